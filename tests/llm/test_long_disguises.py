"""Disguised words of any length."""

import numpy as np

from textloom.llm import toxicity


def test_disguised_words_of_any_length_are_restored():
    words = ("the idiot went with a moron and kill them all right here now " * 40).encode()
    codes = toxicity.CODES[np.frombuffer(b" " + words, np.uint8)].astype(int)
    counts = np.bincount(codes[:-2] * 784 + codes[1:-1] * 28 + codes[2:], minlength=28**3).reshape(28, 28, 28).astype(float)
    restore = toxicity.Restorer(toxicity.char_model(counts))
    assert restore.word("id" + "i" * 40 + "ot") == "idiot" or restore.word("idi" + "i" * 40 + "ot") == "idiot"
    assert restore.word("-".join("killthemallrighthere")).replace(" ", "") == "killthemallrighthere"
    assert restore.word("-".join("moron" * 100)).count("moron") == 100
    for gap in ("  ", "\t", "\n", "\r\n", " \n "):
        assert restore.spelt("you " + gap.join("idiot") + " there") == ["idiot"]
    for before, after in (("(", ")"), ("\u201c", "\u201d,"), ("...", "."), ("", ","), ("you ", " !")):
        assert restore.spelt(f"{before}i d i o t{after}") == ["idiot"]
    for text in ("don't a b", "c'est a b's", "a b", "ab c de f"):
        assert restore.spelt(text) == []
    for n in (41, 401, 50_000):
        assert restore.word("id" + "i" * (n - 4) + "ot") == "idiot"
        spelt = restore.spelt("x " + " ".join("moron" * (n // 5)))
        assert "".join(spelt).count("moron") >= n // 5 - 1


def test_the_byte_condition_loses_no_spelt_word():
    import random

    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b", "1", "@", " ", "  ", "\n", "'", "(", ",", "word", "é", "x y z"]) for _ in range(12))
        if toxicity.SPELT.search(text.lower()):
            assert toxicity.MAY_SPELL.search(text.encode()), text
