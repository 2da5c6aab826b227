"""Operators' inner functions against brute force and the public libraries."""

import base64
import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from textloom.llm import embeddings, graph, packing, quality_model, secrets, simhash, token_counts, toxicity, warc

rng = random.Random(5)
ODD = ["", " ", "\n\n", "a", "Ünïcödé ñ word's 12,5 don't!", "日本語 テキスト\x1c\x85x", "<|endoftext|> <|x|>", "X" * 300, "é ́x", "tab\tnl\nvt\x0bff\x0c", "😀😀 '''re 're"]


def test_word_ids_equal_the_tokenizer():
    words = packing.WordIds(None)
    texts = ODD + ["".join(rng.choice("abÀß 'S,.!?\n1é") for _ in range(80)) for _ in range(300)]
    for text, want in zip(texts, words.whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(words.text(text.encode()), "<u4").tolist() == want.ids, text


@pytest.mark.parametrize("lengths", [[], [1], [4096], [3000] * 50, [5, 9000, 4095, 1], [rng.randint(1, 6000) for _ in range(400)], [1] * 5000])
def test_packing_round_trip(lengths):
    pieces, n = packing.pack_lengths(lengths, 4096)
    covered = {i: [] for i in range(len(lengths))}
    filled = {}
    for i, start, size, seq, at in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert at == filled.get(seq, 0) and size > 0
        filled[seq] = at + size
        covered[i].append((start, size))
    for i, k in enumerate(lengths):
        at = 0
        for start, size in sorted(covered[i]):
            assert start == at
            at += size
        assert at == k
    assert set(filled) == set(range(n)) and all(v <= 4096 and (v == 4096 or v & (v - 1) == 0) for v in filled.values())


def test_fill_is_the_best_subset():
    for _ in range(60):
        lengths = sorted(rng.randint(1, 40) for _ in range(rng.randint(1, 9)))
        have = {x: lengths.count(x) for x in lengths}
        counts, total = packing._fill(sorted(have), dict(have), 60)
        rest = lengths[:-1]
        best = max(lengths[-1] + sum(x for j, x in enumerate(rest) if m >> j & 1) for m in range(1 << len(rest)) if lengths[-1] + sum(x for j, x in enumerate(rest) if m >> j & 1) <= 60)
        assert total == best == sum(k * v for k, v in counts.items()) and all(v <= have[k] for k, v in counts.items())


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | len(x := n.to_bytes((n.bit_length() + 7) // 8, "big"))]) + x
    return bytes([tag]) + size + body


INT = lambda n: der(2, n.to_bytes(max(1, (n.bit_length() + 8) // 8), "big"))
RSA = der(0x30, b"".join(map(INT, [0, 3 << 400, 65537, 5 << 390, 7 << 190, 11 << 190, 13 << 180, 17 << 180, 19 << 180])))
PKCS8 = der(0x30, INT(0) + der(0x30, der(6, b"\x2a\x86\x48") + der(5, b"")) + der(4, RSA))


def b64(x, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(x).decode().rstrip("=" if url else "")


JWT = ".".join([b64(json.dumps({"alg": "HS256"}).encode(), True), b64(json.dumps({"sub": "1"}).encode(), True), "c2ln"])
STRING = lambda x: len(x).to_bytes(4, "big") + x
OPENSSH = b"openssh-key-v1\0" + STRING(b"none") * 2 + STRING(b"") + (1).to_bytes(4, "big") + STRING(b"pub" * 9) + STRING(b"priv" * 20)


def kinds(text):
    return [k for _, k, _ in secrets.all_spans(text)[1]]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (f"see {b64(PKCS8)} here", ["der"]), (f"see {RSA.hex()} here", ["hex", "der"]), (f"x {JWT} y", ["jwt"]), (b64(OPENSSH), ["openssh"]),
        (f"-----BEGIN RSA PRIVATE KEY-----\n{b64(RSA)}\n-----END RSA PRIVATE KEY-----", ["pem"]), ("-----BEGIN RSA PRIVATE KEY-----\nbm90IGEga2V5\n-----END RSA PRIVATE KEY-----", []),
        (b64(b'{"api_key": "abcdef123456"}'), ["nested"]), (b64(PKCS8[:-1]), []), ("eyJhIjoxfQ.eyJhIjoxfQ.c2ln", []), ("A" * 60, []), (b64(b"just some harmless words here"), []),
        ("Token : 'abc", []), ("PASSWD='abcdef'", ["assign"]), ("token=secret=abcdef", ["assign"]), ("AKIA" + "A" * 15, []), ("AKIA" + "A" * 16, ["access"]), ("0" * 23, []), ("f" * 24, ["hex"]), ("\u017fecret=abcdef to\u212aen=abcdef", []),
    ],
)
def test_secret_kinds(text, want):
    assert kinds(text) == want


def brute_base(text):
    out = []
    for kind, pattern, ok in (("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[1]) >= 6), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.A) if ok(m)]
    return sorted(out, key=lambda s: (s[0], secrets.RANK[s[1]]))


def test_base_spans_and_triggers_against_brute_force():
    parts = ["password", "Secret", "TOKEN", "api_key", "apikey", " = ", ": '", "=", "AKIA", "ABCDEF0123456789", "0123456789abcdef", "deadbeef", "ñ ", " the ", "-", "\n", "x", b64(PKCS8), JWT]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    joined, off = "".join(texts).encode(), np.cumsum([0, *(len(t.encode()) for t in texts)])
    found = set(secrets.suspects(np.frombuffer(joined, np.uint8), off[:-1]).tolist())
    for i, t in enumerate(texts):
        assert secrets.all_spans(t)[0] == brute_base(t), t
        assert i in found or not secrets.all_spans(t)[1], t


def brute_fingerprint(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    h = [xxhash.xxh64(" ".join(w[i : i + k]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for t in [*ODD, "One two", "ONE TWO three", "É é É é"] + [" ".join(rng.choice("a b c dd É".split()) for _ in range(n)) for n in range(1, 60)]:
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t), t


def test_tile_comparison_and_forest():
    base = np.array([rng.getrandbits(64) for _ in range(40)], np.uint64)
    near = np.array([int(x) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in base] * 3, np.uint64)
    linked = simhash.compare(base, near, 3)
    assert (linked == np.array([[bin(int(a) ^ int(b)).count("1") <= 3 for b in near] for a in base])).all()
    ids_a, ids_b = np.arange(40), np.arange(100, 100 + len(near))
    want = graph.forest([(int(ids_a[i]), int(ids_b[j])) for i, j in np.argwhere(linked)])
    edges = list(simhash.link_forest(linked, ids_a, ids_b))
    assert graph.forest(edges) == want and len(edges) < 40 + len(near)


def test_pivot_lists_find_each_link_once():
    g = np.random.default_rng(2)
    v = embeddings.unit(np.repeat(g.normal(size=(30, 16)), 5, axis=0) + 0.05 * g.normal(size=(150, 16)))
    order = embeddings.nearest_pivots(v, embeddings.unit(g.normal(size=(64, 16))), 8)
    total = np.zeros((150, 150), int)
    for pivot in range(64):
        own = np.flatnonzero((order == pivot).any(axis=1))
        total[np.ix_(own, own)] += embeddings.tile_links(v[own], v[own], order[own], order[own], pivot, True, 0.98, 2)
    want = np.triu(v @ v.T >= 0.98, 1)
    assert total.max() == 1 and not (total > want).any() and (total & want).sum() >= 0.9 * want.sum()


def test_token_counts_equal_the_unigram_tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces, hidden = token_counts.vocabulary()
    shown = [(p if i not in hidden or p[:3] == "<0x" or i == 0 else f"\ue000{i}", x) for i, (p, x) in enumerate(pieces)]
    for fallback, out, own in ((True, hidden, shown), (False, (0,), [("<unk>", -3.0), ("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -3.0), ("ba", -2.0), ("aba", -3.0)])):
        whole = Tokenizer(models.Unigram(own, unk_id=0, byte_fallback=fallback))
        whole.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        counts = token_counts.WordCounts(own, out, fallback)
        texts = ODD + ["".join(rng.choice("ab ñé▁\n0.<>") for _ in range(rng.randint(1, 60))) for _ in range(400)] + ["".join(rng.choice("ab") for _ in range(30)) for _ in range(200)]
        assert [counts.text(t.encode()) for t in texts] == [len(e.ids) for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_control_and_byte_pieces_match_no_text():
    counts = token_counts.WordCounts(*token_counts.vocabulary())
    assert counts.text(b"<s>") > 1 and counts.text(b"<0x41>") > 1 and counts.text("\u0378".encode()) == 3


def test_any_other_tokenizer_gets_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    words = packing.WordIds(path)
    for text in ("Hello World again", "  two  spaces ", "É\x85 ñ\n\nx", ""):
        assert np.frombuffer(words.text(text.encode()), "<u4").tolist() == words.whole.encode(text, add_special_tokens=False).ids


def test_deobfuscation():
    words = ("the idiot went with a moron and the clown saw some trash here " * 40).encode()
    codes = toxicity.CODES[np.frombuffer(b" " + words, np.uint8)].astype(int)
    counts = np.bincount(codes[:-2] * 784 + codes[1:-1] * 28 + codes[2:], minlength=28**3).reshape(28, 28, 28).astype(float)
    restore = toxicity.Restorer(toxicity.char_model(counts))
    for given, want in (("1d1ot", "idiot"), ("m0r0n!", "moron"), ("idiooooot", "idiot"), ("tr@sh", "trash"), ("i.d.i.o.t", "idiot"), ("clown", "clown"), ("the***", "the"), ("12", "12")):
        assert restore.word(given) == want, given
    assert restore.spelt("you i d i o t there") == ["idiot"]


def test_rule_ensemble_learns_a_conjunction():
    g = np.random.default_rng(1)
    x = g.uniform(size=(3000, 4))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.5)).astype(float)
    model = quality_model.fit(x, y)
    assert 0 < len(model["rules"]) < 150
    z = model["bias"] + sum(v * quality_model.holds(r, x) for r, v in model["rules"])
    for f, lo, hi, s, v in model["linear"]:
        z = z + v * (np.clip(x[:, f], lo, hi) - (lo + hi) / 2) / s
    assert ((1 / (1 + np.exp(-z)) > 0.5) == y).mean() > 0.97
    assert quality_model.fit(x[:0], y[:0])["rules"] == []


def test_warc_records_and_keys():
    data = warc.record("f/0", 7, "http://a.b/c\r\nd", "ñ".encode() * 600, None, None)
    got = warc.parse(data)
    assert got.payload == "ñ".encode() * 600 and got.fields["WARC-Type"] == "response"
    assert warc.parse(warc.record("f/1", 7, "", b"x" * 2000, 9, "u")).payload == b"" and b"WARC-Refers-To-Page-ID: 9" in warc.record("f/2", 7, "", b"", 9, "u")
    with pytest.raises(ValueError):
        warc.parse(data[:-3] + b"zzz")
    assert warc.key_of("https://www.Example.org:8080/A?b=1") == "org,example:8080)/a?b=1" and warc.key_of("") and warc.key_of("http://[bad") == "http://[bad" and warc.key_of("http://a.b/c\r\nd") == warc.key_of("http://a.b/c%0D%0Ad") and "\t" not in warc.key_of("x\ty")


def test_crc_is_over_little_endian_ids():
    assert zlib.crc32(np.array([1, 2], "<u4").tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0") and hashlib.sha256(b"").hexdigest() == secrets.EMPTY_HASH
