"""Scalar functions and filters against plain Python."""

import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textloom.config import QualityConfig, parse_sample_targets
from textloom.functions import metrics, noise, text
from textloom.operators.filters import is_garbage, quality_reason

TEXTS = ["", " ", "One. Two! Three? \"Four.\" five", "a\r\nb\rc\n\n\n\nd \t e", "\0x\0", "ｆｕｌｌ ﬁ", "a b  c", "- a\n* b\n• c\n1. d\nplain\n2. e", "word " * 12, "def f(): import x SELECT y #include", "Ünïcödé señor. Ende"]


def one(spark, column, rows=TEXTS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def clean(t):
    t = unicodedata.normalize("NFKC", t.replace("\0", ""))
    t = re.sub(r"[ \t]+", " ", t.replace("\r\n", "\n").replace("\r", "\n"))
    return re.sub(r"\n{3,}", "\n\n", t).strip()


def test_clean_text(spark):
    assert one(spark, text.clean_text(F.col("t"))) == [clean(t) for t in TEXTS]
    assert one(spark, text.clean_text(F.col("t")), [None]) == [""]


def test_sentences_words_hashes(spark):
    assert one(spark, text.split_sentences(F.col("t"))) == [[p.strip() for p in re.split(r"(?<=[.!?])\s+", t) if p.strip()] for t in TEXTS]
    # NUL apart, both agree on every white space
    assert one(spark, text.word_count(F.col("t"))) == [len(t.split()) for t in TEXTS]
    norm = lambda t: re.sub(r"\s+", " ", t.lower().strip())
    assert one(spark, text.normalized_hash(F.col("t"))) == [hashlib.sha256(norm(t).encode()).hexdigest() for t in TEXTS]


@pytest.mark.parametrize(("given", "want"), [("A b. C", "A b."), ("no end", "no end"), ('x." y', 'x."'), ("v1.5 is", "v1.5 is"), ("", ""), (" One.\nTwo! three ", "One.\nTwo!")])
def test_trim(spark, given, want):
    assert one(spark, text.trim_to_sentence_boundary(F.col("t")), [given]) == [want]


@pytest.mark.parametrize(("given", "want"), [("Sure, ok\nHere is x\nBody\nSure, kept", "Body\nSure, kept"), ("Body", "Body"), ("Okay!", ""), ("\nSure, x", "Sure, x")])
def test_strip_boilerplate(spark, given, want):
    assert one(spark, text.strip_leading_boilerplate(F.col("t")), [given]) == [want]


def test_combine_and_mixed(spark):
    rows = spark.createDataFrame([("a ", " b"), ("a", ", b"), ("a", ""), ("", "b")], "p string, c string")
    assert [r[0] for r in rows.select(text.combine(F.col("p"), F.col("c"))).collect()] == ["a b", "a, b", "a", "b"]
    assert rows.select(text.mixed_final(F.col("p"), F.col("c"), "\n\n")).first()[0] == "a\n\nb"
    assert one(spark, text.is_text_model(F.col("t")), ["x:TEXT", "y-text", "text-y"]) == [True, True, False]


def test_metrics(spark):
    def rep(t):
        w = t.lower().split()
        return 0.0 if len(w) < 10 else 1 - len(set(w)) / len(w)

    assert one(spark, metrics.repetition_score(F.col("t"))) == pytest.approx([rep(t) for t in TEXTS])
    assert one(spark, metrics.non_alnum_ratio(F.col("t"))) == pytest.approx([sum(not (c.isalnum() or c.isspace()) for c in t) / len(t) if t else 1.0 for t in TEXTS])
    assert one(spark, metrics.bullet_ratio(F.col("t")))[7] == pytest.approx(5 / 6)
    assert one(spark, metrics.code_hits(F.col("t")))[9] == 4
    pairs = spark.createDataFrame([("a b", "a b c d"), ("", "x"), ("a", "")], "p string, t string")
    assert [r[0] for r in pairs.select(metrics.prefix_overlap(F.col("p"), F.col("t"))).collect()] == [0.5, 0.0, 1.0]


GOOD = "This is a sound sentence with some words in it. " * 2 + "Here comes another different line of prose! And a third one?"


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("", "empty"), ("few words", "too_short"), ("w" + " w" * 300, "too_long"), ("word " * 30, "too_few_sentences"), ("a. b. c! " + "%$ # @ " * 10, "too_many_symbols"),
        ("same. same. same. " * 8, "repetitive"), (GOOD, "ok"), ("Sure, " + GOOD, "assistant_boilerplate"), ("\n".join(f"- item {i} w{i}. Next{i}" for i in range(8)), "list_heavy"),
        ("def a import b SELECT c. " + GOOD, "code_heavy"), (None, "empty"),
    ],
)
def test_quality_reasons(spark, given, want):
    cfg = QualityConfig(word_count_min=8, word_count_max=200, max_line_repetition=0.5)
    assert one(spark, quality_reason(F.col("t"), cfg), [given]) == [want]


def test_overlap_rule(spark):
    cfg = QualityConfig(word_count_min=8, word_count_max=200, max_line_repetition=0.5)
    df = spark.createDataFrame([(GOOD, GOOD), (GOOD, "other"), (GOOD, None)], "t string, p string")
    got = [r[0] for r in df.select(quality_reason(F.col("t"), cfg, is_ai=True, prefix=F.col("p"))).collect()]
    assert got == ["ai_too_similar_to_prefix", "ok", "ok"]


def test_garbage(spark):
    long = ["Word word word word word word word word word word word."] * 4
    df = spark.createDataFrame([(long,), (long[:3],), (["a."] * 5,), (["{ } 1 2 3 4 5 6 7 8 9 0 % % % % % % % % % % % % % % % % % %."] * 6,)], "s array<string>")
    assert [r[0] for r in df.select(is_garbage(F.col("s"))).collect()] == [False, True, True, True]


def test_noise_kernels_change_one_word(spark):
    base = "The quick brown foxx jumps, señor über alles."
    df = spark.createDataFrame([(i, base) for i in range(40)], "id long, t string")
    for kernel in noise.KERNELS:
        out = [r[0] for r in noise.add_noise(df, "t", F.lit(kernel), 1, F.col("id"), "x", "o").orderBy("id").select("o").collect()]
        for t in out:
            assert abs(len(t) - len(base)) <= {"insert": 1, "duplicate": 1, "delete": 1, "repeat_drop": 1}.get(kernel, 0), (kernel, t)
            assert sum(a != b for a, b in zip(t.split(), base.split(), strict=True)) <= 1
            assert "señor über" in t
        assert any(t != base for t in out), kernel
    nothing = spark.createDataFrame([(1, "a é 1"), (2, "")], "id long, t string")
    assert [r.o for r in noise.add_noise(nothing, "t", F.lit("swap"), 1, F.col("id"), "x", "o").orderBy("id").collect()] == ["a é 1", ""]


def test_adjective_removal_and_augment(spark):
    assert noise.drop_adjective("A wonderful day , it was.", 0) == ("A day, it was.", "wonderful")
    assert noise.drop_adjective("A day", 0) == ("A day", None)
    df = spark.createDataFrame([(i, "A wonderful day came over the famous hills.") for i in range(60)], "id long, t string")
    out = noise.augment(df, "t", F.lit(False), 3, F.col("id"), "p", "o", "log").collect()
    assert all((r.o != r.t.strip()) >= bool(r.log) for r in out)
    sizes = {len(r.log) for r in out}
    assert {0, 1, 2} >= sizes and 1 in sizes
    assert {x.type for r in out for x in r.log} <= {*noise.KERNELS, "adj_remove"}


def test_targets():
    assert parse_sample_targets({}) is None
    with pytest.raises(ValueError):
        parse_sample_targets({"use_sample_quotas": True, "sample_targets": {"human": 1}})
    with pytest.raises(ValueError):
        parse_sample_targets({"use_sample_quotas": True, "sample_targets": {"human": -1, "direct_ai": 0, "hard_ai": 0, "mixed": 0}})
