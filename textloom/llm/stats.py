"""Statistics of a text as native Spark columns; the quality operators share them.

All of them are linear (or n log n) in the text and work on whole texts inside one projection chain: no user functions, no
shuffle. Arrays that a later column uses twice are columns of their own, so that Spark does not compute them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import SPACE, words_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Common short words of the four languages that the corpora hold.
STOP_WORDS = tuple(
    """the and of to in is that it for on with as was are be at by an this from or a
    le la les de des du et un une en que qui dans pour par au ce est sur pas
    der die das und ist nicht ein eine zu den von mit sich auf für im dem als auch
    el los las y en que del se por un una con para su es no lo""".split()
)


def _without(text: str, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _windows(words: Column) -> Column:
    """A 64-bit hash of each window of five words."""
    last = F.size(words) - WINDOW
    at = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), at)).otherwise(F.array().cast("array<bigint>"))


def add_counts(df: DataFrame, text: str = "__text") -> DataFrame:
    """Adds __words and the base counts of column text (not null): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    n_repeat_words counts the words that lie in a 5-word window found twice or more, the first included. Windows are equal
    when their 64-bit hashes are. Only texts with an equal pair take the slow way, which needs positions."""
    df = df.withColumn("__words", words_of(F.col(text)))
    df = df.withColumn("__windows", _windows(F.col("__words")))
    df = df.withColumn("__sorted", F.sort_array("__windows"))
    twice = F.exists(F.arrays_zip(F.expr("slice(__sorted, 1, greatest(size(__sorted) - 1, 0))").alias("a"), F.expr("slice(__sorted, 2, greatest(size(__sorted) - 1, 0))").alias("b")), lambda p: p["a"] == p["b"])
    df = df.withColumn("__placed", F.when(twice, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda p, k: (F.get("__placed", k - 1)["h"] == p["h"]) | (F.get("__placed", k + 1)["h"] == p["h"])
    df = df.withColumn("__at", F.sort_array(F.transform(F.filter("__placed", lambda p, k: F.coalesce(same(p, k), (F.get("__placed", F.when(k > 0, k - 1).otherwise(k + 1))["h"] == p["h"]), F.lit(False))), lambda p: p["i"])))
    covered = F.aggregate(F.transform("__at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__at", k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda s, x: s + x)
    df = df.withColumn("__lines", F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACE, "") != ""))
    return df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": _without(text, SPACE).cast("long"),
        "n_symbols": (F.length(text) - _without(text, SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    })


def add_ratios(df: DataFrame, text: str = "__text") -> DataFrame:
    """Adds ratios over the counts of add_counts; all are 0 for a text without words."""
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.size("__lines")
    df = df.withColumns({
        "__n_stop": F.size(F.filter("__words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
        "__n_bars": F.size(F.filter("__words", lambda w: w == "|")).cast("long"),
        "__n_upper": (F.length(text) - _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long"),
        "__n_loud": (F.length(text) - _without(text, "!?")).cast("long"),
        "__n_stops": (F.length(text) - _without(text, ".,;:")).cast("long"),
        "__n_digits": (F.length(text) - _without(text, "0123456789")).cast("long"),
        "__n_kinds": F.size(F.array_distinct("__words")).cast("long"),
        "__n_lines": lines.cast("long"),
    })
    return df.withColumns({
        "mean_word": over(chars, n),
        "symbol_ratio": over(F.col("n_symbols"), n),
        "stop_ratio": over(F.col("__n_stop"), n),
        "bar_ratio": over(F.col("__n_bars"), n),
        "upper_ratio": over(F.col("__n_upper"), chars),
        "loud_ratio": over(F.col("__n_loud"), n),
        "mark_ratio": over(F.col("__n_stops"), n),
        "digit_ratio": over(F.col("__n_digits"), chars),
        "kind_ratio": over(F.col("__n_kinds"), n),
        "dup_line_ratio": over(F.col("n_dup_lines"), F.col("__n_lines")),
        "repeat_ratio": over(F.col("n_repeat_words"), n),
        "words_a_line": over(n, F.col("__n_lines")),
    })
