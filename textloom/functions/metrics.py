"""Scalar text metrics, inputs of the filters, as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import count_of, strip, words

#: Signs of program text in raw documents and in samples (fixed values).
GARBAGE_MARKERS = ("```", "{", "}", "def ", "import ", "SELECT ", "#include")
CODE_MARKERS = ("def ", "import ", "SELECT ", "#include", "func ", "package ")
#: Line beginnings that make a list item (fixed values).
BULLET = r"^(-|\*|•|1\.|2\.|3\.)"


def non_alnum_ratio(text: Column) -> Column:
    """Share of characters that are neither letters, numbers nor white space; empty: 1."""
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, r"(?U)[\p{L}\p{N}\s]", "")) / F.length(text)).otherwise(1.0)


def repetition_score(text: Column) -> Column:
    """1 - different words / words, in lower case; under ten words 0."""
    w = words(F.lower(text))
    return F.when(F.size(w) < 10, 0.0).otherwise(1 - F.size(F.array_distinct(w)) / F.size(w))


def prefix_overlap(prefix: Column, text: Column) -> Column:
    """Share of a text's words that its prefix has; a text without words: 1."""
    # the struct binds both arrays once; written into the lambda they would be built again for every word
    bound = F.array(F.struct(words(F.lower(text)).alias("full"), F.array_distinct(words(F.lower(prefix))).alias("own")))
    ratio = lambda s: F.when(F.size(s["full"]) == 0, 1.0).otherwise(1 - F.size(F.filter(s["full"], lambda w: ~F.array_contains(s["own"], w))) / F.size(s["full"]))
    return F.get(F.transform(bound, ratio), F.lit(0))


def alpha_ratio(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"(?U)[^\p{L}\s]", "")) / F.greatest(F.length(text), F.lit(1))


def marker_count(text: Column, markers: tuple[str, ...] = GARBAGE_MARKERS) -> Column:
    return sum((count_of(text, m) for m in markers), F.lit(0))


def code_hits(text: Column) -> Column:
    return marker_count(text, CODE_MARKERS)


def lines(text: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(text, "\n", -1), strip), lambda x: x != "")


def bullet_ratio(text: Column) -> Column:
    """Share of list items among the lines, of texts with more than five lines; else 0."""
    ls = lines(text)
    return F.when(F.size(ls) > 5, F.size(F.filter(ls, lambda x: x.rlike(BULLET))) / F.size(ls)).otherwise(0.0)
