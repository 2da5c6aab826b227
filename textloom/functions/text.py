"""Scalar text functions as native columns; only NFKC needs an Arrow UDF, as Spark has no such function.

White space is Unicode white space throughout: the patterns carry (?U)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from importlib import import_module

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Line beginnings that a completion loses (fixed values).
LEAD_LINES = r"(?i)^(sure[,! ]|here is|here's|okay[,! ]|as an ai|i cannot|i'm an ai)"
#: Characters before which no space is put when a completion is joined to its prefix (fixed values).
TIGHT = " \n\t.,;:!?'\")}]}"


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_plain(text: Column) -> Column:
    """True for ASCII texts, which every normal form leaves alone."""
    return F.length(text) == F.octet_length(text)


def clean_text(text: Column, normalise: bool = True) -> Column:
    """NUL away, NFKC, line ends to LF, runs of blanks to one space, three or more line ends to two, ends stripped; null: ""."""
    t = F.coalesce(F.replace(text, F.lit("\0"), F.lit("")), F.lit(""))
    if normalise:
        t = F.when(is_plain(t), t).otherwise(F.coalesce(nfkc(F.when(~is_plain(t), t)), F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, "\r\n?", "\n"), "[ \t]+", " ")
    return strip(F.regexp_replace(t, "\n{3,}", "\n\n"))


def split_sentences(text: Column) -> Column:
    """Sentences end with . ! or ? before white space; trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"(?U)(?<=[.!?])\s+"), strip), lambda s: s != "")


def splitter(name: str) -> Callable[[Column], Column]:
    """A splitter of another kind, by the name module:function of a str -> list[str]; it runs on Arrow batches, blanks are dropped."""
    module, _, attribute = name.partition(":")
    if not attribute or not callable(getattr(import_module(module), attribute, None)):
        raise ValueError(f"{name!r} is no splitter; module:function is asked for")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(text: pd.Series) -> pd.Series:
        of = getattr(import_module(module), attribute)
        return text.map(lambda x: [t for s in of(x or "") if (t := s.strip())])

    return split


def count_sentences(sentences: Column) -> Column:
    return F.size(F.filter(sentences, lambda s: strip(s) != ""))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def normalize_for_dedup(text: Column) -> Column:
    return F.regexp_replace(strip(F.lower(F.coalesce(text, F.lit("")))), r"(?U)\s+", " ")


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def normalized_hash(text: Column) -> Column:
    return F.sha2(normalize_for_dedup(text), 256)


def join_span(sentences: Column) -> Column:
    return F.array_join(F.filter(F.transform(sentences, strip), lambda s: s != ""), " ")


def trim_to_sentence_boundary(text: Column) -> Column:
    """Cut after the last sentence end; texts without one are only stripped."""
    t = strip(text)
    head = F.regexp_extract(t, r"""(?sU)^(.*[.!?]['"]?)(?=\s|$)""", 1)
    return F.when(head == "", t).otherwise(strip(head))


def strip_leading_boilerplate(text: Column) -> Column:
    """Without the leading lines that begin like a chat reply, then stripped."""
    lines = F.split(text, "\n", -1)
    first = F.array_position(F.transform(lines, lambda x: ~strip(x).rlike(LEAD_LINES)), True).cast("int")
    return F.when(first > 0, strip(F.array_join(F.slice(lines, first, F.size(lines)), "\n"))).otherwise("")


def combine(prefix: Column, completion: Column) -> Column:
    """Prefix and completion with one space between, unless the completion begins with a mark or blank."""
    p, c = F.regexp_replace(prefix, r"(?U)\s+$", ""), F.regexp_replace(completion, r"(?U)^\s+", "")
    tight = F.substring(c, 1, 1).isin(*TIGHT)
    return F.when(c == "", p).when((p == "") | tight, F.concat(p, c)).otherwise(F.concat_ws(" ", p, c))


def is_text_model(model: Column) -> Column:
    low = F.lower(model)
    return F.contains(low, F.lit(":text")) | F.endswith(low, F.lit("-text"))


def mixed_final(human: Column, machine: Column, joiner: str) -> Column:
    return F.concat(strip(human), F.lit(joiner), strip(machine))


def count_of(text: Column, piece: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)).cast("int")
