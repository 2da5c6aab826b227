"""Exact and normalised duplicates, within a frame and against earlier output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import normalized_hash, text_hash


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of narrow rows with one key the first in order stays, by an aggregate that is combined before the shuffle: no key's rows are gathered."""
    others = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.min(F.struct(order, *others)).alias("__first")).select(key, "__first.*").select(df.columns)


def drop_duplicates(df: DataFrame, text: str, order: str, normalise: bool = True) -> DataFrame:
    """Of rows with one (normalised) text the first in order stays. Only (hash, order) rows are grouped."""
    keyed = df.select(order, (normalized_hash if normalise else text_hash)(F.col(text)).alias("__hash"))
    return df.join(first_of(keyed, "__hash", order).select(order), order, "left_semi")


def written(earlier: DataFrame, normalise: bool = True) -> DataFrame:
    """(__hash): the (normalised) hashes of the texts of earlier (base_text)."""
    return earlier.where(F.trim("base_text") != "").select((normalized_hash if normalise else text_hash)(F.col("base_text")).alias("__hash")).distinct()


def not_written(df: DataFrame, earlier: DataFrame, text: str, normalise: bool = True) -> DataFrame:
    """Rows whose (normalised) text no row of earlier (base_text) has."""
    keyed = df.withColumn("__hash", (normalized_hash if normalise else text_hash)(F.col(text)))
    return keyed.join(written(earlier, normalise), "__hash", "left_anti").drop("__hash")
