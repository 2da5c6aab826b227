"""Ordered numbering, first rows and running balance without sorting a whole key in one task.

Every order is a hex digest, so its first digits are even buckets. Counts by (key, bucket), combined before the shuffle,
give each bucket's offset; rows are numbered within their bucket only. A key with all rows is dealt over 4096 groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 3


def numbered(df: DataFrame, keys: list[str], order: str, out: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds out: 1, 2, ... within keys (null-safe) in ascending order of the hex digest in column order."""
    at = df.withColumns({"__bucket": F.substring(order, 1, DIGITS), **{f"__k{i}": F.coalesce(F.col(k).cast("string"), F.lit("\0")) for i, k in enumerate(keys)}})
    own = [f"__k{i}" for i in range(len(keys))]
    before = Window.partitionBy(*own).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = at.groupBy(*own, "__bucket").agg(F.count("*").alias("__n"))
    offsets = counts.select(*own, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inner = Window.partitionBy(*own, "__bucket").orderBy(order, *ties)
    ranked = at.withColumn("__row", F.row_number().over(inner)).join(offsets, [*own, "__bucket"])
    return ranked.withColumn(out, F.col("__row") + F.col("__offset")).drop("__bucket", "__row", "__offset", *own)


def first_rows(df: DataFrame, keys: list[str], order: str, limit: Column | int, ties: tuple[str, ...] = ()) -> DataFrame:
    """The first limit rows of each key."""
    return numbered(df, keys, order, "__number", ties).where(F.col("__number") <= limit).drop("__number")


def with_ids(df: DataFrame, split: str, order: str, prefix: str, out: str = "id", offsets: DataFrame | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Dense ids prefix_split_number within each split; offsets (split, last) continue an earlier output."""
    df = numbered(df, [split], order, "__number", ties)
    if offsets is not None:
        df = df.join(F.broadcast(offsets.select(F.col("split").alias(split), F.col("last").alias("__last"))), split, "left").withColumn("__number", F.col("__number") + F.coalesce("__last", F.lit(0))).drop("__last")
    return df.withColumn(out, F.format_string("%s_%s_%06d", F.lit(prefix), F.col(split), F.col("__number"))).drop("__number")


def by_quota(domain: str, quotas: dict[str, float], counts: dict[str, int]) -> Column:
    """The quota domain that a row counts towards: its own, or where it has no quota the one with the fewest rows (by name where equal)."""
    return F.when(F.col(domain).isin(*quotas), F.col(domain)).otherwise(min(sorted(quotas), key=lambda q: counts.get(q, 0)))


def domain_balanced(df: DataFrame, domain: str, order: str, quotas: dict[str, float], leak: Column, slack: float = 1.12, leak_rate: float = 0.22, have: dict[str, int] | None = None, wanted: int | None = None) -> DataFrame:
    """Rows up to slack times their domain's quota of all rows, and of the rest those whose leak draw is below leak_rate.

    have: rows that each domain has so far; all rows are those and wanted (by default all of df) more. No quotas: all rows."""
    if not quotas:
        return df
    total, have = sum(quotas.values()) or 1.0, have or {}
    named = F.when(F.col(domain).isin(*quotas), F.col(domain))
    here = {r[0]: r[1] for r in df.groupBy(named.alias("d")).count().collect()}  # a row for each quota, and one
    counts = {q: have.get(q, 0) + here.get(q, 0) for q in quotas}
    basis = sum(have.values()) + (sum(here.values()) if wanted is None else wanted)
    limit = {q: slack * v / total * basis for q, v in quotas.items()}
    limit = F.element_at(F.create_map(*[F.lit(x) for q, v in limit.items() for x in (q, max(0.0, v - have.get(q, 0)))]), F.col("__domain"))
    ranked = numbered(df.withColumn("__domain", by_quota(domain, quotas, counts)), ["__domain"], order, "__number")
    return ranked.where((F.col("__number") <= F.ceil(limit)) | (leak < leak_rate)).drop("__number", "__domain")
