"""Summary statistics of records: one grouped aggregate, and maps of shares ordered by count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import split_sentences, word_count

COMPARED = ("avg_words_human", "avg_words_ai", "avg_sentences_human", "avg_sentences_ai", "label_balance_ai_share")


def _prepared(records: DataFrame) -> DataFrame:
    has = set(records.columns)
    kind = F.coalesce(F.col("sample_kind"), F.when(F.col("label") == "human", "human").otherwise("direct_ai"))
    return records.withColumns({
        "__kind": kind,
        "__domain": F.coalesce("domain", F.lit("unknown")),
        "__generator": F.coalesce("generator_model", F.lit("unknown")),
        "__provider": F.coalesce("generator_provider", F.lit("unknown")),
        "__words": F.coalesce("num_words", word_count(F.col("final_text"))) if "num_words" in has else word_count(F.col("final_text")),
        "__sentences": F.coalesce("num_sentences", F.size(split_sentences(F.col("final_text")))) if "num_sentences" in has else F.size(split_sentences(F.col("final_text"))),
        "__noised": F.coalesce(F.size("augmentation"), F.lit(0)) > 0,
    })


def shares(records: DataFrame, keys: list[str], value: str, where: Column | None = None) -> DataFrame:
    """(keys, shares): MAP of value -> share of the group's rows to four places, largest first, then by name.

    Counts of (keys, value) are combined before the shuffle, so what is gathered is one row for each different value."""
    rows = records if where is None else records.where(where)
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    packed = counts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))).alias("e"), F.sum("n").alias("__all"))
    return packed.select(*keys, F.map_from_entries(F.transform("e", lambda x: F.struct(x["v"], F.round(-x["n"] / F.col("__all"), 4)))).alias("shares"))


def summarize(records: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group of records (for example each file) with counts, means, rates, balances and share maps."""
    df = _prepared(records)
    human, ai, mixed = (F.col("label") == "human"), (F.col("label") == "ai"), (F.col("__kind") == "mixed")
    mean = lambda c, w, d: F.coalesce(F.round(F.avg(F.when(w, F.col(c).cast("double"))), d), F.lit(0.0))
    n_h, n_a, n_m = F.count_if(human), F.count_if(ai), F.count_if(mixed)
    part = lambda n: F.coalesce(F.round(n / F.nullif(n_h + n_a, F.lit(0)), 4), F.lit(0.0))
    out = df.groupBy(*keys).agg(
        n_h.alias("num_human"), n_a.alias("num_ai"), n_m.alias("num_mixed"),
        mean("__words", human, 3).alias("avg_words_human"), mean("__words", ai, 3).alias("avg_words_ai"),
        mean("__sentences", human, 3).alias("avg_sentences_human"), mean("__sentences", ai, 3).alias("avg_sentences_ai"),
        mean("__noised", human, 4).alias("augmentation_rate_human"), mean("__noised", ai, 4).alias("augmentation_rate_ai"),
        part(n_a).alias("label_balance_ai_share"), part(n_m).alias("label_balance_mixed_share"),
    )
    empty = F.create_map().cast("map<string,double>")
    for name, column, where in (("sample_kind_share", "__kind", None), ("domains", "__domain", None), ("generators", "__generator", ai), ("generator_providers", "__provider", ai)):
        found = shares(df, keys, column, where).withColumnRenamed("shares", name)
        out = out.join(found, keys, "left").withColumn(name, F.coalesce(name, empty))
    return out


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """(metric, a, b, diff) of two one-row summaries over the compared metrics."""
    long = lambda df, n: df.select(F.explode(F.create_map(*[x for m in COMPARED for x in (F.lit(m), F.col(m))])).alias("metric", n))
    return long(a, "a").join(long(b, "b"), "metric").withColumn("diff", F.round(F.col("a") - F.col("b"), 4))


def bucket_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("sample_kind").agg(F.count("*").alias("n"))


def quotas_complete(counts: DataFrame, targets: dict[str, int]) -> bool:
    have = {r.sample_kind: r.n for r in counts.collect()}
    return all(have.get(k, 0) >= v for k, v in targets.items())
