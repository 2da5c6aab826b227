"""Helpers that the operators of this subpackage share: joins of skewed keys, tile pairs, Arrow batches; and the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.shared import cut, drop_path, scratch, shared_dir  # noqa: F401

#: The six ASCII white space characters that end a word: \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"


HOT_KEYS, HOT_ROWS = 256, 1000
#: Narrow rows up to which a table of keys is broadcast.
BROADCAST_KEYS = 300_000
#: Comparisons of tiles' items that a task is dealt.
PART_COMPARISONS = 5e8


def hot_join(rows: DataFrame, small: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join (inner or left) of rows with small, which has one row for each key and in the column weight its number of rows.

    Keys that hold HOT_ROWS rows and a HOT_KEYS-th of all rows or more are at most HOT_KEYS by this rule: they are broadcast
    and their rows stay where they are. All others are shuffled. No key, however many rows it has, meets in one task."""
    total = small.agg(F.sum(weight)).first()[0] or 0
    limit = max(HOT_ROWS, -(-total // HOT_KEYS))
    hot = F.broadcast(small.where(F.col(weight) >= limit))
    others = rows.join(hot, keys, "left_anti").join(small.where(F.col(weight) < limit), keys, how)
    return rows.join(hot, keys).unionByName(others)


def tile_pairs(items: DataFrame, keys: list[str], tile: Column, steps: Iterable[int] = (0,)) -> DataFrame:
    """Pairs of tiles of items (keys, item struct with id): (pair, same, lefts, rights, keys), lefts and rights arrays of items.

    The items of each key are dealt by hash over tiles of about tile (a column over keys) items; tiles are paired where the
    last key, a number, differs by one of steps (not negative, 0 included) and the others are equal. A tile's pair with itself
    (same) has no rights and is made where the tile is. Other pairs are listed by name first and dealt over tasks one by
    one, so a crowded key makes many tasks, not a large one."""
    last = keys[-1]
    crowd = items.groupBy(*keys).agg(F.count("*").alias("__n")).withColumn("__subs", F.ceil(F.col("__n") / tile).cast("int"))
    crowd = cut(crowd.where("__subs > 1"))  # at most a tile-th as many as items
    if crowd.count() <= BROADCAST_KEYS:
        dealt = items.join(F.broadcast(crowd), keys, "left")
    else:
        dealt = hot_join(items, crowd, keys, "__n", "left")
    dealt = dealt.withColumn("sub", F.pmod(F.xxhash64("item.id"), F.coalesce("__subs", F.lit(1))).cast("int"))
    tiles = cut(dealt.groupBy(*keys, "sub").agg(F.collect_list("item").alias("items")))
    own = tiles.select((F.monotonically_increasing_id() * 2).alias("pair"), F.lit(True).alias("same"), F.col("items").alias("lefts"), F.slice("items", 1, 0).alias("rights"), *keys)
    names = tiles.select(*keys, "sub", F.size("items").alias("__size"))
    other = names.select(*keys[:-1], F.explode(F.array(*[F.col(last) - s for s in steps])).alias(last), F.col(last).alias("__last"), F.col("sub").alias("__sub"), F.col("__size").alias("__size2"))
    pairs = names.join(other, keys).where((F.col(last) != F.col("__last")) | (F.col("sub") < F.col("__sub")))
    pairs = cut(pairs.withColumn("pair", F.monotonically_increasing_id() * 2 + 1))
    right = tiles.select(*keys[:-1], F.col(last).alias("__last"), F.col("sub").alias("__sub"), F.col("items").alias("rights"))
    both = pairs.join(tiles.withColumnRenamed("items", "lefts"), [*keys, "sub"]).join(right, [*keys[:-1], "__last", "__sub"])
    work = pairs.agg(F.sum(F.col("__size") * F.col("__size2").cast("double"))).first()[0] or 0
    parts = max(items.sparkSession.sparkContext.defaultParallelism, min(20_000, int(work / PART_COMPARISONS)))
    return own.unionAll(both.select("pair", F.lit(False).alias("same"), "lefts", "rights", *keys).repartition(parts, "pair"))


def grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of batches that are sorted by column, a table for each of its values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(batch.schema.get_field_index(column)).to_numpy()
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            part = batch.slice(lo, hi - lo)
            if held and held[0].column(column)[0] != part.column(column)[0]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """The columns of each batch; the last one, texts, as a list of UTF-8 bytes, null as empty."""
    for batch in batches:
        if batch.num_rows:
            *keys, text = batch.columns
            yield [*keys, [x or b"" for x in text.cast(pa.binary()).to_pylist()]]


def words_of(text: Column) -> Column:
    """Native column: words [^\\x20\\x09-\\x0D]+ of a text (null: none) as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
