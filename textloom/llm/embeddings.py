"""Operator 9, embedding near-duplicates by a pivot-permutation index.

Each vector is described by the ordered list of its nearest pivots (reference vectors). Inverted lists hold, for each
label and pivot, the vectors that name that pivot among their first `PREFIX`; vectors that share at least `SHARED` pivots
are candidates and are verified by their cosine in double precision. A pair is judged only in the list of the smallest
pivot that it shares, so it is counted once.

The pivots are fitted on a bounded sample for each length of vector: by seeded hashes, about four times the root of the
number of vectors and at most `MAX_PIVOTS`, so that lists grow more slowly than the input; of pivots nearer than `THIN` one
stays, so the members of a dense group name the same pivots. Every vector is indexed.

Scale: equal vectors of a label are one row before any search, named by a hash of label and vector; the rows themselves are
joined back by that name, those of hot vectors without a shuffle. Lists are split by hash into tiles of about `TILE` vectors; a
tile is compared with itself where it is, pairs of tiles of a crowded list are dealt over tasks one by one. A tile pair
returns link counts for each vector and a spanning forest, never the pairs. Only the pivots are broadcast.

Defined cases: vectors that are null, empty or zero, hold null or non-finite components, or have no label or no vec_id link
with nothing: n_links 0, component_id = vec_id. Vectors of different lengths never link. Float columns stay float until they are
scaled in double precision, all others are read as double; at the threshold's last digits the quotient of the plain sums
decides. Repeated rows, and rows that repeat a vec_id, each count as a vector of their own. An empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import cut, hot_join, table, tile_pairs
from textloom.llm.graph import components
from textloom.llm.simhash import link_forest

COSINE, PREFIX, SHARED, MAX_PIVOTS, TILE, SEED, THIN = 0.98, 8, 2, 16_384, 512, 7, 0.95
#: Numbers that all pivots together hold at most (32 MB), but for 64 pivots of each length.
PIVOT_VALUES = 1 << 22


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, whatever their scale."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the first prefix pivots of each unit vector by descending cosine, ties by number."""
    k = min(prefix, len(pivots))
    near = vectors @ pivots.T
    some = np.argpartition(-near, k - 1, axis=1)[:, :k]
    by = np.lexsort((some, -np.take_along_axis(near, some, axis=1)), axis=1)
    return np.take_along_axis(some, by, axis=1)


def thinned(vectors: np.ndarray, most: float = THIN) -> np.ndarray:
    """The rows of unit vectors, in order, without those nearer than most to one that stays.

    A dense group then has one pivot, not many, so its members name the same ones."""
    stay = np.zeros(0, np.int64)
    for lo in range(0, len(vectors), 256):
        part = vectors[lo : lo + 256]
        far = np.flatnonzero((part @ vectors[stay].T < most).all(axis=1))
        near, kept = part[far] @ part[far].T, []
        for i in range(len(far)):
            if not (near[i, kept] >= most).any():
                kept.append(i)
        stay = np.concatenate([stay, lo + far[kept]])
    return vectors[stay]


def fit_pivots(vectors: DataFrame, count: int | None = None) -> dict[int, np.ndarray]:
    """Length -> unit vectors of a sample of the vectors (v) of that length, by seeded hashes, thinned.

    count: of each length; by default about four times the root of its number of vectors, at least 64, and at most MAX_PIVOTS
    and what PIVOT_VALUES numbers hold, shared among the lengths. Lengths with fewer vectors are taken whole."""
    held = {r[0]: r[1] for r in vectors.groupBy(F.size("v")).count().collect()}
    most = lambda size, n: count or max(64, min(MAX_PIVOTS, PIVOT_VALUES // (size * len(held)), 1 << int(np.ceil(np.log2(4 * n**0.5)))))
    if not held:
        return {}
    spark, digest = vectors.sparkSession, F.pmod(F.xxhash64(F.lit(SEED), "v"), F.lit(1 << 30))
    share = spark.createDataFrame([(size, min(1.0, most(size, n) / n)) for size, n in held.items()], "size int, share double")
    rows = vectors.select("v", F.size("v").alias("size"), digest.alias("digest")).join(F.broadcast(share), "size").where(F.col("digest") < F.col("share") * (1 << 30))
    by: dict[int, list] = {}
    for r in sorted(rows.select("v", "size", "digest").collect(), key=lambda r: (r.digest, r.v)):
        by.setdefault(r.size, []).append(r.v)
    return {size: thinned(unit(np.array(v[: 2 * most(size, held[size])], np.float64))) for size, v in by.items()}


def shared_pivots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many pivots each of a x b (rows of pivot numbers) share."""
    names, inverse = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
    hot = np.zeros((len(a) + len(b), len(names)), np.float32)
    hot[np.repeat(np.arange(len(hot)), a.shape[1]), inverse] = 1
    return hot[: len(a)] @ hot[len(a) :].T


def tile_links(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, pivot: int, same: bool, cosine: float, shared: int) -> np.ndarray:
    """Which of a x b (vectors) are links that this pivot's list has to report."""
    near = unit(a) @ unit(b).T
    linked = (shared_pivots(pa_, pb) >= min(shared, pa_.shape[1])) & (near >= cosine)
    for i, j in np.argwhere(np.abs(near - cosine) < 1e-12):  # where the last digits decide, by the plain quotient
        x, y = a[i].astype(np.float64), b[j].astype(np.float64)
        linked[i, j] = (pa_[i][:, None] == pb[j]).sum() >= min(shared, pa_.shape[1]) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine
    if same:
        linked &= np.triu(np.ones(linked.shape, bool), 1)
    at = np.argwhere(linked)
    for lo in range(0, len(at), 1 << 16):  # only where this pivot is the smallest of those shared
        i, j = at[lo : lo + (1 << 16)].T
        equal = (pa_[i][:, :, None] == pb[j][:, None, :]).any(axis=2)
        first = np.where(equal, pa_[i], np.iinfo(np.int64).max).min(axis=1)
        linked[i, j] = first == pivot
    return linked


def described(distinct: DataFrame, held: Broadcast, prefix: int) -> DataFrame:
    """distinct (u, label, v, copies) with pivots, the numbers of each vector's nearest ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                for lo in range(0, len(rows), 2048):
                    part = batch.take(pa.array(rows[lo : lo + 2048]))
                    v = part.column(2).flatten().to_numpy().reshape(-1, size)
                    order = nearest_pivots(unit(v), held.value[size], prefix) if size in held.value else np.zeros((len(v), 0), np.int64)
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1) * order.shape[1], pa.int32()), pa.array(order.ravel(), pa.int32()))
                    yield pa.RecordBatch.from_arrays([*part.columns, flat], names=[*part.schema.names, "pivots"])

    rows = distinct.select("u", "label", "v", "copies")
    return rows.mapInArrow(run, f"u long, label string, v {dict(rows.dtypes)['v']}, copies long, pivots array<int>")


def pair_links(pairs: DataFrame, cosine: float, shared: int) -> DataFrame:
    """(a, b, n) of tile pairs: with b an edge of a forest of the links, without b the number n of a's links found there."""

    def columns(items: pa.Array) -> tuple[np.ndarray, ...]:
        n = len(items)
        return items.field("id").to_numpy(), items.field("copies").to_numpy(), items.field("v").flatten().to_numpy().reshape(n, -1), items.field("pivots").flatten().to_numpy().astype(np.int64).reshape(n, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges: list[tuple[int, int | None, int]] = []
            for i in range(batch.num_rows):
                same, number = batch.column(1)[i].as_py(), batch.column(batch.num_columns - 1)[i].as_py()
                id1, n1, a, p1 = columns(batch.column(2)[i].values)
                id2, n2, b, p2 = (id1, n1, a, p1) if same else columns(batch.column(3)[i].values)
                linked = tile_links(a, b, p1, p2, number, same, cosine, shared)
                if linked.any():
                    edges += [(x, y, 0) for x, y in link_forest(linked, id1, id2)]
                    for ids, n in ((id1, linked @ n2), (id2, n1 @ linked)):
                        edges += [(int(ids[k]), None, int(n[k])) for k in np.flatnonzero(n)]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in range(3)], names=["a", "b", "n"])

    return pairs.mapInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, prefix: int = PREFIX, shared: int = SHARED, pivots: int | None = None, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id) for each row of vectors (vec_id, embedding, label)."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"), F.col("label").cast("string").alias("label"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.coalesce(F.size("v"), F.lit(0)) > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumns({"sound": F.coalesce(sound, F.lit(False)), "v": F.transform("v", lambda x: x + F.lit(0.0).cast(kind[6:-1]))})  # -0.0 becomes 0.0
    rows = rows.withColumn("u", F.xxhash64("label", "v"))
    distinct = cut(rows.where("sound").groupBy("u", "label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    held = vectors.sparkSession.sparkContext.broadcast(fit_pivots(distinct, pivots))
    listed = cut(described(distinct, held, prefix)).select("label", F.size("v").alias("size"), F.explode("pivots").alias("pivot"), F.struct(F.col("u").alias("id"), "copies", "v", "pivots").alias("item"))
    found = cut(pair_links(tile_pairs(listed, ["label", "size", "pivot"], F.lit(tile)), cosine, shared))
    more = found.where("b is null").groupBy(F.col("a").alias("u")).agg(F.sum("n").alias("more"))
    of = components(found.where("b is not null").select("a", "b")).select(F.col("vertex").alias("u"), "component")
    known = cut(distinct.select("u", "id", "copies").join(more, "u", "left").join(of, "u", "left").select("u", "id", "copies", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "u").alias("c")))
    least = cut(known.groupBy("c").agg(F.min("id").alias("component_id"), F.count("*").alias("n")))
    named = cut(hot_join(known, least, ["c"], "n").select("u", "copies", "n_links", "component_id"))
    linked = hot_join(rows.where("sound").select("vec_id", "u"), named, ["u"], "copies").select("vec_id", "n_links", "component_id")
    return linked.unionAll(rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
