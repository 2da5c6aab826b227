"""Near copies for the pipeline: SimHash tiles find the candidates, exact Jaccard similarity decides.

Operator 8's tiled exact comparison, with `WORDS` 64-bit words a fingerprint over five-word shingles and a radius wide enough for
a similarity of `JACCARD`: at 0.8 a bit differs with a chance of at most 0.15 (0.19 for texts of four or five shingles), so 256
bits differ in about 39 (48) with a spread of 6, and unrelated texts in 128 with a spread of 8. `RADIUS` lies between: a pair at
0.8 is missed about once in 100,000 (once in 1,000 for those short texts). Every candidate pair is then verified on the two
texts' whole shingle sets, so no pair below the similarity is a link.

Tiles hold texts of one size class; two texts can only be that similar if their numbers of shingles differ by less than a
fifth, so tiles of other sizes are never paired, and within a pair blocks are skipped whose sizes or population counts differ
too much.

Scale: texts with equal shingle sets are one row before any comparison. The comparison names, for each tile pair, the texts
that have a candidate in it; only their shingle sets are computed, and are verified again by tile pairs, with the closest
pairs first and without those that are connected already: no candidate pair is ever a row. A tile holds at most
`TILE` texts and about `TILE_SHINGLES` shingles. Comparison is quadratic in different texts of like size, as its method is.

Memory: Python workers stay beside the executor's heap for the stages that follow, with what they once took. So no task has two
workers, a worker holds `TEXTS` texts and their shingle sets at a time, not Spark's whole batch, and it gives back what a task freed.

Defined cases: texts without words are copies of each other; up to five words are one shingle; case is folded for ASCII;
null text is empty; rows without a doc_id stay. Shingles are equal when their 64-bit hashes are.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import cut, grouped, hot_join, tile_pairs, utf8_lists
from textloom.llm.graph import components
from textloom.llm.simhash import text_hash

SHINGLE, WORDS, RADIUS, CLOSE, CACHE_WORDS = 5, 4, 68, 44, 500_000
#: The similarity of a link, as a fraction.
JACCARD = (4, 5)
#: Texts of a tile and their shingles; texts compared at once; width of a size class.
TILE, TILE_SHINGLES, BLOCK, CLASS = 8192, 1 << 22, 256, 1.05
#: Texts whose shingle sets a worker computes at once.
TEXTS = 256
#: Odd multipliers that give a shingle's hash further words (the golden ratio and two of a common mixer).
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(h: np.ndarray, rounds: int) -> np.ndarray:
    """Another 64-bit hash for each hash."""
    for k in range(rounds):
        h = (h ^ (h >> np.uint64(30))) * MIX[k % 3]
    return h ^ (h >> np.uint64(31))


Mapped = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def given_back(run: Mapped) -> Mapped:
    """run, after which the worker's free memory goes back to the system (C's part of it where the C library can)."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(ctypes.c_size_t(0))

    return out


def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most TEXTS."""
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXTS):
            yield batch.slice(lo, TEXTS)


class Shingles:
    """Sorted different 64-bit hashes of the shingles of a UTF-8 text."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.known = size, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        known = self.known
        if len(known) >= CACHE_WORDS:
            known.clear()
        for x in words:
            if x not in known:
                known[x] = xxhash.xxh64_intdigest(x, 42)
        w = np.fromiter((known[x] for x in words), np.uint64, len(words))
        n = max(min(1, len(w)), len(w) - self.size + 1)
        h = np.full(n, min(len(w), self.size), np.uint64)
        for k in range(min(self.size, len(w))):
            h = mixed((h ^ w[k : k + n]) * MIX[0], 1)
        return np.unique(h)


def fingerprint(h: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Majority bits of a text's different shingle hashes: words 64-bit words; none: zero."""
    ones = np.zeros((words, 64), np.int64)
    for lo in range(0, len(h), 1 << 14):
        part = h[lo : lo + (1 << 14)]
        for k in range(words):
            bits = np.unpackbits(mixed(part, k + 1).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[k] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(h), axis=1, bitorder="little").view("<u8").ravel()


def least_shared(a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | int:
    """Shingles that texts of a and b shingles share at least if they are that similar."""
    p, q = JACCARD
    return -(-p * (a + b) // (p + q))


FP = [f"f{k}" for k in range(WORDS)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, set_id, n, f0...): set_id is a hash of the text's n different shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingles()
        for key, hashes, texts in utf8_lists(few(batches)):
            sets = [of(x) for x in texts]
            ids = np.array([xxhash.xxh64_intdigest(h.tobytes(), 42) for h in sets], np.uint64).view(np.int64)
            prints = np.array([fingerprint(h) for h in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([key, hashes, pa.array(ids), pa.array(map(len, sets), pa.int64()), *map(pa.array, prints.T)], names=["doc_id", "text_hash", "set_id", "n", *FP])

    kinds = ", ".join(f"{f} long" for f in FP)
    return docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), F.col("text").cast("string")).mapInArrow(given_back(run), f"doc_id long, text_hash long, set_id long, n long, {kinds}")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of a x b (rows of 64-bit words)."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for k in range(a.shape[1]):
        out += np.bitwise_count(a[:, None, k] ^ b[None, :, k])
    return out


def near_blocks(n1: np.ndarray, f1: np.ndarray, n2: np.ndarray, f2: np.ndarray, radius: int, same: bool) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Blocks of two lists sorted by size: rows, columns, and the differing bits, above radius where a pair is no candidate.

    Blocks whose sizes rule out the similarity, or whose population counts differ by more than radius, are skipped."""
    p, q = JACCARD
    pop1, pop2 = np.bitwise_count(f1).sum(axis=1, dtype=np.int64), np.bitwise_count(f2).sum(axis=1, dtype=np.int64)
    for lo in range(0, len(n1), BLOCK):
        rows = slice(lo, min(lo + BLOCK, len(n1)))
        first = np.searchsorted(n2, -(-p * n1[rows][0] // q), side="left")
        last = np.searchsorted(n2, n1[rows][-1] * q // p, side="right")
        for at in range(max(first, lo if same else 0), last, 4 * BLOCK):
            cols = slice(at, min(at + 4 * BLOCK, last))
            x, y = pop1[rows], pop2[cols]
            if max(x.min() - y.max(), y.min() - x.max()) > radius:
                continue
            d = distances(f1[rows], f2[cols])
            if same:
                d[np.arange(at, cols.stop)[None, :] <= np.arange(lo, rows.stop)[:, None]] = 999
            if (d <= radius).any():
                yield rows, cols, d


def columns(items: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, sizes and fingerprints of items, by size."""
    ids, n = (items.field(c).to_numpy() for c in ("id", "n"))
    f = np.column_stack([items.field(c).to_numpy().view(np.uint64) for c in FP])
    order = np.lexsort((ids, n))
    return ids[order], n[order], f[order]


def involved(pairs: DataFrame, radius: int) -> DataFrame:
    """(pair, side, id): the texts that have a candidate in a tile pair; side 1 left, 2 right, 3 both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                same = batch.column(1)[i].as_py()
                ids1, n1, f1 = columns(batch.column(2)[i].values)
                ids2, n2, f2 = (ids1, n1, f1) if same else columns(batch.column(3)[i].values)
                left, right = np.zeros(len(n1), bool), np.zeros(len(n2), bool)
                for rows, cols, d in near_blocks(n1, f1, n2, f2, radius, same):
                    left[rows] |= (d <= radius).any(axis=1)
                    right[cols] |= (d <= radius).any(axis=0)
                if same:
                    ids, side = ids1[left | right], (left + 2 * right)[left | right]
                else:
                    ids, side = np.concatenate([ids1[left], ids2[right]]), np.repeat([1, 2], [left.sum(), right.sum()])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), batch.column(0)[i].as_py(), np.int64)), pa.array(side.astype(np.int64)), pa.array(ids)], names=["pair", "side", "id"])

    return pairs.mapInArrow(given_back(run), "pair long, side long, id long")


class Sets:
    """The shingle sets of a tile pair, for counting what two texts share."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.n = sets, np.array([len(s) for s in sets], np.int64)

    def similar(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        return int((b[at] == a).sum()) >= least_shared(len(a), len(b))

    def similar_block(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """similar() of rows x cols, by products of their 0-1 matrices in slices of the shingles that both sides hold."""
        left, right = (np.concatenate([self.sets[i] for i in side]) for side in (rows, cols))
        both = np.intersect1d(left, right)
        shared = np.zeros((len(rows), len(cols)), np.float32)
        marks = []
        for side, flat in ((rows, left), (cols, right)):
            of = np.repeat(np.arange(len(side)), self.n[side])
            at = np.searchsorted(both, flat)
            at[at == len(both)] = 0
            held = both[at] == flat if len(both) else np.zeros(len(flat), bool)
            marks.append((of[held], at[held]))
        for lo in range(0, len(both), 8192):
            hot = []
            for side, (of, at) in zip((rows, cols), marks, strict=True):
                m = np.zeros((len(side), min(8192, len(both) - lo)), np.float32)
                part = (at >= lo) & (at < lo + 8192)
                m[of[part], at[part] - lo] = 1
                hot.append(m)
            shared += hot[0] @ hot[1].T
        return shared >= least_shared(self.n[rows][:, None], self.n[cols][None, :])


def verified(ids: np.ndarray, sets: list[np.ndarray], f: np.ndarray, side: np.ndarray, radius: int, close: int = CLOSE) -> list[tuple[int, int]]:
    """Edges (a, b) that connect what the similar candidates of left x right connect. Close candidates come first; pairs that are connected are not verified again."""
    held = Sets(sets)
    order = np.lexsort((ids, held.n))
    left, right = order[side[order] & 1 > 0], order[side[order] & 2 > 0]
    same = bool((side == 3).any())
    up = np.arange(len(ids))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = int(up[x])
        return x

    def tops(some: np.ndarray) -> np.ndarray:
        return np.array([root(int(x)) for x in some])

    for upto in (close, radius):
        for rows, cols, d in near_blocks(held.n[left], f[left], held.n[right], f[right], upto, False):
            i, j = left[rows], right[cols]
            open_ = (d <= upto) & (tops(i)[:, None] != tops(j)[None, :])
            if same:
                open_ &= ids[i][:, None] != ids[j][None, :]
            for lo in range(0, len(j), BLOCK):
                part = open_[:, lo : lo + BLOCK]
                at = np.argwhere(part)
                if len(at) > 200:
                    use_i, use_j = np.flatnonzero(part.any(axis=1)), np.flatnonzero(part.any(axis=0))
                    good = held.similar_block(i[use_i], j[lo + use_j]) & part[np.ix_(use_i, use_j)]
                    at = [(use_i[a], use_j[b]) for a, b in np.argwhere(good)]
                    test = lambda x, y: True
                else:
                    test = held.similar
                for a, b in at:
                    x, y = root(int(i[a])), root(int(j[lo + b]))
                    if x != y and test(int(i[a]), int(j[lo + b])):
                        up[max(x, y)] = min(x, y)
    return [(int(ids[x]), int(ids[top])) for x in range(len(ids)) if (top := root(x)) != x]


def links(keys: DataFrame, docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) of set ids that connect what all pairs at the similarity connect. keys: (set_id, n, f0..., pick)."""
    items = keys.where("n > 0").select(F.floor(F.log(F.col("n").cast("double")) / float(np.log(CLASS))).cast("int").alias("key"), F.struct(F.col("set_id").alias("id"), "n", *FP).alias("item"))
    steps = list(range(int(np.log(JACCARD[1] / JACCARD[0]) / np.log(CLASS)) + 2))
    size = F.pow(F.lit(CLASS), F.col("key") + 1)
    pairs = tile_pairs(items, ["key"], F.greatest(F.lit(1.0), F.least(F.lit(float(tile)), TILE_SHINGLES / size)), steps)
    found = cut(involved(pairs, radius))
    wanted = cut(found.select(F.col("id").alias("set_id")).distinct().join(keys, "set_id").select("set_id", "pick", *FP))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingles()
        for *key, texts in utf8_lists(few(batches)):
            for i, x in enumerate(texts):
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in key), pa.array([of(x).view(np.int64)], pa.list_(pa.int64()))], names=["id", *FP, "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "pair"):
            flat = rows["shingles"].chunk(0)
            ids, side = (rows[c].to_numpy() for c in ("id", "side"))
            f = np.column_stack([rows[c].to_numpy().view(np.uint64) for c in FP])
            edges = verified(ids, [flat[i].values.to_numpy().view(np.uint64) for i in range(len(flat))], f, side, radius)
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    texts = docs.select(row_key().alias("pick"), F.col("text").cast("string")).join(wanted, "pick").select("set_id", *FP, "text")
    kinds = ", ".join(f"{f} long" for f in FP)
    of = cut(texts.mapInArrow(given_back(sets), f"id long, {kinds}, shingles array<long>").dropDuplicates(["id"]))
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, min(20_000, found.select("pair").distinct().count() // 32))
    both = found.join(of, "id").repartition(parts, "pair").sortWithinPartitions("pair")
    # computed here: contracting them in the same task would take a second Python worker
    return cut(both.select("pair", "side", "id", *FP, "shingles").mapInArrow(given_back(run), "a long, b long"))


def row_key() -> Column:
    """A key of a row's id and text; equal rows share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_hash())


def set_classes(docs: DataFrame, prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(set_id, copies, component, first): component is a set id; first (doc_id, text_hash) is the smallest of the set's rows with an id."""
    row = F.struct("doc_id", "text_hash")
    keys = cut(prints.groupBy("set_id").agg(F.first("n").alias("n"), *[F.first(f).alias(f) for f in FP], F.min(row).alias("__row"), F.min(F.when(F.col("doc_id").isNotNull(), row)).alias("first"), F.count("*").alias("copies")).withColumn("pick", F.xxhash64("__row.doc_id", "__row.text_hash")))
    of = components(links(keys, docs, radius, tile)).withColumnRenamed("vertex", "set_id")
    return cut(keys.join(of, "set_id", "left").select("set_id", "copies", "first", F.coalesce("component", "set_id").alias("component")))


def near_copies(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, text_hash, component_id) for each row of docs (doc_id, text): the smallest doc_id reachable by links."""
    prints = cut(fingerprints(docs))
    sets = set_classes(docs, prints, radius, tile)
    least = sets.groupBy("component").agg(F.min("first.doc_id").alias("component_id"), F.count("*").alias("n"))
    named = cut(hot_join(sets.select("component", "set_id", "copies"), cut(least), ["component"], "n").select("set_id", "copies", "component_id"))
    return hot_join(prints.select("doc_id", "text_hash", "set_id"), named, ["set_id"], "copies").select("doc_id", "text_hash", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The rows of docs without near copies: of each component the row with its smallest doc_id stays, unchanged.

    Of several rows with that id the one with the smallest text hash stays; rows without a doc_id stay."""
    sets = set_classes(docs, cut(fingerprints(docs)), radius, tile)
    keys = sets.groupBy("component").agg(F.min("first").alias("f")).where("f is not null").select(F.col("f.doc_id").alias("__id"), F.col("f.text_hash").alias("__hash"))
    keyed = docs.where("doc_id is not null").withColumns({"__id": F.col("doc_id").cast("long"), "__hash": text_hash()})
    one = Window.partitionBy("__id", "__hash").orderBy("__id")
    kept = keyed.join(keys.distinct(), ["__id", "__hash"]).withColumn("__n", F.row_number().over(one)).where("__n = 1")
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))
