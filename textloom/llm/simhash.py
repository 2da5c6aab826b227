"""Operator 8, SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit majorities over the XXH64 values of word shingles. Distinct fingerprints are put into tiles by the
population counts of their parts (four 16-bit quarters). The Hamming distance of two fingerprints is at least the sum of the
differences of these counts, so a tile pair whose sum exceeds the radius is skipped; all others are compared exactly with
numpy exclusive-or and bit counts. No candidate is lost and there is no cap.

Scale: identical fingerprints are one row before any comparison; a tile holds about `TILE` fingerprints, crowded count
vectors are split over several tiles by hash; each tile meets at most 65 neighbouring count vectors. Tile pairs are dealt
over the tasks one by one, so a crowded count vector makes many tasks. A tile pair returns a spanning forest of its links.
Fingerprints that many rows share are joined back without a shuffle of those rows.

Defined cases: null text is an empty one, with fingerprint zero; a null doc_id takes part but is never a component_id
while another id is in its component (else null); repeated rows each give a row; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import cut, hot_join, table, tile_pairs, utf8_lists
from textloom.llm.graph import components

RADIUS, SHINGLE, SEED, TILE, PARTS = 3, 3, 42, 16_384, 4
#: Fingerprints of a tile that are compared at once.
BLOCK_PRINTS = 2048
#: Shingle hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a UTF-8 text: a bit is 1 if set in over half of its shingles' hashes; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    begin, end = np.concatenate([[0], stops[: n - 1]]).tolist(), (stops[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(begin[lo : lo + BLOCK], end[lo : lo + BLOCK], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("__hash")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): fp holds the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, hashes, texts in utf8_lists(batches):
            fp = np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([key, hashes, pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_hash(), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def link_forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect what the links (left x right) connect, at most one for each row and column."""
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    m, nr = linked[np.ix_(rows, cols)], len(rows)
    of_row, of_col, ids, big = np.arange(nr), np.arange(nr, nr + len(cols)), np.concatenate([left[rows], right[cols]]), nr + len(cols)
    while True:
        new_col = np.minimum(of_col, np.where(m, of_row[:, None], big).min(axis=0))
        new_row = np.minimum(of_row, np.where(m, new_col[None, :], big).min(axis=1))
        if (new_col == of_col).all() and (new_row == of_row).all():
            break
        of_row, of_col = new_row, new_col
    for i, top in enumerate(np.concatenate([of_row, of_col]).tolist()):
        if ids[i] != ids[top]:
            yield int(ids[i]), int(ids[top])


def compare(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which of a x b differ in at most radius bits."""
    out = np.empty((len(a), len(b)), bool)
    for lo in range(0, len(a), 128):
        out[lo : lo + 128] = np.bitwise_count(a[lo : lo + 128, None] ^ b[None, :]) <= radius
    return out


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) whose components are those of all links within radius."""
    width = 64 // parts
    counts = [F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND((1 << width) - 1)) for i in range(parts)]
    # a base above any count and twice the radius, and a bias, keep neighbours' keys apart without carries
    base, bias = width + 3 * radius + 1, radius
    key = sum(((c + bias) * base**i for i, c in enumerate(counts)), F.lit(0)).cast("int")
    near = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    steps = sorted({s for d in near if (s := sum(x * base**i for i, x in enumerate(d))) >= 0})
    items = distinct.select(key.alias("key"), F.struct(F.col("fp").alias("id")).alias("item"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                a = left[i].values.field("id").to_numpy()
                b = a if batch.column(1)[i].as_py() else right[i].values.field("id").to_numpy()
                for lo in range(0, len(a), BLOCK_PRINTS):
                    for at in range(0, len(b), BLOCK_PRINTS):
                        x, y = a[lo : lo + BLOCK_PRINTS], b[at : at + BLOCK_PRINTS]
                        linked = compare(x.view(np.uint64), y.view(np.uint64), radius)
                        if linked.any():
                            found += link_forest(linked, x, y)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return tile_pairs(items, ["key"], F.lit(tile), steps).mapInArrow(run, "a long, b long")


def classes(prints: DataFrame, radius: int = RADIUS, tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """(fp, copies, component_id) of the distinct fingerprints of prints (doc_id, fp): the smallest doc_id reachable by links."""
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    of = components(links(distinct, radius, tile, parts)).withColumnRenamed("vertex", "fp")
    joined = cut(distinct.join(of, "fp", "left").select("fp", "least", "copies", F.coalesce("component", "fp").alias("component")))
    least = cut(joined.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    return cut(hot_join(joined, least, ["component"], "n").select("fp", "copies", "component_id"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile: int = TILE, parts: int = PARTS) -> DataFrame:
    """(doc_id, fp, component_id, text_hash) for each row of docs (doc_id, text)."""
    prints = cut(fingerprints(docs, shingle))
    return hot_join(prints, classes(prints, radius, tile, parts), ["fp"], "copies").select("doc_id", "fp", "component_id", "text_hash")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
