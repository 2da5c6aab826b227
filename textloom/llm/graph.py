"""Connected components of an edge table, by star contraction with reliable checkpoints.

Every round works on two-column rows, aggregates with min (combined before the shuffle) and joins with hot keys broadcast, so
no vertex's neighbours are ever gathered in one place. Before the rounds each task contracts the edges
it holds to a spanning forest of them, in bounded batches. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import cut, hot_join

#: Edges that a task holds at once while it contracts them.
BATCH_EDGES = 1_000_000


def forest(pairs: list[tuple[int, int]] | Iterator[tuple[int, int]]) -> dict[int, int]:
    """vertex -> smallest vertex of its tree, by union-find; roots map to themselves."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (y := up.setdefault(top, top)) != top:
            top = y
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def contract(edges: DataFrame) -> DataFrame:
    """The same components by fewer edges (a > b): stars of what each task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []

        def flush() -> pa.RecordBatch:
            rows = [(x, top) for x, top in forest(held).items() if x != top]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            if len(held) >= BATCH_EDGES:
                yield flush()
        yield flush()

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(vertex, component): the smallest vertex that each vertex of edges (a, b) can reach. Vertices without an edge have no row."""
    edges = cut(contract(edges))
    for _ in range(rounds):
        if edges.isEmpty():
            break
        # large star: each vertex's larger neighbours are tied to the smallest of its neighbourhood
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count_if(F.col("b") > F.col("a")).alias("n")))
        large = hot_join(both.where("b > a"), least, ["a"], "n").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a vertex and its smaller neighbours are tied to the smallest of them
        down = cut(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        low = cut(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        small = hot_join(down, low, ["a"], "n").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        edges, last = cut(small), edges
        # done once all edges are stars: no vertex has both a parent and a child, nor two parents
        roots = edges.select(F.col("b").alias("a")).distinct()
        done = edges.count() == last.count() and edges.join(roots, "a", "left_semi").isEmpty() and edges.groupBy("a").count().where("count > 1").isEmpty()
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())
