"""Embedding near-duplicates against brute force."""

from collections import Counter

import numpy as np
import pytest

from textloom.llm import embeddings
from textloom.llm.queries import QUERIES

BAD = [[0.0] * 8, None, [float("nan")] * 8, [None] + [1.0] * 7, [], [float("inf")] + [1.0] * 7]


def sample():
    """(vec_id, embedding, label): groups of near vectors, a dense group, other lengths, copies, odd rows."""
    g = np.random.default_rng(0)
    v = np.repeat(g.normal(size=(40, 8)), 5, axis=0) + 0.05 * g.normal(size=(200, 8))
    dense = g.normal(size=8) + 0.15 * g.normal(size=(150, 8))
    rows = [(x.tolist(), str(i // 5 % 3)) for i, x in enumerate(v)] + [(x.tolist(), "1") for x in dense]
    rows += [((2 * v[5]).tolist(), "1"), (v[0].tolist(), "0"), (v[0].tolist(), "0"), (v[0].tolist(), None), (v[0].tolist(), "1")]
    rows += [([1.0, 2.0], "0"), ([2.0, 4.0], "0"), ([1.0, -2.0], "0"), ([1e300, 2e300], "0"), ([-0.0, 1.0], "0"), ([0.0, 1.0], "0"), ([3.0], "0"), ([5.0], "0"), ([-5.0], "0")]
    rows += [([1.0, 0.0, 0.0, 0.0], "0"), ([49.0, 9.0, 3.0, 3.0], "0")]  # a cosine of 49 / 50
    rows += [(x, "0") for x in BAD]
    return [(i, *r) for i, r in enumerate(rows)] + [(None, v[0].tolist(), "0"), (7, v[9].tolist(), "1")]


def brute(rows):
    sound = [k for k, (i, x, y) in enumerate(rows) if i is not None and y is not None and x and None not in x and np.isfinite(np.array(x)).all() and any(x)]
    unit = {k: np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in sound}
    linked = lambda a, b: rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and (unit[a] @ unit[b] / np.sqrt(unit[a] @ unit[a]) / np.sqrt(unit[b] @ unit[b])) >= 0.98 - 1e-13
    up, n = {k: k for k in sound}, Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sound:
        for b in sound:
            if a < b and linked(a, b):
                n[a] += 1
                n[b] += 1
                up[root(a)] = root(b)
    least = {}
    for k in sound:
        least[root(k)] = min(rows[k][0], least.get(root(k), rows[k][0]))
    return Counter((r[0], n[k], least[root(k)]) if k in up else (r[0], 0, r[0]) for k, r in enumerate(rows))


@pytest.mark.parametrize("tile", [embeddings.TILE, 16])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_are_those_of_brute_force(spark, kind, tile):
    rows = sample()
    if kind == "float":
        rows = [(i, None if x is None else [None if c is None else float(np.float32(min(c, 1e30))) if c == c and c != float("inf") else c for c in x], y) for i, x, y in rows]
    half = len(rows) // 2
    make = lambda part: spark.createDataFrame(part, f"vec_id long, embedding array<{kind}>, label string")
    df = make(rows[:half]).unionAll(make(rows[half:]))
    got = embeddings.near_duplicates(df, tile=tile).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def test_one_vector_of_another_length_changes_nothing(spark):
    rows = [(i, [1.0 + i / 1e4, 2.0, 3.0], "a") for i in range(12)]
    for k in range(3):
        df = spark.createDataFrame([*rows, (99, [float(k), 1.0], "a")], "vec_id long, embedding array<float>, label string")
        got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df).collect()}
        assert got == {i: 11 for i in range(12)} | {99: 0}


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert QUERIES["op9_embeddings"](spark, str(tmp_path)).count() == 0


def test_thinned_pivots_are_apart():
    g = np.random.default_rng(2)
    v = embeddings.unit(np.concatenate([g.normal(size=(400, 6)), g.normal(size=6) + 0.01 * g.normal(size=(400, 6))]))
    kept = embeddings.thinned(v, 0.95)
    near = kept @ kept.T - np.eye(len(kept))
    assert near.max() < 0.95 and ((v @ kept.T).max(axis=1) >= 0.95).all()
