"""Near copies of the pipeline's stage against brute force."""

import ctypes
import random
import re
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest

import corpus_pipeline
from textloom.llm import near_copies

rng = random.Random(9)
WORDS = [f"{a}{b}" for a in "ka lo mi nu pe ra so tu ve wi".split() for b in "ra te li mo du".split()]


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def texts():
    out = ["", " ", "one two", "One TWO", "one two three"]
    for _ in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.randint(40, 120))]
        out.append(" ".join(base))
        for changes in (1, 2, 3, 4):
            near = list(base)
            for i in rng.sample(range(len(near)), changes):
                near[i] = rng.choice(WORDS)
            out.append(" ".join(near))
    common = " ".join(rng.choice(WORDS) for _ in range(20))
    return out + [common + " " + " ".join(rng.choice(WORDS) for _ in range(30)) for _ in range(30)] + out[5:9]


@pytest.mark.parametrize(("tile", "shingles"), [(near_copies.TILE, near_copies.TILE_SHINGLES), (7, 400)])
def test_stage_links_are_the_pairs_at_the_similarity(spark, monkeypatch, tile, shingles):
    monkeypatch.setattr(near_copies, "TILE_SHINGLES", shingles)
    held = texts()
    up = list(range(len(held)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(held)):
        for j in range(i):
            if jaccard(held[i], held[j]) >= 0.8:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    df = spark.createDataFrame(list(enumerate(held)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(df, tile=tile).collect()} == {i: root(i) for i in range(len(held))}
    stage = dict(corpus_pipeline.STAGES)["simhash"]
    assert sorted(r.doc_id for r in stage(spark, df, "").collect()) == sorted({root(i) for i in range(len(held))})


def test_a_large_group_of_near_copies_is_one_component(spark):
    """Copies that are each near the first text, but not near each other."""
    base = [rng.choice(WORDS) for _ in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1500):
        near = list(base)
        for k in rng.sample(range(100), 2):
            near[k] = f"x{rng.random()}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(rng.choice(WORDS) for _ in range(100))) for i in range(1500, 1600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(df, tile=600).collect()}
    up = {i: i for i in range(1600)}
    for i in range(1, 1500):
        up[i] = 0 if jaccard(rows[0][1], rows[i][1]) >= 0.8 else i
    assert all(got[i] == 0 for i in up if up[i] == 0) and all(got[i] == i for i in range(1500, 1600))


def test_shared_counts_by_products_are_those_of_the_sets():
    import numpy as np

    g = np.random.default_rng(1)
    sets = [np.unique(g.integers(0, 300, 200).astype(np.uint64)) for _ in range(40)] + [np.zeros(0, np.uint64)]
    held = near_copies.Sets(sets)
    rows, cols = np.arange(20), np.arange(20, 41)
    block = held.similar_block(rows, cols)
    assert all(block[a, b] == held.similar(int(i), int(j)) for a, i in enumerate(rows) for b, j in enumerate(cols))


def test_a_worker_holds_few_texts_of_a_batch_at_once(spark):
    class Rows:
        """Stands for a frame; gives the function that its batches go through."""

        select = lambda self, *columns: self
        mapInArrow = lambda self, run, schema: run

    held = [" ".join(rng.choice(WORDS) for _ in range(400)) for _ in range(100)]
    whole = pa.RecordBatch.from_pydict({"doc_id": range(3000), "text_hash": range(3000), "text": [f"{i} {held[i % 100]}" for i in range(3000)]})
    run = near_copies.fingerprints(Rows())
    tracemalloc.start()
    got = [(x["doc_id"], x["n"]) for batch in run(iter([whole])) for x in batch.select(["doc_id", "n"]).to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x for x, _ in got] == list(range(3000)) and all(390 < n <= 397 for _, n in got)
    assert most < 6e6  # the texts alone are 4 MB, their shingle sets 10 MB


def test_no_task_has_two_python_workers(spark, monkeypatch):
    """What takes a Python worker does not read from what takes another in the same stage."""
    plans = []

    def contracted(edges):
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return components(edges)

    components = near_copies.components
    monkeypatch.setattr(near_copies, "components", contracted)
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    assert near_copies.keep_one(df).count() > 0
    assert len(plans) == 1 and "MapInArrow" not in plans[0]


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="only glibc gives free memory back on demand")
def test_a_worker_gives_back_what_a_task_freed():
    size = lambda: int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024
    last = []

    def run(batches):
        held = [bytes([i % 256]) * 2000 for i in range(100_000)]
        last.append(held[-1])  # stays above the freed 200 MB
        del held
        yield from batches

    before = size()
    assert list(near_copies.given_back(run)(iter([1, 2]))) == [1, 2]
    assert size() - before < 60
