"""Verdicts on very long texts."""

import numpy as np

from textloom.llm import quality_rules


def test_a_long_clean_text_keeps_its_place(spark):
    g = np.random.default_rng(1)
    words = [f"w{r}" if i % 4 else "the" for i, r in enumerate(g.integers(0, 40_000, 400_000))]
    few = [f"w{r}" if i % 4 else "the" for i, r in enumerate(g.integers(0, 300, 20_000))]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(few))], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.reason) for r in quality_rules.judge(df).collect()}
    assert got[1] == (400_000, None) and len(set(words)) < 0.25 * 400_000
    assert got[2][1] == "different_words"
