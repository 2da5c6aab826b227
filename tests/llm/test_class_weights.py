"""Scores that mean the same at every size of the labels."""

import numpy as np

from textloom.llm import quality_model, toxicity


def test_weights_undo_the_sampling_of_a_class():
    g = np.random.default_rng(4)
    y = (g.uniform(size=40_000) < 0.05).astype(float)
    x = np.column_stack([g.normal(size=len(y)) + 1.5 * y, g.normal(size=len(y))])
    part = (y == 1) | (g.uniform(size=len(y)) < 0.1)
    weight = np.where(y[part] == 1, 1.0, 10.0)

    def mean_score(model):
        z = model["bias"] + sum(v * quality_model.holds(r, x) for r, v in model["rules"])
        for f, lo, hi, s, v in model["linear"]:
            z = z + v * (np.clip(x[:, f], lo, hi) - (lo + hi) / 2) / s
        return (1 / (1 + np.exp(-z))).mean()

    assert mean_score(quality_model.fit(x[part], y[part])) > 0.2
    assert abs(mean_score(quality_model.fit(x[part], y[part], weight=weight)) - 0.05) < 0.01
    a = x[:, :1]
    (w, b), (v, c) = quality_model.lasso(a, y, 1e-4), quality_model.lasso(a[part], y[part], 1e-4, weight=weight)
    assert abs(w[0] - v[0]) < 0.2 and abs(b - c) < 0.2


def test_toxicity_scores_keep_their_level_when_the_clean_class_is_sampled(spark):
    rows = [(i, f"river stone w{i % 97} " + ("scum" if i % 10 == 0 and i % 30 or i % 15 == 1 else "cloud") + " garden", int(i % 10 == 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    level = lambda n: np.mean([r.score for r in toxicity.score(df, df, fit_rows=n).collect()])
    assert abs(level(4000) - 0.1) < 0.02 and abs(level(300) - 0.1) < 0.03
