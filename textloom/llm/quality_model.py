"""Operator 4, quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on the statistics of labelled rows; every path from a root becomes a conjunctive rule; a
lasso logistic regression over rules and clipped linear terms keeps few of them; what it keeps is compiled into one Spark
column expression. Scoring is native and reads each whole text once.

Scale: statistics are computed once for all documents in one pass (no shuffle) and checkpointed as narrow rows. The fit
takes at most about `FIT_ROWS` labelled rows of each class, chosen by a seeded hash of the id and
weighted by the inverse of their class's share, so scores mean the same at every size; everything else covers all rows.

Defined cases: null text is an empty one and is scored as such; without labelled rows of both classes the score is the
share of the one class there is, or 0.5; an id with several label rows is good if one says so; null ids are never labelled and are not held out; an empty table gives no row;
repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import cut, table
from textloom.llm.stats import add_counts, add_ratios

FEATURES = ("n_words", "mean_word", "symbol_ratio", "stop_ratio", "bar_ratio", "upper_ratio", "loud_ratio", "mark_ratio", "digit_ratio", "kind_ratio", "dup_line_ratio", "repeat_ratio", "words_a_line")
FIT_ROWS, TREES, DEPTH, BINS, LASSO, CUTOFF = 8_000, 16, 3, 24, 2e-3, 0.3
SEED = 11

Rule = tuple[tuple[int, str, float], ...]


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids give null."""
    return F.crc32(key.cast("long").cast("string")) % modulus


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, __y): one row for each id; of several labels the largest counts."""
    rows = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("__y")).where("doc_id is not null and __y in (0, 1)")
    return rows.groupBy("doc_id").agg(F.max("__y").alias("__y"))


def shares(labelled: DataFrame, label: str, rows: int = FIT_ROWS) -> tuple[float, float]:
    """The sampling share of each class (label 0, 1) of labelled that leaves about rows rows of it at most."""
    counts = {r[0]: r[1] for r in labelled.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    return tuple(min(1.0, rows / max(1, counts.get(c, 1))) for c in (0, 1))


def sampled(labelled: DataFrame, label: str, share_of: tuple[float, float]) -> DataFrame:
    """The rows of labelled (doc_id, label) of both classes, each class by its share, by a seeded hash of doc_id."""
    share = F.when(F.col(label) == 1, F.lit(share_of[1])).otherwise(F.lit(share_of[0]))
    return labelled.where(F.col(label).isin(0, 1) & (F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) < share * (1 << 20)))


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], depth: int, least: int, path: Rule = ()) -> tuple[list[tuple[Rule, float, int]], object]:
    """(paths as (rule, gain, rows), tree) of one regression tree on gradients; a tree is a value or (feature, cut, low, high)."""
    value = -grad.sum() / (hess.sum() + 1.0)
    best = (1e-6, -1, 0.0)
    if depth and len(x) >= 2 * least:
        whole = grad.sum() ** 2 / (hess.sum() + 1.0)
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            slot = np.searchsorted(edges, x[:, f], side="left")  # x <= edges[k] iff slot <= k
            g, h, n = (np.bincount(slot, w, len(edges) + 1).cumsum()[:-1] for w in (grad, hess, np.ones(len(x))))
            gain = g * g / (h + 1.0) + (grad.sum() - g) ** 2 / (hess.sum() - h + 1.0) - whole
            gain[(n < least) | (len(x) - n < least)] = -1
            if gain.max() > best[0]:
                best = (float(gain.max()), f, float(edges[gain.argmax()]))
    gain, f, at = best
    if f < 0:
        return [], value
    low = x[:, f] <= at
    rules, sides = [], []
    for side, sign in ((low, "<="), (~low, ">")):
        own = (*path, (f, sign, at))
        more, tree = grow(x[side], grad[side], hess[side], cuts, depth - 1, least, own)
        rules += [(own, gain, int(side.sum())), *more]
        sides.append(tree)
    return rules, (f, at, *sides)


def predict(tree: object, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, at, low, high = tree
    return np.where(x[:, f] <= at, predict(low, x), predict(high, x))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, sign, at in rule:
        out &= x[:, f] <= at if sign == "<=" else x[:, f] > at
    return out


def lasso(a: np.ndarray, y: np.ndarray, strength: float, steps: int = 400, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with an L1 penalty, by accelerated proximal gradients. weight: of the rows."""
    n, k = a.shape
    weight = np.ones(n) if weight is None else weight / weight.mean()
    w, b, vw, vb, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    rate = 4.0 * n / (np.linalg.norm(a * np.sqrt(weight)[:, None], 2) ** 2 + n)
    for _ in range(steps):
        r = weight * (1 / (1 + np.exp(-(a @ vw + vb))) - y)
        nw = vw - rate * (a.T @ r) / n
        nw, nb = np.sign(nw) * np.maximum(np.abs(nw) - rate * strength, 0), vb - rate * r.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, strength: float = LASSO, weight: np.ndarray | None = None) -> dict:
    """The ensemble: bias, rules with weights, and linear terms (feature, low, high, scale, weight). weight: of the rows."""
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        return {"bias": float(np.log(p / (1 - p))), "rules": [], "linear": []}
    rng = np.random.default_rng(SEED)
    weight = np.ones(len(y)) if weight is None else weight / weight.mean()
    how = {} if (weight == weight[0]).all() else {"method": "inverted_cdf", "weights": weight}
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], **how)) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    score, found = np.full(len(y), np.log((weight * y).sum() / (weight * (1 - y)).sum())), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        part = rng.random(len(y)) < 0.6
        paths, tree = grow(x[part], (weight * (p - y))[part], (weight * (p * (1 - p) + 1e-6))[part], cuts, depth, max(5, len(y) // 400))
        score = score + 0.3 * predict(tree, x)
        for rule, gain, _ in paths:
            rule = tuple(sorted(rule))
            found[rule] = max(gain, found.get(rule, 0.0))
    rules = sorted(found, key=lambda r: (-found[r], r))[:300]
    lo, hi = (np.array([np.quantile(x[:, f], q, **how) for f in range(x.shape[1])]) for q in (0.025, 0.975))
    wide = np.flatnonzero(hi > lo)
    spread = lambda v: np.sqrt(np.average((v - np.average(v, weights=weight)) ** 2, weights=weight))
    scale = np.array([max(spread(np.clip(x[:, f], lo[f], hi[f])), 1e-9) / 0.4 for f in wide])
    linear = np.clip(x[:, wide], lo[wide], hi[wide]) / scale - (lo[wide] + hi[wide]) / 2 / scale
    a = np.column_stack([linear, *[holds(r, x).astype(np.float64) for r in rules]])
    w, b = lasso(a, y.astype(np.float64), strength, weight=weight)
    m = len(wide)
    return {"bias": float(b), "rules": [(r, float(v)) for r, v in zip(rules, w[m:], strict=True) if abs(v) > 1e-6], "linear": [(int(f), float(lo[f]), float(hi[f]), float(s), float(v)) for f, s, v in zip(wide, scale, w[:m], strict=True) if abs(v) > 1e-6]}


def compile_score(model: dict, features: tuple[str, ...] = FEATURES) -> Column:
    """The model as one native column, between 0 and 1."""
    total = [repr(model["bias"]) + "D"]
    for f, lo, hi, s, v in model["linear"]:
        total.append(f"{v!r}D * (least(greatest({features[f]}, {lo!r}D), {hi!r}D) - {(lo + hi) / 2!r}D) / {s!r}D")
    for rule, v in model["rules"]:
        total.append(f"case when {' and '.join(f'{features[f]} {sign} {at!r}D' for f, sign, at in rule)} then {v!r}D else 0D end")
    return F.expr(f"1D / (1D + exp(-({' + '.join(f'({t})' for t in total)})))")


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, FEATURES) of each row of docs, checkpointed."""
    text = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    return cut(add_ratios(add_counts(text)).select("doc_id", *[F.col(f).cast("double") for f in FEATURES]))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: Column | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score) of each row of docs; labels (doc_id, label) are learnt where held_out, a column over doc_id, is false."""
    held_out = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    stats = statistics(docs)
    known = one_label(labels, label).where(~held_out)
    learnt = sampled(known, "__y", share := shares(known, "__y", fit_rows))
    rows = stats.join(learnt, "doc_id").select("__y", *FEATURES).orderBy("__y", *FEATURES).collect()
    data = np.array([list(r) for r in rows], np.float64).reshape(-1, 1 + len(FEATURES))
    model = fit(data[:, 1:], data[:, 0], weight=np.where(data[:, 0] == 1, 1 / share[1], 1 / share[0]))
    return stats.select("doc_id", held_out.alias("held_out"), compile_score(model).alias("score"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=remainder(F.col("doc_id"), 5) == 0)
    return found.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))
