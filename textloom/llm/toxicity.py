"""Operator 6, toxicity by noisy-channel deobfuscation.

Words that may be disguised (leetspeak, separators or repeated letters inside a word, words spelt with spaces) become
character lattices; Viterbi decoding under a character trigram model, counted over all documents, restores them. The
restored words are scored with log-odds of words and word beginnings that toxic documents of the labelled rows use, and a
logistic regression on a document's evidence gives the score. Words that the channel cannot change are their own decoding.

Scale: the character counts are one bounded table (28**3 numbers) summed by Spark over all documents; texts are never
shuffled. A label counts once for each id; sampled labels (at most about `FIT_ROWS` of each class, weighted by the inverse of
its share) are broadcast, and their texts are staged once. The fitted table holds at most `KEPT` features. All documents are
read three times: for the characters, for the labelled texts, for the scores. Decodings and word scores are cached in each
worker in bounded dictionaries; words and spelt runs of any length are decoded whole, in time linear in their length.

Defined cases: null text is an empty one; texts without evidence get the score of no evidence; without labelled rows of
both classes the score is the share of the one there is, or 0.5; an id with several label rows is toxic if one says so; null ids are not held out; an empty table gives no row;
repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import cut, table, utf8_lists
from textloom.llm.quality_model import lasso, one_label, remainder, sampled, shares
from textloom.llm.secrets import text_bytes

FIT_ROWS, KEPT, LEAST_GAIN, CUTOFF, CACHE_WORDS = 4_000, 4_000, 8.0, 0.3, 500_000
#: Longer words are decoded anew each time, so that the bounded caches are small.
CACHE_CHARS = 200
#: Beginnings of a word that are features beside the whole word, in letters.
BEGINNINGS = (4, 5, 6)
#: Letters that a character may stand for (fixed values of common leetspeak).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Characters that may be put between the letters of a word.
SEPARATORS = ".-_*~^'`·"
COST_LEET, COST_DROP, COST_RUN = 0.7, 0.4, 0.3
#: Alphabet of the character model: 0 is anything that ends a word, 1 to 26 are letters, 27 is any other letter.
SIZE = 28
CODES = np.zeros(256, np.uint8)
CODES[97:123], CODES[65:91], CODES[128:] = np.arange(1, 27), np.arange(1, 27), 27

_DISGUISE = "0-9@$!|+(€£" + re.escape(SEPARATORS)
#: A letter, or a sign that can stand for one, on both sides of a sign; a sign that begins a word; a letter three times.
SUSPECT = re.compile(rf"[a-z][{_DISGUISE}]+[a-z]|^[0-9@$!|+(€£][a-z0-9@$!|+(€£]*[a-z]|[a-z][0-9@$!|+(€£]+$|([a-z])\1\1")
#: Single letters, or signs for letters, with white space between them; marks may stand around the word.
SPELT = re.compile(r"(?<!\w)(?<!\w['’])[a-z0-9@$!|](?:[ \t\n\x0b\x0c\r]+[a-z0-9@$!|]){2,}(?!\w)(?!['’]\w)")
#: A necessary condition of SPELT on the bytes of a text of any case.
MAY_SPELL = re.compile(rb"(?<![A-Za-z0-9])[A-Za-z0-9@$!|][ \t\n\x0b\x0c\r]+[A-Za-z0-9@$!|][ \t\n\x0b\x0c\r]")
EDGE = ".,;:?\"')]}%&#*-_~^`<>/\\=[{"


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all docs (SIZE x SIZE x SIZE); runs of word ends count as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                data, off = text_bytes(batch.column(0).slice(lo, 1000).fill_null(""))
                if not len(data):
                    continue
                # a word end before and after each text, and a mark between texts that no trigram crosses
                codes = np.concatenate([[0], np.insert(CODES[data], np.repeat(off[1:-1], 3), [0, SIZE, 0] * (len(off) - 2)), [0]]).astype(np.int32)
                twice = np.zeros(len(codes), bool)  # of a letter in several bytes, and of word ends, one stays
                twice[1:] = ((codes[1:] == 0) | (codes[1:] == 27)) & (codes[1:] == codes[:-1])
                codes = codes[~twice]
                whole = (codes[:-2] < SIZE) & (codes[1:-1] < SIZE) & (codes[2:] < SIZE)
                total += np.bincount((codes[:-2] * SIZE * SIZE + codes[1:-1] * SIZE + codes[2:])[whole], minlength=SIZE**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["k", "n"])

    out = np.zeros(SIZE**3, np.float64)
    for k, n in docs.select(F.col("text").cast("string")).mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n")).collect():
        out[k] = n
    return out.reshape(SIZE, SIZE, SIZE)


def char_model(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of a character after two others, backed off to shorter contexts."""
    uni = (counts.sum((0, 1)) + 1) / (counts.sum() + SIZE)
    two = counts.sum(0)
    bi = (two + 20 * uni) / (two.sum(1, keepdims=True) + 20)
    return -np.log((counts + 20 * bi[None]) / (counts.sum(2, keepdims=True) + 20))


def code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def options(text: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each place (a run of one character is one place) the strings it may stand for and their costs."""
    out = []
    for m in re.finditer(r"(.)\1*", text, re.S):
        c, n = m[1], len(m[0])
        if c == " ":
            out.append([("", 0.0), (" ", 0.0)])
        elif c.isalpha():
            out.append([(c * n, 0.0)] if n < 3 else [(c, COST_RUN), (c * 2, COST_RUN)])
        else:
            own = [(x * min(n, 2), COST_LEET) for x in LEET.get(c, "")] + ([(x, COST_LEET) for x in LEET.get(c, "")] if n > 1 else [])
            out.append(own + ([("", COST_DROP)] if c in SEPARATORS or c in "!|+($*" or n > 2 else []) or [(" ", COST_DROP)])
    return out


def decode(text: str, model: np.ndarray) -> str:
    """The most likely string of a lattice under the character model; ties go to the option listed first."""
    # what is done so far is a chain of strings, so a step costs the same at any length
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for place in [*options(text), [(" ", 0.0)]]:
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, done) in best.items():
            for string, more in place:
                x, y, total = a, b, cost + more
                for c in string:
                    k = code(c)
                    if k == 0 and y == 0:
                        continue
                    total += model[x, y, k]
                    x, y = y, k
                if (x, y) not in new or total < new[x, y][0]:
                    new[x, y] = (total, (done, string))
        best = new
    chain, out = min(best.values(), key=lambda v: v[0])[1], []
    while chain:
        chain, string = chain
        out.append(string)
    return "".join(reversed(out)).strip()


class Restorer:
    """Restored words of whole texts."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def word(self, word: str) -> str:
        """A lower-case word without the marks at its edges, decoded if the channel may have changed it."""
        core = word.strip(EDGE)
        if not core or not SUSPECT.search(core):
            return core.rstrip("!")
        if len(core) > CACHE_CHARS:
            return decode(core, self.model)
        if core not in self.known:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[core] = decode(core, self.model)
        return self.known[core]

    def spelt(self, text: str) -> list[str]:
        """Words that are spelt letter by letter, of a lower-case text."""
        out = []
        for m in SPELT.finditer(text):
            out += decode(" ".join(m[0].split()), self.model).split()
        return out


def features(word: str) -> list[str]:
    """A restored word and its beginnings; a decoded string of several words gives those of each."""
    return [f for w in word.split() for f in (w, *(w[:k] + "*" for k in BEGINNINGS if len(w) >= k))]


def log_odds(seen: DataFrame, model: np.ndarray, clean_weight: float = 1.0) -> dict[str, float]:
    """Feature -> log-odds of the KEPT strongest features of labelled texts (y, text), each with a log-likelihood gain of LEAST_GAIN or more over chance.

    clean_weight: rows that a clean row stands for, for each that a toxic one does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for y, texts in utf8_lists(batches):
            for label, text in zip(y.to_pylist(), texts, strict=True):
                low = text.decode().lower()
                found = {f for w in set(low.split()) for f in features(restore.word(w))} | {f for w in restore.spelt(low) for f in features(w)}
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([label] * len(found), pa.int64())], names=["f", "y"])

    n = {r[0]: r[1] for r in seen.groupBy("y").count().collect()}
    share = n.get(1, 0) / max(1, n.get(1, 0) + clean_weight * n.get(0, 0))
    if not 0 < share < 1:
        return {}
    counts = seen.select("y", "text").mapInArrow(run, "f string, y long").groupBy("f").agg(F.sum("y").cast("double").alias("t"), F.count("*").cast("double").alias("n"))
    odds = F.log((F.col("t") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (n.get(0, 0) + 1))
    clean = clean_weight * (F.col("n") - F.col("t"))
    both = F.col("t") + clean
    gain = F.col("t") * F.log(F.col("t") / both / share) + F.when(clean > 0, clean * F.log(clean / both / (1 - share))).otherwise(0.0)
    counts = counts.where(F.col("t") > share * both).where(gain >= LEAST_GAIN)
    return {r.f: r.w for r in counts.select("f", odds.alias("w")).where("w > 1.5").orderBy(F.desc("w"), "f").limit(KEPT).collect()}


def evidence(docs: DataFrame, odds: dict[str, float], model: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep, most double, total double of each row of docs: the strongest log-odds of its restored words, and their sum."""
    types = ", ".join(f"{c} long" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, known = Restorer(model), {}
        for *keys, texts in utf8_lists(batches):
            most, total = np.zeros(len(texts)), np.zeros(len(texts))
            for i, text in enumerate(texts):
                hits = []
                for w in set(text.split()):
                    v = known.get(w)
                    if v is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        v = max((odds.get(f, 0.0) for f in features(restore.word(w.decode().lower()))), default=0.0)
                        known[w] = v
                    if v:
                        hits.append(v)
                spelt = restore.spelt(text.decode().lower()) if MAY_SPELL.search(text) else ()
                hits += [v for w in spelt if (v := max((odds.get(f, 0.0) for f in features(w)), default=0.0))]
                if hits:
                    most[i], total[i] = max(hits), sum(hits)
            yield pa.RecordBatch.from_arrays([*keys, pa.array(most), pa.array(total)], names=[*keep, "most", "total"])

    return docs.select(*[F.col(c).cast("long") for c in keep], F.col("text").cast("string")).mapInArrow(run, f"{types}, most double, total double")


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: Column | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score) of each row of docs; labels (doc_id, label) are learnt where held_out, a column over doc_id, is false."""
    held_out = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    model = char_model(count_trigrams(docs))
    labelled = one_label(labels, label).where(~held_out)
    learnt = sampled(labelled, "__y", share := shares(labelled, "__y", fit_rows))
    seen = cut(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(learnt), "doc_id").select(F.col("__y").cast("long").alias("y"), "text"))
    odds = log_odds(seen, model, share[1] / share[0])
    rows = np.array([list(r) for r in evidence(seen, odds, model, ("y",)).orderBy("y", "most", "total").collect()], np.float64).reshape(-1, 3)
    y, most, total = rows.T
    if not len(y) or y.min() == y.max():
        return evidence(docs, {}, model).select("doc_id", held_out.alias("held_out"), F.lit(float(y.mean()) if len(y) else 0.5).alias("score"))
    a = np.column_stack([most / 8, np.log1p(total) / 4, most > 0])
    w, b = lasso(a, y, 1e-4, 1500, np.where(y == 1, 1 / share[1], 1 / share[0]))
    z = F.lit(float(b)) + F.lit(float(w[0])) * F.col("most") / 8 + F.lit(float(w[1])) * F.log1p("total") / 4 + F.when(F.col("most") > 0, float(w[2])).otherwise(0.0)
    return evidence(docs, odds, model).select("doc_id", held_out.alias("held_out"), (1 / (1 + F.exp(-z))).alias("score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=remainder(F.col("doc_id"), 4) == 2)
    return found.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))
