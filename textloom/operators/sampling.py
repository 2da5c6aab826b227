"""Keyed sampling: splits, spans, prefixes, generation parameters, pools, styles, hosts and buckets."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.config import BUCKETS, SPLITS, SampleConfig
from textloom.functions.hashing import draw, randint, uniform
from textloom.functions.text import join_span

PLAIN_REWRITE = "Say the passage again in new words. Keep its meaning and its tone. Give the new text alone."


def assign_split(seed: int, key: Column, ratios: dict[str, float], stress_fraction: float) -> Column:
    """stress first, then train, val or test by their shares; a pure function of the document, so it never leaks."""
    total = sum(ratios.get(s, 0.0) for s in SPLITS) or 1.0
    u = uniform(seed, key, "split")
    train, val = ratios.get("train", 0.0) / total, (ratios.get("train", 0.0) + ratios.get("val", 0.0)) / total
    return F.when(uniform(seed, key, "stress") < stress_fraction, "stress").when(u < train, "train").when(u < val, "val").otherwise("test")


def _length(n: Column, low: int, high: int, seed: int, key: Column, purpose: str) -> Column:
    lo = F.greatest(F.lit(1), F.least(F.lit(low), n))
    return randint(seed, key, purpose, lo, F.greatest(lo, F.least(F.lit(high), n)))


def sample_span(sentences: Column, low: int, high: int, seed: int, key: Column) -> Column:
    """STRUCT<span, i0, i1>: consecutive sentences, the end exclusive."""
    n = F.size(sentences)
    size = _length(n, low, high, seed, key, "span:length")
    start = randint(seed, key, "span:start", F.lit(0), F.greatest(n - size, F.lit(0)))
    return F.struct(F.slice(sentences, start + 1, size).alias("span"), start.alias("i0"), (start + size).alias("i1"))


def prefix_length(sentences: Column, low: int, high: int, seed: int, key: Column) -> Column:
    return _length(F.size(sentences), low, high, seed, key, "prefix")


def prefix_span(sentences: Column, low: int, high: int, seed: int, key: Column) -> Column:
    """The first sentences, joined."""
    return join_span(F.slice(sentences, F.lit(1), prefix_length(sentences, low, high, seed, key)))


def generation_params(cfg: SampleConfig, seed: int, key: Column) -> Column:
    p = cfg.max_tokens_range
    return F.struct(uniform(seed, key, "temperature", *cfg.temperature_range).alias("temperature"), uniform(seed, key, "top_p", *cfg.top_p_range).alias("top_p"), randint(seed, key, "max_tokens", p[0], p[1]).alias("max_tokens"), uniform(seed, key, "repeat_penalty", *cfg.repeat_penalty_range).alias("repeat_penalty"))


def rewrite_params(cfg: SampleConfig, seed: int, key: Column) -> Column:
    return F.struct(uniform(seed, key, "rewrite:temperature", *cfg.hard_transform_temperature_range).alias("temperature"), uniform(seed, key, "rewrite:top_p", *cfg.hard_transform_top_p_range).alias("top_p"), randint(seed, key, "rewrite:max_tokens", cfg.hard_transform_max_tokens_min, cfg.hard_transform_max_tokens_max).alias("max_tokens"), uniform(seed, key, "rewrite:repeat_penalty", *cfg.repeat_penalty_range).alias("repeat_penalty"))


def pick_weighted(weights: list[float], u: Column) -> Column:
    """Number of the entry where the running weight first reaches u times the total; all zero: evenly."""
    if not weights:
        raise ValueError("empty generator pool")
    total = sum(weights)
    if total <= 0:
        weights, total = [1.0] * len(weights), float(len(weights))
    out, upto = F.lit(len(weights) - 1), total
    for i in reversed(range(len(weights) - 1)):
        upto -= weights[i + 1]
        out = F.when(u * total <= upto, i).otherwise(out)
    return out


def rewrite_styles(cfg: SampleConfig) -> list[tuple[str, str]]:
    """(prompt, style) of each entry; entries without a prompt take the single system prompt, and that the plain one."""
    single = (cfg.hard_transform_system.strip(), "default") if cfg.hard_transform_system.strip() else (PLAIN_REWRITE, "fallback")
    out: list[tuple[str, str]] = []
    for entry in cfg.hard_transform_systems:
        name, system = ("line", entry) if isinstance(entry, str) else (str(entry.get("name") or "variant").strip(), str(entry.get("system") or ""))
        out.append((system.strip(), name or "variant") if system.strip() else single)
    return out or [single]


def pick_style(cfg: SampleConfig, seed: int, key: Column) -> Column:
    """STRUCT<system, style>."""
    styles = rewrite_styles(cfg)
    rows = F.array(*[F.struct(F.lit(s).alias("system"), F.lit(n).alias("style")) for s, n in styles])
    return F.get(rows, (draw(seed, key, "rewrite:style") % len(styles)).cast("int"))


def pick_host(hosts: list[str], seed: int, key: Column) -> Column:
    return F.get(F.array(*map(F.lit, hosts)), (draw(seed, key, "host") % len(hosts)).cast("int"))


def bucket_order(seed: int, key: Column) -> Column:
    """The four buckets in an order of the document's own; the first open one is its bucket."""
    return F.transform(F.array_sort(F.transform(F.array(*map(F.lit, BUCKETS)), lambda b: F.struct(draw(seed, key, F.concat(F.lit("bucket:"), b)).alias("u"), b.alias("b")))), lambda s: s["b"])


def entries_as_columns(pool: list[Any], number: Column) -> tuple[Column, Column]:
    """(provider, model) of the numbered entry of a pool."""
    pick = lambda name: F.get(F.array(*[F.lit(getattr(e, name)) for e in pool]), number)
    return pick("provider"), pick("model")
