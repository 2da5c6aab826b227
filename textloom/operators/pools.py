"""Generator pools: parsing, phases, credentials and preflight; driver-side, as a pool is a handful of rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

PROVIDERS = ("ollama", "openai", "offline")
PHASES = ("all", "openai_only", "ollama_locked")


@dataclass(frozen=True)
class Entry:
    provider: str
    model: str
    weight: float = 1.0
    base_url: str | None = None
    api_key_env: str | None = None

    def model_id(self) -> str:
        return self.model


def _text(raw: dict[str, Any], *names: str) -> str | None:
    return next((s for n in names if raw.get(n) is not None and (s := str(raw[n]).strip())), None)


def parse_entry(raw: Any) -> Entry:
    if not isinstance(raw, dict):
        raise ValueError(f"a generator entry is a mapping, not {raw!r}")
    provider, model = str(raw.get("provider") or "").strip().lower(), _text(raw, "model")
    if provider not in PROVIDERS:
        raise ValueError(f"unknown provider in {raw!r}")
    if model is None:
        raise ValueError(f"no model in {raw!r}")
    try:
        weight = float(raw["weight"])
    except (KeyError, TypeError, ValueError):
        weight = 1.0
    if weight < 0:
        raise ValueError(f"negative weight in {raw!r}")
    if provider == "openai":
        return Entry(provider, model, weight, _text(raw, "openai_base_url", "base_url"), _text(raw, "openai_api_key_env", "api_key_env"))
    if _text(raw, "openai_base_url", "openai_api_key_env"):
        raise ValueError(f"only openai entries take a URL or key of their own: {raw!r}")
    return Entry(provider, model, weight)


def parse_pool(items: Iterable[Any] | None) -> list[Entry]:
    """All entries with a weight above zero; where there is none, all."""
    entries = [parse_entry(x) for x in items or ()]
    return [e for e in entries if e.weight > 0] or entries


def _plain(names: Iterable[Any] | None) -> list[Entry]:
    return [Entry("ollama", str(n).strip()) for n in names or () if str(n).strip()]


def train_pool(cfg: dict[str, Any]) -> list[Entry]:
    if "train_generators" in cfg and cfg["train_generators"] is not None:
        if not (pool := parse_pool(cfg["train_generators"])):
            raise ValueError("train_generators is empty")
        return pool
    return _plain(cfg.get("train_models")) or _plain([cfg.get("default_model") or ""])


def stress_pool(cfg: dict[str, Any]) -> list[Entry]:
    return parse_pool(cfg["stress_generators"]) if cfg.get("stress_generators") is not None else _plain(cfg.get("stress_models"))


def rewrite_pool(cfg: dict[str, Any]) -> list[Entry]:
    return parse_pool(cfg["hard_transform_generators"]) if cfg.get("hard_transform_generators") else train_pool(cfg)


def providers_used(pools: Iterable[list[Entry]]) -> set[str]:
    return {e.provider for pool in pools for e in pool}


def _of_phase(pool: list[Entry], phase: str, tag: str) -> list[Entry]:
    if phase == "openai_only":
        return [e for e in pool if e.provider == "openai"]
    return [e for e in pool if e.provider == "ollama" and e.model == tag]


def _phase(phase: str | None, tag: str | None) -> tuple[str, str]:
    name = (phase or "all").strip().lower()
    name = "all" if name == "default" else name
    if name not in PHASES:
        raise ValueError(f"unknown phase {phase!r}")
    if name == "ollama_locked" and not (tag or "").strip():
        raise ValueError("a locked phase needs a model tag")
    return name, (tag or "").strip()


def apply_phase(train: list[Entry], stress: list[Entry], phase: str | None, tag: str | None = None) -> tuple[list[Entry], list[Entry]]:
    """Both pools for one phase: all of them, only remote ones, or only one local tag (a side without it borrows the other's)."""
    name, tag = _phase(phase, tag)
    if name == "all":
        return train, stress
    a, b = _of_phase(train, name, tag), _of_phase(stress, name, tag)
    if name == "openai_only" and not (a and b):
        raise ValueError(f"both pools need an openai entry, they have {len(a)} and {len(b)}")
    if not (a or b):
        tags = sorted({e.model for e in train + stress if e.provider == "ollama"})
        raise ValueError(f"no entry with tag {tag!r}; tags are {tags}")
    return a or b, b or a


def filter_for_phase(pool: list[Entry], phase: str | None, tag: str | None, fallback: list[Entry]) -> list[Entry]:
    """Another pool for the same phase, from itself or else from fallback; a locked phase makes an entry if neither has one."""
    name, tag = _phase(phase, tag)
    if name == "all":
        return pool
    if out := _of_phase(pool, name, tag) or _of_phase(fallback, name, tag):
        return out
    if name == "openai_only":
        raise ValueError("no openai entry in either pool")
    return [Entry("ollama", tag)]


def remote_config(cfg: dict[str, Any] | None, entry: Entry) -> dict[str, Any]:
    """The shared remote settings with the entry's own on top; an own URL is never an Azure one."""
    own: dict[str, Any] = {}
    if entry.provider == "openai" and entry.base_url:
        own |= {"base_url": entry.base_url.rstrip("/"), "use_azure": False}
    if entry.provider == "openai" and entry.api_key_env:
        own["api_key_env"] = entry.api_key_env
    return dict(cfg or {}) | own


def drop_without_key(cfg: dict[str, Any], *pools: list[Entry], ready: Callable[[dict[str, Any]], bool]) -> list[list[Entry]]:
    """Pools without remote entries that lack credentials, where openai.omit_if_no_api_key is on."""
    shared = cfg.get("openai") or {}
    if not shared.get("omit_if_no_api_key"):
        return [list(p) for p in pools]
    return [[e for e in p if e.provider != "openai" or ready(remote_config(shared, e))] for p in pools]


def assert_configured(pools: Iterable[list[Entry]], cfg: dict[str, Any], *, ready: Callable[[dict[str, Any]], bool], reach: Callable[[], None]) -> None:
    """Preflight: local servers answer if any entry needs them, remote entries have credentials."""
    pools = list(pools)
    if "ollama" in providers_used(pools):
        reach()
    for e in (e for p in pools for e in p if e.provider == "openai"):
        if not ready(remote_config(cfg.get("openai"), e)):
            raise ValueError(f"no credentials for {e.model}")


def local_urls(cfg: dict[str, Any], url: str | None = None, urls: Iterable[str] | None = None, env: str = "OLLAMA_HOST") -> list[str]:
    """Hosts by precedence: a list argument, one argument, the environment, the configured list, the configured one, the default."""
    clean = lambda xs: [u for x in xs or () if (u := str(x or "").strip().rstrip("/"))]
    own = os.environ.get(env, "").split(",")
    return clean(urls) or clean([url]) or clean(own) or clean(cfg.get("ollama_base_urls")) or clean([cfg.get("ollama_base_url")]) or ["http://127.0.0.1:11434"]


def as_frame(spark: SparkSession, pool: list[Entry]) -> DataFrame:
    """A pool as a small dimension: provider, model, weight and the running weight's bounds low < u <= high."""
    total = sum(e.weight for e in pool)
    weights = [e.weight / total if total > 0 else 1 / len(pool) for e in pool]
    rows, at = [], 0.0
    for i, (e, w) in enumerate(zip(pool, weights, strict=True)):
        rows.append((i, e.provider, e.model, e.weight, at, 1.0 if i == len(pool) - 1 else at + w))
        at += w
    return spark.createDataFrame(rows, "number int, provider string, model string, weight double, low double, high double")
