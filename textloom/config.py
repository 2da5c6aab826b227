"""Configuration: frozen dataclasses that YAML mappings fill; unknown keys are ignored, wrong values raise."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

BUCKETS = ("human", "direct_ai", "hard_ai", "mixed")
SPLITS = ("train", "val", "test")


def load_yaml(path: str | Path) -> dict[str, Any]:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def load_env(path: str | Path) -> dict[str, str]:
    """NAME=value lines of a file into the environment; what is set already stays. Comments, quotes and "export" are understood; no file: nothing."""
    out: dict[str, str] = {}
    if not Path(path).is_file():
        return out
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        name, sign, value = line.strip().removeprefix("export ").partition("=")
        if not sign or not name.strip().isidentifier() or line.lstrip().startswith("#"):
            continue
        value = value.strip()
        value = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value.split(" #", 1)[0].strip()
        out[name.strip()] = os.environ.setdefault(name.strip(), value)
    return out


def _known(kind: type, raw: dict[str, Any]) -> dict[str, Any]:
    names = {f.name for f in fields(kind)}
    return {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items() if k in names and v is not None}


@dataclass(frozen=True)
class QualityConfig:
    word_count_min: int = 80
    word_count_max: int = 300
    min_sentences: int = 3
    max_non_alnum_ratio: float = 0.18
    max_line_repetition: float = 0.35
    ai_prefix_overlap_max: float = 0.88
    list_heavy_max_ratio: float = 0.4
    code_heavy_word_threshold: int = 200

    @classmethod
    def of(cls, raw: dict[str, Any]) -> QualityConfig:
        return cls(**_known(cls, raw))


@dataclass(frozen=True)
class SampleConfig:
    sentence_span_min: int = 4
    sentence_span_max: int = 8
    prefix_sentence_min: int = 2
    prefix_sentence_max: int = 4
    temperature_range: tuple[float, float] = (0.3, 1.2)
    top_p_range: tuple[float, float] = (0.7, 1.0)
    max_tokens_range: tuple[int, int] = (80, 220)
    repeat_penalty_range: tuple[float, float] = (1.0, 1.2)
    hard_transform_temperature_range: tuple[float, float] = (0.2, 0.65)
    hard_transform_top_p_range: tuple[float, float] = (0.75, 1.0)
    hard_transform_max_tokens_min: int = 120
    hard_transform_max_tokens_max: int = 320
    mixed_paragraph_joiner: str = "\n\n"
    mixed_word_count_max: int = 520
    continuation_system: str = ""
    use_raw_completion_for_text_models: bool = True
    hard_transform_systems: tuple[Any, ...] = ()
    hard_transform_system: str = ""

    @classmethod
    def of(cls, raw: dict[str, Any]) -> SampleConfig:
        return cls(**_known(cls, raw))


@dataclass(frozen=True)
class AugmentConfig:
    augment_prob_none: float = 0.2
    augment_prob_one: float = 0.5
    stress_augment_prob_none: float = 0.1
    stress_augment_prob_one: float = 0.4
    char_augs: tuple[str, ...] = ()
    word_augs: tuple[str, ...] = ()

    @classmethod
    def of(cls, raw: dict[str, Any]) -> AugmentConfig:
        return cls(**_known(cls, raw))


@dataclass(frozen=True)
class BuildConfig:
    random_seed: int = 42
    id_prefix: str = "row"
    source_type: str = "corpus"
    stress_fraction: float = 0.05
    split_ratios: dict[str, float] = field(default_factory=lambda: {"train": 0.8, "val": 0.1, "test": 0.1})
    domain_quotas: dict[str, float] = field(default_factory=dict)
    subset_to_domain: dict[str, str] = field(default_factory=dict)
    default_coarse_domain: str = "web"
    #: module:function of a sentence splitter; by default sentences are split by rule.
    sentence_splitter: str | None = None
    output_layout: str = "mixed"
    dedup_normalize_text: bool = True
    skip_ai: bool = False
    num_pairs: int | None = None
    max_documents_scan: int | None = None
    sample_targets: dict[str, int] | None = None
    quality: QualityConfig = QualityConfig()
    sample: SampleConfig = SampleConfig()
    augment: AugmentConfig = AugmentConfig()

    def __post_init__(self) -> None:
        if self.output_layout not in ("mixed", "by_label"):
            raise ValueError(f"unknown output_layout {self.output_layout!r}")
        if self.sample_targets is not None and self.skip_ai:
            raise ValueError("sample targets need machine rows; skip_ai excludes them")


def parse_sample_targets(raw: dict[str, Any]) -> dict[str, int] | None:
    """The four targets, or None where use_sample_quotas is off; all must be given and none negative."""
    if not raw.get("use_sample_quotas"):
        return None
    given = raw.get("sample_targets")
    if not isinstance(given, dict) or any(k not in given for k in BUCKETS):
        raise ValueError(f"sample_targets needs all of {', '.join(BUCKETS)}")
    out = {k: int(given[k]) for k in BUCKETS}
    if min(out.values()) < 0:
        raise ValueError("sample_targets must not be negative")
    return out


def load_config(folder: str | Path, **overrides: Any) -> BuildConfig:
    """BuildConfig from datasets.yaml, generation.yaml and augmentation.yaml of a folder; missing files count as empty."""
    raw = {n: load_yaml(p) if (p := Path(folder) / f"{n}.yaml").exists() else {} for n in ("datasets", "generation", "augmentation")}
    own = _known(BuildConfig, raw["datasets"])
    own["sample_targets"] = parse_sample_targets(raw["datasets"])
    if mapping := raw["datasets"].get("pile_subset_to_domain"):
        own["subset_to_domain"] = mapping
    own |= {"quality": QualityConfig.of(raw["generation"]), "sample": SampleConfig.of(raw["generation"]), "augment": AugmentConfig.of(raw["augmentation"])}
    return BuildConfig(**(own | overrides))
