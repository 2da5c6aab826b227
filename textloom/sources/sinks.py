"""Sinks: JSON lines by layout, counts, statistics and the lock of an output folder."""

from __future__ import annotations

import contextlib
import json
import os
from collections.abc import Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.ranking import with_ids


class Locked(RuntimeError):
    """Another run writes to the folder."""


def side(kind: Column) -> Column:
    """Folder of a kind in the by_label layout: direct and hard rows share one."""
    return F.when(kind.isin("human", "mixed"), kind).otherwise("ai")


def layout_columns(layout: str) -> list[str]:
    if layout not in ("mixed", "by_label"):
        raise ValueError(f"unknown layout {layout!r}")
    return ["side", "split"] if layout == "by_label" else ["split"]


def write_jsonl(records: DataFrame, folder: str, layout: str = "mixed", append: bool = False) -> None:
    """Records as JSON lines under split=.../ or side=.../split=.../, nulls kept; the split stays in the record as split_name."""
    columns = layout_columns(layout)
    out = records.withColumn("split_name", F.col("split"))
    if layout == "by_label":
        out = out.withColumn("side", side(F.col("sample_kind")))
    out.write.partitionBy(*columns).mode("append" if append else "overwrite").json(folder, ignoreNullFields=False)


def merge_outputs(parts: list[DataFrame], prefix: str) -> DataFrame:
    """The records of several outputs (of disjoint shards) as one, with new dense ids: by split, in an order of hashes of part and old id."""
    named = [p.withColumn("__part", F.lit(k)) for k, p in enumerate(parts)]
    rows = named[0]
    for p in named[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    rows = rows.withColumns({"__split": F.regexp_extract("id", r"^.*_([a-z]+)_\d+$", 1), "__order": F.sha2(F.concat_ws("|", "__part", "id"), 256)})
    return with_ids(rows, "__split", "__order", prefix).drop("__part", "__split", "__order")


def paths(folder: str, layout: str) -> list[str]:
    """All folders that a layout may have."""
    splits = [f"split={s}" for s in ("train", "val", "test", "stress")]
    return [f"{folder}/{s}" for s in splits] if layout_columns(layout) == ["split"] else [f"{folder}/side={x}/{s}" for x in ("human", "ai", "mixed") for s in splits]


def write_json(path: str | Path, value: Any) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def save_counts(path: str | Path, counts: dict[str, int], targets: dict[str, int] | None) -> None:
    write_json(path, {**counts, "targets": targets or {}})


@contextlib.contextmanager
def output_lock(folder: str | Path) -> Iterator[None]:
    """Holds the folder's lock file, with the process id inside; raises Locked at once if another process holds it."""
    try:
        import fcntl
    except ImportError:
        yield
        return
    Path(folder).mkdir(parents=True, exist_ok=True)
    with open(Path(folder) / ".build.lock", "a+") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as e:
            raise Locked(f"{folder} is in use") from e
        f.truncate(0)
        f.write(str(os.getpid()))
        f.flush()
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)
