"""Earlier output as input: hashes, last ids and counts for runs that append."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import BUCKETS

ID = r"^.*_([a-z]+)_(\d+)$"


def read_output(spark: SparkSession, folder: str, *, strict: bool = True, schema: str | None = None) -> DataFrame:
    """Records of a written folder in either layout; malformed lines raise, or are skipped where not strict."""
    fields = schema or "id string, label string, label_int int, sample_kind string, domain string, base_text string, final_text string, original_text_hash string, generator_provider string, generator_model string, num_words int, num_sentences int, augmentation array<struct<type:string,word:string>>"
    return spark.read.schema(fields).option("recursiveFileLookup", "false").json(folder, mode="FAILFAST" if strict else "DROPMALFORMED")


def last_ids(records: DataFrame, column: str = "id") -> DataFrame:
    """(split, last): the largest number of each split's ids."""
    found = records.where(F.col(column).rlike(ID))
    return found.groupBy(F.regexp_extract(column, ID, 1).alias("split")).agg(F.max(F.regexp_extract(column, ID, 2).cast("bigint")).alias("last"))


def written_hashes(records: DataFrame) -> DataFrame:
    return records.where("original_text_hash is not null").select(F.col("original_text_hash").alias("hash")).distinct()


def load_counts(path: str | Path) -> dict[str, int] | None:
    """Counts of a counts file; None where it is missing or broken, 0 for what it lacks."""
    try:
        raw = json.loads(Path(path).read_text(encoding="utf-8"))
        return {b: int(raw.get(b) or 0) for b in BUCKETS}
    except (OSError, ValueError, TypeError, AttributeError):
        return None
