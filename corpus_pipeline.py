"""The corpus pipeline: five stages from raw documents to packed training sequences.

1. quality_rules: documents that a rule rejects go.
2. simhash: of each group of near copies (SimHash candidates at an exact five-word Jaccard similarity of 0.8 or more) the document
   with the smallest id stays.
3. secrets: what the secret scan reports is replaced by a mark; documents stay.
4. mixing: documents are taken by the weights of their domain, language and source; several epochs repeat a document.
5. packing: all documents left are packed into token sequences; the result is its pieces.

Every stage is written as Parquet to the shared folder and read back, so a later stage never recomputes an earlier one and a
lost executor costs only its own tasks; the tables are deleted again, and the result is a checkpoint that goes with its frame.
Null texts and ids, empty tables, repeated rows and further columns are handled as each operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import mixing, near_copies, packing, quality_rules, secrets
from textloom.llm.common import cut, drop_path, scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_docs(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_docs(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("simhash", simhash_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SimHash classes and packing are beyond SQL; tests hold the stages against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed corpus. Each stage's table is deleted once the next one is written."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        if path:
            drop_path(spark, path)
        docs, path = spark.read.parquet(out), out
    pieces = cut(docs)
    drop_path(spark, path)
    return pieces
