"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import embeddings, mixing, packing, quality_model, quality_rules, secrets, simhash, token_counts, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.op1_packing,
    "op2_secrets": secrets.op2_secrets,
    "op3_mixing": mixing.op3_mixing,
    "op4_quality_model": quality_model.op4_quality_model,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_simhash": simhash.op8_simhash,
    "op9_embeddings": embeddings.op9_embeddings,
    "op10_warc": warc.op10_warc,
}

SQL: dict[str, str] = {
    "op3_mixing": mixing.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op10_warc": warc.SQL,
}
