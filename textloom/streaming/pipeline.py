"""Streaming builds: a growing folder of documents becomes appended records, batch by batch.

No column has event time, so there is no watermark: earlier output is the state. Each micro-batch runs the batch plan,
anti-joins what is already written, continues the ids and appends. A batch that is replayed after a failure finds its own
rows written and adds none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from textloom.config import BuildConfig
from textloom.operators import summary
from textloom.plans.build import Report, build_pairs
from textloom.sources import sinks, state

SCHEMA = "id string, base_text string, sample_kind string, split_name string, original_text_hash string"


def has_output(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(path) and any("split=" in x.getPath().getName() or "side=" in x.getPath().getName() for x in system.listStatus(path))


def append_batch(docs: DataFrame, folder: str, cfg: BuildConfig, **more: object) -> None:
    """Builds docs and appends what is new to folder."""
    spark, report = docs.sparkSession, Report()
    if has_output(spark, folder):
        earlier = state.read_output(spark, folder, strict=False, schema=SCHEMA)
        more |= {"earlier": earlier, "offsets": state.last_ids(earlier)}
    sinks.write_jsonl(build_pairs(docs, cfg, report=report, **more), folder, cfg.output_layout, append=True)
    if "://" not in folder:  # counts after each batch, from what is written
        counts = {r.sample_kind: r.n for r in summary.bucket_counts(state.read_output(spark, folder, strict=False, schema=SCHEMA)).collect()}
        sinks.save_counts(f"{folder}/_counts.json", counts, cfg.sample_targets)


def stream_build(docs: DataFrame, folder: str, checkpoint: str, cfg: BuildConfig, **more: object) -> DataStreamWriter:
    """A writer that appends each micro-batch of the stream docs; start() it with a trigger of choice."""
    return docs.writeStream.foreachBatch(lambda batch, _: append_batch(batch, folder, cfg, **more)).option("checkpointLocation", checkpoint)


def event_windows(events: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Extension: tumbling windows over a stream or table of events (ts, event_type, value), late rows up to a watermark."""
    held = events.withWatermark("ts", late) if events.isStreaming else events
    return held.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
