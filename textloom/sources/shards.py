"""Compressed JSON-lines shards behind an opener (a hub, a web server), read by tasks that go on after broken connections."""

from __future__ import annotations

import gzip
import io
import random
import time
import urllib.request
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from textloom.sources.documents import is_passing_stream_error

Opener = Callable[[str], BinaryIO]


def http_opener(url: str, timeout: float = 300.0) -> BinaryIO:
    return urllib.request.urlopen(url, timeout=timeout)


def plain(name: str, raw: BinaryIO) -> BinaryIO:
    """The decompressed stream of a shard, by the end of its name."""
    if name.endswith((".zst", ".zstd")):
        import zstandard

        return io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True))
    return gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw


def lines_of(url: str, opener: Opener, reconnects: int, base: float, most: float, sleep: Callable[[float], None]) -> Iterator[bytes]:
    """Lines of a shard, each once: after a passing error the shard is opened again and the lines given before are skipped.

    Waits grow up to most with jitter; a line that arrives after a reconnect starts the count of reconnects anew."""
    given, failed = 0, 0
    while True:
        try:
            with opener(url) as raw:
                for k, line in enumerate(plain(url, raw)):
                    if k >= given:
                        yield line
                        given, failed = k + 1, 0
            return
        except Exception as e:
            failed += 1
            if failed > reconnects or not (is_passing_stream_error(e) or isinstance(e, EOFError)):
                raise
            sleep(min(most, base * 2 ** (failed - 1)) + random.uniform(0, min(10.0, base)))


def read_shards(spark: SparkSession, urls: list[str], opener: Opener = http_opener, *, reconnects: int = 30, base: float = 15.0, most: float = 120.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(value, shard): the lines of shards, a task for each shard. opener must be picklable; parse value with from_json, then as_documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                held: list[str] = []
                for line in lines_of(url, opener, reconnects, base, most, sleep):
                    held.append(line.decode(errors="replace").rstrip("\r\n"))
                    if len(held) == 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array([url] * len(held))], names=["value", "shard"])
                        held = []
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array([url] * len(held), pa.string())], names=["value", "shard"])

    rows = spark.createDataFrame([(u,) for u in urls], "url string").repartition(max(1, len(urls)), "url")
    return rows.mapInArrow(run, "value string, shard string")
