"""Document sources: JSON lines, Parquet and hub-like shards, all giving (text, doc_id, subset, domain)."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from typing import Any, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.hashing import digest, draw
from textloom.operators.filters import not_empty

T = TypeVar("T")
#: Keys of meta that may name the subset, in this order (fixed values).
SUBSET_KEYS = ("pile_set_name", "subset", "pile_subset")
#: Parts of messages of errors that pass (fixed values).
PASSING = ("504", "503", "502", "429", "gateway time-out", "timeout", "timed out", "connection reset", "connection aborted", "temporarily unavailable", "bad gateway")
STREAM_PASSING = ("errno 110", "timed out", "connection reset", "broken pipe")
REMOTE_PATHS = ("hf://", "zstd://", "huggingface.co")


def is_passing_error(error: BaseException) -> bool:
    """Hub and network errors that a retry may cure."""
    if isinstance(error, (TimeoutError, ConnectionError)) or any(p in str(error).lower() for p in PASSING):
        return True
    at, depth = error, 0
    while at is not None and depth < 8:
        if getattr(getattr(at, "response", None), "status_code", None) in (429, 502, 503, 504):
            return True
        at, depth = at.__cause__ or at.__context__, depth + 1
    return False


def is_passing_stream_error(error: BaseException) -> bool:
    """Also reads of remote shards that break off."""
    text = str(error).lower()
    if isinstance(error, FileNotFoundError) and any(p in text for p in REMOTE_PATHS):
        return True
    return is_passing_error(error) or (isinstance(error, OSError) and any(p in text for p in STREAM_PASSING))


def with_retries(opener: Callable[[], T], *, retries: int = 15, base: float = 20.0, most: float = 180.0, passing: Callable[[BaseException], bool] = is_passing_error, sleep: Callable[[float], None] = time.sleep) -> T:
    """opener(), again after growing waits with jitter while its errors pass."""
    for i in range(retries + 1):
        try:
            return opener()
        except Exception as e:
            if i == retries or not passing(e):
                raise
            sleep(min(most, base * 2**i) + random.uniform(0, min(10.0, base)))
    raise AssertionError


def parse_meta(meta: Column, kind: str) -> Column:
    """MAP of strings from a map, a struct or a JSON string; anything else is empty."""
    empty = F.create_map().cast("map<string,string>")
    if kind.startswith("map"):
        return F.coalesce(meta.cast("map<string,string>"), empty)
    text = F.to_json(meta) if kind.startswith("struct") else meta.cast("string")
    return F.coalesce(F.from_json(text, "map<string,string>"), empty)


def subset_name(meta: Column) -> Column:
    """The first name that is not blank."""
    named = [F.nullif(F.regexp_replace(meta[k], r"(?U)^\s+|\s+$", ""), F.lit("")) for k in SUBSET_KEYS]
    return F.coalesce(*named)


def coarse_domain(subset: Column, mapping: dict[str, str], default: str = "web") -> Column:
    """Domain of a subset by exact name, else in any case (the first entry wins), else default."""
    if not mapping:
        return F.lit(default)
    low: dict[str, str] = {}
    for k, v in mapping.items():
        low.setdefault(k.lower(), v)
    look = lambda m, c: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), c)
    return F.coalesce(look(mapping, subset), look(low, F.lower(subset)), F.lit(default))


def as_documents(rows: DataFrame, *, text_field: str = "text", meta_field: str = "meta", id_field: str = "id", id_prefix: str = "doc", mapping: dict[str, str] | None = None, default_domain: str = "web") -> DataFrame:
    """(text, doc_id, subset, domain) of rows with a text; rows without an id are named by a hash of their text, so their splits and draws don't depend on files or partitions."""
    kinds = dict(rows.dtypes)
    texts = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in dict.fromkeys((text_field, "text")) if c in kinds]
    text = F.coalesce(*texts) if texts else F.lit(None).cast("string")
    number = F.concat(F.lit(f"{id_prefix}_"), F.substring(F.sha2(text, 256), 1, 16))
    doc_id = F.coalesce(F.col(id_field).cast("string"), number) if id_field in kinds else number
    subset = subset_name(parse_meta(F.col(meta_field), kinds[meta_field])) if meta_field in kinds else F.lit(None).cast("string")
    out = rows.select(text.alias("text"), doc_id.alias("doc_id"), subset.alias("subset"))
    return out.where(not_empty(F.col("text"))).withColumn("domain", coarse_domain(F.col("subset"), mapping or {}, default_domain))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names a file, by Spark's own file system layer."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target))


JSON_SCHEMA = "text string, meta string, id string"


def read_jsonl(spark: SparkSession, path: str, *, strict: bool = False, schema: str | None = None, **options: Any) -> DataFrame:
    """Documents of JSON lines; blank and malformed lines are skipped, or raise where strict. meta may be an object or a string."""
    if not path:
        raise ValueError("a local source needs a path")
    fields = schema or ", ".join(dict.fromkeys([f"`{options.get('text_field', 'text')}` string", "`text` string", f"`{options.get('meta_field', 'meta')}` string", f"`{options.get('id_field', 'id')}` string"]))
    if not exists(spark, path):
        raise FileNotFoundError(f"no input at {path}")
    rows = spark.read.schema(fields).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")
    return as_documents(rows, **options)


def read_parquet(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    return as_documents(with_retries(lambda: spark.read.parquet(path), passing=is_passing_stream_error), **options)


def stream_jsonl(spark: SparkSession, folder: str, **options: Any) -> DataFrame:
    """Documents of a growing folder of JSON lines, as a stream."""
    return as_documents(spark.readStream.schema(JSON_SCHEMA).json(folder, mode="DROPMALFORMED"), **options)


def read_documents(spark: SparkSession, cfg: dict[str, Any]) -> DataFrame:
    """Factory by cfg["source"]: local reads JSON lines, anything else Parquet shards; shuffles and shards if asked to."""
    options = {k: cfg[k] for k in ("text_field", "meta_field") if cfg.get(k)} | {"mapping": cfg.get("pile_subset_to_domain") or {}, "default_domain": cfg.get("default_coarse_domain") or "web"}
    if cfg.get("source") == "local":
        return read_jsonl(spark, cfg.get("local_jsonl_path") or "", **options)
    docs = read_parquet(spark, cfg.get("parquet_path") or "", **options)
    docs = docs if cfg.get("random_seed") is None else shuffled(docs, cfg["random_seed"])
    return sharded(docs, int(cfg.get("stream_num_shards") or 1), int(cfg.get("stream_shard_index") or 0))


def shuffled(docs: DataFrame, seed: int, out: str = "seq") -> DataFrame:
    """Adds the order of a full, repeatable shuffle as a column; sorting by it is left to whoever needs the order."""
    return docs.withColumn(out, digest(seed, F.col("doc_id"), "seq"))


def sharded(docs: DataFrame, shards: int, index: int) -> DataFrame:
    """One of shards disjoint parts that together are all; a function of the id, so no position is counted."""
    if shards < 1 or not 0 <= index < shards:
        raise ValueError(f"shard {index} of {shards}")
    return docs if shards == 1 else docs.where(draw("shards", F.col("doc_id"), str(shards)) % shards == index)
