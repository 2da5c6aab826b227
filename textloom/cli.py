"""Command line: build a dataset from JSON lines or Parquet, and print its statistics."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from textloom.config import BUCKETS, load_config, load_env, load_yaml
from textloom.operators import pools, summary
from textloom.operators.generation import NotConfigured, Router, Unreachable, assert_reachable, is_ready
from textloom.plans.build import OFFLINE, Report, build
from textloom.sources import documents, sinks, state


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="textloom", description=__doc__)
    p.add_argument("--config", required=True, help="folder of datasets.yaml, generation.yaml, augmentation.yaml, models.yaml")
    p.add_argument("--input", required=True, help="JSON lines (.jsonl, .json) or Parquet")
    p.add_argument("--output", required=True)
    p.add_argument("--num-pairs", type=int)
    p.add_argument("--max-documents", type=int)
    p.add_argument("--stress-fraction", type=float)
    p.add_argument("--seed", type=int)
    p.add_argument("--skip-ai", action="store_true")
    p.add_argument("--append", action="store_true")
    p.add_argument("--offline", action="store_true", help="use the deterministic stand-in instead of model servers")
    p.add_argument("--phase", default="all", choices=pools.PHASES)
    p.add_argument("--phase-model")
    p.add_argument("--urls", help="comma-separated local servers")
    p.add_argument("--url", help="one local server; --urls wins")
    p.add_argument("--env", help="file of NAME=value lines; by default .env beside the configuration folder")
    p.add_argument("--skip-preflight", action="store_true", help="don't ask servers and credentials before the build")
    p.add_argument("--num-shards", type=int)
    p.add_argument("--shard-index", type=int)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = parser()
    a = p.parse_args(argv)
    if (a.num_shards is None) != (a.shard_index is None):
        p.error("--num-shards and --shard-index go together")
    load_env(a.env or f"{a.config}/../.env")
    cfg = load_config(a.config)
    changes = {"num_pairs": a.num_pairs, "max_documents_scan": a.max_documents, "stress_fraction": a.stress_fraction, "random_seed": a.seed, "skip_ai": a.skip_ai or None}
    cfg = replace(cfg, **{k: v for k, v in changes.items() if v is not None})
    spark = spark or SparkSession.builder.appName("textloom").getOrCreate()
    options = {"mapping": cfg.subset_to_domain, "default_domain": cfg.default_coarse_domain}
    docs = documents.read_jsonl(spark, a.input, **options) if a.input.endswith((".jsonl", ".json")) else documents.read_parquet(spark, a.input, **options)
    if a.num_shards is not None:
        docs = documents.sharded(docs, a.num_shards, a.shard_index)
    more: dict = {}
    if not (a.offline or cfg.skip_ai):
        models = load_yaml(f"{a.config}/models.yaml")
        train, stress = pools.drop_without_key(models, pools.train_pool(models), pools.stress_pool(models), ready=is_ready)
        train, stress = pools.apply_phase(train, stress, a.phase, a.phase_model)
        rewriters = pools.filter_for_phase(pools.rewrite_pool(models), a.phase, a.phase_model, train)
        hosts = pools.local_urls(models, url=a.url, urls=(a.urls or "").split(","))
        if not a.skip_preflight:
            pools.assert_configured([train, stress, rewriters if cfg.sample_targets else []], models, ready=is_ready, reach=lambda: assert_reachable(hosts))
        more = {"train": train, "stress": stress, "rewriters": rewriters, "provider": Router([*train, *stress, *rewriters], models, hosts)}
    else:
        more = {"train": OFFLINE}
    before = {}
    if a.append:
        earlier = state.read_output(spark, f"{a.output}/records")
        before = {r.sample_kind: r.n for r in summary.bucket_counts(earlier).collect()}
        more |= {"earlier": earlier, "offsets": state.last_ids(earlier), "counts": before}
    report = Report()
    with sinks.output_lock(a.output) if "://" not in a.output else _nothing():
        sinks.write_jsonl(build(docs, cfg, report=report, **more), f"{a.output}/records", cfg.output_layout, a.append)
        records = state.read_output(spark, f"{a.output}/records")
        counts = {r.sample_kind: r.n for r in summary.bucket_counts(records).collect()}
        rows = {k: counts.get(k, 0) - before.get(k, 0) for k in BUCKETS}
        stats = {
            "num_pairs_target": cfg.num_pairs, "pairs_written": None if cfg.sample_targets else rows["human"], "human_rows_written": rows["human"],
            "ai_rows_written": rows["direct_ai"] + rows["hard_ai"], "mixed_rows_written": rows["mixed"], "use_sample_quotas": cfg.sample_targets is not None,
            "targets": cfg.sample_targets, "counts": counts, "layout": cfg.output_layout, "documents_seen": report.documents,
            "split_documents": report.split_documents, "requests": report.requests, "parts": report.parts, "domains": dict(report.domains), "dedup_normalize_text": cfg.dedup_normalize_text,
            "files": [r.asDict(True) for r in summary.summarize(records.withColumn("file", F.concat_ws("/", sinks.side(F.col("sample_kind")), F.regexp_extract("id", state.ID, 1))), ["file"]).collect()],
        }
        sinks.save_counts(f"{a.output}/counts.json", counts, cfg.sample_targets)
        sinks.write_json(f"{a.output}/build_stats.json", stats)
    return stats


def run(argv: list[str] | None = None) -> int:
    """main() with the errors of configuration, input and servers as one line and exit code 2."""
    try:
        main(argv)
    except (NotConfigured, Unreachable, sinks.Locked, FileNotFoundError, ValueError) as e:
        print(f"textloom: {e}", file=sys.stderr)
        return 2
    return 0


class _nothing:
    def __enter__(self) -> None: ...

    def __exit__(self, *_: object) -> None: ...


if __name__ == "__main__":
    sys.exit(run())
