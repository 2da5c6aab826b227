"""Command line and streaming runs from end to end, and the driver contract."""

import json

from test_texts import sentences_of

from textloom import cli
from textloom.config import BuildConfig, QualityConfig
from textloom.sources import documents, state
from textloom.streaming import pipeline

QUALITY = {"word_count_min": 10, "word_count_max": 300, "min_sentences": 2, "max_line_repetition": 0.9, "max_non_alnum_ratio": 0.5, "ai_prefix_overlap_max": 0.99}


def write(path, ids):
    path.write_text("\n".join(json.dumps({"text": sentences_of(i), "id": str(i), "meta": {"subset": "Books"}}) for i in ids))


def test_cli_builds_and_appends(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/generation.yaml").write_text(json.dumps(QUALITY))
    (tmp_path / "c/datasets.yaml").write_text(json.dumps({"output_layout": "by_label", "pile_subset_to_domain": {"books": "books"}}))
    write(tmp_path / "a.jsonl", range(12))
    args = ["--config", str(tmp_path / "c"), "--input", str(tmp_path / "a.jsonl"), "--output", str(tmp_path / "o"), "--offline"]
    first = cli.main(args, spark)
    assert first["counts"]["human"] == first["counts"]["direct_ai"] > 0
    assert {f["file"].split("/")[0] for f in first["files"]} == {"human", "ai"} and first["files"][0]["domains"] == {"books": 1.0}
    write(tmp_path / "a.jsonl", range(20))
    again = cli.main([*args, "--append"], spark)
    assert again["counts"]["human"] > first["counts"]["human"]
    ids = [r.id for r in state.read_output(spark, str(tmp_path / "o/records")).collect()]
    assert len(set(ids)) == len(ids)


def test_stream_appends_each_batch_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    cfg = BuildConfig(quality=QualityConfig(**QUALITY), skip_ai=True)
    for part in (range(6), range(3, 12)):
        write(tmp_path / f"in/{part.start}.json", part)
        docs = documents.stream_jsonl(spark, str(tmp_path / "in"))
        pipeline.stream_build(docs, str(tmp_path / "out"), str(tmp_path / "ck"), cfg).trigger(availableNow=True).start().awaitTermination()
    rows = state.read_output(spark, str(tmp_path / "out")).collect()
    assert len({r.original_text_hash for r in rows}) == len(rows) == len({r.id for r in rows}) >= 8


def test_entry_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "build_dataset" in e.queries()
