"""Pair builds over tables with many copies of their texts, against a plain loop."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_engine import CFG, corpus

from textloom.config import AugmentConfig, SampleConfig
from textloom.functions.text import normalized_hash
from textloom.plans import build

PLAIN = replace(CFG, augment=AugmentConfig(1.0, 0.0, 1.0, 0.0), sample=SampleConfig(sentence_span_min=7, sentence_span_max=8))


class Picky:
    """Answers by the prompt; fails for documents that draw a high temperature."""

    def complete(self, request):
        if request["temperature"] > 0.8:
            raise RuntimeError("busy")
        return f"It goes on after {len(request['prompt'])} letters. And then it ends here at last.", {"provider": "offline"}


class Never:
    def complete(self, request):
        raise RuntimeError("busy")


def copies(spark, texts, times):
    """Each text under times ids."""
    return corpus(spark, texts).crossJoin(spark.range(times).withColumnRenamed("id", "copy")).withColumn("doc_id", F.concat_ws("-", "doc_id", "copy")).drop("copy").repartition(3)


def expected(docs, provider, cfg=PLAIN):
    """Pairs (doc, seq) in order: of each human text the first row that passes, of these of each machine text the first; and the requests of asking one by one."""
    human = build.cut(build.keep(build.add_human(build.prepare(build.Feed(docs, cfg).docs, cfg), cfg), F.col("h_reason") == "ok"))
    both = build.add_machine(human, cfg, build.OFFLINE, [], provider)
    rows = both.select("seq", "doc_id", normalized_hash(F.col("h_base")).alias("h"), normalized_hash(F.col("a_base")).alias("a"), "a_reason").collect()
    hs, machine, out, requests = set(), set(), [], 0
    for r in sorted(rows):
        requests += r.h not in hs
        if r.a_reason == "ok" and r.h not in hs:
            hs.add(r.h)
            if r.a not in machine:
                machine.add(r.a)
                out.append(r.doc_id)
    return out, requests, len(rows)


@pytest.mark.parametrize("provider", [None, Picky()])
def test_pairs_of_copies(spark, provider):
    """A pair whose machine text is taken gives its place to no copy of its human text, and an earlier one is not lost to a later one."""
    docs = copies(spark, 6, 12)
    want, requests, rows = expected(docs, provider)
    report = build.Report()
    got = build.build_pairs(docs, PLAIN, provider=provider, report=report).collect()
    assert sorted(r.source_doc_id for r in got if r.sample_kind == "human") == sorted(want) == sorted(r.source_doc_id for r in got if r.sample_kind == "direct_ai")
    assert len({r.id for r in got}) == len(got) and 0 < len(want) < rows / 2
    assert report.requests <= (rows if provider is None else 2 * requests) and report.rows == {"human": len(want), "direct_ai": len(want)}
    few = build.build_pairs(docs, replace(PLAIN, num_pairs=3), provider=provider).where("sample_kind = 'human'").collect()
    assert sorted(r.source_doc_id for r in few) == sorted(want[:3])


def test_copies_that_fail_are_asked_in_few_turns(spark):
    docs = copies(spark, 2, 30)
    report = build.Report()
    assert build.build_pairs(docs, PLAIN, provider=Never(), report=report).count() == 0
    assert report.requests == expected(docs, None)[2]


@pytest.mark.parametrize("provider", [None, Never()])
def test_jobs_do_not_grow_with_the_copies(spark, provider):
    jobs = []
    for times in (4, 32):
        spark.sparkContext.setJobGroup(f"copies-{times}-{provider is None}", "")
        build.build_pairs(copies(spark, 3, times), PLAIN, provider=provider).count()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"copies-{times}-{provider is None}")))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[1] <= (jobs[0] + 3 if provider is None else 3 * jobs[0]), jobs
