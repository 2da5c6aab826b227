"""Sources, sinks, pools, providers, quotas and plans."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textloom.config import BUCKETS, BuildConfig, QualityConfig
from textloom.operators import dedup, generation, pools, ranking, summary
from textloom.operators.generation import Reply
from textloom.plans import build
from textloom.sources import documents, sinks, state


def test_jsonl_source(spark, tmp_path):
    lines = ['{"text": "one", "id": 7, "meta": {"pile_set_name": "GitHub"}}', "", "{broken", '{"text": ""}', '{"text": "two", "meta": "{\\"subset\\": \\" Books3 \\"}"}', '{"text": "three", "meta": "nonsense"}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    rows = {r.text: r for r in documents.read_jsonl(spark, str(tmp_path), mapping={"Github": "code", "Books3": "books"}).collect()}
    assert set(rows) == {"one", "two", "three"}
    assert (rows["one"].doc_id, rows["one"].domain) == ("7", "code")
    assert (rows["two"].subset, rows["two"].domain) == ("Books3", "books")
    assert (rows["three"].subset, rows["three"].domain) == (None, "web")
    with pytest.raises(ValueError):
        documents.read_jsonl(spark, "")


def test_retries():
    calls, waits = [], []

    def opener():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("503 bad")
        return "open"

    assert documents.with_retries(opener, sleep=waits.append) == "open" and len(waits) == 2
    with pytest.raises(KeyError):
        documents.with_retries(lambda: {}["x"], sleep=waits.append)
    assert documents.is_passing_stream_error(FileNotFoundError("hf://x")) and not documents.is_passing_error(FileNotFoundError("x"))


def test_shards_are_a_partition(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    parts = [{r[0] for r in documents.sharded(df, 3, i).collect()} for i in range(3)]
    assert sum(map(len, parts)) == 100 and set.union(*parts) == set(range(100))
    with pytest.raises(ValueError):
        documents.sharded(df, 2, 2)


def test_pools():
    pool = pools.parse_pool([{"provider": "ollama", "model": "a", "weight": 0}, {"provider": "openai", "model": "b", "base_url": "http://x/"}, {"provider": "ollama", "model": "c", "weight": "?"}])
    assert [e.model for e in pool] == ["b", "c"]
    assert pools.remote_config({"use_azure": True}, pool[0]) == {"use_azure": False, "base_url": "http://x"}
    for bad in ({"provider": "x", "model": "a"}, {"provider": "ollama", "model": " "}, {"provider": "ollama", "model": "a", "weight": -1}, {"provider": "ollama", "model": "a", "openai_base_url": "u"}):
        with pytest.raises(ValueError):
            pools.parse_entry(bad)
    train, stress = pools.apply_phase(pool, [], "ollama_locked", "c")
    assert train == stress == [pool[1]]
    with pytest.raises(ValueError):
        pools.apply_phase(pool, [], "openai_only")
    assert pools.filter_for_phase([], "ollama_locked", "z", [])[0].model == "z"
    assert pools.drop_without_key({"openai": {"omit_if_no_api_key": True}}, pool, ready=lambda c: False) == [[pool[1]]]


def test_local_server_retries():
    seen = []

    def transport(url, body, headers, timeout):
        seen.append((url, body))
        return Reply(500, "no", {}) if len(seen) == 1 else Reply(200, json.dumps({"response": " hi "}), {})

    request = {"model": "m", "prompt": "p", "system": "s", "raw": True, "temperature": 0.5, "top_p": 1.0, "repeat_penalty": 1.0, "max_tokens": 9}
    got, meta = generation.LocalServer(["http://h"], transport=transport, sleep=lambda s: None).complete(request)
    assert got == "hi" and meta["provider"] == "ollama" and "system" not in seen[1][1]


def test_chat_server_rules(monkeypatch):
    monkeypatch.setenv("K", "secret")
    replies = [Reply(429, "", {"Retry-After": "500"}), Reply(400, "max_tokens is not it, use max_completion_tokens", {}), Reply(400, "temperature unsupported", {}), Reply(200, json.dumps({"choices": [{"message": {"content": "ok "}}]}), {})]
    bodies, waits = [], []

    def transport(url, body, headers, timeout):
        bodies.append(body)
        return replies[len(bodies) - 1]

    request = {"model": "m", "prompt": "p", "system": None, "temperature": 0.5, "top_p": 0.9, "max_tokens": 9}
    got, meta = generation.ChatServer({"api_key_env": "K"}, transport, waits.append).complete(request)
    assert got == "ok" and waits == [180.0] and meta["temperature"] == 1.0
    assert "max_completion_tokens" in bodies[2] and bodies[3]["temperature"] == 1.0
    monkeypatch.delenv("K")
    with pytest.raises(generation.NotConfigured):
        generation.ChatServer({"api_key_env": "K"}, transport).complete(request)
    assert generation.azure_url({"azure_endpoint": "http://a/", "azure_deployment": "d e"}).startswith("http://a/openai/deployments/d%20e/")
    assert generation.retry_after({"retry-after": "Thu, 01 Jan 1970 00:00:10 GMT"}, now=lambda: 4.0) == 6.0


def broken():
    """A provider that workers get by value: they can't import this test."""

    class Broken:
        def complete(self, request):
            if request["prompt"] == "bad":
                raise RuntimeError("no")
            return request["prompt"].upper(), {"provider": "offline"}

    return Broken()


def test_generate_keeps_failures_as_rows(spark):
    df = spark.createDataFrame([("offline", "m", p, "", False, 0.1, 0.2, 1.0, 5) for p in ("good", "bad")], "provider string, model string, prompt string, system string, raw boolean, temperature double, top_p double, repeat_penalty double, max_tokens int")
    rows = {r.prompt: r for r in generation.generate(df, broken()).collect()}
    assert rows["good"].completion == "GOOD" and rows["good"].error is None
    assert rows["bad"].completion is None and "no" in rows["bad"].error


def test_numbered_is_row_number(spark):
    df = spark.range(500).selectExpr("id", "id % 3 as k", "sha2(cast(id as string), 256) as o")
    got = {(r.k, r.id): r.n for r in ranking.numbered(df, ["k"], "o", "n").collect()}
    for k in range(3):
        rows = sorted((r.o, r.id) for r in df.where(F.col("k") == k).collect())
        assert [got[k, i] for _, i in rows] == list(range(1, len(rows) + 1))


def sequential(rows, targets):
    left, out = dict(targets), []
    for seq, order, ok in rows:
        bucket = next((b for b in order if left.get(b, 0) > 0), None)
        if bucket and ok[bucket]:
            left[bucket] -= 1
            out.append((seq, bucket))
    return out


@pytest.mark.parametrize("targets", [(5, 9, 3, 1), (0, 4, 4, 4), (500, 1, 1, 1)])
def test_quota_rounds_equal_the_sequential_loop(spark, targets):
    rng = random.Random(sum(targets))
    goal = dict(zip(BUCKETS, targets, strict=True))
    rows = [(f"{i:03x}", rng.sample(BUCKETS, 4), {b: rng.random() < 0.6 for b in BUCKETS}) for i in rng.sample(range(4096), 120)]
    df = spark.createDataFrame(rows, "seq string, buckets array<string>, ok map<string,boolean>")
    got = [(r.seq, r.bucket) for r in build.assign_quotas(df, goal).collect()]
    assert sorted(got) == sequential(sorted(rows), goal)


def test_dedup(spark):
    df = spark.createDataFrame([("b", "One  two"), ("a", "one two"), ("c", "three")], "seq string, t string")
    assert {r.seq for r in dedup.drop_duplicates(df, "t", "seq").collect()} == {"a", "c"}
    assert {r.seq for r in dedup.drop_duplicates(df, "t", "seq", False).collect()} == {"a", "b", "c"}
    earlier = spark.createDataFrame([("THREE",)], "base_text string")
    assert {r.seq for r in dedup.not_written(df, earlier, "t").collect()} == {"a", "b"}


SENTENCES = [f"Here the {w} walks along a quiet road with number {i} today." for i, w in enumerate("cat dog hen cow fox owl bee ant".split())]


def corpus(spark, n=40):
    rows = [(" ".join(SENTENCES[i % 8 :] + SENTENCES[: i % 8] + [f"Ending {i} is told here once more."]), str(i), "s", "web") for i in range(n)]
    return spark.createDataFrame(rows, "text string, doc_id string, subset string, domain string")


CFG = BuildConfig(quality=QualityConfig(word_count_min=10, word_count_max=300, min_sentences=2, max_line_repetition=0.9, max_non_alnum_ratio=0.5, ai_prefix_overlap_max=0.99))


def test_pairs(spark):
    rows = build.build_pairs(corpus(spark), CFG).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.source_doc_id, []).append(r)
        assert r.label_int == (0 if r.sample_kind == "human" else 1) and r.num_words == len(r.final_text.split())
    assert rows and all(sorted(x.sample_kind for x in g) == ["direct_ai", "human"] and len({x.split for x in g}) == 1 for g in by_doc.values())
    assert len({r.id for r in rows}) == len(rows)
    assert all(r.base_text.startswith(r.prompt_text) for r in rows if r.sample_kind == "direct_ai")
    again = build.build_pairs(corpus(spark).repartition(7), CFG).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_quotas_all_kinds_and_provider(spark):
    from dataclasses import replace

    rows = build.build_quotas(corpus(spark), replace(CFG, sample_targets=dict.fromkeys(BUCKETS, 2), dedup_normalize_text=False)).collect()
    assert {r.sample_kind for r in rows} == set(BUCKETS)
    assert all("\n\n" in r.base_text and r.mixed_joiner for r in rows if r.sample_kind == "mixed")
    assert build.build_quotas(corpus(spark, 6), replace(CFG, sample_targets=dict.fromkeys(BUCKETS, 1)), provider=broken()).count() >= 1


def test_empty_input(spark):
    assert build.build_pairs(corpus(spark).where("false"), CFG).count() == 0


def test_write_append_and_state(spark, tmp_path):
    out = str(tmp_path / "o")
    rows = build.build_pairs(corpus(spark), CFG)
    sinks.write_jsonl(rows, out, "by_label")
    back = state.read_output(spark, out)
    assert back.count() == rows.count()
    assert state.written_hashes(back).count() == rows.select("original_text_hash").distinct().count()
    assert {r.split: r.last for r in state.last_ids(back).collect()} == {r[0]: r[1] for r in rows.groupBy("split").count().collect()}
    assert build.build_pairs(corpus(spark), CFG, earlier=back).count() == 0
    sinks.save_counts(tmp_path / "c.json", {"human": 3}, None)
    assert state.load_counts(tmp_path / "c.json") == {"human": 3, "direct_ai": 0, "hard_ai": 0, "mixed": 0} and state.load_counts(tmp_path / "none") is None
    s = summary.summarize(rows.withColumn("every", F.lit(1)), ["every"]).first()
    assert s.num_human == s.num_ai and s.label_balance_ai_share == 0.5 and s.domains == {"web": 1.0}
    with sinks.output_lock(tmp_path / "l"):
        pass


def test_requests_are_few_more_than_pairs(spark):
    from dataclasses import replace

    report = build.Report()
    rows = build.build_pairs(corpus(spark, 600), replace(CFG, num_pairs=5), report=report).collect()
    assert len(rows) == 10 and report.rows == {"human": 5, "direct_ai": 5}
    assert report.requests <= 40 and report.documents <= 60
    report = build.Report()
    targets = {"human": 60, "direct_ai": 1, "hard_ai": 1, "mixed": 1}
    rows = build.build_quotas(corpus(spark, 600), replace(CFG, sample_targets=targets), report=report).collect()
    assert report.rows == targets and len(rows) == 63 and report.requests <= 60


def test_quota_mode_equals_the_sequential_loop(spark):
    """Against a loop over all documents in order: the turn's bucket, new texts only, targets less what is written, refilled after duplicates."""
    from dataclasses import replace

    cfg = replace(CFG, sample_targets={"human": 14, "direct_ai": 9, "hard_ai": 6, "mixed": 12}, dedup_normalize_text=False, augment=build.BuildConfig().augment.__class__(1.0, 0.0, 1.0, 0.0))
    docs = corpus(spark, 60)
    docs = docs.unionAll(docs.where("doc_id % 3 = 0").withColumn("doc_id", F.concat(F.lit("copy"), "doc_id")))
    done = {"human": 4, "direct_ai": 9}
    got = build.build_quotas(docs, cfg, counts=done).collect()
    part = build.prepare(build.Feed(docs, cfg).docs, cfg).withColumn("buckets", build.sampling.bucket_order(cfg.random_seed, F.col("doc_id")))
    made = {b: {r.seq: r for r in build._of_bucket(part.withColumn("bucket", F.lit(b)), b, cfg, build.OFFLINE, [], build.OFFLINE, None).collect()} for b in BUCKETS}
    left, seen, want = {b: cfg.sample_targets[b] - done.get(b, 0) for b in BUCKETS}, set(), []
    for r in sorted(part.select("seq", "buckets").collect()):
        bucket = next((b for b in r.buckets if left[b] > 0), None)
        m = made[bucket].get(r.seq) if bucket else None
        if m and m.ok and m.hash not in seen:
            seen.add(m.hash)
            left[bucket] -= 1
            want.append((m.r.source_doc_id, bucket))
    assert sorted((r.source_doc_id, r.sample_kind) for r in got) == sorted(want) and not any(left.values())
    assert len({r.original_text_hash for r in got}) == len(got) == len({r.id for r in got})


def test_repeated_documents_give_one_record(spark):
    """Rows without an id that share a text share a name."""
    rows = [r.text for r in corpus(spark, 8).collect()] * 3
    docs = documents.as_documents(spark.createDataFrame([(t,) for t in rows], "text string").repartition(5))
    report = build.Report()
    got = build.build_pairs(docs, CFG, report=report).collect()
    assert len({r.id for r in got}) == len(got) == 2 * len({r.source_doc_id for r in got}) and report.requests <= 8


def test_a_copy_is_asked_for_where_the_first_fails(spark):
    rows = [(" ".join(SENTENCES), str(i), "s", "web") for i in range(12)]
    docs = spark.createDataFrame(rows, "text string, doc_id string, subset string, domain string")
    got = build.build_pairs(docs, CFG).collect()
    assert {r.sample_kind for r in got} == {"human", "direct_ai"}
    texts = [r.original_text_hash for r in got]
    assert len(texts) == len(set(texts))


def test_domains_are_balanced_in_both_modes(spark):
    from dataclasses import replace

    rows = [(f"{r.text} Number {r.doc_id} is here.", r.doc_id, "s", "web" if int(r.doc_id) % 10 else "books") for r in corpus(spark, 500).collect()]
    docs = spark.createDataFrame(rows, "text string, doc_id string, subset string, domain string")
    cfg = replace(CFG, domain_quotas={"web": 0.5, "books": 0.5})
    plain = build.build_pairs(docs, replace(cfg, skip_ai=True, num_pairs=90, domain_quotas={}))
    held = build.build_pairs(docs, replace(cfg, skip_ai=True, num_pairs=90))
    quota = build.build_quotas(docs, replace(cfg, sample_targets={"human": 90, "direct_ai": 0, "hard_ai": 0, "mixed": 0}))
    share = lambda df: (lambda c: c["books"] / sum(c.values()))({r[0]: r[1] for r in df.groupBy("domain").count().collect()})
    assert share(plain) < 0.18 and min(share(held), share(quota)) > 0.19
    assert held.count() == quota.count() == 90


def test_preflight_and_configuration_errors(spark, monkeypatch, tmp_path):
    from textloom.config import load_env

    monkeypatch.delenv("NO_SUCH_KEY", raising=False)
    entry = pools.Entry("openai", "m", 1.0, None, "NO_SUCH_KEY")
    with pytest.raises(ValueError, match="credentials"):
        pools.assert_configured([[entry]], {}, ready=generation.is_ready, reach=lambda: None)
    with pytest.raises(generation.Unreachable):
        pools.assert_configured([[pools.Entry("ollama", "m")]], {}, ready=generation.is_ready, reach=lambda: generation.assert_reachable(["http://h"], transport=lambda *a: Reply(500, "", {})))
    with pytest.raises(Exception, match="NO_SUCH_KEY is not set"):
        build.build_pairs(corpus(spark, 5), CFG, train=[entry], provider=generation.Router([entry])).count()
    (tmp_path / ".env").write_text("# keys\nexport A_KEY_X='a b'\nNO_SUCH_KEY=1 # note\nbroken line\n")
    monkeypatch.setenv("A_KEY_X", "kept")
    assert load_env(tmp_path / ".env") == {"A_KEY_X": "kept", "NO_SUCH_KEY": "1"} and load_env(tmp_path / "none") == {}
    assert generation.Router([entry]).settings["NO_SUCH_KEY"] == "1"


def test_ids_without_an_id_field_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(f"text {i}",) for i in range(20)], "text string")
    ids = [{(r.text, r.doc_id) for r in documents.as_documents(rows.repartition(n)).collect()} for n in (1, 7)]
    assert ids[0] == ids[1] and len({i for _, i in ids[0]}) == 20
    with pytest.raises(FileNotFoundError):
        documents.read_jsonl(spark, "/no/such/file.jsonl")


def test_shards_go_on_after_broken_connections(spark, tmp_path):
    import gzip

    from textloom.sources import shards

    (tmp_path / "a.jsonl").write_text("".join(f'{{"text": "row {i}"}}\n' for i in range(50)))
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(b'{"text": "packed"}\n'))
    failures = []

    class Broken:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def __iter__(self):
            for k, line in enumerate(self.f):
                if k == 10 * (len(failures) + 1) and len(failures) < 3:
                    failures.append(k)
                    raise OSError("connection reset by peer")
                yield line

    waits = []
    got = list(shards.lines_of(str(tmp_path / "a.jsonl"), lambda u: Broken(open(u, "rb")), 2, 1.0, 4.0, waits.append))
    assert len(got) == 50 == len(set(got)) and len(failures) == 3 == len(waits)
    with pytest.raises(PermissionError):
        list(shards.lines_of("x", lambda u: (_ for _ in ()).throw(PermissionError("no")), 2, 1.0, 4.0, waits.append))
    rows = shards.read_shards(spark, [f"file://{tmp_path}/a.jsonl", f"file://{tmp_path}/b.jsonl.gz"])
    docs = documents.as_documents(rows.select(F.from_json("value", "text string").alias("v"), "shard").select("v.text"))
    assert {r.text for r in docs.collect()} == {f"row {i}" for i in range(50)} | {"packed"}


def test_another_sentence_splitter(spark):
    from dataclasses import replace

    from textloom.functions import text

    df = spark.createDataFrame([("a|b| |c",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(text.splitter("test_texts:bars")(F.col("t"))).collect()] == [["a", "b", "c"], [], []]
    with pytest.raises(ValueError):
        text.splitter("test_texts:nothing")
    with pytest.raises(ValueError):
        text.splitter("str")
    assert build.build_pairs(corpus(spark, 10), replace(CFG, skip_ai=True, sentence_splitter="test_texts:by_dots")).count() > 0


def test_merged_outputs_have_dense_ids(spark):
    make = lambda n, s: spark.createDataFrame([(f"row_{s}_{i:06d}", f"{n}{i}") for i in range(1, n + 1)], "id string, base_text string")
    got = sinks.merge_outputs([make(5, "train"), make(3, "train"), make(2, "val")], "all").collect()
    assert {r.id for r in got} == {f"all_train_{i:06d}" for i in range(1, 9)} | {"all_val_000001", "all_val_000002"} and len({r.base_text for r in got}) == 10
