"""Queries over the driver's tables, by name, and their SQL twins.

The tables' documents are already clean, so queries about cleaning put dirt into them first, in the query as in its twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import BUCKETS, BuildConfig, QualityConfig, SampleConfig
from textloom.functions import metrics, noise, text
from textloom.functions.hashing import SPAN, digest, draw, sql_digest, sql_draw, uniform
from textloom.operators import dedup, generation, pools, ranking, sampling, summary
from textloom.operators.filters import is_garbage, not_empty, quality_reason
from textloom.plans import build
from textloom.sources import documents as sources
from textloom.sources import sinks, state

SEED = 42
DOMAINS = {f"src{i}": d for i, d in enumerate(("web", "web", "academic", "code", "legal", "medical", "books", "web", "academic", "financial", "books", "web", "legal", "medical", "code"))}
QUOTAS = {"web": 0.2, "academic": 0.2, "code": 0.1, "legal": 0.1, "medical": 0.1, "financial": 0.1, "books": 0.2}
QUALITY = QualityConfig(word_count_min=48, word_count_max=420, min_sentences=2, max_non_alnum_ratio=0.30, max_line_repetition=0.52, ai_prefix_overlap_max=0.94, list_heavy_max_ratio=0.65, code_heavy_word_threshold=0)
POOL = [pools.Entry("ollama", "small:text", 3.0), pools.Entry("ollama", "medium", 2.0), pools.Entry("openai", "remote", 1.0)]
PLAIN = BuildConfig(quality=QUALITY, skip_ai=True, augment=build.BuildConfig().augment.__class__(1.0, 0.0, 1.0, 0.0), subset_to_domain=DOMAINS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").where(not_empty(F.col("text")))


def _corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a source gives them: text, doc_id, subset, domain."""
    return sources.as_documents(_table(spark, folder, "documents").withColumn("meta", F.create_map(F.lit("subset"), F.col("source"))), id_field="doc_id", mapping=DOMAINS)


def _sents(t: str) -> str:
    return rf"list_filter(list_transform(string_split_regex(regexp_replace({t}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"


def _words(t: str) -> str:
    return rf"list_filter(string_split_regex({t}, '\s+'), lambda w: w <> '')"


def _strip(t: str) -> str:
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


def _alpha(t: str) -> str:
    return rf"(length(regexp_replace({t}, '[^\p{{L}}\s]', '', 'g'))::double / greatest(length({t}), 1))"


def _count(t: str, piece: str) -> str:
    return f"((length({t}) - length(replace({t}, '{piece}', ''))) // {len(piece)})"


_D = "d as (select doc_id, text, source, lang from documents where text is not null and text <> '')"
_S = f"{_D}, s as (select *, {_sents('text')} as sents from d)"
_MARKERS = " + ".join(_count("j", m) for m in metrics.GARBAGE_MARKERS)
_GARBAGE = f"(len(sents) < 4 or length(j) < 200 or {_alpha('j')} < 0.55 or ({_MARKERS} > 12 and {_alpha('j')} < 0.65))"
_NON_ALNUM = r"(length(regexp_replace(t, '[\p{L}\p{N}\s]', '', 'g'))::double / length(t))"
_REPEAT = f"(case when len({_words('lower(t)')}) < 10 then 0.0 else 1 - len(list_distinct({_words('lower(t)')}))::double / len({_words('lower(t)')}) end)"
_LINES = f"list_filter(list_transform(string_split(t, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"
_BULLET = rf"(case when len({_LINES}) > 5 then len(list_filter({_LINES}, lambda x: regexp_matches(x, '^(-|\*|•|1\.|2\.|3\.)')))::double / len({_LINES}) else 0.0 end)"


def _u(purpose: str, key: str = "doc_id") -> str:
    return f"({sql_draw(SEED, key, purpose)} / {float(SPAN)!r}::double)"


def _randint(purpose: str, low: str, high: str) -> str:
    return f"(({low}) + {sql_draw(SEED, 'doc_id', purpose)} % (({high}) - ({low}) + 1))"


def _reason(cfg: QualityConfig, longest: str | None = None, last: str = "") -> str:
    return rf"""case when t = '' then 'empty' when len({_words("t")}) < {cfg.word_count_min} then 'too_short' when len({_words("t")}) > {longest or cfg.word_count_max} then 'too_long'
  when len({_sents("t")}) < {cfg.min_sentences} then 'too_few_sentences' when {_NON_ALNUM} > {cfg.max_non_alnum_ratio}::double then 'too_many_symbols'
  when {_REPEAT} > {cfg.max_line_repetition}::double then 'repetitive' when {_BULLET} > {cfg.list_heavy_max_ratio}::double then 'list_heavy'
  when regexp_matches(({_LINES})[1], '(?i)^(sure[,! ]|here is|here''s|as an ai|i''m an ai|i cannot|#+ |\*\s)') then 'assistant_boilerplate' {last} else 'ok' end"""


_SPLIT = f"case when {_u('stress')} < 0.05 then 'stress' when {_u('split')} < 0.8 then 'train' when {_u('split')} < {0.8 + 0.1!r}::double then 'val' else 'test' end"
_LOW = lambda lo: f"greatest(1, least({lo}, len(sents)))"
_SPAN_LEN = _randint("span:length", _LOW(4), f"greatest({_LOW(4)}, least(8, len(sents)))")
_PREFIX_LEN = _randint("prefix", _LOW(2), f"greatest({_LOW(2)}, least(4, len(sents)))")


# --- scalar functions -------------------------------------------------------------------------------------------------
@query(rf"""with {_D} select doc_id, {_strip("regexp_replace(regexp_replace(regexp_replace(replace(chr(0) || ' ' || chr(9) || replace(text, ' ', '  ') || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10) || 'end ', chr(0), ''), '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")} as cleaned from d""")
def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    dirty = F.concat(F.lit("\0 \t"), F.replace(F.col("text"), F.lit(" "), F.lit("  ")), F.lit("\r\n\r\n\r\nend "))
    return _docs(spark, folder).select("doc_id", text.clean_text(dirty).alias("cleaned"))


@query(f"with {_S} select doc_id, len(sents)::int as n_sentences, sents[1] as first_sentence, sents[-1] as last_sentence from s")
def sentences(spark: SparkSession, folder: str) -> DataFrame:
    s = _docs(spark, folder).withColumn("sents", text.split_sentences(F.col("text")))
    return s.select("doc_id", text.count_sentences(F.col("sents")).alias("n_sentences"), F.element_at("sents", 1).alias("first_sentence"), F.element_at("sents", -1).alias("last_sentence"))


@query(rf"with {_D} select doc_id, len({_words('text')})::int as n_words, sha256(text) as text_sha256, sha256(regexp_replace({_strip('lower(text)')}, '\s+', ' ', 'g')) as normalized_sha256 from d")
def text_hashes(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, folder).select("doc_id", text.word_count(t).alias("n_words"), text.text_hash(t).alias("text_sha256"), text.normalized_hash(t).alias("normalized_sha256"))


@query(f"with {_D}, x as (select doc_id, text as t, text as j from d) select doc_id, {_NON_ALNUM} as non_alnum, {_REPEAT}::double as repetition, {_alpha('t')} as alpha, ({_MARKERS})::int as markers, ({' + '.join(_count('t', m) for m in metrics.CODE_MARKERS)})::int as code_hits, {_BULLET}::double as bullets from x")
def text_metrics(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, folder).select("doc_id", metrics.non_alnum_ratio(t).alias("non_alnum"), metrics.repetition_score(t).alias("repetition"), metrics.alpha_ratio(t).alias("alpha"), metrics.marker_count(t).alias("markers"), metrics.code_hits(t).alias("code_hits"), metrics.bullet_ratio(t).alias("bullets"))


@query(f"with {_S}, p as (select doc_id, text, {_strip('sents[1]')} as prefix from s) select doc_id, case when len({_words('lower(text)')}) = 0 then 1.0 else 1 - len(list_filter({_words('lower(text)')}, lambda w: not list_contains({_words('lower(prefix)')}, w)))::double / len({_words('lower(text)')}) end as overlap from p")
def prefix_overlap(spark: SparkSession, folder: str) -> DataFrame:
    s = _docs(spark, folder).withColumn("prefix", F.get(text.split_sentences(F.col("text")), F.lit(0)))
    return s.select("doc_id", metrics.prefix_overlap(F.col("prefix"), F.col("text")).alias("overlap"))


@query(rf"""with {_S}, c as (select doc_id, 'Sure, here it is' || chr(10) || 'Here is the rest' || chr(10) || text || ' an end without' as raw from s),
t as (select doc_id, case when regexp_extract({_strip("raw")}, '(?s)^(.*[.!?][''"]?)(\s|$)', 1) = '' then {_strip("raw")} else {_strip("regexp_extract(" + _strip("raw") + r", '(?s)^(.*[.!?][''" + '"' + r"]?)(\s|$)', 1)")} end as cut from c),
b as (select doc_id, {_strip("array_to_string(string_split(cut, chr(10))[3:], chr(10))")} as body from t)
select doc_id, case when body = '' then 'A start' when list_contains([' ', chr(10), chr(9), '.', ',', ';', ':', '!', '?', '''', '"', ')', '}}', ']'], body[1]) then 'A start' || body else 'A start ' || body end as combined from b""")
def completions(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.concat(F.lit("Sure, here it is\nHere is the rest\n"), F.col("text"), F.lit(" an end without"))
    return _docs(spark, folder).select("doc_id", text.combine(F.lit("A start "), generation.post_process(raw)).alias("combined"))


@query(f"with {_S} select doc_id, array_to_string(list_reverse(sents[({_PREFIX_LEN} + 1)::bigint:({_PREFIX_LEN} + 3)::bigint]), ' ') as completion, array_to_string(list_concat(sents[2:], sents[1:1]), ' ') as rewrite from s")
def offline_generation(spark: SparkSession, folder: str) -> DataFrame:
    s = _docs(spark, folder).withColumn("sents", text.split_sentences(F.col("text")))
    return s.select("doc_id", generation.offline_completion(F.col("sents"), sampling.prefix_length(F.col("sents"), 2, 4, SEED, F.col("doc_id"))).alias("completion"), generation.offline_rewrite(F.col("text")).alias("rewrite"))


# --- sources, metadata ------------------------------------------------------------------------------------------------
_CASES = " ".join(f"when '{k}' then '{v}'" for k, v in DOMAINS.items())


@query(f"with {_D} select doc_id::varchar as doc_id, upper(source) as subset, coalesce(case lower(source) {_CASES} end, 'web') as domain, length(text)::int as n from d")
def parsed_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "documents").withColumn("meta", F.to_json(F.struct(F.concat(F.lit(" "), F.upper("source"), F.lit(" ")).alias("pile_set_name"))))
    return sources.as_documents(rows, id_field="doc_id", mapping=DOMAINS).select("doc_id", "subset", "domain", F.length("text").alias("n"))


@query("select event_id, list_sort(coalesce(json_keys(props), [])) as keys, coalesce(len(json_keys(props)), 0)::int as n_keys from events")
def parsed_properties(spark: SparkSession, folder: str) -> DataFrame:
    e = _table(spark, folder, "events").withColumn("m", sources.parse_meta(F.col("props"), "string"))
    return e.select("event_id", F.array_sort(F.map_keys("m")).alias("keys"), F.size("m").alias("n_keys"))


@query(f"with {_D} select doc_id, {sql_digest(SEED, 'doc_id', 'seq')} as seq from d")
def shuffled_documents(spark: SparkSession, folder: str) -> DataFrame:
    return sources.shuffled(_docs(spark, folder), SEED).select("doc_id", "seq")


@query(f"with {_D} select doc_id, ({sql_draw('shards', 'doc_id', '3')} % 3)::int as shard from d")
def sharded_documents(spark: SparkSession, folder: str) -> DataFrame:
    parts = [sources.sharded(_docs(spark, folder), 3, i).select("doc_id", F.lit(i).alias("shard")) for i in range(3)]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


# --- filters ----------------------------------------------------------------------------------------------------------
@query(f"with {_S}, x as (select *, array_to_string(sents, ' ') as j from s) select doc_id, {_GARBAGE} as garbage from x")
def garbage_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).withColumn("sents", text.split_sentences(F.col("text"))).select("doc_id", is_garbage(F.col("sents")).alias("garbage"))


@query(f"with {_D}, x as (select doc_id, {_strip('text')} as t from d) select doc_id, {_reason(QUALITY)} as reason from x")
def quality_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", quality_reason(F.col("text"), QUALITY).alias("reason"))


_STRICT = QualityConfig(code_heavy_word_threshold=0)


@query(f"with {_D}, x as (select doc_id, {_strip('text')} as t from d), r as (select {_reason(_STRICT)} as reason from x) select reason, count(*) as n from r group by reason")
def quality_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select(quality_reason(F.col("text"), _STRICT).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"""with {_D}, x as (select doc_id, coalesce(case source {_CASES} end, 'web') as domain, {sql_digest(SEED, 'doc_id', 'seq')} as seq from d),
n as (select *, row_number() over (partition by domain order by seq) as rn, (select count(*) from x) as total from x),
q as (select *, ceil(case domain {' '.join(f"when '{k}' then {1.12 * v!r}::double / {sum(QUOTAS.values())!r}::double" for k, v in QUOTAS.items())} end * total) as cap from n)
select doc_id, domain from q where rn <= cap or {_u('balance')} < 0.22""")
def balanced_domains(spark: SparkSession, folder: str) -> DataFrame:
    docs = _corpus(spark, folder).withColumn("seq", digest(SEED, F.col("doc_id"), "seq"))
    kept = ranking.domain_balanced(docs, "domain", "seq", QUOTAS, uniform(SEED, F.col("doc_id"), "balance"))
    return kept.select(F.col("doc_id").cast("long").alias("doc_id"), "domain")


# --- sampling ---------------------------------------------------------------------------------------------------------
@query(f"with {_D} select doc_id, {_SPLIT} as split from d")
def document_splits(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", sampling.assign_split(SEED, F.col("doc_id"), {"train": 0.8, "val": 0.1, "test": 0.1}, 0.05).alias("split"))


@query(f"with {_D}, x as (select {_SPLIT} as split from d) select split, count(*) as n from x group by split")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return document_splits(spark, folder).groupBy("split").agg(F.count("*").alias("n"))


_SPAN_CTE = f"p as (select *, {_SPAN_LEN} as size from s), q as (select *, {_randint('span:start', '0', 'greatest(len(sents) - size, 0)')} as i0 from p)"


@query(f"with {_S}, {_SPAN_CTE} select doc_id, i0::int as i0, (i0 + size)::int as i1, array_to_string(sents[i0 + 1:i0 + size], ' ') as span from q")
def human_spans(spark: SparkSession, folder: str) -> DataFrame:
    s = _docs(spark, folder).withColumn("sents", text.split_sentences(F.col("text"))).withColumn("s", sampling.sample_span(F.col("sents"), 4, 8, SEED, F.col("doc_id")))
    return s.select("doc_id", "s.i0", "s.i1", text.join_span(F.col("s.span")).alias("span"))


@query(f"with {_S} select doc_id, array_to_string(sents[1:{_PREFIX_LEN}::bigint], ' ') as prefix from s")
def prefixes(spark: SparkSession, folder: str) -> DataFrame:
    s = _docs(spark, folder).withColumn("sents", text.split_sentences(F.col("text")))
    return s.select("doc_id", sampling.prefix_span(F.col("sents"), 2, 4, SEED, F.col("doc_id")).alias("prefix"))


def _affine(purpose: str, lo: float, hi: float) -> str:
    return f"({lo!r}::double + {_u(purpose)} * {hi - lo!r}::double)"


@query(f"with {_D} select doc_id, {_affine('temperature', 0.3, 1.2)} as temperature, {_affine('top_p', 0.7, 1.0)} as top_p, {_randint('max_tokens', '80', '220')}::int as max_tokens, {_affine('repeat_penalty', 1.0, 1.2)} as repeat_penalty, {_affine('rewrite:temperature', 0.2, 0.65)} as rewrite_temperature, {_randint('rewrite:max_tokens', '120', '320')}::int as rewrite_max_tokens from d")
def generation_parameters(spark: SparkSession, folder: str) -> DataFrame:
    cfg = SampleConfig()
    p = _docs(spark, folder).withColumns({"p": sampling.generation_params(cfg, SEED, F.col("doc_id")), "r": sampling.rewrite_params(cfg, SEED, F.col("doc_id"))})
    return p.select("doc_id", "p.*", F.col("r.temperature").alias("rewrite_temperature"), F.col("r.max_tokens").alias("rewrite_max_tokens"))


@query(f"""with {_D}, pool(number, model, low, high) as (values (0, 'small:text', 0.0::double, 0.5::double), (1, 'medium', 0.5::double, {0.5 + 2 / 6!r}::double), (2, 'remote', {0.5 + 2 / 6!r}::double, 1.0::double)),
x as (select doc_id, {_u('generator')} as u from d) select doc_id, model from x join pool on (u > low or low = 0) and u <= high""")
def picked_generators(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder).select("doc_id", uniform(SEED, F.col("doc_id"), "generator").alias("u"))
    pool = F.broadcast(pools.as_frame(spark, POOL))  # a handful of rows by construction
    return docs.join(pool, ((F.col("u") > F.col("low")) | (F.col("low") == 0)) & (F.col("u") <= F.col("high"))).select("doc_id", "model")


@query(f"with {_D} select doc_id, (['formal', 'short', 'default'])[{sql_draw(SEED, 'doc_id', 'rewrite:style')} % 3 + 1] as style, (['a', 'b'])[{sql_draw(SEED, 'doc_id', 'host')} % 2 + 1] as host from d")
def rewrite_styles(spark: SparkSession, folder: str) -> DataFrame:
    cfg = SampleConfig(hard_transform_systems=({"name": "formal", "system": "x"}, {"name": "short", "system": "y"}, {"name": "blank", "system": " "}), hard_transform_system="z")
    key = F.col("doc_id")
    return _docs(spark, folder).select("doc_id", sampling.pick_style(cfg, SEED, key)["style"].alias("style"), sampling.pick_host(["a", "b"], SEED, key).alias("host"))


_ORDER = "list_transform(list_sort([" + ", ".join(f"{{'u': {sql_draw(SEED, 'doc_id', 'bucket:' + b)}, 'b': '{b}'}}" for b in BUCKETS) + "]), lambda x: x.b)"


@query(f"with {_D} select doc_id, {_ORDER}[1] as bucket from d")
def first_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.get(sampling.bucket_order(SEED, F.col("doc_id")), F.lit(0)).alias("bucket"))


@query(f"with {_D}, x as (select doc_id, {_ORDER}[1] as bucket, {sql_digest(SEED, 'doc_id', 'seq')} as seq from d), n as (select *, row_number() over (partition by bucket order by seq) as rn from x) select doc_id, bucket from n where rn <= 40")
def quota_rows(spark: SparkSession, folder: str) -> DataFrame:
    docs = sources.shuffled(_docs(spark, folder), SEED).withColumn("bucket", F.get(sampling.bucket_order(SEED, F.col("doc_id")), F.lit(0)))
    return ranking.first_rows(docs, ["bucket"], "seq", 40).select("doc_id", "bucket")


def _fill(source: str, targets: dict[str, int], ok: str, hash_: str = "null") -> str:
    """SQL of the sequential loop: source (doc_id, seq, buckets and what ok and hash_ need, by bucket b) in order of seq, a row at a time."""
    left = ", ".join(f"{n} as left_{b}" for b, n in targets.items())
    is_open = " or ".join(f"(x = '{b}' and left_{b} > 0)" for b in BUCKETS)
    take = ", ".join(f"left_{b} - (case when acc and b = '{b}' then 1 else 0 end)" for b in BUCKETS)
    return f"""o as materialized (select *, row_number() over (order by seq) as n from {source}),
loop as (select 0::bigint as n, {left}, []::varchar[] as seen, null::varchar as bucket
  union all select n, {take}, case when acc and name is not null then list_append(seen, name) else seen end, case when acc then b end
  from (select *, b is not null and coalesce(good, false) and (name is null or not list_contains(seen, name)) as acc
    from (select *, {ok} as good, ({hash_})::varchar as name
      from (select o.*, loop.* exclude (n, bucket), list_filter(o.buckets, lambda x: {is_open})[1] as b from loop join o on o.n = loop.n + 1)))),
taken as (select o.doc_id, o.seq, loop.bucket from loop join o using (n) where loop.bucket is not null)"""


_BY_BUCKET = lambda f: "case b " + " ".join(f"when '{b}' then {f(b)}" for b in BUCKETS) + " end"
_DRAWN = ", ".join(f"{sql_draw(SEED, 'doc_id', 'ok:' + b)} % 3 > 0 as ok_{b}" for b in BUCKETS)


@query(f"with recursive {_D}, x as (select doc_id, {sql_digest(SEED, 'doc_id', 'seq')} as seq, {_ORDER} as buckets, {_DRAWN} from d), {_fill('x', {'human': 60, 'direct_ai': 30, 'hard_ai': 20, 'mixed': 10}, _BY_BUCKET(lambda b: f'ok_{b}'))} select doc_id, bucket from taken")
def quota_assignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = sources.shuffled(_docs(spark, folder), SEED).withColumns({"buckets": sampling.bucket_order(SEED, F.col("doc_id")), "ok": F.create_map(*[x for b in BUCKETS for x in (F.lit(b), draw(SEED, F.col("doc_id"), f"ok:{b}") % 3 > 0)])})
    return build.assign_quotas(docs, {"human": 60, "direct_ai": 30, "hard_ai": 20, "mixed": 10}).select("doc_id", "bucket")


# --- dedup, ids, joins ------------------------------------------------------------------------------------------------
def _first(key: str) -> str:
    return f"with {_D}, x as (select doc_id, row_number() over (partition by {key} order by {sql_digest(SEED, 'doc_id', 'seq')}) as rn from d) select doc_id from x where rn = 1"


@query(_first("sha256(text)"))
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.drop_duplicates(sources.shuffled(_docs(spark, folder), SEED), "text", "seq", False).select("doc_id")


_NORM = rf"sha256(regexp_replace({_strip('lower(text)')}, '\s+', ' ', 'g'))"


@query(_first(_NORM))
def normalized_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.drop_duplicates(sources.shuffled(_docs(spark, folder), SEED), "text", "seq").select("doc_id")


_IDS = f"with {_D}, x as (select doc_id, {_SPLIT} as split, {sql_digest(SEED, 'doc_id', 'seq')} as seq from d), n as (select *, row_number() over (partition by split order by seq) + case split when 'val' then 100 else 0 end as rn from x)"


@query(f"{_IDS} select doc_id, 'row_' || split || '_' || lpad(rn::varchar, 6, '0') as id from n")
def dense_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = sources.shuffled(_docs(spark, folder), SEED).withColumn("split", sampling.assign_split(SEED, F.col("doc_id"), {"train": 0.8, "val": 0.1, "test": 0.1}, 0.05))
    last = spark.createDataFrame([("val", 100)], "split string, last long")
    return ranking.with_ids(docs, "split", "seq", "row", offsets=last).select("doc_id", "id")


@query(f"{_IDS} select split, max(rn)::bigint as last from n group by split")
def last_ids(spark: SparkSession, folder: str) -> DataFrame:
    return state.last_ids(dense_ids(spark, folder))


@query(f"with {_D}, x as (select doc_id, {sql_digest(SEED, 'doc_id', 'seq')} as seq from d) select doc_id from x order by seq limit 100")
def scan_limit(spark: SparkSession, folder: str) -> DataFrame:
    """The first documents of the seeded order (the limit is the feature)."""
    return ranking.first_rows(sources.shuffled(_docs(spark, folder), SEED), [], "seq", 100).select("doc_id")


# --- plans and summaries ----------------------------------------------------------------------------------------------
_HUMAN = f"""{_S}, g as (select *, array_to_string(sents, ' ') as j from s), k as (select * from g where not {_GARBAGE}),
p as (select *, {_SPAN_LEN} as size from k), q as (select *, {_randint('span:start', '0', 'greatest(len(sents) - size, 0)')} as i0 from p),
b as (select doc_id, source, array_to_string(sents[i0 + 1:i0 + size], ' ') as t, i0, i0 + size as i1, {_SPLIT} as split, {sql_digest(SEED, 'doc_id', 'seq')} as seq from q),
o as (select *, {_reason(QUALITY)} as reason from b), f as (select * from o where reason = 'ok'),
u as (select *, row_number() over (partition by sha256(regexp_replace({_strip('lower(t)')}, '\\s+', ' ', 'g')) order by seq) as copy from f),
n as (select *, row_number() over (partition by split order by seq) as rn from u where copy = 1)"""


@query(f"with {_HUMAN} select 'row_' || split || '_' || lpad(rn::varchar, 6, '0') as id, 'human' as label, 0 as label_int, doc_id::varchar as source_doc_id, coalesce(case source {_CASES} end, 'web') as domain, t as base_text, sha256(t) as original_text_hash, len({_sents('t')})::int as num_sentences, len({_words('t')})::int as num_words, i0::int as i0, i1::int as i1, split from n")
def human_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """The human-only plan, without noise."""
    rows = build.build_pairs(_corpus(spark, folder), PLAIN)
    return rows.select("id", "label", "label_int", "source_doc_id", "domain", "base_text", "original_text_hash", "num_sentences", "num_words", F.get("span_sentence_indices", F.lit(0)).alias("i0"), F.get("span_sentence_indices", F.lit(1)).alias("i1"), "split")


@query(f"with {_HUMAN} select doc_id from b where {_NORM.replace('text', 't')} not in (select {_NORM.replace('text', 't')} from n)")
def not_yet_written(spark: SparkSession, folder: str) -> DataFrame:
    """The documents whose human span the human-only plan did not write."""
    earlier = build.build_pairs(_corpus(spark, folder), PLAIN)
    spans = build.add_human(build.prepare(build.Feed(_corpus(spark, folder), PLAIN).docs, PLAIN), PLAIN)
    return dedup.not_written(spans, earlier, "h_base").select(F.col("doc_id").cast("long").alias("doc_id"))


def _trimmed(t: str) -> str:
    head = rf"""regexp_extract({_strip(t)}, '(?s)^(.*[.!?][''"]?)(\s|$)', 1)"""
    return f"(case when {head} = '' then {_strip(t)} else {_strip(head)} end)"


def _without_lead(t: str) -> str:
    lines = f"string_split({t}, chr(10))"
    at = rf"list_position(list_transform({lines}, lambda x: not regexp_matches({_strip('x')}, '(?i)^(sure[,! ]|here is|here''s|okay[,! ]|as an ai|i cannot|i''m an ai)')), true)"
    return f"(case when coalesce({at}, 0) > 0 then {_strip(f'array_to_string(({lines})[{at}:], chr(10))')} else '' end)"


def _overlap(t: str, prefix: str) -> str:
    return f"(case when len({_words(f'lower({t})')}) = 0 then 1.0 else 1 - len(list_filter({_words(f'lower({t})')}, lambda w: not list_contains({_words(f'lower({prefix})')}, w)))::double / len({_words(f'lower({t})')}) end)"


_SHORT = {"human": "h", "direct_ai": "a", "hard_ai": "r", "mixed": "m"}
_NORM_OF = lambda t: _NORM.replace("text", t)
_TIGHT = """list_contains([' ', chr(10), chr(9), '.', ',', ';', ':', '!', '?', '''', '"', ')', '}', ']'], body[1])"""
_LAST = f"when kind = 'a' and prefix <> '' and {_overlap('t', 'prefix')} > {QUALITY.ai_prefix_overlap_max}::double then 'ai_too_similar_to_prefix'"
#: The texts of all four kinds of each document worth sampling, with the first rule that each breaks; offline provider, no noise.
_KINDS = f"""{_S}, g as (select *, array_to_string(sents, ' ') as j from s), k as (select * from g where not {_GARBAGE}),
p as (select *, {_SPAN_LEN} as size, {_PREFIX_LEN} as pre from k), q as (select *, {_randint('span:start', '0', 'greatest(len(sents) - size, 0)')} as i0 from p),
w0 as (select doc_id, source, {_SPLIT} as split, {sql_digest(SEED, 'doc_id', 'seq')} as seq, {_ORDER} as buckets, array_to_string(sents[i0 + 1:i0 + size], ' ') as h,
  array_to_string(sents[1:pre::bigint], ' ') as prompt, array_to_string(list_reverse(sents[(pre + 1)::bigint:(pre + 3)::bigint]), ' ') as completion from q),
w1 as (select *, {_without_lead('cut')} as body from (select *, {_trimmed('completion')} as cut from w0)),
w2 as (select *, case when body = '' then prompt when prompt = '' or {_TIGHT} then prompt || body else prompt || ' ' || body end as a from w1),
w3 as (select *, {_sents('a')} as asents from w2),
w4 as (select *, {_without_lead('cut2')} as r from (select *, {_trimmed("array_to_string(list_concat(asents[2:], asents[1:1]), ' ')")} as cut2 from w3)),
w5 as (select *, h || chr(10) || chr(10) || a as m, {_strip('h')} || chr(10) || chr(10) || {_strip('a')} as m_final from w4),
long as (select doc_id, 'h' as kind, {_strip('h')} as t, null as prefix, 1000000 as n from w5 union all select doc_id, 'a', {_strip('a')}, prompt, len({_words('a')}) from w5
  union all select doc_id, 'r', {_strip('r')}, null, len({_words('r')}) from w5 union all select doc_id, 'm', {_strip('m_final')}, null, 1000000 from w5),
reasons as (select doc_id, kind, case when n < {QUALITY.word_count_min} then 'too_short' else {_reason(QUALITY, "(case kind when 'm' then 520 else 420 end)", _LAST)} end as reason from long),
ok as (select doc_id, max(reason) filter (kind = 'h') as h_reason, max(reason) filter (kind = 'a') as a_reason, max(reason) filter (kind = 'r') as r_reason, max(reason) filter (kind = 'm') as m_reason from reasons group by doc_id),
v as materialized (select *, h_reason = 'ok' as ok_human, prompt <> '' and a_reason = 'ok' as ok_direct_ai, prompt <> '' and a_reason <> 'too_short' and r_reason = 'ok' as ok_hard_ai, h_reason = 'ok' and prompt <> '' and a_reason = 'ok' and m_reason = 'ok' as ok_mixed from w5 join ok using (doc_id))"""


def _record_sql(kind: str, number: str) -> str:
    """SQL of the records of the rows of n."""
    base, final = {"human": ("h", "h"), "direct_ai": ("a", "a"), "hard_ai": ("r", "r"), "mixed": ("m", "m_final")}[kind]
    prompt = "null" if kind == "human" else "prompt"
    return f"select 'row_' || split || '_' || lpad(({number})::varchar, 6, '0') as id, '{'human' if kind == 'human' else 'ai'}' as label, '{kind}' as sample_kind, doc_id::varchar as source_doc_id, coalesce(case source {_CASES} end, 'web') as domain, {prompt} as prompt_text, {base} as base_text, {final} as final_text, len({_sents(final)})::int as num_sentences, len({_words(final)})::int as num_words, split, sha256({base}) as original_text_hash"


_SHOWN = ("id", "label", "sample_kind", "source_doc_id", "domain", "prompt_text", "base_text", "final_text", "num_sentences", "num_words", "split", "original_text_hash")


@query(f"""with {_KINDS}, f as (select * from v where ok_human and ok_direct_ai), c1 as (select *, row_number() over (partition by {_NORM_OF('h')} order by seq) as copy_h from f),
c2 as (select *, row_number() over (partition by {_NORM_OF('a')} order by seq) as copy_a from c1 where copy_h = 1), n as (select *, row_number() over (partition by split order by seq) as rn from c2 where copy_a = 1)
{_record_sql('human', '2 * rn - 1')} from n union all {_record_sql('direct_ai', '2 * rn')} from n""")
def pair_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """Pair mode with the offline provider, without noise: human and machine rows."""
    return build.build_pairs(_corpus(spark, folder), BuildConfig(quality=QUALITY, augment=PLAIN.augment, subset_to_domain=DOMAINS)).select(*_SHOWN)


@query()
def build_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """Pair mode with noise and the offline provider: human and machine rows."""
    cfg = BuildConfig(quality=QUALITY, augment=build.BuildConfig().augment.__class__(word_augs=("adjective_remove",)), subset_to_domain=DOMAINS)
    return build.build_pairs(_corpus(spark, folder), cfg)


_TARGETS = {"human": 60, "direct_ai": 40, "hard_ai": 30, "mixed": 20}


@query(f"""with recursive {_KINDS}, {_fill("v", _TARGETS, _BY_BUCKET(lambda b: f"ok_{b}"), _BY_BUCKET(lambda b: _NORM_OF(_SHORT[b])))},
n as (select v.*, taken.bucket, row_number() over (partition by v.split order by v.seq) as rn from taken join v using (doc_id))
{" union all ".join(f"{_record_sql(b, 'rn')} from n where bucket = '{b}'" for b in BUCKETS)}""")
def build_quota_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """Quota mode with all four kinds, without noise."""
    cfg = BuildConfig(quality=QUALITY, sample_targets=_TARGETS, augment=PLAIN.augment, subset_to_domain=DOMAINS)
    return build.build_quotas(_corpus(spark, folder), cfg).select(*_SHOWN)


@query()
def noised_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every kernel on every document."""
    docs = _docs(spark, folder).select("doc_id", "text").withColumn("kernel", F.explode(F.array(*map(F.lit, noise.KERNELS))))
    return noise.add_noise(docs, "text", F.col("kernel"), SEED, F.col("doc_id"), "noise", "noised").select("doc_id", "kernel", "noised")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations seen as records: the user's turns as human rows, all others as machine rows."""
    c = _table(spark, folder, "conversations").where("text is not null")
    human = F.col("role") == "user"
    return c.select(F.when(human, "human").otherwise("ai").alias("label"), F.when(human, "human").otherwise(F.when(F.col("turn") % 5 == 3, "mixed").otherwise("direct_ai")).alias("sample_kind"), F.col("role").alias("domain"), F.lit(None).cast("string").alias("generator_model"), F.col("role").alias("generator_provider"), F.col("text").alias("final_text"), F.when(F.col("turn") % 2 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("augmentation"), (F.col("conv_id") % 3).alias("part"), "conv_id", "turn")


_REC = f"c as (select case when role = 'user' then 'human' else 'ai' end as label, case when role = 'user' then 'human' when turn % 5 = 3 then 'mixed' else 'direct_ai' end as kind, role, text, turn % 2 = 0 as noised, turn <= 1 as early, conv_id % 3 as part, len({_words('text')})::double as nw, len({_sents('text')})::double as ns from conversations where text is not null)"


def _avg(c: str, label: str, d: int) -> str:
    return f"coalesce(round(avg(case when label = '{label}' then {c} end), {d}), 0.0)::double"


@query(f"""with {_REC} select part, count(*) filter (label = 'human') as num_human, count(*) filter (label = 'ai') as num_ai, count(*) filter (kind = 'mixed') as num_mixed,
{_avg('nw', 'human', 3)} as avg_words_human, {_avg('nw', 'ai', 3)} as avg_words_ai, {_avg('ns', 'human', 3)} as avg_sentences_human, {_avg('ns', 'ai', 3)} as avg_sentences_ai,
{_avg('noised::int', 'human', 4)} as augmentation_rate_human, {_avg('noised::int', 'ai', 4)} as augmentation_rate_ai,
round(count(*) filter (label = 'ai') / count(*)::double, 4) as label_balance_ai_share, round(count(*) filter (kind = 'mixed') / count(*)::double, 4) as label_balance_mixed_share from c group by part""")
def summaries(spark: SparkSession, folder: str) -> DataFrame:
    return summary.summarize(_records(spark, folder), ["part"]).drop("sample_kind_share", "domains", "generators", "generator_providers")


@query(f"with {_REC}, n as (select part, role as name, count(*) as k from c group by all), t as (select *, sum(k) over (partition by part) as total from n) select part, name, round(k / total::double, 4) as share from t")
def domain_shares(spark: SparkSession, folder: str) -> DataFrame:
    return summary.summarize(_records(spark, folder), ["part"]).select("part", F.explode("domains").alias("name", "share"))


@query(f"with {_REC}, n as (select role as name, count(*) as k from c where label = 'ai' group by all) select name, round(k / (select sum(k) from n)::double, 4) as share from n")
def provider_shares(spark: SparkSession, folder: str) -> DataFrame:
    return summary.summarize(_records(spark, folder).withColumn("all", F.lit(1)), ["all"]).select(F.explode("generator_providers").alias("name", "share"))


@query(f"with {_REC} select kind as sample_kind, count(*) as n from c group by kind")
def bucket_counts(spark: SparkSession, folder: str) -> DataFrame:
    return summary.bucket_counts(_records(spark, folder))


def _metric(m: str, e: str) -> str:
    return f"select '{m}' as metric, max(case part when 'a' then v end) as a, max(case part when 'b' then v end) as b from (select part, {e} as v from halves group by part)"


@query(f"with {_REC}, halves as (select * exclude (part), case when early then 'a' else 'b' end as part from c), m as ({' union all '.join(_metric(m, e) for m, e in (('avg_words_human', _avg('nw', 'human', 3)), ('avg_words_ai', _avg('nw', 'ai', 3)), ('avg_sentences_human', _avg('ns', 'human', 3)), ('avg_sentences_ai', _avg('ns', 'ai', 3)), ('label_balance_ai_share', "round(count(*) filter (label = 'ai') / count(*)::double, 4)")))}) select metric, a, b, round(a - b, 4) as diff from m")
def compared_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """The first two turns of all conversations against all later ones."""
    s = summary.summarize(_records(spark, folder).withColumn("part", F.when(F.col("turn") <= 1, "a").otherwise("b")), ["part"])
    return summary.compare(s.where("part = 'a'"), s.where("part = 'b'"))


@query("select kind as sample_kind, case when kind in ('human', 'mixed') then kind else 'ai' end as side, n from (select case when role = 'user' then 'human' when turn % 5 = 3 then 'mixed' else 'direct_ai' end as kind, count(*) as n from conversations where text is not null group by 1)")
def layout_sides(spark: SparkSession, folder: str) -> DataFrame:
    return summary.bucket_counts(_records(spark, folder)).select("sample_kind", sinks.side(F.col("sample_kind")).alias("side"), "n")
