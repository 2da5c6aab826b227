"""Dataset plans: documents -> labelled records.

Pair mode gives a human and a machine row for each document of which both pass; quota mode gives one row for each document,
of the kind that its own order of kinds and the open targets choose. Stages only add columns; narrow columns decide which
documents are asked for machine text, a part of the documents at a time until limits and targets are met. A build runs
Spark jobs when it is called: parts and decisions are reliable checkpoints, and the result is a DataFrame over them."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textloom.config import BUCKETS, BuildConfig
from textloom.functions.hashing import digest, uniform
from textloom.functions.noise import augment
from textloom.functions.text import clean_text, combine, is_text_model, join_span, mixed_final, normalized_hash, split_sentences, splitter, text_hash, word_count
from textloom.operators import dedup, generation, ranking, sampling
from textloom.operators.filters import is_garbage, not_empty, quality_reason
from textloom.operators.pools import Entry
from textloom.sources.shared import cut


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """df.where(condition) over columns that are costly to compute: the row number is not deterministic, so the optimiser
    does not write the columns' expressions into the filter, where each of their inputs would be computed again."""
    return df.withColumn("__at", F.monotonically_increasing_id()).where(condition & (F.col("__at") >= 0)).drop("__at")


OFFLINE = [Entry("offline", "offline-text", 1.0)]


def prepare(docs: DataFrame, cfg: BuildConfig, normalise: bool = True) -> DataFrame:
    """Documents worth sampling (text, doc_id, subset, domain, seq) with sents, split and stress_mode."""
    key = F.col("doc_id")
    df = docs.withColumn("__clean", clean_text(F.col("text"), normalise)).withColumn("sents", (splitter(cfg.sentence_splitter) if cfg.sentence_splitter else split_sentences)(F.col("__clean")))
    df = df.withColumn("__garbage", is_garbage(F.col("sents")))
    df = keep(df, ~F.col("__garbage"))
    df = df.withColumn("split", sampling.assign_split(cfg.random_seed, key, cfg.split_ratios, cfg.stress_fraction))
    return df.withColumn("stress_mode", F.col("split") == "stress").drop("__clean", "__garbage", "text")


class Feed:
    """The documents worth sampling, in the order of seq, a part at a time.

    seq is a hash, so the share of documents up to a place is known without a sort. Documents are scanned and prepared in
    blocks that grow with what is asked for; parts are filters on a block. Without a limit there is one part: all."""

    def __init__(self, docs: DataFrame, cfg: BuildConfig):
        self.cfg = cfg
        self.docs = docs.where(not_empty(F.col("text"))).withColumn("seq", digest(cfg.random_seed, F.col("doc_id"), "seq"))
        if cfg.max_documents_scan is not None:
            last = ranking.numbered(self.docs.select("seq"), [], "seq", "n").where(F.col("n") == cfg.max_documents_scan).head(1)
            if last or cfg.max_documents_scan <= 0:
                self.docs = self.docs.where(F.col("seq") <= (last[0].seq if last else ""))
        self.at, self.end, self.size, self.rows, self.block = "", "", 0, None, None
        self.settled, self.watch = 0, []

    def done(self) -> bool:
        return self.at == LAST

    def take(self, size: int | None = None) -> DataFrame:
        """About the next size documents; all that are left where size is None."""
        if size is None:
            rest = prepare(self._watched(self.docs.where(F.col("seq") > self.at)), self.cfg)
            self.at = self.end = LAST
            return self._watched(rest)
        if self.rows is None:
            self.rows = max(1, self.docs.select("seq").count())
        if self.at >= self.end:
            self.size = max(4 * size, 2 * self.size)
            self.settled += 0 if self.block is None else self.block.count()
            self.end = self._after(self.at, self.size)
            self.block = cut(prepare(self.docs.where((F.col("seq") > self.at) & (F.col("seq") <= self.end)), self.cfg))
        upto = min(self.end, self._after(self.at, size))
        part = self.block.where((F.col("seq") > self.at) & (F.col("seq") <= upto))
        self.at = upto
        return part

    def _watched(self, df: DataFrame) -> DataFrame:
        """df, whose rows are counted when it is first computed."""
        self.watch.append(seen := Observation())
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def counts(self) -> tuple[int, int]:
        """Documents read so far, and those of them that were worth sampling (so that they have a split)."""
        if self.block is None:
            return tuple(sum(w.get["n"] for w in self.watch[k::2]) for k in (0, 1))
        upto = F.col("seq") <= self.at
        return self.docs.where(upto).count(), self.block.where(upto).count() + self.settled

    def _after(self, at: str, size: int) -> str:
        place = int((at[:13] or "0").ljust(13, "0"), 16) + max(1, size * 16**13 // self.rows)
        return f"{place:013x}" if place < 16**13 else LAST


#: Above every hash.
LAST = "g"


def _augmented(df: DataFrame, base: str, cfg: BuildConfig, purpose: str, out: str) -> DataFrame:
    a = cfg.augment
    return augment(df, base, F.col("stress_mode"), cfg.random_seed, F.col("doc_id"), purpose, out, f"{out}_log", kernels=a.char_augs, adjectives="adjective_remove" in a.word_augs, chances=(a.augment_prob_none, a.augment_prob_one), stress_chances=(a.stress_augment_prob_none, a.stress_augment_prob_one))


def add_human(df: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Adds span, h_base, h_final, h_final_log and h_reason."""
    s = cfg.sample
    df = df.withColumn("span", sampling.sample_span(F.col("sents"), s.sentence_span_min, s.sentence_span_max, cfg.random_seed, F.col("doc_id")))
    df = _augmented(df.withColumn("h_base", join_span(F.col("span.span"))), "h_base", cfg, "human", "h_final")
    return df.withColumn("h_reason", quality_reason(F.col("h_final"), cfg.quality))


def add_request(df: DataFrame, cfg: BuildConfig, train: list[Entry], stress: list[Entry]) -> DataFrame:
    """Adds the request of a continuation: provider, model, prompt, system, raw and the sampling parameters."""
    s, key = cfg.sample, F.col("doc_id")
    u = uniform(cfg.random_seed, key, "generator")
    of_train = sampling.entries_as_columns(train, sampling.pick_weighted([e.weight for e in train], u))
    of_stress = sampling.entries_as_columns(stress or train, sampling.pick_weighted([e.weight for e in stress or train], u))
    df = df.withColumns({n: F.when(F.col("stress_mode"), b).otherwise(a) for n, a, b in zip(("provider", "model"), of_train, of_stress, strict=True)})
    params = sampling.generation_params(s, cfg.random_seed, key)
    df = df.withColumn("prompt", sampling.prefix_span(F.col("sents"), s.prefix_sentence_min, s.prefix_sentence_max, cfg.random_seed, key))
    df = df.withColumns({n: params[n] for n in ("temperature", "top_p", "repeat_penalty", "max_tokens")})
    return df.withColumns({"system": F.lit(s.continuation_system), "raw": F.lit(s.use_raw_completion_for_text_models) & is_text_model(F.col("model"))})


def params_struct(provider: Column) -> Column:
    none = lambda t: F.lit(None).cast(t)
    return F.struct(provider.alias("provider"), F.col("temperature").alias("temperature"), F.col("top_p").alias("top_p"), F.col("repeat_penalty").alias("repeat_penalty"), F.col("max_tokens").alias("max_tokens"), none("string").alias("host"), none("string").alias("backend"), none("string").alias("deployment"), none("string").alias("rewrite_stage"), none("string").alias("rewrite_style"))


def complete(df: DataFrame, cfg: BuildConfig, provider: generation.Provider | None) -> DataFrame:
    """Adds completion (null where the request failed) and generation_params. No provider: the offline one, a native expression."""
    if provider is None:
        s = cfg.sample
        after = sampling.prefix_length(F.col("sents"), s.prefix_sentence_min, s.prefix_sentence_max, cfg.random_seed, F.col("doc_id"))
        return df.withColumns({"completion": generation.offline_completion(F.col("sents"), after), "generation_params": params_struct(F.col("provider"))})
    return generation.generate(df, provider).drop("error")


def add_machine(df: DataFrame, cfg: BuildConfig, train: list[Entry], stress: list[Entry], provider: generation.Provider | None = None) -> DataFrame:
    """Adds prompt, a_base, a_final, a_final_log and a_reason of the machine row."""
    return judge_machine(complete(add_request(df, cfg, train, stress), cfg, provider), cfg)


def judge_machine(df: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Adds a_base, a_final, a_final_log and a_reason to completed requests."""
    df = df.withColumn("a_base", combine(F.col("prompt"), generation.post_process(F.col("completion"))))
    df = _augmented(df, "a_base", cfg, "machine", "a_final")
    reason = quality_reason(F.col("a_final"), cfg.quality, is_ai=True, prefix=F.col("prompt"))
    short = word_count(F.col("a_base")) < cfg.quality.word_count_min
    return df.withColumn("a_reason", F.when(F.col("prompt") == "", "empty_prefix").when(F.col("completion").isNull(), "generation_failed").when(short, "too_short").otherwise(reason))


def add_hard(df: DataFrame, cfg: BuildConfig, pool: list[Entry], provider: generation.Provider | None = None) -> DataFrame:
    """Adds r_base, r_final, r_reason: the machine text rewritten by an entry of its own draw."""
    key = F.col("doc_id")
    picked = sampling.entries_as_columns(pool, sampling.pick_weighted([e.weight for e in pool], uniform(cfg.random_seed, key, "rewriter")))
    df = df.withColumns({"r_provider": picked[0], "r_model": picked[1], "style": sampling.pick_style(cfg.sample, cfg.random_seed, key)})
    params = sampling.rewrite_params(cfg.sample, cfg.random_seed, key)
    if provider is None:
        df = df.withColumn("__rewrite", generation.offline_rewrite(F.col("a_base")))
        meta = F.struct(F.col("r_provider").alias("provider"), *[params[n].alias(n) for n in ("temperature", "top_p", "repeat_penalty", "max_tokens")])
    else:
        own = ("provider", "model", "prompt", "system", "raw", "temperature", "top_p", "repeat_penalty", "max_tokens")
        held = df.select(*[F.col(c).alias(f"__{c}") if c in own else F.col(c) for c in df.columns])
        asked = held.withColumns({"provider": F.col("r_provider"), "model": F.col("r_model"), "prompt": F.col("a_base"), "system": F.col("style.system"), "raw": F.lit(False), **{n: params[n] for n in own[5:]}})
        done = generation.generate(asked, provider, "__rewrite", "__meta", "__error").drop("__error", *own)
        df = done.select(*[F.col(c).alias(c[2:]) if c.startswith("__") and c[2:] in own else F.col(c) for c in done.columns])
        meta = F.col("__meta")
    df = df.withColumns({"rewrite_params": F.struct(*[meta[n].alias(n) for n in ("provider", "temperature", "top_p", "repeat_penalty", "max_tokens")], F.lit("rewrite").alias("rewrite_stage"), F.col("style.style").alias("rewrite_style")), "r_base": generation.post_process(F.col("__rewrite"))}).drop("__rewrite", "__meta")
    df = _augmented(df, "r_base", cfg, "hard", "r_final")
    short = word_count(F.col("r_base")) < cfg.quality.word_count_min
    return df.withColumn("r_reason", F.when(F.col("a_reason").isin("empty_prefix", "generation_failed", "too_short"), F.col("a_reason")).when(short, "too_short").otherwise(quality_reason(F.col("r_final"), cfg.quality, is_ai=True, prefix=F.col("prompt"), check_overlap=False)))


def add_mixed(df: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Adds m_base, m_final and m_reason: human span, joiner and machine text; all three must pass."""
    j = cfg.sample.mixed_paragraph_joiner
    df = df.withColumns({"m_base": F.concat("h_base", F.lit(j), "a_base"), "m_final": mixed_final(F.col("h_final"), F.col("a_final"), j)})
    whole = quality_reason(F.col("m_final"), cfg.quality, max_words=cfg.sample.mixed_word_count_max)
    return df.withColumn("m_reason", F.when(F.col("h_reason") != "ok", F.col("h_reason")).when(F.col("a_reason") != "ok", F.col("a_reason")).otherwise(whole))


def record(kind: str, cfg: BuildConfig) -> Column:
    """The record of one kind as a struct of the canonical columns, without its id."""
    short = {"human": "h", "direct_ai": "a", "hard_ai": "r", "mixed": "m"}[kind]
    human, hard, mixed = kind == "human", kind == "hard_ai", kind == "mixed"
    none = lambda t: F.lit(None).cast(t)
    final = F.col(f"{short}_final")
    log = F.concat("h_final_log", "a_final_log") if mixed else F.col(f"{short}_final_log")
    rewrite = "struct<provider:string,temperature:double,top_p:double,repeat_penalty:double,max_tokens:int,rewrite_stage:string,rewrite_style:string>"
    return F.struct(
        F.lit("human" if human else "ai").alias("label"), F.lit(int(not human)).alias("label_int"), F.lit(kind).alias("sample_kind"),
        F.col("domain").alias("domain"), F.col("doc_id").cast("string").alias("source_doc_id"), F.lit(cfg.source_type).alias("source_type"), F.col("subset").alias("subset"),
        (none("string") if human else F.col("prompt")).alias("prompt_text"), F.col(f"{short}_base").alias("base_text"), final.alias("final_text"),
        (F.lit(cfg.sample.mixed_paragraph_joiner) if mixed else none("string")).alias("mixed_joiner"),
        (none("string") if human else F.col("r_provider") if hard else F.col("provider")).alias("generator_provider"),
        (none("string") if human else F.col("r_model") if hard else F.col("model")).alias("generator_model"),
        (F.col("model") if hard else none("string")).alias("continuation_generator"), (F.col("provider") if hard else none("string")).alias("continuation_provider"),
        (none(generation.PARAMS) if human else F.col("generation_params").cast(generation.PARAMS)).alias("generation_params"),
        (F.col("rewrite_params").cast(rewrite) if hard else none(rewrite)).alias("rewrite_params"),
        log.alias("augmentation"), F.size(split_sentences(final)).alias("num_sentences"), word_count(final).alias("num_words"), F.col("split").alias("split"),
        (F.array("span.i0", "span.i1") if human or mixed else none("array<int>")).alias("span_sentence_indices"),
        text_hash(F.col(f"{short}_base")).alias("original_text_hash"), F.col("stress_mode").alias("stress_mode"),
    )


@dataclass
class Report:
    """What a build did: documents read, those that got a split, parts, requests to providers, rows by kind and by domain."""

    documents: int = 0
    split_documents: int = 0
    parts: int = 0
    requests: int = 0
    rows: Counter = field(default_factory=Counter)
    domains: Counter = field(default_factory=Counter)

    def add(self, chosen: DataFrame, kinds: list[str], quotas: dict[str, float]) -> int:
        """Counts the chosen rows (domain, and where kinds is empty bucket); how many there are."""
        domain = by_quota_now(quotas, self.domains)
        found = chosen.groupBy(domain.alias("d"), (F.lit(None).cast("string") if kinds else F.col("bucket")).alias("b")).count().collect()
        for r in found:
            self.domains[r.d] += r[2]
            self.rows.update({k: r[2] for k in kinds or [r.b]})
        return sum(r[2] for r in found)


def by_quota_now(quotas: dict[str, float], counts: dict[str, int]) -> Column:
    return ranking.by_quota("domain", quotas, counts) if quotas else F.lit("")


def _balanced(rows: DataFrame, cfg: BuildConfig, report: Report, wanted: int | None) -> DataFrame:
    """rows without what the domain balance leaves out; below BALANCE_FROM rows nothing is left out."""
    have = sum(report.domains.values())
    if wanted is not None and have + wanted < BALANCE_FROM:
        return rows
    return ranking.domain_balanced(rows, "domain", "seq", cfg.domain_quotas, uniform(cfg.random_seed, F.col("doc_id"), "balance"), have=dict(report.domains), wanted=wanted)


#: Rows from which domains are balanced (fixed value of the rule).
BALANCE_FROM = 80


class Written:
    """Hashes of texts that are written: of earlier output, and of the parts so far."""

    def __init__(self, earlier: DataFrame | None, normalise: bool):
        self.known = [] if earlier is None else [dedup.written(earlier, normalise)]

    def new(self, rows: DataFrame, key: str) -> DataFrame:
        for k in self.known:
            rows = rows.join(k.withColumnRenamed("__hash", key), key, "left_anti")
        return rows

    def add(self, rows: DataFrame, keys: list[str]) -> None:
        if len(self.known) > 8:
            self.known = [cut(reduce(DataFrame.unionAll, self.known))]
        self.known.append(rows.select(F.explode(F.array(*keys)).alias("__hash")))


def _pair_rows(df: DataFrame, kinds: list[str], cfg: BuildConfig) -> DataFrame:
    """(rid, a, records) of rows with all sides: a null where the machine side fails, records null where one does."""
    of = normalized_hash if cfg.dedup_normalize_text else text_hash
    ok = F.lit(True) if len(kinds) == 1 else F.col("a_reason") == "ok"
    a = F.lit(None).cast("string") if len(kinds) == 1 else F.when(ok, of(F.col("a_base")))
    return df.withColumns({"a": a, "records": F.when(ok, F.array(*[record(k, cfg) for k in kinds]))})


def _asked_in_turn(human: DataFrame, rows: DataFrame, cfg: BuildConfig, provider: generation.Provider, written: Written, left: int | None, report: Report) -> tuple[DataFrame, DataFrame]:
    """(rid, records) of the answers and of each human text the first row (rid, seq, domain, split, h, a) whose machine row passes.

    Turns ask for the 1st document of each text, and of texts without a passing one for the 2nd, the 3rd and 4th, the 5th to
    8th and so on: n copies take about log2(n) turns and less than twice the requests of asking one by one. The turn of a row is
    known before, so that each turn reads and shuffles its own rows only. Rows behind the left-th good one are not asked."""
    kinds = ["human", "direct_ai"]
    rows = rows.groupBy("seq", "h").agg(F.min(F.struct("domain", "split", "rid")).alias("__first")).select("seq", "h", "__first.*")
    rows = cut(ranking.numbered(rows, ["h"], "seq", "__n").withColumn("turn", F.when(F.col("__n") == 1, 0).otherwise(F.length(F.bin(F.col("__n") - 1)))).drop("__n"))
    last = rows.agg(F.max("turn")).first()[0] or 0
    human = human.join(rows.select("rid", "turn"), "rid")
    human = cut(human) if last else human
    fulls, firsts, upto = [], [], None
    for turn in range(last + 1):
        asked = rows.where(F.col("turn") == turn)
        for f in firsts:
            asked = asked.join(f.select("h"), "h", "left_anti")
        asked = cut(asked if upto is None else asked.where(F.col("seq") < upto))
        if not (n := asked.count()) and turn:
            break
        report.requests += n
        made = judge_machine(complete(human.where(F.col("turn") == turn).join(asked.select("rid"), "rid", "left_semi"), cfg, provider), cfg)
        full = cut(keep(_pair_rows(made, kinds, cfg).select("rid", "a", "records"), F.col("a").isNotNull()))
        fulls.append(full.select("rid", "records"))
        passed = asked.join(full.select("rid", "a"), "rid").select("rid", "seq", "domain", "split", "h", "a")
        firsts.append(cut(dedup.first_of(passed, "h", "seq")))
        if left is not None:  # with more first rows the left-th good one can only come earlier
            good = dedup.first_of(written.new(reduce(DataFrame.unionAll, firsts), "a"), "a", "seq")
            end = ranking.numbered(good.select("seq"), [], "seq", "__n").where(F.col("__n") == left).head(1)
            upto = end[0].seq if end else None
    return reduce(DataFrame.unionAll, fulls), reduce(DataFrame.unionAll, firsts)


def build_pairs(docs: DataFrame, cfg: BuildConfig, train: list[Entry] = OFFLINE, stress: list[Entry] = (), provider: generation.Provider | None = None, earlier: DataFrame | None = None, offsets: DataFrame | None = None, report: Report | None = None) -> DataFrame:
    """Human rows, and with skip_ai off a machine row beside each; a pair is kept only if both sides pass.

    Documents come in the order of seq. Of those with one human text the first whose machine row passes counts; of these,
    the first of each machine text. With num_pairs, parts of documents are taken until there are so many pairs, so requests
    are few more than pairs; without, all documents are one part. Only narrow rows decide: order, hashes, domain and split.
    The offline provider's texts cost no request: they are made in one pass with the human side. Records are written once
    and shuffled once, whatever the number of copies."""
    of = normalized_hash if cfg.dedup_normalize_text else text_hash
    feed, report, written = Feed(docs, cfg), report or Report(), Written(earlier, cfg.dedup_normalize_text)
    made: list[tuple[DataFrame, DataFrame]] = []
    kinds, pairs, tried = ["human"] if cfg.skip_ai else ["human", "direct_ai"], 0, 0
    at_once = cfg.skip_ai or provider is None

    def sides(part: DataFrame) -> DataFrame:
        """Rows whose human side passes, by rid, with what is asked for, or all that is made at once."""
        human = keep(add_human(part, cfg), F.col("h_reason") == "ok").withColumns({"h": of(F.col("h_base")), "rid": F.monotonically_increasing_id()})
        if not at_once:
            return add_request(human, cfg, list(train), list(stress)).drop("sents")
        full = human if cfg.skip_ai else add_machine(human, cfg, list(train), list(stress))
        return _pair_rows(full, kinds, cfg).select("rid", "seq", "doc_id", "domain", "split", "h", "a", "records")

    while not feed.done() and (cfg.num_pairs is None or pairs < cfg.num_pairs):
        left = None if cfg.num_pairs is None else cfg.num_pairs - pairs
        size = None if left is None else int(1.15 * left / max(0.02, pairs / tried if pairs else 0.5 if not tried else 0.5 / tried)) + 4
        human = cut(sides(feed.take(size)))
        rows = human.select("rid", "seq", "doc_id", "domain", "split", "h", *["a"] * at_once)
        rows = cut(_balanced(written.new(rows, "h"), cfg, report, left))
        report.parts += 1
        tried += size or 0
        if at_once:
            full, firsts = human.select("rid", "records"), cut(dedup.first_of(rows if cfg.skip_ai else rows.where("a is not null"), "h", "seq"))
            report.requests += 0 if cfg.skip_ai else rows.select("seq", "h").distinct().count()
        else:
            full, firsts = _asked_in_turn(human, rows, cfg, provider, written, left, report)
        good = firsts if cfg.skip_ai else dedup.first_of(written.new(firsts, "a"), "a", "seq")
        if left is not None:
            good = ranking.first_rows(good, [], "seq", left)
        good = cut(good)
        pairs += report.add(good, kinds, cfg.domain_quotas)
        made.append((full, good))
        written.add(firsts, ["h"] if cfg.skip_ai else ["h", "a"])
    report.documents, report.split_documents = feed.counts() if made else (0, 0)
    if not made:
        at_once = True
        empty = sides(prepare(feed.docs.where("false"), cfg))
        made.append((empty.select("rid", "records"), empty))
    chosen = reduce(DataFrame.unionAll, [g.select(F.lit(i).alias("__part"), "rid", "seq", "split") for i, (_, g) in enumerate(made)])
    numbers = cut(ranking.numbered(chosen, ["split"], "seq", "__number", ("__part", "rid")).select("__part", "rid", "__number"))
    rows = [full.join(numbers.where(F.col("__part") == i), "rid") for i, (full, _) in enumerate(made)]
    records = [r.select("__number", F.posexplode("records").alias("place", "r")) for r in rows]
    return _with_ids(reduce(DataFrame.unionAll, records), len(kinds), cfg, offsets)


def _with_ids(rows: DataFrame, width: int, cfg: BuildConfig, offsets: DataFrame | None) -> DataFrame:
    """The records of rows (__number within the split, place, r) with dense ids; width: records of a number."""
    if offsets is not None:
        last = F.broadcast(offsets.select(F.col("split").alias("__split"), F.col("last").alias("__last")))  # one row for each split
        rows = rows.join(last, F.col("r.split") == F.col("__split"), "left")
    else:
        rows = rows.withColumn("__last", F.lit(0).cast("long"))
    number = (F.col("__number") - 1) * width + F.col("place") + 1 + F.coalesce("__last", F.lit(0))
    return rows.select(F.format_string("%s_%s_%06d", F.lit(cfg.id_prefix), F.col("r.split"), number).alias("id"), "r.*")


def first_filled(rows: DataFrame, left: dict[str, int]) -> tuple[str, str] | None:
    """(seq, bucket) of the row (seq, bucket) of rows at which, in the order of seq, a bucket first reaches what is left of its target."""
    full = ranking.numbered(rows.select("seq", "bucket"), ["bucket"], "seq", "__n")
    goal = F.element_at(F.create_map(*[F.lit(x) for kv in left.items() for x in kv]), F.col("bucket"))
    ends = full.where(F.col("__n") == goal).select("seq", "bucket").orderBy("seq").limit(1).collect()
    return (ends[0][0], ends[0][1]) if ends else None


def first_open(order: str, open_now: list[str]) -> Column:
    return F.get(F.filter(order, lambda b: b.isin(*open_now)), F.lit(0))


def assign_quotas(df: DataFrame, targets: dict[str, int], seq: str = "seq", order: str = "buckets", ok: str = "ok") -> DataFrame:
    """Adds bucket, and keeps the rows that a sequential run with these targets accepts.

    Rows come in order of seq; each takes the first open bucket of its own order (array) and counts if ok[bucket] is true;
    a bucket closes at its target. Set-based: within a round the open buckets are fixed, and the round ends with the row at
    which one of them fills, so there are at most as many rounds as buckets; only (seq, bucket) rows are numbered."""
    open_now, out, rest = [b for b in BUCKETS if targets.get(b, 0) > 0], None, df.withColumn("seq", F.col(seq))
    while open_now:
        taken = rest.withColumn("bucket", first_open(order, open_now)).where(F.col(ok)[F.col("bucket")])
        end = first_filled(taken, {b: targets[b] for b in open_now})
        part = taken if end is None else taken.where(F.col("seq") <= end[0])
        out = part if out is None else out.unionAll(part)
        if end is None:
            break
        counts = {r[0]: r[1] for r in part.groupBy("bucket").count().collect()}
        targets = {b: targets[b] - counts.get(b, 0) for b in open_now}
        open_now = [b for b in open_now if targets[b] > 0 and b != end[1]]
        rest = rest.where(F.col("seq") > end[0])
    return df.withColumn("bucket", F.lit(None).cast("string")).limit(0) if out is None else out


def _of_bucket(df: DataFrame, bucket: str, cfg: BuildConfig, train: list[Entry], stress: list[Entry], rewriters: list[Entry], provider: generation.Provider | None) -> DataFrame:
    """(seq, doc_id, domain, split, bucket, ok, hash, r) of documents whose turn is one bucket; only what its record needs is made."""
    short = {"human": "h", "direct_ai": "a", "hard_ai": "r", "mixed": "m"}[bucket]
    df = df.where(F.col("bucket") == bucket)
    if bucket in ("human", "mixed"):
        df = add_human(df, cfg)
    if bucket == "mixed":  # no request where the human side fails
        df = keep(df, F.col("h_reason") == "ok")
    if bucket != "human":
        df = add_machine(df, cfg, train, stress, provider)
    if bucket == "hard_ai":
        df = add_hard(df, cfg, rewriters, provider)
    if bucket == "mixed":
        df = add_mixed(df, cfg)
    of = normalized_hash if cfg.dedup_normalize_text else text_hash
    return df.select("seq", "doc_id", "domain", "split", "bucket", (F.col(f"{short}_reason") == "ok").alias("ok"), of(F.col(f"{short}_base")).alias("hash"), record(bucket, cfg).alias("r"))


def build_quotas(docs: DataFrame, cfg: BuildConfig, train: list[Entry] = OFFLINE, stress: list[Entry] = (), rewriters: list[Entry] = (), provider: generation.Provider | None = None, earlier: DataFrame | None = None, offsets: DataFrame | None = None, counts: dict[str, int] | None = None, report: Report | None = None) -> DataFrame:
    """One row for each document, of the bucket that is its turn, until all targets are met; counts: rows that are written already.

    Equal to a sequential run over documents in the order of seq: each takes the first open bucket of its own order, and counts if
    its row passes and its text is new; a bucket closes at its target. Documents come in parts. Within a part the open buckets
    are fixed and each document is made for one bucket; the part ends with the row at which one fills, and what
    follows it comes again. A part is about as large as the next bucket to fill needs, so few requests are made in vain."""
    feed, report, written = Feed(docs, cfg), report or Report(), Written(earlier, cfg.dedup_normalize_text)
    left = {b: (cfg.sample_targets or {}).get(b, 0) - (counts or {}).get(b, 0) for b in BUCKETS}
    open_now, made, tried, rows_made = [b for b in BUCKETS if left[b] > 0], [], 0, 0
    pools = (list(train), list(stress), list(rewriters or train), provider)
    while open_now and not feed.done():
        rate = rows_made / tried if rows_made else 0.5 if not tried else 0.5 / tried
        size = int(1.15 * min(left[b] for b in open_now) * len(open_now) / max(0.02, rate)) + 4
        began = feed.at
        part = feed.take(size).withColumn("buckets", sampling.bucket_order(cfg.random_seed, F.col("doc_id"))).withColumn("bucket", first_open("buckets", open_now))
        turn = cut(_balanced(part.select("seq", "doc_id", "domain", "bucket").distinct(), cfg, report, min(sum(left[b] for b in open_now), size)).select("seq"))
        part = part.join(turn, "seq", "left_semi").dropDuplicates(["seq"])
        found = cut(reduce(DataFrame.unionAll, [_of_bucket(part, b, cfg, *pools) for b in open_now]))
        rows = found.where("ok").select("seq", "doc_id", "domain", "split", "bucket", "hash")
        rows = cut(dedup.first_of(written.new(rows, "hash"), "hash", "seq"))
        end = first_filled(rows, {b: left[b] for b in open_now})
        if end:
            feed.at = end[0]
            rows = rows.where(F.col("seq") <= end[0])
        report.parts += 1
        report.requests += sum(r[1] * (2 if r[0] == "hard_ai" else 1) for r in found.where("bucket <> 'human'").groupBy("bucket").count().collect())
        before = report.rows.copy()
        rows_made += report.add(rows, [], cfg.domain_quotas)
        tried += turn.where(F.col("seq") <= end[0]).count() if end else turn.count()
        made.append((found, rows))
        written.add(rows, ["hash"])
        left = {b: left[b] - report.rows[b] + before[b] for b in BUCKETS}
        open_now = [b for b in open_now if left[b] > 0]
        assert feed.at > began
    report.documents, report.split_documents = feed.counts() if made else (0, 0)
    if not made:
        empty = prepare(feed.docs.where("false"), cfg).withColumn("bucket", F.lit("human"))
        found = _of_bucket(empty, "human", cfg, *pools)
        made.append((found, found.drop("r", "ok")))
    chosen = cut(reduce(DataFrame.unionAll, [g.select("seq", "split") for _, g in made]))
    numbers = cut(ranking.numbered(chosen, ["split"], "seq", "__number").select("seq", "__number"))
    records = [f.join(g.select("seq"), "seq", "left_semi").select("seq", F.lit(0).alias("place"), "r") for f, g in made]
    return _with_ids(reduce(DataFrame.unionAll, records).join(numbers, "seq"), 1, cfg, offsets)


def build(docs: DataFrame, cfg: BuildConfig, **more: Any) -> DataFrame:
    return build_quotas(docs, cfg, **more) if cfg.sample_targets is not None else build_pairs(docs, cfg, **{k: v for k, v in more.items() if k not in ("rewriters", "counts")})
