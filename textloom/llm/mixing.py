"""Operator 3, mixing sources to target weights by hierarchical budgets; native DataFrame operations only.

Leaves are (domain, language, source). A token budget runs down the tree by weights. A node can hold at most `epochs`
times its tokens; what siblings cannot hold goes to the other siblings in proportion to their weights, and only what a
whole family cannot hold returns to its parent's siblings. For one family this is a water level: node i gets
min(capacity, level * weight), and the level follows from running sums in order of capacity / weight. Each leaf's budget
is taken as whole epochs and a token prefix of one more epoch in that epoch's own seeded order.

Tokens are the words of a text: a tokenizer's count needs Python, which the native path has none of.

Scale: texts are split once, into narrow rows; leaves are sums combined before the shuffle. Where a leaf's prefix ends is
found by token sums over hash prefixes, three digits at a time, until a prefix holds few rows of each leaf; only those are
ordered, without their texts. Documents are then taken by comparing their own hash with their leaf's cut. Hot leaves' plans
are broadcast (at most HOT_KEYS of them), so a leaf with a third of all rows is never sorted, nor moved. The nodes of one
family are ordered in one task: a narrow row for each source of a language.

Defined cases: null text is empty, with no token; null language or source is a leaf of its own ("" in the tree); unknown
nodes weigh `OTHER`; repeated rows each count; an empty table gives no row; fractions of a token are dropped, so a family
may stay short of its budget by less than one token a node; other columns are kept by mix_docs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import cut, hot_join, table, words_of

DOMAINS = ("web", "books", "news", "reference")
#: Integer weights of the tree's nodes; sources of a language weigh the same.
DOMAIN_WEIGHTS = {"web": 45, "books": 25, "news": 20, "reference": 10}
LANG_WEIGHTS = {"en": 55, "de": 15, "fr": 15, "es": 15}
OTHER, EPOCHS, SEED = 1, 2, "mix-1"
#: Hex digits of the seeded hash by which a leaf's prefix is narrowed down at a time, and rows of a leaf that are then ordered.
PREFIX_DIGITS, EDGE_ROWS = 3, 10_000
LEVELS = ("domain", "lang", "source")


class Tree(NamedTuple):
    """Weights of domains and languages, and of sources (all others OTHER); missing names weigh OTHER."""

    domains: dict[str, int] = DOMAIN_WEIGHTS
    langs: dict[str, int] = LANG_WEIGHTS
    sources: dict[str, int] = {}


def domain_of(source: Column) -> Column:
    """Domain of a source by the number that ends its name; sources without one are 'other'."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(number == "", "other").otherwise(F.element_at(F.array(*map(F.lit, DOMAINS)), (number.cast("int") % len(DOMAINS) + 1).cast("int")))


def _weight(name: str, weights: dict[str, int]) -> Column:
    out = F.lit(OTHER)
    for k, v in sorted(weights.items()):
        out = F.when(F.col(name) == k, v).otherwise(out)
    return out.cast("decimal(38,0)")


def share_out(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """nodes (parents, w, c, b: weight, capacity and the family's budget) with x, each node's budget."""
    family = Window.partitionBy(*[F.col(p) for p in parents]) if parents else Window.partitionBy(F.lit(0))
    upto = family.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    big = "decimal(38,0)"
    df = nodes.withColumn("ratio", F.col("c").cast("double") / F.col("w").cast("double"))
    df = df.withColumns({"c_to": F.sum("c").over(upto).cast(big), "w_to": F.sum("w").over(upto).cast(big), "w_all": F.sum("w").over(family).cast(big)})
    df = df.withColumn("full", F.expr("cast(w * c_to as decimal(38,0)) + cast(c * (w_all - w_to) as decimal(38,0)) <= cast(b * w as decimal(38,0))"))
    df = df.withColumns({"c_full": F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(family), F.lit(0)).cast(big), "w_full": F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(family), F.lit(0)).cast(big)})
    part = F.expr("cast((w * (b - c_full)) div nullif(w_all - w_full, 0) as decimal(38,0))")
    return df.withColumn("x", F.when(F.col("full"), F.col("c")).otherwise(part).cast(big)).drop("ratio", "c_to", "w_to", "w_all", "full", "c_full", "w_full")


def budgets(leaves: DataFrame, total: int | Column | None = None, tree: Tree = Tree(), epochs: int = EPOCHS) -> DataFrame:
    """leaves (domain, lang, source, tokens) with budget: tokens to take, at most epochs times tokens. total: by default all tokens."""
    big = "decimal(38,0)"
    leaf = leaves.select(*LEVELS, F.col("tokens").cast(big).alias("tokens"), (F.col("tokens") * epochs).cast(big).alias("c"), _weight("source", tree.sources).alias("w"))
    top = leaf.groupBy("domain").agg(F.sum("c").cast(big).alias("c"), F.sum("tokens").cast(big).alias("t")).withColumn("w", _weight("domain", tree.domains))
    everything = Window.partitionBy(F.lit(0))
    asked = F.sum("t").over(everything) if total is None else F.lit(total)
    top = share_out(top.withColumn("b", F.least(asked.cast(big), F.sum("c").over(everything).cast(big))), []).select("domain", F.col("x").alias("b"))
    middle = leaf.groupBy("domain", "lang").agg(F.sum("c").cast(big).alias("c")).withColumn("w", _weight("lang", tree.langs)).join(top, "domain")
    middle = share_out(middle, ["domain"]).select("domain", "lang", F.col("x").alias("b"))
    return share_out(leaf.join(middle, ["domain", "lang"]), ["domain", "lang"]).select(*LEVELS, F.col("tokens").cast("long"), F.col("x").cast("long").alias("budget"))


def _seeded(epoch: Column, seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit(""))))


def _leaf(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang, source and more) with __id and the leaf's __domain, __lang and __source."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.withColumns({"__id": F.col("doc_id"), "__lang": name("lang"), "__source": name("source"), "__domain": domain_of(name("source"))})


def _tokens(text: Column) -> Column:
    return F.size(words_of(text.cast("string"))).cast("long")


OWN = [f"__{x}" for x in LEVELS]


def _cut_points(rows: DataFrame) -> DataFrame:
    """(leaf, __cut, __left) of rows (leaf, __hash, __tokens, __rest): the hash at which the tokens in the order of hashes exceed __rest, and what is left before it.

    Token sums by hash prefixes find the prefix in which the rest ends, three digits at a time, until it holds few rows of
    each leaf; only those are ordered."""
    upto = Window.partitionBy(*OWN).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def ending(sums: DataFrame) -> DataFrame:
        """Of sums (leaf, __at, __rest, n, rows) the first of each leaf that does not fit whole."""
        over = sums.withColumn("__upto", F.sum("n").over(upto)).where(F.col("__upto") > F.col("__rest"))
        return over.groupBy(*OWN).agg(F.min_by(F.struct(F.col("__at").alias("__prefix"), (F.col("__rest") - F.col("__upto") + F.col("n")).alias("__rest"), "rows"), "__at").alias("e")).select(*OWN, "e.*")

    sums = lambda df, at: df.withColumn("__at", at).groupBy(*OWN, "__rest", "__at").agg(F.sum("__tokens").alias("n"), F.count("*").alias("rows"))
    digits, state = PREFIX_DIGITS, cut(ending(sums(rows, F.substring("__hash", 1, PREFIX_DIGITS))))
    inside = lambda: rows.drop("__rest").withColumn("__prefix", F.substring("__hash", 1, digits)).join(state.drop("rows"), [*OWN, "__prefix"])
    while digits < 30 and (state.agg(F.max("rows")).first()[0] or 0) > EDGE_ROWS:
        held = inside()
        digits += PREFIX_DIGITS
        state = cut(ending(sums(held, F.substring("__hash", 1, digits))))
    return ending(sums(inside(), F.col("__hash"))).select(*OWN, F.col("__prefix").alias("__cut"), F.col("__rest").alias("__left"))


def plan_cuts(docs: DataFrame, total: int | None = None, tree: Tree = Tree(), epochs: int = EPOCHS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(narrow, cuts): narrow (__id, leaf, __tokens) has a row for each of docs; cuts has a row for each leaf with tokens to take:
    __full whole epochs, and of one more epoch the documents before the hash __cut (all, where it is null and __part is true)
    and, of those with that hash, what fits into __left. __rows: the leaf's rows."""
    narrow = cut(_leaf(docs).select("__id", *OWN, _tokens(F.col("text")).alias("__tokens")))
    leaves = narrow.groupBy(*OWN).agg(F.sum("__tokens").alias("tokens"), F.count("*").alias("__rows"))
    named = cut(leaves.select(*[F.col(o).alias(x) for o, x in zip(OWN, LEVELS, strict=True)], "tokens", "__rows"))
    plan = budgets(named.drop("__rows"), total, tree, epochs).join(named.drop("tokens"), list(LEVELS))
    plan = cut(plan.select(*[F.col(x).alias(o) for o, x in zip(OWN, LEVELS, strict=True)], "__rows", F.coalesce(F.expr("budget div nullif(tokens, 0)"), F.lit(epochs)).alias("__full"), F.coalesce(F.expr("budget % nullif(tokens, 0)"), F.lit(0)).alias("__rest")))
    part = plan.where("__rest > 0")
    hashed = cut(hot_join(narrow, part, OWN, "__rows").select(*OWN, "__rest", "__tokens", _seeded(F.col("__full"), seed).alias("__hash")))
    return narrow, cut(plan.join(_cut_points(hashed), OWN, "left").select(*OWN, "__rows", "__full", "__cut", "__left", (F.col("__rest") > 0).alias("__part")))


def taken(rows: DataFrame, cuts: DataFrame, seed: str, tokens: Column) -> DataFrame:
    """rows (leaf, __id and more) as often as the cuts take them, with __epoch. tokens is computed for rows at a cut only."""
    seen = hot_join(rows, cuts, OWN, "__rows").withColumn("__hash", _seeded(F.col("__full"), seed))
    inside = F.col("__part") & F.coalesce(F.col("__hash") < F.col("__cut"), F.lit(True))
    count = (F.col("__full") + F.when(inside, 1).otherwise(0)).cast("int")
    whole = seen.where(count > 0).withColumn("__epoch", F.explode(F.sequence(F.lit(0), count - 1)))
    # at most the rows of one id of each leaf
    order = Window.partitionBy(*OWN).orderBy("__n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = seen.where(F.col("__part") & (F.col("__hash") == F.col("__cut"))).withColumn("__n", tokens).withColumn("__sum", F.sum("__n").over(order))
    names = [*rows.columns, "__epoch"]
    return whole.select(names).unionAll(edge.where("__sum <= __left").withColumn("__epoch", F.col("__full").cast("int")).select(names))


def select(docs: DataFrame, total: int | None = None, tree: Tree = Tree(), epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """What is taken from docs (doc_id, text, lang, source): __id, __domain, __lang, __source, __tokens, __epoch, a row for each time."""
    narrow, cuts = plan_cuts(docs, total, tree, epochs, seed)
    return taken(narrow, cuts, seed, F.col("__tokens"))


def mix_docs(docs: DataFrame, total: int | None = None, tree: Tree = Tree(), epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows taken, with docs' columns; a row that several epochs take comes several times."""
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), *[docs[c] for c in ("doc_id", "text", "lang", "source")])
    rows = _leaf(held).select("__row", "__id", *OWN)
    return taken(rows, plan_cuts(docs, total, tree, epochs, seed)[1], seed, _tokens(F.col("__row.text"))).select("__row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(table(spark, sf_dir, "documents")).select(F.col("__id").alias("doc_id"), F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), F.col("__tokens").alias("n_tokens"), F.col("__epoch").cast("long").alias("epoch"))


def _sql_weight(name: str, weights: dict[str, int]) -> str:
    return "(case " + " ".join(f"when {name} = '{k}' then {v}" for k, v in sorted(weights.items())) + f" else {OTHER} end)::hugeint"


def _sql_level(name: str, source: str, family: str, keys: str) -> str:
    by = f"partition by {family}" if family else ""
    return f"""
{name}_1 as (select *, c::double / w::double as ratio from {source}),
{name}_2 as (select *, sum(c) over ({by} order by ratio range between unbounded preceding and current row) as c_to, sum(w) over ({by} order by ratio range between unbounded preceding and current row) as w_to, sum(w) over ({by}) as w_all from {name}_1),
{name}_3 as (select *, w * c_to + c * (w_all - w_to) <= b * w as is_full from {name}_2),
{name}_4 as (select *, coalesce(sum(case when is_full then c end) over ({by}), 0) as c_full, coalesce(sum(case when is_full then w end) over ({by}), 0) as w_full from {name}_3),
{name} as (select {keys}, (case when is_full then c else (w * (b - c_full)) // nullif(w_all - w_full, 0) end)::hugeint as x from {name}_4)"""


_LIST = "[" + ", ".join(f"'{d}'" for d in DOMAINS) + "]"
SQL = rf"""
with d as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as n_tokens from documents),
e as (select *, case when regexp_extract(source, '([0-9]{{1,9}})$', 1) = '' then 'other' else {_LIST}[regexp_extract(source, '([0-9]{{1,9}})$', 1)::bigint % {len(DOMAINS)} + 1] end as domain from d),
leaf as (select domain, lang, source, sum(n_tokens)::hugeint as tokens, (sum(n_tokens) * {EPOCHS})::hugeint as c, {OTHER}::hugeint as w from e group by all),
top_0 as (select domain, sum(c)::hugeint as c, {_sql_weight("domain", DOMAIN_WEIGHTS)} as w, least((select sum(tokens) from leaf), (select sum(c) from leaf))::hugeint as b from leaf group by domain),
{_sql_level("top", "top_0", "", "domain")},
mid_0 as (select domain, lang, sum(c)::hugeint as c, {_sql_weight("lang", LANG_WEIGHTS)} as w, any_value(x) as b from leaf join top using (domain) group by domain, lang),
{_sql_level("mid", "mid_0", "domain", "domain, lang")},
low_0 as (select leaf.*, x as b from leaf join mid using (domain, lang)),
{_sql_level("low", "low_0", "domain, lang", "domain, lang, source, tokens")},
plan as (select domain, lang, source, coalesce(x // nullif(tokens, 0), {EPOCHS}) as n_full, coalesce(x % nullif(tokens, 0), 0) as rest from low),
h as (select e.*, n_full, rest, md5('{SEED}|' || n_full || '|' || coalesce(doc_id::varchar, '')) as hash from e join plan using (domain, lang, source)),
s as (select *, sum(n_tokens) over (partition by domain, lang, source order by hash, doc_id, n_tokens rows unbounded preceding) as upto from h)
select doc_id, domain, lang, source, n_tokens, unnest(range(0, (n_full + case when rest > 0 and upto <= rest then 1 else 0 end)::bigint)) as epoch from s
"""
