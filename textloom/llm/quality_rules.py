"""Operator 7, quality rules: a threshold table compiled into one native Spark projection.

Each row of the table bounds one ratio of counts (length, symbol, stop-word and line ratios). The table is compiled both
to a Spark column and to SQL text; no user function, no Python, no shuffle runs on the main path.

Different words grow more slowly than a text (in clean prose with a power of its words of a half or more), so above 1000 words
their bound grows with the root of the words; below, it is a plain ratio.

Defined cases: null text has no words, as an empty text; texts under ten words fail the base rule; a null doc_id stays
null; repeated rows each give a row; an empty table gives no row; other columns are ignored, or kept by filter_docs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import table
from textloom.llm.stats import STOP_WORDS, SYMBOLS, add_counts, add_ratios


class Rule(NamedTuple):
    """The ratio numerator / denominator must lie in [low, high] for texts of at least from_words words.

    With root_from, a denominator d above it counts as sqrt(root_from * d): for a count that grows more slowly than the text."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None
    from_words: int = 0
    root_from: int = 0


TABLE = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_a_word", "n_symbols", "n_words", None, 0.1),
    Rule("exclamations_a_word", "n_loud", "n_words", None, 0.3),
    Rule("capitals", "n_upper", "word_chars", None, 0.45),
    Rule("stop_words", "n_stop", "n_words", 0.03, None, 30),
    Rule("different_words", "n_kinds", "n_words", 0.25, None, 20, 1000),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.4),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def broken(rule: Rule, named: dict[str, str]) -> str:
    """SQL text (Spark's and DuckDB's alike): true if a text with words breaks the rule. named: column of each count."""
    top, below = (f"cast({named.get(c, c)} as double)" for c in (rule.numerator, rule.denominator))
    if rule.root_from:
        below = f"least({below}, sqrt(cast({rule.root_from} as double) * {below}))"
    tests = [f"{top} {sign} cast({bound} as double) * {below}" for sign, bound in (("<", rule.low), (">", rule.high)) if bound is not None]
    return f"({named.get('n_words', 'n_words')} >= {max(1, rule.from_words)} and ({' or '.join(tests)}))"


def verdict(rules: tuple[Rule, ...] = TABLE, named: dict[str, str] | None = None) -> str:
    """SQL text: true if no rule is broken."""
    return "not (" + " or ".join(broken(r, named or {}) for r in rules) + ")" if rules else "true"


INNER = {"n_loud": "__n_loud", "n_upper": "__n_upper", "n_stop": "__n_stop", "n_kinds": "__n_kinds", "n_lines": "__n_lines"}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = TABLE) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the first broken rule (reason, null if kept), a row for each of docs."""
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    counted = add_ratios(add_counts(text))
    reason = F.when(base_failed(), "base")
    for r in rules:
        reason = reason.when(F.expr(broken(r, INNER)), r.name)
    # true, but not deterministic: a caller's filter on these columns is not written into the projections below, where
    # every count would be computed again for each word
    barrier = F.monotonically_increasing_id() >= 0
    kept = ~base_failed() & F.expr(verdict(rules, INNER)) & barrier
    return counted.select("doc_id", *COUNTS, (base_failed() & barrier).alias("base_failed"), kept.alias("kept"), reason.alias("reason"))


def filter_docs(docs: DataFrame, rules: tuple[Rule, ...] = TABLE) -> DataFrame:
    """The rows of docs that base rule and table keep, with docs' columns unchanged."""
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("__text"))
    # the row number, which is not deterministic, keeps the optimiser from writing all the counts into the filter again
    counted = add_ratios(add_counts(held)).withColumn("__at", F.monotonically_increasing_id())
    return counted.where(~base_failed() & F.expr(verdict(rules, INNER)) & (F.col("__at") >= 0)).select("__row.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *COUNTS, "base_failed", "kept")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_SPACES = r"[\x20\x09-\x0D]"
SQL = rf"""
with t as (select row_number() over () rid, doc_id, coalesce(text, '') as body from documents),
w as (select *, list_filter(string_split_regex(body, '{_SPACES}+'), lambda x: x <> '') as words, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from t),
win as (select rid, i, words[i : i + 4] as win from (select rid, words, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, win) as n from win) where n > 1),
rep as (select rid, sum(least(5, coalesce(next_i - i, 5))) as n_repeat_words from (select rid, i, lead(i) over (partition by rid order by i) as next_i from twice) group by rid),
c as (select doc_id, len(words)::bigint as n_words, length(regexp_replace(body, '{_SPACES}', '', 'g'))::bigint as word_chars,
  (length(body) - length(translate(body, '{SYMBOLS}', '')))::bigint as n_symbols,
  (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
  length(body) - length(translate(body, '!?', '')) as n_loud, length(body) - length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as n_upper,
  len(list_filter(words, lambda x: lower(x) in ({_STOP}))) as n_stop, len(list_distinct(words)) as n_kinds, len(lines) as n_lines
  from w left join rep using (rid)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from c)
select doc_id, {", ".join(COUNTS)}, base_failed, not base_failed and {verdict()} as kept from b
"""
