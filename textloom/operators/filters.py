"""Row predicates: documents worth sampling, and the ordered quality rules that report a reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.config import QualityConfig
from textloom.functions import metrics
from textloom.functions.text import split_sentences, strip, word_count

#: Line beginnings of chat replies and headings (fixed values).
REPLY_START = r"(?i)^(sure[,! ]|here is|here's|as an ai|i'm an ai|i cannot|#+ |\*\s)"


def not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def is_garbage(sentences: Column, min_sentences: int = 4) -> Column:
    """Too few sentences, too short, too few letters, or program text."""
    joined = F.array_join(sentences, " ")
    alpha = metrics.alpha_ratio(joined)
    return (F.size(sentences) < min_sentences) | (F.length(joined) < 200) | (alpha < 0.55) | ((metrics.marker_count(joined) > 12) & (alpha < 0.65))


def quality_reason(text: Column, cfg: QualityConfig, *, is_ai: bool = False, prefix: Column | None = None, check_overlap: bool = True, max_words: int | None = None) -> Column:
    """The first rule that a text breaks, in the order of cost, or 'ok'."""
    t = strip(F.coalesce(text, F.lit("")))
    n, ls = word_count(t), metrics.lines(t)
    reason = (
        F.when(t == "", "empty")
        .when(n < cfg.word_count_min, "too_short")
        .when(n > (cfg.word_count_max if max_words is None else max_words), "too_long")
        .when(F.size(split_sentences(t)) < cfg.min_sentences, "too_few_sentences")
        .when(metrics.non_alnum_ratio(t) > cfg.max_non_alnum_ratio, "too_many_symbols")
        .when(metrics.repetition_score(t) > cfg.max_line_repetition, "repetitive")
        .when(metrics.bullet_ratio(t) > cfg.list_heavy_max_ratio, "list_heavy")
        .when(F.coalesce(F.get(ls, F.lit(0)), F.substring(t, 1, 120)).rlike(REPLY_START), "assistant_boilerplate")
    )
    if cfg.code_heavy_word_threshold > 0:
        reason = reason.when((metrics.code_hits(t) >= 3) & (n < cfg.code_heavy_word_threshold), "code_heavy")
    if is_ai and prefix is not None and check_overlap:
        reason = reason.when((F.coalesce(prefix, F.lit("")) != "") & (metrics.prefix_overlap(prefix, t) > cfg.ai_prefix_overlap_max), "ai_too_similar_to_prefix")
    return reason.otherwise("ok")
