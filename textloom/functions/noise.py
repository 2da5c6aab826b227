"""Controlled text noise: ten character kernels as native columns, and adjective removal with a pluggable tagger.

A kernel draws a word of three or more Latin letters, a place in it and a letter by keyed hashes. The text is cut into
words and the gaps between them, so a change costs one pass and no offsets are needed."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.hashing import draw, uniform
from textloom.functions.text import strip

#: Keys beside each key (fixed values).
NEIGHBOURS = {
    "a": "qwsz", "b": "vghn", "c": "xdfv", "d": "ersfxc", "e": "rdsw", "f": "drtgcv", "g": "ftyhbv", "h": "gyujnb", "i": "ujko",
    "j": "huikmn", "k": "jiol", "l": "kop", "m": "njk", "n": "bhjm", "o": "iklp", "p": "ol", "q": "wa", "r": "edft",
    "s": "awedxz", "t": "rfgy", "u": "yhji", "v": "cfgb", "w": "qase", "x": "zsdc", "y": "tghu", "z": "asx",
}
LETTERS, VOWELS, CONSONANTS = "abcdefghijklmnopqrstuvwxyz", "aeiou", "bcdfghjklmnpqrstvwxyz"
WORD = r"(?<![\p{L}\p{N}_])[a-zA-Z]{3,}(?![\p{L}\p{N}_])"
RUN = r"(.)\1{1,3}"
KERNELS = ("swap", "delete", "insert", "replace", "duplicate", "keyboard_typo", "case_flip", "vowel_sub", "consonant_sub", "repeat_drop")


def _put(word: Column, at: Column, new: Column, size: int = 1) -> Column:
    """word with the size characters from place at (0-based) replaced."""
    return F.concat(F.substring(word, F.lit(1), at), new, F.substring(word, at + size + 1, F.length(word)))


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), (n % len(letters)).cast("int") + 1, F.lit(1))


def _substitute(word: Column, among: str, at: Column, letter: Column) -> Column:
    """A drawn character of the class is replaced by a different one of it; words without one take any letter anywhere."""
    low = F.lower(word)
    places = F.filter(F.sequence(F.lit(1), F.length(low)), lambda i: F.contains(F.lit(among), F.substring(low, i, F.lit(1))))
    place = F.get(places, (at % F.greatest(F.size(places), F.lit(1))).cast("int")) - 1
    own = F.instr(F.lit(among), F.substring(low, place + 1, F.lit(1))) - 1
    other = _pick(among, own + 1 + letter % (len(among) - 1))
    return F.when(F.size(places) > 0, _put(low, place, other)).otherwise(_put(low, (at % F.length(low)).cast("int"), _pick(LETTERS, letter)))


def change_word(kernel: str, word: Column, at: Column, letter: Column) -> Column:
    """One kernel on one word; at and letter are draws."""
    n = F.length(word)
    i = (at % n).cast("int")
    if kernel == "swap":
        j = (at % (n - 1)).cast("int")
        return _put(word, j, F.concat(F.substring(word, j + 2, F.lit(1)), F.substring(word, j + 1, F.lit(1))), 2)
    if kernel == "delete":
        return _put(word, i, F.lit(""))
    if kernel == "insert":
        return _put(word, (at % (n + 1)).cast("int"), _pick(LETTERS, letter), 0)
    if kernel == "replace":
        return _put(F.lower(word), i, _pick(LETTERS, letter))
    if kernel == "duplicate":
        c = F.substring(word, i + 1, F.lit(1))
        return _put(word, i, F.concat(c, c))
    if kernel == "keyboard_typo":
        near = F.element_at(F.create_map(*[F.lit(x) for kv in NEIGHBOURS.items() for x in kv]), F.substring(F.lower(word), i + 1, F.lit(1)))
        return _put(F.lower(word), i, F.substring(near, (letter % F.length(near)).cast("int") + 1, F.lit(1)))
    if kernel == "case_flip":
        c = F.substring(word, i + 1, F.lit(1))
        return _put(word, i, F.when(c == F.upper(c), F.lower(c)).otherwise(F.upper(c)))
    if kernel == "vowel_sub":
        return _substitute(word, VOWELS, at, letter)
    if kernel == "consonant_sub":
        return _substitute(word, CONSONANTS, at, letter)
    raise ValueError(f"unknown kernel {kernel!r}")


def _weave(gaps: Column, words: Column, low: Column, high: Column) -> Column:
    """gaps[low] + words[low] + ... + words[high - 1] + gaps[high]."""
    body = F.array_join(F.flatten(F.transform(F.sequence(low, high - 1), lambda i: F.array(F.get(gaps, i), F.get(words, i)))), "")
    return F.concat(F.when(high > low, body).otherwise(""), F.get(gaps, high))


def add_noise(df: DataFrame, text: str, kernel: Column, seed: int | str, key: Column, purpose: str, out: str) -> DataFrame:
    """Adds column out: text changed by the kernel that column kernel names; null or unknown names and texts without a word change nothing."""
    words, gaps = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.split(F.col(text), WORD, -1)
    runs, between = F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0)), F.split(F.col(text), RUN, -1)
    df = df.withColumns({"__k": kernel, "__words": words, "__at": draw(seed, key, f"{purpose}:at"), "__letter": draw(seed, key, f"{purpose}:letter")})
    df = df.withColumns({"__runs": F.when(F.col("__k") == "repeat_drop", runs), "__n": (draw(seed, key, f"{purpose}:word") % F.greatest(F.size("__words"), F.lit(1))).cast("int")})
    # each run is dropped or not by one bit of a draw of its own; the first that is dropped counts
    coins = F.transform("__runs", lambda _, i: draw(seed, key, F.concat(F.lit(f"{purpose}:run"), i.cast("string"))) % 2 == 0)
    df = df.withColumn("__run", F.coalesce(F.array_position(coins, True).cast("int") - 1, F.lit(-1)))
    df = df.withColumns({"__word": F.get("__words", F.col("__n")), "__gaps": gaps, "__between": F.when(F.col("__run") >= 0, between)})
    new = F.lit(None).cast("string")
    for k in KERNELS[:-1]:
        new = F.when(F.col("__k") == k, change_word(k, F.col("__word"), F.col("__at"), F.col("__letter"))).otherwise(new)
    new = F.when(F.col("__k") == "repeat_drop", change_word("delete", F.col("__word"), F.col("__at"), F.col("__letter"))).otherwise(new)
    last = F.size("__words")
    spliced = F.concat(_weave(F.col("__gaps"), F.col("__words"), F.lit(0), F.col("__n")), new, _weave(F.col("__gaps"), F.col("__words"), F.col("__n") + 1, last))
    dropped = F.concat(_weave(F.col("__between"), F.col("__runs"), F.lit(0), F.col("__run")), F.substring(F.get("__runs", F.col("__run")), 1, 1), _weave(F.col("__between"), F.col("__runs"), F.col("__run") + 1, F.size("__runs")))
    df = df.withColumn(out, F.when((F.col("__k") == "repeat_drop") & (F.col("__run") >= 0), dropped).when(last == 0, F.col(text)).otherwise(F.coalesce(spliced, F.col(text))))
    return df.drop("__k", "__words", "__at", "__letter", "__runs", "__n", "__run", "__word", "__gaps", "__between")


TOKEN = re.compile(r"\w+(?:'\w+)?|[^\w\s]")
ADJECTIVE_ENDS = ("able", "ible", "ful", "less", "ous", "ive", "ish", "ical", "ial", "ant", "ent")


def suffix_tagger(tokens: list[str]) -> list[bool]:
    """Offline stand-in for a part-of-speech tagger: words of six or more letters with a common adjective ending."""
    return [len(t) >= 6 and t.lower().endswith(ADJECTIVE_ENDS) for t in tokens]


def drop_adjective(text: str, number: int, tagger: Callable[[list[str]], list[bool]] = suffix_tagger) -> tuple[str, str | None]:
    """text re-joined from its tokens without one adjective, and that word; texts without one, or under three tokens, stay."""
    tokens = TOKEN.findall(text)
    places = [i for i, is_adjective in enumerate(tagger(tokens)) if is_adjective] if len(tokens) >= 3 else []
    if not places:
        return text, None
    i = places[number % len(places)]
    return re.sub(r"\s+([.,;:!?])", r"\1", " ".join(tokens[:i] + tokens[i + 1 :])), tokens[i]


def adjective_udf(tagger: Callable[[list[str]], list[bool]] = suffix_tagger):
    """Arrow UDF (text, draw) -> struct<text, word>; null texts pass."""

    @F.pandas_udf("text string, word string")
    def run(text: pd.Series, number: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if t is None else drop_adjective(t, int(n), tagger) for t, n in zip(text, number, strict=True)]
        return pd.DataFrame(rows, columns=["text", "word"])

    return run


def augment(df: DataFrame, text: str, stress: Column, seed: int | str, key: Column, purpose: str, out: str, log: str, *, kernels: tuple[str, ...] = KERNELS, adjectives: bool = True, chances: tuple[float, float] = (0.2, 0.5), stress_chances: tuple[float, float] = (0.1, 0.4), tagger: Callable[[list[str]], list[bool]] = suffix_tagger) -> DataFrame:
    """Adds out, text after none, one or two rounds of noise, and log, ARRAY<STRUCT<type, word>> of the rounds that changed it.

    chances: of no round and of one round; the rest is two. Three rounds in four draw a kernel, else an adjective is removed."""
    kernels = tuple(k for k in (kernels or KERNELS) if k in KERNELS)
    u = uniform(seed, key, f"{purpose}:rounds")
    count = lambda p: F.when(u < p[0], 0).when(u < p[0] + p[1], 1).otherwise(2)
    entry = "array<struct<type:string,word:string>>"
    df = df.withColumns({"__rounds": F.when(stress, count(stress_chances)).otherwise(count(chances)), "__t0": strip(F.col(text)), log: F.array().cast(entry)})
    for r in (1, 2):
        before, after, name = f"__t{r - 1}", f"__t{r}", f"{purpose}:{r}"
        is_char = uniform(seed, key, f"{name}:kind") < 0.75
        active = F.col("__rounds") >= r
        kernel = F.when(active & is_char, F.get(F.array(*map(F.lit, kernels)), (draw(seed, key, f"{name}:kernel") % len(kernels)).cast("int")))
        df = add_noise(df.withColumn("__kernel", kernel), before, F.col("__kernel"), seed, key, name, "__noised")
        if adjectives:
            df = df.withColumn("__adj", adjective_udf(tagger)(F.when(active & ~is_char, F.col(before)), draw(seed, key, f"{name}:adjective")))
            df = df.withColumns({after: F.coalesce("__adj.text", "__noised"), log: F.when(F.col("__adj.word").isNotNull(), F.concat(log, F.array(F.struct(F.lit("adj_remove").alias("type"), F.col("__adj.word").alias("word"))).cast(entry))).when(F.col("__noised") != F.col(before), F.concat(log, F.array(F.struct(F.col("__kernel").alias("type"), F.lit(None).cast("string").alias("word"))).cast(entry))).otherwise(F.col(log))}).drop("__adj")
        else:
            df = df.withColumns({after: F.col("__noised"), log: F.when(F.col("__noised") != F.col(before), F.concat(log, F.array(F.struct(F.col("__kernel").alias("type"), F.lit(None).cast("string").alias("word"))).cast(entry))).otherwise(F.col(log))})
        df = df.drop("__noised", "__kernel")
    return df.withColumn(out, F.col("__t2")).drop("__t0", "__t1", "__t2", "__rounds")
