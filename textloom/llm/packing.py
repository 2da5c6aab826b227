"""Operator 1, packing: minimum bin slack over token windows.

Documents are tokenised and packed into sequences of `capacity` tokens. What exceeds a whole window is cut off in whole
windows; the remaining lengths of a buffer of documents form a multiset (a count for each length). For each window the
largest remaining length is placed and a bitset subset-sum dynamic programme over the others finds the reachable total
nearest to the capacity; backtracking through the bitsets gives the count of each length, and the pattern is repeated as
often as the counts allow. Where no multiset fills the window, one document is cut to close the gap, and what is left at
the end of a buffer is cut into powers of two, which need no padding.

Scale: each task packs its own input partition in buffers of at most `buffer_tokens` (a longer document counts as a
buffer of its own), so there is no shuffle, nothing reaches the driver and memory is bounded. A partition's pieces and
sequence ids depend on that partition alone: a lost task is simply run again.

Defined cases: null text is an empty one, which has the end id alone; a null doc_id stays null; repeated rows are packed
once for each row; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from textloom.llm.common import table, utf8_lists

CAPACITY, END_ID, BUFFER_TOKENS, CACHE_WORDS = 4096, 2, 8_000_000, 600_000

LITTLE = sys.byteorder == "little" and array("I").itemsize == 4

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: A word whose pieces are plain: letters that lower-case one to one and that no normal form changes, then marks.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")


class WordIds(dict):
    """UTF-8 bytes of a word -> its ids as little-endian 32-bit bytes, by the tokenizer; a bounded cache.

    The default tokenizer drops white space and never joins over it, so a text's ids are its words' ids. Plain words go to the
    tokenizer's model directly, lower-cased and with letters and marks apart as its own first steps do; all other words
    go through the whole tokenizer. Of any other tokenizer (path) nothing is assumed: it encodes whole texts."""

    def __init__(self, path: str | None):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.by_words = path is None
        self.whole = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.model = self.whole.model
        # the model's letter for each byte: printable bytes stand for themselves, the others follow from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letters = {b: chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)}
        assert set(self.letters.values()) == set(pre_tokenizers.ByteLevel.alphabet())

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if plain := PLAIN.fullmatch(text):
            stem, marks = plain[1].lower(), plain[2]
            if marks or stem != text:
                out = self[stem.encode()] + (self[marks.encode()] if marks else b"")
                if len(word) < 8:
                    self[word] = out
                return out
            ids = [x.id for x in self.model.tokenize(word.decode("latin-1").translate(self.letters))]
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = array("I", ids).tobytes() if LITTLE else np.asarray(ids, "<u4").tobytes()
        if len(word) < 100:
            self[word] = out
        return out

    def text(self, text: bytes) -> bytes:
        """bytes.split() splits at ASCII white space only; other separators stay inside words for the tokenizer to judge."""
        if not self.by_words:
            return np.asarray(self.whole.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self[w] for w in text.split()])


def _fill(free: list[int], have: dict[int, int], capacity: int) -> tuple[dict[int, int], int]:
    """The counts of lengths (the largest included) whose total is nearest to the capacity, and that total.

    free: lengths, ascending; those used up have a count of 0. Bit t of the set is 1 if a total of t can be reached."""
    mask = (1 << (capacity + 1)) - 1
    while not have[free[-1]]:
        free.pop()
    first = free[-1]
    bits, steps = 1 << first, []
    for at in range(bisect_right(free, capacity - first) - 1, -1, -1):
        length = free[at]
        copies = min(have[length] - (length == first), (capacity - first) // length)
        if copies <= 0:
            continue
        before = bits
        for _ in range(copies):
            wider = bits | (bits << length) & mask
            if wider == bits:
                break
            bits = wider
        steps.append((length, copies, before))
        if bits >> capacity:
            break
    total = at = bits.bit_length() - 1
    counts = {first: 1}
    for length, copies, before in reversed(steps):
        used = next(k for k in range(copies + 1) if at >= k * length and before >> (at - k * length) & 1)
        if used:
            counts[length] = counts.get(length, 0) + used
            at -= used * length
    return counts, total


def pack_lengths(lengths: list[int], capacity: int = CAPACITY, first_sequence: int = 0) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(item, start, length, sequence, offset) of every piece, and the next free sequence number."""
    pieces: list[tuple[int, int, int, int, int]] = []
    seq, pool, total = first_sequence, {}, 0
    for i, n in enumerate(lengths):
        whole = n // capacity * capacity
        for start in range(0, whole, capacity):
            pieces.append((i, start, capacity, seq, 0))
            seq += 1
        if n > whole:
            pool.setdefault(n - whole, []).append((i, whole))
            total += n - whole
    have = {k: len(v) for k, v in pool.items()}
    free = sorted(have)

    def take(length: int) -> tuple[int, int]:
        have[length] -= 1
        return pool[length].pop()

    while total >= capacity:
        if not seq & 63:
            free = [x for x in free if have[x]]
        counts, filled = _fill(free, have, capacity)
        gap = capacity - filled
        for _ in range(min(have[k] // c for k, c in counts.items())):
            at = 0
            for length, c in counts.items():
                for _ in range(c):
                    pieces.append((*take(length), length, seq, at))
                    at += length
            total -= filled
            if gap and total:  # every length left exceeds the gap: one is cut to close it, its rest goes back
                length = next(x for x in reversed(free) if have[x])
                i, start = take(length)
                head = min(gap, length)
                pieces.append((i, start, head, seq, at))
                total -= head
                if length > head:
                    rest = length - head
                    have[rest] = have.get(rest, 0) + 1
                    pool.setdefault(rest, []).append((i, start + head))
                    if (at := bisect_left(free, rest)) == len(free) or free[at] != rest:
                        free.insert(at, rest)
            seq += 1
            if total < capacity or any(have[k] < c for k, c in counts.items()):
                break
    left = [(i, start, k) for k in sorted(have, reverse=True) for i, start in (pool[k] if have[k] else [])]
    at, room = 0, 1 << (total.bit_length() - 1) if total else 0
    for i, start, n in left:
        while n:
            head = min(n, room - at)
            pieces.append((i, start, head, seq, at))
            start, n, at, total = start + head, n - head, at + head, total - head
            if at == room:
                seq, at, room = seq + 1, 0, 1 << (total.bit_length() - 1) if total else 0
    return pieces, seq


def pack(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None, buffer_tokens: int = BUFFER_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of all docs (doc_id, text); with_ids adds the piece's ids as ARRAY<INT>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seq = WordIds(tokenizer_path), TaskContext.get().partitionId() << 33
        end, keys, ids, held = np.asarray([end_id], "<u4").tobytes(), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal seq
            pieces, seq = pack_lengths([len(x) // 4 for x in ids], capacity, seq)
            for lo in range(0, len(pieces), 20_000):
                part = pieces[lo : lo + 20_000]
                item, start, length, number, at = (list(x) for x in zip(*part, strict=True))
                cut = [memoryview(ids[i])[4 * a : 4 * (a + n)] for i, a, n in zip(item, start, length, strict=True)]
                cols = [pa.array([keys[i] for i in item], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array([zlib.crc32(x) for x in cut], pa.int64()), pa.array([len(ids[i]) // 4 for i in item], pa.int64()), pa.array(number, pa.int64()), pa.array(at, pa.int64())]
                if with_ids:
                    flat = np.frombuffer(b"".join(cut), "<i4")
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids)
            keys.clear()
            ids.clear()

        for key, texts in utf8_lists(batches):
            for k, text in zip(key.to_pylist(), texts, strict=True):
                keys.append(k)
                ids.append(cache.text(text) + end)
                held += len(ids[-1]) // 4
                if held >= buffer_tokens:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
