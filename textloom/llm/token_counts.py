"""Operator 5, token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates all vocabulary matches of a word; dynamic programming over their ends carries the best
score and the number of pieces on the best path, without building pieces. Ties follow the tokenizer: of equal scores at an
end, the match that starts first stays. A character that no piece covers alone may be unknown, at the lowest score less
10; with byte fallback it then counts as its UTF-8 bytes, else runs of unknown characters count as one.

The vocabulary is a SentencePiece file's pieces and scores. Text is cut as the unigram tokenizer does: a space becomes the
mark U+2581, one is put before the text, and each mark starts a word, which no piece crosses. Control, unknown, byte and
unused pieces match no text: "<s>" in a text is three characters. A text's count is then the sum of its words' counts, so words are counted once and cached in a bounded dictionary in each worker.

Scale: one pass, no shuffle. Defined cases: null and empty texts have no token; a null doc_id stays null; repeated rows
each give a row; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import table, utf8_lists

MARK, UNKNOWN_PENALTY, CACHE_WORDS = "▁", 10.0, 600_000


class Vocabulary(NamedTuple):
    """Pieces with scores by id, and the ids of those that no text matches: control, unknown, byte and unused pieces."""

    pieces: list[tuple[str, float]]
    hidden: frozenset[int]


def vocabulary(path: str | None = None) -> Vocabulary:
    """The pieces of a SentencePiece file; by default the public 32k one."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    held = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    ids = range(held.vocab_size())
    return Vocabulary([(held.id_to_piece(i), held.get_score(i)) for i in ids], frozenset(i for i in ids if held.is_control(i) or held.is_unknown(i) or held.is_byte(i) or held.is_unused(i)))


class WordCounts(dict):
    """Word as UTF-8 bytes, without its mark -> number of pieces."""

    def __init__(self, pieces: list[tuple[str, float]], hidden: Collection[int] = (0,), byte_fallback: bool = True):
        super().__init__()
        import ahocorasick

        self.matches = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if piece and i not in hidden:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        names = {p for p, _ in pieces}
        self.bytes = {b for b in range(256) if byte_fallback and f"<0x{b:02X}>" in names}

    def count(self, word: str) -> int:
        """Pieces on the best path of a word with its mark."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (size, score) in self.matches.iter(word):
            ends[end].append((size, score))
        best, count, run = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            top, start, lone = None, 0, False
            for size, score in sorted(ends[end], reverse=True):  # first starts first
                lone |= size == 1
                if top is None or score + best[end + 1 - size] > top:
                    top, start = score + best[end + 1 - size], end + 1 - size
            if not lone and (top is None or self.unknown_score + best[end] > top):
                raw = word[end].encode()
                whole = all(b in self.bytes for b in raw)
                # an unknown run of characters that bytes cannot spell is one piece; run: its end so far
                best[end + 1], count[end + 1], run[end + 1] = self.unknown_score + best[end], count[end] + (len(raw) if whole else 0 if run[end] else 1), not whole
            else:
                best[end + 1], count[end + 1] = top, count[start] + 1
        return count[n]

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self.count(MARK + word.decode())
        if len(word) < 100:
            self[word] = n
        return n

    def text(self, text: bytes) -> int:
        if not text:
            return 0
        text = text.replace(MARK.encode(), b" ")
        return sum(map(self.__getitem__, text.removeprefix(b" ").split(b" ")))


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = WordCounts(*vocabulary(path))
        for key, texts in utf8_lists(batches):
            yield pa.RecordBatch.from_arrays([key, pa.array(map(len, texts), pa.int64()), pa.array(map(counts.text, texts), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
