"""Token counts of a unigram tokenizer by count-only Viterbi.

An Aho-Corasick automaton lists all vocabulary pieces that end at a position;
dynamic programming keeps, per position, the best score and the number of
pieces on its path, never the path.  Ties as in the tokenizer: pieces are
tried by their start, from left to right, and a later one replaces the best
only if its score is higher, so of equal scores the earliest start wins.  A
character that no one-character piece covers may also be unknown, ``unk_gap``
under the lowest score; with byte pieces in the vocabulary it counts as many
tokens as it has UTF-8 bytes, otherwise neighbouring unknowns are one token.

Spaces are the mark U+2581 inside; a text gets one in front.  If no piece
holds the mark after another character (checked on the vocabulary) the best
path never crosses such a place, so texts are cut there and the counts of
their units are remembered by the task.

Plan: no shuffle; at most ``_KNOWN`` units per task; the vocabulary (under
1 MB, a fixed file) is broadcast.
"""

from __future__ import annotations

import functools
import re
from pathlib import Path

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType

from postlake.llm.common import pieces, table, with_fields, without

MARK = "▁"
_KNOWN = 600_000
_LONG = 256
_PIECE = 4 << 20
UNK_GAP = 10.0


class Pieces(dict):
    """Unit -> (score, tokens), filled on demand."""

    def __init__(self, scores: dict[str, float], byte_pieces: bool, lowest: float, unk_gap: float = UNK_GAP):
        super().__init__()
        self.scores, self.byte_pieces, self.unk = scores, byte_pieces, lowest - unk_gap
        self.matches = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        joined = any(MARK in p[k:] and p[k - 1] != MARK for p in scores for k in range(1, len(p)) if p[k] == MARK)
        # units end before each mark that follows another character
        self.cut = None if joined or MARK not in scores else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def best(self, unit: str) -> tuple[float, int]:
        n = len(unit)
        score, tokens, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (size, value) in self.matches.iter(unit):
            found[end].append((end + 1 - size, value))
        for end in range(1, n + 1):
            top, count, dark, single = None, 0, False, False
            for start, value in sorted(found[end - 1]):
                single = single or start == end - 1
                if top is None or score[start] + value > top:
                    top, count = score[start] + value, tokens[start] + 1
            if not single and (top is None or score[end - 1] + self.unk > top):
                top, dark = score[end - 1] + self.unk, True
                if self.byte_pieces:
                    count = tokens[end - 1] + len(unit[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    count = tokens[end - 1] + (not unknown[end - 1])
            score[end], tokens[end], unknown[end] = top, count, dark
        return score[n], tokens[n]

    def __missing__(self, unit: str) -> tuple[float, int]:
        got = self.best(unit)
        if len(unit) <= _LONG:
            if len(self) >= _KNOWN:
                self.clear()
            self[unit] = got
        return got

    def count(self, text: str | None) -> tuple[float, int]:
        """Score and number of tokens of a text."""
        if not text:
            return 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        if self.cut is None:
            return self.best(marked)
        score, tokens = 0.0, 0
        for s, t in map(self.__getitem__, self.cut.findall(marked)):
            score += s
            tokens += t
        return score, tokens


@functools.lru_cache(maxsize=4)
def load(content: bytes) -> Pieces:
    """The pieces of a sentencepiece model file; control, unknown and byte pieces match no text."""
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    n = model.get_piece_size()
    text = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return Pieces({model.id_to_piece(i): model.get_score(i) for i in text}, sum(map(model.is_byte, range(n))) == 256,
                  min(model.get_score(i) for i in range(n)))


def _count(content, text_col: str):
    def run(batches):
        vocabulary = load(content.value)
        for batch in batches:
            for piece in pieces(batch, text_col, _PIECE):
                got = list(map(vocabulary.count, piece.column(text_col).to_pylist()))
                yield pa.record_batch({c: piece.column(c) for c in piece.schema.names if c != text_col}
                                      | {"n_tokens": pa.array([t for _, t in got], pa.int64()),
                                         "score": pa.array([s for s, _ in got], pa.float64())})
    return run


def token_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens`` (long) and the best path's ``score`` (double).

    ``path`` is a sentencepiece model whose pieces and scores are used as a
    unigram vocabulary.  Null or empty text: 0 tokens, score 0.  Rows that
    repeat count alike; an empty table gives no rows; columns of the input
    named ``n_tokens`` or ``score`` are replaced.
    """
    docs = without(docs, "n_tokens", "score")
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    kept = docs.drop(text_col).schema
    return docs.mapInArrow(_count(content, text_col), with_fields(kept, ("n_tokens", LongType()), ("score", DoubleType())))


def op9(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        path or public_tokenizers.path("piece_bpe_32k.model"))
