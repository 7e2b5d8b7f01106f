"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task gathers the distinct pretokens of its batch that it hasn't met yet
and replays the merges over all of them at once: an inverted index leads
from a merge's rank to the word positions where its pair stands; ranks are
taken upwards, positions from left to right, and a merge only looks at its
two neighbours again; the index has arrays of positions, so one step merges a
pair wherever it stands.  With rank files a merge can give rise to a pair of
a lower rank, which a word-by-word encoder takes before the word's other
merges; such words, which are rare, are encoded by themselves.  A pretoken
that is itself an entry of the vocabulary is one token.

Plan: no shuffle.  Every pretoken is looked up in the task's table of known
words (at most ``_KNOWN`` of them, then started afresh; dropped with the
task); texts are joined from packed ids.  The vocabulary (about 1 MB, a fixed file) is broadcast.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from postlake.llm.common import pieces, table, with_fields, without

_KNOWN = 300_000
_LONG = 256  # characters beyond which a pretoken isn't kept
_PIECE = 2 << 20
_NONE = 1 << 31


class Vocabulary:
    """Ranks of byte strings, as in a rank file (base64 and rank a line)."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}
        # every pair of tokens that joins to a token, in key order
        get, found = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                if (a := get(token[:k])) is not None and (b := get(token[k:])) is not None:
                    found[a << 32 | b] = rank
        self.pair_keys = np.array(sorted(found), np.int64)
        self.pair_ranks = np.array([found[k] for k in self.pair_keys.tolist()], np.int64)
        # decoding: all tokens' bytes one after the other
        sizes = np.zeros(max(self.tokens) + 1, np.int64)
        for rank, token in self.tokens.items():
            sizes[rank] = len(token)
        self.token_sizes = sizes
        self.token_starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(self.tokens[r] for r in sorted(self.tokens)), np.uint8)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the merges of token pairs; ``_NONE`` where there is none."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def alone(self, word: bytes) -> list[int]:
        """One word by itself: always its lowest pair, the leftmost of equals."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        get, tokens, n = self.ranks.get, self.tokens, len(word)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]

        def low(k):
            return get(tokens[ids[k]] + tokens[ids[after[k]]], _NONE) if after[k] >= 0 else _NONE

        rank = [low(k) for k in range(n)]
        heap = [(r, k) for k, r in enumerate(rank) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            if rank[k] != r:
                continue
            gone = after[k]
            ids[k], ids[gone], rank[gone] = r, -1, _NONE
            after[k] = after[gone]
            if after[k] >= 0:
                before[after[k]] = k
            for at in (k, before[k]):
                if at >= 0:
                    rank[at] = low(at)
                    if rank[at] != _NONE:
                        heapq.heappush(heap, (rank[at], at))
        return [x for x in ids if x >= 0]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each word)."""
        sizes = np.array([len(w) for w in words], np.int64)
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        n = len(ids)
        if n == 0:
            return ids, sizes
        last = np.cumsum(sizes)[sizes > 0] - 1
        word = np.repeat(np.arange(len(words)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[last] = -1
        before[np.append(0, last[:-1] + 1)] = -1
        rank = np.full(n, _NONE)  # of the pair that starts at a position
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.pair(ids[inner], ids[inner + 1])
        # the index from a rank to positions, smallest rank first: as first found, and as merges add to it
        order = np.argsort(rank, kind="stable")
        order = order[:np.searchsorted(rank[order], _NONE)]
        ranks, cuts = np.unique(rank[order], return_index=True)
        stands = dict(zip(ranks.tolist(), np.split(order, cuts[1:]), strict=True)) if len(order) else {}
        more: dict[int, list[np.ndarray]] = {}
        heap = ranks.tolist()
        odd: list[np.ndarray] = []
        while heap:
            r = heapq.heappop(heap)
            at = stands.pop(r, None)
            if r in more:
                at = np.unique(np.concatenate(more.pop(r) + ([] if at is None else [at])))
            if at is None:
                continue
            at = at[rank[at] == r]
            if len(at) == 0:
                continue
            right = after[at]
            if len(at) > 1 and (right[:-1] == at[1:]).any():  # runs such as aaa: from the left, none twice
                kept, taken = [], -1
                for k, q in zip(at.tolist(), right.tolist(), strict=True):
                    if k != taken:
                        kept.append(k)
                        taken = q
                at = np.array(kept)
                right = after[at]
            ids[at], ids[right], rank[right] = r, -1, _NONE
            far = after[right]
            after[at] = far
            rank[at] = _NONE
            ahead = far >= 0
            before[far[ahead]] = at[ahead]
            back = before[at]
            touched = np.concatenate([at[ahead], back[back >= 0]])
            if len(touched) == 0:
                continue
            new = self.pair(ids[touched], ids[after[touched]])
            rank[touched] = new
            some = new != _NONE
            touched, new = touched[some], new[some]
            if len(new) == 0:
                continue
            if (early := new < r).any():
                odd.append(word[touched[early]])
            order = np.argsort(new, kind="stable")
            touched, new = touched[order], new[order]
            heads = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]])).tolist()
            for a, b in zip(heads, [*heads[1:], len(new)], strict=True):
                other = int(new[a])
                if other in more:
                    more[other].append(touched[a:b])
                else:
                    more[other] = [touched[a:b]]
                    if other not in stands:
                        heapq.heappush(heap, other)
        live = ids >= 0
        counts = np.bincount(word[live], minlength=len(words))
        ids = ids[live]
        if odd:
            ends = np.cumsum(counts)
            out = np.split(ids, ends[:-1])
            for w in np.unique(np.concatenate(odd)).tolist():
                out[w] = np.array(self.alone(words[w]), np.int64)
            ids, counts = np.concatenate(out), np.array([len(x) for x in out])
        return ids, counts

    def text(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids one after the other."""
        sizes = self.token_sizes[ids]
        ends = np.cumsum(sizes)
        if len(ids) == 0:
            return np.zeros(0, np.uint8)
        if (sizes == 0).any():
            raise ValueError("an id isn't in the vocabulary")
        return self.token_bytes[np.repeat(self.token_starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])]

    def packed(self, texts: list[list[str]]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, from its pretokens."""
        known = self.known
        fresh = list({w for words in texts for w in words if w not in known})
        if len(known) + len(fresh) > _KNOWN:
            known.clear()
            fresh = list({w for words in texts for w in words})
        raw = [w.encode("utf-8", "surrogatepass") for w in fresh]
        whole = [self.ranks.get(b) for b in raw]
        ids, counts = self.replay([b if r is None else b"" for b, r in zip(raw, whole, strict=True)])
        flat, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        for w, r, a, b in zip(fresh, whole, [0, *ends], ends):
            known[w] = flat[a:b] if r is None else r.to_bytes(4, "little")
        out = [b"".join(map(known.__getitem__, words)) for words in texts]
        for w in fresh:
            if len(w) > _LONG:
                del known[w]
        return out


@functools.lru_cache(maxsize=4)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def _packed_array(packed: list[bytes]) -> pa.Array:
    sizes = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))


def _encode(content, pattern: str, text_col: str, keep_text: bool = True):
    def run(batches):
        vocab, cut = vocabulary(content.value), regex.compile(pattern)
        for batch in batches:
            for piece in pieces(batch, text_col, _PIECE):
                texts = [cut.findall(t) if t else [] for t in piece.column(text_col).to_pylist()]
                yield pa.record_batch({c: piece.column(c) for c in piece.schema.names if keep_text or c != text_col}
                                      | {"ids": _packed_array(vocab.packed(texts))})
        vocab.known.clear()  # the worker may serve other stages next
    return run


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` array<int>: its text by the ranks in the file ``path``.

    ``pattern`` cuts a text into pretokens, each encoded by itself; there are
    no special tokens, so strings that look like one are ordinary text.  What
    the pattern doesn't match is left out (a pattern for round trips matches
    everything).  Null or empty text: no ids.  Rows that repeat are encoded
    alike; ``ids`` of the input is replaced; empty table: no rows.
    """
    docs = without(docs, "ids")
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    return docs.mapInArrow(_encode(content, pattern, text_col),
                           with_fields(docs.schema, ("ids", ArrayType(IntegerType()))))


def _decode(content, ids_col: str):
    def run(batches):
        vocab = vocabulary(content.value)
        for batch in batches:
            column = batch.column(ids_col)
            rows = [vocab.text(x.values.to_numpy(zero_copy_only=False)).tobytes() if x.is_valid else b"" for x in column]
            yield pa.record_batch({c: batch.column(c) for c in batch.schema.names}
                                  | {"decoded": pa.array(rows, pa.binary())})
    return run


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` binary: the bytes of its ids.  Null or no ids: no bytes; an unknown id is an error."""
    rows = without(rows, "decoded")
    content = rows.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    return rows.mapInArrow(_decode(content, ids_col), with_fields(rows.schema, ("decoded", BinaryType())))


def _digest(batches):
    for batch in batches:
        ids = batch.column("ids")
        flat, at = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(at).astype(np.int64)),
            "ids_sha256": pa.array([hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]),
            "decoded_sha256": pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("decoded")])})


def _then(*runs):
    """One pass through several functions of record batches: no copy of the ids goes through the JVM between them."""
    def run(batches):
        for f in runs:
            batches = f(batches)
        return batches
    return run


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``ids`` and ``decoded``: ``encode`` and ``decode`` in one pass over the rows."""
    docs = without(docs, "ids", "decoded")
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    return docs.mapInArrow(_then(_encode(content, pattern, text_col, False), _decode(content, "ids")),
                           with_fields(docs.drop(text_col).schema, ("ids", ArrayType(IntegerType())), ("decoded", BinaryType())))


def op10(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    content = spark.sparkContext.broadcast(Path(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = _then(_encode(content, public_tokenizers.PATTERN, "text", False), _decode(content, "ids"), _digest)
    return docs.mapInArrow(done, StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]))
