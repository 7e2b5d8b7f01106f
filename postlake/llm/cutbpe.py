"""BPE encoding and decoding by forced-boundary splitting, for vocabularies with word ends.

A merge joins two neighbours to a token of the vocabulary, so two bytes that
never stand side by side inside any token are never joined: between them
every word is cut for certain.  The bytes of all new words of a piece of text
stand in one array; one lookup of each neighbouring pair marks the cuts, the
last byte of a word counting as a symbol of its own, as tokens with a word end
hold it.  The fragments are encoded independently, short ones side by side in
rounds of one merge each, and concatenated; a fragment's merges are those the
whole word would have made there, in the same order, as no merge looks across
a cut.

Words are found as the tokenizer file says: texts are cut at its special
tokens, brought to NFC, lower-cased code point by code point, and matched by
its pattern.  Texts with code points on which the Unicode tables of Python and
of the tokenizers library may differ (those Python doesn't know, and marks
that the library orders otherwise) are normalised and cut into words by the
library's own tables; the fragments are encoded here in either case.

Plan: no shuffle, one pass in Arrow batches.  A piece holds about ``_PIECE``
bytes of text, a longer text is worked through in runs of ``_RUN`` characters
cut before a blank, so memory doesn't grow with it but for its ids and, where
it has no blank, the text itself.  Known words (at most ``_KNOWN``,
then started afresh) are dropped with the task.  The
tokenizer file (under 2 MB, fixed) is broadcast.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from postlake.llm.common import pieces, table, with_fields, without

_KNOWN = 300_000
_LONG = 256  # characters beyond which a word isn't kept
_PIECE = 2 << 20
_RUN = 1 << 20
_SHORT = 64  # symbols up to which fragments are merged side by side
_NONE = 1 << 31


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def _odd_points() -> np.ndarray:
    """True for code points on whose normal form, case or class the two Unicode tables may differ."""
    from tokenizers import normalizers

    odd, nfc = np.zeros(0x110000, bool), normalizers.NFC()
    for point in range(0x110000):
        c = chr(point)
        if unicodedata.category(c) == "Cn":
            odd[point] = True
        elif unicodedata.combining(c):
            tries = [a + b for a, b in (("a̕" + c, ""), ("a" + c, "̀"), ("aͅ" + c, "̧"), ("a" + c, "ְ"))]
            odd[point] = any(nfc.normalize_str(s) != unicodedata.normalize("NFC", s) for s in tries)
    return odd


class Vocabulary:
    """The model, pattern and special tokens of a tokenizer file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, special = spec["model"], spec["added_tokens"]
        first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if steps != ["NFC", "Replace", "Lowercase"] or first.get("type") != "Split" or spec["decoder"] or not first["invert"]:
            raise ValueError("only tokenizers that lower-case NFC text and split it by a pattern are supported")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
            raise ValueError("only special tokens that are matched as they stand are supported")
        self.content, self.words = content, regex.compile(first["pattern"]["Regex"])
        self.special = {t["content"]: int(t["id"]) for t in special}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if special else None

        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.single = np.array([vocab[c] for c in letters] + [vocab[c + end] for c in letters])  # symbols 256.. end a word
        # what may stand side by side inside a token, by symbol
        inside = np.zeros((512, 512), bool)
        for token in vocab:
            last = token.endswith(end) and token != end
            symbols = [byte_of[c] for c in (token[:-len(end)] if last else token)]
            if last:
                symbols[-1] += 256
            inside[symbols[:-1], symbols[1:]] = True
        self.inside = inside.ravel()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_ranks = np.array([self.merges[k] for k in self.pair_keys.tolist()], np.int64)
        self.tokens = {i: t.encode() for t, i in (vocab | self.special).items()}
        self.known: dict[str, bytes] = {}
        self.special_ids = {t: i.to_bytes(4, "little") for t, i in self.special.items()}

    @functools.cached_property
    def library(self):
        """The library's normaliser and splitter, for texts with odd code points."""
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(self.content.decode())
        back = {c: b for b, c in enumerate(byte_letters())}

        def cut(text: str) -> list[str]:
            found = whole.pre_tokenizer.pre_tokenize_str(whole.normalizer.normalize_str(text))
            return [bytes(back[c] for c in w).decode("utf-8") for w, _ in found]
        return cut

    # ------------------------------------------------------------- words

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii():
            if _odd_points()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
                return self.library(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() alone treats a final sigma by its place
        return self.words.findall(text.lower())

    def runs(self, text: str):
        """(special token or None, words, characters) of a text from left to right, in bounded runs."""
        for k, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if k % 2:
                yield part, [], len(part)
                continue
            at = 0
            while at < len(part):
                to = part.find(" ", at + _RUN) if len(part) - at > _RUN else -1
                to = len(part) if to < 0 else to
                yield None, self.split(part[at:to]), to - at
                at = to

    # --------------------------------------------------------- fragments

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merges of token pairs, by rank; ``_NONE`` where there is none."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def merge_short(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All short fragments side by side: each round makes every fragment's lowest merge, the leftmost of equals.

        Takes and returns (ids one after the other, number of ids of each fragment).
        """
        if len(sizes) == 0:
            return ids, sizes
        ids, n, live = ids.copy(), len(sizes), np.arange(len(sizes))
        done_ids, done_at = [], []
        place = np.repeat(live, sizes)
        ranks = np.full(len(ids), _NONE)
        ranks[:-1] = np.where(place[:-1] == place[1:], self.pairs(ids[:-1], ids[1:]), _NONE)
        while len(live):
            heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            low = np.minimum.reduceat(ranks, heads)
            over = low == _NONE
            if over.any():  # these fragments are finished
                out = np.repeat(over, sizes)
                done_ids.append(ids[out])
                done_at.append(place[out])
                ids, place, ranks = ids[~out], place[~out], ranks[~out]
                live, sizes, low = live[~over], sizes[~over], low[~over]
                if len(live) == 0:
                    break
            hits = np.flatnonzero(ranks == np.repeat(low, sizes))
            owner = place[hits]
            hits = hits[np.concatenate([[True], owner[1:] != owner[:-1]])]
            ids[hits] = self.made[low]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            ids, place, ranks = ids[keep], place[keep], ranks[keep]
            sizes = sizes - 1
            hits = hits - np.arange(len(hits))
            for left in (hits, hits[hits > 0] - 1):  # the pairs that a merged token starts and ends
                right = np.minimum(left + 1, len(ids) - 1)
                same = (place[left] == place[right]) & (right > left)
                ranks[left] = np.where(same, self.pairs(ids[left], ids[right]), _NONE)
        place = np.concatenate(done_at)
        order = np.argsort(place, kind="stable")
        return np.concatenate(done_ids)[order], np.bincount(place, minlength=n)

    def merge_long(self, ids: list[int]) -> list[int]:
        """One long fragment, by a heap of (rank, place) in one integer each over a linked list."""
        n, get = len(ids), self.merges.get
        after, before = np.arange(1, n + 1, dtype=np.int64), np.arange(-1, n - 1, dtype=np.int64)

        def entry(k):
            rank = get(ids[k] << 32 | ids[after[k]]) if after[k] < n else None
            return None if rank is None else rank << 40 | k

        heap = [e for e in map(entry, range(n)) if e is not None]
        heapq.heapify(heap)
        while heap:
            low = heapq.heappop(heap)
            k = low & ((1 << 40) - 1)
            if ids[k] < 0 or entry(k) != low:
                continue
            gone = int(after[k])
            ids[k], ids[gone] = int(self.made[low >> 40]), -1
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
            for at in (k, int(before[k])):
                if at >= 0 and (e := entry(at)) is not None:
                    heapq.heappush(heap, e)
        return [i for i in ids if i >= 0]

    def fragments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols of all words, where each fragment starts, the number of fragments before each word and at the end)."""
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(r) for r in raw])
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        symbols[ends - 1] += 256  # a word has one byte at least
        cut = np.ones(len(symbols), bool)
        cut[1:] = ~self.inside[symbols[:-1] * 512 + symbols[1:]]
        starts = np.flatnonzero(cut)
        return symbols, starts, np.searchsorted(starts, np.concatenate([[0], ends]))

    def _learn(self, fresh: list[str]) -> None:
        """Encode words that aren't known: cut them all at once, encode the fragments, put them together."""
        symbols, starts, heads = self.fragments(fresh)
        sizes = np.diff(np.append(starts, len(symbols)))
        long = np.flatnonzero(sizes > _SHORT)
        short = np.repeat(sizes <= _SHORT, sizes)
        counts = np.zeros(len(sizes), np.int64)
        ids, counts[sizes <= _SHORT] = self.merge_short(self.single[symbols[short]], sizes[sizes <= _SHORT])
        if len(long):
            parts, at = [], 0
            before = np.concatenate([[0], np.cumsum(counts)])
            for f in long.tolist():
                merged = self.merge_long(self.single[symbols[starts[f]:starts[f] + sizes[f]]].tolist())
                parts += [ids[at:before[f]], np.array(merged, np.int64)]
                at, counts[f] = before[f], len(merged)
            ids = np.concatenate([*parts, ids[at:]])
        flat, bounds = ids.astype("<u4").tobytes(), (np.concatenate([[0], np.cumsum(counts)])[heads] * 4).tolist()
        for word, a, b in zip(fresh, bounds[:-1], bounds[1:], strict=True):
            self.known[word] = flat[a:b]

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; new words of all texts are encoded together."""
        out = [[] for _ in texts]
        group, held = [], 0

        def settle():
            known = self.known
            fresh = list({w for _, words in group for w in words if w not in known})
            if fresh and len(known) + len(fresh) > _KNOWN:
                known.clear()
                fresh = list({w for _, words in group for w in words})
            if fresh:
                self._learn(fresh)
            for k, words in group:
                out[k].append(b"".join(map(known.__getitem__, words)))
            for w in fresh:
                if len(w) > _LONG:
                    del known[w]
            group.clear()

        for k, text in enumerate(texts):
            for special, words, size in self.runs(text or ""):
                if special is not None:
                    settle()
                    out[k].append(self.special_ids[special])
                    continue
                group.append((k, words))
                held += size
                if held >= _RUN:
                    settle()
                    held = 0
        settle()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens joined by blanks, as the library does where the file names no decoder."""
        return b" ".join([t for i in ids.tolist() if (t := self.tokens.get(i)) is not None])


@functools.lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def _encode(content, text_col: str, keep_text: bool = True):
    def run(batches):
        vocab = vocabulary(content.value)
        for batch in batches:
            for piece in pieces(batch, text_col, _PIECE):
                packed = vocab.packed(piece.column(text_col).to_pylist())
                sizes = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))
                yield pa.record_batch({c: piece.column(c) for c in piece.schema.names if keep_text or c != text_col}
                                      | {"ids": ids})
        vocab.known.clear()  # the worker may serve other stages next
    return run


def _decode(content, ids_col: str):
    def run(batches):
        vocab = vocabulary(content.value)
        for batch in batches:
            rows = [vocab.decode(x.values.drop_null().to_numpy()) if x.is_valid else b"" for x in batch.column(ids_col)]
            yield pa.record_batch({c: batch.column(c) for c in batch.schema.names}
                                  | {"decoded": pa.array(rows, pa.binary()).cast(pa.string())})
    return run


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` array<int>: its text by the tokenizer file ``path``, without added special tokens.

    Special tokens that stand in a text are encoded as such, as the library
    does.  Null, empty or blank text: no ids.  Very long texts: see the
    module.  Rows that repeat are encoded alike; ``ids`` of the input is
    replaced, other columns pass through; empty table: no rows.
    """
    docs = without(docs, "ids")
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    return docs.mapInArrow(_encode(content, text_col), with_fields(docs.schema, ("ids", ArrayType(IntegerType()))))


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` string: the tokens of its ids joined by blanks.

    Null or no ids: the empty string; null and unknown ids are left out, as
    the library does; ``decoded`` of the input is replaced.
    """
    rows = without(rows, "decoded")
    content = rows.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    return rows.mapInArrow(_decode(content, ids_col), with_fields(rows.schema, ("decoded", StringType())))


def _digest(batches):
    for batch in batches:
        ids = batch.column("ids")
        flat, at = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(at).astype(np.int64)),
            "ids_sha256": pa.array([hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("decoded")], pa.string())})


def op13(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    content = spark.sparkContext.broadcast(Path(path or public_tokenizers.path("word_bpe_49k.json")).read_bytes())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def run(batches):  # one pass: no copy of the ids goes through the JVM between the steps
        return _digest(_decode(content, "ids")(_encode(content, "text", False)(batches)))

    return docs.mapInArrow(run, StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]))
