"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits meet if each emits the
variants of itself within about half of r.  For r = 3: every fingerprint
emits its 64 variants of one flipped bit, so that pairs at distance 2 meet.
Pairs at distance 1 or 3 have different parity, so only fingerprints with an
even number of ones also emit variants of two flipped bits; of three bits two
lie in the same half of the word, so the two flips may stay in one half: 992
variants rather than 2016, and no pair is lost.

A variant's members needn't be paired up: an odd member stands one flip from
an (even) variant and so within 3 bits of every other member.  One star per
variant, verified by the bit count, is enough for the same components; a
group of any size gives a number of links in proportion to its members.

Plan: fingerprints are written once; copies fold into one row per
fingerprint (with the smallest id) before anything is emitted.  Batches of
fingerprints send their variants, mixed by a bijection and sorted, to blocks
of the key space as byte planes (about 7 bytes a variant, 560 variants a
fingerprint); a block sorts its variants, verifies the stars and folds them
to a forest before they are shuffled.  Components come from ``components``.
A block holds variants / blocks keys, about 40 bytes each while it works.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from postlake.llm.common import (block_cuts, hot_join, ipc, mix64, numbered, pack_keys, parts, pieces, table, unipc, unpack_keys, utf8,
                                 with_fields, word_bounds, written)
from postlake.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 2 << 20  # text bytes that are worked on at once
_PER_CALL = 1 << 15  # shingles whose bits are counted at once


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _PER_CALL):
        some = np.ascontiguousarray(hashes[k:k + _PER_CALL])
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def fingerprints_of(offsets: np.ndarray, data: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of every text of a batch."""
    data = _LOWER[data]
    starts, ends, doc = word_bounds(offsets, data)
    out = np.zeros(len(offsets) - 1, np.uint64)
    cuts = np.searchsorted(doc, np.arange(len(offsets)))
    lengths = ends - starts
    # words joined by one space each: copy the bytes that belong to words, and a space after each word
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    joined = np.full(at[-1], 32, np.uint8)
    place = np.ones(at[-1], bool)
    place[at[1:] - 1] = False
    joined[place] = data[np.cumsum(inside[:-1]) > 0]
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    for d in np.flatnonzero(np.diff(cuts)):
        lo, hi = cuts[d], cuts[d + 1]
        span = min(shingle, hi - lo)
        first = at[lo:hi - span + 1].tolist()
        last = (at[lo + span:hi + 1] - 1).tolist()
        hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(first))
        out[d] = _majority(hashes)
    return out


def _fingerprint(text_col: str, shingle: int):
    def run(batches):
        for piece in (p for batch in batches for p in pieces(batch, text_col, _PIECE)):
            values = fingerprints_of(*utf8(piece.column(text_col)), shingle).view(np.int64)
            names = [c for c in piece.schema.names if c != text_col]
            yield pa.record_batch({c: piece.column(c) for c in names} | {"fingerprint": pa.array(values)})
    return run


def _balls(max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The flips that all fingerprints emit, and those that even ones emit besides."""
    one = [1 << i for i in range(64)]
    halves = [(1 << i) | (1 << j) for lo in (0, 32) for i in range(lo, lo + 32) for j in range(i + 1, lo + 32)]
    every, even = {0: ([], []), 1: ([0], one), 2: ([0, *one], []), 3: (one, halves)}[max_bits]
    return np.array(every, np.uint64), np.array(even, np.uint64)


def _emit(max_bits: int, blocks: int, batch_rows: int):
    def run(batches):
        every, even = _balls(max_bits)
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for k in range(0, len(values), batch_rows):
                some = values[k:k + batch_rows]
                paired = np.flatnonzero(np.bitwise_count(some) % 2 == 0)
                keys = np.concatenate([(some[:, None] ^ every).ravel(), (some[paired][:, None] ^ even).ravel()])
                who = np.concatenate([np.repeat(np.arange(len(some)), len(every)), np.repeat(paired, len(even))])
                keys = mix64(keys)
                order = np.argsort(keys)
                keys, who = keys[order], who[order]
                cuts, members = block_cuts(keys, blocks), ipc(pa.record_batch({"f": pa.array(some.view(np.int64))}))
                for b in np.flatnonzero(np.diff(cuts)):
                    s = slice(cuts[b], cuts[b + 1])
                    yield pa.record_batch({"block": pa.array([b], pa.int32()),
                                           "keys": pa.array([pack_keys(keys[s], who[s])], pa.binary()),
                                           "members": pa.array([members], pa.binary())})
    return run


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    root: dict[int, int] = {}

    def find(x):
        while (y := root.setdefault(x, x)) != x:
            root[x] = root[y]
            x = root[x]
        return x

    for a, b in links.tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in root if find(x) != x]


def _meet(max_bits: int):
    def run(batches):
        lists: dict[int, list] = {}
        for some in batches:
            for block, keys, members in zip(*(some.column(c).to_pylist() for c in ("block", "keys", "members")),
                                            strict=True):
                lists.setdefault(block, []).append((keys, members))
        for _, given in sorted(lists.items()):
            keys, who = [], []
            for blob, members in given:
                k, i = unpack_keys(blob)
                keys.append(k)
                who.append(unipc(members).column(0).to_numpy().view(np.uint64)[i])
            keys, who = np.concatenate(keys), np.concatenate(who)
            order = np.argsort(keys)
            keys = keys[order]
            same = np.flatnonzero(keys[1:] == keys[:-1])
            if len(same) == 0:
                continue
            shared = np.zeros(len(keys), bool)
            shared[same] = shared[same + 1] = True
            keys, who = keys[shared], who[order[shared]]
            # the centre of a star: its smallest odd member, or else its smallest
            even = np.bitwise_count(who) % 2 == 0
            order = np.lexsort((who, even, keys))
            keys, who = keys[order], who[order]
            head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            centre = np.repeat(who[head], np.diff(np.append(head, len(who))))
            ok = (np.bitwise_count(who ^ centre) <= max_bits) & (who != centre)
            links = np.unique(np.stack([who[ok], centre[ok]], 1).view(np.int64), axis=0)
            if len(links):
                forest = np.array(_forest(links), np.int64).reshape(-1, 2)
                yield pa.record_batch({"u": pa.array(forest[:, 0]), "v": pa.array(forest[:, 1])})
    return run


def _classed(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, blocks: int | None,
             batch_rows: int) -> DataFrame:
    """(id, mark of the text, fingerprint, root, component_id) of every row; root names the group."""
    if max_bits not in (0, 1, 2, 3):
        raise ValueError("max_bits must be 0, 1, 2 or 3")
    blocks = blocks or parts(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    schema = with_fields(narrow.select("id", "mark").schema, ("fingerprint", LongType()))
    rows = written(narrow.mapInArrow(_fingerprint("text", shingle), schema), "fingerprints")
    distinct = rows.groupBy("fingerprint").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("_n"))
    if max_bits:
        # dealt by another key than the aggregate's, whose partitions would be coalesced for their few bytes
        links = (distinct.select("fingerprint").repartition(blocks, F.xxhash64("fingerprint"))
                 .mapInArrow(_emit(max_bits, blocks, batch_rows), "block int, keys binary, members binary")
                 .repartitionById(blocks, F.col("block")).mapInArrow(_meet(max_bits), "u long, v long"))
        grouped = components(links)
        named = (distinct.join(grouped, distinct.fingerprint == grouped.node, "left")
                 .select("fingerprint", "low", "_n", F.coalesce("root", "fingerprint").alias("root")))
    else:
        named = distinct.select("fingerprint", "low", "_n", F.col("fingerprint").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = written(named.join(lows, "root").select("fingerprint", "root", "component_id", "_n"), "classes")
    return hot_join(rows, classes, "fingerprint", classes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, blocks: int | None = None, batch_rows: int = 2048) -> DataFrame:
    """(id, fingerprint long, component_id) of every row of ``docs``.

    A text's A-Z are lower-cased; its shingles are ``shingle`` words each,
    repeats included (fewer words: the whole sequence), hashed by XXH64 of
    their UTF-8 bytes with seed 42.  A fingerprint bit is one if it is set in
    more than half of the hashes; a text without words (null, empty) has
    fingerprint zero and is linked like any other.  Fingerprints of at most
    ``max_bits`` (0 to 3) differing bits are linked; ``component_id`` is the
    smallest id that can be reached, a null id counting as the largest.

    Rows that repeat, also under one id, are rows of their own.  Empty table:
    no rows.  Columns besides the id and the text are left out.
    """
    found = _classed(docs, id_col, text_col, shingle, max_bits, blocks, batch_rows)
    return found.select(F.col("id").alias(id_col), "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group, the one with the smallest id, columns unchanged.

    A null id counts as the largest; rows that share the smallest id are told
    apart by a hash of their text, then of the whole row, and of equal rows
    one stays.  Columns may have any names.
    """
    found = _classed(docs, id_col, text_col, shingle, max_bits, None, 2048)
    best = (found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("b"))
            .select(F.col("b.id").alias("_best_id"), F.col("b.mark").alias("_best_mark")))
    plain, given, (doc_id, text) = numbered(docs, id_col, text_col)
    marked = plain.withColumns({"_row_id": F.col(doc_id).cast("long"), "_row_mark": F.xxhash64(F.col(text).cast("string"))})
    stay = marked.join(best, F.col("_row_id").eqNullSafe(F.col("_best_id")) & (F.col("_row_mark") == F.col("_best_mark")),
                       "left_semi")
    hashed = [c for c, kind in plain.dtypes if "map<" not in kind and "variant" not in kind]  # others have no hash
    one = Window.partitionBy("_row_id", "_row_mark").orderBy(F.xxhash64(*hashed))
    return stay.withColumn("_row", F.row_number().over(one)).where("_row = 1").select(*given)


def op7(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
