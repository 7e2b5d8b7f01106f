"""Substring dedup by the first occurrence of word runs, from a block index.

Every document is looked up in all documents with a smaller id.  The
reference is an index of all runs of ``window`` words (a suffix index cut
at that depth), split by key range into blocks; every batch of documents is
looked up in every block that holds one of its keys.  A lookup returns the
smallest document that holds the run.  This stands in for the longest-match
parse of RLZ: neighbouring runs with the same smallest document are joined
to a factor, whether or not they are neighbours in that document, so a
longer match in a later document isn't found.  Runs that straddle
the boundary between two factors are looked up like all others, so a
repeated passage that two reference documents share between them isn't
missed at the seam.

Plan: documents are cut into batches of about ``batch_bytes`` of text,
written once to the shared folder (compressed, so that batches are the same
whatever is recomputed later); each batch sends its sorted, distinct keys to
the blocks as byte planes (about 7 bytes a word); each block answers with
one bit a key plus the source of those keys it knows from an earlier
document; answers meet their batch in a shuffle by batch.  A run that stands
in a third of all documents is one key per batch, so no block is hot.  A
block holds words / blocks keys (about 60 bytes each while it works):
``blocks`` sets its memory; unless given it follows from the number of
batches, so that a block holds the runs of about 16 MB of text, and is the
session's shuffle partitions at least.  A batch takes about 60 bytes of memory
a byte of its text; a longer text is a batch of its own.
Keys are 64-bit hashes; two different runs among n collide with a
probability of n * n / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from postlake.llm.common import (NO_ID, block_cuts, ipc, mix64, normal_words, pack_keys, parts, pieces, span_hashes,
                                 string_array, table, unipc, unpack_keys, utf8, with_fields, without, word_bounds,
                                 written)

WINDOW = 13
FACTOR = ArrayType(StructType([StructField("start", IntegerType()), StructField("n_words", IntegerType()),
                               StructField("source_doc", LongType())]))
_FACTOR_ARROW = pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("source_doc", pa.int64())])
_BLOCK_BYTES = 16 << 20  # of text whose runs a block holds, about
_MULTIPLIER = 0xD1342543DE82EF95
ADDED = ("n_words", "n_removed", "factors")


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def _runs(batch: pa.RecordBatch, id_col: str, text_col: str, window: int):
    """Words of a batch and its distinct run keys.

    Returns (offsets, data, word starts, word ends, word's document, run
    starts, inverse, keys, ids, rank): ``keys`` are the sorted distinct run
    keys, ``keys[inverse]`` those of the runs, ``ids`` the sorted distinct
    document ids and ``ids[rank]`` the smallest id of the batch with the key.
    """
    offsets, data = utf8(batch.column(text_col))
    starts, ends, doc = word_bounds(offsets, data)
    words = span_hashes(data, starts, ends)
    n = len(words) - window + 1
    at = np.flatnonzero(doc[:n] == doc[window - 1:]).astype(np.int32) if n > 0 else np.zeros(0, np.int32)
    value = np.zeros(max(n, 0), np.uint64)
    factor = 1
    for j in range(window if n > 0 else 0):
        value += words[j:j + n] * np.uint64(factor)
        factor = factor * _MULTIPLIER % 2**64
    del words
    keys, inverse = np.unique(mix64(value[at]), return_inverse=True)
    del value
    inverse = inverse.astype(np.int32)
    ids, place = np.unique(_ids(batch.column(id_col)), return_inverse=True)
    rank = np.full(len(keys), len(ids), np.int32)
    np.minimum.at(rank, inverse, place[doc[at]].astype(np.int32))
    return offsets, data, starts, ends, doc, at, inverse, keys, ids, rank, place


def _pack(text_col: str, limit: int):
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch, text_col, limit):
                yield pa.record_batch({"batch": pa.array([(part << 32) + k], pa.int64()),
                                       "blob": pa.array([ipc(piece)], pa.binary())})
                k += 1
    return run


def _ask(id_col: str, text_col: str, window: int, blocks: int):
    def run(batches):
        for some in batches:
            for name, blob in zip(some.column("batch").to_pylist(), some.column("blob"), strict=True):
                *_, keys, ids, rank, _ = _runs(unipc(blob.as_buffer()), id_col, text_col, window)
                cuts = block_cuts(keys, blocks)
                who = ipc(pa.record_batch({"step": pa.array(np.diff(ids, prepend=0))}))
                for b in np.flatnonzero(np.diff(cuts)):
                    s = slice(cuts[b], cuts[b + 1])
                    yield pa.record_batch({"block": pa.array([b], pa.int32()), "batch": pa.array([name], pa.int64()),
                                           "keys": pa.array([pack_keys(keys[s], rank[s])], pa.binary()),
                                           "ids": pa.array([who], pa.binary())})
    return run


def _answer(batches):
    """One block: the smallest id of every key, told to the batches whose own smallest is larger."""
    lists: dict[int, list] = {}
    for some in batches:
        for block, name, keys, ids in zip(*(some.column(c).to_pylist() for c in ("block", "batch", "keys", "ids")),
                                          strict=True):
            lists.setdefault(block, []).append((name, keys, ids))
    for block, asked in sorted(lists.items()):
        known, least, sizes = [], [], []
        for _, blob, ids in asked:
            keys, rank = unpack_keys(blob)
            known.append(keys)
            least.append(np.cumsum(unipc(ids).column(0).to_numpy())[rank])
            sizes.append(len(keys))
        keys, own = np.concatenate(known), np.concatenate(least)
        del known, least
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
        del keys, sorted_keys
        low = np.minimum.reduceat(own[order], new)
        best = np.empty(len(own), np.int64)
        best[order] = np.repeat(low, np.diff(np.append(new, len(own))))
        at = 0
        for (name, _, _), n in zip(asked, sizes, strict=True):
            smaller = best[at:at + n] < own[at:at + n]
            told = ipc(pa.record_batch({"id": pa.array(best[at:at + n][smaller])}))
            yield pa.record_batch({"batch": pa.array([name], pa.int64()), "block": pa.array([block], pa.int32()),
                                   "blob": pa.array([told], pa.binary()),
                                   "bits": pa.array([np.packbits(smaller).tobytes()], pa.binary())})
            at += n


def _factors(runs_doc, at, source, first_word, window):
    """Greedy factors of the marked runs: (document, first word in it, words, source)."""
    if len(at) == 0:
        return [np.zeros(0, np.int64)] * 4
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (source[1:] != source[:-1]) | (runs_doc[1:] != runs_doc[:-1])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(at)))
    return [runs_doc[head], at[head] - first_word[runs_doc[head]], length + window - 1, source[head]]


def _parse(batch: pa.RecordBatch, answers: list, id_col: str, text_col: str, window: int, blocks: int):
    offsets, data, starts, ends, doc, at, inverse, keys, ids, rank, _ = _runs(batch, id_col, text_col, window)
    n_docs = batch.num_rows
    source = ids[rank] if len(keys) else np.zeros(0, np.int64)
    cuts = block_cuts(keys, blocks)
    for block, bits, told in answers:
        s = slice(cuts[block], cuts[block + 1])
        smaller = np.unpackbits(np.frombuffer(bits, np.uint8), count=s.stop - s.start).astype(bool)
        source[s][smaller] = unipc(told).column(0).to_numpy()
    own = _ids(batch.column(id_col))
    run_source = source[inverse] if len(at) else np.zeros(0, np.int64)
    marked = run_source < own[doc[at]]
    at, run_source = at[marked], run_source[marked]

    words = np.bincount(doc, minlength=n_docs)
    first_word = np.concatenate([[0], np.cumsum(words)])[:n_docs]
    fdoc, fstart, flen, fsource = _factors(doc[at], at, run_source, first_word, window)
    del keys, inverse, run_source, marked, at, source
    cover = np.zeros(len(starts) + 1, np.int32)
    begin = first_word[fdoc] + fstart if len(fdoc) else np.zeros(0, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + flen, -1)
    gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
    del cover

    # cut each removed word and the gap after it, up to the document's next word
    edge = np.zeros(len(data) + 1, np.int8)  # a byte starts one gap and ends one at most
    if gone.any():
        last = np.ones(len(starts), bool)
        last[:-1] = doc[1:] != doc[:-1]
        to = np.where(last, ends, np.append(starts[1:], 0))
        np.add.at(edge, starts[gone], 1)
        np.add.at(edge, to[gone], -1)
    keep = np.cumsum(edge[:-1], dtype=np.int8) == 0
    del edge
    removed_before = np.concatenate([[0], np.cumsum(~keep, dtype=np.int32)])
    text = string_array(offsets - removed_before[offsets], data[keep], batch.column(text_col).is_valid())

    counts = np.bincount(fdoc, minlength=n_docs)
    factors = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(fstart.astype(np.int32)), pa.array(flen.astype(np.int32)),
                                    pa.array(fsource.astype(np.int64))], fields=list(_FACTOR_ARROW)))
    columns = {c: (text if c == text_col else batch.column(c)) for c in batch.schema.names}
    return pa.record_batch(columns | {"n_words": pa.array(words.astype(np.int64)),
                                      "n_removed": pa.array(np.bincount(doc[gone], minlength=n_docs).astype(np.int64)),
                                      "factors": factors})


def _finish(id_col: str, text_col: str, window: int, blocks: int):
    def run(batches):
        name, blob, answers = None, None, []
        for some in batches:
            for b, block, data, bits in zip(*(some.column(c) for c in ("batch", "block", "blob", "bits")), strict=True):
                if b.as_py() != name:
                    if blob is not None:
                        yield _parse(unipc(blob), answers, id_col, text_col, window, blocks)
                    name, blob, answers = b.as_py(), data.as_py(), []
                else:
                    answers.append((block.as_py(), bits.as_py(), data.as_py()))
        if blob is not None:
            yield _parse(unipc(blob), answers, id_col, text_col, window, blocks)
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    blocks: int | None = None, batch_bytes: int = 1 << 20) -> DataFrame:
    """Remove passages that stand in a document with a smaller id.

    A word goes if it lies in a run of ``window`` words that also stands in
    a document with a smaller id; runs are judged on the input.  The result
    has the columns of ``docs``, the text without those words (and the gap
    after each; a text that loses none is unchanged), ``n_words`` and
    ``n_removed`` (long) and ``factors``: (start word, n_words, source_doc),
    neighbouring removed runs of one first occurrence (see the module), where
    neighbours may overlap.

    Null text: stays null, no words.  Texts of fewer words than ``window``
    lose none.  A null id sorts last: such a document never is a source.
    Rows with one id don't remove each other's words, as neither id is
    smaller.  Empty table: no rows.  ``factors``, ``n_words``, ``n_removed``
    of the input are replaced.
    """
    spark = docs.sparkSession
    docs = without(docs, *ADDED)
    stored = written(docs.mapInArrow(_pack(text_col, batch_bytes), "batch long, blob binary"), "rlz-batches")
    blocks = blocks or max(parts(spark), -(-stored.count() * batch_bytes // _BLOCK_BYTES))
    asked = stored.mapInArrow(_ask(id_col, text_col, window, blocks), "block int, batch long, keys binary, ids binary")
    told = (asked.repartitionById(blocks, F.col("block"))
            .mapInArrow(_answer, "batch long, block int, blob binary, bits binary"))
    both = stored.select("batch", F.lit(-1).alias("block"), "blob", F.lit(None).cast("binary").alias("bits")).unionByName(told)
    schema = with_fields(docs.schema, ("n_words", LongType()), ("n_removed", LongType()), ("factors", FACTOR))
    return (both.repartition(parts(spark), "batch").sortWithinPartitions("batch", "block")
            .mapInArrow(_finish(id_col, text_col, window, blocks), schema))


def op1(spark, sf_dir: str) -> DataFrame:
    done = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(normal_words(F.col("text")), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
s AS (SELECT row, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d),
r AS (SELECT row, doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(w[i:i + 12], ' ')) AS lo FROM s),
gone AS (SELECT DISTINCT row, r.i + t.j AS i FROM r, range(13) t(j) WHERE lo < doc_id OR doc_id IS NULL AND lo IS NOT NULL)
SELECT d.doc_id, any_value(len(d.w)) AS n_words, count(gone.i) AS n_removed,
       sha256(coalesce(string_agg(p.word, ' ' ORDER BY p.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN p ON p.row = d.row LEFT JOIN gone ON gone.row = p.row AND gone.i = p.i
GROUP BY d.row, d.doc_id
"""
