"""Hot keys and odd texts: joins dealt out, ranges of hot ids, bounded signatures, long labelled documents."""

import time

import numpy as np
import pyarrow as pa
import pytest
from llm_util import DOCS, SCHEMA, linked, simhash
from pyspark.sql import functions as F

from postlake.llm import common, crf, ctph
from postlake.llm import simhash as sim
from postlake.llm.components import components

M = 2**64


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % M
    return x ^ x >> 31


def plain_chunk(raw):
    value = 0
    for k, b in enumerate(raw):
        value += (b + 1) * pow(common._BASE, k, M)
    return plain_mix((value + len(raw) * 0xD6E8FEB86659FD93) % M)


def plain_signature(raw, size):
    """Byte by byte: a rolling hash of the last seven, a chunk ended at its hits, a character a chunk, runs cut to three."""
    out, chunk, last = [], b"", [0] * ctph.REACH
    for b in raw:
        last = last[1:] + [b + 1]
        chunk += bytes([b])
        rolling = 0
        for x in last:
            rolling = (rolling * int(ctph._STEP) + x) % M
        if (plain_mix(rolling) >> 20) % size == size - 1:
            out.append(chunk)
            chunk = b""
    if chunk or not raw:
        out.append(chunk)
    text = ""
    for c in out:
        letter = chr(ctph._ALPHABET[plain_chunk(c) >> 58])
        if not text.endswith(letter * ctph.RUN):
            text += letter
    return text


def plain_fingerprint(text):
    raw = (text or "").encode()
    if not raw:
        return "3::"
    size = 3
    while size * ctph.TARGET < len(raw):
        size *= 2
    while size > 3 and len(plain_signature(raw, size)) < ctph.SHORTEST:
        size //= 2
    while max(len(plain_signature(raw, s)) for s in (size, 2 * size)) > ctph.LONGEST:
        size *= 2
    return f"{size}:{plain_signature(raw, size)}:{plain_signature(raw, 2 * size)}"


def test_fingerprints_match_a_chunker_byte_by_byte():
    r = np.random.default_rng(0)
    texts = [d[1] for d in DOCS if not d[1] or len(d[1]) < 4000] + ["", "a", " " * 900, "ab" * 400, "abc" * 300, "-=" * 50 + "x"]
    texts += ["".join(r.choice(list("abcdefgh \n"), int(r.integers(1, 1500)))) for _ in range(25)]
    for t in texts:
        assert ctph.fingerprint(t) == plain_fingerprint(t)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_likeness_is_the_distance_of_bounded_signatures():
    r = np.random.default_rng(1)
    for _ in range(30):
        a = "".join(r.choice(list("ab"), int(r.integers(1, 30))))
        b = a[:7] + "".join(r.choice(list("abc"), int(r.integers(0, 20))))
        got = ctph._alike(a, b)
        assert got in (0.0, 1.0 if a == b else 1 - plain_distance(a, b) / max(len(a), len(b)))
    began = time.time()
    odd = [" " * 10_000_000, " " * 9_999_990 + "x" * 10, "ab" * 5_000_000, "0123456789" * 1_000_000, "-" * 5_000_000 + "=" * 5_000_000]
    prints = [ctph.fingerprint(t) for t in odd]
    assert all(len(p) <= 2 * ctph.LONGEST + 40 for p in prints)
    hashed = time.time()
    for a in prints:
        for b in prints:
            assert 0 <= ctph.likeness(a, b) <= 1
    assert time.time() - hashed < 1 and hashed - began < 120


@pytest.mark.parametrize("hot", [3, None])
def test_a_hot_id_spans_ranges(spark, hot):
    rows = [(hot if k % 3 else 100 + k, f"text number {k} of the table {k * k}", "en", "s", 1) for k in range(300)] + [(3, "x", "en", "s", 1), (None, "y", "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, one = (sorted(map(tuple, ctph.edited_fingerprints(df, ranges=n).collect()), key=repr) for n in (9, 1))
    assert got == one and len(got) == len(rows)
    ids = pa.array([None if r[0] is None else r[0] for r in rows], pa.int64())
    marks = np.random.default_rng(0).integers(-2**63, 2**63 - 1, len(rows))
    known = sorted(r[0] for r in rows if r[0] is not None)
    ranges = ctph.Ranges([known[k * len(known) // 9] for k in range(1, 9)], 6 if hot is None else 1)
    at = ranges.of(ids, marks)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, marks[k]))
    assert (np.diff(at[order]) >= 0).all() and at.max() < len(ranges) and np.bincount(at).max() < 90


def test_hot_join_deals_a_key_out(spark):
    big = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("k"), F.col("id").alias("v"))
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("_n"), F.max("v").alias("m"))
    joined = common.hot_join(big, small, "k", 5000)
    assert joined.columns == ["k", "v", "m"] and joined.exceptAll(big.join(small.drop("_n"), "k")).count() == 0 and joined.count() == 5000
    assert common.hot_join(big.where("false"), small.where("false"), "k", 0).count() == 0


def test_components_of_a_hub(spark):
    edges = [(0, k) for k in range(1, 700)] + [(k, k + 1000) for k in range(1, 300)] + [(5000, 5001)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    assert got == {n: 5000 if n >= 5000 else 0 for e in edges for n in e}


def test_a_fingerprint_of_a_third_of_all_rows(spark):
    rows = [(k, f"word {k} and so on {k * 7} it goes {k}" if k % 3 else None, "en", "s", 1) for k in range(600)]
    roots = linked([simhash(r[1]) for r in rows])
    got = {r.doc_id: r.component_id for r in sim.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    low = {}
    for (i, *_), root in zip(rows, roots):
        low[root] = min(low.get(root, i), i)
    assert got == {r[0]: low[root] for r, root in zip(rows, roots)}


def test_long_labelled_documents_take_part_in_the_fit(spark):
    good, bad = "A quiet sentence of plain words.", "$$$ 999 ### @@@ 123"
    rows = [(k, "\n".join([good if k % 2 else bad] * 900), "en", "s", 1) for k in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    field = crf.fit(docs, labels, steps=60, fit_lines=50)
    scores = {r.doc_id: r.score for r in crf.quality(docs, field).collect()}
    assert min(scores[k] for k in range(1, 20, 2)) > 0.7 > 0.3 > max(scores[k] for k in range(0, 20, 2))
    own = np.arange(900 * 2, dtype=np.float32).reshape(900, 2)
    runs = [crf._run_of(own, k, 50) for k in range(40)]
    assert all(len(r) == 50 and (np.diff(r[:, 0]) == 2).all() for r in runs) and len({r[0, 0] for r in runs}) > 20
    assert (crf._run_of(own, 5, 50) == crf._run_of(own, 5, 50)).all() and crf._run_of(own, 5, 900) is own
