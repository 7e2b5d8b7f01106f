"""Substring dedup, SimHash near-dedup and mixing against plain versions, with the awkward cases."""

import numpy as np
import pytest
from llm_util import DOCS, SCHEMA, clashing, documents, linked, removed, simhash, words

from pyspark.sql import functions as F

from postlake.llm import pivotal, rlz, simhash as sim
from postlake.llm.components import components


def by_row(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_substring_dedup_matches_plain_version(spark):
    done = rlz.substring_dedup(clashing(documents(spark)), blocks=5, batch_bytes=600).collect()
    assert len(done) == len(DOCS)
    want = removed([(r[0], r[1]) for r in DOCS])
    got = sorted(((r.doc_id, words(r.text), r.n_words, r.n_removed) for r in done), key=repr)
    assert got == sorted(((i, k, len(words(t)), len(words(t)) - len(k)) for (i, t, *_), k in zip(DOCS, want)), key=repr)


def test_substring_dedup_keeps_untouched_texts_and_tells_sources(spark):
    rows = {r.doc_id: r for r in rlz.substring_dedup(documents(spark)).collect() if r.doc_id}
    assert rows[5].text is None and rows[7].text == " \t\n " and rows[1].text == DOCS[0][1]
    assert {f.source_doc for f in rows[4].factors} == {2} and rows[4].n_removed == rows[4].n_words
    assert rows[2].factors == [] and rows[8].n_removed == 0


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_random(spark, seed):
    r = np.random.default_rng(seed)
    pool = [" ".join(r.choice(list("abcd"), 20)) for _ in range(6)]
    rows = [(int(r.integers(0, 40)), " ".join([" ".join(r.choice(list("abcd"), r.integers(0, 30))), pool[r.integers(6)][r.integers(8) * 2:]]),
             "en", "s", 1) for _ in range(60)]
    done = rlz.substring_dedup(documents(spark, rows), blocks=3, batch_bytes=200)
    want = [(i, b" ".join(k)) for (i, *_), k in zip(rows, removed([(x[0], x[1]) for x in rows]))]
    assert sorted((x.doc_id, b" ".join(words(x.text))) for x in done.collect()) == sorted(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rlz.substring_dedup(none).count() == 0
    assert sim.near_duplicates(none).count() == 0 and sim.keep_one(none).count() == 0
    assert pivotal.mix(none).count() == 0 and pivotal.repeat(pivotal.mix(none)).count() == 0


def test_near_duplicates_match_plain_version(spark):
    got = by_row(sim.near_duplicates(clashing(documents(spark)), blocks=4, batch_rows=3), "doc_id", "fingerprint", "component_id")
    prints = [simhash(r[1]) for r in DOCS]
    roots = linked(prints)
    ids = {}
    for (i, *_), root in zip(DOCS, roots):
        if i is not None:
            ids[root] = min(ids.get(root, i), i)
    want = [(i, int(np.uint64(p).astype(np.int64)), ids.get(root)) for (i, *_), p, root in zip(DOCS, prints, roots)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_balls_find_every_link(bits):
    r = np.random.default_rng(bits)
    base = r.integers(0, 2**64, 12, dtype=np.uint64)
    some = [b ^ np.uint64(sum(1 << int(k) for k in r.choice(64, n, replace=False))) for b in base for n in (0, 1, 2, 3, 4, 5)]
    every, even = sim._balls(bits)
    keys = {}
    for f in some:
        for m in [*every, *(even if int(f).bit_count() % 2 == 0 else [])]:
            keys.setdefault(int(f ^ m), set()).add(int(f))
    for i, a in enumerate(some):
        for b in some[:i]:
            if 0 < int(a ^ b).bit_count() <= bits:
                assert any({int(a), int(b)} <= s for s in keys.values())


def test_near_duplicates_random_chains(spark):
    r = np.random.default_rng(5)
    text = [list(r.choice([f"w{k}" for k in range(50)], 120)) for _ in range(4)]
    rows = []
    for k in range(120):
        w = list(text[k % 4])
        for _ in range(r.integers(0, 4)):
            w[r.integers(len(w))] = f"x{r.integers(9)}"
        rows.append((int(1000 - k), " ".join(w), "en", "s", 1))
    prints = [simhash(x[1]) for x in rows]
    roots = linked(prints)
    low = {}
    for x, root in zip(rows, roots):
        low[root] = min(low.get(root, 10**9), x[0])
    got = {r.doc_id: r.component_id for r in sim.near_duplicates(documents(spark, rows), blocks=3).collect()}
    assert got == {x[0]: low[root] for x, root in zip(rows, roots)}
    kept = {r.doc_id for r in sim.keep_one(documents(spark, rows)).collect()}
    assert kept == set(low.values())


def test_keep_one_leaves_one_row_a_group(spark):
    df = documents(spark).withColumnRenamed("lang", "component_id")
    kept = sim.keep_one(df)
    assert kept.columns == df.columns
    roots = linked([simhash(r[1]) for r in DOCS])
    assert kept.count() == len(set(roots))


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 50), (100, 60), (60, 50), (7, 7), (-3, 100), (-3, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: -3 for k in (-3, 50, 60, 100)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def water(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again and again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def test_mix(spark):
    r = np.random.default_rng(1)
    rows = [(k, "w " * int(r.integers(0, 60)), "en", [None, "a", "b", "é", "zz"][int(r.integers(0, 5)) if k % 3 else 1], 1)
            for k in range(900)] + [(900 + k, "tiny", "en", "q", 1) for k in range(3)] + [(77, None, "en", "b", 1)] * 2
    df = clashing(documents(spark, rows))
    got = pivotal.mix(df, stream_docs=64).collect()
    again = pivotal.mix(df.repartition(7), stream_docs=64).collect()
    key = lambda x: (x.doc_id, x.source or "", x.text or "", x.copies)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target = water(sizes)
    for x in got:
        assert x.size == len(words(x.text)) and x.source_size == sizes[x.source]
        assert x.target == pytest.approx(target[x.source]) and 0 <= x.copies <= 3
        assert x.size or x.copies == 0
    for s in sizes:
        assert abs(sum(x.size * x.copies for x in got if x.source == s) - target[s]) <= 60
    taken = pivotal.repeat(pivotal.mix(documents(spark, rows), stream_docs=64))
    assert taken.columns == documents(spark, rows).columns and taken.count() == sum(x.copies for x in got)


def test_mix_expectation():
    """Each document's probability is kept on average."""
    r = np.random.default_rng(0)
    rows = [("s", 0, k, k, float(m), 0.3) for k, m in enumerate([50, 30, 9, 7, 5, 3, 2, 1])]
    total = np.zeros(8)
    for _ in range(4000):
        out, held = pivotal._against_rest(rows, r.random(8).tolist())
        assert sum(x[4] * x[5] for x in [*out, *([held] if held else [])]) == pytest.approx(0.3 * 107)
        for x in [*out, *([held] if held else [])]:
            total[x[2]] += x[5]
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_mix_takes_what_comes_nearest_in_small_sources(spark):
    """A source's largest document outweighs its target, and others fit: no coin decides whether it takes anything."""
    sizes = {"a": [20] * 10, "b": [700, 66, 63], "c": [500, 31, 30, 7]}
    rows = [(k, "w " * n, "en", s, 1) for k, (s, n) in enumerate((s, n) for s, some in sizes.items() for n in some)]
    for seed in range(4):
        got = pivotal.mix(documents(spark, rows), seed=seed).collect()
        for s, some in sizes.items():
            mine = [x for x in got if x.source == s]
            target, taken = mine[0].target, sum(x.size * x.copies for x in mine)
            whole = sum(int(x.target // x.source_size) * x.size for x in mine)
            sums = {whole}
            for n in some:
                sums |= {t + n for t in sums}
            assert abs(taken - target) <= max(7.0, 2 * min(abs(t - target) for t in sums), 0.1 * target), (s, seed, taken, target)


def test_close_ends_nearest():
    row = lambda words, p: ("s", 0, int(words), int(words), float(words), p, 1)
    closed = pivotal._close([row(636, 0.0), row(665, 0.0)], row(8000, 1437 / 8000))
    assert {x[4]: x[5] for x in closed} == {636.0: 1.0, 665.0: 1.0, 8000.0: 0.0}
    closed = pivotal._close([row(10, 1.0), row(3, 0.0)], row(100, 0.9))
    assert {x[4]: x[5] for x in closed} == {10.0: 0.0, 3.0: 0.0, 100.0: 1.0}
    assert [x[5] for x in pivotal._close([], row(10, 0.5))] == [0.0]


def test_internal_names_are_free_for_columns_of_the_input(spark):
    names = ("_row_id", "_row_unit", "_row_mark", "_row", "_source", "_id", "_unit", "_goal", "source_docs", "in_0", "in_1", "cells", "more")
    df = documents(spark)
    wide = df.withColumns({c: F.concat(F.lit(c), F.col("n_chars").cast("string")) for c in names})
    plain = sorted((r.doc_id or -1, r.text or "", r.copies) for r in pivotal.mix(df).collect())
    mixed = pivotal.mix(wide)
    assert mixed.columns == [*wide.columns, *pivotal.ADDED]
    assert sorted((r.doc_id or -1, r.text or "", r.copies) for r in mixed.collect()) == plain
    kept = sim.keep_one(wide)
    assert kept.columns == wide.columns and {r["_goal"] for r in kept.collect()} <= {None, *(f"_goal{r[4]}" for r in DOCS)}
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted((r.doc_id or -1, r.text or "") for r in sim.keep_one(df).collect())


def test_of_rows_equal_in_id_and_text_one_stays_whatever_the_partitions(spark):
    rows = [(1, "the same text", "en", f"s{k}", k) for k in range(9)]
    kept = {tuple(sim.keep_one(documents(spark, rows, n)).first()) for n in (1, 3, 7)}
    assert len(kept) == 1
