"""Ranked lexical search against plain scoring and SQL, and the bounds of the tree."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_util import DOCS, SCHEMA
from oracle_util import compare
from pyspark.sql import functions as F

from postlake.llm import fptree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    """Sorted (item position, rank, doc_id, score) by scoring every document."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_all = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for q, text in enumerate(items):
        scored = []
        for i, b, n in bags:
            m = 50 + 50 * n * n_docs // n_all
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m))
                    for t in set(terms(text)) if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(q, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def corpus(seed, n):
    r = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["ünï", "漢字", "Ab", "X9"]
    weight = 1 / np.arange(1, 65)
    docs = [(int(r.integers(0, 4 * n)), r.choice([" ", ", ", "-"]).join(r.choice(vocabulary, int(r.integers(0, 40)), p=weight / weight.sum())))
            for _ in range(n)]
    docs += [(9000 + k % 7, "w0 w1 w2 w40 w40 X9") for k in range(n // 3)] + [(None, "w50 w51"), (None, "w50 w51"), (5, None), (6, " .;\n")]
    items = [" ".join(r.choice(vocabulary, int(r.integers(1, 12)))) for _ in range(7)] + [None, "", "nowhere else", "w40 x9 w40", "w40 x9"]
    return docs, items


@pytest.mark.parametrize("seed, block, leaf", [(0, 50, 4), (1, 1000, 16), (2, 33, 1)])
def test_rank_matches_plain_scores(spark, seed, block, leaf):
    docs, items = corpus(seed, 150)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("n", "terms", "item", "score")})
    i = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("rank", F.lit(0))
    want = plain(docs, items, 20)
    for tile in (5, 1 << 16):
        got = fptree.rank(d, i, k=20, block_docs=block, leaf_docs=leaf, tile_terms=tile).collect()
        assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == sorted(want)


def test_bounds_hold_and_prune():
    r = np.random.default_rng(4)
    n_terms, vectors = 40, []
    for k in range(3000):  # two kinds of documents that share little
        of = np.arange(20) if k % 10 else np.arange(20, 40)
        t = np.unique(r.choice(of, 9))
        vectors.append((t, r.integers(1, 5, len(t))))
    cuts = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])])
    flat, tfs = (np.concatenate([v[j] for v in vectors]).astype(np.int64) for j in (0, 1))
    df = np.bincount(flat, minlength=n_terms)
    frequent = np.empty(n_terms, np.int64)
    frequent[np.argsort(-df, kind="stable")] = np.arange(n_terms)
    m = r.integers(50, 400, 3000)
    tree = fptree.Tree(cuts, flat, tfs, m, frequent, 32)
    weights = np.arange(1, n_terms + 1)
    leaves = [v for v in range(len(tree.lo)) if not tree.children[v]]
    assert sorted((tree.lo[v], tree.hi[v]) for v in leaves)[0][0] == 0 and sum(tree.hi[v] - tree.lo[v] for v in leaves) == 3000
    for v, kids in enumerate(tree.children):
        if kids:
            spans = sorted((tree.lo[c], tree.hi[c]) for c in kids)
            assert spans[0][0] == tree.lo[v] and spans[-1][1] == tree.hi[v] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    column = weights[tree.present]
    for v in leaves:
        assert (tree.scores(v, column) <= column @ tree.bounds[:, v]).all()
    item, best = np.arange(30, 38), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    scored = fptree.search_block(tree, np.arange(3000), [item], weights, best, 10)
    assert scored < 700  # of 3000: the subtrees of the other kind can't reach the tenth score
    every = [sum(int(weights[t]) * (10**9 * int(f) // (1000 * int(f) + 20 * int(m[j]))) for t, f in zip(*vectors[j]) if 30 <= t < 38) for j in range(3000)]
    assert best[0][0].tolist() == sorted(every, reverse=True)[:10]


def test_terms_are_compared_by_their_bytes(monkeypatch):
    known = fptree.Terms([b"alpha", b"beta"])
    data = np.frombuffer(b"alphabetaalphx", np.uint8)
    starts, ends = np.array([0, 5, 9]), np.array([5, 9, 14])
    assert known.find(data, starts, ends).tolist() == [0, 1, -1]
    monkeypatch.setattr(fptree, "span_hashes", lambda d, s, e: np.full(len(s), known.keys[0]))
    first = known.number[0]
    assert known.find(data, starts, ends).tolist() == [0 if first == 0 else -1, 1 if first == 1 else -1, -1]


def test_terms_of_pieces_part_at_documents():
    texts = ["ab", "cd ef", "", "é1-Z", None, "x" * 5]
    import pyarrow as pa
    offsets, data = fptree.utf8(pa.array(texts))
    starts, ends, doc = fptree.term_bounds(offsets, fptree._FOLD[data])
    got = [(int(d), bytes(fptree._FOLD[data][a:b]).decode()) for a, b, d in zip(starts, ends, doc)]
    assert got == [(k, t) for k, text in enumerate(texts) for t in terms(text)]


def test_exact_lengths_beyond_64_bits():
    n = np.array([10**7, 3], np.int64)
    assert fptree.lengths(n, 10**11, 7 * 10**12).tolist() == [50 + 50 * 10**7 * 10**11 // (7 * 10**12), 50 + 150 * 10**11 // (7 * 10**12)]


def test_registered_query_matches_sql_on_awkward_rows(spark, workdir):
    docs, items = corpus(7, 120)
    rows = DOCS + [(i, t, "en", "s", 1) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame([(k // 2, t) for k, t in enumerate(items)], "item_id long, text string").coalesce(1).write.parquet(
        f"{workdir}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{workdir}/{t}.parquet/*.parquet')")
    ok, said = compare(fptree.op12(spark, workdir), con, fptree.OP12_SQL)
    assert ok, said


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    docs = spark.createDataFrame(DOCS, SCHEMA)
    for d, i in ((none, some), (docs, some.where("false")), (none, some.where("false"))):
        out = fptree.rank(d, i)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]
