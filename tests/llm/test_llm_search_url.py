"""Top-k search, URL filter, the registered queries against their SQL, and the pipeline."""

import re

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_util import DOCS, SCHEMA, documents, linked, removed, simhash, words
from oracle_util import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from postlake.llm import bitslice, crf, pivotal, queries, urltrees


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    ok, said = compare(queries.QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), queries.ORACLE[name])
    assert ok, said


@pytest.mark.parametrize("n,d,slices", [(100, 5, 9), (1000, 8, 3), (7, 3, 1), (300, 4, 2), (65, 64, 9), (50, 2, 60)])
def test_top_rows(n, d, slices):
    r = np.random.default_rng(n)
    rows = r.integers(-700, 700, (n, d))
    rows[: n // 2] = rows[n - n // 2:]
    ids, asked = r.permutation(n).astype(np.int64), np.arange(0, n, 3)
    a, b, c = bitslice.top_rows(rows, np.arange(n), ids, rows[asked], asked, 10, slices)
    want = []
    for i, q in enumerate(asked):
        scores = rows @ rows[q]
        want += [(i, ids[j], scores[j]) for j in np.lexsort((ids, -scores)) if j != q][:10]
    assert list(zip(a, ids[b], c)) == want


def test_top_k_awkward_vectors(spark):
    rows = [(0, [0.5, -0.5], 1), (100, [0.5, -0.5], 1), (1, [0.25, 0.0], 1), (2, None, 1), (3, [], 1), (4, [None, 1.0], 1),
            (5, [float("nan"), 1.0], 1), (6, [float("inf"), 0.0], 1), (7, [0.5, -0.5], 1), (7, [0.5, -0.5], 1),
            (None, [1.0, 1.0], 1), (200, [1.0, 0.0, 0.0], 1), (8, [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    for blocks in (2, 100):
        got = bitslice.top_k(df, F.col("vec_id") % 100 == 0, k=4, block_rows=blocks, tile_queries=1).collect()
        ranked = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got}
        assert [ranked[0, k] for k in range(1, 5)] == [(7, 524288), (7, 524288), (100, 524288), (1, 131072)]
        assert [ranked[100, k] for k in range(1, 5)] == [(0, 524288), (7, 524288), (7, 524288), (1, 131072)]
        assert not any(q == 200 for q, _ in ranked)
    assert bitslice.top_k(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_of_any_finite_size_matches_sql(spark, workdir):
    """Components far beyond 32 bits, scores beyond 64, ties there, null ids: what SQL says."""
    import duckdb

    r = np.random.default_rng(2)
    rows = [(0, [3e6, 1.0]), (1, [3e6, 1.0]), (2, [1.0, 1.0]), (None, [3e6, 2.0]), (3, [-3e6, 5.0]), (4, [2.0**40, 0.5]),
            (100, [4e5] * 64), (101, [4e5] * 64), (102, [1.0] * 64), (103, [-4e5] * 64), (104, [4e5] * 63 + [4e5 + 1]), (None, [4e5] * 64),
            (200, [2.0**52, -(2.0**51)]), (201, [2.0**52, -(2.0**51)]), (202, [float("inf"), 0.0])]
    rows += [(1000 + k, [float(x) for x in r.normal(0, 10.0 ** int(r.integers(0, 9)), 2)]) for k in range(60)]
    rows += [(2000 + k, [float(x) for x in r.normal(0, 4e5, 64)]) for k in range(40)]
    spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int").coalesce(1).write.parquet(
        f"{workdir}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{workdir}/embeddings.parquet/*.parquet')")
    ok, said = compare(bitslice.op3(spark, workdir), con, bitslice.OP3_SQL)
    assert ok, said
    df = spark.read.parquet(f"{workdir}/embeddings.parquet").withColumns({c: F.lit("clash") for c in ("key", "x", "size", "block", "past", "order")})
    split = bitslice.top_k(df, F.col("vec_id") % 100 == 0, block_rows=9, tile_queries=2)
    ok, said = compare(split, con, bitslice.OP3_SQL)
    assert ok, said


def test_order_bytes_sort_as_integers():
    r = np.random.default_rng(1)
    some = [int(x) ** 7 for x in r.integers(-(10**9), 10**9, 300)] + [0, 1, -1, 255, 256, -255, -256, 2**64, -(2**64)]
    assert sorted(some, key=bitslice._order) == sorted(some)


def plain_url(url):
    url = url or ""
    at = url.find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in urltrees.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


URLS = ["http://a.Example.NET/en/x?q=1#f", "https://example.net/de/1", "http://net/", "http://xnet/", "http://net", "ftp://a.example.com/de/",
        "http://b.example.com/fr/1", "http://x.org/fr/a", "http://x.org/fr", "http://org/fr/?a=b&c=d", "no scheme", "", None, "://", "a://b://c/d",
        "http://É.net/é", "http://example.net/en/" + "y" * 30000, "http://h.example.com?x=/de/", "http://example.com/de/", "http://example.com/de/"]


def test_urls(spark):
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in urltrees.url_verdicts(df, trees=3).collect()}
    assert len(got) == len(URLS)
    for k, url in enumerate(URLS):
        host, path, rule, verdict = plain_url(url)
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
        assert r.verdict in ("block", "allow")
    assert urltrees.url_verdicts(df.where("false")).count() == 0
    assert {r.verdict for r in urltrees.url_verdicts(df.where("page_id IN (10, 11)")).collect()} == {"allow"}
    assert {r.verdict for r in urltrees.url_verdicts(df.where("page_id IN (2, 10)")).collect()} == {"block"}


def test_url_trees_judge_unlabelled_urls_by_their_look(spark):
    """Trained on two labelled hosts, the trees tell the same two looks apart on hosts that no rule names."""
    r = np.random.default_rng(8)
    odd = lambda: f"/{r.integers(10**9)}/{r.integers(10**9)}?a={r.integers(10**6)}&b={r.integers(10**6)}"
    plain = lambda: "/" + "/".join(r.choice(["news", "about", "story", "help"], r.integers(1, 3)))
    rows = [(k, f"http://{h}.test{(odd if bad else plain)()}", bad) for k, (h, bad) in
            enumerate([("bad", True), ("good", False)] * 150 + [("one", True), ("one", False)] * 100)]
    rules = (("block", "bad.test/"), ("allow", "good.test/"))
    df = spark.createDataFrame([x[:2] for x in rows], "page_id long, url string")
    got = {x.page_id: (x.rule, x.verdict) for x in urltrees.url_verdicts(df, rules=rules, trees=5).collect()}
    free = [(got[k][1] == "block") == bad for k, _, bad in rows if got[k][0] is None]
    assert len(free) == 200 and sum(free) >= 190


def test_url_columns_may_have_any_names(spark):
    names = ("_features", "_raw", "_prediction", "_probability", "_of", "_said", "_suffix", "label", "in_1", "f_length", "URL2")
    df = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    wide = df.withColumns({c: F.lit(c) for c in names})
    got = urltrees.url_verdicts(wide, trees=3)
    assert got.columns == [*wide.columns, "host", "path", "rule", "verdict"]
    want = {r.page_id: r.verdict for r in urltrees.url_verdicts(df, trees=3).collect()}
    rows = got.collect()
    assert {r.page_id: r.verdict for r in rows} == want and all(r[c] == c for r in rows for c in names)


def test_a_url_of_many_copies_is_one_row_of_the_sample(spark):
    from pyspark.sql import functions as F
    urls = [(v, f"http://{v}.test/{k}") for v in ("block", "allow") for k in range(30)] + [("block", "http://block.test/7")] * 500
    full = spark.createDataFrame([*urls, (None, "http://free.test/")], "_said string, url string")
    full = full.withColumns({f: F.length("url").cast("double") for f in urltrees.FEATURES})
    for fit_rows, want in ((5, 5), (100, 30)):
        got = urltrees._sample(full, "url", fit_rows).collect()
        assert sorted(r.label for r in got) == [0.0] * want + [1.0] * want and len({r._pick for r in got}) == 2 * want


def test_the_url_sample_is_limited_in_every_task(spark):
    """At the registered 10,000 rows no window ranks all URLs of a verdict, and the picks are the smallest hashes."""
    from pyspark.sql import functions as F
    full = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "block").otherwise("allow").alias("_said"), F.concat(
        F.lit("http://a.test/"), F.col("id").cast("string")).alias("url"), *[F.lit(1.0).alias(f) for f in urltrees.FEATURES])
    plan = urltrees._sample(full, "url", 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("TakeOrderedAndProject") == 2
    hashes = [(r.said, r.pick) for r in full.select(F.col("_said").alias("said"), F.xxhash64("url").alias("pick")).collect()]
    want = {(float(v == "block"), p) for v in ("block", "allow") for p in sorted(p for s, p in hashes if s == v)[:40]}
    assert {(r.label, r._pick) for r in urltrees._sample(full, "url", 40).collect()} == want


def test_url_plan_has_no_python(spark):
    plan = urltrees.op4(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where(crf.fold_of(F.col("doc_id")) != 2)
    kept = corpus_pipeline.quality(spark, docs, SF_SMALL)
    scores = {r.doc_id: r.score for r in crf.quality(docs, crf.fit(docs, labels)).collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.7}

    rows = sorted(kept.collect())
    roots = linked([simhash(r.text) for r in rows])
    near = corpus_pipeline.near_dedup(spark, kept, SF_SMALL)
    assert sorted(near.collect()) == [rows[k] for k in sorted(set(roots))]

    rows = sorted(near.collect())
    cut = corpus_pipeline.substring_dedup(spark, near, SF_SMALL)
    want = {r.doc_id: k for r, k in zip(rows, removed([(r.doc_id, r.text) for r in rows]))}
    assert cut.columns == docs.columns and {r.doc_id: words(r.text) for r in cut.collect()} == want

    mixed = corpus_pipeline.mix(spark, cut, SF_SMALL).groupBy("doc_id").count().collect()
    copies = {r.doc_id: r.copies for r in pivotal.mix(cut).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixed} == copies
    last = corpus_pipeline.encode(spark, cut, SF_SMALL).collect()
    assert {r.doc_id: r.text for r in last} == {r.doc_id: r.text for r in cut.collect()}


def test_pipeline_runs_on_awkward_and_empty_tables(spark, tmp_path):
    for name, rows in (("awkward", DOCS), ("empty", [])):
        df = documents(spark, rows) if rows else spark.createDataFrame([], SCHEMA)
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (8, 0, 0), (2, 1, 0)] if rows else [], "doc_id long, quality int, toxic int").write.parquet(
            f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert out.columns == ["doc_id", "source", "ids", "n_tokens", "text"] and (out.count() > 0) == bool(rows)
