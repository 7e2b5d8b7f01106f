import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from postlake.operators.embed import HashedBagOfWords, hashed_terms, hashed_vectors
from postlake.operators import search
from postlake.operators.search import build_ivf, ivf_search, knn, recall_at_k
from postlake.sources.tables import read_table
from postlake.sources.vectors import constraint_violations, read_vectors, upsert, upsert_snapshot


def test_upsert_whole_row_null_wins_and_idempotent(spark):
    old = spark.createDataFrame([(1, "u1", "a"), (2, "u2", "b")], "id bigint, url string, title string")
    new = spark.createDataFrame([(1, None, "a2"), (3, "u3", "c")], "id bigint, url string, title string")
    once = upsert(old, new)
    twice = upsert(once, new)
    assert sorted(once.collect()) == sorted(twice.collect())
    got = {r.id: (r.url, r.title) for r in once.collect()}
    assert got == {1: (None, "a2"), 2: ("u2", "b"), 3: ("u3", "c")}


def test_constraints(spark):
    df = spark.createDataFrame([(1, "t", [1.0, 0.0]), (1, "t", [1.0, 0.0]), (2, None, [1.0]), (3, "t", None)],
                               "id bigint, title string, embedding array<float>")
    got = sorted((r.id, r.reason) for r in constraint_violations(df, dim=2, not_null=("title", "embedding")).collect())
    assert got == [(1, "duplicate_id"), (2, "null_title"), (2, "wrong_dimension"), (3, "null_embedding")]


def test_knn_matches_brute_force_and_zero_vector_last(spark):
    rng = np.random.default_rng(0)
    vecs = rng.normal(size=(300, 8)).astype(np.float32)
    vecs[7] = 0.0
    rows = [(i, vecs[i].tolist()) for i in range(300)]
    v = spark.createDataFrame(rows, "id bigint, embedding array<float>").repartition(5)
    q = spark.createDataFrame([(0, vecs[3].tolist()), (1, (-vecs[5]).tolist())], "query_id int, embedding array<float>")
    hits = knn(v, q, k=300).collect()
    for qi, qv in [(0, vecs[3]), (1, -vecs[5])]:
        mine = [r.id for r in sorted((h for h in hits if h.query_id == qi), key=lambda r: r["rank"])]
        norms = np.linalg.norm(vecs.astype(np.float64), axis=1) * np.linalg.norm(qv.astype(np.float64))
        sims = np.where(norms > 0, vecs.astype(np.float64) @ qv.astype(np.float64) / np.where(norms > 0, norms, 1), -np.inf)
        expect = sorted(range(300), key=lambda i: (-round(sims[i], 9), i))
        assert mine == expect
        assert mine[-1] == 7


@pytest.mark.parametrize("block_rows,tile_queries,merge_blocks", [(7, 3, 2), (50, 100, 1)])
def test_knn_is_the_same_in_any_blocks(spark, block_rows, tile_queries, merge_blocks):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist(), f"t{i}") for i in range(120)] + [(120, None, "none"), (121, [1.0], "short")]
    v = spark.createDataFrame(rows, "id bigint, embedding array<double>, title string")
    q = v.where("id % 11 = 0").selectExpr("id AS query_id", "embedding", "CAST(1 + id % 5 AS INT) AS k")
    whole = knn(v, q, k_col="k", payload=["title"]).collect()
    cut = knn(v, q, k_col="k", payload=["title"], block_rows=block_rows, tile_queries=tile_queries, merge_blocks=merge_blocks).collect()
    key = lambda r: (r.query_id, r["rank"], r.id, r.title, r.similarity and round(r.similarity, 9))
    assert sorted(map(key, whole)) == sorted(map(key, cut))
    assert all(sum(r.query_id == i for r in whole) == 1 + i % 5 for i in range(0, 120, 11))


def test_ivf_recall_rebuild_and_zero_vector(spark, workdir):
    emb = read_table(spark, SF_MID, "embeddings")
    vecs = emb.select(F.col("vec_id").alias("id"), "embedding")
    vecs = vecs.unionByName(spark.createDataFrame([(-5, [0.0] * 64)], "id bigint, embedding array<double>").select(
        "id", F.col("embedding").cast("array<float>")))
    q = emb.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    exact = knn(vecs, q, k=10)
    build_ivf(vecs, workdir, cells=16)
    shares = [recall_at_k(ivf_search(spark, workdir, q, k=10, nprobe=n), exact) for n in (4, 13, 16)]
    assert shares[2] == 1.0 and shares[1] >= 0.9 and shares[0] >= 0.5
    last = [r for r in ivf_search(spark, workdir, q, k=1000, nprobe=16).collect() if r.query_id == 0]
    assert len(last) == 501 and max(last, key=lambda r: r["rank"]).id == -5
    build_ivf(vecs.where("id < 100"), workdir, cells=2)
    assert ivf_search(spark, workdir, q, k=1000, nprobe=2).where("query_id = 0").count() == 101


def test_ivf_groups_are_bounded_in_a_cell_of_copies(spark, workdir, monkeypatch):
    """Copies (some of one id) fill a cell, zero vectors another, and all queries probe them: no group outgrows its bound."""
    rng = np.random.default_rng(2)
    rows = [(i // 4 if i < 400 else i, [1.0, 0.0, 0.0]) for i in range(2400)] + [(i, [0.0] * 3) for i in range(3000, 4200)] + [
        (i, rng.normal(size=3).tolist()) for i in range(5000, 5200)]
    vecs = spark.createDataFrame(rows, "id bigint, embedding array<double>").repartition(3)
    q = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(60)], "query_id bigint, embedding array<double>")
    exact = knn(vecs, q, k=7)
    build_ivf(vecs, workdir, cells=3)
    plain = search._cell

    def bounded(kmax, payload, tile_queries, block_rows):
        run = plain(kmax, payload, tile_queries, block_rows)

        def checked(rows, queries):
            assert len(rows) <= 2 * 16 * block_rows and len(queries) <= 3 * tile_queries, (len(rows), len(queries))
            return run(rows, queries)
        return checked

    monkeypatch.setattr(search, "_cell", bounded)
    found = ivf_search(spark, workdir, q, k=7, nprobe=3, sub_blocks=1, block_rows=8, tile_queries=10)
    keys = ["query_id", "rank", "id"]
    assert sorted(found.select(*keys).collect()) == sorted(exact.select(*keys).collect())


def test_upsert_touches_only_its_buckets(spark, workdir):
    rows = [(i, f"t{i}", i) for i in range(200)] + [(None, "lost", 1)]
    ddl = "id bigint, title string, score int"
    assert upsert_snapshot(workdir, spark.createDataFrame(rows, ddl)) == 200
    before = set(read_vectors(spark, workdir).inputFiles())
    assert upsert_snapshot(workdir, spark.createDataFrame([(7, None, 1), (7, "older", 0), (500, "new", 1)], ddl)) == 2
    after = read_vectors(spark, workdir)
    assert len(before & set(after.inputFiles())) >= len(before) * 3 // 4
    got = {r.id: r.title for r in after.collect()}
    assert len(got) == 201 and got[7] is None and got[500] == "new"
    assert upsert_snapshot(workdir, spark.createDataFrame([], ddl)) == 0


def test_encoders_agree(spark):
    texts = ["Hello, world! hello", "Ünïcode wörds 42", "", "   "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, title string")
    dense = {r.id: np.array(r.embedding) for r in hashed_vectors(df).collect()}
    py = HashedBagOfWords()(texts)
    for i in range(len(texts)):
        assert np.allclose(dense[i], py[i], atol=1e-7)
    terms = hashed_terms(df).collect()
    for r in terms:
        assert abs(py[r.id][r.bucket] - r.weight) < 1e-6
    assert not np.any(dense[2]) and not np.any(dense[3])


def test_author_lookup_pushes_filter(spark, workdir):
    from postlake.operators.features import build_text_features
    from postlake.plans.posts import posts
    from postlake.sources.vectors import author_lookup, write_vectors_sorted
    from conftest import SF_SMALL
    t = build_text_features(posts(spark, SF_SMALL))
    write_vectors_sorted(t, f"{workdir}/vec")
    author = t.first().by_author
    got = author_lookup(spark, f"{workdir}/vec", author)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(by_author), EqualTo(by_author," in plan
    ts = [r.created_ts for r in got.collect()]
    assert ts == sorted(ts, reverse=True) and len(ts) == t.where(F.col("by_author") == author).count()


def test_knn_cells_are_small_and_carry_no_payload(spark, monkeypatch):
    from pyspark.sql import functions as F

    from postlake.operators import search
    rows = [(k % 40, [float(k % 7), 1.0, float(k % 3)], f"text {k}") for k in range(120)] + [(None, [0.0, 0.0, 0.0], "no id")]
    v = spark.createDataFrame(rows, "id long, embedding array<float>, title string")
    q = spark.createDataFrame([(1, [1.0, 2.0, 0.5]), (2, [0.0, 0.0, 0.0])], "query_id long, embedding array<float>")
    met, cell = [], search._search

    def seen(rows, *args):
        met.append(rows.schema)
        return cell(rows, *args)

    monkeypatch.setattr(search, "_search", seen)
    hits = knn(v, q, k=121, payload=["title"])
    assert hits.columns == ["query_id", "id", "title", "similarity", "rank"]
    assert "title" not in met[0].names and met[0]["vector"].dataType.elementType.simpleString() == "float"
    got = hits.where("query_id = 1")
    # every row once with its own text, though ids repeat and one is null
    assert sorted((r.id if r.id is not None else -1, r.title) for r in got.collect()) == sorted((i if i is not None else -1, t) for i, _, t in rows)
    parts = []
    monkeypatch.setattr(search, "_search", lambda rows, *args: parts.append(rows.agg(F.max("_group")).first()[0]) or cell(rows, *args))
    wide = spark.range(40_000).select("id", F.array(F.lit(1.0), F.rand(1)).cast("array<float>").alias("embedding"))
    assert knn(wide, q.select("query_id", F.slice("embedding", 1, 2).alias("embedding")), k=1).count() == 2
    assert parts == [2]  # three groups of at most about 16,384 rows; it was one of 40,000


def test_the_payload_of_a_written_table_is_neither_copied_nor_shuffled(spark, monkeypatch):
    """under a key of its own no row is copied, and the few winners meet the payload by a broadcast."""
    from postlake.operators import search
    from postlake.session import materialise
    rng = np.random.default_rng(4)
    table = materialise(spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)], f"t{i}") for i in range(200)],
                                              "id long, embedding array<double>, title string"), "table")
    q = table.where("id < 5").select(F.col("id").alias("query_id"), "embedding")
    want = {tuple(r) for r in knn(table, q, k=7, payload=["title"]).collect()}
    names, plain = [], search.materialise
    monkeypatch.setattr(search, "materialise", lambda df, name, *a: names.append(name) or plain(df, name, *a))
    hits = knn(table, q, k=7, payload=["title"], row_key="id")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert names == ["queries", "hits"] and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert {tuple(r) for r in hits.collect()} == want and len(want) == 35


def test_a_written_batch_is_upserted_as_any_other(spark, workdir, monkeypatch):
    from postlake.session import materialise
    from postlake.sources import lake
    ddl = "id long, title string, score int"
    batches = [[(k % 40, f"a{k}", k) for k in range(60)] + [(None, "n", 1)], [(k, f"b{k}", None) for k in range(30, 50)] + [(31, "c", 5)], []]
    plans, writer = [], lake._writer
    for n, rows in enumerate(batches):
        batch = materialise(spark.createDataFrame(rows, ddl), "batch")
        n_held = upsert_snapshot(f"{workdir}/held", batch)
        monkeypatch.setattr(lake, "_writer", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or writer(df))
        assert upsert_snapshot(f"{workdir}/written", batch, written=True) == n_held == [40, 20, 0][n]
        monkeypatch.setattr(lake, "_writer", writer)
        held, written = (sorted(map(tuple, read_vectors(spark, f"{workdir}/{x}").collect()), key=str) for x in ("held", "written"))
        assert held == written and len(held) == [40, 50, 50][n]
    assert [p.count("Exchange") for p in plans] == [1, 2]  # rows are shuffled once, the table's and the batch's
