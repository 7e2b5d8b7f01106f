"""The quantised index: recall at its own settings, exact search with pruning, copies, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.operators import ann
from postlake.operators.search import knn, recall_at_k
from postlake.session import materialise


def clustered(spark, n=3000, dim=24, centres=30, seed=0):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(centres, dim))
    rows = [(k, (middle[k % centres] + 0.15 * r.normal(size=dim)).astype(np.float32).tolist(), f"t{k}") for k in range(n)]
    return materialise(spark.createDataFrame(rows, "id long, embedding array<float>, title string").repartition(6), "clustered")


def asked(vectors, step=100):
    return vectors.where(F.col("id") % step == 0).select(F.col("id").alias("query_id"), "embedding")


def ranks(df):
    return {(r.query_id, r["rank"]): r.id for r in df.collect()}


def test_recall_and_pruning_on_clusters(spark, workdir):
    vectors = clustered(spark)
    ann.build_index(vectors, workdir, payload=["title"], rows_per_cell=60)
    index = ann.open_index(spark, workdir)
    assert 40 <= len(index.sizes) <= 56 and index.nprobe <= 12 and sum(index.sizes.values()) == 3000
    queries = asked(vectors)
    exact = materialise(knn(vectors, queries, k=10), "exact")
    found = materialise(ann.search(spark, workdir, queries, k=10, payload=["title"]), "found")
    assert recall_at_k(found, exact) >= 0.9
    assert found.where(F.col("title") != F.concat(F.lit("t"), "id")).count() == 0
    pruned, pairs = ann.exact_search(spark, workdir, queries, k=10)
    assert ranks(pruned) == ranks(exact)
    assert pairs < 0.5 * 3000 * 30  # of all (query, row) pairs


def test_every_cell_and_row_is_exact_in_any_blocks(spark, workdir):
    vectors = clustered(spark, 500, dim=7, centres=5)
    odd = spark.createDataFrame([(9001, [0.0] * 7, "zero"), (9000, None, "null"), (9002, [1.0], "short")], vectors.schema)
    vectors = materialise(vectors.unionByName(odd), "with-odd")
    ann.build_index(vectors, workdir, rows_per_cell=40, codes=16)
    queries = asked(vectors.where("id < 500"), 50)
    exact = materialise(knn(vectors, queries, k=503), "exact")
    whole = ann.search(spark, workdir, queries, k=503, nprobe=999, shortlist=10**6, block_rows=16, tile_queries=3)
    assert ranks(whole) == ranks(exact)
    pruned, _ = ann.exact_search(spark, workdir, queries, k=503, block_rows=16, tile_queries=3)
    assert ranks(pruned) == ranks(exact)
    few = ann.search(spark, workdir, queries.withColumn("k", (F.lit(1) + F.col("query_id") % 3).cast("int")), k_col="k")
    assert all(sum(r.query_id == q for r in few.collect()) == 1 + q % 3 for q in range(0, 500, 50))
    # a query without a direction has no similarity to anything: smallest ids first, as in the exact search
    none = spark.createDataFrame([(1, [0.0] * 7), (2, None)], "query_id long, embedding array<float>")
    assert ranks(ann.exact_search(spark, workdir, none, k=5)[0]) == ranks(knn(vectors, none, k=5))
    assert ranks(ann.search(spark, workdir, none, k=5)) == ranks(knn(vectors, none, k=5))


def test_a_cell_of_copies_is_dealt_out(spark, workdir):
    vectors = clustered(spark, 300, dim=8, centres=6)
    copies = spark.range(1000, 1600).select("id", F.lit([0.5] * 8).cast("array<float>").alias("embedding"), F.lit("copy").alias("title"))
    vectors = materialise(vectors.unionByName(copies), "copies")
    ann.build_index(vectors, workdir, rows_per_cell=50)
    index = ann.open_index(spark, workdir)
    assert max(index.sizes.values()) >= 600
    probes = ann._probes(index, spark.createDataFrame([(1, [0.5] * 8, 5)], "query_id long, vector array<double>, k long"), None)
    here, there = ann._paired(spark, index, spark.read.parquet(f"{index.where}/codes"), probes, 60, 10)
    assert here.groupBy("cell", "_block", "_tile").count().agg(F.max("count")).first()[0] <= 90
    queries = spark.createDataFrame([(1, [0.5] * 8), (2, [0.4] * 8)], "query_id long, embedding array<float>")
    found = ann.search(spark, workdir, queries, k=5, block_rows=60)
    assert [ranks(found)[1, k] for k in range(1, 6)] == [1000, 1001, 1002, 1003, 1004]
    assert ranks(ann.exact_search(spark, workdir, queries, k=5, block_rows=60)[0]) == ranks(found)


def test_rebuild_empty_and_tiny(spark, workdir):
    vectors = clustered(spark, 40, dim=5, centres=4)
    ann.build_index(vectors.where("false"), workdir)
    assert ann.search(spark, workdir, asked(vectors, 10), k=3).count() == 0
    assert ann.exact_search(spark, workdir, asked(vectors, 10), k=3)[0].count() == 0
    ann.build_index(vectors, workdir)  # the newest version is read
    assert ann.open_index(spark, workdir).where.endswith("v=2")
    assert recall_at_k(ann.search(spark, workdir, asked(vectors, 10), k=3), knn(vectors, asked(vectors, 10), k=3)) >= 0.9
    assert ann.search(spark, workdir, asked(vectors, 10).where("false"), k=3).count() == 0


def test_lloyd():
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(0, .01, (50, 2)) + c for c in ((0, 0), (5, 5), (0, 9))]).astype(np.float32)
    centres = sorted(ann.lloyd(x, 3, 1).round().astype(int).tolist())
    assert centres == [[0, 0], [0, 9], [5, 5]]
    assert len(ann.lloyd(np.ones((9, 2), np.float32), 4, 0)) == 1


@pytest.mark.parametrize("dim, sub_dim", [(8, 4), (7, 4), (3, 4)])
def test_codes_approach_the_residuals(dim, sub_dim):
    r = np.random.default_rng(1)
    m = -(-dim // sub_dim)
    cells = ann.Cells(np.zeros((1, dim), np.float32), np.zeros(1, int), np.zeros((1, dim), np.float32), np.zeros((m, 1, sub_dim), np.float32), dim)
    x = r.normal(size=(400, dim)).astype(np.float32)
    cells.books = np.stack([ann.lloyd(p, 64, 2) for p in cells.parts(x)])
    back = np.concatenate([cells.books[s][c] for s, c in enumerate(cells.encode(x).T)], 1)[:, :dim]
    assert ((x - back) ** 2).mean() < 0.25 * (x ** 2).mean()


def test_a_shortlist_of_all_rows_passes_on_k_rows_a_block(spark, workdir, monkeypatch):
    vectors = clustered(spark, 1200, dim=6, centres=4)
    copies = spark.createDataFrame([(k, [1.0] * 6, "copy") for k in range(5000, 5600)], vectors.schema)
    odd = spark.createDataFrame([(9001, [0.0] * 6, "zero"), (9000, None, "null"), (9002, [1.0, 2.0], "short"), (9003, [float("nan")] * 6, "nan")], vectors.schema)
    vectors = materialise(vectors.unionByName(copies).unionByName(odd), "with-copies")
    ann.build_index(vectors, workdir, rows_per_cell=100, codes=16)
    queries = materialise(asked(vectors).unionByName(asked(odd.where("id <> 9000"), 1)), "asked-odd")
    exact = materialise(knn(vectors, queries, k=5), "exact")
    passed = []

    def counted(*args):
        out = ann_shortlisted(*args)

        def run(rows, asked):
            made = out(rows, asked)
            assert made.num_rows <= 5 * asked.num_rows, "a block passes on more than its best rows"
            return made
        passed.append(args)
        return run

    ann_shortlisted = ann._shortlisted
    monkeypatch.setattr(ann, "_shortlisted", counted)
    whole = materialise(ann.search(spark, workdir, queries, k=5, nprobe=999, shortlist=vectors.count(), block_rows=300, tile_queries=3), "whole")
    direct = [r.query_id for r in queries.where("query_id <> 9002").collect()]  # a query of another length meets rows of that length here alone
    mine = F.col("query_id").isin(direct)
    assert passed and ranks(whole.where(mine)) == ranks(exact.where(mine))
    monkeypatch.setattr(ann, "_shortlisted", ann_shortlisted)
    cut = ann.search(spark, workdir, queries, k=5, nprobe=999, shortlist=700, block_rows=300, tile_queries=3)
    assert cut.select("query_id").distinct().count() == queries.count()


def test_an_index_keeps_its_payload_beside_the_vectors(spark, workdir, monkeypatch):
    """texts aren't dealt to cells; a written table isn't copied; indexes built earlier are read as well."""
    r = np.random.default_rng(8)
    table = materialise(spark.createDataFrame([(i, [float(x) for x in r.normal(size=8)] if i % 50 else None, f"t{i}") for i in range(400)],
                                              "id long, embedding array<float>, title string"), "table")
    names = []
    monkeypatch.setattr(ann, "materialise", lambda df, name, *a: names.append(name) or materialise(df, name, *a))
    where = ann.build_index(table, workdir, payload=["title"], rows_per_cell=60, codes=16, row_key="id")
    assert "ann-rows" not in names
    assert "title" not in spark.read.parquet(f"{where}/rows").columns and spark.read.parquet(f"{where}/payload").count() == 400
    queries = asked(table, 40).where("embedding IS NOT NULL")
    want = {tuple(x) for x in knn(table, queries, k=6, payload=["title"]).collect()}
    for again in (False, True):
        if again:  # the layout of before: the payload beside the vectors
            rows = materialise(spark.read.parquet(f"{where}/rows").join(spark.read.parquet(f"{where}/payload"), "_row"), "old")
            monkeypatch.setattr(ann, "marked", lambda *a: False)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("coarse").parquet(f"{where}/rows")
        got = ann.search(spark, workdir, queries, k=6, nprobe=999, shortlist=10**6, payload=["title"])
        exact = ann.exact_search(spark, workdir, queries, k=6, payload=["title"])[0]
        for hits in (got, exact):
            assert hits.columns == ["query_id", "id", "title", "similarity", "rank"]
            assert {(x.query_id, x.id, x.title, x["rank"]) for x in hits.collect()} == {(q, i, t, n) for q, i, t, _, n in want}
