import json
import os

from pyspark.sql import functions as F

from postlake.sources import ingest


def test_top_ids_limit(spark):
    ranked = spark.createDataFrame([(i + 1, i) for i in range(500)], "rank int, id bigint")
    assert [r.id for r in ingest.top_ids(ranked, 10).orderBy("rank").collect()] == list(range(10))
    assert ingest.top_ids(ranked, None).count() == 500


def test_hydrate_with_fake_fetcher(spark):
    def fetch(i):
        if i == 2:
            return None                       # deleted item: no row
        if i == 3:
            raise OSError("network down")     # retried, then reported
        return {"id": i, "type": "story", "title": f"t{i}", "score": i}
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id bigint")
    ok, bad = ingest.split_errors(ingest.hydrate(ids, fetch, partitions=2, backoff_base=0.0, backoff_cap=0.0))
    assert sorted(r.id for r in ok.collect()) == [1, 4]
    assert ok.where(F.col("ingested_at").isNull()).count() == 0
    assert [r.id for r in bad.collect()] == [3]


def test_retry_backoff():
    calls, sleeps = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise TimeoutError("slow")
        return x
    assert ingest.retry_call(flaky, 5, attempts=3, base=1, cap=10, sleep=sleeps.append) == 5
    assert sleeps == [1, 2]


def test_json_items_null_line(spark, workdir):
    os.makedirs(workdir.replace("file:", ""))
    path = f"{workdir}/items.json"
    with open(path.replace("file:", ""), "w") as f:
        f.write(json.dumps({"id": 1, "type": "story", "title": "x"}) + "\nnull\n\n{bad json\n" + '{"id": 2, "score": "abc"}\n')
    rows = ingest.read_items_json(spark, path).collect()
    assert [(r.id, r.title) for r in rows] == [(1, "x"), (2, None)]
    assert {r.line for r in ingest.json_rejects(spark, path).collect()} == {"{bad json", '{"id": 2, "score": "abc"}'}
