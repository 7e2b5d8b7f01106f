"""The hourly job: the feature layers follow the change feed of the curated layer."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from postlake.operators.features import build_tabular_features, build_text_features
from postlake.plans import jobs
from postlake.plans.posts import posts
from postlake.session import materialise
from postlake.sources import lake
from postlake.sources.lake import Layout, changed_rows, latest_version, read_snapshot


@pytest.fixture()
def layout(spark, workdir):
    return Layout(workdir)


def items(spark, **changes):
    p = materialise(posts(spark, SF_SMALL).withColumn("ingested_at", F.lit("2024-01-01T07")), "items")
    return p.withColumns(changes) if changes else p


def same(a, b):
    cols = sorted(a.columns)
    return sorted(a.columns) == sorted(b.columns) and a.select(cols).exceptAll(b.select(cols)).count() == b.select(cols).exceptAll(a.select(cols)).count() == 0


def folders(spark, root):
    return lake._bucket_list(spark, root, latest_version(spark, root))["folders"]


def test_features_follow_changes_and_other_buckets_keep_their_files(spark, layout):
    first = items(spark)
    jobs.ingest_hour(spark, layout, first, "2024-01-01", "07")
    before = {r: folders(spark, r) for r in (layout.tabular, layout.text)}
    stories = [r.id for r in read_snapshot(spark, layout.tabular).select("id").orderBy("id").limit(3).collect()]
    # one more point, one story that becomes a job, one without a title: with a higher score all three replace their rows
    later = first.where(F.col("id").isin(stories)).withColumns({
        "score": F.col("score") + 1000, "type": F.when(F.col("id") == stories[1], "job").otherwise(F.col("type")),
        "title": F.when(F.col("id") != stories[2], F.col("title")), "ingested_at": F.lit("2024-01-01T08")})
    jobs.ingest_hour(spark, layout, later, "2024-01-01", "08")
    curated = read_snapshot(spark, layout.curated)
    assert same(read_snapshot(spark, layout.tabular), build_tabular_features(curated))
    assert same(read_snapshot(spark, layout.text), build_text_features(curated))
    left = {r.id for r in read_snapshot(spark, layout.tabular).select("id").collect()}
    assert stories[0] in left and stories[1] not in left and stories[2] not in left
    for root, old in before.items():
        now = folders(spark, root)
        moved = {b for b in {*old, *now} if old.get(b) != now.get(b)}
        assert 1 <= len(moved) <= 3 and len(now) > 8
    # an hour that is run again changes no row, so no bucket
    again = {r: folders(spark, r) for r in before}
    jobs.ingest_hour(spark, layout, later, "2024-01-01", "08")
    assert {r: folders(spark, r) for r in before} == again


def test_layers_of_unknown_or_lost_origin_are_rebuilt(spark, layout):
    first = items(spark)
    jobs.ingest_hour(spark, layout, first, "2024-01-01", "07")
    for k in range(3):  # the version the layers came from is pruned by other writers
        more = first.where(F.col("id") % 40 == k).withColumns({"score": F.col("score") + 100 + k, "ingested_at": F.lit(f"2024-01-01T1{k}")})
        lake.merge_snapshot(layout.curated, more, "id", jobs.curate, keep_versions=1)
    stray = build_tabular_features(items(spark, id=F.col("id") + 10**6))
    lake.write_snapshot(read_snapshot(spark, layout.tabular).unionByName(stray), layout.tabular)  # a whole table, without a mark
    jobs.ingest_hour(spark, layout, first.where("id < 5"), "2024-01-02", "07")
    curated = read_snapshot(spark, layout.curated)
    assert same(read_snapshot(spark, layout.tabular), build_tabular_features(curated))
    assert same(read_snapshot(spark, layout.text), build_text_features(curated))


def test_an_hour_without_stories_still_has_its_layers(spark, layout):
    jobs.ingest_hour(spark, layout, items(spark, type=F.lit("job")), "2024-01-01", "07")
    assert read_snapshot(spark, layout.tabular).count() == 0
    jobs.ingest_hour(spark, layout, items(spark, score=F.col("score") + 1), "2024-01-01", "08")
    assert same(read_snapshot(spark, layout.tabular), build_tabular_features(read_snapshot(spark, layout.curated)))
    jobs.ingest_hour(spark, layout, items(spark, score=F.col("score") + 5000, type=F.lit("job")), "2024-01-01", "09")
    out = read_snapshot(spark, layout.tabular)
    assert out.count() == 0 and "vai_bombar" in out.columns and "_gone" not in out.columns


def test_change_feed(spark, workdir):
    def put(rows):
        df = spark.createDataFrame(rows, "id long, v string, kids array<long>")
        return lake.merge_snapshot(workdir, df, "id", jobs._replaced, buckets=4)

    one = put([(k, f"a{k}", [k]) for k in range(40)])
    two = put([(3, "a3", [3]), (5, "new", None), (100, "x", [1])])
    rows, gone = changed_rows(spark, workdir, one)
    assert sorted((r.id, r.v) for r in rows.collect()) == [(5, "new"), (100, "x")] and gone.count() == 0
    back, lost = changed_rows(spark, workdir, two, until=one)
    assert [(r.id, r.v) for r in back.collect()] == [(5, "a5")] and [r.id for r in lost.collect()] == [100]
    assert changed_rows(spark, workdir, two)[0].count() == 0
    for since in (None, 77):
        rows, gone = changed_rows(spark, workdir, since)
        assert rows.count() == 41 and gone.count() == 0


def test_search_goes_through_the_index(spark, layout, monkeypatch):
    jobs.ingest_hour(spark, layout, items(spark), "2024-01-01", "07")
    jobs.index_daily(spark, layout)
    requests = spark.createDataFrame([(1, "the time of that", 5), (2, "", 3), (3, "und der", 2)], "query_id long, query string, k int")
    exact, rejected = jobs.search(spark, layout, requests, exact=True)
    monkeypatch.setattr(jobs, "knn", None)  # the index alone
    found, _ = jobs.search(spark, layout, requests)
    assert rejected.count() == 1 and found.columns == exact.columns
    got, want = ({(r.query_id, r.id): round(r.similarity, 9) for r in x.collect()} for x in (found, exact))
    assert len(got) == 7 and len(set(got) & set(want)) >= 6 and all(want[k] == v for k, v in got.items() if k in want)


def test_jobs_with_a_learnt_encoder(spark, layout):
    jobs.ingest_hour(spark, layout, items(spark), "2024-01-01", "07")
    assert jobs.load_encoder(spark, layout) is None
    made = jobs.train_encoder(spark, layout, dim=24, max_terms=500)
    encoder = jobs.load_encoder(spark, layout)
    assert encoder.name == made.name and encoder.dim == 24
    jobs.index_daily(spark, layout)  # rows of another encoder are never compared
    said = jobs.index_daily(spark, layout, encoder=encoder)
    assert said["vector_dim"] == 24 and said["embedding_model"] == encoder.name
    some = read_snapshot(spark, layout.text).orderBy("id").limit(4).collect()
    requests = spark.createDataFrame([(r.id, r.title, 3) for r in some], "query_id long, query string, k int")
    hits = jobs.search(spark, layout, requests, encoder=encoder)[0].collect()
    best = {r.query_id: r.similarity for r in hits if r["rank"] == 1}
    assert len(hits) == 12 and all(abs(best[r.id] - 1) < 1e-5 for r in some)  # a text finds itself or its copy


def test_an_hour_evaluates_its_items_once_and_refuses_none(spark, layout):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    first = items(spark)
    n = first.count()
    jobs.ingest_hour(spark, layout, first.mapInArrow(counted, first.schema), "2024-01-01", "07")
    assert seen.value == n  # before, a part of the rows was evaluated a second time to see whether there were any
    with pytest.raises(ValueError, match="empty hour 2024-01-01 07: nothing extracted"):
        jobs.ingest_hour(spark, layout, first.where("false"), "2024-01-01", "07")
    assert lake.read_raw(spark, layout.raw, "2024-01-01", "07").count() == n
    read = []
    feed = jobs.changed_rows
    jobs.changed_rows = lambda *a, **k: read.append(a) or feed(*a, **k)
    try:
        jobs.ingest_hour(spark, layout, first.where("id % 2 = 0").withColumns({"score": F.col("score") + 7, "ingested_at": F.lit("2024-01-01T08")}), "2024-01-01", "08")
    finally:
        jobs.changed_rows = feed
    assert len(read) == 1  # both layers follow one version
    curated = read_snapshot(spark, layout.curated)
    assert same(read_snapshot(spark, layout.tabular), build_tabular_features(curated))
    assert same(read_snapshot(spark, layout.text), build_text_features(curated))


def test_texts_are_shuffled_once_into_their_buckets(spark, layout, monkeypatch):
    """a merge deals old and new rows once; a feature layer takes its rows from the buckets' files, without a shuffle of texts."""
    plans, writer = [], lake._writer
    monkeypatch.setattr(lake, "_writer", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or writer(df))
    first = items(spark)
    jobs.ingest_hour(spark, layout, first, "2024-01-01", "07")
    jobs.ingest_hour(spark, layout, first.where("id % 2 = 0").withColumns({"score": F.col("score") + 7, "ingested_at": F.lit("2024-01-01T08")}), "2024-01-01", "08")
    assert [p.count("Exchange") for p in plans] == [0, 1, 0, 0, 0, 2, 0, 0]  # raw, curated, tabular, text of each hour
    rows, _ = changed_rows(spark, layout.curated, 1, until=2)
    shuffled = [line for line in rows.select("id")._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line]
    assert shuffled and all("title#" not in line for line in shuffled)  # texts are compared by digests


def test_merge_by_written_keys_is_the_merge(spark, workdir, monkeypatch):
    """Repeated, null and hot keys, missing columns: the merge that deals rows first gives the rows of the one that holds the batch."""
    ddl = "id long, title string, score long, ingested_at string"
    batches = [[(k % 30, f"t{k}", k % 7, f"{k % 3}") for k in range(90)] + [(None, "n", 1, "1"), (None, "m", None, None)],
               [(k, "é" * 100 + str(k), 5 + k % 3, "2") for k in range(0, 60, 3)] + [(None, "o", 9, "1")] + [(4, f"h{k}", k, "3") for k in range(8)]]
    for most in (1_000, 2):
        monkeypatch.setattr(lake, "HOT_ROWS", most)
        roots = [f"{workdir}/{most}-{kind}" for kind in ("held", "dealt")]
        for n, rows in enumerate(batches):
            batch = materialise(spark.createDataFrame(rows, ddl), "batch")
            batch = batch if n == 0 else batch.withColumn("url", F.concat(F.lit("u"), "title"))
            for root, keys in zip(roots, (None, batch.select("id")), strict=True):
                lake.merge_snapshot(root, batch, "id", jobs.curate, buckets=4, keys=keys)
        held, dealt = (read_snapshot(spark, r) for r in roots)
        assert held.columns == dealt.columns and held.count() == len({r[0] for b in batches for r in b}) and same(held, dealt)


def test_change_feed_compares_long_texts_and_nulls(spark, workdir):
    long = "x" * 200
    for rows in ([(1, long + "a", None), (2, long, "b"), (3, None, long)], [(1, long + "b", None), (2, long, "b"), (3, long, None)]):
        version = lake.merge_snapshot(workdir, spark.createDataFrame(rows, "id long, v string, w string"), "id", jobs._replaced, buckets=2)
    rows, gone = changed_rows(spark, workdir, version - 1)
    assert sorted(r.id for r in rows.collect()) == [1, 3] and gone.count() == 0


def test_text_features_choose_one_row_where_ids_repeat(spark):
    odd = items(spark).unionByName(items(spark, score=F.col("score") + 1, title=F.concat("title", F.lit(" x"))))
    assert same(build_text_features(odd, check_ids=True), build_text_features(odd))
    assert same(build_text_features(items(spark), check_ids=True), build_text_features(items(spark)))
