import pytest

from postlake.operators.curate import best_per_key, curate, union_by_name
from postlake.sources import lake

SNAP_DDL = "id bigint, score bigint, ingested_at string, title string"


def test_keeps_max_score_nulls_last_and_ties_by_latest(spark):
    df = spark.createDataFrame([
        (1, 5, "2024-01-01T00", "a"), (1, 9, "2024-01-01T01", "b"), (1, 7, "2024-01-01T02", "c"),
        (7, None, "2024-01-01T00", "n"),
        (8, 9, "2024-01-01T00", "old"), (8, 9, "2024-01-01T05", "new"),
        (9, None, "2024-01-01T00", "x"), (9, 3, "2024-01-01T00", "y"),
    ], SNAP_DDL)
    got = {r.id: r.title for r in best_per_key(df, "id", ("score", "ingested_at")).collect()}
    assert got == {1: "b", 7: "n", 8: "new", 9: "y"}


def test_curate_is_order_independent_and_idempotent(spark):
    a = spark.createDataFrame([(1, 5, "t1", "a"), (2, 3, "t1", "b")], SNAP_DDL)
    b = spark.createDataFrame([(1, 9, "t2", "c"), (3, 1, "t2", "d")], SNAP_DDL)
    ab = sorted(curate(a, b).collect())
    ba = sorted(curate(b, a).collect())
    again = sorted(curate(curate(a, b), b).collect())
    assert ab == ba == again


def test_union_missing_column(spark):
    a = spark.createDataFrame([(1, 2)], "id bigint, descendants bigint")
    b = spark.createDataFrame([(2,)], "id bigint")
    rows = {r.id: r.descendants for r in union_by_name(a, b).collect()}
    assert rows == {1: 2, 2: None}


def test_rerun_hour_replaces_only_that_hour(spark, workdir):
    root = f"{workdir}/raw"
    one = spark.createDataFrame([(1,)], "id bigint")
    two = spark.createDataFrame([(2,), (3,)], "id bigint")
    lake.write_hour(one, root, "2024-01-01", "07")
    lake.write_hour(two, root, "2024-01-01", "08")
    lake.write_hour(two, root, "2024-01-01", "07")
    got = {(r.dt, r.hr): r.n for r in lake.read_raw(spark, root).groupBy("dt", "hr").count().withColumnRenamed("count", "n").collect()}
    assert got == {("2024-01-01", "07"): 2, ("2024-01-01", "08"): 2}
    assert lake.read_raw(spark, root, hr="08").count() == 2      # hr stays a string


def test_snapshot_versions_numeric_and_empty_start(spark, workdir):
    root = f"{workdir}/snap"
    schema = spark.createDataFrame([(1,)], "id bigint").schema
    assert lake.read_snapshot(spark, root, schema).count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read_snapshot(spark, root)
    df = spark.createDataFrame([(9,)], "id bigint")
    lake.write_snapshot(df, root, version=9)
    lake.write_snapshot(spark.createDataFrame([(10,)], "id bigint"), root, version=10)
    assert lake.latest_version(spark, root) == 10
    assert lake.read_snapshot(spark, root).first().id == 10
    assert lake.write_snapshot(df, root) == 11


def test_hours_listing_empty_rerun_and_pruning(spark, workdir):
    root = f"{workdir}/raw"
    one = spark.createDataFrame([(1,)], "id bigint")
    assert lake.list_partitions(spark, root).count() == 0
    for hr in ("07", "08"):
        lake.write_hour(one, root, "2024-01-01", hr)
    lake.write_hour(one.where("false"), root, "2024-01-01", "07")
    assert [tuple(r) for r in lake.list_partitions(spark, root).collect()] == [("2024-01-01", "08")]
    snap = f"{workdir}/snap"
    for _ in range(5):
        lake.write_snapshot(one, snap)
    assert lake.prune_versions(spark, snap, 2) == [1, 2, 3] and lake.versions(spark, snap) == [4, 5]
    assert lake.write_snapshot(one, snap) == 6
