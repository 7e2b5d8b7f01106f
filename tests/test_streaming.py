"""Stream replay and restart equal the batch result (R1..R4)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from postlake.operators.curate import best_per_key
from postlake.session import scratch_dir
from postlake.sources.lake import read_raw, read_snapshot
from postlake.sources.tables import read_table
from postlake.streaming.jobs import read_landing, stream_best_state, stream_curate, stream_raw

COLS = ["user_id", "event_id", "ts", "event_type", "value", "props"]
ORDER = ("value", "ts", "event_id")


def _land(spark, ev, path, lo, hi):
    ev.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).repartitionByRange(2, "ts") \
      .write.mode("append").parquet(path)


def test_curate_and_state_survive_restart(spark):
    ev = read_table(spark, SF_SMALL, "events").select(*COLS)
    landing = scratch_dir(spark, "landing")
    cur, cur_ck = scratch_dir(spark, "cur"), scratch_dir(spark, "ck")
    st, st_ck = scratch_dir(spark, "st"), scratch_dir(spark, "ck")
    half = ev.count() // 2
    for lo, hi in [(0, half), (half, 10 ** 9)]:
        _land(spark, ev, landing, lo, hi)
        # a fresh query object on the same checkpoint = a restarted job
        s = read_landing(spark, landing, ev.schema, max_files_per_trigger=1)
        stream_curate(s, cur, cur_ck, "user_id", ORDER).awaitTermination()
        s = read_landing(spark, landing, ev.schema, max_files_per_trigger=1)
        stream_best_state(s, st, st_ck, "user_id", ORDER).awaitTermination()
    batch = sorted(best_per_key(ev, "user_id", ORDER).collect())
    assert sorted(read_snapshot(spark, cur).select(*COLS).collect()) == batch
    assert sorted(read_snapshot(spark, st).select(*COLS).collect()) == batch


def test_raw_stream_counts(spark):
    ev = read_table(spark, SF_SMALL, "events")
    landing, raw, ck = scratch_dir(spark, "landing"), scratch_dir(spark, "raw"), scratch_dir(spark, "ck")
    ev.repartitionByRange(3, "ts").write.mode("overwrite").parquet(landing)
    stream_raw(read_landing(spark, landing, ev.schema, max_files_per_trigger=1), raw, ck, "ts").awaitTermination()
    assert read_raw(spark, raw).count() == ev.count()


def test_stream_on_existing_history_and_replay(spark):
    from postlake.sources.lake import versions, write_snapshot
    ev = read_table(spark, SF_SMALL, "events").select(*COLS)
    landing, root, ck = scratch_dir(spark, "landing"), scratch_dir(spark, "cur"), scratch_dir(spark, "ck")
    write_snapshot(best_per_key(ev.where("event_id < 300"), "user_id", ORDER), root)
    write_snapshot(best_per_key(ev.where("event_id < 500"), "user_id", ORDER), root)
    _land(spark, ev, landing, 500, 10 ** 9)
    for k in range(2):  # the second time on a fresh checkpoint: all batches again, the same rows
        s = read_landing(spark, landing, ev.schema, max_files_per_trigger=1)
        stream_curate(s, root, f"{ck}/{k}", "user_id", ORDER, keep_versions=2).awaitTermination()
        assert sorted(read_snapshot(spark, root).collect()) == sorted(best_per_key(ev, "user_id", ORDER).collect())
    assert len(versions(spark, root)) == 2


def test_a_batch_rewrites_its_own_buckets_only(spark):
    from postlake.operators.curate import curate
    from postlake.sources.lake import latest_version, marked, merge_snapshot, versions, write_snapshot
    root = scratch_dir(spark, "cur")
    ddl = "id bigint, score int, ingested_at bigint"

    def merge(*rows, ddl=ddl, **options):
        return merge_snapshot(root, spark.createDataFrame(rows, ddl), "id", curate, keep_versions=2, **options)

    assert merge() is None and latest_version(spark, root) is None
    write_snapshot(spark.createDataFrame([(k, k, 0) for k in range(300)], ddl), root)  # a whole table comes first
    assert merge((1, 500, 1), (1, 400, 2), (2, 0, 9)) == 2
    before = set(read_snapshot(spark, root).inputFiles())
    assert merge((7, 900, 1), (None, 5, 1), (None, 6, 1)) == 3
    after = read_snapshot(spark, root)
    assert len(before & set(after.inputFiles())) >= len(before) * 3 // 4
    got = {r.id: r.score for r in after.collect()}
    assert after.count() == len(got) == 301
    assert got == {k: k for k in range(300)} | {1: 500, 7: 900, None: 6}
    assert merge() == 3 and merge(mark="_done") == 4 and marked(spark, f"{root}/v=4", "_done")
    assert merge((8, 1000, 1, "x"), ddl=ddl + ", extra string") == 5
    wide = read_snapshot(spark, root)
    assert {r.id: r.extra for r in wide.collect() if r.extra} == {8: "x"} and wide.count() == 301
    assert versions(spark, root) == [4, 5]


def test_bounded_state_forgets_keys_and_loses_no_row(spark):
    from postlake.streaming.jobs import stream_bounded_state
    ev = read_table(spark, SF_SMALL, "events").select(*COLS)
    # every id a key of its own, many hot rows of one key, null keys and values; the better rows come in any order
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 7).when(F.col("event_id") % 50 == 1, None).otherwise(F.col("event_id") % 400))
    ev = ev.withColumn("value", F.when(F.col("event_id") % 9 != 4, F.col("value")))
    ev = ev.withColumn("user_id", F.when(F.col("user_id") > 300, F.col("user_id") + 2**60).otherwise(F.col("user_id")))  # beyond a float's digits
    landing, root, ck = scratch_dir(spark, "landing"), scratch_dir(spark, "st"), scratch_dir(spark, "ck")
    for lo in range(0, 1000, 250):
        ev.where((F.col("event_id") >= lo) & (F.col("event_id") < lo + 250)).coalesce(1).write.mode("append").parquet(landing)
    states = []
    for _ in range(2):  # a restart on the same checkpoint, nothing new the second time
        s = read_landing(spark, landing, ev.schema, max_files_per_trigger=1)
        query = stream_bounded_state(s, root, ck, "user_id", ORDER, idle_seconds=0.001)
        query.awaitTermination()
        states += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    batch = best_per_key(ev, "user_id", ORDER)
    got = read_snapshot(spark, root).select(*COLS)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0
    assert len(states) >= 4 and max(states) < batch.count()


def test_late_rows_go_aside_and_each_key_lands_once(spark):
    from postlake.streaming.late import stream_raw_on_time
    ddl = "id long, ts timestamp, note string, tags map<string,string>"
    landing, raw, aside, ck = (scratch_dir(spark, n) for n in ("landing", "raw", "late", "ck"))
    stamp = lambda s: f"2024-05-01 {s}"

    def drop(*rows, checkpoint=ck):
        if rows:
            spark.createDataFrame([(k, s and stamp(s), n) for k, s, n in rows], "id long, t string, note string").select(
                "id", F.to_timestamp("t").alias("ts"), "note", F.create_map(F.lit("a"), "note").alias("tags")).write.mode("append").parquet(landing)
        stream_raw_on_time(read_landing(spark, landing, spark.createDataFrame([], ddl).schema), raw, aside, checkpoint, "ts", ["id"], 3600).awaitTermination()
        read = lambda root: sorted((r.id or 0, r.note) for r in spark.read.parquet(root).collect())
        return read(raw), read(aside)

    accepted, late = drop((1, "10:00:00", "a"), (1, "10:00:00", "a"), (2, "09:10:00", "b"), (None, "09:30:00", "n"), (3, None, "no time"), (4, "01:00:00", "first batch"))
    assert accepted == [(0, "n"), (1, "a"), (2, "b"), (4, "first batch")] and late == [(3, "no time")]
    # horizon 09:00: copies of accepted rows go, 5 is in time at the horizon itself, 6 is a second late, also as a copy of 4
    accepted, late = drop((1, "10:00:00", "copy"), (None, "09:40:00", "copy"), (5, "09:00:00", "c"), (6, "08:59:59", "d"), (4, "01:00:00", "late copy"), (7, "13:00:00", "e"))
    assert accepted == [(0, "n"), (1, "a"), (2, "b"), (4, "first batch"), (5, "c"), (7, "e")]
    assert late == [(3, "no time"), (4, "late copy"), (6, "d")]
    assert drop() == (accepted, late)  # a restart with nothing new
    # horizon 12:00: what was accepted before it is not looked at any more
    accepted, late = drop((1, "12:30:00", "again"), (8, "11:00:00", "f"))
    assert (1, "again") in accepted and (8, "f") in late and len(accepted) == 7 and len(late) == 4
    # a stream begun anew has no horizon: it lands what was late, and nothing twice
    assert drop(checkpoint=scratch_dir(spark, "ck"))[0] == sorted([*accepted, (6, "d"), (8, "f")])


def test_bounded_state_meets_keys_row_by_row():
    from pyspark.sql import Row
    from pyspark.sql import types as T
    from postlake.streaming.jobs import _TIE, _best_processor
    names = ["user_id", "value", "order_0", _TIE]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])

    class State:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    processor, state = _best_processor(schema, ["user_id", "value"], ["order_0"], 1000), State()
    processor.best = state
    row = Row("a", "b", "a", "c")  # names change on the way, the order of the columns doesn't
    meet = lambda *rows: [tuple(r) for r in processor.handleInputRows(("key 1",), iter(rows), None)]
    assert meet(row(2**60 + 1, None, None, 5), row(2**60 + 1, 3, 3, -7), row(2**60 + 1, 3, 3, -8)) == [(2**60 + 1, 3)] and state.held == (3, -7)
    assert meet(row(2**60 + 1, None, None, 9)) == [] and meet(row(2**60 + 1, 3, 3, -7)) == []
    assert meet(row(2**60 + 1, 4, 3, -6)) == [(2**60 + 1, 4)]
