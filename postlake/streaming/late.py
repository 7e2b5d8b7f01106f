"""Raw ingest with event-time lateness and duplicates.

``stream_raw_on_time`` lands each row once and sets late rows aside.  The
horizon of a micro-batch is the latest event time of all earlier batches less
``delay_seconds``; it is written beside the checkpoint, so a replayed batch
sees the horizon of its first run.

* late: event time before the horizon, or none at all; goes to the side table.
* duplicate: on time, and a row of the same key with an event time at or after the
  horizon stands in the raw layer, or another row of its batch is taken for
  the key; dropped.
* accepted: the rest.

The raw layer itself is the memory of what was accepted: a batch reads the
key columns of the hours since its horizon (folders of earlier days aren't
even listed), whoever wrote them.  So there is no state to bound or to lose, and which rows are dropped
follows from the batches alone; Spark's ``dropDuplicatesWithinWatermark``
drops late rows without a trace, so it can't fill the side table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import partition_date, partition_hour
from postlake.session import shuffle_partitions
from postlake.sources.lake import BATCH, drop_folders, folder_values, marked, write_stream_batch
from postlake.streaming.jobs import _stream_name, _trigger

_EPOCH = datetime(1970, 1, 1)


def _horizon(spark: SparkSession, seen: str, batch_id: int, delay_us: int):
    """Event time (microseconds) before which a row of the batch is late; None if no earlier batch had a time."""
    if not marked(spark, seen, "."):
        return None
    earlier = spark.read.schema("last_us long, batch long").parquet(seen).where(F.col("batch") < batch_id)
    last = earlier.agg(F.max("last_us")).first()[0]
    return None if last is None else last - delay_us


def first_per_key(rows: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """The earliest row of each key, of rows at one time the one with the smallest hash; reduced before the shuffle."""
    hashed = [F.col(f"`{c}`") for c, t in rows.dtypes if "map<" not in t and t != "variant"]
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    first = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min_by(whole, F.struct(F.col(f"`{ts_col}`"), F.xxhash64(*hashed))).alias("row"))
    return first.select("row.*")


def _known(spark: SparkSession, raw_root: str, rows: DataFrame, keys: Sequence[str], ts_col: str, horizon: int | None, own: str) -> DataFrame:
    """Keys of the raw layer at or after the horizon, but for those that this very batch wrote in an earlier try."""
    cols = list(dict.fromkeys([*keys, ts_col]))
    schema = rows.select(*[F.col(f"`{c}`") for c in cols]).schema
    for name in ("dt", "hr", BATCH):
        schema = schema.add(name, "string")
    days = folder_values(spark, raw_root, "dt=")
    if horizon is not None:  # only folders of days since then are listed
        day, hour = f"{(_EPOCH + timedelta(microseconds=horizon)):%Y-%m-%d %H}".split()
        days = [d for d in days if d >= day]
    paths = [f"{raw_root}/dt={d}" for d in days]
    found = (spark.read.schema(schema).option("basePath", raw_root).parquet(*paths) if paths else spark.createDataFrame([], schema))
    found = found.where(F.col(BATCH).isNull() | (F.col(BATCH) != own))
    if horizon is not None:
        found = found.where((F.col("dt") > day) | ((F.col("dt") == day) & (F.col("hr") >= hour)))
        found = found.where(F.unix_micros(F.col(f"`{ts_col}`").cast("timestamp")) >= horizon)
    return found.select(*[F.col(f"`{k}`").alias(f"known_{j}") for j, k in enumerate(keys)])


def stream_raw_on_time(stream: DataFrame, raw_root: str, late_root: str, checkpoint: str, ts_col: str, keys: Sequence[str],
                       delay_seconds: float, available_now: bool = True, salt: int = 4):
    """Accepted rows to ``raw_root``, late ones to ``late_root``, both partitioned by the event hour.

    Null in a key equals null.  A row without an event time is late, of no
    hour.  Both tables are read by ``lake.read_raw``.  One writer per
    checkpoint.
    """
    name, seen, delay_us = _stream_name(checkpoint), f"{checkpoint.rstrip('/')}-seen", round(delay_seconds * 1_000_000)
    out = stream.withColumns({"dt": partition_date(ts_col), "hr": partition_hour(ts_col)})

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        horizon = _horizon(spark, seen, batch_id, delay_us)
        at = F.unix_micros(F.col(f"`{ts_col}`").cast("timestamp"))
        late = at.isNull() if horizon is None else at.isNull() | (at < horizon)
        batch = batch.persist()
        try:
            fresh = first_per_key(batch.where(~late), keys, ts_col)
            if marked(spark, raw_root, "."):
                known = _known(spark, raw_root, fresh, keys, ts_col, horizon, f"{name}-{batch_id}")
                same = [F.col(f"`{k}`").eqNullSafe(F.col(f"known_{j}")) for j, k in enumerate(keys)]
                fresh = fresh.join(known, same, "left_anti")
            for rows, root in ((fresh, raw_root), (batch.where(late), late_root)):
                dealt = rows.repartition(shuffle_partitions(spark), "dt", "hr", F.pmod(F.xxhash64(ts_col, *keys), F.lit(salt)))
                write_stream_batch(dealt, root, name, batch_id)
            last = batch.agg(F.max(at)).first()[0]
            before = None if horizon is None else horizon + delay_us
            top = max((t for t in (last, before) if t is not None), default=None)
            spark.createDataFrame([(top,)], "last_us long").coalesce(1).write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
            drop_folders(spark, seen, "batch=", {f"batch={b}" for b in (batch_id - 1, batch_id)})
        finally:
            batch.unpersist()

    return _trigger(out.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint), available_now).start()
