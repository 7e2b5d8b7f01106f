"""Incremental jobs with Structured Streaming (R1..R4).

* ``stream_raw`` (R1): landed files -> raw layer partitioned by dt/hr, a
  folder per micro-batch inside the hour, the layout that batch jobs write
  too; ``availableNow`` processes what has landed and stops (an hourly run),
  a processing-time trigger keeps going.
* ``stream_curate`` (R2): each micro-batch is merged into the newest curated
  snapshot (union + best row per key), whoever wrote it.  Only the buckets
  that hold keys of the batch are read and rewritten (``merge_snapshot``);
  the next version is marked with the stream and the batch.  A replayed batch
  whose mark stands on the newest version is skipped; applying any other
  batch again changes nothing, as the merge is idempotent.  One writer per
  target.
* ``stream_best_state`` (R3): the best row per key kept in the state store
  (``max_by`` over the ordering struct, update mode); each batch's changed
  keys are merged into the newest snapshot the same way.  State grows with
  the number of distinct keys; ``stream_bounded_state`` forgets keys whose
  best row stands in the snapshot and that nothing has improved for a while.
  Neither needs a watermark (R4: the reduction is commutative and idempotent).

Old versions are pruned after each batch (``keep_versions``).
Checkpoints live under the shared checkpoint folder, so a restarted query on
another executor or driver resumes where it stopped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import partition_date, partition_hour
from postlake.operators.curate import _order_key, best_per_key, union_by_name
from postlake.session import shuffle_partitions
from postlake.sources.lake import latest_version, marked, merge_snapshot, write_stream_batch


def read_landing(spark: SparkSession, landing: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(landing)


def _stream_name(checkpoint: str) -> str:
    """Names a stream by its checkpoint, which a restart keeps."""
    return "stream-" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def _trigger(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")


def stream_raw(stream: DataFrame, raw_root: str, checkpoint: str, ts_col: str, available_now: bool = True, salt: int = 4):
    """Raw layer, partitioned by the event hour; rows dealt by hour and a salt, so that files stay few."""
    out = stream.withColumns({"dt": partition_date(ts_col), "hr": partition_hour(ts_col)})
    name = _stream_name(checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        dealt = batch.repartition(shuffle_partitions(batch.sparkSession), "dt", "hr", F.pmod(F.xxhash64(ts_col), F.lit(salt)))
        write_stream_batch(dealt, raw_root, name, batch_id)

    return _trigger(out.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint), available_now).start()


def _merge_into(root: str, checkpoint: str, key: str, order_by: Sequence[str], buckets: int, keep_versions: int):
    """A foreachBatch function: the best rows of the newest snapshot and the batch become the next one."""
    name = _stream_name(checkpoint)

    def merge(current, batch):
        return best_per_key(batch if current is None else union_by_name(current, batch), key, order_by)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, mark = batch.sparkSession, f"_{name}-{batch_id}"
        newest = latest_version(spark, root)
        if newest is None or not marked(spark, f"{root}/v={newest}", mark):
            merge_snapshot(root, batch, key, merge, buckets, keep_versions=keep_versions, mark=mark)
    return apply


def stream_curate(stream: DataFrame, curated_root: str, checkpoint: str, key: str,
                  order_by: Sequence[str], available_now: bool = True, keep_versions: int = 3, buckets: int = 16):
    """R2: merge every micro-batch into the curated snapshot."""
    writer = stream.writeStream.foreachBatch(_merge_into(curated_root, checkpoint, key, order_by, buckets, keep_versions))
    return _trigger(writer.option("checkpointLocation", checkpoint), available_now).start()


def stream_best_state(stream: DataFrame, state_root: str, checkpoint: str, key: str,
                      order_by: Sequence[str], available_now: bool = True, keep_versions: int = 3, buckets: int = 16):
    """Best row per key in the state store; the changed keys merged per batch.

    The snapshot may hold rows this stream has never seen, so the better row wins, not the newer.
    """
    cols = stream.columns
    payload = [c for c in cols if c != key]
    best = (stream.groupBy(key)
                  .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), _order_key(order_by, cols)).alias("_b"))
                  .select(key, *[F.col(f"_b.{c}").alias(c) for c in payload]))

    writer = best.writeStream.outputMode("update").foreachBatch(
        _merge_into(state_root, checkpoint, key, order_by, buckets, keep_versions))
    return _trigger(writer.option("checkpointLocation", checkpoint), available_now).start()


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIE, _NAME = "row_hash_of_ties", "name_of_the_key"


def _ranked(rows: pd.DataFrame, order_by: Sequence[str]) -> pd.DataFrame:
    """Rows from worst to best: nulls below every value, then the value, column by column, then the row hash."""
    keys = {f"_there_{c}": rows[c].notna() for c in order_by}
    by = [x for c in order_by for x in (f"_there_{c}", c)]
    return rows.assign(**keys).sort_values([*by, _TIE], kind="stable", na_position="first").drop(columns=list(keys))


def _comparable(stream: DataFrame, name: str) -> Column:
    """Times as microseconds: a state gives them back without a zone."""
    timed = isinstance(stream.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))
    return F.unix_micros(F.col(name).cast("timestamp")) if timed else F.col(name)


def _place(row: Sequence) -> tuple:
    """Compares as ``_ranked`` sorts; the values of the order columns, then the row hash."""
    out: list = []
    for v in row[:-1]:
        there = v is not None and v == v  # NaN ranks like null
        out += [there, v if there else 0]
    return (*out, row[-1])


def _best_processor(schema: T.StructType, payload: Sequence[str], order_by: Sequence[str], idle_ms: int):
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    # columns come under names that some are changed to on the way, but in their order
    names = schema.fieldNames()
    order, out = [names.index(c) for c in (*order_by, _TIE)], [names.index(c) for c in payload]
    made = Row(*payload)
    kept = T.StructType([schema[c] for c in order_by] + [T.StructField(_TIE, T.LongType())])

    class BestRow(StatefulProcessor):
        """Remembers how good the best row of a key was, not the row, for as long as nothing better than ``idle_ms`` ago came."""

        def init(self, handle) -> None:
            self.best = handle.getValueState("best", kept, idle_ms)

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  names of the interface
            top = top_place = None
            for row in rows:
                place = _place([row[j] for j in order])
                if top is None or place > top_place:
                    top, top_place = row, place
            held = self.best.get()
            if held is None or top_place > _place(held):
                self.best.update(tuple(top[j] for j in order))
                yield made(*[top[j] for j in out])

        def close(self) -> None:
            pass

    return BestRow()


def stream_bounded_state(stream: DataFrame, state_root: str, checkpoint: str, key: str, order_by: Sequence[str],
                         idle_seconds: float = 7 * 86400, available_now: bool = True, keep_versions: int = 3, buckets: int = 16):
    """R3 with bounded state: a key for which nothing better came for ``idle_seconds`` (processing time) is forgotten.

    What is forgotten stands in the snapshot: the next row of the key is
    passed on as if it were the first, and the merge keeps the better of the
    two.  So the result is that of ``stream_best_state`` whatever the time,
    no row is late, and the state holds the keys that improved lately, each
    with its order values alone.  Rows of a batch are reduced to one a key
    and Arrow batch before the shuffle, so a hot key isn't gathered.
    """
    spark, cols = stream.sparkSession, stream.columns
    # pandas turns whole numbers beside nulls to floats: they go as text, and a key under a name that is never null
    whole = {f.name for f in stream.schema.fields if isinstance(f.dataType, T.IntegralType)}
    order = [f"order_{k}" for k in range(len(order_by))]
    name = F.coalesce(F.concat(F.lit("key "), F.col(key).cast("string")), F.lit("none"))
    rows = stream.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in whole else F.col(f"`{c}`") for c in cols],
                         *[_comparable(stream, c).alias(o) for c, o in zip(order_by, order, strict=True)], F.xxhash64(*cols).alias(_TIE), name.alias(_NAME))

    def reduce(batches):
        for some in batches:
            if len(some):
                yield _ranked(some, order).drop_duplicates(_NAME, keep="last")

    kept = T.StructType([rows.schema[c] for c in cols])
    best = (rows.mapInPandas(reduce, rows.schema).groupBy(_NAME)
            .transformWithState(_best_processor(rows.schema, cols, order, int(idle_seconds * 1000)), kept, "Update", "ProcessingTime")
            .select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in stream.schema.fields]))
    writer = best.writeStream.outputMode("update").foreachBatch(_merge_into(state_root, checkpoint, key, order_by, buckets, keep_versions))
    # a store that keeps values with a time to live; no batches without data, which would follow each other for ever
    # (keys are forgotten with the next batch that has some); a query keeps the settings it starts with
    wanted = {STATE_STORE: ROCKSDB, NO_DATA: "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return _trigger(writer.option("checkpointLocation", checkpoint), available_now).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
