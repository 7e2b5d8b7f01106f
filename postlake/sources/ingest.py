"""Ingestion (S1..S4, J5, P10).

* ``top_ids``: the first N of a ranked id list (per snapshot when there are
  several).
* ``hydrate``: ids -> items through an injected ``fetch(id) -> dict | None``
  run inside ``mapInPandas`` tasks (the network client is not part of this
  library).  A failing id is retried with exponential backoff, then reported
  in ``error``; a ``None`` item (deleted) yields no row; survivors are
  stamped with ``ingested_at``.
* ``hydrate_from_table``: the same contract when items are already landed
  as a table: a left join, the missing ids flagged.
* ``read_items_json``: JSON lines with a fixed schema; ``null`` / empty
  lines produce no row.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake import schemas

FETCHED = T.StructType(schemas.ITEM.fields + [
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("error", T.StringType()),
])


def top_ids(ranked: DataFrame, limit: int | None, rank_col: str = "rank",
            snapshot_cols: list[str] | None = None) -> DataFrame:
    """Ids with ``rank <= limit`` (``None`` keeps all).  With explicit
    ranks this is a pushed-down filter; without ranks per snapshot,
    ``row_number`` with a partial WindowGroupLimit."""
    if limit is None:
        return ranked
    if rank_col in ranked.columns:
        return ranked.where(F.col(rank_col) <= limit)
    w = Window.partitionBy(*(snapshot_cols or [])).orderBy("position")
    return ranked.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= limit)


def retry_call(fn: Callable, arg, attempts: int = 3, base: float = 1.0, cap: float = 10.0,
               retry_on: tuple[type[BaseException], ...] = (OSError, TimeoutError, ConnectionError),
               sleep: Callable[[float], None] = time.sleep):
    """Bounded retry, exponential backoff ``base * 2**i`` capped at
    ``cap``, only for ``retry_on`` errors; the last error is re-raised."""
    for i in range(attempts):
        try:
            return fn(arg)
        except retry_on:
            if i == attempts - 1:
                raise
            sleep(min(cap, base * (2 ** i)))
    return None


def _fetch_partition(fetch: Callable, attempts: int, base: float, cap: float,
                     retry_on: tuple) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = [f.name for f in schemas.ITEM.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for item_id in pdf["id"].tolist():
                try:
                    item = retry_call(fetch, int(item_id), attempts, base, cap, retry_on)
                except Exception as exc:  # noqa: BLE001 -- reported per id, the batch goes on
                    out.append({**{n: None for n in names}, "id": int(item_id),
                                "ingested_at": None, "error": f"{type(exc).__name__}: {exc}"})
                    continue
                if item is None:
                    continue
                row = {n: item.get(n) for n in names}
                row["ingested_at"] = datetime.now(timezone.utc)
                row["error"] = None
                out.append(row)
            yield pd.DataFrame(out, columns=names + ["ingested_at", "error"])
    return run


def hydrate(ids: DataFrame, fetch: Callable[[int], dict | None], partitions: int | None = None,
            attempts: int = 3, backoff_base: float = 1.0, backoff_cap: float = 10.0,
            retry_on: tuple = (OSError, TimeoutError, ConnectionError)) -> DataFrame:
    """Ids -> fetched items plus per-id errors (``error`` not NULL); ``partitions`` fetchers work side by
    side (unless given, as many as ``ids`` has partitions)."""
    ids = ids.select("id")
    return (ids.repartition(partitions) if partitions else ids).mapInPandas(
        _fetch_partition(fetch, attempts, backoff_base, backoff_cap, retry_on), FETCHED)


def split_errors(fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = fetched.where(F.col("error").isNull()).drop("error")
    bad = fetched.where(F.col("error").isNotNull()).select("id", "error")
    return ok, bad


def hydrate_from_table(ids: DataFrame, items: DataFrame, key: str = "id") -> DataFrame:
    """Hydrate from landed items; ``found`` = 0 for a missing id."""
    marked = items.withColumn("_found", F.lit(1))
    return (ids.join(marked, key, "left")
               .withColumn("found", F.coalesce("_found", F.lit(0)))
               .drop("_found"))


def missing_ids(ids: DataFrame, items: DataFrame, key: str = "id") -> DataFrame:
    """Ids with no landed item (left anti join)."""
    return ids.join(items.select(key), key, "left_anti")


def decode_json_column(df: DataFrame, col: str, schema: str | T.StructType, bad_col: str | None = None) -> DataFrame:
    """S3 on a string column: ``from_json`` with a fixed schema.

    A field that doesn't parse is NULL; with ``bad_col`` the text of such a
    row (of a field or the whole) is kept there for a report.
    """
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    fields, options = struct.fieldNames(), {}
    if bad_col:
        struct, options = T.StructType([*struct.fields, T.StructField(bad_col, T.StringType())]), {"columnNameOfCorruptRecord": bad_col}
        fields = [*fields, bad_col]
    parsed = F.from_json(F.col(col), struct, options)
    return df.withColumn("_json", parsed).select("*", *[F.col(f"_json.{f}").alias(f) for f in fields]).drop("_json")


def read_items_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: JSON lines -> ITEM rows; ``null``/empty/corrupt lines give no row (``json_rejects`` has the latter)."""
    return spark.read.schema(schemas.ITEM).option("mode", "PERMISSIVE").json(path).where(F.col("id").isNotNull())


def json_rejects(spark: SparkSession, path: str) -> DataFrame:
    """S3: (id, line) of the lines that don't parse in full, also those whose other fields make a row."""
    lines = spark.read.text(path).where(~F.trim("value").isin("", "null"))
    return decode_json_column(lines, "value", schemas.ITEM, "line").select("id", "line").where(F.col("line").isNotNull())


def require_rows(df: DataFrame, what: str = "batch") -> DataFrame:
    """P10: an empty extraction is an error, not an empty partition."""
    if df.isEmpty():
        raise ValueError(f"empty {what}: nothing extracted")
    return df
