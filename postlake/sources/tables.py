"""Reading the given tables (S6 for the driver's layout)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

#: A user's setting: read the given tables into so many partitions.  Unset (the default) the scan's splits stay.
SCAN_PARTITIONS = "spark.postlake.scanPartitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  With ``spark.postlake.scanPartitions`` set, rows are dealt round robin into that many
    partitions: useful where one small file holds whole texts, as in tests; never derived from the machine."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df
