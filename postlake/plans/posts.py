"""Story-shaped input derived from the driver's tables.

The given tables hold no stories, so ``posts`` builds one deterministic
story per document: the whole document text is the title, the event with
the same id supplies author, time, score and type, the page with the same
id supplies the URL (most documents have none).  A few titles are turned
NULL / blank and some get a trailing '?' so every feature rule is exercised.
All rows are kept; nothing is sampled.

Joins are plain equi-joins on the id; AQE turns a side into a broadcast at
run time only when its measured size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.sources.tables import read_table


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    j = (d.join(e, d.doc_id == e.event_id, "left")
          .join(p, d.doc_id == p.page_id, "left"))
    title = (F.when(F.col("doc_id") % 97 == 0, F.lit(None).cast("string"))
              .when(F.col("doc_id") % 89 == 0, F.lit("   "))
              .when(F.col("user_id") % 5 == 0, F.concat("text", F.lit("?")))
              .otherwise(F.col("text")))
    return j.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("event_type") == "error", F.lit("job")).otherwise(F.lit("story")).alias("type"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("by"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        title.alias("title"),
        "url",
        F.floor("value").cast("bigint").alias("score"),
    )


# the same view for the DuckDB oracle
POSTS_SQL = """
SELECT d.doc_id AS id,
       CASE WHEN e.event_type = 'error' THEN 'job' ELSE 'story' END AS type,
       'user' || CAST(e.user_id AS VARCHAR) AS "by",
       CAST(floor(epoch(e.ts)) AS BIGINT) AS "time",
       CASE WHEN d.doc_id % 97 = 0 THEN NULL WHEN d.doc_id % 89 = 0 THEN '   '
            WHEN e.user_id % 5 = 0 THEN d.text || '?'
            ELSE d.text END AS title,
       p.url, CAST(floor(e.value) AS BIGINT) AS score
FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id
"""
