"""Registered queries of the composed jobs, the stream and lake writers on used roots, and the smaller operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlake import schemas
from postlake.operators.features import build_tabular_features, build_text_features
from postlake.plans import sqlbits as Q
from postlake.plans.catalog import (_SPLIT_SQL, ORACLE, POSTS_CTE, _land_events, _train_test, register)
from postlake.plans.posts import POSTS_SQL, posts
from postlake.session import materialise, scratch_dir
from postlake.sources.tables import read_table

EVENT_COLUMNS = ["user_id", "event_id", "ts", "event_type", "value", "props"]
BEST = ("value", "ts", "event_id")


def _hour_counts(spark, root):
    from postlake.sources.lake import read_raw
    return read_raw(spark, root).groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 6).alias("sum_value"))


def _first_hour(ev):
    from postlake.functions import partition_date, partition_hour
    first = ev.agg(F.min("ts").alias("t")).select(partition_date("t").alias("dt"), partition_hour("t").alias("hr")).first()
    return first, (partition_date("ts") == first.dt) & (partition_hour("ts") == first.hr)


# ---------------------------------------------------------------- lake and streams on used roots

@register("s5_rerun_empty", """
WITH f AS (SELECT strftime(min(ts), '%Y-%m-%d') AS fdt, strftime(min(ts), '%H') AS fhr FROM events),
e AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, value FROM events)
SELECT dt, hr, count(*) AS n_rows, round(sum(value), 6) AS sum_value
FROM e, f WHERE NOT (dt = fdt AND hr = fhr) GROUP BY 1, 2""")
def s5_rerun_empty(spark, sf_dir):
    """Running an hour again with no rows clears that hour."""
    from postlake.sources.lake import write_by_time, write_hour
    root, ev = scratch_dir(spark, "raw"), read_table(spark, sf_dir, "events")
    write_by_time(ev, root, "ts")
    first, _ = _first_hour(ev)
    write_hour(ev.where("false"), root, first.dt, first.hr)
    return _hour_counts(spark, root)


@register("s5_rerun_after_stream", ORACLE["s5_rerun_hour"])
def s5_rerun_after_stream(spark, sf_dir):
    """A batch re-run replaces an hour that the stream has written."""
    from postlake.sources.lake import write_hour
    from postlake.streaming.jobs import read_landing, stream_raw
    landing, schema = _land_events(spark, sf_dir)
    root = scratch_dir(spark, "raw")
    stream_raw(read_landing(spark, landing, schema, max_files_per_trigger=1), root, scratch_dir(spark, "ckpt"), "ts").awaitTermination()
    ev = read_table(spark, sf_dir, "events")
    first, within = _first_hour(ev)
    write_hour(ev.where(within).withColumn("value", F.col("value") * 2), root, first.dt, first.hr)
    return _hour_counts(spark, root)


@register("r2_existing_history", ORACLE["d1_curate_max_score"])
def r2_existing_history(spark, sf_dir):
    """R2: a stream on a curated root with two versions merges into the newest; nothing is lost."""
    from postlake.sources.lake import read_snapshot, write_snapshot
    from postlake.operators.curate import best_per_key
    from postlake.streaming.jobs import read_landing, stream_curate
    ev = read_table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    root, landing = scratch_dir(spark, "curated"), scratch_dir(spark, "landing")
    write_snapshot(best_per_key(ev.where("event_id % 4 = 0"), "user_id", BEST), root)
    write_snapshot(best_per_key(ev.where("event_id % 2 = 0"), "user_id", BEST), root)
    ev.where("event_id % 2 = 1").repartition(3, "event_id").write.parquet(landing)
    stream_curate(read_landing(spark, landing, ev.schema, max_files_per_trigger=1), root, scratch_dir(spark, "ckpt"),
                  "user_id", BEST).awaitTermination()
    return read_snapshot(spark, root)


@register("r4_out_of_order", ORACLE["d1_curate_max_score"])
def r4_out_of_order(spark, sf_dir):
    """Files whose events are in no order of time give the same state."""
    from postlake.sources.lake import read_snapshot
    from postlake.streaming.jobs import read_landing, stream_best_state
    landing, schema = _land_events(spark, sf_dir, late=True)
    root = scratch_dir(spark, "state")
    stream = read_landing(spark, landing, schema, max_files_per_trigger=1).select(*EVENT_COLUMNS)
    stream_best_state(stream, root, scratch_dir(spark, "ckpt"), "user_id", BEST).awaitTermination()
    return read_snapshot(spark, root)


@register("s9_empty_start", ORACLE["d1_curate_max_score"])
def s9_empty_start(spark, sf_dir):
    """An absent layer reads as empty, and the first batch becomes its first snapshot."""
    from postlake.operators.curate import curate
    from postlake.sources.lake import read_snapshot, write_snapshot
    root, ev = scratch_dir(spark, "curated"), read_table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    write_snapshot(curate(read_snapshot(spark, root, ev.schema), ev, "user_id", BEST), root)
    return read_snapshot(spark, root)


# ---------------------------------------------------------------- ingestion

@register("s2_hydrate_fetch", """
SELECT event_id AS id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE 2 * event_id END AS score,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 2 ELSE 1 END AS attempts,
       CASE WHEN event_id % 11 = 0 THEN 'ValueError: bad ' || event_id END AS error
FROM events WHERE event_id % 11 = 0 OR event_id % 7 <> 0""")
def s2_hydrate_fetch(spark, sf_dir):
    """Ids through a fetcher with deleted (7), failing (11) and flaky (13) items; errors and attempts per id."""
    from postlake.sources.ingest import hydrate, split_errors
    tried: dict[int, int] = {}

    def fetch(i):
        tried[i] = tried.get(i, 0) + 1
        if i % 11 == 0:
            raise ValueError(f"bad {i}")
        if i % 7 == 0:
            return None
        if i % 13 == 0 and tried[i] == 1:
            raise TimeoutError("first attempt")
        return {"id": i, "score": 2 * i, "descendants": tried[i]}

    ids = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    fetched = materialise(hydrate(ids, fetch, backoff_base=0.0, backoff_cap=0.0), "fetched")
    good, bad = split_errors(fetched)
    return good.select("id", "score", F.col("descendants").alias("attempts")).unionByName(bad, allowMissingColumns=True)


@register("s3_json_rejects", """
SELECT event_id, CASE WHEN event_id % 10 IN (3, 4) THEN NULL ELSE event_id END AS k, CAST(event_id % 10 IN (3, 4) AS INTEGER) AS bad
FROM events""")
def s3_json_rejects(spark, sf_dir):
    """S3: rows with a field or a whole text that doesn't parse are reported, not lost."""
    from postlake.sources.ingest import decode_json_column
    text = (F.when(F.col("event_id") % 10 == 3, F.lit('{"k":"abc"}')).when(F.col("event_id") % 10 == 4, F.lit("{bad"))
            .otherwise(F.concat(F.lit('{"k":'), F.col("event_id").cast("string"), F.lit("}"))))
    ev = read_table(spark, sf_dir, "events").select("event_id").withColumn("props", text)
    done = decode_json_column(ev, "props", "k bigint", "line")
    return done.select("event_id", "k", F.col("line").isNotNull().cast("int").alias("bad"))


@register("j5_missing_ids", "SELECT event_id AS id FROM events WHERE event_id NOT IN (SELECT doc_id FROM documents)")
def j5_missing_ids(spark, sf_dir):
    """Listed ids that have no landed item."""
    from postlake.sources.ingest import missing_ids
    ids = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return missing_ids(ids, read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")))


# ---------------------------------------------------------------- functions

_SCORES = ["'12'", "' -7 '", "'12.9'", "'-3.5e2'", "'12d'", "'nan'", "'inf'", "''", "NULL", "'9007199254740993'", "'1e30'", "'abc'"]


@register("t10_lenient_int", f"""
WITH s AS (SELECT event_id, CASE event_id % 13 {" ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(_SCORES))}
           ELSE CAST(value AS VARCHAR) END AS score FROM events)
SELECT event_id, {Q.lenient_int_sql('score')} AS score FROM s""")
def t10_lenient_int(spark, sf_dir):
    """Text scores with signs, blanks, fractions, exponents, names of no number, and 2**53 + 1."""
    from postlake.functions import lenient_int
    text = F.expr(f"CASE event_id % 13 {' '.join(f'WHEN {k} THEN {v}' for k, v in enumerate(_SCORES))} ELSE CAST(value AS STRING) END")
    ev = read_table(spark, sf_dir, "events").withColumn("text", text)
    return ev.select("event_id", lenient_int("text").alias("score"))


@register("t9_dirty_time", """
SELECT event_id, CASE WHEN event_id % 5 IN (0, 1, 2) THEN NULL ELSE make_timestamp(event_id * 1000000) END AS created_ts FROM events""")
def t9_dirty_time(spark, sf_dir):
    """Text times, some of them no number or out of range."""
    from postlake.functions import epoch_to_ts
    text = F.expr("CASE event_id % 5 WHEN 0 THEN 'abc' WHEN 1 THEN '99999999999999' WHEN 2 THEN '' ELSE CAST(event_id AS STRING) END")
    return read_table(spark, sf_dir, "events").select("event_id", epoch_to_ts(text).alias("created_ts"))


@register("t6_domain_nfkc", f"""
SELECT page_id, CASE WHEN page_id % 3 = 0 AND contains(url, '://') THEN 'no_url' ELSE {Q.domain_sql('url')} END AS domain FROM pages""")
def t6_domain_nfkc(spark, sf_dir):
    """A host with a character that stands for 'a/c' (or '#') in compatibility form is no host."""
    from postlake.functions import domain
    odd = F.regexp_replace("url", "://", F.when(F.col("page_id") % 2 == 0, F.lit("://℀")).otherwise(F.lit("://＃")))
    url = F.when(F.col("page_id") % 3 == 0, odd).otherwise(F.col("url"))
    return read_table(spark, sf_dir, "pages").select("page_id", domain(url).alias("domain"))


@register("t18_vector_columns", """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
SELECT vec_id, list_cosine_similarity(x, list_reverse(x)) AS similarity, 1 - list_cosine_similarity(x, list_reverse(x)) AS distance,
       1 AS unit, 1 AS same_text, len(x) AS dim FROM v""")
def t18_vector_columns(spark, sf_dir):
    """T17..T20 as Columns: similarity and distance to the reversed vector, unit length, text there and back."""
    from postlake.functions import cosine_distance, cosine_similarity, dimension, from_text, l2_norm, l2_normalize, to_text
    back = F.reverse("embedding")
    close = F.forall(F.zip_with(from_text(to_text("embedding")), "embedding", lambda a, b: F.abs(a - b) < 1e-6), lambda x: x)
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", cosine_similarity("embedding", back).alias("similarity"), cosine_distance("embedding", back).alias("distance"),
        (F.abs(l2_norm(l2_normalize("embedding")) - 1) < 1e-6).cast("int").alias("unit"), close.cast("int").alias("same_text"),
        dimension("embedding").cast("long").alias("dim"))


# ---------------------------------------------------------------- features, order, rates

@register("p8_model_input", f"{POSTS_CTE} SELECT id, {', '.join(schemas.FEATURE_COLUMNS)}, vai_bombar FROM ({Q.tabular_sql('posts')})")
def p8_model_input(spark, sf_dir):
    """The model's columns in their fixed order."""
    from postlake.operators.features import model_input
    return model_input(build_tabular_features(posts(spark, sf_dir)))


@register("d3_global_sort", f"{POSTS_CTE} SELECT id, score, 1 AS in_order FROM posts")
def d3_global_sort(spark, sf_dir):
    """D3: all posts sorted by score descending, NULLs last; each row follows its predecessor within its partition."""
    from pyspark.sql import Window

    from postlake.operators.curate import sort_desc_nulls_last
    done = materialise(sort_desc_nulls_last(posts(spark, sf_dir).select("id", "score")).withColumns(
        {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted")
    key = lambda s, i: F.struct(F.coalesce(-s, F.lit(2**62)), i)
    before = F.lag(key(F.col("score"), F.col("id"))).over(Window.partitionBy("part").orderBy("at"))
    return done.select("id", "score", F.coalesce(before <= key(F.col("score"), F.col("id")), F.lit(True)).cast("int").alias("in_order"))


@register("a11_positive_rate", f"""{_SPLIT_SQL}
SELECT split, avg(CAST(vai_bombar AS DOUBLE)) AS positive_rate, count(*) AS n FROM sp GROUP BY 1""")
def a11_positive_rate(spark, sf_dir):
    """Share of positives of each split."""
    from postlake.operators.metrics import positive_rate
    return positive_rate(_train_test(spark, sf_dir), "vai_bombar", ["split"])


@register("m2_one_hot", f"""{_SPLIT_SQL},
l AS (SELECT 'domain' AS feature, domain AS category FROM sp WHERE split = 'train'
      UNION ALL SELECT 'by_author', by_author FROM sp WHERE split = 'train'),
v AS (SELECT feature, category, CASE WHEN count(*) >= 5 THEN category ELSE '__rare__' END AS mapped FROM l GROUP BY 1, 2),
r AS (SELECT id, 'domain' AS feature, CASE WHEN id % 7 = 0 THEN NULL ELSE domain END AS category FROM feats
      UNION ALL SELECT id, 'by_author', CASE WHEN id % 5 = 0 THEN 'nobody-ever' ELSE by_author END FROM feats)
SELECT r.id, r.feature, v.mapped AS active FROM r LEFT JOIN v USING (feature, category)""")
def m2_one_hot(spark, sf_dir):
    """The active one-hot column of every story; unseen and null values have none, rare ones share one."""
    from postlake.operators.model import active_categories, fit, random_forest
    sp = materialise(_train_test(spark, sf_dir), "train-test")
    m = fit("tiny", random_forest(num_trees=1, max_depth=1), sp.where("split = 'train'"))
    odd = sp.withColumns({"domain": F.when(F.col("id") % 7 != 0, F.col("domain")),
                          "by_author": F.when(F.col("id") % 5 == 0, F.lit("nobody-ever")).otherwise(F.col("by_author"))})
    return active_categories(m, odd)


@register("d7_champion", f"""{_SPLIT_SQL}
SELECT run, name AS champion, name AS loaded, 'champion' AS stage, (SELECT count(*) FROM sp WHERE split = 'test') AS n_test
FROM (VALUES (1, 'random_forest'), (2, 'boosted_trees')) AS v(run, name)""")
def d7_champion(spark, sf_dir):
    """After each of two trainings with different winners, the preference loads that run's winner."""
    from postlake.operators.model import boosted_trees, load_preferred, random_forest, train_and_select
    work, features = scratch_dir(spark, "train"), materialise(build_tabular_features(posts(spark, sf_dir)), "features")
    rows = []
    for run, (name, est) in enumerate([("random_forest", random_forest(num_trees=3, max_depth=3)),
                                       ("boosted_trees", boosted_trees(max_iter=2, max_depth=2))], 1):
        said = train_and_select(features, work, [(name, est)])
        model = load_preferred(spark, f"{work}/models", ["champion", "random_forest", "boosted_trees"])
        rows.append((run, said["champion"], model.name, model.stage, said["n_test"]))
    return spark.createDataFrame(rows, "run int, champion string, loaded string, stage string, n_test long")


# ---------------------------------------------------------------- vectors

_TEXTS = f"{POSTS_CTE}, t AS ({Q.text_sql('posts')})"


@register("s13_s14_lineage", f"""{_TEXTS}
SELECT id, title, url, CAST(score AS INTEGER) AS score, by_author, created_ts, 384 AS dim, 'hashed-bow-md5' AS model_name,
       1 AS has_run, 1 AS stamped FROM t""")
def s13_s14_lineage(spark, sf_dir):
    """Encoded texts in the table's columns, each with its encoder, run and time."""
    from postlake.operators.embed import encode_frame
    rows, run_id, _ = encode_frame(build_text_features(posts(spark, sf_dir)))
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("indexed_at")
    return rows.select("id", "title", "url", "score", "by_author", "created_ts", F.size("embedding").alias("dim"), "model_name",
                       (F.col("model_run_id") == run_id).cast("int").alias("has_run"), (age.between(0, 86400)).cast("int").alias("stamped"))


@register("e3_encode_frame", f"""{_TEXTS}
SELECT DISTINCT 'param' AS kind, 'embedding_model' AS key, 'hashed-bow-md5' AS value FROM t
UNION ALL SELECT DISTINCT 'param', 'vector_dim', '384' FROM t
UNION ALL SELECT 'metric', 'n_inputs', CAST(count(*) AS VARCHAR) FROM t
UNION ALL SELECT 'metric', 'n_vectors', CAST(count(*) AS VARCHAR) FROM t
UNION ALL SELECT 'sample', CAST(id AS VARCHAR), title FROM (SELECT id, title FROM t ORDER BY id LIMIT 10)""")
def e3_encode_frame(spark, sf_dir):
    """The run record of an encoding: encoder, dimension, counts, sample."""
    from postlake.operators.embed import encode_frame, encoding_log
    _, run_id, report = encode_frame(build_text_features(posts(spark, sf_dir)))
    return encoding_log(spark, run_id, report).select("kind", "key", "value")


@register("k4_author_lookup", f"""{_TEXTS}
SELECT by_author, id, title, created_ts FROM t WHERE by_author = (SELECT min(by_author) FROM t)""")
def k4_author_lookup(spark, sf_dir):
    """K4: one author's rows from the layout sorted by author, by a filter that reaches the scan."""
    from postlake.sources.vectors import author_lookup, write_vectors_sorted
    texts, path = materialise(build_text_features(posts(spark, sf_dir)), "texts"), scratch_dir(spark, "by-author")
    write_vectors_sorted(texts, path)
    first = texts.agg(F.min("by_author").alias("a")).first().a
    return author_lookup(spark, path, first).select("by_author", "id", "title", "created_ts")


# ---------------------------------------------------------------- the composed jobs

def _items(spark, sf_dir):
    """Posts as two hourly batches: all, then those of even id with a higher score."""
    p = posts(spark, sf_dir).withColumn("ingested_at", F.lit("2024-01-01T07"))
    again = p.where("id % 2 = 0").withColumns({"score": F.col("score") + 60, "ingested_at": F.lit("2024-01-01T08")})
    return p, again


_CURATED = f"""WITH p AS ({POSTS_SQL}),
posts AS (SELECT id, type, "by", "time", title, url, CASE WHEN id % 2 = 0 THEN score + 60 ELSE score END AS score FROM p)"""


def _layout(spark, sf_dir):
    from postlake.plans import jobs
    from postlake.sources.lake import Layout
    layout = Layout(scratch_dir(spark, "lake"))
    first, second = _items(spark, sf_dir)
    jobs.ingest_hour(spark, layout, first, "2024-01-01", "07")
    jobs.ingest_hour(spark, layout, second, "2024-01-01", "08")
    return jobs, layout


@register("job_ingest", f"{_CURATED} {Q.tabular_sql('posts')}")
def job_ingest(spark, sf_dir):
    """S5..S10, P10, D1, P1..P9: two hours landed, curated and turned into features; the tabular layer."""
    from postlake.sources.lake import read_snapshot
    _, layout = _layout(spark, sf_dir)
    return read_snapshot(spark, layout.tabular)


@register("job_from_ids", """
WITH w AS (SELECT event_id AS id, row_number() OVER (ORDER BY value DESC, event_id) AS rank FROM events)
SELECT id, CASE WHEN id % 11 = 0 THEN 'error' WHEN id % 7 = 0 THEN 'missing' ELSE 'item' END AS kind,
       CASE WHEN id % 11 <> 0 AND id % 7 <> 0 THEN 2 * id END AS score,
       CASE WHEN id % 11 <> 0 AND id % 7 <> 0 THEN CAST(id % 3 > 0 AS INTEGER) END AS is_story
FROM w WHERE rank <= 500""")
def job_from_ids(spark, sf_dir):
    """The hourly job from a ranked id list: curated items, whether they have features, failures, ids without an item."""
    from postlake.plans import jobs
    from postlake.sources.lake import Layout, read_snapshot

    def fetch(i):
        if i % 11 == 0:
            raise ValueError(f"bad {i}")
        return None if i % 7 == 0 else {"id": i, "type": "story" if i % 3 else "job", "title": f"Item {i}", "time": 1_700_000_000 + i, "score": 2 * i}

    order = F.row_number().over(Window.orderBy(F.desc("value"), F.asc("event_id")))
    first = read_table(spark, sf_dir, "events").select("event_id", "value").orderBy(F.desc("value"), F.asc("event_id")).limit(600)
    ranked = first.select(F.col("event_id").alias("id"), order.alias("rank"))
    layout = Layout(scratch_dir(spark, "lake"))
    _, errors, missing = jobs.ingest_ids(spark, layout, ranked, fetch, "2024-01-01", "07", limit=500)
    none = lambda kind: F.lit(None).cast(kind)
    tabular = read_snapshot(spark, layout.tabular).select("id", F.lit(1).alias("is_story"))
    items = read_snapshot(spark, layout.curated).join(tabular, "id", "left").select(
        "id", F.lit("item").alias("kind"), "score", F.coalesce("is_story", F.lit(0)).alias("is_story"))
    return (items.unionByName(errors.select("id", F.lit("error").alias("kind"), none("long").alias("score"), none("int").alias("is_story")))
            .unionByName(missing.select("id", F.lit("missing").alias("kind"), none("long").alias("score"), none("int").alias("is_story"))))


@register("m9_predict", f"""{_CURATED}
SELECT id, 1 AS p_in_range, 1 AS class_ok, 'random_forest' AS model_name, 'champion' AS model_stage, CAST(NULL AS VARCHAR) AS reasons
FROM posts WHERE title IS NOT NULL AND id % 26 <= 23 AND id % 8 <= 6
UNION ALL
SELECT id, NULL, NULL, NULL, NULL, concat_ws(',', CASE WHEN title IS NULL THEN 'title_required' END,
       CASE WHEN id % 26 > 23 THEN 'hour_out_of_range' END, CASE WHEN id % 8 > 6 THEN 'weekday_out_of_range' END)
FROM posts WHERE title IS NULL OR id % 26 > 23 OR id % 8 > 6""")
def m9_predict(spark, sf_dir):
    """Daily training, then a batch of requests: checked, featured, scored by the champion, with its name."""
    from postlake.operators.model import random_forest
    jobs, layout = _layout(spark, sf_dir)
    jobs.train_daily(spark, layout, [("random_forest", random_forest(num_trees=20, max_depth=6))])
    requests = posts(spark, sf_dir).select("id", "title", "url", F.col("by").alias("by_author"),
                                           F.pmod("id", F.lit(26)).cast("int").alias("hour"), F.pmod("id", F.lit(8)).cast("int").alias("weekday"))
    scored, rejected = jobs.predict(spark, layout, requests)
    p, none = F.col("probability"), lambda kind: F.lit(None).cast(kind)
    good = scored.select("id", p.between(0, 1).cast("int").alias("p_in_range"),
                         (F.col("prediction") == (p >= 0.5).cast("int")).cast("int").alias("class_ok"), "model_name", "model_stage",
                         none("string").alias("reasons"))
    return good.unionByName(rejected.select("id", none("int").alias("p_in_range"), none("int").alias("class_ok"),
                                            none("string").alias("model_name"), none("string").alias("model_stage"),
                                            F.concat_ws(",", "reasons").alias("reasons")))


@register("p16_search_hits", f"""{_CURATED}, t AS ({Q.text_sql('posts')}), dt AS (SELECT id, bucket, CAST(CAST(weight AS FLOAT) AS DOUBLE) AS w
  FROM ({Q.hashed_terms_sql('t', 'id', 'title')}) _d),
qt AS (SELECT id, bucket, CAST(CAST(weight AS FLOAT) AS DOUBLE) AS w FROM ({Q.hashed_terms_sql('benchmark', 'item_id', 'text')}) _q),
dn AS (SELECT id, sqrt(sum(w * w)) AS n FROM dt GROUP BY id), qn AS (SELECT id, sqrt(sum(w * w)) AS n FROM qt GROUP BY id),
s AS (SELECT qt.id AS query_id, dt.id AS id, sum(qt.w * dt.w) AS dotp FROM qt JOIN dt USING (bucket) GROUP BY 1, 2),
c AS (SELECT s.query_id, s.id, dotp / (qn.n * dn.n) AS similarity FROM s JOIN qn ON qn.id = s.query_id JOIN dn ON dn.id = s.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC NULLS LAST, id) AS rank FROM c)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, title, url, CAST(score AS INTEGER) AS score, by_author, similarity
FROM r JOIN t USING (id) WHERE rank <= 1 + query_id % 5""")
def p16_search_hits(spark, sf_dir):
    """Texts encoded and indexed by the daily job, then a batch of searches with k of their own."""
    jobs, layout = _layout(spark, sf_dir)
    jobs.index_daily(spark, layout)
    requests = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"),
                                                             (F.lit(1) + F.pmod("item_id", F.lit(5))).cast("int").alias("k"))
    return jobs.search(spark, layout, requests, exact=True)[0]


@register("k3_indexed_search", f"""{_CURATED}, t AS ({Q.text_sql('posts')})
SELECT (SELECT count(*) FROM benchmark) * least(10, (SELECT count(*) FROM t)) AS n_exact, 1 AS enough, 1 AS same_similarity""")
def k3_indexed_search(spark, sf_dir):
    """K2, K3: the batch search through the daily job's index finds 0.9 of the exact hits, with their exact similarities."""
    from postlake.operators.search import recall_at_k
    jobs, layout = _layout(spark, sf_dir)
    jobs.index_daily(spark, layout)
    requests = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"), F.lit(10).alias("k"))
    found, exact = (materialise(jobs.search(spark, layout, requests, exact=e)[0], "hits") for e in (False, True))
    both = found.alias("a").join(exact.alias("b"), ["query_id", "id"])
    differ = both.where(F.abs(F.col("a.similarity") - F.col("b.similarity")) > 1e-9).count()
    return exact.agg(F.count(F.lit(1)).alias("n_exact"), F.lit(int(recall_at_k(found, exact) >= 0.9)).alias("enough"),
                     F.lit(int(differ == 0)).alias("same_similarity"))


_WORDS = r"""WITH w AS (SELECT doc_id AS id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'))) AS term FROM documents),
f AS (SELECT term, count(*) AS n_docs FROM w GROUP BY term HAVING count(*) >= 2),
v AS (SELECT term, n_docs, row_number() OVER (ORDER BY n_docs DESC, term) AS place FROM f)"""


@register("e2_latent_vocabulary", f"""{_WORDS}
SELECT term, n_docs, ln((1 + (SELECT count(*) FROM documents)) / (1 + n_docs)) + 1 AS idf FROM v WHERE place <= 2000""")
def e2_latent_vocabulary(spark, sf_dir):
    """The words and weights of an encoder learnt from whole documents."""
    encoder = _latent(spark, sf_dir)[1]
    rows = [(t, int(n), float(w)) for t, n, w in zip(encoder.terms, encoder.df, encoder.idf, strict=True)]
    return spark.createDataFrame(rows, "term string, n_docs long, idf double")


@register("e2_latent_encode", f"""{_WORDS}, k AS (SELECT id, count(*) AS n FROM w JOIN v USING (term) WHERE place <= 2000 GROUP BY id)
SELECT doc_id AS id, 32 AS dim, CAST(coalesce(n, 0) > 0 AS INTEGER) AS has_direction FROM documents LEFT JOIN k ON k.id = doc_id""")
def e2_latent_encode(spark, sf_dir):
    """Every whole document as the unit vector of a learnt encoder; one without a known word has no direction."""
    from postlake.functions.vector import l2_norm
    from postlake.operators.embed import encode_with
    docs, encoder = _latent(spark, sf_dir)
    out = encode_with(docs, encoder.factory(spark), "text")
    unit = F.when(F.abs(l2_norm("embedding") - 1) < 1e-5, 1).when(l2_norm("embedding") == 0, 0)
    return out.select("id", F.size("embedding").alias("dim"), unit.alias("has_direction"))


def _latent(spark, sf_dir):
    from postlake.operators import latent
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs, latent.fit(docs, "text", dim=32, max_terms=2000)
