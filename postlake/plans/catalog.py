"""Registered queries: one per operator group of SURVEY §2.

Each query takes ``(spark, sf_dir)``, reads whole given tables (or tables
Spark derives from them) and returns a DataFrame.  ``ORACLE`` holds the
DuckDB SQL of every query that SQL can express; column names and types
match the Spark side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.features import build_tabular_features, build_text_features
from postlake.plans import sqlbits as Q
from postlake.plans.posts import POSTS_SQL, posts
from postlake.session import prepare
from postlake.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


POSTS_CTE = f"WITH posts AS ({POSTS_SQL})"


# ---------------------------------------------------------------- features

@register("p_tabular_features", f"{POSTS_CTE} {Q.tabular_sql('posts')}")
def p_tabular_features(spark, sf_dir):
    """P1, P2, P5, P6, P9, T1, T3..T9, T12: model features and target of every story."""
    return build_tabular_features(posts(spark, sf_dir))


@register("p_text_features", f"{POSTS_CTE} {Q.text_sql('posts')}")
def p_text_features(spark, sf_dir):
    """Clean titles for the encoder."""
    return build_text_features(posts(spark, sf_dir))


@register("t6_domain_counts", f"""
SELECT {Q.domain_sql('url')} AS domain, CAST(count(*) AS BIGINT) AS n_pages
FROM pages GROUP BY 1""")
def t6_domain_counts(spark, sf_dir):
    """Pages per domain (partial + final hash aggregate)."""
    from postlake.functions import domain
    pages = read_table(spark, sf_dir, "pages").select("url")
    return pages.groupBy(domain("url").alias("domain")).agg(F.count(F.lit(1)).alias("n_pages"))


# ---------------------------------------------------------------- ingestion side

@register("s1_rank_limit", """
SELECT CAST(row_number() OVER (ORDER BY value DESC NULLS LAST, event_id) AS INTEGER) AS rank,
       event_id AS id, value
FROM events ORDER BY value DESC NULLS LAST, event_id LIMIT 100""")
def s1_rank_limit(spark, sf_dir):
    """The first 100 of a ranked id list (ranked by value)."""
    from postlake.operators.curate import top_n
    ev = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "value")
    return top_n(ev, 100, [F.desc_nulls_last("value"), F.asc("id")]).select("rank", "id", "value")


@register("s2_hydrate_report", """
SELECT e.event_id AS id, CAST(d.doc_id IS NOT NULL AS INTEGER) AS found, d.n_chars, d.lang
FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id""")
def s2_hydrate_report(spark, sf_dir):
    """Hydrate every listed id from the landed items; missing ids reported."""
    from postlake.sources.ingest import hydrate_from_table
    ids = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "n_chars", "lang")
    return hydrate_from_table(ids, docs)


@register("s3_json_decode", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def s3_json_decode(spark, sf_dir):
    """S3: JSON text to typed columns (fixed schema, no inference)."""
    from postlake.sources.ingest import decode_json_column
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    return decode_json_column(ev, "props", "k bigint").select("event_id", "k")


_HOURLY_SQL = """
SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, CAST(count(*) AS BIGINT) AS n_rows,
       round(sum({value}), 6) AS sum_value
FROM events {extra} GROUP BY 1, 2"""


@register("s5_raw_hourly", _HOURLY_SQL.format(value="value", extra=""))
def s5_raw_hourly(spark, sf_dir):
    """Land events by dt/hr, read the layer back, count per hour."""
    from postlake.session import scratch_dir
    from postlake.sources.lake import list_partitions, read_raw, write_by_time
    root = scratch_dir(spark, "raw")
    write_by_time(read_table(spark, sf_dir, "events"), root, "ts")
    parts = list_partitions(spark, root)
    agg = read_raw(spark, root).groupBy("dt", "hr").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 6).alias("sum_value"))
    return parts.join(agg, ["dt", "hr"], "left")


@register("s5_rerun_hour", """
WITH f AS (SELECT strftime(min(ts), '%Y-%m-%d') AS fdt, strftime(min(ts), '%H') AS fhr FROM events),
     e AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, value FROM events)
SELECT dt, hr, CAST(count(*) AS BIGINT) AS n_rows,
       round(sum(CASE WHEN dt = fdt AND hr = fhr THEN 2 * value ELSE value END), 6) AS sum_value
FROM e, f GROUP BY 1, 2""")
def s5_rerun_hour(spark, sf_dir):
    """Re-running one hour replaces that hour only; the others survive."""
    from postlake.functions import partition_date, partition_hour
    from postlake.session import scratch_dir
    from postlake.sources.lake import read_raw, write_by_time, write_hour
    root = scratch_dir(spark, "raw")
    ev = read_table(spark, sf_dir, "events")
    write_by_time(ev, root, "ts")
    first = ev.agg(F.min("ts").alias("t")).select(partition_date("t").alias("dt"),
                                                  partition_hour("t").alias("hr")).first()
    redo = (ev.where((partition_date("ts") == first.dt) & (partition_hour("ts") == first.hr))
              .withColumn("value", F.col("value") * 2))
    write_hour(redo, root, first.dt, first.hr)
    return read_raw(spark, root).groupBy("dt", "hr").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 6).alias("sum_value"))


@register("s7_snapshot_roundtrip", """
SELECT event_id, value + 1 AS value, 2 AS version FROM events""")
def s7_snapshot_roundtrip(spark, sf_dir):
    """Two versions written side by side; readers see the newest."""
    from postlake.session import scratch_dir
    from postlake.sources.lake import latest_version, read_snapshot, write_snapshot
    root = scratch_dir(spark, "snap")
    ev = read_table(spark, sf_dir, "events").select("event_id", "value")
    write_snapshot(ev, root)
    write_snapshot(ev.withColumn("value", F.col("value") + 1), root)
    v = latest_version(spark, root)
    return read_snapshot(spark, root).withColumn("version", F.lit(v))


# ---------------------------------------------------------------- curation

@register("u1_union_missing_cols", """
SELECT event_id, 'old' AS src, props FROM events
UNION ALL SELECT event_id, 'new' AS src, CAST(NULL AS VARCHAR) AS props FROM events""")
def u1_union_missing_cols(spark, sf_dir):
    """Union by name; the newer batch lacks ``props`` -> NULL."""
    from postlake.operators.curate import union_by_name
    ev = read_table(spark, sf_dir, "events")
    old = ev.select("event_id", F.lit("old").alias("src"), "props")
    new = ev.select("event_id", F.lit("new").alias("src"))
    return union_by_name(old, new)


@register("d1_curate_max_score", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY value DESC NULLS LAST, ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""")
def d1_curate_max_score(spark, sf_dir):
    """Snapshots of a key (events per user) -> the max-score row."""
    from postlake.operators.curate import best_per_key
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value", "props")
    return best_per_key(ev, "user_id", ("value", "ts", "event_id"))


@register("d3_sort_nulls_last", f"""{POSTS_CTE}
SELECT id, score, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, id) AS INTEGER) AS rank
FROM posts ORDER BY score DESC NULLS LAST, id LIMIT 10""")
def d3_sort_nulls_last(spark, sf_dir):
    """Posts by score descending, NULLs last; the head of 10."""
    from postlake.operators.curate import top_n
    return top_n(posts(spark, sf_dir).select("id", "score"), 10,
                 [F.desc_nulls_last("score"), F.asc("id")])


# ---------------------------------------------------------------- metrics, split, fitted stats

_EVENT_SCORERS_SQL = """
SELECT 'value' AS model, 1 AS ordinal, CAST(event_type = 'purchase' AS INTEGER) AS y, value / 500.0 AS p FROM events
UNION ALL
SELECT 'k' AS model, 2 AS ordinal, CAST(event_type = 'purchase' AS INTEGER) AS y,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS p FROM events"""


def _event_scorers(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_type", "value", "props")
    y = (F.col("event_type") == "purchase").cast("int")
    k = F.get_json_object("props", "$.k").cast("double")
    return (ev.select(F.lit("value").alias("model"), y.alias("y"), (F.col("value") / 500.0).alias("p"))
              .unionByName(ev.select(F.lit("k").alias("model"), y.alias("y"), (k / 100.0).alias("p"))))


@register("a5_metrics", Q.metrics_sql("(" + _EVENT_SCORERS_SQL + ")"))
def a5_metrics(spark, sf_dir):
    """A5..A8, M7: accuracy, F1, ROC AUC, average precision of two scorers of
    'purchase' events, evaluated in one pass grouped by model."""
    from postlake.operators.metrics import evaluate
    return evaluate(_event_scorers(spark, sf_dir))


@register("a9_champion", f"""
WITH m AS ({Q.metrics_sql("(" + _EVENT_SCORERS_SQL + ")")}),
o AS (SELECT 'value' AS model, 1 AS ordinal UNION ALL SELECT 'k', 2)
SELECT model AS champion, roc_auc FROM m JOIN o USING (model)
ORDER BY roc_auc DESC NULLS LAST, ordinal LIMIT 1""")
def a9_champion(spark, sf_dir):
    """Champion by ROC AUC, first model wins ties."""
    from postlake.operators.metrics import champion, evaluate
    return champion(evaluate(_event_scorers(spark, sf_dir)), order=["value", "k"])


def _train_test(spark, sf_dir):
    from postlake.operators.split import stratified_split
    return stratified_split(build_tabular_features(posts(spark, sf_dir)), "vai_bombar")


_SPLIT_SQL = f"WITH posts AS ({POSTS_SQL}), feats AS ({Q.tabular_sql('posts')}), " \
             f"sp AS ({__import__('postlake.operators.split', fromlist=['split_sql']).split_sql('feats', 'vai_bombar')})"


@register("m1_split", f"""{_SPLIT_SQL}
SELECT split, vai_bombar, CAST(count(*) AS BIGINT) AS n, CAST(sum(id) AS BIGINT) AS id_sum,
       CAST(min(id) AS BIGINT) AS min_id FROM sp GROUP BY 1, 2""")
def m1_split(spark, sf_dir):
    """Exact stratified 80/20 split, reproducible by hash of id:seed."""
    sp = _train_test(spark, sf_dir)
    return sp.groupBy("split", "vai_bombar").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"), F.min("id").alias("min_id"))


@register("a3_rare_categories", f"""{_SPLIT_SQL},
l AS (SELECT 'domain' AS feature, domain AS category FROM sp WHERE split = 'train'
      UNION ALL SELECT 'by_author', by_author FROM sp WHERE split = 'train')
SELECT feature, category, CAST(count(*) AS BIGINT) AS n,
       CASE WHEN count(*) >= 5 THEN category ELSE '__rare__' END AS mapped
FROM l GROUP BY 1, 2""")
def a3_rare_categories(spark, sf_dir):
    """Fitted category vocabulary on the train split; rare -> shared value."""
    from postlake.operators.encoding import category_vocabulary
    train = _train_test(spark, sf_dir).where(F.col("split") == "train")
    return category_vocabulary(train, ["domain", "by_author"], 5)


_NUMERIC = ["title_len", "n_words_title", "hour", "weekday", "has_url", "has_question"]


@register("a4_standardise", f"""{_SPLIT_SQL},
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM sp WHERE split = 'train'"
                          for c in _NUMERIC)})
SELECT feature, avg(value) AS mean, stddev_pop(value) AS std FROM l GROUP BY 1""")
def a4_standardise(spark, sf_dir):
    """A4, M3: mean and population std of the six numeric features on the train split."""
    from postlake.operators.encoding import standard_stats
    train = _train_test(spark, sf_dir).where(F.col("split") == "train")
    return standard_stats(train, _NUMERIC)


# ---------------------------------------------------------------- encoding and vectors

@register("e2_encode", Q.hashed_terms_sql("documents", "doc_id", "text"))
def e2_encode(spark, sf_dir):
    """Hashed bag-of-words of every whole document, long form (id, bucket, weight)."""
    from postlake.operators.embed import hashed_terms
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return hashed_terms(docs, "id", "text")


@register("e1_encode_pandas", Q.hashed_terms_sql("documents", "doc_id", "text"))
def e1_encode_pandas(spark, sf_dir):
    """The same encoder as a Python callable through mapInPandas (one per task)."""
    from postlake.operators.embed import HashedBagOfWords, dense_to_terms, encode_with

    def factory():
        enc = HashedBagOfWords()
        return lambda texts: enc(texts, dtype="float64")
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return dense_to_terms(encode_with(docs, factory, "text", element_type="double"))


@register("e4_quantise", """
SELECT vec_id, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE), 6) AS FLOAT)) AS embedding_q,
       '[' || array_to_string(list_transform(embedding, lambda x: printf('%.6f', CAST(x AS DOUBLE))), ',') || ']'
         AS embedding_text
FROM embeddings""")
def e4_quantise(spark, sf_dir):
    """Vectors quantised to 6 decimals and their text literal."""
    from postlake.functions import quantize, to_text
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", quantize("embedding").alias("embedding_q"), to_text("embedding").alias("embedding_text"))


_UPSERT_SQL = """
WITH old AS (SELECT vec_id AS id, label, embedding, 'v1' AS model_name FROM embeddings),
new AS (SELECT vec_id AS id, label + 100 AS label, list_transform(embedding, lambda x: -x) AS embedding,
               'v2' AS model_name FROM embeddings WHERE label < 5
        UNION ALL
        SELECT vec_id + 1000000 AS id, label + 100 AS label, list_transform(embedding, lambda x: -x) AS embedding,
               'v2' AS model_name FROM embeddings WHERE label < 5)
SELECT * FROM old WHERE id NOT IN (SELECT id FROM new)
UNION ALL SELECT * FROM new"""


@register("s11_upsert", _UPSERT_SQL)
def s11_upsert(spark, sf_dir):
    """Re-embedded classes 0-4 replace their rows whole and add new ids."""
    from postlake.session import scratch_dir
    from postlake.sources.vectors import read_vectors, upsert_snapshot
    root = scratch_dir(spark, "vectors")
    emb = read_table(spark, sf_dir, "embeddings")
    old = emb.select(F.col("vec_id").alias("id"), "label", "embedding", F.lit("v1").alias("model_name"))
    upsert_snapshot(root, old)
    changed = emb.where(F.col("label") < 5).select(
        "vec_id", (F.col("label") + 100).alias("label"),
        F.transform("embedding", lambda x: -x).alias("embedding"), F.lit("v2").alias("model_name"))
    new = (changed.withColumnRenamed("vec_id", "id")
                  .unionByName(changed.select((F.col("vec_id") + 1000000).alias("id"), "label", "embedding",
                                              "model_name")))
    upsert_snapshot(root, new)
    return read_vectors(spark, root).select("id", "label", "embedding", "model_name")


@register("s12_constraints", """
WITH c AS (
  SELECT vec_id AS id, CASE WHEN label = 3 THEN NULL ELSE 'v' || CAST(vec_id AS VARCHAR) END AS title,
         CASE WHEN label = 7 THEN embedding[1:63] ELSE embedding END AS embedding, 'given' AS model_name
  FROM embeddings
  UNION ALL
  SELECT vec_id, 'dup', embedding, 'given' FROM embeddings WHERE label = 9)
SELECT id, 'duplicate_id' AS reason FROM c GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, 'null_title' FROM c WHERE title IS NULL
UNION ALL SELECT id, 'wrong_dimension' FROM c WHERE len(embedding) <> 64""")
def s12_constraints(spark, sf_dir):
    """Key, NOT NULL and dimension checks of vector rows -> rejects."""
    from postlake.sources.vectors import constraint_violations
    emb = read_table(spark, sf_dir, "embeddings")
    c = emb.select(
        F.col("vec_id").alias("id"),
        F.when(F.col("label") == 3, F.lit(None).cast("string")).otherwise(F.concat(F.lit("v"), F.col("vec_id").cast("string"))).alias("title"),
        F.when(F.col("label") == 7, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("embedding"),
        F.lit("given").alias("model_name"))
    dup = emb.where(F.col("label") == 9).select(F.col("vec_id").alias("id"), F.lit("dup").alias("title"), "embedding",
                                                F.lit("given").alias("model_name"))
    return constraint_violations(c.unionByName(dup), "id", dim=64)


def _label_centroids(emb):
    """One query per label: the mean vector of the label (derived from the whole table)."""
    parts = emb.select("label", F.posexplode("embedding").alias("pos", "x")) \
               .groupBy("label", "pos").agg(F.avg("x").alias("m"))
    return parts.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("s")) \
                .select(F.col("label").alias("query_id"), F.transform("s", lambda e: e["m"]).alias("embedding"))


@register("k1_knn", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, i, avg(v[i]) AS m FROM (SELECT label, v, unnest(generate_series(1, len(v))) AS i FROM e) _u
      GROUP BY label, i),
q AS (SELECT label AS query_id, list(m ORDER BY i) AS qv FROM x GROUP BY label),
s AS (SELECT q.query_id, e.vec_id AS id, list_cosine_similarity(e.v, q.qv) AS similarity FROM q, e)
SELECT query_id, id, similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC NULLS LAST, id) AS rank FROM s) _r
WHERE rank <= 10""")
def k1_knn(spark, sf_dir):
    """Exact cosine top-10 of every label centroid over all vectors."""
    from postlake.operators.search import knn
    emb = read_table(spark, sf_dir, "embeddings")
    hits = knn(emb.select(F.col("vec_id").alias("id"), "embedding"), _label_centroids(emb), k=10)
    return hits.select("query_id", "id", "similarity", "rank")


def _ivf(spark, sf_dir, nprobe):
    from postlake.operators.search import build_ivf, ivf_search
    from postlake.session import scratch_dir
    emb = read_table(spark, sf_dir, "embeddings")
    vecs = emb.select(F.col("vec_id").alias("id"), "embedding")
    path = scratch_dir(spark, "ivf")
    build_ivf(vecs, path, cells=16)
    return vecs, _label_centroids(emb), ivf_search(spark, path, _label_centroids(emb), k=10, nprobe=nprobe)


@register("k2_ivf_full", ORACLE["k1_knn"])
def k2_ivf_full(spark, sf_dir):
    """With all 16 cells probed the index search is exact."""
    return _ivf(spark, sf_dir, 16)[2].select("query_id", "id", "similarity", "rank")


_ROW_QUERIES_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_cosine_similarity(e.v, q.v) AS similarity FROM e q, e WHERE q.vec_id % 100 = 0)
SELECT query_id, id, similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC NULLS LAST, id) AS rank FROM s) _r
WHERE rank <= 10"""


def _quantised(spark, sf_dir):
    """(vectors, queries: every row whose id is divisible by 100, path of the index)."""
    from postlake.operators import ann
    from postlake.session import scratch_dir
    vecs = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    path = scratch_dir(spark, "ann")
    ann.build_index(vecs, path)
    return vecs, vecs.where("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding"), path


@register("k2_ivf_recall", "SELECT 10 * count_if(vec_id % 100 = 0) AS n_exact, 1 AS enough FROM embeddings")
def k2_ivf_recall(spark, sf_dir):
    """Every row of an id divisible by 100 finds 0.9 of its exact ten at the index's own number of cells."""
    from postlake.operators import ann
    from postlake.operators.search import knn, recall_at_k
    from postlake.session import materialise
    vecs, queries, path = _quantised(spark, sf_dir)
    exact = materialise(knn(vecs, queries, k=10).select("query_id", "id"), "exact")
    enough = recall_at_k(ann.search(spark, path, queries, k=10), exact) >= 0.9
    return exact.agg(F.count(F.lit(1)).alias("n_exact"), F.lit(int(enough)).alias("enough"))


@register("k2_quantised_full", _ROW_QUERIES_SQL)
def k2_quantised_full(spark, sf_dir):
    """K2: with every cell visited and every row on the shortlist the quantised search is exact."""
    from postlake.operators import ann
    vecs, queries, path = _quantised(spark, sf_dir)
    found = ann.search(spark, path, queries, k=10, nprobe=len(ann.open_index(spark, path).sizes), shortlist=vecs.count())
    return found.select("query_id", "id", "similarity", "rank")


@register("k1_pruned", _ROW_QUERIES_SQL)
def k1_pruned(spark, sf_dir):
    """K1: exact top-10 through the cells' bounds; what can't hold a hit isn't read."""
    from postlake.operators import ann
    _, queries, path = _quantised(spark, sf_dir)
    return ann.exact_search(spark, path, queries, k=10)[0].select("query_id", "id", "similarity", "rank")


_DOC_TERMS = Q.hashed_terms_sql("documents", "doc_id", "text")
_BENCH_TERMS = Q.hashed_terms_sql("benchmark", "item_id", "text")


@register("k3_text_search", f"""
WITH dt AS (SELECT id, bucket, CAST(CAST(weight AS FLOAT) AS DOUBLE) AS w FROM ({_DOC_TERMS}) _d),
qt AS (SELECT id, bucket, CAST(CAST(weight AS FLOAT) AS DOUBLE) AS w FROM ({_BENCH_TERMS}) _q),
dn AS (SELECT id, sqrt(sum(w * w)) AS n FROM dt GROUP BY id),
qn AS (SELECT id, sqrt(sum(w * w)) AS n FROM qt GROUP BY id),
s AS (SELECT qt.id AS query_id, dt.id AS id, sum(qt.w * dt.w) AS dotp FROM qt JOIN dt USING (bucket) GROUP BY 1, 2),
c AS (SELECT s.query_id, s.id, dotp / (qn.n * dn.n) AS similarity
      FROM s JOIN qn ON qn.id = s.query_id JOIN dn ON dn.id = s.id)
SELECT query_id, id, similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC NULLS LAST, id) AS rank FROM c) _r
WHERE rank <= 10""")
def k3_text_search(spark, sf_dir):
    """Every benchmark text as a query over every whole document, top 10."""
    from postlake.operators.embed import hashed_vectors
    from postlake.operators.search import knn
    docs = hashed_vectors(read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), "text")
    qs = hashed_vectors(read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text"), "text")
    return knn(docs, qs, k=10).select("query_id", "id", "similarity", "rank")


@register("k4_author_recent", f"""{POSTS_CTE}, t AS ({Q.text_sql('posts')})
SELECT by_author, id, created_ts, CAST(rank AS INTEGER) AS rank FROM (
  SELECT by_author, id, created_ts,
         row_number() OVER (PARTITION BY by_author ORDER BY created_ts DESC NULLS LAST, id) AS rank FROM t) _r
WHERE rank <= 5""")
def k4_author_recent(spark, sf_dir):
    """K4: each author's five most recent stories."""
    from postlake.operators.search import by_author_recent
    return by_author_recent(build_text_features(posts(spark, sf_dir))).select("by_author", "id", "created_ts", "rank")


# ---------------------------------------------------------------- validation and gates

@register("p14_validate_predict", f"""{POSTS_CTE}
SELECT id, CAST(((id % 26) <= 23 AND (id % 8) <= 6 AND title IS NOT NULL) AS INTEGER) AS valid,
       concat_ws(',', CASE WHEN title IS NULL THEN 'title_required' END,
                      CASE WHEN id % 26 > 23 THEN 'hour_out_of_range' END,
                      CASE WHEN id % 8 > 6 THEN 'weekday_out_of_range' END) AS reasons,
       coalesce("by", 'unknown') AS by_author
FROM posts""")
def p14_validate_predict(spark, sf_dir):
    """Prediction requests built from posts (hour = id mod 26, weekday = id mod 8) -> valid / reasons."""
    from postlake.operators.quality import validate_predict
    req = posts(spark, sf_dir).select("id", "title", "url", F.col("by").alias("by_author"),
                                      F.pmod("id", F.lit(26)).cast("int").alias("hour"),
                                      F.pmod("id", F.lit(8)).cast("int").alias("weekday"))
    v = validate_predict(req)
    return v.select("id", "valid", F.concat_ws(",", "reasons").alias("reasons"), "by_author")


@register("p15_validate_search", """
SELECT conv_id, turn, CAST(coalesce(turn, 10) AS INTEGER) AS k,
       CAST((text IS NOT NULL AND length(text) >= 1 AND coalesce(turn, 10) BETWEEN 1 AND 50) AS INTEGER) AS valid,
       concat_ws(',', CASE WHEN text IS NULL OR length(text) < 1 THEN 'query_required' END,
                      CASE WHEN NOT (coalesce(turn, 10) BETWEEN 1 AND 50) THEN 'k_out_of_range' END) AS reasons
FROM conversations""")
def p15_validate_search(spark, sf_dir):
    """Every conversation turn as a search request, k = turn."""
    from postlake.operators.quality import validate_search
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("query"),
                                                             F.col("turn").alias("k"))
    v = validate_search(conv)
    return v.select("conv_id", "turn", "k", "valid", F.concat_ws(",", "reasons").alias("reasons"))


@register("p_gates", f"""{POSTS_CTE}, f AS ({Q.tabular_sql('posts')}), t AS ({Q.text_sql('posts')})
SELECT (SELECT count(*) FROM f) AS n_rows,
       (SELECT count(DISTINCT vai_bombar) FROM f) AS n_classes,
       CAST((SELECT count(*) FROM f) >= 20 AS INTEGER) AS min_rows_ok,
       CAST((SELECT count(DISTINCT vai_bombar) FROM f) >= 2 AS INTEGER) AS two_classes_ok,
       (SELECT count(*) FROM t) AS n_text,
       CAST((SELECT count(*) FROM t) > 0 AS INTEGER) AS text_ok""")
def p_gates(spark, sf_dir):
    """P10..P13, A1, A2: the training and embedding gates as one row of counts and flags."""
    from postlake.operators import quality
    from postlake.session import materialise
    from postlake.sources.ingest import require_rows

    def passes(gate, df):
        try:
            gate(df)
        except ValueError:
            return 0
        return 1

    p = require_rows(posts(spark, sf_dir), "posts")
    features = materialise(build_tabular_features(p).select("id", "vai_bombar"), "gate-features")
    texts = materialise(build_text_features(p).select("id"), "gate-texts")
    counts = features.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("vai_bombar").alias("n_classes"))
    flags = {"min_rows_ok": passes(quality.gate_min_rows, features), "two_classes_ok": passes(quality.gate_two_classes, features),
             "text_ok": passes(quality.gate_not_empty, texts)}
    return counts.withColumns({**{k: F.lit(v) for k, v in flags.items()}, "n_text": F.lit(texts.count())})


# ---------------------------------------------------------------- models (SQL of what is exact: rows, ranges, flags)

def _fit_score(spark, sf_dir, name, estimator):
    from postlake.operators.model import fit
    from postlake.session import materialise
    sp = materialise(_train_test(spark, sf_dir), "train-test")
    m = fit(name, estimator, sp.where(F.col("split") == "train"))
    return m, sp, m.score(sp.where(F.col("split") == "test"))


def _checked(scored):
    p = F.col("probability")
    return [(p.between(0.0, 1.0)).cast("int").alias("p_in_range"),
            (F.col("prediction") == (p >= 0.5).cast("int")).cast("int").alias("class_ok")]


def _scored_rows(spark, sf_dir, name, estimator):
    _, _, scored = _fit_score(spark, sf_dir, name, estimator)
    return scored.select("id", F.col("vai_bombar").alias("y"), *_checked(scored), "model_name")


_SCORED_SQL = f"""{_SPLIT_SQL}
SELECT id, vai_bombar AS y, 1 AS p_in_range, 1 AS class_ok, '{{name}}' AS model_name FROM sp WHERE split = 'test'"""


@register("m5_forest", _SCORED_SQL.replace('{name}', 'random_forest'))
def m5_forest(spark, sf_dir):
    """M4, M5, M9: random forest (200 trees, depth 12) fit on the train split, test split scored."""
    from postlake.operators.model import random_forest
    return _scored_rows(spark, sf_dir, "random_forest", random_forest())


@register("m6_boosted", _SCORED_SQL.replace('{name}', 'boosted_trees'))
def m6_boosted(spark, sf_dir):
    """M4, M6, M9: boosted trees (300 rounds, depth 6, rate 0.1, sampling 0.9) on the same split."""
    from postlake.operators.model import boosted_trees
    return _scored_rows(spark, sf_dir, "boosted_trees", boosted_trees())


@register("m8_save_load_score", f"""{_SPLIT_SQL}
SELECT id, 1 AS same, 'random_forest' AS model_name, 'champion' AS model_stage FROM sp WHERE split = 'test'""")
def m8_save_load_score(spark, sf_dir):
    """Persist the fitted unit, reload it by preference, score again; equal scores."""
    from postlake.operators.model import load_preferred, random_forest
    from postlake.session import scratch_dir
    root = scratch_dir(spark, "models")
    m, sp, scored = _fit_score(spark, sf_dir, "random_forest", random_forest())
    m.save(root, "champion")
    again = load_preferred(spark, root, ["champion", "random_forest"]).score(sp.where(F.col("split") == "test"))
    a = scored.select("id", F.col("probability").alias("p_fit"))
    b = again.select("id", F.col("probability").alias("p_loaded"), "model_name", "model_stage")
    return a.join(b, "id").select("id", (F.abs(F.col("p_fit") - F.col("p_loaded")) < 1e-12).cast("int").alias("same"),
                                  "model_name", "model_stage")


_PARAMS = {"random_forest": {"numTrees": "200", "maxDepth": "12", "seed": "42"},
           "boosted_trees": {"maxIter": "300", "maxDepth": "6", "stepSize": "0.1", "subsamplingRate": "0.9", "seed": "42"}}
_LOG_ROWS = ([(m, "param", "clf__" + k, v) for m, ps in _PARAMS.items() for k, v in ps.items()]
             + [(m, "tag", "modelo", m) for m in _PARAMS]
             + [(m, "metric", k, "in range") for m in _PARAMS for k in ("accuracy", "f1", "roc_auc", "pr_auc")])


@register("m10_run_log", f"""{_SPLIT_SQL}
SELECT model, kind, key, value, (SELECT count(*) FROM sp WHERE split = 'test') AS n_test, 1 AS champion_is_best
FROM (VALUES {", ".join("(" + ", ".join(Q.sql_str(x) for x in r) + ")" for r in _LOG_ROWS)}) AS v(model, kind, key, value)""")
def m10_run_log(spark, sf_dir):
    """M1, M4..M10, A9, D7: gates, split, both candidates, one-pass evaluation, champion
    persisted and reloaded, long-form run record; metric values only as a flag."""
    from postlake.operators.model import load_preferred, train_and_select
    from postlake.session import scratch_dir
    work = scratch_dir(spark, "train")
    summary = train_and_select(build_tabular_features(posts(spark, sf_dir)), work)
    log = spark.read.parquet(f"{work}/runs").where(F.col("run_id") == summary["run_id"])
    best = max(summary["metrics"].values(), key=lambda m: m["roc_auc"])["roc_auc"]
    loaded = load_preferred(spark, f"{work}/models", ["champion", *summary["metrics"]])
    right = loaded.name == summary["champion"] and summary["roc_auc"] == best and loaded.stage == "champion"
    value = F.when(F.col("kind") != "metric", F.col("value")).when(F.col("value").cast("double").between(0, 1), F.lit("in range"))
    wanted = {m: [f"clf__{k}" for k in ps] for m, ps in _PARAMS.items()}
    mine = F.lit(False)
    for m, keys in wanted.items():
        mine = mine | ((F.col("model") == m) & F.col("key").isin(keys))
    return log.where((F.col("kind") != "param") | mine).select(
        "model", "kind", "key", value.alias("value"), F.lit(summary["n_test"]).cast("long").alias("n_test"),
        F.lit(int(right)).alias("champion_is_best"))


# ---------------------------------------------------------------- streaming (SQL of the batch form)

def _land_events(spark, sf_dir, files: int = 4, late: bool = False):
    """Events landed as several files ordered by time (a stream of hourly drops), or in no order at all."""
    from postlake.session import scratch_dir
    landing = scratch_dir(spark, "landing")
    ev = read_table(spark, sf_dir, "events")
    dealt = ev.repartition(files, "event_id") if late else ev.repartitionByRange(files, "ts")
    dealt.write.parquet(landing)
    return landing, ev.schema


@register("r1_stream_raw", _HOURLY_SQL.format(value="value", extra=""))
def r1_stream_raw(spark, sf_dir):
    """Landed files -> raw dt/hr layer by Structured Streaming (availableNow)."""
    from postlake.session import scratch_dir
    from postlake.sources.lake import read_raw
    from postlake.streaming.jobs import read_landing, stream_raw
    landing, schema = _land_events(spark, sf_dir)
    raw, ckpt = scratch_dir(spark, "raw"), scratch_dir(spark, "ckpt")
    stream_raw(read_landing(spark, landing, schema, max_files_per_trigger=1), raw, ckpt, "ts").awaitTermination()
    return read_raw(spark, raw).groupBy("dt", "hr").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 6).alias("sum_value"))


@register("r2_stream_curate", ORACLE["d1_curate_max_score"])
def r2_stream_curate(spark, sf_dir):
    """R2: each micro-batch merged into the curated snapshot (one version per batch)."""
    from postlake.session import scratch_dir
    from postlake.streaming.jobs import read_landing, stream_curate
    landing, schema = _land_events(spark, sf_dir)
    root, ckpt = scratch_dir(spark, "curated"), scratch_dir(spark, "ckpt")
    stream = read_landing(spark, landing, schema, max_files_per_trigger=1).select(
        "user_id", "event_id", "ts", "event_type", "value", "props")
    stream_curate(stream, root, ckpt, "user_id", ("value", "ts", "event_id")).awaitTermination()
    from postlake.sources.lake import read_snapshot
    return read_snapshot(spark, root)


@register("r3_stream_state", ORACLE["d1_curate_max_score"])
def r3_stream_state(spark, sf_dir):
    """Best row per key held in the streaming state store, upserted per batch."""
    from postlake.session import scratch_dir
    from postlake.sources.lake import read_snapshot
    from postlake.streaming.jobs import read_landing, stream_best_state
    landing, schema = _land_events(spark, sf_dir)
    root, ckpt = scratch_dir(spark, "state"), scratch_dir(spark, "ckpt")
    stream = read_landing(spark, landing, schema, max_files_per_trigger=1).select(
        "user_id", "event_id", "ts", "event_type", "value", "props")
    stream_best_state(stream, root, ckpt, "user_id", ("value", "ts", "event_id")).awaitTermination()
    return read_snapshot(spark, root)


@register("r3_bounded_state", ORACLE["d1_curate_max_score"])
def r3_bounded_state(spark, sf_dir):
    """Best row per key with a state that forgets keys which nothing has improved for a second."""
    from postlake.session import scratch_dir
    from postlake.sources.lake import read_snapshot
    from postlake.streaming.jobs import read_landing, stream_bounded_state
    landing, schema = _land_events(spark, sf_dir)
    root, ckpt = scratch_dir(spark, "state"), scratch_dir(spark, "ckpt")
    stream = read_landing(spark, landing, schema, max_files_per_trigger=1).select(
        "user_id", "event_id", "ts", "event_type", "value", "props")
    stream_bounded_state(stream, root, ckpt, "user_id", ("value", "ts", "event_id"), idle_seconds=1).awaitTermination()
    return read_snapshot(spark, root)


_DROPS_SQL = """
WITH s AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // 3 + 1 AS step FROM events),
d AS (SELECT event_id, ts, epoch_us(ts) AS t, step, (epoch_us(ts) - lo) // step
             + CASE WHEN event_id % 25 = 0 THEN 2 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS drop_no FROM events, s),
e AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE event_id % 11 = 0
      UNION ALL SELECT event_id, ts, t, step, drop_no + 1 FROM d WHERE event_id % 7 = 0),
m AS (SELECT drop_no, max(t) AS top FROM e GROUP BY drop_no),
h AS (SELECT drop_no, max(top) OVER (ORDER BY drop_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM m),
k AS (SELECT e.*, coalesce(e.t < h.seen - e.step // 2, false) AS late FROM e JOIN h USING (drop_no)),
o AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, late, row_number() OVER (PARTITION BY event_id, late ORDER BY drop_no) AS nth FROM k)
SELECT dt, CAST(count(*) FILTER (WHERE NOT late AND nth = 1) AS BIGINT) AS n_accepted,
       CAST(count(*) FILTER (WHERE NOT late AND nth > 1) AS BIGINT) AS n_duplicate,
       CAST(count(*) FILTER (WHERE late) AS BIGINT) AS n_late
FROM o GROUP BY dt"""


@register("r4_late_rows", _DROPS_SQL)
def r4_late_rows(spark, sf_dir):
    """Accepted, duplicate and late rows a day of events that land in drops, some of them a drop or two late, some twice.

    The stream is restarted for every drop; a row is late by more than half a drop.
    """
    from postlake.functions import partition_date
    from postlake.session import scratch_dir
    from postlake.sources.lake import read_raw
    from postlake.streaming.jobs import read_landing
    from postlake.streaming.late import stream_raw_on_time
    ev = read_table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(at), F.max(at)).first()
    step = (hi - lo) // 3 + 1 if lo is not None else 1
    late = F.when(F.col("event_id") % 25 == 0, 2).when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    one = ev.withColumn("drop_no", (F.floor((at - F.lit(lo)) / F.lit(step)) + late).cast("int"))
    drops = one.unionByName(one.where("event_id % 11 = 0")).unionByName(
        one.where("event_id % 7 = 0").withColumn("drop_no", F.col("drop_no") + 1))
    landing, raw, aside, ckpt = (scratch_dir(spark, n) for n in ("landing", "raw", "late", "ckpt"))
    for k in range(6):
        drops.where(F.col("drop_no") == k).drop("drop_no").write.mode("append").parquet(landing)
        stream_raw_on_time(read_landing(spark, landing, ev.schema), raw, aside, ckpt, "ts", ["event_id"],
                           step // 2 / 1_000_000).awaitTermination()
    landed = spark.read.schema(ev.schema).parquet(landing).select(partition_date("ts").alias("dt"), F.lit(0).alias("kind"))
    both = [read_raw(spark, root, schema=ev.schema).select("dt", F.lit(kind).alias("kind")) for root, kind in ((raw, 1), (aside, 2))]
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    return landed.unionByName(both[0]).unionByName(both[1]).groupBy("dt").agg(
        n(1).alias("n_accepted"), (n(0) - n(1) - n(2)).alias("n_duplicate"), n(2).alias("n_late"))


from postlake.plans import catalog_jobs  # noqa: E402, F401  registers the composed jobs and the smaller operators
