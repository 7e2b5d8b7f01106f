"""The three scheduled jobs and the two batch responses, over the roots of a ``Layout``.

Plain functions that chain the operators; when to run them is the caller's
business.  Every step that a later one reads is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import schemas
from postlake.operators import ann
from postlake.operators.curate import curate
from postlake.operators.embed import HASHED_MODEL_NAME, encode_frame, encode_with, encoding_log, hashed_vectors
from postlake.operators.features import build_tabular_features, build_text_features, model_input
from postlake.operators.latent import LatentEncoder
from postlake.operators.latent import fit as fit_encoder
from postlake.operators.model import load_preferred, request_features, train_and_select
from postlake.operators.quality import gate_not_empty, search_hits, split_valid, validate_predict, validate_search
from postlake.operators.search import knn
from postlake.session import materialise
from postlake.sources.ingest import hydrate, missing_ids, split_errors, top_ids
from postlake.sources.lake import (Layout, buckets_of, changed_rows, follow_snapshot, latest_version, mark_value, merge_snapshot,
                                   next_version, prune_versions, read_raw, read_snapshot, write_hour, write_marker)
from postlake.sources.vectors import constraint_violations, read_vectors, upsert_snapshot

HIT_COLUMNS = ["title", "url", "score", "by_author"]
MODEL_PREFERENCE = ["champion", "boosted_trees", "random_forest"]


def ingest_hour(spark: SparkSession, layout: Layout, items: DataFrame, dt: str, hr: str, keep: int = 3,
                buckets: int = 16) -> dict[str, int]:
    """Hourly: land the fetched items, merge them into their buckets of the curated snapshot, bring both feature layers up to it.

    A feature layer names the curated version it was derived from and has its
    buckets: those with a row that changed since are derived again from the
    curated ones, those without a change keep their files.  Returns the
    versions written.  Running an hour again replaces its raw rows and merges
    the same best rows.  The items are evaluated once: an hour into which
    nothing landed is an error, and keeps the rows it had.
    """
    write_hour(items, layout.raw, dt, hr, required=f"hour {dt} {hr}")
    landed = read_raw(spark, layout.raw, dt, hr).drop("dt", "hr")
    now = merge_snapshot(layout.curated, landed, "id", curate, buckets, keep_versions=keep, keys=landed.select("id"))
    out, changed = {"curated": now}, {None: None}  # a layer of unknown origin: any of its rows may be out of date
    for name, root, build in (("tabular", layout.tabular, build_tabular_features), ("text", layout.text, _text_features)):
        since = mark_value(spark, root, _FROM)
        if since not in changed:  # layers that follow the same version read one feed
            rows, left = changed_rows(spark, layout.curated, since, until=now)
            changed[since] = buckets_of(spark, layout.curated, now, rows.select("id").unionByName(left), "id")
        out[name] = follow_snapshot(spark, layout.curated, now, root, build, "id", changed[since], keep, mark=f"{_FROM}{now}")
    return out


_FROM = "_curated-"


def _text_features(curated: DataFrame) -> DataFrame:
    return build_text_features(curated, check_ids=True)


def _replaced(existing: DataFrame | None, batch: DataFrame) -> DataFrame:
    """A merge by which rows of the batch replace whole rows."""
    if existing is None:
        return batch
    return existing.join(batch.select("id"), "id", "left_anti").unionByName(batch, allowMissingColumns=True)


def ingest_ids(spark: SparkSession, layout: Layout, ranked: DataFrame, fetch, dt: str, hr: str, limit: int | None = 100,
               partitions: int | None = None, **options) -> tuple[dict[str, int], DataFrame, DataFrame]:
    """Hourly, from the ranked id list: the first ``limit`` ids are fetched once, failures set aside, the rest ingested.

    Returns (versions, errors (id, error), ids without an item).  ``options``
    go to ``hydrate``.
    """
    wanted = materialise(top_ids(ranked, limit).select("id"), "wanted")
    fetched = materialise(hydrate(wanted, fetch, partitions, **options), "fetched")
    items, errors = split_errors(fetched)
    return ingest_hour(spark, layout, items, dt, hr), errors, missing_ids(wanted, fetched)


def train_daily(spark: SparkSession, layout: Layout, candidates=None, **options) -> dict:
    """Daily: gates, split, all candidates, evaluation, champion and run record under the layout's roots."""
    return train_and_select(read_snapshot(spark, layout.tabular), layout.root, candidates, **options)


def train_encoder(spark: SparkSession, layout: Layout, **options) -> LatentEncoder:
    """Learn a text encoder from all curated texts and save it as the newest version; ``options`` go to ``latent.fit``."""
    texts = read_snapshot(spark, layout.text)
    gate_not_empty(texts)
    encoder, root = fit_encoder(texts, **options), f"{layout.models}/encoder"
    path = f"{root}/v={next_version(spark, root)}"
    encoder.save(spark, path)
    write_marker(spark, path)
    return encoder


def load_encoder(spark: SparkSession, layout: Layout) -> LatentEncoder | None:
    """The newest learnt encoder, or None."""
    version = latest_version(spark, f"{layout.models}/encoder")
    return None if version is None else LatentEncoder.load(spark, f"{layout.models}/encoder/v={version}")


def index_daily(spark: SparkSession, layout: Layout, dim: int = 384, keep: int = 2, encoder: LatentEncoder | None = None) -> dict:
    """Daily: gate, encode, reject rows that break a constraint, upsert, run record, search index over the encoder's rows.

    Encodes by a hash of the words, or by a learnt ``encoder``.
    """
    texts = read_snapshot(spark, layout.text)
    gate_not_empty(texts)
    if encoder is None:
        vectors, run_id, report = encode_frame(texts, dim=dim)
    else:
        dim = encoder.dim
        vectors, run_id, report = encode_frame(texts, model_name=encoder.name, encoder_factory=encoder.factory(spark))
    bad = materialise(constraint_violations(vectors, dim=dim).select("id").distinct(), "rejected")
    good = vectors if bad.isEmpty() else vectors.join(bad, "id", "left_anti")  # with no reject, no row meets another
    n = upsert_snapshot(layout.vectors, good, written=True)
    encoding_log(spark, run_id, report).write.mode("append").parquet(layout.runs)
    model = HASHED_MODEL_NAME if encoder is None else encoder.name
    index = f"{layout.index}/{model}"
    ann.build_index(read_vectors(spark, layout.vectors).where(F.col("model_name") == model), index, payload=HIT_COLUMNS,
                    row_key="id")
    prune_versions(spark, index, keep)
    return report | {"run_id": run_id, "n_written": n}


def predict(spark: SparkSession, layout: Layout, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch prediction: (rows with an id; valid ones with probability, prediction, model_name, model_stage; rejects with reasons)."""
    typed = requests.select("id", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.PREDICT_REQUEST.fields])
    valid, rejected = split_valid(materialise(validate_predict(typed), "checked", "zstd"))  # both are read
    model = load_preferred(spark, layout.models, MODEL_PREFERENCE)
    featured = request_features(valid.drop("reasons", "valid"))
    scored = model.score(model_input(featured, with_target=False))
    return scored.select("id", "probability", "prediction", "model_name", "model_stage"), rejected


def search(spark: SparkSession, layout: Layout, requests: DataFrame, model_name: str = HASHED_MODEL_NAME,
           dim: int = 384, exact: bool = False, encoder: LatentEncoder | None = None) -> tuple[DataFrame, DataFrame]:
    """Batch search: (hits of the valid requests, rejects).  Only vectors of the query's encoder are compared.

    Searches the index of the last daily job at the number of cells that the
    index measured; ``exact``, or an encoder without an index, compares every
    vector.  A learnt ``encoder`` encodes the queries as it encoded the texts.
    """
    valid, rejected = split_valid(validate_search(requests))
    asked = valid.select("query_id", "query", "k")
    if encoder is None:
        queries = hashed_vectors(asked, "query", dim)
    else:
        queries, model_name = encode_with(asked, encoder.factory(spark), "query"), encoder.name
    index = f"{layout.index}/{model_name}"
    if exact or latest_version(spark, index) is None:
        vectors = read_vectors(spark, layout.vectors).where(F.col("model_name") == model_name)
        return search_hits(knn(vectors, queries, k_col="k", payload=HIT_COLUMNS, row_key="id")), rejected
    return search_hits(ann.search(spark, index, queries, k_col="k", payload=HIT_COLUMNS)), rejected
