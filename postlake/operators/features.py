"""Feature builders (P1..P9): curated items -> tabular / text features.

The two builders filter differently on purpose (tabular keeps the raw
title, drops a NULL score and an unparseable time; text strips the title,
drops a blank one, fills score with 0 and keeps a NULL ``created_ts``), so
they do not share a filter.  Both are narrow (no shuffle) except the final
one-row-per-id step of the text builder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake import schemas
from postlake.functions import (domain, ends_with_question, epoch_to_ts, has_url, hour_utc,
                                is_numeric_null, lenient_int, strip_ws, target_flag, title_length,
                                weekday_monday0, word_count)
from postlake.operators.curate import best_per_key, key_repeats

ITEM_COLUMNS = ["id", "type", "by", "time", "title", "url", "score"]


def ensure_columns(df: DataFrame, names=ITEM_COLUMNS) -> DataFrame:
    """A column absent from the batch is a NULL column (string typed)."""
    missing = [c for c in names if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing]) if missing else df


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def stories(df: DataFrame) -> DataFrame:
    """``type = 'story'``; a NULL type is dropped."""
    return df.where(F.col("type") == "story")


def build_tabular_features(curated: DataFrame, score_threshold: int = 100) -> DataFrame:
    """Tabular features and target, contract ``schemas.TABULAR_COLUMNS``."""
    df = ensure_columns(curated)
    score_t, time_t = _dtype(df, "score"), _dtype(df, "time")
    df = stories(df).where(                                            # P1, P2
        F.col("title").isNotNull() & ~is_numeric_null("time", time_t) & ~is_numeric_null("score", score_t))
    df = df.select(
        "id", "type", "by", "url",
        F.col("title").cast("string").alias("title"),                  # T14
        lenient_int("score", score_t).alias("score"),                  # T10
        epoch_to_ts("time").alias("created_ts"),                       # T9
    ).where(F.col("created_ts").isNotNull())                           # P5
    return df.select(                                                  # P6
        "id", "title",
        title_length("title").alias("title_len"),                      # T1
        word_count("title").alias("n_words_title"),                    # T3
        hour_utc("created_ts").alias("hour"),                          # T7
        weekday_monday0("created_ts").alias("weekday"),                # T8
        has_url("url").alias("has_url"),                               # T5
        ends_with_question("title").alias("has_question"),             # T4
        domain("url").alias("domain"),                                 # T6
        F.coalesce("by", F.lit("unknown")).alias("by_author"),         # P9
        "type", "url", "score", "created_ts",
        target_flag("score", score_threshold).alias(schemas.TARGET),  # T12
    )


def build_text_features(curated: DataFrame, check_ids: bool = False) -> DataFrame:
    """Clean titles for the encoder, contract ``schemas.TEXT_COLUMNS``.

    ``check_ids`` first counts the rows of each id of ``curated`` (a written
    table): where none repeats there is nothing to choose, and no text is shuffled.
    """
    df = ensure_columns(curated)
    score_t, time_t = _dtype(df, "score"), _dtype(df, "time")
    df = stories(df).where(F.col("title").isNotNull() & ~is_numeric_null("time", time_t))  # P1, P3
    df = df.select(                                                                        # P7
        "id",
        strip_ws(F.col("title").cast("string")).alias("title"),                            # T2
        F.coalesce(F.col("url"), F.lit("")).alias("url"),                                  # T11
        lenient_int("score", score_t).alias("score"),                                      # T10
        F.coalesce("by", F.lit("unknown")).alias("by_author"),                             # P9
        epoch_to_ts("time").alias("created_ts"),                                           # T9
    ).where(F.length("title") > 0)                                                         # P4
    if check_ids and not key_repeats(curated):
        return df
    return best_per_key(df, "id", ("created_ts", "score"))                                 # D2


def model_input(features: DataFrame, with_target: bool = True) -> DataFrame:
    """The model's input columns in their fixed order."""
    cols = ["id"] + schemas.FEATURE_COLUMNS + ([schemas.TARGET] if with_target else [])
    return features.select(*cols)
