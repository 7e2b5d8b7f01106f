"""Fixed schemas and column contracts.

Items arrive as JSON with a varying set of fields; here every layer has a
fixed ``StructType`` so that a field absent from a batch is a NULL column,
never a missing one.
"""

from __future__ import annotations

from pyspark.sql import types as T

ITEM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("by", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("descendants", T.LongType()),
    T.StructField("kids", T.ArrayType(T.LongType())),
    T.StructField("deleted", T.BooleanType()),
    T.StructField("dead", T.BooleanType()),
])

# model input columns, in the fixed order used for training and scoring
NUMERIC_FEATURES = ["title_len", "n_words_title", "hour", "weekday", "has_url", "has_question"]
CATEGORICAL_FEATURES = ["domain", "by_author"]
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
TARGET = "vai_bombar"

TABULAR_COLUMNS = [
    "id", "title", "title_len", "n_words_title", "hour", "weekday", "has_url",
    "has_question", "domain", "by_author", "type", "url", "score", "created_ts", TARGET,
]

TEXT_COLUMNS = ["id", "title", "url", "score", "by_author", "created_ts"]

# vector table: one row per id
VECTORS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("url", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("by_author", T.StringType()),
    T.StructField("created_ts", T.TimestampNTZType()),
    T.StructField("embedding", T.ArrayType(T.FloatType()), False),
    T.StructField("model_name", T.StringType(), False),
    T.StructField("model_run_id", T.StringType()),
    T.StructField("indexed_at", T.TimestampType()),
])

SEARCH_HIT_COLUMNS = ["id", "title", "url", "score", "by_author", "similarity"]

PREDICT_REQUEST = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("by_author", T.StringType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("weekday", T.IntegerType()),
])

EMBEDDING_DIM = 384
