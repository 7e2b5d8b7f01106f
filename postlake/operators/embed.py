"""Text encoders (E1..E3, S14, S15).

No transformer weights are available offline, so the built-in encoder is a
*hashed bag of words*: lower-cased letter/digit runs, each token to bucket
``int(md5(token)[:8], 16) % dim``, term counts, L2-normalised.  It is
lexical, not semantic; a semantic model plugs in through ``encode_with``.

* ``hashed_terms`` (E2): the sparse long form ``(id, bucket, weight)`` from
  the dense vectors by ``posexplode``: row-local, no shuffle.
* ``hashed_vectors``: dense ``array`` by ``mapInArrow``; the distinct tokens of
  a batch are hashed and the whole batch is scattered with one ``bincount``.
* ``encode_with`` (E1): any ``encoder(texts) -> ndarray`` in ``mapInPandas``,
  built once per task, fed in batches (default 32).
* ``encode_frame`` (E3): add ``embedding``, stamp model name and a fresh run
  id (S14), materialise once, report count, dimension and a sample (S15).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.schemas import EMBEDDING_DIM
from postlake.session import materialise
from postlake.sources.vectors import with_lineage

HASHED_MODEL_NAME = "hashed-bow-md5"
TOKEN_PATTERN = r"[^\p{L}\p{N}]+"


def hashed_terms(df: DataFrame, id_col: str = "id", text_col: str = "title", dim: int = EMBEDDING_DIM) -> DataFrame:
    """E2 long form: ``(id, bucket, weight)``, weights of one row have unit norm."""
    dense = hashed_vectors(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")), "_text", dim, "_v", "double")
    return dense_to_terms(dense, "id", "_v")


ROWS_AT_ONCE = 1024


def hashed_vectors(df: DataFrame, text_col: str = "title", dim: int = EMBEDDING_DIM,
                   out_col: str = "embedding", element_type: str = "float") -> DataFrame:
    """Dense unit vectors of the hashed encoder, row-local (no shuffle).

    Arrow batches, each distinct token of a batch hashed once.  Not a UDF
    column: filters inferred above it would evaluate it twice.
    """
    np_type = np.float32 if element_type == "float" else np.float64
    element = T.FloatType() if element_type == "float" else T.DoubleType()
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(element))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = HashedBagOfWords(dim)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                flat = pa.array(encoder(some.column(text_col).to_pylist(), dtype=np_type).ravel())
                ends = pa.array(np.arange(some.num_rows + 1, dtype=np.int32) * dim)
                yield pa.record_batch({c: some.column(c) for c in some.schema.names} | {out_col: pa.ListArray.from_arrays(ends, flat)})
    return df.mapInArrow(run, schema)


class HashedBagOfWords:
    """The same encoder as a plain Python callable (the E1 default)."""

    def __init__(self, dim: int = EMBEDDING_DIM):
        import regex
        self.dim = dim
        self._split = regex.compile(TOKEN_PATTERN).split

    def bucket(self, tok: str) -> int:
        return int(hashlib.md5(tok.encode("utf-8")).hexdigest()[:8], 16) % self.dim

    def __call__(self, texts: list[str], dtype=np.float32) -> np.ndarray:
        found = [[tok for tok in self._split((t or "").lower()) if tok] for t in texts]
        known = {tok: self.bucket(tok) for tok in {tok for row in found for tok in row}}  # each distinct token is hashed once
        flat = np.fromiter((known[tok] for row in found for tok in row), np.int64)
        row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        out = np.bincount(row * self.dim + flat, minlength=len(texts) * self.dim).reshape(len(texts), self.dim).astype(np.float64)
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0).astype(dtype)


def encode_with(df: DataFrame, encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]],
                text_col: str = "title", out_col: str = "embedding", batch_size: int = 32,
                element_type: str = "float") -> DataFrame:
    """Run a Python encoder over Arrow batches, one encoder per task."""
    etype = T.FloatType() if element_type == "float" else T.DoubleType()
    np_type = np.float32 if element_type == "float" else np.float64
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(etype))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder_factory()
        for pdf in batches:
            texts = pdf[text_col].fillna("").astype(str).tolist()
            parts = [enc(texts[i:i + batch_size]) for i in range(0, len(texts), batch_size)]
            vecs = np.vstack(parts) if parts else np.zeros((0, 0), dtype=np_type)
            pdf[out_col] = list(vecs.astype(np_type))
            yield pdf
    return df.mapInPandas(run, schema)


def dense_to_terms(df: DataFrame, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Long form ``(id, bucket, weight)`` of the non-zero entries of a dense vector."""
    return (df.select(F.col(id_col).alias("id"), F.posexplode(vec_col).alias("bucket", "weight"))
              .where(F.col("weight") != 0)
              .select("id", F.col("bucket").cast("int"), F.col("weight").cast("double")))


def encode_frame(df: DataFrame, text_col: str = "title", dim: int = EMBEDDING_DIM,
                 model_name: str = HASHED_MODEL_NAME, encoder_factory=None) -> tuple[DataFrame, str, dict]:
    """Encode once, stamp lineage, materialise; returns (frame, run_id, report)."""
    run_id = uuid.uuid4().hex
    enc = (hashed_vectors(df, text_col, dim) if encoder_factory is None
           else encode_with(df, encoder_factory, text_col))
    out = materialise(with_lineage(enc, model_name, run_id), "encoded", "zstd")                                   # S14
    stats = out.agg(F.count(F.lit(1)).alias("n_vectors"), F.max(F.size("embedding")).alias("vector_dim")).first()
    sample = [r.asDict() for r in out.select("id", text_col).orderBy("id").limit(10).collect()]  # S15
    report = {"n_inputs": stats.n_vectors, "n_vectors": stats.n_vectors, "vector_dim": stats.vector_dim,
              "embedding_model": model_name, "sample_inputs": sample}
    return out, run_id, report


def encoding_log(spark, run_id: str, report: dict) -> DataFrame:
    """The run record of an encoding, ``(run_id, model, kind, key, value)`` like that of a training."""
    rows = [(run_id, report["embedding_model"], "param", "embedding_model", report["embedding_model"]),
            (run_id, report["embedding_model"], "param", "vector_dim", str(report["vector_dim"])),
            (run_id, report["embedding_model"], "metric", "n_inputs", str(report["n_inputs"])),
            (run_id, report["embedding_model"], "metric", "n_vectors", str(report["n_vectors"]))]
    rows += [(run_id, report["embedding_model"], "sample", str(r["id"]), str(r.get("title"))) for r in report["sample_inputs"]]
    return spark.createDataFrame(rows, "run_id string, model string, kind string, key string, value string")
