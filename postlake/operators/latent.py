"""A text encoder learnt from the corpus (E1, E2, K3): randomised factoring of its words' co-occurrence.

Texts that use different words for one thing share the words around them.
With A the TF-IDF matrix (one row a text, unit length), A'A tells how often
words stand together; without its diagonal, which would tell words apart that
replace each other, two words with the same company have the same rows.
``fit`` learns the ``dim`` leading eigenvectors of it and takes each word's row
in their terms as its vector, without forming A or A'A in one place:

* the vocabulary is the ``max_terms`` words that stand in most texts (two at
  least), counted by a native aggregate; only these reach the driver;
* the matrix is written once, a row a text, as (terms, weights);
* each round of subspace iteration is one pass over it: a task multiplies its
  rows with the basis (vocabulary x (dim + oversample) numbers, broadcast) and
  back, common words as a dense matrix and rare ones entry by entry, and the
  partial products are summed by blocks of words, in two steps, so neither a
  block nor the driver holds more than a fixed number of them;
* the driver keeps the basis orthogonal.  With 20,000 words and 400 columns it
  is 64 MB, whatever the number of texts.

A ``LatentEncoder`` is saved as a table, scores through ``encode_with`` like
any other encoder, and encodes a text as the unit vector of its projection; a
text without a known word has no direction.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.embed import TOKEN_PATTERN
from postlake.schemas import EMBEDDING_DIM
from postlake.session import materialise

BLOCK, WAYS = 256, 32
ROWS_AT_ONCE = 2048
ROWS_MULTIPLIED = 512
#: A word that stands in one of so many rows is multiplied as a dense column.
COMMON = 128

_split = regex.compile(TOKEN_PATTERN).split
#: All of ASCII but letters and digits becomes spaces; the bytes of other characters stay.
_ASCII_CUT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The lower-cased letter and digit runs of a text as UTF-8, in no order; only what isn't ASCII goes through the pattern."""
    found = text.lower().encode("utf-8", "replace").translate(_ASCII_CUT).split()
    if text.isascii():
        return found
    rest = b" ".join([w for w in found if not w.isascii()]).decode()
    return [w for w in found if w.isascii()] + [w.encode() for w in _split(rest) if w]


class _Rows:
    """TF-IDF rows of unit length over a vocabulary: (terms of all texts, their weights, terms of each text)."""

    def __init__(self, terms: list[str], idf: np.ndarray):
        self.place, self.idf = {t.encode(): k for k, t in enumerate(terms, 1)}, idf  # from 1: filter drops None and 0

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        get, n = self.place.get, max(1, len(self.place))
        found = [list(filter(None, map(get, words_of(t or "")))) for t in texts]
        row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        keys, tf = np.unique(row * n + np.fromiter(chain.from_iterable(found), np.int64, len(row)) - 1, return_counts=True)
        row, term = np.divmod(keys, n)
        weight = (1 + np.log(tf)) * self.idf[term]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(texts)))
        return term, weight / norm[row], np.bincount(row, minlength=len(texts))


def _add_runs(out: np.ndarray, where: np.ndarray, values: np.ndarray) -> None:
    """``out[where] += values``, where equal numbers in ``where`` stand together and all their values count."""
    if len(where):
        heads = np.flatnonzero(np.diff(where, prepend=-1))
        out[where[heads]] += np.add.reduceat(values, heads, axis=0)


@dataclass
class LatentEncoder:
    """Words with their idf and direction: all that encoding needs (vocabulary x dim numbers)."""
    terms: list[str]
    df: np.ndarray
    n_texts: int
    vectors: np.ndarray
    strengths: np.ndarray
    name: str = "latent"

    @property
    def dim(self) -> int:
        return self.vectors.shape[1]

    @property
    def idf(self) -> np.ndarray:
        return np.log((1 + self.n_texts) / (1 + self.df)) + 1

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if not hasattr(self, "_rows"):
            self._rows = _Rows(self.terms, self.idf)
        term, weight, count = self._rows(texts)
        out = np.zeros((len(texts), self.dim))
        _add_runs(out, np.repeat(np.arange(len(texts)), count), self.vectors[term] * weight[:, None])
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=np.zeros_like(out), where=norm > 1e-12).astype(np.float32)

    def factory(self, spark: SparkSession) -> Callable[[], LatentEncoder]:
        """What ``encode_with`` and ``encode_frame`` take; the model is broadcast once."""
        shared = spark.sparkContext.broadcast((self.terms, self.df, self.n_texts, self.vectors, self.strengths, self.name))
        return lambda: LatentEncoder(*shared.value)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(k, t, int(d), [float(x) for x in v]) for k, (t, d, v) in enumerate(zip(self.terms, self.df, self.vectors, strict=True))]
        spark.createDataFrame(rows, "number int, term string, n_docs long, vector array<double>").write.parquet(f"{path}/terms")
        spark.createDataFrame([(self.name, self.n_texts, [float(x) for x in self.strengths])],
                              "name string, n_texts long, strengths array<double>").write.parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LatentEncoder:
        meta = spark.read.parquet(f"{path}/meta").first()
        rows = sorted(spark.read.parquet(f"{path}/terms").collect())  # ``max_terms`` rows
        return LatentEncoder([r.term for r in rows], np.array([r.n_docs for r in rows], np.int64), meta.n_texts,
                             np.array([r.vector for r in rows]).reshape(len(rows), -1) if rows else np.zeros((0, len(meta.strengths))),
                             np.array(meta.strengths), meta.name)


def vocabulary(texts: DataFrame, text_col: str, max_terms: int, min_docs: int) -> DataFrame:
    """``(term, n_docs)`` of the words that stand in most texts; equal counts go to the smaller word."""
    words = F.split(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), TOKEN_PATTERN)
    found = texts.select(F.explode(F.array_distinct(words)).alias("term")).where("term <> ''")
    seen = found.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    return seen.where(F.col("n_docs") >= min_docs).orderBy(F.desc("n_docs"), "term").limit(max_terms)


def _matrix(shared, text_col: str):
    def run(batches):
        rows = _Rows(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                term, weight, count = rows(batch.column(text_col).slice(at, ROWS_AT_ONCE).to_pylist())
                cuts = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                yield pa.record_batch({"terms": pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                                       "weights": pa.ListArray.from_arrays(cuts, pa.array(weight))})
    return run


def _add_products(out: np.ndarray, basis: np.ndarray, term: np.ndarray, weight: np.ndarray, count: np.ndarray) -> None:
    """Adds A'(A Q) of some rows to ``out``: words that stand in many of them as a dense matrix, the others entry by entry."""
    row = np.repeat(np.arange(len(count)), count)
    common = np.bincount(term, minlength=len(basis)) * COMMON >= len(count)
    words, often = np.flatnonzero(common), common[term]
    dense = np.zeros((len(count), len(words)))
    dense[row[often], (np.cumsum(common) - 1)[term[often]]] = weight[often]
    row, term, weight = row[~often], term[~often], weight[~often, None]
    seen = dense @ basis[words]
    _add_runs(seen, row, basis[term] * weight)
    out[words] += dense.T @ seen
    order = np.argsort(term, kind="stable")
    _add_runs(out, term[order], seen[row[order]] * weight[order])


def _products(shared):
    """A task's share of A'(A Q), as blocks of words."""
    def run(batches):
        basis = shared.value
        out = np.zeros_like(basis)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_MULTIPLIED):
                some = batch.slice(at, ROWS_MULTIPLIED)
                count = np.diff(some.column("terms").offsets.to_numpy())
                term, weight = some.column("terms").flatten().to_numpy(), some.column("weights").flatten().to_numpy()
                _add_products(out, basis, term, weight, count)
        part = TaskContext.get().partitionId()
        for b in range(0, len(out), BLOCK):
            if out[b:b + BLOCK].any():
                yield pa.record_batch({"block": pa.array([b // BLOCK], pa.int32()), "way": pa.array([part % WAYS], pa.int32()),
                                       "sums": pa.array([out[b:b + BLOCK].tobytes()], pa.binary())})
    return run


def _summed(key, rows):
    total = None
    for blob in rows.column("sums"):
        some = np.frombuffer(blob.as_buffer())
        total = some.copy() if total is None else total + some
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "way": pa.array([0], pa.int32()),
                     "sums": pa.array([total.tobytes()], pa.binary())})


def _gram_times(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'(A Q) of the written matrix; the result, as large as the basis, is all that comes back."""
    shared = rows.sparkSession.sparkContext.broadcast(basis)
    kind = "block int, way int, sums binary"
    sums = rows.mapInArrow(_products(shared), kind).groupBy("block", "way").applyInArrow(_summed, kind)
    out = np.zeros_like(basis)
    for r in sums.groupBy("block").applyInArrow(_summed, kind).collect():
        at = r.block * BLOCK
        out[at:at + BLOCK] = np.frombuffer(r.sums).reshape(-1, basis.shape[1])
    shared.unpersist()
    return out


def fit(texts: DataFrame, text_col: str = "title", dim: int = EMBEDDING_DIM, max_terms: int = 20_000, min_docs: int = 2,
        oversample: int = 16, rounds: int = 4, seed: int = 42) -> LatentEncoder:
    """Learn an encoder of ``dim`` directions (fewer if the vocabulary is smaller) from all ``texts``.

    Null and empty texts count as texts without words.  Without any word in
    ``min_docs`` texts the encoder has no words and every vector is zero.
    """
    spark = texts.sparkSession
    texts = materialise(texts.select(F.col(text_col).cast("string").alias("text")), "latent-texts")
    n = texts.count()
    words = vocabulary(texts, "text", max_terms, min_docs).collect()  # bounded by max_terms
    terms, df = [r.term for r in words], np.array([r.n_docs for r in words], np.int64)
    name = f"latent-{uuid.uuid4().hex[:8]}"
    if not terms:
        return LatentEncoder([], df, n, np.zeros((0, dim)), np.zeros(dim), name)
    idf = np.log((1 + n) / (1 + df)) + 1
    rows = materialise(texts.mapInArrow(_matrix(spark.sparkContext.broadcast((terms, idf)), "text"),
                                        "terms array<int>, weights array<double>"), "latent-matrix")
    width = min(len(terms), dim + oversample)
    own = np.zeros(len(terms))  # the diagonal: a number a word
    pairs = rows.select(F.inline(F.arrays_zip("terms", "weights"))).groupBy("terms").agg(F.sum(F.col("weights") * F.col("weights")).alias("w"))
    for r in pairs.collect():
        own[r.terms] = r.w

    def company(basis):
        return _gram_times(rows, basis) - own[:, None] * basis

    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(terms), width)))
    for _ in range(rounds):
        basis, _ = np.linalg.qr(company(basis))
    small = basis.T @ company(basis)
    values, turned = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-np.abs(values))[:min(dim, width)]
    vectors = basis @ turned[:, best]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])  # a direction's sign is free: the largest entry is positive
    return LatentEncoder(terms, df, n, vectors * values[best], values[best], name)
