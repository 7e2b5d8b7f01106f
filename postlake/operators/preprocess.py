"""Preprocessing as one MLlib estimator.

``FeatureEncoder`` learns, from the train split alone, the category
vocabulary (rare values share a column), an index for every column and the
mean and population std of the numbers.  ``FeatureEncoderModel`` is a
transformer with ML persistence, so that encoder and classifier save, load,
tune and score as one ``PipelineModel``.

Nothing that grows with the categories passes through the driver: columns are
numbered by a distributed dense ranking (sorted ranges, a count for each
range, an offset for each), the numbers are joined to the rows, and every
row's sparse vector is put together from its few indices in Arrow batches.
Only the number of columns of each feature, and one mean and std for each
number, are read there.  Vectors carry no attribute metadata, which would
name every column.

The vector has the scaled numbers first, then one block of columns for each
category.  An unseen or null category has no column in its block.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake import schemas
from postlake.operators.encoding import apply_vocabulary, category_vocabulary, standard_stats, standardize
from postlake.session import materialise, shuffle_partitions

IDX_SUFFIX = "_idx"


def dense_index(labels: DataFrame, group: str, value: str, partitions: int | None = None) -> DataFrame:
    """``(group, value, index)``: distinct values of each group numbered from 0 in ascending order.

    Values are dealt by range and sorted in their range; a value's number is
    its place in the range and the values of the group in all ranges before.
    The only gathered table has one row for each group and range.
    """
    distinct = labels.select(group, value).where(F.col(value).isNotNull()).distinct()
    ranges = distinct.repartitionByRange(partitions or shuffle_partitions(labels.sparkSession), group, value)
    placed = materialise(ranges.sortWithinPartitions(group, value).withColumn("_at", F.monotonically_increasing_id())
                         .withColumn("_range", F.shiftright("_at", 33)), "dense-index")
    runs = placed.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (placed.join(F.broadcast(runs), [group, "_range"])  # groups x ranges rows
            .select(group, value, (F.col("_offset") + F.col("_at") - F.col("_first")).cast("int").alias("index")))


def indexed_vocabulary(train: DataFrame, cols: list[str], min_frequency: int) -> DataFrame:
    """A3, M2: ``(feature, category, n, mapped, index)``; rare values share their column's index."""
    vocab = materialise(category_vocabulary(train, cols, min_frequency), "vocab")
    # the rare values, which may be most of the table, share one label: they get its index without a join on it
    from postlake.operators.encoding import RARE
    labels = dense_index(vocab, "feature", "mapped")
    rare = F.broadcast(labels.where(F.col("mapped") == RARE).select("feature", F.col("index").alias("_rare")))  # a row a feature
    own = labels.where(F.col("mapped") != RARE)
    return (vocab.withColumn("_own", F.when(F.col("mapped") != RARE, F.col("mapped")))
            .join(own.select("feature", F.col("mapped").alias("_own"), "index"), ["feature", "_own"], "left")
            .join(rare, "feature", "left")
            .select("feature", "category", "n", "mapped", F.coalesce("index", F.when(F.col("mapped") == RARE, F.col("_rare"))).alias("index")))


class _EncoderParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "columns to scale", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns to one-hot encode", TypeConverters.toListString)
    minFrequency = Param(Params._dummy(), "minFrequency", "rows a value needs for a column of its own", TypeConverters.toInt)
    outputCol = Param(Params._dummy(), "outputCol", "the vector", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=list(schemas.NUMERIC_FEATURES), categoricalCols=list(schemas.CATEGORICAL_FEATURES),
                         minFrequency=5, outputCol="features")


class FeatureEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """M2, M3, M4: fits vocabulary, indices and number statistics."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, minFrequency=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FeatureEncoderModel:
        cats, numbers = self.getOrDefault("categoricalCols"), self.getOrDefault("numericCols")
        train = materialise(dataset.select(*numbers, *cats), "encoder-input")
        vocab = materialise(indexed_vocabulary(train, cats, self.getOrDefault("minFrequency")), "encoder-vocab")
        stats = materialise(standard_stats(train, numbers), "encoder-stats")
        return self._copyValues(FeatureEncoderModel(vocab, stats))


class FeatureEncoderModel(Model, _EncoderParams, MLReadable, MLWritable):
    """The fitted encoder: adds the vector and, for each category, its ``<column>_idx`` (null where it has none)."""

    def __init__(self, vocab: DataFrame | None = None, stats: DataFrame | None = None):
        super().__init__()
        self.vocab, self.stats = vocab, stats
        self._widths: dict[str, int] | None = None

    @property
    def widths(self) -> dict[str, int]:
        """The number of columns of each category: one number a feature is read."""
        if self._widths is None:
            found = {r.feature: r.n for r in self.vocab.groupBy("feature").agg((F.max("index") + 1).alias("n")).collect()}
            self._widths = {c: int(found.get(c) or 0) for c in self.getOrDefault("categoricalCols")}
        return self._widths

    def columns(self) -> DataFrame:
        """M2: ``(feature, index, label)``, one row per one-hot column."""
        return self.vocab.where(F.col("index").isNotNull()).select("feature", "index", F.col("mapped").alias("label")).distinct()

    def offset(self, column: str) -> int:
        """Where a category's block starts in the vector."""
        cats = self.getOrDefault("categoricalCols")
        return len(self.getOrDefault("numericCols")) + sum(self.widths[c] for c in cats[:cats.index(column)])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cats, numbers = self.getOrDefault("categoricalCols"), self.getOrDefault("numericCols")
        out = self.getOrDefault("outputCol")
        kept = [F.col(f"`{c}`") for c in dataset.columns if c != out and c not in {x + IDX_SUFFIX for x in cats}]
        x = apply_vocabulary(dataset.select(*kept), self.vocab, cats, IDX_SUFFIX, value="index")
        x = x.withColumns({f"_scaled_{c}": F.col(c) for c in numbers})
        scaled = standardize(x, self.stats.withColumn("feature", F.concat(F.lit("_scaled_"), "feature")), [f"_scaled_{c}" for c in numbers])
        at = [F.col(c + IDX_SUFFIX) + F.lit(self.offset(c)) for c in cats]
        size = len(numbers) + sum(self.widths.values())
        vector = _assembled(len(numbers), len(cats), size)(*[F.col(f"_scaled_{c}").cast("double") for c in numbers], *[a.cast("int") for a in at])
        return scaled.withColumn(out, vector).drop(*[f"_scaled_{c}" for c in numbers])

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


def _assembled(n_numbers: int, n_cats: int, size: int):
    """A function of Arrow batches: numbers and active indices to sparse vectors."""
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    def assemble(*columns: pa.Array) -> pa.Array:
        import numpy as np

        n = len(columns[0])
        values = np.zeros((n, n_numbers + n_cats))
        index = np.zeros((n, n_numbers + n_cats), np.int32)
        there = np.ones((n, n_numbers + n_cats), bool)
        for k, c in enumerate(columns):
            if k < n_numbers:
                values[:, k], index[:, k] = c.fill_null(0.0).to_numpy(zero_copy_only=False), k
            else:
                values[:, k], there[:, k] = 1.0, c.is_valid().to_numpy(zero_copy_only=False)
                index[:, k] = c.fill_null(0).to_numpy(zero_copy_only=False)
        cuts = pa.array(np.concatenate([[0], np.cumsum(there.sum(1))]).astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)),
             pa.ListArray.from_arrays(cuts, pa.array(index[there])), pa.ListArray.from_arrays(cuts, pa.array(values[there]))],
            ["type", "size", "indices", "values"])

    # set rather than written: annotations here are strings, which the decorator can't resolve
    assemble.__annotations__ = {"columns": pa.Array, "return": pa.Array}
    return arrow_udf(assemble, VectorUDT())


class _EncoderWriter(MLWriter):
    def __init__(self, instance: FeatureEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.vocab.write.parquet(f"{path}/vocab")
        self.instance.stats.write.parquet(f"{path}/stats")


class _EncoderReader(MLReader):
    def load(self, path: str) -> FeatureEncoderModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = FeatureEncoderModel(spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/stats"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
