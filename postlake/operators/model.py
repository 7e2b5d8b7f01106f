"""Training, evaluation, persistence and scoring (M1..M10) with MLlib.

One fitted unit = a ``PipelineModel`` of the feature encoder (see
``preprocess``: vocabulary with rare values grouped, column indices, scaling,
all fitted on the train split and kept as tables) and the classifier.  Unseen
categories encode as all zeros, rare ones share a column, vectors stay sparse
and no list of categories passes through the driver.

Tree learners seed their sampling by partition, so the training rows are
dealt by a hash of the id into ``partitions`` partitions, a parameter or a
function of the number of rows alone, and sorted in them: the same data gives
the same model on any cluster.

``train_and_select`` fits every candidate on the same persisted train split,
scores the test split once per candidate, evaluates all of them in one
grouped pass and keeps the real argmax of ROC AUC (ties: first candidate).
Only one metrics row per model reaches the driver.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import schemas
from postlake.functions import (domain, ends_with_question, has_url, title_length, to_class, word_count)
from postlake.operators.metrics import champion, evaluate, metrics_long
from postlake.operators.preprocess import FeatureEncoder, FeatureEncoderModel
from postlake.operators.quality import gate_min_rows, gate_two_classes
from postlake.operators.split import stratified_split
from postlake.operators.trees import BoostedClassifier, ForestClassifier
from postlake.session import materialise
from postlake.sources.lake import latest_version, resolve_first, versions, write_marker

MIN_FREQUENCY = 5


def train_partitions(n: int) -> int:
    """By the number of train rows alone: up to 8 of 1,000 rows at least, then one for each 100,000."""
    return max(1, min(8, math.ceil(n / 1_000)), math.ceil(n / 100_000))


def random_forest(seed: int = 42, num_trees: int = 200, max_depth: int = 12):
    """M5."""
    return ForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=seed, labelCol=schemas.TARGET, featuresCol="features")


def boosted_trees(seed: int = 42, max_iter: int = 300, max_depth: int = 6, step: float = 0.1,
                  subsample: float = 0.9, col_sample: float = 0.9):
    """M6: logistic-loss boosting; column sampling is per node (per tree elsewhere)."""
    return BoostedClassifier(maxIter=max_iter, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                             featureSubsetStrategy=str(col_sample), seed=seed, lossType="logistic",
                             labelCol=schemas.TARGET, featuresCol="features", checkpointInterval=10)


def default_candidates(seed: int = 42) -> list[tuple[str, object]]:
    return [("random_forest", random_forest(seed)), ("boosted_trees", boosted_trees(seed))]


@dataclass
class FittedModel:
    """M4: encoder and classifier as one pipeline, fitted on the train split only."""
    name: str
    pipeline: PipelineModel
    stage: str = "candidate"

    @property
    def encoder(self) -> FeatureEncoderModel:
        return self.pipeline.stages[0]

    def encoded(self, features: DataFrame) -> DataFrame:
        """M2, M3: the given columns, the index of each category and the classifier's input vector."""
        return self.encoder.transform(features)

    def score(self, features: DataFrame, threshold: float = 0.5) -> DataFrame:
        """``probability`` of the positive class, ``prediction`` (p >= 0.5) and the model's identity."""
        out = self.pipeline.transform(features)
        p = vector_to_array("probability")[1]
        return (out.select(*[F.col(f"`{c}`") for c in features.columns], p.alias("probability"))
                .withColumn("prediction", to_class("probability", threshold))
                .withColumns({"model_name": F.lit(self.name), "model_stage": F.lit(self.stage)}))

    def save(self, root: str, stage: str | None = None) -> str:
        """M8: ``<root>/<stage or name>/v=<n>`` holding the ``pipeline`` and the model's name."""
        spark = SparkSession.active()
        base = f"{root}/{stage or self.name}"
        existing = versions(spark, base, complete_only=False)
        path = f"{base}/v={(existing[-1] + 1) if existing else 1}"
        spark.createDataFrame([(self.name, stage or self.stage)], "name string, stage string").write.parquet(f"{path}/meta")
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        write_marker(spark, path)
        return path


def load_model(spark: SparkSession, path: str) -> FittedModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    return FittedModel(meta.name, PipelineModel.load(f"{path}/pipeline"), meta.stage)


def load_preferred(spark: SparkSession, root: str, preference: list[str]) -> FittedModel:
    """The newest complete version of the first name in ``preference``
    that has one (e.g. champion, then any candidate)."""
    found = resolve_first(spark, [f"{root}/{name}" for name in preference])
    if found is None:
        raise FileNotFoundError(f"no model under {root} for {preference}")
    return load_model(spark, f"{found}/v={latest_version(spark, found)}")


def fit(name: str, classifier, train: DataFrame, partitions: int | None = None) -> FittedModel:
    """M4: the encoder, then the classifier, on the train split only.

    ``partitions`` sets the parallelism of the fit and, with the data and the
    seed, the model; unless given it follows from the number of train rows.
    """
    train = materialise(train.select("id", schemas.TARGET, *schemas.FEATURE_COLUMNS), "train")
    encoder = FeatureEncoder(minFrequency=MIN_FREQUENCY, outputCol="features").fit(train)
    partitions = partitions or train_partitions(train.count())
    x = (encoder.transform(train).select("id", schemas.TARGET, "features").repartition(partitions, "id")
         .sortWithinPartitions("id", schemas.TARGET).cache())
    model = FittedModel(name, PipelineModel([encoder, classifier.fit(x)]))
    x.unpersist()
    return model


def _between(low: int, high: int):
    return lambda i: (i >= low) & (i < high)


def active_categories(model: FittedModel, features: DataFrame) -> DataFrame:
    """``(id, feature, active)``, the label of the column that is set in the feature's block of the vector, or null."""
    encoder = model.encoder
    at = F.unwrap_udt("features")["indices"]
    pairs = []
    for f in schemas.CATEGORICAL_FEATURES:
        low, high = encoder.offset(f), encoder.offset(f) + encoder.widths[f]
        mine = F.filter("_at", _between(low, high))
        pairs.append(F.struct(F.lit(f).alias("feature"), (F.get(mine, F.lit(0)) - low).alias("index")))
    found = model.encoded(features).select("id", at.alias("_at")).select("id", F.inline(F.array(*pairs)))
    return found.join(encoder.columns(), ["feature", "index"], "left").select("id", "feature", F.col("label").alias("active"))


def primitive_params(estimator) -> dict[str, str]:
    """Only primitive-valued parameters are recorded."""
    out = {}
    for p, v in estimator.extractParamMap().items():
        if isinstance(v, (int, float, str, bool)) or v is None:
            out[f"clf__{p.name}"] = json.dumps(v)
    return out


def run_log_rows(spark: SparkSession, run_id: str, name: str, estimator, metrics: DataFrame) -> DataFrame:
    """``(run_id, model, kind, key, value)``."""
    params = [(run_id, name, "param", k, v) for k, v in sorted(primitive_params(estimator).items())]
    params.append((run_id, name, "tag", "modelo", name))
    p = spark.createDataFrame(params, "run_id string, model string, kind string, key string, value string")
    m = (metrics_long(metrics.where(F.col("model") == name))
         .select(F.lit(run_id).alias("run_id"), "model", F.lit("metric").alias("kind"),
                 F.col("metric").alias("key"), F.col("value").cast("string").alias("value")))
    return p.unionByName(m)


def train_and_select(features: DataFrame, workdir: str, candidates=None, seed: int = 42,
                     test_fraction: float = 0.2, partitions: int | None = None) -> dict:
    """M1 + M4..M10: gates, split, fit all, evaluate in one pass, keep the
    argmax, persist it, append the run log.  Returns a small summary."""
    spark = features.sparkSession
    gate_two_classes(gate_min_rows(features))                                     # P11, P12
    # the split takes along what the models read, not the texts
    narrow = features.select("id", schemas.TARGET, *schemas.FEATURE_COLUMNS)
    data = materialise(stratified_split(narrow, schemas.TARGET, "id", test_fraction, seed), "split")
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    candidates = candidates or default_candidates(seed)
    fitted, scored = [], None
    for name, est in candidates:
        m = fit(name, est, train, partitions)
        s = m.score(test).select(F.lit(name).alias("model"), F.col(schemas.TARGET).alias("y"),
                                 F.col("probability").alias("p"))
        fitted.append((name, est, m))
        scored = s if scored is None else scored.unionByName(s)
    metrics = materialise(evaluate(scored), "metrics")
    order = [n for n, _ in candidates]
    win = champion(metrics, order).first()
    run_id = uuid.uuid4().hex
    log = None
    for name, est, _ in fitted:
        rows = run_log_rows(spark, run_id, name, est, metrics)
        log = rows if log is None else log.unionByName(rows)
    log.write.mode("append").parquet(f"{workdir}/runs")
    best = next(m for n, _, m in fitted if n == win.champion)
    path = best.save(f"{workdir}/models", "champion")
    return {"run_id": run_id, "champion": win.champion, "roc_auc": win.roc_auc, "model_path": path,
            "metrics": {r["model"]: r.asDict() for r in metrics.collect()}, "n_test": test.count()}


def request_features(requests: DataFrame) -> DataFrame:
    """M9: features of prediction requests (hour and weekday come with the
    request); the question flag uses the training rule, not the serving one."""
    return requests.select(
        "*",
        title_length("title").alias("title_len"),
        word_count("title").alias("n_words_title"),
        has_url("url").alias("has_url"),
        ends_with_question("title").alias("has_question"),
        domain("url").alias("domain"),
    ).withColumn("by_author", F.coalesce("by_author", F.lit("unknown")))
