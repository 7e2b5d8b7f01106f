"""The feature encoder: numbering without the driver, sparse vectors, persistence, tuning; learners find a planted signal."""

import subprocess
import sys

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from conftest import ROOT
from postlake import schemas
from postlake.operators.metrics import evaluate
from postlake.operators.model import boosted_trees, fit, random_forest
from postlake.operators.preprocess import FeatureEncoder, FeatureEncoderModel, dense_index
from postlake.session import materialise

NUMBERS = list(schemas.NUMERIC_FEATURES)


def test_dense_index_matches_a_plain_numbering(spark):
    rows = [("a", "x"), ("a", "b"), ("b", "é"), ("b", "z"), ("a", "x"), ("b", None), ("a", ""), ("c", "\U0001f600"), ("b", "Z")] + [
        ("d", f"k{k % 50}") for k in range(300)]
    df = spark.createDataFrame(rows, "g string, v string").repartition(5)
    want = {(g, v): i for g in {g for g, _ in rows}
            for i, v in enumerate(sorted({v for h, v in rows if h == g and v is not None}, key=str.encode))}
    for partitions in (1, 3, 9):
        assert {(r.g, r.v): r["index"] for r in dense_index(df, "g", "v", partitions).collect()} == want
    assert dense_index(df.where("false"), "g", "v").count() == 0


def frame(spark, n=1200, signal=True):
    """Rows whose target follows author and hour (or, without signal, the id's hash)."""
    noise = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(100))
    df = (spark.range(n).withColumn("by_author", F.concat(F.lit("a"), F.pmod(F.xxhash64("id"), F.lit(12))))
          .withColumn("domain", F.concat(F.lit("d"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9))))
          .withColumns({c: F.pmod(F.xxhash64("id", F.lit(k + 2)), F.lit(24)).cast("int") for k, c in enumerate(NUMBERS)}))
    good = F.col("by_author").isin("a1", "a4", "a7", "a10") & (F.col("hour") < 14) | (F.col("hour") > 19)
    target = F.when(noise < 3, ~good).otherwise(good) if signal else noise < 30
    return df.withColumn(schemas.TARGET, target.cast("int"))


@pytest.mark.parametrize("name, made", [("random_forest", lambda: random_forest(num_trees=60, max_depth=10)),
                                        ("boosted_trees", lambda: boosted_trees(max_iter=40))])
def test_learners_find_a_planted_signal(spark, name, made):
    data = materialise(frame(spark), "planted")
    test = F.pmod(F.xxhash64("id", F.lit(99)), F.lit(4)) == 0
    scored = fit(name, made(), data.where(~test)).score(data.where(test))
    r = evaluate(scored.select(F.lit(name).alias("model"), F.col(schemas.TARGET).alias("y"), F.col("probability").alias("p"))).first()
    assert r.roc_auc >= 0.9


def test_encoder_vectors_hold_scaled_numbers_and_one_column_a_category(spark):
    data = materialise(frame(spark, 300), "enc")
    m = FeatureEncoder(minFrequency=25).fit(data)
    out = m.transform(data).collect()
    labels = {(r.feature, r["index"]): r.label for r in m.columns().collect()}
    counts = {c: {r[c]: r["count"] for r in data.groupBy(c).count().collect()} for c in schemas.CATEGORICAL_FEATURES}
    assert {c: m.widths[c] for c in counts} == {c: sum(n >= 25 for n in v.values()) + any(n < 25 for n in v.values()) for c, v in counts.items()}
    for r in out:
        at = dict(zip(r.features.indices.tolist(), r.features.values.tolist()))
        assert len(at) == len(NUMBERS) + 2 and r.features.size == len(NUMBERS) + sum(m.widths.values())
        for c in schemas.CATEGORICAL_FEATURES:
            wanted = r[c] if counts[c][r[c]] >= 25 else "__rare__"
            assert labels[c, r[c + "_idx"]] == wanted and at[m.offset(c) + r[c + "_idx"]] == 1.0
    mean = sum(r[NUMBERS[0]] for r in out) / len(out)
    std = (sum((r[NUMBERS[0]] - mean) ** 2 for r in out) / len(out)) ** 0.5
    assert all(abs(r.features[0] - (r[NUMBERS[0]] - mean) / std) < 1e-9 for r in out)


def test_nulls_and_clashing_columns(spark):
    data = frame(spark, 200).withColumn("domain", F.when(F.col("id") % 3 > 0, F.col("domain"))).withColumn("features", F.lit("clash"))
    m = FeatureEncoder().fit(data)
    rows = m.transform(data.withColumn("by_author", F.lit(None).cast("string"))).collect()
    assert all(len(r.features.indices) == len(NUMBERS) + (r.domain is not None) for r in rows)
    assert m.transform(data.where("false")).count() == 0


def test_one_pipeline_saves_loads_and_tunes(spark, workdir):
    data = materialise(frame(spark, 400), "tune")
    forest = random_forest(num_trees=5, max_depth=3)
    whole = Pipeline(stages=[FeatureEncoder(minFrequency=3), forest])
    fitted = whole.fit(data)
    fitted.write().save(f"{workdir}/whole")
    again = PipelineModel.load(f"{workdir}/whole")
    assert isinstance(again.stages[0], FeatureEncoderModel) and again.stages[0].getOrDefault("minFrequency") == 3
    p = lambda m: {r.id: r.probability for r in m.transform(data).select("id", "probability").collect()}
    assert p(fitted) == p(again)
    whole.write().save(f"{workdir}/unfitted")
    assert Pipeline.load(f"{workdir}/unfitted").getStages()[0].getOrDefault("minFrequency") == 3
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [1, 6]).build()
    tuned = CrossValidator(estimator=whole, estimatorParamMaps=grid, numFolds=2, seed=1,
                           evaluator=BinaryClassificationEvaluator(labelCol=schemas.TARGET)).fit(data)
    assert tuned.avgMetrics[1] > tuned.avgMetrics[0]


MILLION = """
import sys
sys.path.insert(0, {root!r})
from postlake.session import build_session
from postlake import schemas
from postlake.operators.preprocess import FeatureEncoder
from pyspark.sql import functions as F
spark = build_session("local[4]", 4, extra={{"spark.driver.maxResultSize": "2m", "spark.driver.memory": "1g",
                                                          "spark.sql.autoBroadcastJoinThreshold": "200k"}})
df = spark.range(1000000).withColumns({{c: F.lit(1) for c in schemas.NUMERIC_FEATURES}})
df = df.withColumn("by_author", F.concat(F.lit("author-"), "id")).withColumn("domain", F.lit("one"))
m = FeatureEncoder(minFrequency=1).fit(df)
assert m.widths["by_author"] == 1000000, m.widths
at = F.unwrap_udt("features")
out = m.transform(df).select(at["size"].alias("size"), F.element_at(at["indices"], -1).alias("i"), F.size(at["indices"]).alias("n"),
                             F.col("by_author_idx").alias("k"))
r = out.agg(F.min("size"), F.max("size"), F.min("n"), F.max("n"), F.count_distinct("k"), F.max("k")).first()
assert tuple(r) == (1000007, 1000007, 8, 8, 1000000, 999999), r
print("whole")
"""


def test_a_million_categories_need_no_room_on_the_driver():
    """Results of more than 2 MB may not reach the driver; a million labels are 20 MB."""
    done = subprocess.run([sys.executable, "-c", MILLION.format(root=ROOT)], capture_output=True, text=True, timeout=600)
    assert "whole" in done.stdout, done.stderr[-3000:]
