"""The sparse tree learners: MLlib's trees on narrow rows, a million columns without dense rows, odd input."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from postlake import schemas
from postlake.operators.model import boosted_trees, random_forest
from postlake.operators.trees import BoostedClassifier, ForestClassifier, _subset, _thresholds


def rows(n, size, seed=0):
    """Sparse rows: two numbers (one sometimes zero), one column of a block of ``size`` or none, a noisy target."""
    r = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        a, b, c = float(r.integers(20)) - 7.5, float(r.integers(4)), int(r.integers(size + 1))
        y = int((a > 3) ^ (c % 3 == 0) ^ (b > 2 and a < 0)) if r.random() > 0.1 else int(r.integers(2))
        at = [(0, a), (1, b)] + ([(2 + c, 1.0)] if c < size else [])
        out.append((Vectors.sparse(2 + size, [x for x in at if x[1]]), y))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, ["features", schemas.TARGET]).coalesce(2)


def probabilities(model, df):
    return np.array([r.probability.toArray()[1] for r in model.transform(df).select("probability").collect()])


def test_trees_are_those_of_mllib(spark):
    df = frame(spark, rows(900, 12)).cache()
    said = dict(labelCol=schemas.TARGET, seed=3)
    pairs = [(RandomForestClassifier(numTrees=1, maxDepth=5, **said), ForestClassifier(numTrees=1, maxDepth=5, **said)),
             (GBTClassifier(maxIter=4, maxDepth=3, stepSize=0.3, **said), BoostedClassifier(maxIter=4, maxDepth=3, stepSize=0.3, **said))]
    for e in pairs[0]:
        e.set(e.bootstrap, False)
    for theirs, ours in pairs:
        want, got = probabilities(theirs.fit(df), df), probabilities(ours.fit(df), df)
        assert len(set(want.round(9))) > 5 and np.allclose(want, got, atol=1e-9)
    df.unpersist()


@pytest.mark.parametrize("learner", [random_forest(num_trees=1, max_depth=2), random_forest(num_trees=4, max_depth=3),
                                     boosted_trees(max_iter=2, max_depth=2)])
def test_a_million_columns_cost_no_dense_rows(spark, learner):
    """3,000 dense rows of two million bins would be 24 GB."""
    size = 2_000_000
    r = np.random.default_rng(1)
    data = [(Vectors.sparse(size, sorted({0: float(k % 30), 5 + int(r.integers(size - 5)): 1.0}.items())), int(k % 30 > 11)) for k in range(3000)]
    df, held = frame(spark, data), set(spark.sparkContext._jsc.getPersistentRDDs())
    model = learner.fit(df)
    if learner.getOrDefault("featureSubsetStrategy") == "auto" and len(model.trees) > 1:
        assert all(len(t.column) >= 1 for t in model.trees)  # a node draws 1,415 of the columns
    else:
        assert all(((p > 0.5) == (k % 30 > 11)) for k, p in enumerate(probabilities(model, df)))
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held


def test_dense_vectors_margins_and_checkpoints(spark):
    """Dense rows split as sparse ones; margins written every two rounds give the trees of margins kept."""
    df = frame(spark, rows(500, 6))
    dense = df.withColumn("features", F.udf(lambda v: Vectors.dense(v.toArray()), VectorUDT())("features"))
    often, never = (BoostedClassifier(maxIter=7, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="0.7", seed=5,
                                      labelCol=schemas.TARGET, checkpointInterval=c) for c in (2, 50))
    p = probabilities(never.fit(df), df)
    assert np.allclose(probabilities(often.fit(df), df), p, atol=1e-12)
    assert np.allclose(probabilities(never.fit(dense), dense), p, atol=1e-12)


def test_labels_subsets_and_thresholds(spark):
    with pytest.raises(ValueError):
        ForestClassifier(labelCol=schemas.TARGET).fit(frame(spark, [(Vectors.dense([1.0]), 2)]))
    one = ForestClassifier(numTrees=3, labelCol=schemas.TARGET).fit(frame(spark, [(Vectors.dense([1.0, 0.0]), 1)] * 5))
    assert set(probabilities(one, frame(spark, [(Vectors.dense([9.0, 9.0]), 0)]))) == {1.0}
    assert [_subset(s, 100, 2) for s in ("auto", "all", "sqrt", "log2", "onethird", "0.9", "7")] == [10, 100, 10, 7, 34, 90, 7]
    assert _subset("auto", 100, 1) == 100
    assert _thresholds(np.array([1.0, 2.0, 4.0]), np.array([1, 1, 9]), 32).tolist() == [1.5, 3.0]
    cuts = _thresholds(np.arange(1000.0), np.ones(1000, int), 32)
    assert len(cuts) == 31 and np.ptp(np.diff(cuts)) <= 1


def test_a_level_walks_only_what_is_new(monkeypatch):
    """a worker that kept a block's margins and nodes takes one step; one without them comes to the same numbers."""
    from postlake.operators import trees
    r = np.random.default_rng(2)
    block = trees.Block((0, 0), r.integers(0, 8, (60, 2)).astype(np.uint8), np.full((60, 1), -1, np.int32), r.integers(0, 2, 60).astype(float))
    layout = trees.Layout(2, np.array([0, 1]), [np.arange(7.0)] * 2)
    i = lambda *x: np.array(x, np.int32)
    grown = [trees.Tree(n, i(0, -1, -1), i(n, 0, 0), i(1, 0, 0), np.array([60.0, 30, 30]), np.array([30.0, 10 + n, 20])) for n in range(4)]
    walked, plain = [], trees.descend
    monkeypatch.setattr(trees, "descend", lambda *a: walked.append((a[2].number, a[4] is not None)) or plain(*a))
    monkeypatch.setattr(trees, "_HELD", trees.OrderedDict())
    recent = [(t, 0.1) for t in grown]
    for n in range(1, 5):
        got = trees._Residuals(1, 0.9, recent[:n], 0, "a").margin(block, layout)
    assert walked == [(n, False) for n in range(4)]  # each tree once
    bigger = trees.Tree(3, i(0, 1, -1, -1, -1), i(3, 2, 0, 0, 0), i(1, 3, 0, 0, 0), np.ones(5), np.arange(5.0))
    step = trees._Residuals(1, 0.9, recent[:3], 0, "a").nodes(block, bigger, layout)
    assert walked[-1] == (3, True) and (step == plain(block.bins, block.ones, bigger, layout.place)).all()
    fresh = sum(0.1 * t.value[plain(block.bins, block.ones, t, layout.place)] for t in grown)
    held = trees.Block(block.at, block.bins, block.ones, block.y, trees._Residuals(1, 0.9, recent[:2], 0, "b").margin(block, layout))
    assert len(trees._HELD) == 1 and np.allclose(got, fresh, atol=1e-12)  # one fit at a time
    assert (trees._Residuals(1, 0.9, recent[2:], 2, "c").margin(held, layout) == got).all()
    w, y = trees._Residuals(1, 0.9, recent, 0, "d")(block, 4, layout)
    assert (y == 4 * (2 * block.y - 1) / (1 + np.exp(2 * (2 * block.y - 1) * got))).all() and set(w) <= {0.0, 1.0}
