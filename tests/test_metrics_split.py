import math

from pyspark.sql import functions as F

from postlake.operators.metrics import champion, evaluate
from postlake.operators.split import stratified_split


def brute(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, P = 0.0, len(pos)
    for t in sorted(set(p), reverse=True):
        sel = [yi for yi, pi in zip(y, p) if pi >= t]
        tp_here = sum(yi for yi, pi in zip(y, p) if pi == t)
        ap += tp_here / P * sum(sel) / len(sel)
    return auc, ap


def test_auc_ap_f1_accuracy(spark):
    y = [1, 0, 1, 0, 0, 1, 0, 0]
    p = [0.9, 0.8, 0.8, 0.3, 0.5, 0.1, 0.5, 0.2]
    df = spark.createDataFrame([("m", a, b) for a, b in zip(y, p)], "model string, y int, p double")
    r = evaluate(df).first()
    auc, ap = brute(y, p)
    assert math.isclose(r.roc_auc, auc) and math.isclose(r.pr_auc, ap)
    pred = [int(x >= 0.5) for x in p]
    tp = sum(a and b for a, b in zip(y, pred))
    fp = sum((not a) and b for a, b in zip(y, pred))
    fn = sum(a and (not b) for a, b in zip(y, pred))
    assert math.isclose(r.f1, 2 * tp / (2 * tp + fp + fn))
    assert math.isclose(r.accuracy, sum(a == b for a, b in zip(y, pred)) / len(y))


def test_f1_zero_and_champion_tie(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 0, 0.2), ("b", 1, 0.1), ("b", 0, 0.2)],
                               "model string, y int, p double")
    m = evaluate(df)
    assert {r.model: r.f1 for r in m.collect()} == {"a": 0.0, "b": 0.0}
    assert champion(m, ["b", "a"]).first().champion == "b"
    assert champion(m, ["a", "b"]).first().champion == "a"


def test_split_exact_disjoint_deterministic(spark):
    df = spark.range(0, 5003).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    s1 = stratified_split(df, "y")
    s2 = stratified_split(df.repartition(3), "y")
    assert sorted(s1.collect()) == sorted(s2.collect())
    counts = {(r.y, r.split): r["count"] for r in s1.groupBy("y", "split").count().collect()}
    for cls in (0, 1):
        n = counts[(cls, "train")] + counts[(cls, "test")]
        assert counts[(cls, "test")] == math.ceil(0.2 * n)
    assert s1.count() == 5003 and s1.select("id").distinct().count() == 5003
