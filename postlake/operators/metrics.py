"""Binary-classification metrics as DataFrame aggregates (A1, A2, A5..A9, A11, M7).

Input: a scored frame ``(model, y, p)`` with ``y`` in {0, 1} and ``p`` the
positive-class score.  All candidate models are evaluated in one pass,
grouped by ``model``; only one metrics row per model reaches the driver.

ROC AUC (ties averaged, as the rank-sum) and average precision (step sum
over distinct thresholds) need running sums over scores in descending
order.  Rows are first collapsed to distinct scores (partial aggregation),
then the running sums are computed per score *range bucket*: bucket totals
(a few dozen rows per model) give each bucket its offset, and the window
inside a bucket runs in its own task.  No step puts all scores of a model
into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import to_class
from postlake.session import materialise, shuffle_partitions


def running_desc(g: DataFrame, part: list[str], order_col: str, sums: list[str],
                 buckets: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sums`` by ``order_col`` descending within ``part``.

    Adds ``cum_<c>`` for every ``c`` in ``sums``.  ``buckets`` ranges per
    group (the session's shuffle partitions unless given) run in parallel.
    """
    buckets = max(2, buckets or shuffle_partitions(g.sparkSession))
    if not part:
        g, part = g.withColumn("_all", F.lit(0)), ["_all"]
        return running_desc(g, part, order_col, sums, buckets).drop("_all")
    probs = [i / buckets for i in range(1, buckets)]
    cuts = g.groupBy(*part).agg(F.percentile_approx(order_col, probs, 10000).alias("_cuts"))
    # bounded: (number of models) x (buckets - 1) numbers
    with_b = g.join(F.broadcast(cuts), part, "left")
    with_b = with_b.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(order_col)))).drop("_cuts")
    tot = with_b.groupBy(*part, "_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    wb = Window.partitionBy(*part).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select(*part, "_b", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_o_{c}")
                                        for c in sums])
    w = Window.partitionBy(*part, "_b").orderBy(F.desc(order_col)).rowsBetween(Window.unboundedPreceding, 0)
    out = with_b.join(F.broadcast(offsets), [*part, "_b"], "left")
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.sum(c).over(w) + F.col(f"_o_{c}"))
    return out.drop("_b", *[f"_o_{c}" for c in sums])


def evaluate(scored: DataFrame, model_col: str = "model", y: str = "y", p: str = "p",
             threshold: float = 0.5) -> DataFrame:
    """M7: accuracy, F1 (positive class, 0 when undefined), ROC AUC and PR AUC
    (average precision) per model."""
    s = scored.select(F.col(model_col).alias("model"), F.col(y).cast("int").alias("y"),
                      F.col(p).cast("double").alias("p"))
    # one pass over the input: everything below derives from the distinct-score table,
    # which is written because three branches read it; rows without a score or a label don't count
    g = materialise(s.where("p IS NOT NULL AND y IS NOT NULL").groupBy("model", "p")
                    .agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("cnt")), "scores")
    pred = to_class("p", threshold)
    neg = F.col("cnt") - F.col("pos")
    cls = g.groupBy("model").agg(
        (F.sum(F.when(pred == 1, F.col("pos")).otherwise(neg)) / F.sum("cnt")).alias("accuracy"),  # A5
        F.sum(F.when(pred == 1, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(pred == 1, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(pred == 0, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum("pos").alias("n_pos"), F.sum("cnt").alias("n"),                                   # A1
    )
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))  # A6
    c = running_desc(g, ["model"], "p", ["pos", "cnt"])
    ranked = (c.join(cls.select("model", "n_pos", (F.col("n") - F.col("n_pos")).alias("n_neg")), "model")
               .select("model",
                       (F.col("pos") * ((F.col("n_neg") - (F.col("cum_cnt") - F.col("cum_pos")))
                                        + (F.col("cnt") - F.col("pos")) / 2.0)).alias("_auc"),      # A7
                       (F.col("pos") / F.col("n_pos") * F.col("cum_pos") / F.col("cum_cnt")).alias("_ap")))  # A8
    areas = ranked.groupBy("model").agg(F.sum("_auc").alias("_auc"), F.sum("_ap").alias("pr_auc"))
    out = cls.join(areas, "model", "left")
    return out.select(
        "model", "accuracy", f1.alias("f1"),
        F.try_divide(F.col("_auc"), F.col("n_pos") * (F.col("n") - F.col("n_pos"))).alias("roc_auc"),
        F.when(F.col("n_pos") > 0, F.col("pr_auc")).alias("pr_auc"),
    )


def metrics_long(metrics: DataFrame) -> DataFrame:
    """Metrics as ``(model, metric, value)`` rows (the run-record form)."""
    return metrics.select("model", F.expr(
        "stack(4, 'accuracy', accuracy, 'f1', f1, 'roc_auc', roc_auc, 'pr_auc', pr_auc) AS (metric, value)"))


def champion(metrics: DataFrame, order: list[str] | None = None, by: str = "roc_auc") -> DataFrame:
    """The model with the largest ``by``; ties go to the earliest model in
    ``order`` (as ``max`` over an insertion-ordered dict)."""
    ordinal = (F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
               if order else F.lit(0))
    return metrics.agg(F.max_by(F.struct(F.col("model"), F.col(by)),
                                F.struct(F.col(by).isNotNull(), F.col(by), -ordinal)).alias("w")) \
                  .select(F.col("w.model").alias("champion"), F.col(f"w.{by}").alias(by))


def positive_rate(df: DataFrame, y: str, by: list[str] | None = None) -> DataFrame:
    """Share of positives (overall or per group, e.g. per split)."""
    return df.groupBy(*(by or [])).agg(F.avg(F.col(y).cast("double")).alias("positive_rate"),
                                       F.count(F.lit(1)).alias("n"))
