"""Classifier evaluation tables over a (target, prob) frame.

Everything is computed in aggregates; the ROC curve needs a running sum over
scores in descending order, which is done without a single-partition window:
distinct scores are cut into ~1024 quantile buckets (``QuantileDiscretizer``),
the bucket totals (≤ 1024 rows) give each bucket's offset, and the running
sum inside a bucket is a window partitioned by bucket.

A row without a score counts as scored below every threshold: predicted
negative in the tables, the last point of the ROC curve.  Rates over an empty class are NULL.
"""

from __future__ import annotations

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.config import SWEEP_THRESHOLDS


def threshold_sweep(scored: DataFrame, thresholds=SWEEP_THRESHOLDS, label: str = "target", prob: str = "prob") -> DataFrame:
    """threshold, predicted_positive, precision, recall (strict ``prob > t``), one pass."""
    y, p = F.col(label), F.col(prob)
    aggs = [F.sum(F.when(y == 1, 1).otherwise(0)).alias("_pos")]
    for i, t in enumerate(thresholds):
        pred = p > F.lit(float(t))
        aggs.append(F.sum(F.when(pred, 1).otherwise(0)).alias(f"_pp{i}"))
        aggs.append(F.sum(F.when(pred & (y == 1), 1).otherwise(0)).alias(f"_tp{i}"))
    row = scored.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"_pp{i}").cast("bigint").alias("pp"),
                F.col(f"_tp{i}").cast("bigint").alias("tp"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    e = row.select(F.col("_pos"), F.explode(rows).alias("r"))
    return e.select(
        F.col("r.threshold").alias("threshold"),
        F.col("r.pp").alias("predicted_positive"),
        F.try_divide(F.col("r.tp"), F.col("r.pp")).cast("double").alias("precision"),
        F.try_divide(F.col("r.tp"), F.col("_pos")).cast("double").alias("recall"),
    )


def confusion_matrix(scored: DataFrame, threshold: float, label: str = "target", prob: str = "prob") -> DataFrame:
    """threshold, target, predicted, n, rate (n over the target's row total)."""
    pred = F.coalesce(F.col(prob) > F.lit(float(threshold)), F.lit(False)).cast("int")
    per = scored.groupBy(F.col(label).cast("int").alias("target")).agg(
        F.sum(F.when(pred == 0, 1).otherwise(0)).cast("bigint").alias("n0"),
        F.sum(F.when(pred == 1, 1).otherwise(0)).cast("bigint").alias("n1"),
    )
    cells = per.select(
        "target",
        (F.col("n0") + F.col("n1")).alias("tot"),
        F.explode(F.array(F.struct(F.lit(0).alias("predicted"), F.col("n0").alias("n")), F.struct(F.lit(1).alias("predicted"), F.col("n1").alias("n")))).alias("c"),
    )
    return cells.select(
        F.lit(float(threshold)).alias("threshold"),
        "target",
        F.col("c.predicted").alias("predicted"),
        F.col("c.n").alias("n"),
        (F.col("c.n") / F.col("tot")).alias("rate"),
    )


def accuracy(scored: DataFrame, threshold: float = 0.85, label: str = "target", prob: str = "prob") -> DataFrame:
    hit = (F.coalesce(F.col(prob) > F.lit(float(threshold)), F.lit(False)).cast("int") == F.col(label)).cast("int")
    return scored.agg(F.lit(float(threshold)).alias("threshold"), F.avg(hit).alias("accuracy"))


def score_cumulative(scored: DataFrame, label: str = "target", prob: str = "prob", buckets: int = 1024) -> DataFrame:
    """Per distinct score (descending): pos, neg and their running sums."""
    y = F.col(label)
    per = scored.groupBy(F.col(prob).alias("score")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(y == 1, 0).otherwise(1)).cast("bigint").alias("neg"),
    )
    qd = QuantileDiscretizer(numBuckets=buckets, inputCol="score", outputCol="bucket", relativeError=0.001)
    per = qd.setHandleInvalid("keep").fit(per.filter(F.col("score").isNotNull())).transform(per)
    per = per.withColumn("bucket", F.when(F.col("score").isNull(), F.lit(-1.0)).otherwise(F.col("bucket")))
    totals = per.groupBy("bucket").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    higher = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("bp").over(higher), F.lit(0)).alias("off_pos"),
        F.coalesce(F.sum("bn").over(higher), F.lit(0)).alias("off_neg"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.col("score").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return per.join(F.broadcast(offsets), "bucket").select(
        "score",
        "pos",
        "neg",
        (F.col("off_pos") + F.sum("pos").over(inside)).cast("bigint").alias("cum_pos"),
        (F.col("off_neg") + F.sum("neg").over(inside)).cast("bigint").alias("cum_neg"),
    )


def _class_totals(scored: DataFrame, label: str):
    y = F.col(label)
    return scored.select(
        F.struct(
            F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("P"),
            F.sum(F.when(y == 1, 0).otherwise(1)).cast("bigint").alias("N"),
        )
    ).scalar()


def roc_curve(scored: DataFrame, label: str = "target", prob: str = "prob") -> DataFrame:
    """One point per distinct score: threshold, tpr, fpr (no intermediate drop)."""
    tot = _class_totals(scored, label)
    cum = score_cumulative(scored, label, prob)
    return cum.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_pos"), tot["P"]).alias("tpr"),
        F.try_divide(F.col("cum_neg"), tot["N"]).alias("fpr"),
    )


def roc_auc(scored: DataFrame, label: str = "target", prob: str = "prob") -> DataFrame:
    """Trapezoid area under the ROC curve, from integer sums (exact)."""
    tot = _class_totals(scored, label)
    cum = score_cumulative(scored, label, prob)
    num = cum.agg(F.sum(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos"))).cast("bigint").alias("num"))
    return num.select(F.try_divide(F.col("num"), F.lit(2.0) * tot["P"] * tot["N"]).alias("auc"))
