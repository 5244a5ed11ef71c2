"""Business layer on scored merchants: LTV, product ranking, outlier trim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.config import RANK_ORDER, THRESHOLDS
from tillpoint.functions.stats import exact_quantiles
from tillpoint.sources.sinks import stage


def _avg_tpv() -> Column:
    return (F.col("m1_tpv") + F.col("m2_tpv")) / F.lit(2.0)


def with_ltv(df: DataFrame) -> DataFrame:
    """loan: 6 x 12% x (two loans of half the average monthly value) x p x eligibility;
    speaker: 12 x 120 x p x eligibility; swipe: average value x 12 x 2% x p x
    eligibility; mltv = their sum (NULL if any is NULL)."""
    disposable = F.lit(0.5) * _avg_tpv() * F.lit(2.0)
    loan = F.lit(6.0) * F.lit(0.12) * disposable * F.col("prob_loan") * F.col("lending_eligibility")
    speaker = F.lit(12.0) * F.lit(120.0) * F.col("prob_speaker") * F.col("speaker_eligibility")
    swipe = _avg_tpv() * F.lit(12.0) * F.lit(0.02) * F.col("prob_swipe") * F.col("swipe_eligibility")
    out = df.select("*", loan.alias("loan_ltv"), speaker.alias("speaker_ltv"), swipe.alias("swipe_ltv"))
    return out.withColumn("mltv", F.col("loan_ltv") + F.col("speaker_ltv") + F.col("swipe_ltv"))


def with_recommendation(df: DataFrame, thresholds: dict = THRESHOLDS, order: tuple = RANK_ORDER) -> DataFrame:
    """p1/p2/p3: products by (probability - threshold) descending; ties keep
    the fixed product order.  A sorted array of structs, no UDF."""
    items = [
        F.struct(
            (F.lit(0.0) - (F.col(f"prob_{p}") - F.lit(float(thresholds[p])))).alias("k"),
            F.lit(i).alias("o"),
            F.lit(p).alias("name"),
        )
        for i, p in enumerate(order)
    ]
    ranked = F.array_sort(F.array(*items))
    return df.select("*", *[ranked[i]["name"].alias(f"p{i + 1}_recommendation") for i in range(len(order))])


def iqr_fence(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Rows with ``q1 - k*iqr <= col <= q3 + k*iqr`` (exact quartiles of the staged rows, linear
    interpolation); no rows if the column has no values."""
    df = stage(df)
    q1, q3 = (F.lit(q).cast("double") for q in exact_quantiles(df, [col], (0.25, 0.75))[col])
    iqr = q3 - q1
    return df.filter((F.col(col) >= q1 - F.lit(k) * iqr) & (F.col(col) <= q3 + F.lit(k) * iqr))


def iqr_trim(df: DataFrame) -> DataFrame:
    d = df.withColumn("m1_m2_avg_tpv", F.lit(0.5) * (F.col("m1_tpv") + F.col("m2_tpv")))
    return iqr_fence(d, "m1_m2_avg_tpv", 3.0)


def max_rows(df: DataFrame, col: str) -> DataFrame:
    """All rows equal to the column maximum (ties kept)."""
    return df.filter(F.col(col) == df.select(F.max(col)).scalar())


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; every bin reported.  A constant
    column gets the range of one around its value."""
    stats = df.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("s")).scalar()
    half = F.when(stats["lo"] == stats["hi"], F.lit(0.5)).otherwise(F.lit(0.0))
    lo, hi = stats["lo"] - half, stats["hi"] + half
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.floor((F.col(col) - lo) / (hi - lo) * F.lit(float(bins))), F.lit(bins - 1)).cast("int") + 1
    row = df.filter(F.col(col).isNotNull()).agg(
        *[F.sum(F.when(idx == b, 1).otherwise(0)).cast("bigint").alias(f"b{b}") for b in range(1, bins + 1)]
    )
    cells = F.array(
        *[
            F.struct(F.lit(b).alias("bin"), (lo + width * F.lit(float(b - 1))).alias("lo"), (lo + width * F.lit(float(b))).alias("hi"), F.col(f"b{b}").alias("n"))
            for b in range(1, bins + 1)
        ]
    )
    return row.select(F.explode(cells).alias("c")).select("c.bin", "c.lo", "c.hi", "c.n")
