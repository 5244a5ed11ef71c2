"""Exploratory tables behind the propensity charts (the charts are not drawn)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.stats import exact_quantiles
from tillpoint.sources.sinks import stage

NUMERIC_EDA_COLS = (
    "total_txn_count",
    "m1_tpv",
    "w1_sessions",
    "total_atv",
    "total_unique_payers",
    "m1_atv",
    "m1_max_daily_tpv",
    "m1_active_days",
    "total_active_vintage",
    "vintage",
)
CATEGORY_EDA_COLS = ("business_category", "zone_name", "manufacturer")
#: The scoring side, by product flag.
SCORING_EDA_COLS = (
    "total_txn_count",
    "m1_tpv",
    "total_atv",
    "total_unique_payers",
    "m1_atv",
    "m1_max_daily_tpv",
    "m1_active_days",
    "total_active_vintage",
    "w1_loan_sessions",
    "w1_swipe_sessions",
    "w1_speaker_sessions",
    "m1_loan_sessions",
    "m1_swipe_sessions",
    "m1_speaker_sessions",
)
#: How many columns are binned in one projection.
COLUMNS_A_SCAN = 6
SCORING_CATEGORY_COLS = ("zone_name", "business_category", "geohash4")


def _rates(stacked: DataFrame, by: list, labels: dict[str, str] | None, label: str) -> DataFrame:
    """Mean label in percent and merchants per group; with ``labels`` (product -> label column)
    one row per product, from the same aggregate."""
    own = labels or {"": label}
    g = stacked.groupBy(*by).agg(
        F.count("merchant_id").alias("n_merchants"),
        *[(F.lit(100.0) * F.avg(c)).alias(f"_rate{i}") for i, c in enumerate(own.values())],
    )
    keep = [c for c in g.columns if not c.startswith("_rate")]
    cells = F.array(*[F.struct(F.lit(p).alias("product"), F.col(f"_rate{i}").alias("propensity")) for i, p in enumerate(own)])
    out = g.select(*keep, F.explode(cells).alias("r")).select(*([] if not labels else ["r.product"]), *keep, "r.propensity")
    return out.select(*[c for c in out.columns if c != "n_merchants"], "n_merchants")


def rate_by_category(df: DataFrame, cols=CATEGORY_EDA_COLS, label: str = "target", labels: dict[str, str] | None = None) -> DataFrame:
    """(feature, category, propensity = 100 x mean label, n_merchants) per non-NULL category; with
    ``labels`` also by product.  One pass for all columns and labels."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in cols])
    own = list((labels or {"": label}).values())
    stacked = df.select("merchant_id", *own, F.explode(cells).alias("s")).filter(F.col("s.category").isNotNull())
    return _rates(stacked, ["s.feature", "s.category"], labels, label)


def column_quartiles(df: DataFrame, cols=NUMERIC_EDA_COLS) -> DataFrame:
    """(feature, min, q25, q50, q75, max) of every column, exact, found together."""
    rows = [(c, *q) for c, q in exact_quantiles(df, cols).items()]
    return df.sparkSession.createDataFrame(rows, "feature string, min double, q25 double, q50 double, q75 double, max double")


def int_quartile_edges(df: DataFrame, cols) -> dict[str, list[float]]:
    """Per column the edges [-0.01, int(min), int(q25), int(q50), int(q75), int(max)]
    (truncated toward zero, duplicates dropped, sorted); none for a column without values."""
    return {
        c: sorted({-0.01, *(float(int(x)) for x in q)}) if q[0] is not None else []
        for c, q in exact_quantiles(df, cols).items()
    }


def rate_by_quartile_bin(
    df: DataFrame, cols=NUMERIC_EDA_COLS, label: str = "target", labels: dict[str, str] | None = None
) -> DataFrame:
    """(feature, bin, lo, hi, propensity, n_merchants) for each numeric column; bins are
    right-closed between neighbouring edges, values outside have none.  With ``labels`` also by
    product.

    The edges of all columns are found together over the staged rows; the columns are
    then binned a few at a time and the per-bin rates come from one grouped aggregate
    over the stacked rows.
    """
    own = list((labels or {"": label}).values())
    df = stage(df.select("merchant_id", *own, *[F.col(c).cast("double").alias(c) for c in cols]))
    edges = int_quartile_edges(df, cols)
    parts = []
    for k in range(0, len(cols), COLUMNS_A_SCAN):  # few columns a scan keep the generated code small
        some = cols[k : k + COLUMNS_A_SCAN]
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), _bin_of(F.col(c), edges[c]).alias("bin")) for c in some])
        parts.append(df.select("merchant_id", *own, F.explode(cells).alias("s")).filter(F.col("s.bin").isNotNull()))
    rates = _rates(reduce(DataFrame.unionByName, parts), ["s.feature", "s.bin"], labels, label)
    of = F.get(F.lit([edges[c] or [None] for c in cols]).cast("array<array<double>>"), F.array_position(F.lit(list(cols)), F.col("feature")).cast("int") - 1)
    bin_ = F.col("bin").cast("int")
    out = rates.withColumns({"lo": F.get(of, bin_ - 1), "hi": F.get(of, bin_)})
    return out.select(*[c for c in rates.columns if c not in ("propensity", "n_merchants")], "lo", "hi", "propensity", "n_merchants")


def _bin_of(v, edges: list[float]):
    """Right-closed bin over sorted edges, from 1; NULL outside."""
    below = [F.when(v > x, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for x in edges]
    if not below:
        return F.lit(None).cast("bigint")
    return F.when((v > edges[0]) & (v <= edges[-1]), sum(below[1:], below[0]))


def rate_by_top_category(df: DataFrame, col: str = "geohash4", k: int = 50, label: str = "target") -> DataFrame:
    """Rate and count for the k most frequent values (NULL shown as 'nan', as
    the text conversion of the source does; ties by value)."""
    v = F.coalesce(F.col(col).cast("string"), F.lit("nan"))
    d = df.select("merchant_id", F.col(label), v.alias("category"))
    top = d.groupBy("category").count().orderBy(F.col("count").desc(), F.col("category").asc()).limit(k).select("category")
    return (
        d.join(F.broadcast(top), "category", "left_semi")
        .groupBy("category")
        .agg((F.lit(100.0) * F.avg(F.col(label))).alias("propensity"), F.count("merchant_id").alias("n_merchants"))
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def audit(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, n_rows) for several frames in one union of aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)
