"""Feature assembly: the training matrix and the scoring matrix.

Both are chains of left joins of merchant-level frames onto a merchant list
(each right side is merchant-unique, so no fan-out), followed by derived
columns.  The merchant frame is staged once before the steps that read it twice
(top manufacturers, per-geohash statistics), so each fact table is scanned once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.config import (
    CATEGORICAL_FEATURES,
    RATIO_FEATURES,
    ROLLING_FEATURES,
    ProductSpec,
)
from tillpoint.operators import cohort, profile, rolling, sessions
from tillpoint.sources.sinks import stage
from tillpoint.sources.tables import Tables

TRAIN_PROFILE_COLS = (
    "actual_merchant_type",
    "area_name",
    "zone_name",
    "region_name",
    "territory_name",
    "business_category",
    "merchant_acquisition_channel",
)


def trend(w1: Column, w2: Column, w3: Column) -> Column:
    """up if w1 > w2 > w3 strictly, down if strictly falling, else flat (NULL -> flat)."""
    c1, c2 = w1 - w2, w2 - w3
    return (
        F.when((c1 > 0) & (c2 > 0), F.lit("up"))
        .when((c1 < 0) & (c2 < 0), F.lit("down"))
        .otherwise(F.lit("flat"))
    )


def with_trend(df: DataFrame) -> DataFrame:
    return df.withColumn("trend", trend(F.col("w1_txn_count"), F.col("w2_txn_count"), F.col("w3_txn_count")))


def with_ratios(df: DataFrame) -> DataFrame:
    """The nine activity ratios; a zero or NULL denominator gives NULL."""
    return df.select("*", *[F.try_divide(F.col(n), F.col(d)).cast("double").alias(name) for name, n, d in RATIO_FEATURES])


def with_location(df: DataFrame, geo: str = "geohash4", tpv: str = "total_tpv") -> DataFrame:
    """Per-geohash distinct merchants, tpv per row and total tpv, joined back.

    Rows without a geohash get NULL.  A geohash whose rows all lack tpv gets
    0 (sum over nothing), as a pandas group sum would.
    """
    stats = (
        df.filter(F.col(geo).isNotNull())
        .groupBy(geo)
        .agg(
            F.count_distinct("merchant_id").alias("loc_hash_density"),
            F.coalesce(F.sum(tpv), F.lit(0.0)).alias("_tpv"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .select(
            geo,
            "loc_hash_density",
            (F.col("_tpv") / F.col("_rows")).alias("loc_hash_atv"),
            F.col("_tpv").alias("loc_hash_tpv"),
        )
    )
    return df.join(stats, geo, "left")


def _active_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("txn_count_90_days").isNotNull())


def _located_and_active(df: DataFrame, location_first: bool) -> DataFrame:
    """Location statistics and the activity filter, in either order."""
    return _active_only(with_location(df)) if location_first else with_location(_active_only(df))


def drop_null_categoricals(df: DataFrame, cols=CATEGORICAL_FEATURES) -> DataFrame:
    return df.na.drop("any", subset=list(cols))


def _one_vintage(tables: Tables, spec: ProductSpec) -> DataFrame:
    """Vintage per merchant; with two anchor rows the earliest anchor's value."""
    return profile.vintage(tables, spec).groupBy("merchant_id").agg(F.min("vintage").alias("vintage"))


def training_matrix(
    tables: Tables,
    spec: ProductSpec,
    session_spec: ProductSpec | None = None,
    session_years: tuple[int, ...] = (2020, 2021, 2022),
    anchor_mode: str = "earliest",
    with_sessions: bool = True,
    drop_nulls: bool = True,
    location_first: bool = True,
) -> DataFrame:
    """Label + device + profile + rolling features + sessions + vintage, then
    trend, manufacturer top-20, location statistics and the ``txn_count_90_days``
    filter, ratios, the categorical NULL drop and the vintage clamp.

    ``location_first``: whether location statistics count merchants that the activity filter
    drops; the source does so in training and not in scoring, and so do the defaults."""
    labels = cohort.target_label(tables, spec)
    dev = profile.device_manufacturer(tables, labels)
    m = labels.join(dev, "merchant_id", "left")

    order_col = [spec.profile_date_col] if spec.profile_date_col else []
    prof_cols = list(TRAIN_PROFILE_COLS) + order_col + ["merchant_created_at", "geohash6", "geohash3", "geohash4"]
    prof = profile.merchant_profile(tables, spec).select("merchant_id", *prof_cols)
    m = m.join(prof, "merchant_id", "left")
    m = m.join(rolling.txn_features_train(tables, spec, anchor_mode), "merchant_id", "left")
    sess_cols = []
    if with_sessions:
        sspec = session_spec or spec
        m = m.join(sessions.session_features_years(tables, sspec, session_years, anchor_mode), "merchant_id", "left")
        sess_cols = ["w1_sessions", "m1_sessions"]
    m = with_trend(m)
    m = m.join(_one_vintage(tables, spec), "merchant_id", "left")
    m = stage(m)  # the next two steps read their input twice
    m = profile.manufacturer_topk(m)
    m = with_ratios(_located_and_active(m, location_first))
    if drop_nulls:
        m = drop_null_categoricals(m)
    m = m.withColumn("vintage", profile.clamp_negative("vintage").cast("bigint"))
    cols = (
        ["merchant_id", "target", "manufacturer"]
        + prof_cols
        + list(ROLLING_FEATURES)
        + sess_cols
        + ["trend", "vintage", "loc_hash_density", "loc_hash_atv", "loc_hash_tpv"]
        + [r[0] for r in RATIO_FEATURES]
    )
    return m.select(*cols)


SCORING_PROFILE_COLS = (
    "vintage",
    "zone_name",
    "business_category",
    "geohash4",
    "speaker_eligibility",
    "swipe_eligibility",
    "lending_eligibility",
)


def scoring_matrix(
    tables: Tables,
    as_of: dt.date,
    products: dict[str, tuple],
    min_txns: int = 5,
    impute_mode: bool = False,
    location_first: bool = False,
) -> DataFrame:
    """Active base as of ``as_of`` with every scoring feature (``location_first`` as in
    :func:`training_matrix`).

    ``impute_mode`` fills NULL categoricals with the column mode; the source
    pipeline's fill is a no-op (it aligns on index), so the default is off.
    """
    base = profile.merchant_profile_asof(tables, as_of, min_txns).select("merchant_id", *SCORING_PROFILE_COLS)
    m = base
    for part in (
        rolling.activity_features_asof(tables, as_of, min_txns),  # one fact scan for all 35
        sessions.session_features_asof(tables, as_of, products, min_txns),
    ):
        m = m.join(part, "merchant_id", "left")
    m = with_trend(m)
    if not location_first:
        m = _active_only(m)
    m = m.join(tables.device_info.select("merchant_id", "manufacturer"), "merchant_id", "left")
    m = stage(profile.manufacturer_fixed(m))  # the next step reads its input twice
    m = with_ratios(_located_and_active(m, location_first))
    if impute_mode:
        m = mode_impute(m)
    m = m.withColumn("vintage", profile.clamp_negative("vintage").cast("bigint"))
    sess = [f"{w}_{p}_sessions" for p in products for w in ("w1", "m1")]
    cols = (
        ["merchant_id"]
        + list(ROLLING_FEATURES)
        + [r[0] for r in RATIO_FEATURES]
        + ["zone_name", "business_category", "trend", "geohash4", "vintage", "manufacturer"]
        + ["loc_hash_density", "loc_hash_atv", "loc_hash_tpv"]
        + sess
        + ["speaker_eligibility", "swipe_eligibility", "lending_eligibility"]
    )
    return m.select(*cols)


def column_modes(df: DataFrame, cols=CATEGORICAL_FEATURES) -> DataFrame:
    """(feature, mode) with the smallest value among equally frequent ones."""
    row = df.select(*[F.mode(F.col(c), deterministic=True).alias(c) for c in cols])
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("mode")) for c in cols])).alias("m")
    ).select("m.feature", "m.mode")


def mode_impute(df: DataFrame, cols=CATEGORICAL_FEATURES) -> DataFrame:
    """NULL categoricals -> column mode (one scalar subquery for all columns)."""
    modes = df.select(F.struct(*[F.mode(F.col(c), deterministic=True).alias(c) for c in cols])).scalar()
    return df.select(*[F.coalesce(F.col(c), modes[c]).alias(c) if c in cols else F.col(c) for c in df.columns])


def with_pseudo_scores(df: DataFrame) -> DataFrame:
    """Deterministic stand-in probabilities derived from merchant_id.

    Used where a check needs model-free scores (LTV, ranking, trimming); the
    production path scores with the trained models (``operators.ml``).
    """
    k = F.col("merchant_id")
    return df.select(
        "*",
        ((k * 7919 % 1000) / 1000.0).alias("prob_loan"),
        ((k * 104729 % 1000) / 1000.0).alias("prob_swipe"),
        ((k * 1299709 % 1000) / 1000.0).alias("prob_speaker"),
    )
