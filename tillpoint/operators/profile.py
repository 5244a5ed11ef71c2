"""Merchant profile (mart rows + geohash), vintage and device manufacturer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.config import MAJOR_BRANDS, MANUFACTURER_ALIASES, ProductSpec
from tillpoint.functions.geohash import geohash
from tillpoint.operators import cohort
from tillpoint.operators.rolling import bounded_broadcast
from tillpoint.sources.sinks import stage
from tillpoint.sources.tables import Tables, unique_by

FLAG_COLS = ("swipe_flag", "speaker_flag", "loan_flag", "fp_flag", "club_flag", "qr_flag", "credit_flag", "debit_flag")
ELIGIBILITY_COLS = (
    "lending_eligibility",
    "lending_eligibility_type",
    "swipe_eligibility",
    "fp_eligibility",
    "insurance_eligibility",
    "club_eligibility",
    "gl_eligibility",
    "speaker_eligibility",
)
PRODUCT_DATE_COLS = (
    "loan_disbursal_date",
    "loan_closure_date",
    "swipe_order_date",
    "speaker_order_date",
    "club_start_date",
    "club_end_date",
)


def _profile_columns(geo_precisions: tuple[int, ...], vintage_as_of: dt.date | None) -> list:
    lng, lat = F.col("integ_longitude"), F.col("integ_latitude")
    cols = ["merchant_id", "mid", "actual_merchant_type"]
    if vintage_as_of is not None:
        cols.append(F.date_diff(F.lit(vintage_as_of), F.to_date("merchant_created_at")).cast("bigint").alias("vintage"))
    cols += [
        "area_name",
        "zone_name",
        "region_name",
        "territory_name",
        "merchant_created_at",
        F.col("std_category").alias("business_category"),
    ]
    cols += [geohash(lng, lat, p).alias(f"geohash{p}") for p in geo_precisions]
    cols += list(FLAG_COLS)
    cols += [F.col("actual_merchant_type").alias("merchant_acquisition_channel"), "onboarding_date"]
    cols += list(ELIGIBILITY_COLS)
    cols += ["merchant_score", "engagement_score"]
    cols += list(PRODUCT_DATE_COLS)
    return cols


def merchant_profile(tables: Tables, spec: ProductSpec, ordered: bool = False) -> DataFrame:
    """Mart rows of the applied ∪ pushed cohort created since the floor, with
    geohash 6 / 3 / 4.  ``ordered`` adds the presentation sort."""
    mart = tables.merchant_mart.filter(F.col("merchant_created_at") >= cohort.ts_floor(spec.date_floor))
    own = mart.join(cohort.cohort_union(tables, spec), "merchant_id", "left_semi")
    out = unique_by(own, "merchant_id", "merchant mart").select(*_profile_columns((6, 3, 4), None))
    return out.orderBy("merchant_id") if ordered else out


def merchant_profile_asof(tables: Tables, as_of: dt.date, min_txns: int = 5) -> DataFrame:
    """Mart rows of the active base with vintage as of ``as_of`` and geohash 3 / 4."""
    active = cohort.active_merchants(tables, as_of, min_txns=min_txns)
    mart = tables.merchant_mart.filter(F.col("merchant_created_at") >= cohort.ts_floor(tables.date_floor))
    own = mart.join(bounded_broadcast(active, ["merchant_id"]), "merchant_id", "left_semi")
    return unique_by(own, "merchant_id", "merchant mart").select(*_profile_columns((3, 4), as_of))


def vintage(tables: Tables, spec: ProductSpec) -> DataFrame:
    """Days from merchant creation to the (status-filtered) anchor date.

    One row per anchor row (a merchant may have two), as the source does.
    """
    anchors = cohort.anchor_dates(tables, spec, mode="reference", status_filter=True)
    mart = tables.merchant_mart.filter(F.col("merchant_created_at") >= cohort.ts_floor(spec.date_floor))
    mart = unique_by(mart.select("merchant_id", "merchant_created_at"), "merchant_id", "merchant mart")
    return mart.join(anchors, "merchant_id").select(
        "merchant_id", F.date_diff(F.col("order_date"), F.to_date("merchant_created_at")).cast("bigint").alias("vintage")
    )


def clamp_negative(c: str = "vintage"):
    """Negative -> 0, NULL stays NULL."""
    return F.when(F.col(c) < 0, F.lit(0)).otherwise(F.col(c))


def device_manufacturer(tables: Tables, merchants: DataFrame) -> DataFrame:
    """Device rows of the given merchants (semi join)."""
    return tables.device_info.join(merchants.select("merchant_id"), "merchant_id", "left_semi").select(
        "merchant_id", "manufacturer"
    )


def normalise_manufacturer(c):
    """Lower-case and map the four long vendor names to short ones."""
    low = F.lower(c)
    out = low
    for k, v in MANUFACTURER_ALIASES.items():
        out = F.when(low == F.lit(k), F.lit(v)).otherwise(out)
    return out


def manufacturer_fixed(df: DataFrame, col: str = "manufacturer") -> DataFrame:
    """Scoring rule: normalised name if in the fixed brand list, else 'other'
    (NULL also becomes 'other')."""
    norm = normalise_manufacturer(F.col(col))
    return df.withColumn(col, F.when(norm.isin(list(MAJOR_BRANDS)), norm).otherwise(F.lit("other")))


def manufacturer_topk(df: DataFrame, col: str = "manufacturer", k: int = 20) -> DataFrame:
    """Training rule: NULL -> 'Other', normalise, keep the k most frequent
    names (ties by name) and map the rest to 'other'.

    The top-k is a ``TakeOrderedAndProject`` over the per-name counts, which
    holds one row per distinct name; the k-row result is broadcast.  The rows are read twice, so
    they are staged first (a staged frame is taken as it is).
    """
    filled = stage(df).withColumn(col, normalise_manufacturer(F.coalesce(F.col(col), F.lit("Other"))))
    top = (
        filled.groupBy(col)
        .count()
        .orderBy(F.col("count").desc(), F.col(col).asc())
        .limit(k)
        .select(F.col(col).alias("_top"))
    )
    j = filled.join(F.broadcast(top), filled[col] == top["_top"], "left")
    return j.withColumn(col, F.when(F.col("_top").isNotNull(), F.col(col)).otherwise(F.lit("other"))).drop("_top")
