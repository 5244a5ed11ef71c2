"""Cohorts (pushed / applied / active merchants), labels and anchor dates.

All outputs are merchant-level frames.  Set operations are ``union`` +
``distinct`` (one shuffle on merchant_id, map-side de-duplicated first, so a
hot merchant collapses to one row per map task before the exchange).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.config import (
    ACTIVE_DAYS,
    ACTIVE_MIN_TPV,
    ACTIVE_MIN_TXNS,
    ProductSpec,
)
from tillpoint.sources.tables import Tables, unique_by


def ts_floor(d: dt.date) -> Column:
    """Timestamp literal: ``ts >= ts_floor(d)`` equals ``to_date(ts) >= d`` and
    is a plain comparison on the scanned column, so it reaches PushedFilters."""
    # parsed from text: independent of the session and Python time zones
    return F.to_timestamp_ntz(F.lit(f"{d.isoformat()} 00:00:00"))


def _tasks(tables: Tables, spec: ProductSpec, floor: bool = True) -> list[DataFrame]:
    out = []
    for name in ("task_history_v1", "task_history_v2"):
        t = tables.get(name).filter(F.col("task_id").isin(list(spec.task_ids)))
        if floor:
            t = t.filter(F.col("created_at") >= ts_floor(spec.date_floor))
        out.append(t)
    return out


def _applications(tables: Tables, spec: ProductSpec) -> DataFrame:
    return tables.get(spec.application_table)


def pushed_merchants(tables: Tables, spec: ProductSpec) -> DataFrame:
    """Merchants with a qualifying field task in either task table."""

    def build():
        v1, v2 = _tasks(tables, spec)
        return v1.select("merchant_id").union(v2.select("merchant_id")).distinct()

    return tables.memo(("pushed", spec), build, staged=False)


def push_dates(tables: Tables, spec: ProductSpec) -> DataFrame:
    """(merchant_id, order_date): first task date per table, UNION DISTINCT.

    Not merchant-unique: a merchant in both tables with different first dates
    keeps two rows (the fan-out the anchor plans reproduce).
    """
    def build():
        parts = [
            t.groupBy("merchant_id").agg(F.min(F.to_date("created_at")).alias("order_date"))
            for t in _tasks(tables, spec)
        ]
        return parts[0].union(parts[1]).distinct()

    return tables.memo(("push_dates", spec), build)


first_task_date = push_dates


def applied_merchants(tables: Tables, spec: ProductSpec) -> DataFrame:
    def build():
        app = _applications(tables, spec)
        return (
            app.filter((F.col("created_at") >= ts_floor(spec.date_floor)) & F.col("status").isin(list(spec.statuses)))
            .select("merchant_id")
            .distinct()
        )

    return tables.memo(("applied", spec), build, staged=False)


def cohort_union(tables: Tables, spec: ProductSpec) -> DataFrame:
    """Applied ∪ pushed, merchant-unique."""
    return tables.memo(
        ("cohort", spec), lambda: applied_merchants(tables, spec).union(pushed_merchants(tables, spec)).distinct()
    )


def applied_not_pushed(tables: Tables, spec: ProductSpec) -> DataFrame:
    return applied_merchants(tables, spec).join(pushed_merchants(tables, spec), "merchant_id", "left_anti")


def target_label(tables: Tables, spec: ProductSpec) -> DataFrame:
    """1 if the merchant applied, else 0, over applied ∪ pushed (existence join)."""
    applied = applied_merchants(tables, spec).withColumn("_applied", F.lit(1))
    return (
        cohort_union(tables, spec)
        .join(applied, "merchant_id", "left")
        .select("merchant_id", F.coalesce(F.col("_applied"), F.lit(0)).alias("target"))
    )


def first_application_dates(
    tables: Tables, spec: ProductSpec, merchants: DataFrame | None = None, status_filter: bool = False
) -> DataFrame:
    """(merchant_id, first order date) from the application table.

    ``merchants`` restricts to a cohort (semi join); ``status_filter`` applies
    the product statuses (vintage plan) - the feature plans do not (B2).
    """
    app = _applications(tables, spec)
    if status_filter:
        app = app.filter(F.col("status").isin(list(spec.statuses)))
    if merchants is not None:
        app = app.join(merchants.select("merchant_id"), "merchant_id", "left_semi")
    return app.groupBy("merchant_id").agg(F.min(F.to_date(F.col(spec.order_date_col))).alias("order_date"))


def anchor_dates(
    tables: Tables,
    spec: ProductSpec,
    mode: str = "earliest",
    merchants: DataFrame | None = None,
    status_filter: bool = False,
) -> DataFrame:
    """Anchor date per merchant: first application order date, else first push date.

    ``mode='reference'`` keeps the bag produced by the full outer join of the
    push dates (up to two rows per merchant) with the application dates; every
    feature plan then aggregates over all anchor rows of a merchant.
    ``mode='earliest'`` returns exactly one row per merchant.
    """
    if merchants is None:
        return tables.memo(
            ("anchors", spec, mode, status_filter),
            lambda: _anchor_dates(tables, spec, mode, None if status_filter else cohort_union(tables, spec), status_filter),
            staged=False,  # consumers stage what they broadcast
        )
    return _anchor_dates(tables, spec, mode, merchants, status_filter)


def _anchor_dates(tables, spec, mode, merchants, status_filter):
    pushed = push_dates(tables, spec).withColumnRenamed("order_date", "_pushed")
    ordered = first_application_dates(tables, spec, merchants, status_filter).withColumnRenamed("order_date", "_ordered")
    joined = pushed.join(ordered, "merchant_id", "full_outer").select(
        "merchant_id", F.coalesce("_ordered", "_pushed").alias("order_date")
    )
    if mode == "reference":
        return joined
    if mode == "earliest":
        return joined.groupBy("merchant_id").agg(F.min("order_date").alias("order_date"))
    raise ValueError(f"unknown anchor mode {mode!r}")


def push_converted(tables: Tables, spec: ProductSpec, days: int = 7) -> DataFrame:
    """Merchants with a task in ``(first order date - days, first order date]``.

    Tasks are not date-floored here; applications are (status + 2018 floor).
    """
    app = _applications(tables, spec).filter(
        (F.col("created_at") >= ts_floor(spec.date_floor)) & F.col("status").isin(list(spec.statuses))
    )
    so = app.groupBy("merchant_id").agg(F.min(F.to_date(F.col(spec.order_date_col))).alias("od"))
    v1, v2 = _tasks(tables, spec, floor=False)
    tasks = v1.select("merchant_id", "created_at").union(v2.select("merchant_id", "created_at"))
    d = F.to_date("created_at")
    hit = tasks.join(so, "merchant_id").filter((d <= F.col("od")) & (d > F.date_sub(F.col("od"), days)))
    return hit.select("merchant_id").distinct()


def active_merchants(
    tables: Tables,
    as_of: dt.date,
    min_txns: int = ACTIVE_MIN_TXNS,
    min_tpv: float = ACTIVE_MIN_TPV,
    days: int = ACTIVE_DAYS,
    with_mart: bool = False,
    date_floor: dt.date | None = None,
) -> DataFrame:
    """Active base: >= min_txns distinct successful ids and >= min_tpv value
    since ``as_of - days`` (no upper bound, so "today" counts).

    ``with_mart`` adds the mart join (created >= 2018) and returns ``mid``.
    The count-distinct runs as Spark's two-phase distinct aggregate keyed by
    (merchant_id, id), so a merchant holding a third of the rows is spread over
    many tasks before its per-merchant total is formed.
    """
    date_floor = date_floor or tables.date_floor
    key = ("active", as_of, min_txns, min_tpv, days, with_mart, date_floor)
    return tables.memo(key, lambda: _active(tables, as_of, min_txns, min_tpv, days, with_mart, date_floor))


def _active(tables, as_of, min_txns, min_tpv, days, with_mart, date_floor):
    recent = tables.since("transactions", "payment_timestamp", as_of - dt.timedelta(days=days))
    tx = recent.filter(F.col("status") == "SUCCESS")
    agg = tx.groupBy("merchant_id").agg(
        F.count_distinct("id").alias("txns"),
        F.sum("amount").alias("tpv"),
    )
    active = agg.filter((F.col("txns") >= min_txns) & (F.col("tpv") >= min_tpv)).select(
        "merchant_id", "txns", F.col("tpv").cast("double").alias("tpv")
    )
    if not with_mart:
        return active
    # the facts are reduced to one row per merchant before they meet the mart
    mart = tables.merchant_mart.filter(F.col("merchant_created_at") >= ts_floor(date_floor or tables.date_floor))
    own = active.join(mart.select("merchant_id", "mid"), "merchant_id").select("merchant_id", "mid", "txns", "tpv")
    return unique_by(own, "merchant_id", "merchant mart")


def chunked_ids(df: DataFrame, partitions: int, key: str = "merchant_id") -> DataFrame:
    """Union of ``MOD(key, p) = i`` for i in 0..p-1, as one predicate.

    SQL MOD keeps the dividend's sign, so negative keys not divisible by p and
    NULL keys fall in no chunk and are dropped; everything else is kept.  The
    physical split is Spark's job (shuffle partitions), not the query's.
    """
    m = F.col(key) % F.lit(partitions)
    return df.filter((m >= 0) & (m < partitions))
