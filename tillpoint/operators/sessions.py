"""App-session features.

Sessions are given ids on app events (not gap windows).  Every distinct count
is a window mask per (merchant, session) (:func:`rolling.window_distinct_counts`), and event tables are
semi-joined to the (size-checked, broadcast) merchant list before any
aggregation so that only cohort events are shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.config import ProductSpec
from tillpoint.functions.windows import in_window
from tillpoint.operators import cohort
from tillpoint.operators.rolling import bounded_broadcast, window_distinct_counts
from tillpoint.sources.tables import Tables, unique_by


def event_name_discovery(tables: Tables, pattern: str, date_floor: dt.date | None = None) -> DataFrame:
    """Distinct trimmed event names whose lower-case form contains ``pattern``."""
    floor = date_floor or tables.date_floor
    ev = tables.app_event.filter(
        (F.col("created_at") >= cohort.ts_floor(floor)) & F.lower(F.col("event_name")).contains(pattern.lower())
    )
    return ev.select(F.trim(F.col("event_name")).alias("event_name")).distinct()


def product_events(tables: Tables, spec: ProductSpec) -> DataFrame:
    """App events of the product: by literal list, or by discovered names.

    Discovered names are trimmed but matched against untrimmed rows (so padded
    names never match), via a semi join against the small name set.
    """
    ev = tables.app_event
    if spec.event_pattern:
        names = event_name_discovery(tables, spec.event_pattern, spec.date_floor)
        return ev.join(bounded_broadcast(names), "event_name", "left_semi")
    return ev.filter(F.col("event_name").isin(list(spec.events)))


Slice = tuple[dt.date, dt.date]


def _slice_of(ts: Column, slices: Sequence[Slice]) -> Column:
    """The index of the half-open slice that holds ``ts``, or NULL."""
    out = F.lit(None).cast("int")
    for k, (start, end) in enumerate(slices):
        out = F.when((ts >= cohort.ts_floor(start)) & (ts < cohort.ts_floor(end)), F.lit(k)).otherwise(out)
    return out


def _within(ts: Column, slices: Sequence[Slice]) -> Column:
    """``ts`` in any slice, as plain comparisons that reach the scan; touching slices are one."""
    spans: list[list[dt.date]] = []
    for start, end in sorted(slices):
        if spans and start < spans[-1][1]:
            raise ValueError("slices overlap")
        if spans and start == spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([start, end])
    return reduce(Column.__or__, [(ts >= cohort.ts_floor(a)) & (ts < cohort.ts_floor(b)) for a, b in spans])


def session_cohort(tables: Tables, spec: ProductSpec, slices: Sequence[Slice]) -> DataFrame:
    """(merchant_id, mid, slice) of applied ∪ pushed merchants created in one of the slices."""
    created = F.col("merchant_created_at")
    mart = tables.merchant_mart.filter(_within(created, slices)).select("merchant_id", "mid", _slice_of(created, slices).alias("slice"))
    own = cohort.cohort_union(tables, spec).join(mart, "merchant_id")
    return unique_by(own, "merchant_id", "merchant mart")


def session_features_slices(
    tables: Tables, spec: ProductSpec, slices: Sequence[Slice], anchor_mode: str = "earliest"
) -> DataFrame:
    """(merchant_id, slice, w1_sessions, m1_sessions): distinct sessions before each merchant's
    anchor date, of merchants created in a slice and of events in the same slice (source
    MerchantApp, non-null session, product events); only w1 > 0.

    Merchants and events are tagged with their slice and joined on it, so events are read
    once and the cohort is staged once, whatever the number of slices.
    """
    ml = session_cohort(tables, spec, slices)
    anchors = cohort.anchor_dates(tables, spec, mode=anchor_mode, merchants=ml)
    st = bounded_broadcast(ml.join(anchors, "merchant_id").select("merchant_id", "mid", "slice", "order_date"))
    at = F.col("created_at")
    ev = product_events(tables, spec).filter(
        _within(at, slices) & F.col("session_id").isNotNull() & (F.col("source") == "MerchantApp")
    )
    j = ev.withColumn("slice", _slice_of(at, slices)).join(st, ["mid", "slice"])
    counts = window_distinct_counts(
        j,
        F.col("session_id"),
        F.to_date("created_at"),
        F.col("order_date"),
        {"w1_sessions": "w1", "m1_sessions": "m1"},
        by=("merchant_id", "slice"),
    )
    return counts.filter(F.col("w1_sessions") > 0)


def session_features_train(
    tables: Tables, spec: ProductSpec, start: dt.date, end: dt.date, anchor_mode: str = "earliest"
) -> DataFrame:
    """One slice [start, end) of :func:`session_features_slices`."""
    return session_features_slices(tables, spec, [(start, end)], anchor_mode).drop("slice")


def session_features_years(
    tables: Tables, spec: ProductSpec, years: tuple[int, ...], anchor_mode: str = "earliest"
) -> DataFrame:
    """Year-sliced extraction in one pass, then per-merchant sums over the slices."""
    slices = [(dt.date(y, 1, 1), dt.date(y + 1, 1, 1)) for y in sorted(set(years))]
    return session_features_slices(tables, spec, slices, anchor_mode).groupBy("merchant_id").agg(
        F.sum("w1_sessions").cast("bigint").alias("w1_sessions"),
        F.sum("m1_sessions").cast("bigint").alias("m1_sessions"),
    )


def _active_mids(tables: Tables, as_of: dt.date, min_txns: int) -> DataFrame:
    """Size-checked broadcast of the active base's (merchant_id, mid)."""
    active = cohort.active_merchants(tables, as_of, min_txns=min_txns, with_mart=True)
    return bounded_broadcast(active, ["merchant_id", "mid"])


def session_features_asof(
    tables: Tables, as_of: dt.date, products: dict[str, tuple], min_txns: int = 5, lookback: int = 31
) -> DataFrame:
    """Per product: w1 / m1 sums of per-day distinct sessions, last ``lookback`` days.

    No source filter; NULL sessions never count but still make the merchant
    appear (with zeros) when it had any event in the look-back.
    """
    ml = _active_mids(tables, as_of, min_txns)
    ev = tables.since("app_event", "created_at", as_of - dt.timedelta(days=lookback))
    ev = ev.join(ml.select("mid"), "mid", "left_semi")
    day = F.to_date("created_at").alias("day")
    flags = ev.groupBy("mid", day, "session_id").agg(
        *[
            F.max(F.when(F.col("session_id").isNotNull() & F.col("event_name").isin(list(evs)), 1).otherwise(0)).alias(p)
            for p, evs in products.items()
        ]
    )
    od = F.lit(as_of).cast("date")
    aggs = []
    for p in products:
        for w in ("w1", "m1"):
            aggs.append(
                F.sum(F.when(in_window(F.col("day"), od, w), F.col(p)).otherwise(0)).cast("bigint").alias(f"{w}_{p}_sessions")
            )
    per_mid = flags.groupBy("mid").agg(*aggs)
    return per_mid.join(ml, "mid").select("merchant_id", *[a for a in per_mid.columns if a != "mid"])


def session_rollup_asof(tables: Tables, as_of: dt.date, min_txns: int = 5, lookback: int = 31) -> DataFrame:
    """All events: w1 / m1 sums of per-day non-null session counts (not distinct)."""
    ml = _active_mids(tables, as_of, min_txns)
    ev = tables.since("app_event", "created_at", as_of - dt.timedelta(days=lookback))
    ev = ev.join(ml.select("mid"), "mid", "left_semi")
    app1 = ev.groupBy("mid", F.to_date("created_at").alias("day")).agg(F.count("session_id").alias("sessions"))
    od = F.lit(as_of).cast("date")
    app2 = app1.groupBy("mid").agg(
        *[
            F.sum(F.when(in_window(F.col("day"), od, w), F.col("sessions")).otherwise(0)).cast("bigint").alias(f"{w}_sessions")
            for w in ("w1", "m1")
        ]
    )
    return app2.join(ml, "mid").select("merchant_id", "w1_sessions", "m1_sessions")
