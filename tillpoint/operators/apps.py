"""Installed-app snapshot features and the Digital / Offline channel rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.config import (
    CHANNEL_MIN_RELEVANT_APPS,
    CHANNEL_MIN_W1_SESSIONS,
    RELEVANT_APPS,
)
from tillpoint.functions.stats import exact_quantiles
from tillpoint.operators import cohort, sessions
from tillpoint.operators.rolling import bounded_broadcast
from tillpoint.sources.sinks import stage
from tillpoint.sources.tables import Tables

APP_SCHEMA = "array<struct<appName:string,packageName:string>>"


def latest_app_snapshot(tables: Tables, as_of: dt.date, min_txns: int = 5) -> DataFrame:
    """Latest snapshot (all rows on the latest date, ties kept) of active merchants.

    Written as max-date aggregate + equi-join instead of a window partitioned by
    merchant, so a merchant with a very long snapshot history is reduced by
    partial aggregation rather than sorted in one task.
    """
    floor = cohort.ts_floor(tables.date_floor).cast("date")
    dump = tables.app_dump.filter(F.col("date") > floor)
    active = cohort.active_merchants(tables, as_of, min_txns=min_txns)
    dump = dump.join(bounded_broadcast(active, ["merchant_id"]), "merchant_id", "left_semi")
    latest = dump.groupBy("merchant_id").agg(F.max("date").alias("date"))
    return dump.join(latest, ["merchant_id", "date"]).select("merchant_id", "app_details")


def parse_app_list(details: Column, field: str = "appName") -> Column:
    """Field values of the list-of-records text; any parse failure -> [].

    The text is a quoted list: the first and last characters are dropped, the
    rest must be a list (``[...]``) or a run of at least two records
    (``{...}, {...}``); a lone record yields [] as in the source.  Records
    without the field make the whole list [].  Parsing is Spark's JSON reader
    (single quotes allowed), never an evaluator.
    """
    inner = F.trim(F.substring(details, F.lit(2), F.length(details) - F.lit(2)))
    as_list = F.when(inner.startswith("["), inner).when(inner.startswith("{"), F.concat(F.lit("["), inner, F.lit("]")))
    parsed = F.from_json(as_list, APP_SCHEMA)
    lone_record = inner.startswith("{") & (F.size(parsed) < 2)
    missing = F.exists(parsed, lambda x: x[field].isNull())
    values = F.transform(parsed, lambda x: x[field])
    empty = F.array().cast("array<string>")
    return F.when(parsed.isNull() | lone_record | missing, empty).otherwise(values)


def app_names(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumn("app_names", parse_app_list(F.col("app_details"), "appName"))


def package_names(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumn("package_names", parse_app_list(F.col("app_details"), "packageName"))


def app_features(
    tables: Tables, as_of: dt.date, min_txns: int = 5, relevant: tuple = RELEVANT_APPS
) -> DataFrame:
    """relevant_apps (distinct overlap with the fixed list), total_apps (with
    repeats) and the merchant's w1 sessions (all events, as-of rollup)."""
    snap = app_names(latest_app_snapshot(tables, as_of, min_txns))
    rel = F.array(*[F.lit(a) for a in relevant])
    feats = snap.select(
        "merchant_id",
        "app_names",
        F.size(F.array_intersect(F.col("app_names"), rel)).cast("bigint").alias("relevant_apps"),
        F.size(F.col("app_names")).cast("bigint").alias("total_apps"),
    )
    w1 = sessions.session_rollup_asof(tables, as_of, min_txns).select("merchant_id", "w1_sessions")
    return feats.join(w1, "merchant_id", "left")


def app_frequency(features: DataFrame) -> DataFrame:
    """How many snapshot rows list each app name (repeats counted)."""
    return features.select(F.explode("app_names").alias("app")).groupBy("app").agg(F.count(F.lit(1)).alias("n"))


def top_apps(freq: DataFrame, k: int = 5) -> DataFrame:
    return freq.orderBy(F.col("n").desc(), F.col("app").asc()).limit(k)


def quartile_bin(value: Column, edges: list[float | None]) -> Column:
    """Right-closed bin index over the distinct sorted edges; values equal to
    the first edge (the minimum) or outside the range get NULL."""
    e = sorted({x for x in edges if x is not None})
    out = F.lit(None).cast("bigint")
    for k, (lo, hi) in reversed(list(enumerate(zip(e, e[1:])))):
        out = F.when((value > lo) & (value <= hi), F.lit(k + 1).cast("bigint")).otherwise(out)
    return out


def quartile_bins(
    features: DataFrame, cols: tuple[str, ...] = ("w1_sessions", "total_apps", "relevant_apps")
) -> DataFrame:
    """``features`` with the quartile bin of every column; the rows are staged, as the edges
    are found in them first."""
    features = stage(features)
    edges = exact_quantiles(features, cols)
    return features.select("*", *[quartile_bin(F.col(c).cast("double"), edges[c]).alias(f"{c}_bin") for c in cols])


def app_session_pivot(binned: DataFrame) -> DataFrame:
    """Distinct merchants by (w1_sessions bin) x (relevant_apps bin)."""
    return (
        binned.filter(F.col("w1_sessions_bin").isNotNull() & F.col("relevant_apps_bin").isNotNull())
        .groupBy("w1_sessions_bin")
        .pivot("relevant_apps_bin", [1, 2, 3, 4])
        .agg(F.count_distinct("merchant_id"))
        .select(
            "w1_sessions_bin",
            *[F.col(str(i)).alias(f"relevant_bin_{i}") for i in (1, 2, 3, 4)],
        )
    )


def channel(features: DataFrame, min_relevant: int = CHANNEL_MIN_RELEVANT_APPS, min_w1: int = CHANNEL_MIN_W1_SESSIONS) -> DataFrame:
    rule = (F.col("relevant_apps") >= min_relevant) & (F.col("w1_sessions") >= min_w1)
    return features.withColumn("Channel", F.when(rule, F.lit("Digital")).otherwise(F.lit("Offline")))


def digital_merchants(features: DataFrame, **kw) -> DataFrame:
    return channel(features, **kw).filter(F.col("Channel") == "Digital").select("merchant_id")


def channel_label(merchants: DataFrame, digital: DataFrame) -> DataFrame:
    """Existence join: Digital when listed, else Offline."""
    d = digital.select("merchant_id").distinct().withColumn("_d", F.lit(1))
    return merchants.join(d, "merchant_id", "left").withColumn(
        "Channel", F.when(F.col("_d").isNotNull(), F.lit("Digital")).otherwise(F.lit("Offline"))
    ).drop("_d")
