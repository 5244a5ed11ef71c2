"""Anchor-dated rolling-window activity features (the 35-feature family).

Windows are day ranges relative to an anchor date (``config.WINDOWS``).  Two
anchor sources exist:

* training: per-merchant anchor rows from :func:`cohort.anchor_dates`
  (possibly several rows per merchant, which the features aggregate over);
* scoring ("as of"): one literal date for everybody.

Plan shape (no ``Expand`` with one projection per distinct aggregate):

* ``daily``: one row per (merchant, day) with value, distinct payers and
  distinct ids of the day - Spark's distinct-aggregate rewrite with two
  distinct columns, partially aggregated before the shuffle.
* window sums / maxima are taken over ``daily`` (joined to the anchors).
* every *window-distinct* count (payers, ids, sessions) is a two-level aggregate:
  one integer per (merchant, entity) holds a bit for each window the entity was
  seen in (``window_mask``, merged by ``bit_or``), and a merchant counts the bits.
  Both levels are hash aggregates with map-side partial aggregation, the first
  keyed by (merchant, entity), so one merchant holding a third of all rows is
  spread across tasks rather than landing in one.
* the ids and payers of a single day are only grouped for days that a month window can
  hold; earlier days fold into spans of 48 days, one bit a day and one value a span.
* rows outside every window carry no entity, day or value past the scan: they fold
  into one row per merchant map-side, which keeps the merchant in the result.
* the anchors are joined with a size-checked broadcast (see
  :func:`bounded_broadcast`); beyond the bound the join is a sort-merge join
  that AQE's skew-join handling splits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.config import (
    MONTH_WINDOWS,
    ROLLING_FEATURES,
    PAYER_WINDOWS,
    TPV_WINDOWS,
    TXN_WINDOWS,
    WINDOWS,
    ProductSpec,
    feature_name,
)
from tillpoint.functions.windows import in_window
from tillpoint.operators import cohort
from tillpoint.sources.sinks import stage, staged_rows
from tillpoint.sources.tables import Tables

# Upper bound on the in-memory size of a frame that may be broadcast.  The
# size is estimated from the row count and the column types, so the bound
# holds whatever the frame's width; above it the join is shuffled instead.
BROADCAST_MAX_BYTES = 256 * 1024 * 1024

_TYPE_BYTES = {
    "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "int": 4, "date": 4,
    "float": 4, "smallint": 2, "tinyint": 1, "boolean": 1,
}


def estimated_row_bytes(df: DataFrame) -> int:
    """Hash-relation row size estimate: fixed widths by type, 32 bytes for
    strings and other variable-width values, 16 bytes of row overhead."""
    return 16 + sum(_TYPE_BYTES.get(f.dataType.simpleString(), 32) for f in df.schema.fields)


def bounded_broadcast(df: DataFrame, cols: list[str] | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only after checking its size against a bound.

    The frame (anchors, cohort lists: merchant-level) is staged first (parquet
    in the shared checkpoint folder; the staging write also counts its rows),
    so the join that follows does not recompute it.  Above the bound the frame
    is returned unhinted and Spark plans a shuffled join, which AQE can still
    convert or skew-split at runtime.
    """
    df = stage(df)
    n = staged_rows(df)
    if n is None:
        n = df.count()
    out = df.select(*cols) if cols else df
    return F.broadcast(out) if n * estimated_row_bytes(out) <= max_bytes else out


def successful_transactions(tables: Tables) -> DataFrame:
    """(merchant_id, id, user, amount, payment_date) of SUCCESS payments."""
    return tables.transactions.filter(F.col("status") == "SUCCESS").select(
        "merchant_id",
        "id",
        F.col("payer_vpa_hash").alias("user"),
        "amount",
        F.to_date("payment_timestamp").alias("payment_date"),
    )


def daily_rollup(tx: DataFrame, payees: bool = True) -> DataFrame:
    """(merchant_id, payment_date) -> daily_tpv, daily_txns[, daily_payees].

    Without ``payees``: group by (merchant, day, id) then (merchant, day).
    With it: one ``GROUPING SETS ((merchant, day, id), (merchant, day, user))``
    pass (one scan, one partially aggregated shuffle) and a second aggregate
    per (merchant, day) that counts the rows of each set.
    """
    if not payees:
        per_id = tx.groupBy("merchant_id", "payment_date", "id").agg(F.sum("amount").alias("_amt"))
        return per_id.groupBy("merchant_id", "payment_date").agg(
            F.sum("_amt").alias("daily_tpv"), F.count("id").alias("daily_txns")
        )
    g = tx.groupingSets(
        [["merchant_id", "payment_date", "id"], ["merchant_id", "payment_date", "user"]],
        "merchant_id",
        "payment_date",
        "id",
        "user",
    ).agg(F.grouping_id("merchant_id", "payment_date", "id", "user").alias("_g"), F.sum("amount").alias("_amt"))
    # _g: id set -> user aggregated (01 = 1); user set -> id aggregated (10 = 2)
    is_id = (F.col("_g") == 1) & F.col("id").isNotNull()
    is_user = (F.col("_g") == 2) & F.col("user").isNotNull()
    return g.groupBy("merchant_id", "payment_date").agg(
        F.sum(F.when(F.col("_g") == 1, F.col("_amt"))).alias("daily_tpv"),
        F.count(F.when(is_id, 1)).alias("daily_txns"),
        F.count(F.when(is_user, 1)).alias("daily_payees"),
    )


def window_mask(day: Column, anchor: Column, windows: Iterable[str]) -> Column:
    """An integer with bit k set if ``day`` is in the k-th window; 0 for a NULL day or anchor."""
    bits = [F.when(in_window(day, anchor, w), F.lit(1 << k)).otherwise(F.lit(0)) for k, w in enumerate(windows)]
    return reduce(Column.bitwiseOR, bits)


def _has(mask: Column, windows: Iterable[str], window: str) -> Column:
    return mask.bitwiseAND(F.lit(1 << list(windows).index(window))) != 0


def window_distinct_counts(
    rows: DataFrame,
    key: Column,
    day: Column,
    anchor: Column,
    windows: dict[str, str],
    by: Sequence[str] = ("merchant_id",),
    keep_groups: bool = False,
) -> DataFrame:
    """Exact ``COUNT(DISTINCT CASE WHEN in_window THEN key END)`` per group for several
    windows at once: one window mask per (group, key), then the bits are counted.

    ``rows`` has one row per (group, key, day, anchor) occurrence; NULL keys never count.
    ``windows`` maps output name -> window name.  Rows in no window are cut before the
    shuffle; with ``keep_groups`` they leave one row per group, so every group of ``rows``
    is in the result.
    """
    order = list(dict.fromkeys(windows.values()))
    marked = rows.select(*by, key.alias("_key"), window_mask(day, anchor, order).alias("_mask"))
    live = F.col("_key").isNotNull() & (F.col("_mask") != 0)
    if keep_groups:
        marked = marked.select(*by, F.when(live, F.col("_key")).alias("_key"), F.when(live, F.col("_mask")).otherwise(0).alias("_mask"))
    else:
        marked = marked.filter(live)
    seen = marked.groupBy(*by, "_key").agg(F.bit_or("_mask").alias("_mask"))
    return seen.groupBy(*by).agg(*[F.count_if(_has(F.col("_mask"), order, w)).alias(n) for n, w in windows.items()])


#: Days of one folded span: its days are the bits above the windows' in a 64-bit mask.
SPAN_DAYS = 48


def _cut_rows(tx: DataFrame, live: Column, near: Column, mask: Column, amount: Column, fold: bool) -> DataFrame:
    """``tx`` for the grouping sets: a row that is not ``live`` keeps its merchant only, so all of
    them fold into one row per merchant and set map-side.

    ``near``: whether a month window of any anchor can hold the day; only there are the day's
    own ids and payers asked for (``_day``, ``_user``).  With ``fold``, days that are not near
    keep no id of the day (``_id``) and fold into spans: ``payment_date`` is the span's first
    day and the mask has a bit for the day above those of the windows."""
    keep = F.coalesce(live, F.lit(False))
    near = keep & F.coalesce(near, F.lit(False))
    day, mask = F.col("payment_date"), mask.cast("bigint")
    if fold:
        place = F.pmod(F.unix_date(day), F.lit(SPAN_DAYS))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place + len(MASK_WINDOWS))
        mask = F.when(near, mask).otherwise(mask.bitwiseOR(bit))
        day = F.when(near, day).otherwise(F.date_sub(day, place))
    return tx.select(
        "merchant_id",
        F.when(keep, day).alias("payment_date"),
        F.when(near if fold else keep, F.col("id")).alias("_id"),
        F.when(near, F.col("payment_date")).alias("_day"),
        F.when(near, F.col("user")).alias("_user"),
        *[F.when(keep, F.col(c)).alias(c) for c in ("id", "user")],
        F.when(keep, amount).alias("_amount"),
        F.when(keep, mask).otherwise(0).alias("_mask"),
    )


def _days_and_masks(cut: DataFrame, id_windows: bool) -> DataFrame:
    """Daily rollup AND window masks of payers (and ids) from ONE scan, as a linear chain of two
    aggregates (no branch, so nothing is recomputed).

    Level 1 is ``GROUPING SETS`` (columns as in :func:`_cut_rows`):

    * (merchant, day or span, id of the day): value of the id that day, or of the span
    * (merchant, near day, its payer): one row per payer and day
    * (merchant, user)[, (merchant, id)]: the windows the entity was seen in, as one mask

    Level 2 has a row per (merchant, day) with daily value / distinct ids / distinct payers,
    a row per (merchant, span) with its value and its days as bits (``_kind`` 1, ``_mask``),
    and a row per merchant, kind of entity and mask with the number of entities (``_kind``,
    ``_mask``, ``_n``; these have no day).
    """
    order = ("merchant_id", "payment_date", "_id", "_day", "_user", "user", "id")
    sets = [["merchant_id", "payment_date", "_id"], ["merchant_id", "_day", "_user"], ["merchant_id", "user"]]
    if id_windows:
        sets.append(["merchant_id", "id"])
    else:  # no set has it
        order, cut = order[:-1], cut.drop("id")
    ids = [sum(1 << k for k, c in enumerate(reversed(order)) if c not in x) for x in sets]
    g = cut.groupingSets(sets, *order).agg(
        F.grouping_id(*order).alias("_g"),
        F.sum("_amount").alias("_amt"),
        F.bit_or("_mask").alias("_seen"),
    )
    g1, g2, g6 = (F.col("_g") == x for x in ids[:3])
    windows = len(MASK_WINDOWS)
    days = F.call_function("shiftright", F.col("_seen"), F.lit(windows))
    seen = F.col("_seen").bitwiseAND(F.lit((1 << windows) - 1))
    counted = g6 & F.col("user").isNotNull()  # NULL ids / payers never count
    kind = F.when(g6, 6)
    if id_windows:
        g5 = F.col("_g") == ids[3]
        counted, kind = counted | (g5 & F.col("id").isNotNull()), kind.when(g5, 5)
    rows = g.select(
        "merchant_id",
        F.coalesce("payment_date", "_day").alias("payment_date"),
        kind.when(g1 & (days != 0), 1).alias("_kind"),
        F.when(g1 & (days != 0), days).when(~g1 & ~g2, seen).alias("_mask"),
        F.when(g1, F.col("_amt")).alias("_amt"),
        (g1 & F.col("_id").isNotNull()).alias("_is_id"),
        (g2 & F.col("_user").isNotNull()).alias("_is_user"),
        counted.alias("_counted"),
    )
    return rows.groupBy("merchant_id", "payment_date", "_kind", "_mask").agg(
        F.sum("_amt").alias("daily_tpv"),
        F.count(F.when(F.col("_is_id"), 1)).alias("daily_txns"),
        F.count(F.when(F.col("_is_user"), 1)).alias("daily_payees"),
        F.count(F.when(F.col("_counted"), 1)).alias("_n"),
    )


def _unpacked(order: Sequence[str], id_windows: bool, once: Column | None = None) -> list[Column]:
    """Per merchant: entities whose mask has the window's bit, for payers (and ids).  ``once``:
    which of several copies of a row counts."""
    out = []
    for kind, measure, names in ((6, "unique_payers", PAYER_WINDOWS), (5, "txn_count", TXN_WINDOWS if id_windows else ())):
        for n, w in _names(measure, names).items():
            hit = (F.col("_kind") == kind) & _has(F.col("_mask"), order, w)
            hit = hit if once is None else hit & once
            out.append(F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).cast("bigint").alias(n))
    return out


#: The windows of an entity's mask, one bit each.
MASK_WINDOWS = tuple(dict.fromkeys((*PAYER_WINDOWS, *TXN_WINDOWS)))
#: How far back any window but ``total`` reaches.
NEAR_DAYS = max(w.start for w in WINDOWS.values() if w.start is not None)


def _names(measure: str, windows: Iterable[str]) -> dict[str, str]:
    return {feature_name(measure, w): w for w in windows}


def _daily_features(
    daily_anchored: DataFrame, txn_from_daily: bool, one_row_per_day: bool, payees: bool = True, extra=(), folded: bool = False
) -> DataFrame:
    """Every day-level feature in one aggregate over (day, anchor) rows of ``daily``.  ``folded``:
    with the spans of :func:`_days_and_masks`, which are before all windows but ``total``.

    * sums / maxima: plain conditional aggregates;
    * active days (distinct day-of-month in a 30-day window): one bit per day of
      the month, so the whole aggregate stays a hash aggregate over fixed-width rows;
    * active vintage (distinct dates before the anchor): a conditional count
      when the frame has one row per day (scoring), else a distinct count.
    """
    d, od = F.col("payment_date"), F.col("order_date")
    day_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(d))
    aggs = []
    if txn_from_daily:
        aggs += [
            F.sum(F.when(in_window(d, od, w), F.col("daily_txns")).otherwise(0)).cast("bigint").alias(n)
            for n, w in _names("txn_count", TXN_WINDOWS).items()
        ]
    if one_row_per_day:
        aggs.append(F.count(F.when(d < od, 1)).cast("bigint").alias("total_active_vintage"))
    else:
        # a date counts when it precedes any anchor, i.e. the latest one; the
        # rank-1 anchor row stands for the merchant so each day counts once
        first = F.col("_anchor_rank") == 1
        days = F.when(F.col("_kind") == 1, F.bit_count("_mask")).otherwise(1) if folded else F.lit(1)
        before = F.sum(F.when(first & (d < F.col("_max_od")), days))
        aggs.append(F.coalesce(before, F.lit(0)).cast("bigint").alias("total_active_vintage"))
    aggs += [
        F.sum(F.when(in_window(d, od, w), F.col("daily_tpv")).otherwise(0)).cast("double").alias(n)
        for n, w in _names("tpv", TPV_WINDOWS).items()
    ]
    aggs += [
        F.coalesce(F.bit_count(F.bit_or(F.when(in_window(d, od, w), day_bit))), F.lit(0)).cast("bigint").alias(n)
        for n, w in _names("active_days", MONTH_WINDOWS).items()
    ]
    maxes = [("max_daily_tpv", "daily_tpv", "double")]
    if payees:
        maxes.append(("max_daily_payees", "daily_payees", "bigint"))
    maxes.append(("max_daily_txns", "daily_txns", "bigint"))
    for measure, col, typ in maxes:
        aggs += [
            F.max(F.when(in_window(d, od, w), F.col(col)).otherwise(0)).cast(typ).alias(n)
            for n, w in _names(measure, MONTH_WINDOWS).items()
        ]
    return daily_anchored.groupBy("merchant_id").agg(*aggs, *extra)


def rolling_features(
    tx: DataFrame,
    anchors: DataFrame | None = None,
    as_of: dt.date | None = None,
    txn_count: str = "distinct",
    broadcast_anchors: bool = True,
) -> DataFrame:
    """The 35 rolling features per merchant.

    Exactly one of ``anchors`` (merchant_id, order_date rows) or ``as_of``.
    ``txn_count='distinct'`` counts distinct ids per window (training);
    ``'daily_sum'`` sums the per-day distinct counts (scoring).
    Output: merchants having at least one row in ``tx`` (and an anchor row).
    """
    if anchors is not None:
        per_merchant = Window.partitionBy("merchant_id")  # <= a few anchor rows each
        a = anchors.select(
            "merchant_id",
            "order_date",
            F.row_number().over(per_merchant.orderBy("order_date")).alias("_anchor_rank"),
            F.max("order_date").over(per_merchant).alias("_max_od"),
            F.min("order_date").over(per_merchant).alias("_min_od"),
        )
        if broadcast_anchors:
            a = bounded_broadcast(a)
        tx_a = tx.join(a, "merchant_id")  # inner: also cuts the facts to the cohort
        if txn_count == "distinct":
            # days count once (rank-1 copy); a row before any anchor is before the latest one
            d, od = F.col("payment_date"), F.col("order_date")
            first = F.col("_anchor_rank") == 1
            # the same for all copies of a row, so a day is whole or in a span
            near = d >= F.date_sub(F.col("_min_od"), NEAR_DAYS)
            mask = window_mask(d, od, MASK_WINDOWS)
            cut = _cut_rows(tx_a, d < F.col("_max_od"), near, mask, F.when(first, F.col("amount")), fold=True)
            base = _daily_features(
                _days_and_masks(cut, id_windows=True).join(a, "merchant_id"), txn_from_daily=False, one_row_per_day=False,
                extra=_unpacked(MASK_WINDOWS, True, once=first), folded=True,
            )
            return _assemble(base, [])
        daily_a = daily_rollup(tx.join(a, "merchant_id", "left_semi")).join(a, "merchant_id")
    else:
        lit = F.lit(as_of).cast("date").alias("order_date")
        daily_a = daily_rollup(tx).select("*", lit)
        tx_a = tx.select("*", lit)
    d, od = F.col("payment_date"), F.col("order_date")
    base = _daily_features(
        daily_a, txn_from_daily=(txn_count == "daily_sum"), one_row_per_day=(anchors is None)
    )
    parts = [window_distinct_counts(tx_a, F.col("user"), d, od, _names("unique_payers", PAYER_WINDOWS))]
    if txn_count == "distinct":
        parts.append(window_distinct_counts(tx_a, F.col("id"), d, od, _names("txn_count", TXN_WINDOWS)))
    return _assemble(base, parts)


def _assemble(base: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Left-join the window-distinct parts onto the day-level features; a
    merchant with no qualifying rows in a part gets 0."""
    out = base
    zero_fill: list[str] = []
    for p in parts:
        out = out.join(p, "merchant_id", "left")
        zero_fill += [c for c in p.columns if c != "merchant_id"]
    return out.select(
        "merchant_id",
        *[
            F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) if c in zero_fill else F.col(c)
            for c in ROLLING_FEATURES
        ],
    )


def txn_features_train(tables: Tables, spec: ProductSpec, anchor_mode: str = "earliest") -> DataFrame:
    """Training features at each merchant's anchor date (applied ∪ pushed cohort)."""
    anchors = cohort.anchor_dates(tables, spec, mode=anchor_mode)
    tx = successful_transactions(tables)
    return rolling_features(tx, anchors=anchors, txn_count="distinct")


def _active_tx(tables: Tables, as_of: dt.date, min_txns: int, date_floor: dt.date | None = None) -> DataFrame:
    active = cohort.active_merchants(
        tables, as_of, min_txns=min_txns, with_mart=True, date_floor=date_floor or tables.date_floor
    )
    return successful_transactions(tables).join(bounded_broadcast(active, ["merchant_id"]), "merchant_id", "left_semi")


def txn_features_asof(tables: Tables, as_of: dt.date, min_txns: int = 5) -> DataFrame:
    """Scoring: 25 transaction features as of ``as_of`` for the active base.

    Plan: successful transactions semi-joined to the (staged, size-checked,
    broadcast) active list -> daily rollup (one shuffle, partially aggregated
    map-side) -> one aggregate per merchant.
    """
    tx = _active_tx(tables, as_of, min_txns)
    daily = daily_rollup(tx, payees=False).select("*", F.lit(as_of).cast("date").alias("order_date"))
    base = _daily_features(daily, txn_from_daily=True, one_row_per_day=True, payees=False)
    cols = (
        list(_names("txn_count", TXN_WINDOWS))
        + ["total_active_vintage"]
        + list(_names("tpv", TPV_WINDOWS))
        + list(_names("active_days", MONTH_WINDOWS))
        + list(_names("max_daily_tpv", MONTH_WINDOWS))
        + list(_names("max_daily_txns", MONTH_WINDOWS))
    )
    return base.select("merchant_id", *cols)


def activity_features_asof(tables: Tables, as_of: dt.date, min_txns: int = 5) -> DataFrame:
    """All 35 as-of features (transaction, payer and daily-peak families) from
    ONE scan of the active base's transactions (``_days_and_masks``, then one aggregate per
    merchant).  Same values as txn_ + payer_ + max_daily_payers_features_asof.
    """
    tx = _active_tx(tables, as_of, min_txns)
    od = F.lit(as_of).cast("date")
    d = F.col("payment_date")
    near = d >= F.date_sub(od, NEAR_DAYS)
    # days' ids count in every window here, so no days are folded
    cut = _cut_rows(tx, d < od, near, window_mask(d, od, MASK_WINDOWS), F.col("amount"), fold=False)
    base = _daily_features(
        _days_and_masks(cut, id_windows=False).select("*", od.alias("order_date")),
        txn_from_daily=True,
        one_row_per_day=True,  # the rows of masks have no day and never count as days
        extra=_unpacked(MASK_WINDOWS, False),
    )
    return _assemble(base, [])


def payer_features_asof(tables: Tables, as_of: dt.date, min_txns: int = 5) -> DataFrame:
    """Scoring: distinct payers per window (true window distinct), from one scan; a merchant whose
    rows are all outside the windows has zeros."""
    tx = _active_tx(tables, as_of, min_txns)
    od = F.lit(as_of).cast("date")
    names = _names("unique_payers", PAYER_WINDOWS)
    return window_distinct_counts(tx, F.col("user"), F.col("payment_date"), od, names, keep_groups=True)


def max_daily_payers_asof(tables: Tables, as_of: dt.date, min_txns: int = 5) -> DataFrame:
    """Scoring: peak daily distinct payers per month window."""
    tx = _active_tx(tables, as_of, min_txns)
    daily = tx.groupBy("merchant_id", "payment_date").agg(F.count_distinct("user").alias("daily_payees"))
    d, od = F.col("payment_date"), F.lit(as_of).cast("date")
    return daily.groupBy("merchant_id").agg(
        *[
            F.max(F.when(in_window(d, od, w), F.col("daily_payees")).otherwise(0)).cast("bigint").alias(n)
            for n, w in _names("max_daily_payees", MONTH_WINDOWS).items()
        ]
    )


def daily_rollup_active(tables: Tables, as_of: dt.date, min_txns: int = 5) -> DataFrame:
    """The (merchant, day) rollup of the active base, value as double."""
    d = daily_rollup(_active_tx(tables, as_of, min_txns))
    return d.select(
        "merchant_id",
        "payment_date",
        F.col("daily_tpv").cast("double").alias("daily_tpv"),
        "daily_payees",
        "daily_txns",
    )
