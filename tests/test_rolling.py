import datetime as dt
from decimal import Decimal

from helpers import D, tables, ts

from tillpoint.config import ProductSpec
from tillpoint.operators import cohort, rolling

SPEC = ProductSpec(name="swipe", task_ids=(16,), date_floor=D(2000, 1, 1))


def _tx(rows):
    # (id, merchant, amount, ts, payer, status)
    return [(i, m, Decimal(str(a)), t, p, "SUCCESS") for i, m, a, t, p in rows]


def test_anchor_day_and_window_edges(spark):
    od = dt.date(2001, 3, 10)
    t = tables(
        spark,
        application=[(1, ts(2001, 3, 10), ts(2001, 3, 10), "ORDERED")],
        transactions=_tx([
            (1, 1, 10.0, ts(2001, 3, 10), "a"),  # anchor day: outside every window
            (2, 1, 20.0, ts(2001, 3, 3), "b"),  # anchor - 7: w1
            (3, 1, 40.0, ts(2001, 3, 2), "c"),  # anchor - 8: w2
        ]),
    )
    r = rolling.txn_features_train(t, SPEC).first()
    assert r.w1_tpv == 20.0 and r.w2_tpv == 40.0 and r.total_tpv == 60.0
    assert r.w1_txn_count == 1 and r.w2_txn_count == 1 and r.total_txn_count == 2
    assert r.w1_unique_payers == 1 and r.total_unique_payers == 2
    assert od


def test_same_id_two_days_distinct_vs_daily_sum(spark):
    t = tables(
        spark,
        application=[(1, ts(2001, 3, 10), ts(2001, 3, 10), "ORDERED")],
        transactions=_tx([(7, 1, 5.0, ts(2001, 3, 5), "a"), (7, 1, 5.0, ts(2001, 3, 6), "a")]),
    )
    train = rolling.txn_features_train(t, SPEC).first()
    assert train.w1_txn_count == 1  # window-distinct
    asof = rolling.rolling_features(rolling.successful_transactions(t), as_of=D(2001, 3, 10), txn_count="daily_sum").first()
    assert asof.w1_txn_count == 2  # sum of per-day distinct counts


def test_day_of_month_active_days(spark):
    # anchor 2001-03-10: m1 = [Feb 8, Mar 10); Feb 8 and Mar 8 share day 8
    t = tables(
        spark,
        application=[(1, ts(2001, 3, 10), ts(2001, 3, 10), "ORDERED")],
        transactions=_tx([(1, 1, 1.0, ts(2001, 2, 8), "a"), (2, 1, 1.0, ts(2001, 3, 8), "a")]),
    )
    r = rolling.txn_features_train(t, SPEC).first()
    assert r.m1_active_days == 1 and r.total_active_vintage == 2


def test_two_push_anchors_reference_vs_earliest(spark):
    t = tables(
        spark,
        task_history_v1=[(1, ts(2001, 1, 10), 16)],
        task_history_v2=[(1, ts(2001, 2, 10), 16)],
        transactions=_tx([(1, 1, 10.0, ts(2001, 1, 5), "a"), (2, 1, 10.0, ts(2001, 2, 5), "b")]),
    )
    ref = cohort.anchor_dates(t, SPEC, mode="reference").collect()
    assert sorted(r.order_date for r in ref) == [D(2001, 1, 10), D(2001, 2, 10)]
    assert cohort.anchor_dates(t, SPEC, mode="earliest").first().order_date == D(2001, 1, 10)
    r = rolling.txn_features_train(t, SPEC, anchor_mode="reference").first()
    # w1 of either anchor: Jan 5 is in w1 of Jan 10, Feb 5 in w1 of Feb 10
    assert r.w1_txn_count == 2 and r.total_active_vintage == 2
    # sums add over anchor rows: Jan 5 precedes both anchors, Feb 5 only the second
    assert r.total_tpv == 30.0


def test_null_order_date_falls_back_to_push_date(spark):
    t = tables(
        spark,
        application=[(1, ts(2001, 1, 1), None, "ORDERED")],
        task_history_v1=[(1, ts(2001, 1, 20), 16)],
    )
    a = cohort.anchor_dates(t, SPEC, mode="reference").collect()
    assert [(r.merchant_id, r.order_date) for r in a] == [(1, D(2001, 1, 20))]


def test_push_conversion_window(spark):
    t = tables(
        spark,
        application=[(1, ts(2001, 1, 10), ts(2001, 1, 10), "ORDERED"), (2, ts(2001, 1, 10), ts(2001, 1, 10), "ORDERED")],
        task_history_v1=[(1, ts(2001, 1, 10), 16), (2, ts(2001, 1, 3), 16)],
    )
    got = sorted(r.merchant_id for r in cohort.push_converted(t, SPEC, 7).collect())
    assert got == [1]  # anchor day converts, anchor - 7 does not


def test_masks_equal_brute_force(spark):
    """All 35 features on random rows: several anchors, rows on and after them, null payers, ids and
    days, and merchants with rows outside every window only."""
    import random

    from tillpoint.config import MONTH_WINDOWS, PAYER_WINDOWS, TPV_WINDOWS, TXN_WINDOWS, WINDOWS, feature_name

    rng = random.Random(12)
    base = dt.date(2001, 6, 1)
    anchors = {m: sorted({base + dt.timedelta(days=rng.randint(-40, 40)) for _ in range(rng.randint(1, 2))}) for m in range(1, 7)}
    tasks = [[(m, dt.datetime.combine(a[k % len(a)], dt.time(9)), 16) for m, a in anchors.items()] for k in range(2)]
    rows = []
    for _ in range(900):
        m = rng.choice([1, 1, 1, 2, 3, 4, 5, 9])  # 6 has no rows, 9 no anchor
        after = m == 5
        day = base + dt.timedelta(days=rng.randint(45, 90) if after else rng.randint(-200, 60))
        rows.append((
            rng.choice([None, *range(1, 120)]), m, rng.randint(1, 90),
            None if rng.random() < 0.02 else dt.datetime.combine(day, dt.time(rng.randint(0, 23))), rng.choice([None, *"abcdefgh"]),
        ))
    t = tables(spark, task_history_v1=tasks[0], task_history_v2=tasks[1], transactions=_tx(rows))

    def hit(day, od, w):
        w = WINDOWS[w]
        low = w.start is None or day >= od - dt.timedelta(days=w.start)
        return low and day < od - dt.timedelta(days=w.end)

    want = {}
    for m, ods in anchors.items():
        own = [(i, a, t.date() if t else None, u) for i, k, a, t, u in rows if k == m]
        if not own:
            continue
        own_days = [r for r in own if r[2] is not None]
        f = {}
        seen = lambda col, w: len({r[col] for r in own_days for od in ods if r[col] is not None and hit(r[2], od, w)})
        for w in PAYER_WINDOWS:
            f[feature_name("unique_payers", w)] = seen(3, w)
        for w in TXN_WINDOWS:
            f[feature_name("txn_count", w)] = seen(0, w)
        f["total_active_vintage"] = len({r[2] for r in own_days if r[2] < max(ods)})
        daily = {}
        for i, a, day, u in own_days:
            x = daily.setdefault(day, [0, set(), set()])
            x[0] += a
            x[1] |= {i} - {None}
            x[2] |= {u} - {None}
        for w in TPV_WINDOWS:
            f[feature_name("tpv", w)] = float(sum(x[0] for day, x in daily.items() for od in ods if hit(day, od, w)))
        for w in MONTH_WINDOWS:
            days = [day for day in daily for od in ods if hit(day, od, w)]
            f[feature_name("active_days", w)] = len({day.day for day in days})
            f[feature_name("max_daily_tpv", w)] = float(max([daily[day][0] for day in days], default=0))
            f[feature_name("max_daily_txns", w)] = max([len(daily[day][1]) for day in days], default=0)
            f[feature_name("max_daily_payees", w)] = max([len(daily[day][2]) for day in days], default=0)
        want[m] = f
    got = {r.merchant_id: {k: r[k] for k in want[1]} for r in rolling.txn_features_train(t, SPEC, "reference").collect()}
    assert got == want
    assert set(want[5].values()) == {0, 0.0}  # kept, though all its rows are after the anchors


def test_old_days_fold_into_spans(spark, monkeypatch):
    """Days before every month window leave a row a span for the second aggregate, not a row a day,
    whichever of the merchant's anchors a copy is joined to; values stay those of the days."""
    first, last = dt.date(2001, 3, 10), dt.date(2001, 9, 1)  # a day near one anchor only is not folded
    days = [dt.date(1969, 11, 1), dt.date(1970, 2, 1)] + [dt.date(2000, 1, 1) + dt.timedelta(days=k) for k in range(0, 300)]
    near = [first - dt.timedelta(days=90), last - dt.timedelta(days=90), last - dt.timedelta(days=1)]
    tx = _tx([(k, 1, 2, dt.datetime.combine(d, dt.time(5)), f"p{k % 7}") for k, d in enumerate(days + days + near)])
    made = []
    inner = rolling._days_and_masks
    monkeypatch.setattr(rolling, "_days_and_masks", lambda *a, **k: made.append(inner(*a, **k)) or made[-1])
    t = tables(
        spark,
        task_history_v1=[(1, dt.datetime.combine(first, dt.time()), 16)],
        task_history_v2=[(1, dt.datetime.combine(last, dt.time()), 16)],
        transactions=tx,
    )
    r = rolling.txn_features_train(t, SPEC, "reference").first()
    assert made[0].count() < 30  # 3 near days, 9 spans, one row of cut ones, masks; 302 days before
    assert r.total_active_vintage == len(days) + 3
    assert r.total_tpv == 2.0 * (2 * 2 * len(days) + 2 + 1 + 1)  # the first near day is before both anchors
    assert r.total_txn_count == 2 * len(days) + 3 and r.total_unique_payers == 7
    assert r.tpv_90_days == 6.0 and r.txn_count_90_days == 3
    assert (r.m1_active_days, r.m3_active_days) == (1, 2)
