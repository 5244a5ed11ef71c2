import datetime as dt

from helpers import D, tables, ts

from tillpoint.config import ProductSpec
from tillpoint.operators import apps, sessions

SPEC = ProductSpec(name="swipe", task_ids=(16,), events=("view",), date_floor=D(2000, 1, 1))
AS_OF = D(2001, 8, 1)


def _mart(spark, ids):
    from pyspark.sql import functions as F

    rows = [(i, str(i), dt.datetime(2001, 1, 5)) for i in ids]
    return spark.createDataFrame(rows, "merchant_id long, mid string, merchant_created_at timestamp_ntz").withColumn(
        "merchant_created_at", F.col("merchant_created_at")
    )


def _tx(n, merchant=1, day=dt.datetime(2001, 7, 20)):
    from decimal import Decimal

    return [(i, merchant, Decimal("100.00"), day, f"p{i}", "SUCCESS") for i in range(n)]


def test_asof_sessions_sum_daily_distinct_and_null_sessions(spark):
    ev = [
        ("1", dt.datetime(2001, 7, 30, 10), "s1", "Web", "view"),
        ("1", dt.datetime(2001, 7, 30, 11), "s1", "MerchantApp", "view"),  # same session, same day: once
        ("1", dt.datetime(2001, 7, 29, 11), "s1", "MerchantApp", "view"),  # same session, other day: again
        ("1", dt.datetime(2001, 7, 29, 12), None, "MerchantApp", "view"),  # NULL session never counts
        ("1", dt.datetime(2001, 7, 28, 12), "s9", "MerchantApp", "click"),  # other product
    ]
    t = tables(spark, transactions=_tx(6), app_event=ev, merchant_mart=_mart(spark, [1]))
    r = sessions.session_features_asof(t, AS_OF, {"swipe": ("view",), "speaker": ("click",)}, min_txns=5).first()
    assert (r.w1_swipe_sessions, r.m1_swipe_sessions, r.w1_speaker_sessions) == (2, 2, 1)
    roll = sessions.session_rollup_asof(t, AS_OF, min_txns=5).first()
    assert roll.w1_sessions == 4  # plain non-null count per day, summed


def test_latest_snapshot_keeps_ties(spark):
    dump = [
        (1, D(2001, 7, 1), "\"[{'appName': 'Paytm', 'packageName': 'a'}, {'appName': 'CRED', 'packageName': 'b'}]\""),
        (1, D(2001, 7, 2), "\"[{'appName': 'GPay', 'packageName': 'a'}, {'appName': 'CRED', 'packageName': 'b'}]\""),
        (1, D(2001, 7, 2), "\"[{'appName': 'BHIM', 'packageName': 'a'}, {'appName': 'BHIM', 'packageName': 'b'}]\""),
    ]
    t = tables(spark, transactions=_tx(6), app_dump=dump, merchant_mart=_mart(spark, [1]))
    snap = apps.latest_app_snapshot(t, AS_OF, min_txns=5).collect()
    assert len(snap) == 2
    f = apps.app_names(apps.latest_app_snapshot(t, AS_OF, min_txns=5))
    names = sorted(tuple(r.app_names) for r in f.collect())
    assert names == [("BHIM", "BHIM"), ("GPay", "CRED")]


def test_year_slices_in_one_pass(spark):
    """Merchants and events meet only inside a slice; w1 = 0 in a slice drops its m1 too."""
    import pytest

    day = lambda y, m, d: dt.datetime(y, m, d, 10)
    mart = spark.createDataFrame(
        [(1, "1", day(2000, 5, 1)), (2, "2", day(2001, 2, 1)), (3, "3", day(2002, 1, 1))],
        "merchant_id long, mid string, merchant_created_at timestamp_ntz",
    )
    app = [(m, ts(2001, 3, 10), ts(2001, 3, 10), "ORDERED") for m in (2, 3)] + [(1, ts(2000, 12, 30), ts(2000, 12, 30), "ORDERED")]
    ev = [
        ("1", day(2000, 12, 28), "a", "MerchantApp", "view"),
        ("1", day(2000, 12, 29), "a", "MerchantApp", "view"),  # the same session
        ("1", day(2000, 12, 10), "b", "MerchantApp", "view"),  # m1 only
        ("1", day(2001, 1, 2), "c", "MerchantApp", "view"),  # after the anchor, other slice
        ("2", day(2001, 2, 20), "d", "MerchantApp", "view"),  # m1, no w1
        ("3", day(2001, 3, 8), "e", "MerchantApp", "view"),  # created outside the slices
        ("1", day(2000, 12, 29), None, "MerchantApp", "view"),
        ("1", day(2000, 12, 29), "f", "Web", "view"),
    ]
    t = tables(spark, application=app, app_event=ev, merchant_mart=mart)
    got = sessions.session_features_years(t, SPEC, (2000, 2001)).collect()
    assert [tuple(r) for r in got] == [(1, 1, 2)]
    rows = sessions.session_features_slices(t, SPEC, [(D(2001, 1, 1), D(2002, 1, 1)), (D(2000, 1, 1), D(2001, 1, 1))]).collect()
    assert [(r.merchant_id, r.slice, r.w1_sessions) for r in rows] == [(1, 1, 1)]
    with pytest.raises(ValueError, match="overlap"):
        sessions.session_features_slices(t, SPEC, [(D(2000, 1, 1), D(2001, 1, 2)), (D(2001, 1, 1), D(2002, 1, 1))])
