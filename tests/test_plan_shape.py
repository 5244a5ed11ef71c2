"""Physical-plan properties the scale design relies on."""

import dataclasses
import os

import bench
import pytest

from tillpoint.config import FIXTURE_AS_OF, FIXTURE_SPEC
from tillpoint.operators import cohort, rolling, sessions
from tillpoint.sources.tables import Tables

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver fixture not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_floor_reaches_parquet_scan(spark):
    t = Tables.from_fixture(spark, SF)
    df = cohort._active(t, FIXTURE_AS_OF, 25, 150, 90, False, t.date_floor)
    p = plan(df)
    assert "GreaterThanOrEqual(l_shipdate" in p
    assert "orders.parquet" not in p  # payer unused: the orders join is eliminated


def test_masks_keep_the_fact_shuffle_narrow(spark):
    """One mask and one sum per (merchant, entity) go through the first exchange, not a flag a window."""
    t = Tables.from_fixture(spark, SF)
    masked = plan(rolling.txn_features_train(t, FIXTURE_SPEC))
    naive = plan(bench.naive_txn_features_train(t, FIXTURE_SPEC))
    assert masked.count("Expand [") == 1 and naive.count("Expand [") >= 1
    assert "count(distinct" not in masked.lower()
    partial = [x for x in masked.splitlines() if "partial_bit_or(_mask" in x]
    assert len(partial) == 1 and partial[0].count("partial_") == 2
    # and one row per mask, not one sum per window, through the second
    second = [x for x in masked.splitlines() if "partial_count" in x and "payment_date" in x.split("functions=")[0]]
    assert len(second) == 1 and second[0].count("partial_") == 4


@pytest.mark.parametrize("years", [(2001,), (1999, 2000, 2001, 2003)])
def test_events_are_read_once_whatever_the_years(spark, years):
    t = Tables.from_fixture(spark, SF)
    p = plan(sessions.session_features_years(t, dataclasses.replace(FIXTURE_SPEC, application_table="application_recent"), years))
    scans = [x for x in p.splitlines() if "FileScan" in x]
    assert len([x for x in scans if "events.parquet" in x]) == 1 and len(scans) == 2  # and the staged cohort


def test_payers_as_of_read_the_facts_once(spark):
    t = Tables.from_fixture(spark, SF)
    p = plan(rolling.payer_features_asof(t, FIXTURE_AS_OF, 25))
    assert len([x for x in p.splitlines() if "FileScan" in x and "lineitem.parquet" in x]) == 1


def test_no_merchant_window_over_fact_rows(spark):
    t = Tables.from_fixture(spark, SF)
    p = plan(rolling.txn_features_asof(t, FIXTURE_AS_OF, 25))
    assert "Window" not in p
