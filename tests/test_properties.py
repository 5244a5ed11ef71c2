"""Properties from the test strategy: window arithmetic and chunk equivalence."""

import os

import pytest
from pyspark.sql import functions as F

from tillpoint.config import FIXTURE_AS_OF, FIXTURE_SPEC
from tillpoint.operators import cohort, rolling
from tillpoint.sources.tables import Tables

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver fixture not present")


def test_asof_window_arithmetic(spark):
    rows = rolling.txn_features_asof(Tables.from_fixture(spark, SF), FIXTURE_AS_OF, 25).collect()
    assert rows
    for r in rows:
        assert abs((r.m1_tpv + r.m2_tpv + r.m3_tpv) - r.tpv_90_days) < 1e-6 * max(1.0, r.tpv_90_days)
        assert r.m1_txn_count + r.m2_txn_count + r.m3_txn_count == r.txn_count_90_days
        assert r.w1_txn_count + r.w2_txn_count + r.w3_txn_count <= r.txn_count_90_days
        assert r.txn_count_90_days <= r.total_txn_count
        assert max(r.m1_active_days, r.m2_active_days, r.m3_active_days) <= 30


def test_training_distinct_bounds(spark):
    rows = rolling.txn_features_train(Tables.from_fixture(spark, SF), FIXTURE_SPEC, "earliest").collect()
    for r in rows:
        # one anchor per merchant: disjoint monthly windows partition the 90 days
        assert r.m1_txn_count + r.m2_txn_count + r.m3_txn_count == r.txn_count_90_days
        assert r.unique_payers_90_days <= r.m1_unique_payers + r.m2_unique_payers + r.m3_unique_payers
        assert r.total_unique_payers >= r.unique_payers_90_days
        assert r.total_active_vintage >= r.m1_active_days


def test_chunk_union_equals_unchunked(spark):
    tx = Tables.from_fixture(spark, SF).transactions.filter(F.col("status") == "SUCCESS")
    whole = tx.groupBy("merchant_id").count()
    chunked = cohort.chunked_ids(tx, 10).groupBy("merchant_id").count()
    assert whole.exceptAll(chunked).count() == 0 and chunked.exceptAll(whole).count() == 0
