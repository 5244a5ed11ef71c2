import datetime as dt

from pyspark.sql import functions as F

from tillpoint.functions.geohash import geohash
from tillpoint.functions.windows import in_window
from tillpoint.operators import apps, features, score
from tillpoint.operators.cohort import chunked_ids


def test_geohash_published_example_and_prefixes(spark):
    df = spark.createDataFrame([(10.40744, 57.64911), (None, 1.0)], "lng double, lat double")
    r = df.select(*[geohash(F.col("lng"), F.col("lat"), p).alias(f"g{p}") for p in (3, 4, 6)]).collect()
    assert (r[0].g3, r[0].g4, r[0].g6) == ("u4p", "u4pr", "u4pruy")
    assert r[1].g6 is None


def test_window_edges(spark):
    od = dt.date(2001, 3, 10)
    days = [od, od - dt.timedelta(days=7), od - dt.timedelta(days=8), od - dt.timedelta(days=1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    r = df.select(
        "d",
        in_window(F.col("d"), F.lit(od), "w1").alias("w1"),
        in_window(F.col("d"), F.lit(od), "w2").alias("w2"),
        in_window(F.col("d"), F.lit(od), "total").alias("tot"),
    ).collect()
    got = {x.d: (x.w1, x.w2, x.tot) for x in r}
    assert got[od] == (False, False, False)  # the anchor day is outside every window
    assert got[od - dt.timedelta(days=7)] == (True, False, True)
    assert got[od - dt.timedelta(days=8)] == (False, True, True)
    assert got[od - dt.timedelta(days=1)] == (True, False, True)


def test_app_list_parsing(spark):
    rows = [
        (1, "\"[{'appName': 'Paytm', 'packageName': 'a'}, {'appName': 'CRED', 'packageName': 'b'}]\""),
        (2, "\"{'appName': 'Paytm', 'packageName': 'a'}\""),
        (3, "\"[{'appName': 'Paytm'"),
        (4, None),
        (5, "\"[]\""),
        (6, "[{'appName': 'A', 'packageName': 'a'}, {'appName': 'B', 'packageName': 'b'}]"),
    ]
    df = spark.createDataFrame(rows, "id int, app_details string")
    got = {r.id: r.names for r in df.select("id", apps.parse_app_list(F.col("app_details")).alias("names")).collect()}
    assert got[1] == ["Paytm", "CRED"]
    assert got[2] == []  # a lone record is not a list
    assert got[3] == []  # malformed
    assert got[4] == []  # missing
    assert got[5] == []
    assert got[6] == ["A", "B"]  # unquoted run of two records


def test_trend_rule(spark):
    df = spark.createDataFrame([(3, 2, 1), (1, 2, 3), (2, 2, 1), (None, 1, 1)], "a long, b long, c long")
    got = [r.t for r in df.select(features.trend(F.col("a"), F.col("b"), F.col("c")).alias("t")).collect()]
    assert got == ["up", "down", "flat", "flat"]


def test_ratios_null_on_zero(spark):
    df = spark.createDataFrame([(1, 10.0, 0, 0.0, 0)], "merchant_id long, m1_tpv double, m1_txn_count long, m2_tpv double, m2_txn_count long")
    cols = dict(m1_tpv=10.0)
    full = df
    for c in ["total_tpv", "total_txn_count", "total_active_vintage", "m1_active_days", "m2_active_days", "m1_max_daily_tpv", "m1_max_daily_payees", "m1_unique_payers", "m1_max_daily_txns"]:
        full = full.withColumn(c, F.lit(0))
    r = features.with_ratios(full).first()
    assert r.m1_atv is None and r.m2_atv is None and r.total_atv is None
    assert cols


def test_quartile_bin_minimum_unbinned(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8])], "merchant_id long, x double")
    b = apps.quartile_bins(df, ("x",)).orderBy("merchant_id").collect()
    assert b[0].x_bin is None  # equal to the minimum: right-closed bins exclude it
    assert [r.x_bin for r in b[1:]] == [1, 2, 2, 3, 3, 4, 4]


def test_recommendation_ties_keep_product_order(spark):
    df = spark.createDataFrame([(1, 0.6, 0.7, 0.7), (2, 0.9, 0.1, 0.95)], "merchant_id long, prob_loan double, prob_swipe double, prob_speaker double")
    r = {x.merchant_id: (x.p1_recommendation, x.p2_recommendation, x.p3_recommendation) for x in score.with_recommendation(df).collect()}
    assert r[1] == ("loan", "swipe", "speaker")
    assert r[2] == ("loan", "speaker", "swipe")


def test_chunk_predicate_matches_sql_mod(spark):
    df = spark.createDataFrame([(-3,), (-10,), (None,), (7,)], "merchant_id long")
    kept = sorted(r.merchant_id for r in chunked_ids(df, 10).collect())
    assert kept == [-10, 7]


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "p double")
    h = {r.bin: r.n for r in score.histogram(df, "p", 10).collect()}
    assert sum(h.values()) == 11 and h[10] == 2 and len(h) == 10


def test_geohash_beyond_the_map_is_the_cell_at_its_edge(spark):
    df = spark.createDataFrame([(200.0, 95.0), (180.0, 90.0), (-200.0, -95.0), (-180.0, -90.0)], "lng double, lat double")
    r = [x.g for x in df.select(geohash(F.col("lng"), F.col("lat"), 6).alias("g")).collect()]
    assert r[0] == r[1] == "zzzzzz" and r[2] == r[3] == "000000"


def test_location_statistics_before_or_after_the_activity_filter(spark):
    rows = [(1, "a", 10.0, 3), (2, "a", 30.0, None), (3, "b", 5.0, 1), (4, None, 9.0, 2)]
    df = spark.createDataFrame(rows, "merchant_id long, geohash4 string, total_tpv double, txn_count_90_days long")
    for first, want in ((True, {1: (2, 40.0, 20.0), 3: (1, 5.0, 5.0), 4: (None, None, None)}), (False, {1: (1, 10.0, 10.0), 3: (1, 5.0, 5.0), 4: (None, None, None)})):
        got = features._located_and_active(df, first).collect()
        assert {r.merchant_id: (r.loc_hash_density, r.loc_hash_tpv, r.loc_hash_atv) for r in got} == want
