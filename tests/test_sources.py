"""Typed CSV, catalogue layout, mart constraint and restartable extracts."""

import datetime as dt
import os

import pytest
from helpers import D, tables, ts
from pyspark.sql import functions as F

from tillpoint.config import PRODUCTS, ProductSpec
from tillpoint.operators import cohort, profile, sessions
from tillpoint.sources import extracts, sinks
from tillpoint.sources.tables import APPLICATION_TABLES, SCHEMAS, Tables, unique_by

SPEC = ProductSpec(name="swipe", task_ids=(16,), date_floor=D(2000, 1, 1))


# --- CSV ---------------------------------------------------------------------
def test_csv_rows_are_typed_and_bad_rows_are_kept_apart(spark, tmp_path):
    lines = [
        "merchant_id,created_at,agreement_at,status",
        "1,2001-03-10 12:00:00,2001-03-11 00:00:00,APPROVED",
        "2,2001-03-10T12:00:00,,rejected",
        "x,2001-03-10 12:00:00,,APPROVED",  # no number
        "4,10.03.2001,,APPROVED",  # no timestamp
        "5,2001-03-10 12:00:00,,APPROVED,more",  # too many fields
        "6,2001-03-10 12:00:00",  # too few
        '7,2001-03-12 12:00:00,,"with, comma"',
    ]
    path = tmp_path / "loan.csv"
    path.write_text("\n".join(lines) + "\n")
    t = Tables.from_csv(spark, {"application_loan": str(path)})
    df = t.application_loan
    assert df.schema == SCHEMAS["application_loan"]
    got = {r.merchant_id: (r.agreement_at, r.status) for r in df.collect()}
    assert got == {1: (dt.datetime(2001, 3, 11), "APPROVED"), 2: (None, "rejected"), 7: (None, "with, comma")}
    # what counts as bad does not depend on the columns a plan reads
    assert sorted(r.merchant_id for r in df.select("merchant_id").collect()) == [1, 2, 7] and df.count() == 3
    bad = t.rejected("application_loan")
    assert sorted(r.record for r in bad.collect()) == sorted(lines[3:7])
    assert bad.select("record").distinct().count() == 4
    assert cohort.applied_merchants(t, PRODUCTS["loan"]).count() == 0  # before the floor of 2018
    path.write_text("\n".join(["created_at,merchant_id,agreement_at,status", *lines[1:3]]))
    with pytest.raises(Exception, match="(?i)header"):
        Tables.from_csv(spark, {"application_loan": str(path)}).application_loan.collect()


def test_every_product_has_a_table_with_its_date_column():
    for spec in PRODUCTS.values():
        assert spec.application_table in APPLICATION_TABLES
        assert spec.order_date_col in SCHEMAS[spec.application_table].fieldNames()
        assert spec.profile_date_col is None or spec.profile_date_col in SCHEMAS["merchant_mart"].fieldNames()


# --- the mart's key -------------------------------------------------------------
def mart(spark, ids):
    rows = [(m, str(m), dt.datetime(2000, 5, 1), 1.0, 2.0) for m in ids]
    df = spark.createDataFrame(rows, "merchant_id long, mid string, merchant_created_at timestamp_ntz, integ_longitude double, integ_latitude double")
    missing = [f for f in SCHEMAS["merchant_mart"] if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*SCHEMAS["merchant_mart"].fieldNames())


@pytest.mark.parametrize("ids,raises", [([1, 2, 3], False), ([1, 2, 2, 3], True)])
def test_a_repeated_merchant_fails_the_job_that_uses_the_mart(spark, ids, raises):
    tx = [(k, m, 100, ts(2001, 7, 1 + k % 20), "a", "SUCCESS") for k, m in enumerate([1, 2, 3] * 6)]
    frames = {"transactions": [(i, m, __import__("decimal").Decimal(a), t, p, s) for i, m, a, t, p, s in tx]}
    app = [(m, ts(2001, 6, 1), ts(2001, 6, 1), "ORDERED") for m in (1, 2, 3)]
    ev = [("1", ts(2001, 5, 30), "s", "MerchantApp", "view")]
    t = tables(spark, **frames, application=app, app_event=ev, merchant_mart=mart(spark, ids))
    spec = ProductSpec(name="swipe", task_ids=(16,), events=("view",), date_floor=D(2000, 1, 1))
    plans = [
        lambda: cohort.active_merchants(t, D(2001, 8, 1), min_txns=1, min_tpv=1.0, with_mart=True),
        lambda: profile.merchant_profile(t, spec),
        lambda: profile.vintage(t, spec),
        lambda: sessions.session_features_train(t, spec, D(2000, 1, 1), D(2002, 1, 1)),
    ]
    for plan in plans:
        if raises:
            with pytest.raises(Exception, match="merchant mart: more than one row with merchant_id = 2"):
                plan().collect()
        else:
            assert plan().count() in (1, 3)


def test_unique_by_keeps_rows_and_null_keys_once(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "k long, v string")
    assert sorted(map(tuple, unique_by(df, "k", "t").collect()), key=str) == [(1, None), (None, "x")]
    with pytest.raises(Exception, match="NULL"):
        unique_by(df.union(df), "k", "t").select("v").filter("k IS NULL").collect()


# --- catalogue layout -----------------------------------------------------------
@pytest.fixture()
def database(spark, tmp_path):
    name = f"layout_{os.path.basename(tmp_path).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def facts(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(i, m, Decimal(a), t, "p", "SUCCESS") for i, m, a, t in rows], SCHEMAS["transactions"])


def test_published_facts_are_pruned_and_joined_without_exchange(spark, database):
    tx = facts(spark, [(k, k % 5, 100, dt.datetime(2001, 1 + k % 8, 3)) for k in range(400)])
    t = Tables(spark, {"transactions": lambda: tx, "merchant_mart": lambda: mart(spark, range(5))}, D(2000, 1, 1))
    names = sinks.publish_facts(t, database, buckets=4)
    own = Tables.from_catalog(spark, names, sinks.MONTHS)
    own.date_floor = D(2000, 1, 1)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, -1)
    try:
        args = (D(2001, 8, 1), 1, 1.0, 90, True, None)
        df = cohort._active(own, *args)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert "payment_month" in plan.split("PartitionFilters")[1].split("]")[0]
        read = df._jdf.queryExecution().executedPlan()
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, cohort._active(t, *args).collect())) and read
        assert "Exchange" in cohort._active(t, *args)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    months = {r[0] for r in spark.sql(f"SHOW PARTITIONS {names['transactions']}").collect()}
    assert months == {f"payment_month=2001-{m:02d}-01" for m in range(1, 9)}


def test_partition_overwrite_leaves_other_months(spark, database):
    tx = facts(spark, [(k, 1, 10, dt.datetime(2001, 1 + k % 3, 3)) for k in range(9)])
    names = sinks.publish_facts(Tables(spark, {"transactions": lambda: tx, "merchant_mart": lambda: mart(spark, [1])}), database, 2)
    name = names["transactions"]
    late = facts(spark, [(100, 2, 7, dt.datetime(2001, 2, 20))]).withColumn("payment_month", F.trunc("payment_timestamp", "month"))
    sinks.overwrite_partitions(late, name)
    got = spark.table(name).groupBy("payment_month").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id")).collect()
    assert {str(r.payment_month): (r.n, r.id) for r in got} == {"2001-01-01": (3, 6), "2001-02-01": (1, 100), "2001-03-01": (3, 8)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


# --- restartable extracts ----------------------------------------------------------
def test_an_ended_run_is_taken_up_at_its_missing_chunks(spark, tmp_path):
    src = f"{tmp_path}/task"
    rows = spark.createDataFrame([(m, ts(2001, 1, 1 + m % 20), 16) for m in range(30)], SCHEMAS["task_history"])
    rows.write.parquet(src)
    t = Tables.from_paths(spark, {"task_history_v1": src})
    built = []

    def build(fail_at=None):
        def run(part):
            df = part.task_history_v1
            ids = sorted(r.merchant_id for r in df.select("merchant_id").collect())
            if ids and ids[0] % 4 == fail_at:
                raise RuntimeError("executor lost")
            built.append(ids[0] % 4 if ids else None)
            return df.select("merchant_id")

        return run

    path = f"{tmp_path}/out"
    with pytest.raises(RuntimeError):
        extracts.extract(t, "x", build(fail_at=2), path, ["task_history_v1"], chunks=4)
    assert built == [0, 1]
    mark = extracts.fingerprint(t, ["task_history_v1"], ["x", 4, None])
    assert not extracts.is_published(spark, path, mark, 4)
    got = extracts.extract(t, "x", build(), path, ["task_history_v1"], chunks=4)
    assert built == [0, 1, 2, 3] and sorted(r.merchant_id for r in got.collect()) == list(range(30))
    assert extracts.extract(t, "x", lambda part: 1 / 0, path, ["task_history_v1"], chunks=4).count() == 30  # published
    # other parameters, another number of chunks or changed inputs are another run
    assert extracts.extract(t, "x", build(), path, ["task_history_v1"], chunks=1, parameters={"a": 1}).count() == 30
    spark.createDataFrame([(77, ts(2001, 1, 1), 16)], SCHEMAS["task_history"]).write.mode("append").parquet(src)
    again = Tables.from_paths(spark, {"task_history_v1": src})
    built.clear()
    assert extracts.extract(again, "x", build(), path, ["task_history_v1"], chunks=4).count() == 31
    assert built == [0, 1, 2, 3]
    assert spark.read.parquet(f"{extracts.run_folder(path, mark, 4)}/manifest").count() == 4  # the old run is untouched


def test_chunks_of_an_extract_are_its_whole(spark):
    app = [(m, ts(2001, 1, 1), ts(2001, 1, 1), "ORDERED") for m in range(20)] + [(-3, ts(2001, 1, 1), None, "ORDERED")]
    t = tables(spark, application=app)
    parts = [cohort.applied_merchants(t.chunk(3, i), SPEC).collect() for i in range(3)]
    assert sorted(r.merchant_id for p in parts for r in p) == [-3, *range(20)]
