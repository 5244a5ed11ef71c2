"""Logical source tables.

Every plan in the package reads its inputs through a :class:`Tables` object,
so the same plan runs against production tables (``Tables.from_catalog``) or
against the driver's synthetic parquet (``Tables.from_fixture``), where each
logical table is a *view* derived from the TPC-H-like tables (FIXTURES.md §2).
The derivations are plain projections / filters / joins, so predicates and
column pruning still reach the parquet scans.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.config import FIXTURE_APPLICATIONS, FIXTURE_DATE_FLOOR, FIXTURE_EVENT_SHIFT_DAYS, FIXTURE_TASK_IDS

#: The application table of each product; their date columns differ (``SCHEMAS``).
APPLICATION_TABLES = (
    "application_swipe",
    "application_speaker",
    "application_loan",
    "application_club",
    "application_fp",
    "application_card",
)
LOGICAL_TABLES = (
    "transactions",
    "application",
    "application_recent",
    *APPLICATION_TABLES,
    "task_history_v1",
    "task_history_v2",
    "merchant_mart",
    "app_event",
    "app_dump",
    "device_info",
    "scored",
)



def _application(*dates: str) -> T.StructType:
    fields = [T.StructField("merchant_id", T.LongType()), T.StructField("created_at", T.TimestampNTZType())]
    fields += [T.StructField(c, T.TimestampNTZType()) for c in dates]
    return T.StructType([*fields, T.StructField("status", T.StringType())])


_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
}


def _typed(columns: str) -> T.StructType:
    """``name type, name type, ...`` (needs no session, unlike a DDL string)."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


# Declared schemas of the logical tables (production sources are read with
# these, never inferred).
SCHEMAS = {
    "application_swipe": _application("order_date"),
    "application_speaker": _application("order_date"),
    "application_loan": _application("agreement_at"),
    "application_club": _application(),
    "application_fp": _application(),
    "application_card": _application(),
    "application_recent": _application("order_date"),
    "merchant_mart": _typed(
        """merchant_id bigint, mid string, actual_merchant_type string, area_name string, zone_name string,
        region_name string, territory_name string, merchant_created_at timestamp_ntz, std_category string,
        integ_longitude double, integ_latitude double, swipe_flag int, speaker_flag int, loan_flag int, fp_flag int,
        club_flag int, qr_flag int, credit_flag int, debit_flag int, onboarding_date date, lending_eligibility int,
        lending_eligibility_type string, swipe_eligibility int, fp_eligibility int, insurance_eligibility int,
        club_eligibility int, gl_eligibility int, speaker_eligibility int, merchant_score double,
        engagement_score double, loan_disbursal_date date, loan_closure_date date, swipe_order_date date,
        speaker_order_date date, club_start_date date, club_end_date date"""
    ),
    "transactions": T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("merchant_id", T.LongType()),
            T.StructField("amount", T.DecimalType(18, 2)),
            T.StructField("payment_timestamp", T.TimestampNTZType()),
            T.StructField("payer_vpa_hash", T.StringType()),
            T.StructField("status", T.StringType()),
        ]
    ),
    "application": T.StructType(
        [
            T.StructField("merchant_id", T.LongType()),
            T.StructField("created_at", T.TimestampNTZType()),
            T.StructField("order_date", T.TimestampNTZType()),
            T.StructField("status", T.StringType()),
        ]
    ),
    "task_history": T.StructType(
        [
            T.StructField("merchant_id", T.LongType()),
            T.StructField("created_at", T.TimestampNTZType()),
            T.StructField("task_id", T.LongType()),
        ]
    ),
    "app_event": T.StructType(
        [
            T.StructField("mid", T.StringType()),
            T.StructField("created_at", T.TimestampNTZType()),
            T.StructField("session_id", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("event_name", T.StringType()),
        ]
    ),
    "app_dump": T.StructType(
        [
            T.StructField("merchant_id", T.LongType()),
            T.StructField("date", T.DateType()),
            T.StructField("app_details", T.StringType()),
        ]
    ),
    "device_info": T.StructType(
        [
            T.StructField("merchant_id", T.LongType()),
            T.StructField("manufacturer", T.StringType()),
        ]
    ),
    "scored": T.StructType(
        [
            T.StructField("merchant_id", T.LongType()),
            T.StructField("target", T.IntegerType()),
            T.StructField("prob", T.DoubleType()),
        ]
    ),
}


#: The text of a row that does not meet its table's schema.
CORRUPT = "_corrupt_record"


def declared_schema(logical: str) -> T.StructType:
    return SCHEMAS["task_history" if logical.startswith("task_history") else logical]


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    df = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", header)
        .option("enforceSchema", False)  # a header with other names is an error, not a shift
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(path)
    )
    # counts of all columns go to the session's listeners; they also keep every column in the scan
    counts = [F.count(c).alias(c) for c in schema.fieldNames()]
    return df.observe(f"csv_{uuid.uuid4().hex[:12]}", F.count(CORRUPT).alias("rejected"), *counts)


def unique_by(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df`` with one row per ``key``; a second row fails the job that reads the result.

    The check is part of the key's expression, so no plan prunes it; the aggregate is keyed as
    the joins that follow it, which then need no exchange of their own."""
    rest = [c for c in df.columns if c != key]
    counted = df.groupBy(key).agg(*[F.first(c).alias(c) for c in rest], F.count(F.lit(1)).alias("_rows"))
    message = F.concat(F.lit(f"{what}: more than one row with {key} = "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = F.when(F.col("_rows") == 1, F.col(key)).otherwise(F.raise_error(message).cast(df.schema[key].dataType))
    return counted.select(*[checked.alias(key) if c == key else F.col(c) for c in df.columns])


@dataclass
class Tables:
    """Resolver from logical table name to DataFrame."""

    spark: SparkSession
    loaders: dict = field(default_factory=dict)
    # history floor of the sources (cohort / mart "created since" filters)
    date_floor: dt.date = dt.date(2018, 1, 1)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        loaders = self.__dict__.get("loaders", {})
        if name in loaders:
            return loaders[name]()
        raise AttributeError(name)

    def get(self, name: str) -> DataFrame:
        return self.loaders[name]()

    def since(self, name: str, column: str, day: dt.date) -> DataFrame:
        """Rows of a table from ``day`` on; months before it are pruned if the table has them as
        partitions, and the comparison reaches the scan."""
        df = self.get(name).filter(F.col(column) >= _ts(day))
        month = self.__dict__.get("months", {}).get((name, column))
        return df.filter(F.col(month) >= F.lit(day.replace(day=1))) if month else df

    def memo(self, key, build: Callable[[], DataFrame], staged: bool = True) -> DataFrame:
        """Build a derived frame once per Tables object (optionally staged).

        Merchant-level intermediates (cohorts, anchors, the active base) feed
        several plans; staging them once keeps every later plan short and
        avoids recomputing them from the fact tables.
        """
        cache = self.__dict__.setdefault("_memo", {})
        if key not in cache:
            df = build()
            if staged:
                from tillpoint.sources.sinks import stage

                df = stage(df)
            cache[key] = df
        return cache[key]

    # -- constructors -----------------------------------------------------
    @classmethod
    def from_catalog(
        cls, spark: SparkSession, names: dict[str, str], months: dict[tuple[str, str], str] | None = None
    ) -> "Tables":
        """Production: ``names`` maps logical name -> metastore table name.  ``months`` names the
        partition column (first day of the month) of a table's timestamp, see :meth:`since`."""
        loaders: dict[str, Callable[[], DataFrame]] = {}
        for logical, physical in names.items():
            loaders[logical] = (lambda p=physical: spark.table(p))
        out = cls(spark, loaders)
        out.months = months or {}
        return out

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict[str, str]) -> "Tables":
        """Production from parquet folders with declared schemas."""
        loaders = {}
        for logical, path in paths.items():
            schema = declared_schema(logical)
            loaders[logical] = (lambda p=path, s=schema: spark.read.schema(s).parquet(p))
        return cls(spark, loaders)

    @classmethod
    def from_csv(cls, spark: SparkSession, paths: dict[str, str], header: bool = True) -> "Tables":
        """Production from CSV files with declared schemas.

        A row with too few or too many fields, or a field that is not of its type, is no row of
        the table; :meth:`rejected` has its text.  Every field of a row is parsed, whichever
        columns a plan reads, so a plan's columns never decide what counts as a bad row."""
        parsed = {
            logical: (lambda p=path, n=logical: _read_csv(spark, p, declared_schema(n), header)) for logical, path in paths.items()
        }
        loaders = {
            logical: (lambda f=frame: (lambda df: df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))(f())) for logical, frame in parsed.items()
        }
        out = cls(spark, loaders)
        out.parsed = parsed
        return out

    def rejected(self, name: str) -> DataFrame:
        """The rejected rows of a CSV table: its columns as far as they could be read, and the
        row's text as ``record``."""
        df = self.__dict__["parsed"][name]()
        return df.filter(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "record")

    def chunk(self, partitions: int, index: int) -> "Tables":
        """The same tables, those with merchants cut to ``MOD(merchant_id, partitions) = index``.
        Every extract is keyed by merchant, so its chunks are disjoint and their union is the
        whole but for NULL and negative keys off the modulus, as in SQL."""

        def cut(load):
            df = load()
            return df.filter(F.col("merchant_id") % partitions == index) if "merchant_id" in df.columns else df

        out = Tables(self.spark, {n: (lambda f=f: cut(f)) for n, f in self.loaders.items()}, self.date_floor)
        out.months = self.__dict__.get("months", {})
        return out

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """Driver's synthetic tables -> logical tables (FIXTURES.md §2)."""
        raw = _RawFixture(spark, sf_dir)
        loaders = {
            "transactions": raw.transactions,
            "application": raw.application,
            "application_recent": raw.application_recent,
            **{f"application_{p}": (lambda p=p: raw.application_of(p)) for p in FIXTURE_APPLICATIONS},
            "task_history_v1": raw.task_history_v1,
            "task_history_v2": raw.task_history_v2,
            "merchant_mart": raw.merchant_mart,
            "app_event": raw.app_event,
            "app_dump": raw.app_dump,
            "device_info": raw.device_info,
            "scored": raw.scored,
        }
        return cls(spark, loaders, FIXTURE_DATE_FLOOR)


class _RawFixture:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # transactions: one row per line item; id repeats on purpose.  The payer
    # comes from the order; orders is expressed key-unique (group by key) and
    # left-joined, so plans that never read the payer drop the join entirely
    # (the production table has the column, no join).  Every line item has its
    # order in the driver's data, so this equals the inner join.
    def transactions(self) -> DataFrame:
        li = self.read("lineitem").select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag"
        )
        od = self.read("orders").groupBy("o_orderkey").agg(F.min("o_custkey").alias("o_custkey"))
        return li.join(od, li.l_orderkey == od.o_orderkey, "left").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_suppkey").alias("merchant_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            F.col("l_shipdate").alias("payment_timestamp"),
            F.col("o_custkey").cast("string").alias("payer_vpa_hash"),
            F.when(F.col("l_returnflag") == "R", F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        )

    def _lineitem_filtered(self, cond: Column) -> DataFrame:
        return self.read("lineitem").filter(cond)

    def application(self) -> DataFrame:
        li = self._lineitem_filtered(
            (F.col("l_shipdate") >= _ts(dt.date(2000, 1, 1)))
            & (F.col("l_quantity") >= 45)
            & (F.col("l_discount") >= 0.08)
        )
        return li.select(
            F.col("l_suppkey").alias("merchant_id"),
            F.col("l_shipdate").alias("created_at"),
            F.when(F.col("l_tax") <= 0.06, F.col("l_shipdate")).alias("order_date"),
            _app_status(),
        )

    def application_recent(self) -> DataFrame:
        li = self._lineitem_filtered(
            (F.col("l_shipdate") >= _ts(dt.date(2001, 7, 10))) & (F.col("l_quantity") >= 25)
        )
        return li.select(
            F.col("l_suppkey").alias("merchant_id"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("order_date"),
            _app_status(),
        )

    def application_of(self, product: str) -> DataFrame:
        """One product's applications: a quantity of its own, its date column and its statuses."""
        quantity, date_col, statuses = FIXTURE_APPLICATIONS[product]
        li = self._lineitem_filtered(
            (F.col("l_shipdate") >= _ts(dt.date(2000, 1, 1)))
            & F.col("l_quantity").between(quantity, quantity + 1)
            & (F.col("l_discount") >= 0.07)
            & (F.col("l_suppkey") % 3 != 0)
        )
        status = F.lit(statuses[-1])
        for k, x in enumerate(statuses[:-1]):
            status = F.when(F.col("l_linenumber") % len(statuses) == k, F.lit(x)).otherwise(status)
        cols = [F.col("l_suppkey").alias("merchant_id"), F.col("l_shipdate").alias("created_at")]
        if date_col:
            cols.append(F.when(F.col("l_tax") <= 0.06, F.col("l_shipdate")).alias(date_col))
        return li.select(*cols, status.alias("status"))

    def _tasks(self, since: dt.date, qlo: int, qhi: int, mod: int) -> DataFrame:
        li = self._lineitem_filtered(
            (F.col("l_shipdate") >= _ts(since))
            & F.col("l_quantity").between(qlo, qhi)
            & (F.col("l_discount") >= 0.07)
            & ((F.col("l_suppkey") % mod) != 0)
        )
        return li.select(
            F.col("l_suppkey").alias("merchant_id"),
            F.col("l_shipdate").alias("created_at"),
            F.when(F.col("l_linenumber") <= 4, F.lit(16))
            .otherwise(F.element_at(F.array(*map(F.lit, FIXTURE_TASK_IDS)), (F.col("l_partkey") % len(FIXTURE_TASK_IDS) + 1).cast("int")))
            .cast("bigint")
            .alias("task_id"),
        )

    def task_history_v1(self) -> DataFrame:
        return self._tasks(dt.date(2000, 1, 1), 40, 43, 3)

    def task_history_v2(self) -> DataFrame:
        return self._tasks(dt.date(2000, 6, 1), 36, 39, 4)

    def merchant_mart(self) -> DataFrame:
        s = self.read("supplier")
        n = self.read("nation")
        r = self.read("region")
        k = F.col("s_suppkey")
        created = F.date_add(F.lit(dt.date(2000, 1, 1)), (k * 97 % 540).cast("int"))
        j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        return j.select(
            k.alias("merchant_id"),
            k.cast("string").alias("mid"),
            F.when(k % 3 == 0, "RETAIL").when(k % 3 == 1, "SERVICE").otherwise("FOOD").alias("actual_merchant_type"),
            F.concat(F.lit("AREA_"), (k % 10).cast("string")).alias("area_name"),
            F.col("r_name").alias("zone_name"),
            F.col("n_name").alias("region_name"),
            F.concat(F.lit("TERR_"), (k % 6).cast("string")).alias("territory_name"),
            created.cast("timestamp_ntz").alias("merchant_created_at"),
            F.concat(F.lit("CAT_"), (k % 8).cast("string")).alias("std_category"),
            (((k % 25) * 7919 % 36000) / 100.0 - 180.0).alias("integ_longitude"),  # 25 places, shared
            (((k % 25) * 104729 % 18000) / 100.0 - 90.0).alias("integ_latitude"),
            (k % 2 == 0).cast("int").alias("swipe_flag"),
            (k % 3 == 0).cast("int").alias("speaker_flag"),
            (k % 5 == 0).cast("int").alias("loan_flag"),
            (k % 7 == 0).cast("int").alias("fp_flag"),
            (k % 11 == 0).cast("int").alias("club_flag"),
            (k % 2 == 1).cast("int").alias("qr_flag"),
            (k % 13 == 0).cast("int").alias("credit_flag"),
            (k % 17 == 0).cast("int").alias("debit_flag"),
            F.date_add(created, 3).alias("onboarding_date"),
            (k % 4).cast("int").alias("lending_eligibility"),
            F.when(k % 4 == 0, "NONE").otherwise("PRE_APPROVED").alias("lending_eligibility_type"),
            ((k + 1) % 4).cast("int").alias("swipe_eligibility"),
            ((k + 2) % 4).cast("int").alias("fp_eligibility"),
            ((k + 3) % 4).cast("int").alias("insurance_eligibility"),
            (k % 2).cast("int").alias("club_eligibility"),
            ((k + 1) % 2).cast("int").alias("gl_eligibility"),
            ((k + 2) % 4).cast("int").alias("speaker_eligibility"),
            F.col("s_acctbal").alias("merchant_score"),
            ((k * 31 % 100).cast("double") / 100.0).alias("engagement_score"),
            F.when(k % 5 == 0, F.date_add(created, 200)).alias("loan_disbursal_date"),
            F.when(k % 10 == 0, F.date_add(created, 380)).alias("loan_closure_date"),
            F.when(k % 2 == 0, F.date_add(created, 120)).alias("swipe_order_date"),
            F.when(k % 3 == 0, F.date_add(created, 150)).alias("speaker_order_date"),
            F.when(k % 11 == 0, F.date_add(created, 90)).alias("club_start_date"),
            F.when(k % 22 == 0, F.date_add(created, 455)).alias("club_end_date"),
        )

    def _shifted_events(self) -> DataFrame:
        return self.read("events").select(
            "event_id",
            "user_id",
            "event_type",
            (F.col("ts") - F.expr(f"INTERVAL {FIXTURE_EVENT_SHIFT_DAYS} DAYS")).alias("created_at"),
        )

    def app_event(self) -> DataFrame:
        e = self._shifted_events()
        eid = F.col("event_id")
        return e.select(
            F.col("user_id").cast("string").alias("mid"),
            F.col("created_at"),
            F.when(eid % 17 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("-"), F.floor(eid / 3).cast("string")))
            .alias("session_id"),
            F.when(eid % 5 == 0, F.lit("Web")).otherwise(F.lit("MerchantApp")).alias("source"),
            F.col("event_type").alias("event_name"),
        )

    def app_dump(self) -> DataFrame:
        # One snapshot per (merchant, day); the list text keeps event order.
        e = self._shifted_events()
        app = (
            F.when(F.col("event_type") == "view", "Paytm")
            .when(F.col("event_type") == "click", "PhonePe")
            .when(F.col("event_type") == "purchase", "Khatabook")
            .when(F.col("event_type") == "signup", "CRED")
            .otherwise(F.concat(F.lit("OtherApp"), (F.col("event_id") % 4).cast("string")))
        )
        item = F.concat(
            F.lit("{'appName': '"), app, F.lit("', 'packageName': 'com."), F.lower(app), F.lit("'}")
        )
        g = e.groupBy(F.col("user_id").alias("merchant_id"), F.to_date("created_at").alias("date")).agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("event_id", item.alias("item")))), lambda x: x["item"]),
                ", ",
            ).alias("items")
        )
        text = F.when(
            F.col("merchant_id") % 13 == 0, F.concat(F.lit('"['), F.col("items"))
        ).otherwise(F.concat(F.lit('"['), F.col("items"), F.lit(']"')))
        return g.select("merchant_id", "date", text.alias("app_details"))

    def device_info(self) -> DataFrame:
        s = self.read("supplier").filter(F.col("s_suppkey") % 11 != 0)
        k = F.col("s_suppkey") % 7
        man = (  # odd suppliers spread over more brands than a top 20 holds
            F.when(F.col("s_suppkey") % 2 == 1, F.concat(F.lit("Brand "), (F.col("s_suppkey") % 31).cast("string")))
            .when(k == 0, "Samsung")
            .when(k == 1, "VIVO")
            .when(k == 2, "TECNO MOBILE LIMITED")
            .when(k == 3, "HMD Global")
            .when(k == 4, "unknownbrand")
            .when(k == 5, "xiaomi")
        )
        return s.select(F.col("s_suppkey").alias("merchant_id"), man.alias("manufacturer"))

    def scored(self) -> DataFrame:
        c = self.read("customer")
        k = F.col("c_custkey")
        return c.select(
            k.alias("merchant_id"),
            (k % 3 == 0).cast("int").alias("target"),
            ((k * 7919 % 1300) / 1300.0).alias("prob"),
        )


def _ts(d: dt.date) -> Column:
    """Timestamp literal for a date, so ``ts >= date`` pushes down to parquet."""
    return F.to_timestamp_ntz(F.lit(f"{d.isoformat()} 00:00:00"))


def _app_status() -> Column:
    return F.when(F.col("l_linestatus") == "F", F.lit("ORDERED")).otherwise(F.lit("CANCELLED")).alias("status")
