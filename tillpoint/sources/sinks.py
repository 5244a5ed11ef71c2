"""Sinks and staging.

* ``stage``: cut lineage of an intermediate that several later plans read
  (reliable checkpoint in the shared folder named by ``spark.checkpoint.dir``;
  never a machine-local folder, never a local checkpoint).
* ``write_table`` / ``overwrite_partitions``: replace a catalogue table (partitioned,
  bucketed) or some of its partitions; ``publish_facts`` lays the facts out.
* ``export_csv``: write a headed CSV export.

Materialise-if-absent, the extract step of the source pipeline, is in ``sources.extracts``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillpoint.session import checkpoint_dir


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as parquet in the shared checkpoint folder and return
    a frame reading it back: one computation, lineage cut, column pruning on
    the re-read, and it survives executor loss (the files are on the shared
    file system, not on an executor)."""
    if is_staged(df):
        return df
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/stage-{uuid.uuid4().hex}"
    # the row count is collected by the write job itself (no extra job)
    obs = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # known schema: no footer-inference job
    out._tillpoint_staged = True
    out._tillpoint_rows = int(obs.get["rows"])
    return out


def staged_rows(df: DataFrame) -> int | None:
    """Row count recorded when ``df`` was staged (None if it was not)."""
    return getattr(df, "_tillpoint_rows", None)


def is_staged(df: DataFrame) -> bool:
    return bool(getattr(df, "_tillpoint_staged", False))


def is_committed(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds the marker that Spark writes when a job has committed."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
) -> None:
    """Replace a catalogue table.  With ``bucket_by`` its rows are dealt to ``buckets`` files of
    each partition by that key and sorted by it, so joins and groupings by the key need no
    exchange.  Each bucket of a partition is one task's (and file's), so a key that holds a
    third of all rows is written by as many tasks as there are partitions."""
    if bucket_by:
        df = df.repartition(F.pmod(F.hash(bucket_by), F.lit(buckets)), *partition_by)  # the bucket's number
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    w.saveAsTable(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace only those partitions of a table that ``df`` has rows of; columns go by name."""
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def publish_facts(tables, database: str, buckets: int) -> dict[str, str]:
    """Lay the fact and mart tables out for the plans of this package, as catalogue tables
    (logical name -> table): transactions by month and merchant, the mart by merchant.
    Read back with ``Tables.from_catalog(..., months=MONTHS)``."""
    names = {n: f"{database}.{n}" for n in ("transactions", "merchant_mart")}
    tx = tables.get("transactions").withColumn("payment_month", F.trunc("payment_timestamp", "month"))
    write_table(tx, names["transactions"], ["payment_month"], "merchant_id", buckets)
    write_table(tables.get("merchant_mart"), names["merchant_mart"], (), "merchant_id", buckets)
    return names


#: The month column that goes with a timestamp of a published table.
MONTHS = {("transactions", "payment_timestamp"): "payment_month"}


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
