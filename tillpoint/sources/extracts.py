"""Restartable extracts: chunks committed one by one, a manifest published last.

An extract lives below its own folder:

    <path>/<run>/chunk=<i>          the rows of chunk i (committed by Spark's marker)
    <path>/<run>/manifest           one row per chunk: name, chunk, rows, fingerprint (written last)

``run`` is the head of the extract's fingerprint: the files its inputs consist of (path, length,
time of change), the number of chunks and the parameters.  A run that ended half-way is taken up
at its first missing chunk; changed inputs or parameters make a new run beside the old one, and
readers see a run only when its manifest is there.  Nothing is overwritten in place.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillpoint.sources.sinks import is_committed
from tillpoint.sources.tables import Tables

#: Up to how many files a table's own files are told apart from others in their folders.
LISTED = 1000
MANIFEST = "name string, chunk int, rows bigint, fingerprint string"


def fingerprint(tables: Tables, names: Iterable[str], parameters: object = None) -> str:
    """SHA-256 over the files behind the named tables and the parameters.

    Spark lists the folders of the files (content is not read) and hashes path, length and
    modification time in an aggregate; a table without files counts by its plan."""
    spark, parts = tables.spark, [json.dumps(parameters, sort_keys=True, default=str)]
    for name in sorted(set(names)):
        df = tables.get(name)
        own = [re.sub("^file:/+", "file:/", f) for f in df.inputFiles()]
        if not own:
            parts.append(f"{name}:{df.semanticHash()}")
            continue
        files = spark.read.format("binaryFile").load(sorted({f.rsplit("/", 1)[0] for f in own}))
        files = files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "length", "modificationTime")
        if len(own) <= LISTED:  # else any file beside them counts as well
            files = files.filter(F.col("path").isin(own))
        r = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
        parts.append(f"{name}:{r[0]}:{r[1]}:{r[2]}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def run_folder(path: str, mark: str, chunks: int) -> str:
    return f"{path.rstrip('/')}/{mark[:16]}-{chunks}"


def is_published(spark: SparkSession, path: str, mark: str, chunks: int) -> bool:
    return is_committed(spark, f"{run_folder(path, mark, chunks)}/manifest")


def read_extract(spark: SparkSession, path: str, mark: str, chunks: int) -> DataFrame:
    """The rows of a published run, checked against its manifest."""
    base = run_folder(path, mark, chunks)
    manifest = spark.read.schema(MANIFEST).parquet(f"{base}/manifest").collect()  # one row per chunk
    if sorted(r["chunk"] for r in manifest) != list(range(chunks)) or any(r["fingerprint"] != mark for r in manifest):
        raise ValueError(f"the manifest of {base} is not one of this run")
    return spark.read.parquet(*[f"{base}/chunk={i}" for i in range(chunks)])


def extract(
    tables: Tables,
    name: str,
    build: Callable[[Tables], DataFrame],
    path: str,
    inputs: Iterable[str],
    chunks: int = 1,
    parameters: object = None,
) -> DataFrame:
    """Rows of ``build`` over all chunks of the tables, materialised below ``path`` if they are
    not there yet.  ``inputs``: the logical tables that ``build`` reads.  With one chunk the tables
    are not cut (and NULL keys stay)."""
    spark = tables.spark
    mark = fingerprint(tables, inputs, [name, chunks, parameters])
    base = run_folder(path, mark, chunks)
    if not is_published(spark, path, mark, chunks):
        rows = []
        for i in range(chunks):
            at = f"{base}/chunk={i}"
            if is_committed(spark, at):
                n = spark.read.parquet(at).count()
            else:
                seen = Observation()
                df = build(tables if chunks == 1 else tables.chunk(chunks, i))
                df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(at)  # only an unfinished chunk is there
                n = seen.get["n"]
            rows.append((name, i, n, mark))
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest")
    return read_extract(spark, path, mark, chunks)
