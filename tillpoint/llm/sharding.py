"""Sharding through fixed virtual slots (DataFrame operations only).

Every record hashes into one of ``n_slots`` virtual slots (a number fixed for the
life of the data set, in the thousands).  Bytes and rows are aggregated per slot
(map-side partials, at most ``n_slots`` result rows), and a versioned map sends
each slot to a shard.  Growing or rebalancing edits the map: only whole slots move,
and a new version is appended, so every earlier placement can still be resolved.

Edge rules: a null text has no bytes (size is 8, the record header) and checksum 0; a
null id hashes like any other value together with the text's checksum; repeated rows
share a slot; more shards than slots leaves shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tillpoint.llm.common import narrow, stage, text_of

N_SLOTS = 4096
#: The driver edits the map, so its size is a checked constant.
MAX_SLOTS = 65_536
HEADER_BYTES = 8
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, rows long"


def slotted(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot of every record."""
    if not 0 < n_slots <= MAX_SLOTS:
        raise ValueError(f"n_slots must be between 1 and {MAX_SLOTS}")
    base = narrow(docs).select(
        "doc_id",
        (F.octet_length(text_of()).cast("long") + F.lit(HEADER_BYTES)).alias("size"),
        F.crc32(text_of().cast("binary")).cast("long").alias("text_crc32"),
    )
    return base.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_slots)).cast("int"))


def slot_loads(slots: DataFrame) -> DataFrame:
    return slots.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(loads: list, n_slots: int, n_shards: int) -> dict[int, int]:
    """Largest slot first, each to the lightest shard; slots without rows are dealt in turn."""
    import heapq

    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for r in sorted(loads, key=lambda r: (-r["bytes"], r["vslot"])):
        total, shard = heapq.heappop(heap)
        out[r["vslot"]] = shard
        heapq.heappush(heap, (total + r["bytes"], shard))
    for v in range(n_slots):
        out.setdefault(v, v % n_shards)
    return out


def rebalanced(old: dict[int, int], loads: list, n_shards: int) -> dict[int, int]:
    """Edit ``old`` for ``n_shards`` shards, moving as few bytes as the balance needs: slots of
    removed shards go first, then the largest slots that fit move from shards over the mean
    to the lightest shard."""
    size = {r["vslot"]: r["bytes"] for r in loads}
    new, total = dict(old), [0] * n_shards
    held: dict[int, list[int]] = {s: [] for s in range(n_shards)}
    homeless = []
    for v, s in old.items():
        if s < n_shards:
            total[s] += size.get(v, 0)
            held[s].append(v)
        else:
            homeless.append(v)

    def give(v: int) -> None:
        to = min(range(n_shards), key=lambda s: (total[s], s))
        new[v] = to
        total[to] += size.get(v, 0)
        held[to].append(v)

    for v in sorted(homeless, key=lambda v: -size.get(v, 0)):
        give(v)
    mean = sum(total) / n_shards
    for s in sorted(range(n_shards), key=lambda s: -total[s]):
        for v in sorted(held[s], key=lambda v: (-size.get(v, 0), v)):
            w, low = size.get(v, 0), min(range(n_shards), key=lambda t: (total[t], t))
            if w and total[s] - w >= mean and total[low] + w <= mean and low != s:
                total[s] -= w
                held[s].remove(v)
                give(v)
    return new


def map_frame(spark: SparkSession, assignment: dict[int, int], loads: list, version: int) -> DataFrame:
    by = {r["vslot"]: r for r in loads}
    rows = [(version, v, s, int(by[v]["bytes"]) if v in by else 0, int(by[v]["rows"]) if v in by else 0) for v, s in sorted(assignment.items())]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def store_map(map_df: DataFrame, path: str) -> None:
    """Append a version; earlier versions stay readable."""
    map_df.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    m = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = m.agg(F.max("version")).first()[0]
    return m.filter(F.col("version") == F.lit(version))


def placed(slots: DataFrame, map_df: DataFrame) -> DataFrame:
    """Join records to a map version.  The map has ``n_slots`` rows, so it is broadcast; the
    place within a shard is the slot's first place plus the record's rank in its slot, so no
    window ever holds a whole shard."""
    first = map_df.withColumn(
        "first", F.sum("rows").over(W.Window.partitionBy("shard").orderBy("vslot")) - F.col("rows")
    ).select("vslot", "shard", "first")
    rank = F.row_number().over(W.Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return (
        slots.withColumn("rank", rank)
        .join(F.broadcast(first), "vslot")
        .withColumn("slot", F.col("first") + F.col("rank") - F.lit(1).cast("long"))
    )


def shard(docs: DataFrame, n_shards: int = 24, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Place every record: doc_id, size, text_crc32, vslot, shard, slot.  With ``map_path``
    the first map is stored there as version 1."""
    slots = stage(slotted(docs, n_slots))
    loads = slot_loads(slots).collect()  # at most n_slots rows
    m = map_frame(docs.sparkSession, first_map(loads, n_slots, n_shards), loads, 1)
    if map_path:
        store_map(m, map_path)
    return placed(slots, m)


def sharded_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """The digest of ``shard``: sizes of the shards are near equal (law ``bytes``)."""
    return shard(docs, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot",
    )
