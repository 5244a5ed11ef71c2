"""Token ids as compressed blocks with a shared zstandard dictionary.

A dictionary is trained on the serialized ids of at most ``SAMPLE_DOCS`` documents of at most
``SAMPLE_BYTES`` bytes each (those with the smallest id hashes); it only affects the size.
Every document's whole ids are one zstandard frame, so a short document can be read alone.

A block file is a parquet row (Spark commits it, on any file system) whose ``blob`` is:
magic ``TPZ1``; 32 bytes SHA-256 of the dictionary; u4 documents, u4 bytes per id; then
per document: i8 id, u1 id present, u8 frame offset from the first frame, u4 ids; u8 end
offset; the frames.  The dictionary is a row of its own beside the blocks.

Blocks are in ascending order of (doc_id, text fingerprint), nulls first: the rows are
range-partitioned, so a third of all rows with one id still spread over partitions by their texts.

Edge rules: a null text is empty (only the end id); an empty table writes no block.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tillpoint.llm.common import narrow, python_tasks, tasks_for, text_key, text_of, tokenizer_path
from tillpoint.session import checkpoint_dir

SAMPLE_DOCS = 1000
SAMPLE_BYTES = 32_768
DICT_BYTES = 65_536
BLOCK_TOKEN_BYTES = 1 << 20
LEVEL = 3
MAGIC = b"TPZ1"
_HEAD = struct.Struct("<4s32sII")


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A zstandard dictionary from a bounded sample's serialized ids (empty if too few)."""
    import zstandard

    texts = (
        narrow(docs).filter(F.octet_length("text").between(64, SAMPLE_BYTES))
        .orderBy(F.xxhash64("doc_id"), text_key()).limit(SAMPLE_DOCS).select("text")
    )

    def ids(batches):
        import pyarrow as pa

        from tillpoint.llm.tokens import encoder

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([encoder(path).encode(t).tobytes() for t in b.column(0).to_pylist()], pa.binary())], ["ids"])

    samples = [bytes(r.ids) for r in texts.mapInArrow(ids, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def pack_block(rows: list[tuple], dictionary: bytes, width: int) -> bytes:
    """rows: (doc_id or None, ids as bytes)."""
    import zstandard

    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=True)
    frames = [c.compress(ids) for _, ids in rows]
    ends = np.cumsum([0, *map(len, frames)]).astype("<u8")
    return b"".join([
        _HEAD.pack(MAGIC, hashlib.sha256(dictionary).digest(), len(rows), width),
        np.array([i or 0 for i, _ in rows], "<i8").tobytes(),
        np.array([i is not None for i, _ in rows], "u1").tobytes(),
        ends.tobytes(),
        np.array([len(ids) // width for _, ids in rows], "<u4").tobytes(),
        *frames,
    ])


class Block:
    """Read access to one block: the index at once, frames one by one."""

    def __init__(self, blob: bytes, dictionary: bytes):
        import zstandard

        magic, digest, n, self.width = _HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a token block")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(blob, "<i8", n, at)
        self.present = np.frombuffer(blob, "u1", n, at + 8 * n)
        self.offsets = np.frombuffer(blob, "<u8", n + 1, at + 9 * n)
        self.counts = np.frombuffer(blob, "<u4", n, at + 9 * n + 8 * (n + 1))
        self.first = at + 9 * n + 8 * (n + 1) + 4 * n
        self.blob = blob
        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.z = zstandard.ZstdDecompressor(dict_data=d)

    def ids(self, k: int) -> np.ndarray:
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        raw = self.z.decompress(self.blob[self.first + a : self.first + b])
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, by binary search in the index."""
        k = int(np.searchsorted(self.doc_ids, doc_id))
        k += int(np.searchsorted(self.present[k:], 1)) if k < len(self.doc_ids) and not self.present[k] else 0
        return self.ids(k) if k < len(self.doc_ids) and self.doc_ids[k] == doc_id and self.present[k] else None


def write_tokens(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = 2) -> str:
    """Encode every document and write blocks and dictionary below ``out``."""
    spark = docs.sparkSession
    python_tasks(spark)
    path = tokenizer or tokenizer_path()
    dictionary = train_dictionary(docs, path)
    spark.createDataFrame([(bytearray(dictionary), hashlib.sha256(dictionary).hexdigest())], "dictionary binary, sha256 string").coalesce(1).write.parquet(f"{out}/dictionary")
    rows = narrow(docs).select("doc_id", text_key().alias("tkey"), text_of().alias("text"))
    rows = rows.repartitionByRange(tasks_for(spark), "doc_id", "tkey").sortWithinPartitions("doc_id", "tkey")

    def blocks(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tillpoint.llm.tokens import encoder

        enc = encoder(path)
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        end = np.array([end_id], enc.dtype).tobytes()

        def flush():
            n = sum(len(x) for _, x in held) // enc.dtype.itemsize
            blob = pack_block(held, dictionary, enc.dtype.itemsize)
            cols = [[part], [seq], [held[0][0]], [len(held)], [n], [blob]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["part", "seq", "first_id", "docs", "tokens", "blob"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(2)):
                ids = enc.encode(t.as_py()).tobytes() + end
                held.append((i, ids))
                size += len(ids)
                if size >= BLOCK_TOKEN_BYTES:
                    yield flush()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield flush()

    rows.mapInArrow(blocks, "part int, seq long, first_id long, docs long, tokens long, blob binary").write.parquet(f"{out}/blocks")
    return out


def read_dictionary(spark: SparkSession, out: str) -> bytes:
    return bytes(spark.read.parquet(f"{out}/dictionary").first()["dictionary"])


def read_tokens(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, from the files."""
    python_tasks(spark)
    dictionary = read_dictionary(spark, out)
    b = spark.read.parquet(f"{out}/blocks")
    # ids before each partition (one row per partition), then before each block in it
    parts = b.groupBy("part").agg(F.sum("tokens").alias("t"))
    before = parts.select("part", (F.sum("t").over(W.Window.orderBy("part")) - F.col("t")).alias("before"))
    w = W.Window.partitionBy("part").orderBy("seq")
    starts = b.select("part", "seq", "tokens").withColumn("own", F.sum("tokens").over(w) - F.col("tokens")).join(F.broadcast(before), "part").select("part", "seq", (F.col("own") + F.col("before")).alias("start"))
    rows = b.select("part", "seq", "blob").join(starts, ["part", "seq"]).select("start", "blob")

    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            for start, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(blob.as_py(), dictionary)
                ids, crc, raw = None, [], []
                for k in range(len(block.counts)):
                    ids = block.ids(k)
                    if len(ids) != block.counts[k]:
                        raise ValueError("a frame and the index disagree")
                    wide = ids.astype("<u4").tobytes()
                    crc.append(zlib.crc32(wide))
                    if with_ids:
                        raw.append(wide)
                n = block.counts.astype(np.int64)
                cols = [
                    pa.array(block.doc_ids, pa.int64(), mask=block.present == 0),
                    pa.array(start + np.cumsum(n) - n, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                ] + ([pa.array(raw, pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return rows.mapInArrow(decode, schema)


def token_files(docs: DataFrame) -> DataFrame:
    """The digest of every document, read back from files in the shared checkpoint folder."""
    spark = docs.sparkSession
    out = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    return read_tokens(spark, write_tokens(docs, out))
