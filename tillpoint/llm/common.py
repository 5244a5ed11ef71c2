"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.sources.sinks import stage, staged_rows  # noqa: F401

#: The word and space classes of every word-based operator.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE_RE = r"[\x20\x09-\x0D]+"
#: Rows an Arrow batch may hold when rows carry whole texts.
TEXT_BATCH_ROWS = 256
DEFAULT_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def narrow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text) of ``df``; null texts stay null."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def text_key(col: str = "text") -> Column:
    """64-bit fingerprint of a text; with the id it names a row.  Rows equal in both
    are the same document written twice and get the same decision."""
    return F.xxhash64(text_of(col))


def python_tasks(spark: SparkSession) -> None:
    """Settings for Python tasks that get whole texts: bounded Arrow batches, and this
    package on the workers' path (on a cluster it is installed or sent with --py-files)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def tasks_for(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# --------------------------------------------------------------------------
# numpy helpers that work on the bytes of many texts at once
# --------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), in wrapping arithmetic."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array; null is empty."""
    import pyarrow as pa

    array = array.cast(pa.large_binary()) if not pa.types.is_large_binary(array.type) else array
    if array.null_count:
        array = array.fill_null(b"")
    bufs = array.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    if bufs[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(bufs[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word of every row; words never cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, s, side="right") - 1
    return s, e, row


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [s, e), disjoint and ascending: eight bytes at a time."""
    h = (e - s).astype(np.uint64) * _MULT
    if not len(s):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    at, left, live = s.copy(), e - s, np.arange(len(s))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)
    while len(live):
        got = np.ascontiguousarray(words[at]).view(np.uint64).ravel() & masks[np.minimum(left, 8)]
        h[live] = mix(h[live] ^ got) * _MULT  # one to one in the eight bytes
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return mix(h)


def single_threaded_tokenizers() -> None:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
