"""Packing documents into fixed windows with their lexical neighbours.

Documents are encoded once and staged as ids with a lexical sketch (the smallest hash over
adjacent id pairs), then range-partitioned by (sketch, id), so that texts with
common pairs meet and a large group of copies still splits by id.  Each partition works
through bounded shards of ``SHARD_TOKENS`` tokens or ``SHARD_DOCS`` documents: a BM25 inverted
index over the shard's token ids ranks, for each seed document and all its distinct terms, the
documents that are not used yet, and they greedily fill the seed's window.  The last one is cut where the window ends and its rest
stays in the shard; a shard's unfinished window goes over to the next shard, so only the
last window of a partition is padded.

Edge rules: a null text is empty (one id, the end id); repeated rows are packed once each; an
empty table packs nothing.  Every id of every document lies in exactly one piece.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import mix, narrow, python_tasks, stage, tasks_for, text_of, tokenizer_path

WINDOW = 2048
SHARD_TOKENS = 1 << 20
#: Bounds the index of a shard (terms x documents); at least a window's worth of one-token documents.
SHARD_DOCS = 2048
MIN_PARTITION_TOKENS = 1 << 20
K1, B = 1.2, 0.75
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, ids (little-endian, the tokenizer's width), n, sketch; staged."""
    python_tasks(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        from tillpoint.llm.tokens import encoder

        enc = encoder(path)
        end = np.array([end_id], enc.dtype)
        for b in batches:
            if not b.num_rows:
                continue
            parts = [x for t in b.column(1).to_pylist() for x in (enc.encode(t), end)]
            n = np.array([len(x) for x in parts[::2]]) + 1
            ids = np.concatenate(parts).astype(enc.dtype, copy=False)
            ends = np.concatenate([[0], np.cumsum(n)])
            # adjacent pairs of the batch; those across documents never are the smallest
            wide = ids.astype(np.uint64)
            pairs = np.full(len(ids), np.iinfo(np.uint64).max)
            pairs[:-1] = mix((wide[:-1] << np.uint64(32)) | wide[1:])
            pairs[ends[1:] - 1] = np.iinfo(np.uint64).max
            sketch = np.where(n > 1, np.minimum.reduceat(pairs, ends[:-1]) >> np.uint64(1), 0).astype(np.int64)
            offsets = pa.py_buffer((ends * ids.itemsize).astype(np.int64))
            raw = pa.Array.from_buffers(pa.large_binary(), len(n), [None, offsets, pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), raw, pa.array(n, pa.int64()), pa.array(sketch)], ["doc_id", "ids", "n", "sketch"])

    rows = narrow(docs).select("doc_id", text_of().alias("text"))
    return stage(rows.mapInArrow(run, "doc_id long, ids binary, n long, sketch long"))


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value's run, their lengths) of ascending values, without sorting them again."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return np.cumsum(new) - 1, np.diff(np.append(np.flatnonzero(new), len(x)))


class Shard:
    """BM25 over the token ids of the documents of one shard."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        doc = np.repeat(np.arange(n), [len(x) for x in docs])
        key, tf = np.unique(np.concatenate(docs).astype(np.int64) * n + doc, return_counts=True)
        term, doc = key // n, key % n
        place, df = runs(term)
        length = np.array([len(x) for x in docs], float)
        norm = K1 * (1 - B + B * length / length.mean())
        shared = df[place] > 1  # a term of one document finds no other
        doc, tf, df_of = doc[shared], tf[shared], df[place][shared]
        self.n = n
        self.term = runs(place[shared])[0]
        weight = np.log1p((n - df_of + 0.5) / (df_of + 0.5)) * tf * (K1 + 1) / (tf + norm[doc])
        width = int(self.term.max(initial=-1)) + 1
        self.weight = np.zeros((width, n), np.float32)
        self.weight[self.term, doc] = weight
        by_doc = np.argsort(doc.astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")  # 16 bits: a radix sort
        self.term, self.first = self.term[by_doc], np.searchsorted(doc[by_doc], np.arange(n + 1))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents by falling score; all distinct terms of the seed are its query."""
        query = self.term[self.first[seed] : self.first[seed + 1]]
        score = self.weight[query].sum(axis=0) * unused
        hit = np.flatnonzero(score)
        return hit[np.lexsort((hit, -score[hit]))]


def fill(docs: list[np.ndarray], begun: list[int], window: int, last: bool) -> tuple[list[list[tuple[int, int, int]]], dict[int, int]]:
    """Windows of (document, from, to), and for documents that are left where they go on.
    ``begun``: where each document starts.  Unless ``last``, an unfinished window is undone."""
    at, unused = list(begun), np.ones(len(docs), bool)
    index, out = Shard(docs), []
    spare = 0  # the first document that may be unused

    def take(k: int, room: int) -> tuple[int, int, int]:
        a, b = at[k], min(len(docs[k]), at[k] + room)
        at[k] = b
        unused[k] = b < len(docs[k])
        return k, a, b

    while True:
        while spare < len(docs) and not unused[spare]:
            spare += 1
        if spare == len(docs):
            return out, {}
        before, pieces, room = {}, [], window
        seed = spare
        queue = [seed]
        asked = False
        while room and queue:
            k = queue.pop()
            if not unused[k]:
                continue
            before.setdefault(k, at[k])
            pieces.append(take(k, room))
            room -= pieces[-1][2] - pieces[-1][1]
            if room and not queue:
                if not asked:
                    queue, asked = index.neighbours(seed, unused).tolist()[::-1], True
                if not queue:  # nothing lexical is left: the next seed in order joins
                    rest = np.flatnonzero(unused)
                    if len(rest):
                        seed, asked = int(rest[0]), False
                        queue = [seed]
        if room and not last:
            for k, a in before.items():
                at[k], unused[k] = a, True
            return out, {k: at[k] for k in np.flatnonzero(unused).tolist()}
        out.append(pieces)


def packed(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece (see ``SCHEMA``); with ``with_ids`` also its ids."""
    path = tokenizer or tokenizer_path()
    rows = encoded(docs, path, end_id)
    spark = docs.sparkSession
    total = rows.agg(F.sum("n")).first()[0] or 0
    n = max(1, min(tasks_for(spark), total // MIN_PARTITION_TOKENS))
    wide = "<u4"

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tillpoint.llm.tokens import encoder

        dtype = encoder(path).dtype
        sequence = TaskContext.get().partitionId() << 32
        held: list[list] = []  # [doc_id, ids, where to go on]

        def shard(last):
            nonlocal sequence, held
            windows, left = fill([x[1] for x in held], [x[2] for x in held], window, last)
            out = []
            for pieces in windows:
                offset = 0
                for k, a, b in pieces:
                    ids = held[k][1][a:b].astype(wide).tobytes()
                    out.append((held[k][0], a, b - a, zlib.crc32(ids), len(held[k][1]), sequence, offset, ids))
                    offset += b - a
                sequence += 1
            held = [[held[k][0], held[k][1], a] for k, a in left.items()]
            cols = list(zip(*out)) if out else [()] * 8
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols[7], pa.binary())], [*names, "ids"]
            return pa.RecordBatch.from_arrays(arrays, names)

        size = 0
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1)):
                held.append([i, np.frombuffer(raw.as_py(), dtype), 0])
                size += len(held[-1][1])
                if size >= SHARD_TOKENS or len(held) >= max(SHARD_DOCS, window):
                    yield shard(False)
                    size = sum(len(x[1]) - x[2] for x in held)
        if held:
            yield shard(True)

    dealt = rows.repartitionByRange(int(n), "sketch", "doc_id").sortWithinPartitions("sketch", "doc_id").select("doc_id", "ids")
    return dealt.mapInArrow(run, SCHEMA + (", ids binary" if with_ids else ""))
