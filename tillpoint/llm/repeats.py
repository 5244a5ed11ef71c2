"""Removal of repeated 400-byte strings with per-shard suffix arrays.

The strings of all documents are dealt to shards by content: a string belongs to the position
of the smallest hash among its 64-byte grams (leftmost on ties), so equal strings have
the same anchor gram at the same offset and always meet.  A run of successive strings with one
anchor is a context, at most 2 x 400 bytes.  Contexts whose anchor gram occurs once in the
corpus can't hold a repeat and stop here; the others go to shards of about
``SHARD_BYTES``.  Copies of a context collapse (an anchor whose contexts are all one text is
done: all its strings repeat); in a shard a suffix array is built by
Larsson-Sadakane refinement (only groups that are still tied are sorted again, by the
rank ``h`` further on, until none is tied), common prefixes of neighbours come from Kasai's pass, run for all
contexts in step, and neighbours that share 400 bytes are repeats.

An anchor with more than ``HOT`` contexts is split over shards by document.  Each of
its shards then publishes the hash of every distinct string once, sorted; the published
lists are dealt by hash range and merged by binary search, which finds what repeats only
across shards.

Edge rules: a null text is empty; matches never cross documents; equal rows are different
documents, so their strings repeat; texts under 400 bytes are never touched.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import column_bytes, mix, narrow, python_tasks, stage, tasks_for, text_key, text_of

LENGTH = 400
GRAM = 64
SHARD_BYTES = 4 << 20
HOT = 2000
SLICE = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 21) - 1)


def _inverse(x: np.uint64) -> np.uint64:
    """Of an odd number modulo 2**64, by Newton's iteration."""
    y = int(x)
    for _ in range(6):
        y = y * (2 - int(x) * y) % 2**64
    return np.uint64(y)


_POWER = np.concatenate([[np.uint64(1)], np.cumprod(np.full(SLICE + 4 * LENGTH, _BASE))])
_POWER_BACK = np.concatenate([[np.uint64(1)], np.cumprod(np.full(SLICE + 4 * LENGTH, _inverse(_BASE)))])


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-byte windows of at most SLICE + 4 * LENGTH bytes."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWER[:n])])
    return mix((total[width:] - total[: n - width + 1]) * _POWER_BACK[: n - width + 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    grid = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first start, last start, anchor position, anchor hash) of every run of strings;
    positions are in ``data``."""
    out: list[tuple[np.ndarray, ...]] = []
    n, wide = len(data), LENGTH - GRAM + 1
    for a in range(0, max(0, n - LENGTH + 1), SLICE):
        part = data[a : a + SLICE + LENGTH - 1]
        h = rolling(part, GRAM)
        if len(h) < wide:
            break
        least = sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), wide)
        p = a + np.arange(len(least))
        row = np.searchsorted(offsets, p, side="right") - 1
        ok = p + LENGTH <= offsets[row + 1]
        p, row, at = p[ok], row[ok], (least[ok] & _LOW).astype(np.int64)
        if not len(p):
            continue
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (p[1:] != p[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(p)) - 1
        out.append((row[first], p[first], p[last], a + at[first], h[at[first]]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes (Larsson-Sadakane, in numpy)."""
    n = len(t)
    padded = np.concatenate([t, np.zeros(8, np.uint8)])
    key = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[:n]).view(">u8").ravel().astype(np.uint64)
    sa = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[sa][1:] != key[sa][:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    at = np.flatnonzero(~new | np.append(~new[1:], False))  # places in groups of two or more
    while h < depth and len(at):
        i = sa[at]
        further = np.where(i + h < n, rank[np.minimum(i + h, n - 1)] + 1, 0)
        pair = rank[i] * (n + 1) + further
        order = np.argsort(pair, kind="stable")
        sa[at], pair = i[order], pair[order]
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank[sa[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        at = at[~new | np.append(~new[1:], False)]
        h *= 2
    return sa


def common_prefixes(t: np.ndarray, sa: np.ndarray, starts: np.ndarray, lengths: np.ndarray, cap: int) -> np.ndarray:
    """By place in ``sa``: bytes shared with the place before, up to ``cap``.  Kasai's pass, run for
    all texts (``starts``, ``lengths``) in step, eight bytes at a comparison."""
    n = len(t)
    inverse = np.empty(n, np.int64)
    inverse[sa] = np.arange(n)
    padded = np.lib.stride_tricks.sliding_window_view(np.concatenate([t, np.zeros(cap + 16, np.uint8)]), 8)
    load = lambda at: np.ascontiguousarray(padded[at]).view("<u8").ravel()
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")
    lcp, h = np.zeros(n, np.int32), np.zeros(len(starts), np.int64)
    for step, k in enumerate(active):
        i = starts[:k] + step
        r = inverse[i]
        j = sa[r - 1]
        own = h[:k]
        own[r == 0] = 0
        live = np.flatnonzero(r > 0)
        while len(live):
            x = load(i[live] + own[live]) ^ load(j[live] + own[live])
            same = x == 0
            low = x & (~x + np.uint64(1))
            own[live] += np.where(same, 8, np.log2(np.where(same, 1, low).astype(float)).astype(np.int64) // 8)
            live = live[same & (own[live] < cap)]
        np.minimum(own, np.minimum(cap, n - np.maximum(i, j)), out=own, where=r > 0)
        lcp[r] = own
        np.maximum(own - 1, 0, out=own)
    return lcp


def shard_repeats(texts: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place in it, group of equal strings, repeated) of every string of the distinct
    ``texts``, of which ``counts`` copies exist."""
    lengths = np.array([len(x) for x in texts])
    t = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(lengths) - lengths
    sa = suffix_array(t, len(t))  # the carry in Kasai's pass holds on the full order only
    lcp = common_prefixes(t, sa, starts, lengths, LENGTH)
    text = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(t)) - starts[text]
    valid = place + LENGTH <= lengths[text]
    group = np.empty(len(t), np.int64)
    group[sa] = np.cumsum(lcp < LENGTH)
    n = np.bincount(group, np.where(valid, counts[text], 0), minlength=int(group.max(initial=0)) + 1)
    v = np.flatnonzero(valid)
    return text[v], place[v], group[v], n[group[v]] >= 2


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges covered by strings that start at the ascending ``places``."""
    cut = np.flatnonzero(np.diff(places) > LENGTH) + 1
    return [(int(x[0]), int(x[-1]) + LENGTH) for x in np.split(places, cut) if len(x)]


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, lo, hi (starts of a run), pos (of the anchor), gram of every context."""
    python_tasks(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            data, offsets = column_bytes(b.column(2))
            row, lo, hi, pos, gram = contexts(data, offsets)
            base = offsets[row]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array((lo - base).astype(np.int64)), pa.array((hi - base).astype(np.int64)), pa.array((pos - base).astype(np.int64)), pa.array(gram.view(np.int64))],
                ["doc_id", "tkey", "lo", "hi", "pos", "gram"],
            )

    rows = narrow(docs).select("doc_id", text_key().alias("tkey"), "text")
    return rows.mapInArrow(run, "doc_id long, tkey long, lo long, hi long, pos long, gram long")


def repeated_ranges(docs: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tkey, text, runs of documents with candidate contexts; doc_id, tkey, froms, tos
    of byte ranges to remove)."""
    spark = docs.sparkSession
    found = stage(anchors(docs))
    twice = found.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    subs = F.ceil(F.col("c") / F.lit(hot)).cast("int")
    kept = found.join(twice, "gram").withColumn("subs", subs)
    by_doc = kept.groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("lo", "hi", "gram", "subs")).alias("runs"))
    by_doc = by_doc.select(F.col("doc_id").alias("kid"), F.col("tkey").alias("kkey"), "runs")
    d = narrow(docs).withColumn("tkey", text_key())
    affected = stage(d.join(by_doc, d["doc_id"].eqNullSafe(by_doc["kid"]) & (d["tkey"] == by_doc["kkey"])).select("doc_id", "tkey", "text", "runs"))
    size = affected.select(
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["hi"] - r["lo"] + LENGTH).alias("b"),
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + F.when(r["subs"] > 1, r["hi"] - r["lo"] + 1).otherwise(0)).alias("h"),
    ).agg(F.sum("b").alias("b"), F.sum("h").alias("h")).first()
    shards = max(tasks_for(spark), (size["b"] or 0) // (4 * SHARD_BYTES))  # a task flushes at SHARD_BYTES of distinct text
    ranges = max(4, (size["h"] or 0) // 1_000_000)

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            for r in range(b.num_rows):
                text, runs = b.column(2)[r].as_py().encode(), b.column(3)[r].as_py()
                key = hash((b.column(0)[r].as_py(), b.column(1)[r].as_py())) & 0x7FFFFFFF
                cols = [
                    pa.array([x["gram"] for x in runs], pa.int64()), pa.array([key % x["subs"] if x["subs"] > 1 else -1 for x in runs], pa.int32()),
                    pa.array([b.column(0)[r].as_py()] * len(runs), pa.int64()), pa.array([b.column(1)[r].as_py()] * len(runs), pa.int64()),
                    pa.array([x["lo"] for x in runs], pa.int64()), pa.array([text[x["lo"] : x["hi"] + LENGTH] for x in runs], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["gram", "sub", "doc_id", "tkey", "lo", "ctx"])

    ctx = affected.mapInArrow(cut, "gram long, sub int, doc_id long, tkey long, lo long, ctx binary")
    dealt = ctx.repartition(int(shards), "gram", "sub").sortWithinPartitions("gram", "sub")

    def search(batches):
        """Shard by shard; rows with ``bucket`` null are ranges, the others published strings."""
        import pyarrow as pa

        def work(rows):
            texts: dict[bytes, int] = {}
            own = [texts.setdefault(r[5], len(texts)) for r in rows]
            is_hot = np.zeros(len(texts), bool)
            for r, k in zip(rows, own):
                is_hot[k] |= r[1] >= 0
            copies = np.bincount(own, minlength=len(texts))
            text, place, group, again = shard_repeats(list(texts), copies)
            first = np.searchsorted(text, np.arange(len(texts) + 1))
            spans = [_runs(place[first[k] : first[k + 1]][again[first[k] : first[k + 1]]]) for k in range(len(texts))]
            out = [(r[2], r[3], [r[4] + a for a, _ in spans[k]], [r[4] + b for _, b in spans[k]], None, None) for r, k in zip(rows, own) if spans[k]]
            pick = np.flatnonzero(is_hot[text])
            if len(pick):
                whole = list(texts)
                h = np.zeros(len(text), np.uint64)
                for k in np.flatnonzero(is_hot):
                    h[first[k] : first[k + 1]] = rolling(np.frombuffer(whole[k], np.uint8), LENGTH)[place[first[k] : first[k + 1]]]
                # one entry for each distinct string; those that repeat here need no answer
                _, one = np.unique(group[pick], return_index=True)
                one = pick[one]
                holder = {k: r for r, k in zip(rows, own)}
                ids = np.array([holder[int(k)][2] if holder[int(k)][2] is not None else 0 for k in text[one]], np.int64)
                null = np.array([holder[int(k)][2] is None for k in text[one]], bool)
                keys = np.array([holder[int(k)][3] for k in text[one]], np.int64)
                at = np.array([holder[int(k)][4] for k in text[one]], np.int64) + place[one]
                ask = ~again[one]
                rec = np.rec.fromarrays([h[one], ids, keys, at, null, ask], names="h,i,k,p,n,q")
                rec = rec[np.argsort(rec.h, kind="stable")]
                bucket = (rec.h >> np.uint64(32)).astype(np.int64) * ranges >> 32
                edges = np.searchsorted(bucket, np.arange(ranges + 1))
                out += [(None, None, [], [], k, rec[edges[k] : edges[k + 1]].tobytes()) for k in range(ranges) if edges[k + 1] > edges[k]]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.int64())), pa.array([r[3] for r in out], pa.list_(pa.int64())), pa.array([r[4] for r in out], pa.int32()), pa.array([r[5] for r in out], pa.binary())],
                ["doc_id", "tkey", "froms", "tos", "bucket", "strings"],
            )

        def direct(rows):
            """Whole contexts as ranges."""
            one = lambda v: pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1), pa.int32()), pa.array(v, pa.int64()))
            none = [None] * len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()), one([r[4] for r in rows]), one([r[4] + len(r[5]) for r in rows]), pa.array(none, pa.int32()), pa.array(none, pa.binary())],
                ["doc_id", "tkey", "froms", "tos", "bucket", "strings"],
            )

        held: list = []
        copies: list = []
        group: list = []
        size = 0

        def sort_in():
            """Contexts of one anchor.  If all are one text, every string of theirs repeats and there is
            nothing to order; an anchor that is split over shards is always searched."""
            nonlocal size, group
            texts = {r[5] for r in group}
            if len(texts) == 1 and len(group) > 1 and group[0][1] < 0:
                copies.extend(group)
            else:
                held.extend(group)
                size += sum(map(len, texts))
            group = []

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if group and row[:2] != group[0][:2]:
                    sort_in()
                    if size >= SHARD_BYTES:
                        yield work(held)
                        held.clear()
                        size = 0
                    if len(copies) >= 4096:
                        yield direct(copies)
                        copies.clear()
                group.append(row)
        if group:
            sort_in()
        if copies:
            yield direct(copies)
        if held:
            yield work(held)

    schema = "doc_id long, tkey long, froms array<long>, tos array<long>, bucket int, strings binary"
    searched = stage(dealt.mapInArrow(search, schema))

    def merge(batches):
        import pyarrow as pa

        kind = np.dtype([("h", "<u8"), ("i", "<i8"), ("k", "<i8"), ("p", "<i8"), ("n", "?"), ("q", "?")])

        def answer(lists):
            every = np.sort(np.concatenate([x["h"] for x in lists]))
            rows = []
            for x in lists:  # a shard's sorted list against all lists
                n = np.searchsorted(every, x["h"], "right") - np.searchsorted(every, x["h"], "left")
                rows.append(x[(n > 1) & x["q"]])
            x = np.concatenate(rows)
            ones = lambda v: pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1), pa.int32()), pa.array(v))
            return pa.RecordBatch.from_arrays(
                [pa.array(x["i"], mask=x["n"]), pa.array(x["k"]), ones(x["p"]), ones(x["p"] + LENGTH)], ["doc_id", "tkey", "froms", "tos"]
            )

        held, now = [], None
        for b in batches:
            for bucket, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if bucket != now and held:
                    yield answer(held)
                    held = []
                now = bucket
                held.append(np.frombuffer(raw, kind))
        if held:
            yield answer(held)

    published = searched.filter("bucket is not null").select("bucket", "strings")
    merged = published.repartition(int(ranges), "bucket").sortWithinPartitions("bucket").mapInArrow(merge, "doc_id long, tkey long, froms array<long>, tos array<long>")
    out = searched.filter("bucket is null").select("doc_id", "tkey", "froms", "tos").union(merged)
    return affected, out


def removal(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, tkey, n_removed, n_spans, kept (bytes) of the documents that lose anything."""
    affected, ranges = repeated_ranges(docs, hot)
    lists = ranges.groupBy("doc_id", "tkey").agg(F.flatten(F.collect_list("froms")).alias("froms"), F.flatten(F.collect_list("tos")).alias("tos"))
    lists = lists.select(F.col("doc_id").alias("rid"), F.col("tkey").alias("rkey"), "froms", "tos")
    one = affected.select("doc_id", "tkey", "text").dropDuplicates(["doc_id", "tkey"])
    rows = one.join(lists, one["doc_id"].eqNullSafe(lists["rid"]) & (one["tkey"] == lists["rkey"])).select("doc_id", "tkey", "text", "froms", "tos")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            removed, spans, kept = [], [], []
            for t, froms, tos in zip(b.column(2), b.column(3), b.column(4)):
                text = t.as_py().encode()
                f, u = np.array(froms.as_py()), np.array(tos.as_py())
                order = np.lexsort((u, f))
                f, u = f[order], np.maximum.accumulate(u[order])
                new = np.concatenate([[True], f[1:] > u[:-1]])
                lo, hi = f[new], u[np.append(np.flatnonzero(new)[1:] - 1, len(f) - 1)]
                removed.append(int((hi - lo).sum()))
                spans.append(len(lo))
                kept.append(b"".join(text[x:y] for x, y in zip([0, *hi.tolist()], [*lo.tolist(), len(text)])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "tkey", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, tkey long, n_removed long, n_spans long, kept binary")


def repeats_of_documents(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The digest of every document: its bytes, what was removed of them and what is left."""
    cut = removal(docs, hot).select(
        F.col("doc_id").alias("cid"), F.col("tkey").alias("ckey"), "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256")
    )
    raw = text_of().cast("binary")
    d = narrow(docs).select("doc_id", text_key().alias("tkey"), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole_sha256"))
    return d.join(cut, d["doc_id"].eqNullSafe(cut["cid"]) & (d["tkey"] == cut["ckey"]), "left").select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
        (F.col("n_bytes") - F.coalesce("n_removed", F.lit(0))).alias("n_kept"),
    )
