"""Documents that hold benchmark items, under edits.

Texts are compared in lower case with white space runs as one space.  Windows start at every
word, in documents and in items alike.  A window is embedded by the CGK random walk: at step j
the byte under the pointer is written, and the pointer moves on by a random bit of (j, byte),
so that texts at a small edit distance agree at most steps.  ``REPETITIONS`` independent
walks, each with ``TABLES`` samples of ``SAMPLED`` of its steps, give the bit-sampling LSH
keys.  Walks are short (about ``STEPS / 2`` bytes): at ``1 - SIMILARITY`` edits some of an
item's windows are still nearly clean, whatever its length, and a candidate is where one in
``VOTE_WINDOWS`` of an item's windows (one at least) meet the document at nearly one place.  The parameters are set for
``RECALL`` at the threshold itself for mixed edits (tests measure it; at 19.5 percent deletions
alone, 0.80 of the items of 50 to 80 bytes are found, 0.88 of 80 to 120, 0.97 of 200 to 400).  A
candidate is then verified exactly:
the smallest edit distance between the item and any substring of the aligned, item-sized
region (bit-parallel, Myers) may be at most ``1 - SIMILARITY`` of the item's length.

Items under ``SHORT`` bytes have too few windows for that: they are found without loss, since a
match within k edits holds one of the item's k + 1 pieces unchanged.  One automaton looks
for the pieces of all of them in one pass.

Items come in blocks of at most ``BLOCK_BYTES``; each block goes once against all documents.

Edge rules: null and empty texts and items match nothing; repeated items and rows give
repeated pairs once per (doc_id, item_id); an item of one word needs that word or one within its edits
(an item under five bytes, which no edit is allowed, that word).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import column_bytes, lower, mix, python_tasks, text_key

SIMILARITY = 0.8
STEPS = 20
SAMPLED = 10
REPETITIONS = 2
TABLES = 2
RECALL = 0.95
SHORT = 50  # bytes; shorter items have too few windows and are searched piece by piece
VOTE_WINDOWS = 7  # an item needs a vote for so many of its windows
BLOCK_BYTES = 4 << 20
_RNG = np.random.default_rng(733)
_WALK = _RNG.integers(0, 2, (REPETITIONS, STEPS, 256), dtype=np.int32)
# every TABLES-th step: a pointer often stays, so neighbouring steps say the same
_SAMPLES = np.stack([np.arange(SAMPLED) * TABLES + t for _ in range(REPETITIONS) for t in range(TABLES)])
_WORD_BYTE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


def normalised(array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): lower case, white space runs as one space, none at a row's ends."""
    raw, offsets = column_bytes(array)
    data = lower(raw)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    data = np.where(space, np.uint8(32), data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    keep = np.ones(len(data), bool)
    if len(data):
        before = np.concatenate([[True], space[:-1]]) | edge[:-1]
        keep = ~(space & before)
    kept = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], kept[offsets]


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, row) of every word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = data != 32
    starts = inside.copy()
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    at = np.flatnonzero(starts)
    return at, np.searchsorted(offsets, at, side="right") - 1


def walk_keys(data: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """[REPETITIONS * TABLES, windows] LSH keys; ``ends`` is where each window's row ends."""
    last = (ends - 1).astype(np.int32)  # at its row's end a walk stays on the last byte
    out = np.empty((len(_SAMPLES), len(at)), np.uint64)
    steps = np.empty((STEPS, len(at)), np.uint8)
    for r in range(REPETITIONS):
        p = at.astype(np.int32)
        for j in range(STEPS):
            c = data[p]
            steps[j] = c
            p += _WALK[r, j][c]
            np.minimum(p, last, out=p)
        for t in range(r * TABLES, (r + 1) * TABLES):
            acc = np.full(len(at), t + 1, np.uint64)
            for j in _SAMPLES[t]:
                acc = acc * _STEP + steps[j]
            out[t] = mix(acc)
    return out


def edits(item: bytes, masks: dict[int, int], region: bytes) -> int:
    """Smallest edit distance between ``item`` and any substring of ``region``."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best = m
    for c in region:
        eq = masks.get(c, 0)
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp = vn | (full & ~(d0 | vp))
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
            if score < best:
                best = score
        hp = (hp << 1) & full
        hn = (hn << 1) & full
        vp = hn | (full & ~(d0 | hp))
        vn = d0 & hp
    return best


class Items:
    """The items of one block with their LSH index (plain arrays, sent with the task)."""

    def __init__(self, rows: list[tuple[int, str]]):
        import pyarrow as pa

        texts = pa.array([t for _, t in rows], pa.string())
        data, offsets = normalised(texts)
        self.ids = [i for i, _ in rows]
        self.texts = [data[offsets[k] : offsets[k + 1]].tobytes() for k in range(len(rows))]
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.most = ((1 - SIMILARITY) * self.length).astype(np.int64)
        at, row = windows(data, offsets)
        # a window that the item's end cuts short says little
        whole = (offsets[row + 1] - at >= STEPS // 2 + 4) & (self.length[row] >= SHORT)
        at, row = at[whole], row[whole]
        self.votes = np.maximum(1, np.bincount(row, minlength=len(rows)) // VOTE_WINDOWS)
        keys = walk_keys(data, offsets[row + 1], at)
        self.off = at - offsets[row]
        self.row = row
        flat = keys.ravel()
        self.order = np.argsort(flat, kind="stable")
        self.keys = flat[self.order]
        self.window = np.tile(np.arange(len(at)), len(_SAMPLES))[self.order]
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.masks: list[dict[int, int] | None] = [None] * len(rows)
        self.short = None  # built where it is used

    def distance(self, k: int, region: bytes) -> int:
        if self.texts[k] in region:
            return 0
        if self.masks[k] is None:
            m: dict[int, int] = {}
            for i, c in enumerate(self.texts[k]):
                m[c] = m.get(c, 0) | 1 << i
            self.masks[k] = m
        return edits(self.texts[k], self.masks[k], region)

    def matches(self, array) -> list[tuple[int, int, int]]:
        """(row, item index, edits) of every row that holds an item."""
        data, offsets = normalised(array)
        at, row = windows(data, offsets)
        if not len(at):
            return []
        keys = walk_keys(data, offsets[row + 1], at)
        met = []  # document window * item windows + item window
        for t in range(len(keys)):
            hit = np.flatnonzero(self.bitmap[(keys[t] >> np.uint64(44)).astype(np.int64)])
            first, past = np.searchsorted(self.keys, keys[t][hit], "left"), np.searchsorted(self.keys, keys[t][hit], "right")
            n = past - first
            x = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            met.append(np.repeat(hit, n) * len(self.row) + self.window[x])
        met = np.unique(np.concatenate(met))
        best: dict[tuple[int, int], int] = {}
        places = [self.regions(met, at, row), self.short_regions(data, offsets)]
        for r, k, lo, hi in zip(*[np.concatenate(x).tolist() for x in zip(*places)]):
            if best.get((r, k)) == 0:
                continue
            n, most = len(self.texts[k]), int(self.most[k])
            a, b = max(int(offsets[r]), lo - most), min(int(offsets[r + 1]), hi + n + most)
            d = self.distance(k, data[a:b].tobytes())
            if d <= most and d < best.get((r, k), n + 1):
                best[r, k] = d
        return [(r, k, d) for (r, k), d in best.items()]

    def regions(self, met: np.ndarray, at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, item, least start, greatest start) of the places where windows of an item meet."""
        w, x = met // max(1, len(self.row)), met % max(1, len(self.row))
        pair, start = row[w] * len(self.texts) + self.row[x], at[w] - self.off[x]
        order = np.lexsort((start, pair))
        pair, start = pair[order], start[order]
        most = self.most[pair % len(self.texts)]
        # enough windows of a pair at nearly one place: edits of one kind move it by all they are
        near = np.maximum(most, 4 + 2 * np.sqrt(most))
        i = np.arange(len(pair))
        j = i + self.votes[pair % len(self.texts)] - 1
        end = np.minimum(j, len(pair) - 1)
        lead = (j < len(pair)) & (pair[end] == pair) & (start[end] - start <= near)
        cover = np.bincount(i[lead], minlength=len(pair) + 1) - np.bincount(j[lead] + 1, minlength=len(pair) + 1)
        voted = np.cumsum(cover[:-1]) > 0
        pair, start, most = pair[voted], start[voted], most[voted]
        if not len(pair):
            return pair, pair, start, start
        new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (start[1:] - start[:-1] > most[1:])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(pair)) - 1
        return pair[first] // len(self.texts), pair[first] % len(self.texts), start[first], start[last]

    def pieces(self):
        """An automaton over the pieces of all short items: piece -> [(item, place in it)]."""
        import ahocorasick

        held: dict[str, list[tuple[int, int]]] = {}
        for k in np.flatnonzero(self.length < SHORT).tolist():
            text, n = self.texts[k].decode("latin-1"), int(self.most[k]) + 1
            cuts = [len(text) * j // n for j in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    held.setdefault(text[a:b], []).append((k, a))
        found = ahocorasick.Automaton()
        for piece, at in held.items():
            found.add_word(piece, (len(piece), at))
        if held:
            found.make_automaton()
        return found

    def short_regions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """As ``regions``, of the short items, without loss: of one piece more than the edits allowed,
        some piece is whole in every match.  One pass over the texts for all pieces."""
        if self.short is None:
            self.short = self.pieces()
        got = []
        if len(self.short):
            for last, (n, at) in self.short.iter(data.tobytes().decode("latin-1")):
                got += [(last - n + 1, last + 1, last - n + 1 - a, k) for k, a in at]
        hit, past, start, item = np.array(got, np.int64).reshape(-1, 4).T
        row = np.searchsorted(offsets, hit, side="right") - 1
        inside = past <= offsets[row + 1]
        whole = self.most[item] == 0  # as whole words only
        before = (hit > offsets[row]) & _WORD_BYTE[data[hit - 1]]
        after = (past < offsets[row + 1]) & _WORD_BYTE[data[np.minimum(past, len(data) - 1)]]
        inside &= ~(whole & (before | after))
        row, start, item = row[inside], start[inside], item[inside]
        order = np.lexsort((start, item, row))
        row, start, item = row[order], start[order], item[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > 2 * self.most[item[1:]])
        first = np.flatnonzero(new)
        return row[first], item[first], start[first], start[np.append(first[1:], len(row))[: len(first)] - 1]


def item_blocks(benchmark: DataFrame):
    """Lists of (item_id, text), each of at most about ``BLOCK_BYTES``."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.length(F.trim("text")) > 0)
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / BLOCK_BYTES)) if total > BLOCK_BYTES else 1
    for k in range(n):
        part = b if n == 1 else b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = [(r["item_id"], r["text"]) for r in part.distinct().collect()]
        rows = [r for r in rows if r[1].strip()]
        if rows:
            yield sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1]))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, tkey, item_id, edits of every document that holds an item."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tkey"), "text")
    schema = "doc_id long, tkey long, item_id long, edits int"
    out = None
    for block in item_blocks(benchmark):

        def run(batches, block=block):
            import pyarrow as pa

            items = Items(block)
            for b in batches:
                got = items.matches(b.column(2))
                at = pa.array([r for r, _, _ in got], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array([items.ids[k] for _, k, _ in got], pa.int64()), pa.array([d for _, _, d in got], pa.int32())],
                    ["doc_id", "tkey", "item_id", "edits"],
                )

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    if out is None:
        out = rows.select("doc_id", "tkey", F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("edits")).filter(F.lit(False))
    return out.groupBy("doc_id", "tkey", "item_id").agg(F.min("edits").alias("edits"))


def leaked_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).distinct()
    d = docs.withColumn("__tkey", text_key())
    return d.join(bad, d["doc_id"].cast("long").eqNullSafe(bad["__id"]) & (d["__tkey"] == bad["__key"]), "left_anti").drop("__tkey")
