"""Text scores from online logistic context mixing.

Tokens are the words of a text (lowered A-Z) and one end.  Each token is coded as a class
(the ``TOP_WORDS`` most frequent training tokens have their own, the rest share ``RARE_CLASSES``
by their last two bytes) through binary decisions on the classes' Huffman tree, and then as a word of its class.

Every decision is predicted from hashed contexts (none; the class before; the last two tokens
with a class of their own; the two tokens before), whose tables hold the bit counts of all training documents in a
fixed number of slots.  The predictions are mixed in the logistic domain by a weight
set that a gate (how much evidence the longer contexts have) chooses; an adaptive
probability map then refines the mix.  Weights and map are trained online on every token of
every training document, ``STEP`` decisions at a time, which are predicted before they are learned
from with their own counts taken out.  Each block (see below) trains its own in its task; the
model has their means, weighed by how many decisions met each weight set and map cell.  All
counts and statistics are over all training documents.

A word within its class has (c + 0.5) / (C + 0.5 (V + 1)), c its training count and C, V the class's
tokens and distinct words; an unseen word has c = 0.  Word counts are looked up block by
block (a block is one task of the staging scan): a block's distinct words meet the corpus counts
in a shuffle, and come back to the block.

Edge rules: a null or empty text is the end token alone; a null id hashes as the empty text;
without training documents every count is 0 and the model stays at its priors.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tillpoint.llm.common import column_bytes, lower, mix, narrow, python_tasks, span_hashes, stage, text_of, word_spans

FOLDS, HELD_OUT = 5, 1
TOP_WORDS = 255
RARE_CLASSES = 64
SLOT_BITS = 20
ORDERS = 3  # hashed contexts beside the empty one
CHUNK = 1 << 16
MAX_TRAIN_TASKS = 2048
STEP = 2048  # decisions learned at once
PART_TOKENS = 1 << 14  # tokens whose decisions are worked out at once, or one text's: few enough for the processor's cache
COUNT_TOKENS = 1 << 18  # tokens that are added to the tables at once
RATE = 0.00025
MAP_RATE = 0.02
FIXED_POINT = 1 << 20  # blocks are summed as integers, so the sum has no order
MAP_STEPS = 33
GATES = 16
END = np.uint64(1)  # the end token's hash
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = [np.uint64(x) for x in (0x51_7CC1B7_2722_0A95, 0xD1B5_4A32_D192_ED03, 0x8CB9_2BA7_2F3D_8DD7)]


def held_out() -> F.Column:
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return (crc % F.lit(FOLDS)) == F.lit(HELD_OUT)


def tokens(array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with one end per row, first token of each row and the total)."""
    raw, offsets = column_bytes(array)
    data = lower(raw)
    s, e, row = word_spans(data, offsets)
    h = span_hashes(data, s, e)
    if len(s):  # the low bits, and so a rare word's class, tell its last two bytes
        tail = data[e - 1].astype(np.uint64) | np.where(e - s > 1, data[np.maximum(e - 2, 0)], 0).astype(np.uint64) << np.uint64(8)
        low = np.uint64(RARE_CLASSES - 1)
        h = (h & ~low) | (mix(tail + _STEP) & low)
    n = np.bincount(row, minlength=len(array))
    ends = np.concatenate([[0], np.cumsum(n + 1)])
    out = np.full(ends[-1], END, np.uint64)
    out[np.arange(len(h)) + row] = h
    return out, ends


def slots_of(x: np.ndarray) -> np.ndarray:
    """The first ``SLOT_BITS`` bits of ``mix(x)``, whose last step does not reach them; ``x`` is
    overwritten."""
    some = x >> np.uint64(30)
    x ^= some
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=some)
    x *= np.uint64(0x94D049BB133111EB)
    return np.right_shift(x, np.uint64(64 - SLOT_BITS), out=x)


class Classes:
    """Classes of tokens and the paths of their Huffman codes."""

    def __init__(self, top: list[tuple[int, int]], rare: list[tuple[int, int]]):
        """top: (token hash as signed, count); rare: (tokens, distinct) of each rare class."""
        order = np.argsort(np.array([h for h, _ in top], np.int64).view(np.uint64), kind="stable")
        self.hashes = np.array([h for h, _ in top], np.int64).view(np.uint64)[order]
        self.rare = np.array(rare, float).reshape(-1, 2)
        weight = [top[k][1] + 1 for k in order] + [int(t) + 1 for t, _ in rare]
        n = len(weight)
        heap = [(w, k) for k, w in enumerate(weight)]
        heapq.heapify(heap)
        children: dict[int, tuple[int, int]] = {}
        new = n
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            children[new] = (a[1], b[1])
            heapq.heappush(heap, (a[0] + b[0], new))
            new += 1
        paths: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        stack = [(heap[0][1], [])] if children else []
        while stack:
            node, path = stack.pop()
            if node < n:
                paths[node] = path
            else:
                for bit, child in enumerate(children[node]):
                    stack.append((child, [*path, (node - n, bit)]))
        self.length = np.array([len(p) for p in paths])
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        self.nodes = np.array([x for p in paths for x, _ in p], np.int64)
        self.bits = np.array([x for p in paths for _, x in p], np.int8)
        self.n_nodes = max(1, n - 1)

    def of(self, t: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return (t % np.uint64(RARE_CLASSES)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.hashes, t), len(self.hashes) - 1)
        return np.where(self.hashes[at] == t, at, len(self.hashes) + (t % np.uint64(RARE_CLASSES)).astype(np.int64))

    def decisions(self, t: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(token number, node, bit, slots [ORDERS, decisions]) of all decisions of all tokens."""
        c = self.of(t)
        n = self.length[c]
        token = np.repeat(np.arange(len(t)), n)
        at = np.repeat(self.first[c] - np.cumsum(n) + n, n) + np.arange(len(token))
        node, bit = self.nodes[at], self.bits[at]
        row_start = np.repeat(ends[:-1], np.diff(ends))
        here = np.arange(len(t))
        fresh = here == row_start  # contexts start anew with each text
        before = np.where(fresh, 0, np.concatenate([[0], c[:-1] + 1])).astype(np.uint64)
        one = np.where(fresh, np.uint64(0), np.concatenate([[np.uint64(0)], t[:-1]]))
        two = np.where(fresh, np.uint64(0), np.concatenate([[np.uint64(0)], one[:-1]]))
        # the last two tokens with a class of their own
        own = c < len(self.hashes)
        last = np.concatenate([[-1], np.maximum.accumulate(np.where(own, here, -1))[:-1]])
        earlier = np.where(last >= 0, last[np.maximum(last, 0)], -1)
        near = np.where(last >= row_start, c[np.maximum(last, 0)] + 1, 0).astype(np.uint64)
        far = np.where(earlier >= row_start, c[np.maximum(earlier, 0)] + 1, 0).astype(np.uint64)
        step = node.astype(np.uint64) * _STEP
        slots = np.empty((ORDERS, len(token)), np.int32)
        for k, ctx in enumerate((before, near * np.uint64(1024) + far, mix(one * _STEP + two))):
            slots[k] = slots_of((ctx ^ _SALT[k]).take(token) + step)
        return token, node, bit, slots


def parts_of(ends: np.ndarray):
    """(first, end) of runs of rows with about ``PART_TOKENS`` tokens each."""
    first = 0
    while first < len(ends) - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + PART_TOKENS, side="right")) - 1)
        yield first, last
        first = last


def add_counts(tables: np.ndarray, root: np.ndarray, cls: Classes, t: np.ndarray, ends: np.ndarray) -> None:
    places: list[list[np.ndarray]] = [[] for _ in range(ORDERS)]
    for a, b in parts_of(ends):
        _, node, bit, slots = cls.decisions(t[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
        root += np.bincount(node * 2 + bit, minlength=2 * cls.n_nodes).reshape(-1, 2)
        for k in range(ORDERS):
            places[k].append(slots[k] * 2 + bit)
    for k in range(ORDERS):  # each pass goes over a whole table
        if places[k]:
            tables[k] += np.bincount(np.concatenate(places[k]), minlength=2 << SLOT_BITS).reshape(-1, 2).astype(np.uint32)


def stretch(n: np.ndarray) -> np.ndarray:
    """log odds of a one, from (zeros, ones) counts."""
    return np.log((n[..., 1] + 0.4) / (n[..., 0] + 0.4))


def trust(seen: np.ndarray) -> np.ndarray:
    """By a slot's count: how far its estimate is trusted against the empty context's (few counts
    are drawn to it)."""
    n = seen.astype(np.float32)
    return n / (n + np.float32(1.5))


def evidence(seen: np.ndarray) -> np.ndarray:
    """By a slot's count, 0..3: none, little, some, much."""
    return (seen >= 1).view(np.uint8) + (seen >= 4).view(np.uint8) + (seen >= 31).view(np.uint8)


#: By the decisions that a map cell meets in a step: how far it goes to their mean.
MAP_PULL = 1 - (1 - MAP_RATE) ** np.arange(STEP + 1)


class Mixer:
    def __init__(self, n_nodes: int):
        self.weights = np.tile(np.array([0.1, 0.5, 0.3, 0.1]), (GATES, 1))
        grid = (np.arange(MAP_STEPS) - MAP_STEPS // 2) / 2.0
        self.map = np.tile(1 / (1 + np.exp(-grid)), (n_nodes, 1))

    def log_odds(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        weights = np.ascontiguousarray(self.weights.T, x.dtype)
        s = x[0] * weights[0].take(gate)
        for k in range(1, 1 + ORDERS):
            s += x[k] * weights[k].take(gate)
        return np.clip(s, -8, 8, out=s)

    def mixed(self, x: np.ndarray, gate: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Probability of a one."""
        s = self.log_odds(x, gate)
        q = self.map.astype(x.dtype).ravel().take(map_cell(s, node))
        q += 1 / (1 + np.exp(-s))
        q *= x.dtype.type(0.5)
        return np.clip(q, 1e-5, 1 - 1e-5, out=q)

    def learn(self, x: np.ndarray, gate: np.ndarray, node: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One online step over at most ``STEP`` decisions: (decisions by gate, map cells met, decisions by these)."""
        s = self.log_odds(x, gate)
        miss = bit - 1 / (1 + np.exp(-s))
        for k in range(1 + ORDERS):
            self.weights[:, k] += RATE * np.bincount(gate, miss * x[k], minlength=GATES)
        at = map_cell(s, node)
        n, ones = np.bincount(at), np.bincount(at, bit)
        met = np.flatnonzero(n > 0)
        n, cells = n[met], self.map.reshape(-1)
        # as n steps one by one, of the mean bit
        cells[met] = np.clip(cells[met] + MAP_PULL.take(n) * (ones[met] / n - cells[met]), 1e-4, 1 - 1e-4)
        return np.bincount(gate, minlength=GATES), met, n

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights.ravel(), self.map.ravel()])

    def set(self, cell: np.ndarray, value: np.ndarray) -> None:
        """Some of ``flat``'s numbers."""
        flat = self.flat()
        flat[cell] = value
        self.weights = flat[: self.weights.size].reshape(self.weights.shape)
        self.map = np.ascontiguousarray(flat[self.weights.size :].reshape(self.map.shape))


def map_cell(s: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The map's cell, by node and log odds (within -8 and 8)."""
    return node * MAP_STEPS + np.rint(s * 2).astype(np.int64) + MAP_STEPS // 2


def packed(logits: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Log odds (half precision) and count (16 bits) of every entry side by side, so that a decision
    finds both in one place of memory."""
    both = np.empty((*logits.shape, 2), np.uint16)
    both[..., 0], both[..., 1] = logits.astype(np.float16).view(np.uint16), seen
    return both.view(np.uint32)[..., 0]


def inputs(zero: np.ndarray, entries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(inputs [1 + ORDERS, decisions], gate) from every context's ``packed`` log odds and counts."""
    x = np.empty((1 + ORDERS, len(zero)), np.float32)
    x[0] = zero
    seen = [e.view(np.uint16)[1::2] for e in entries]
    for k in range(ORDERS):
        x[1 + k] = x[0] + trust(seen[k]) * (entries[k].view(np.float16)[::2] - x[0])
    return x, (evidence(seen[2]) * np.uint8(4) + evidence(seen[1])).astype(np.int64)


def without_own(n: np.ndarray) -> np.ndarray:
    """[..., bit]: the log odds of counts from which one such bit is taken."""
    return np.stack([stretch(np.maximum(n.astype(np.int64) - own, 0)) for own in np.eye(2, dtype=np.int64)], axis=-1)


class Learner:
    """Trains one block's mixer: its texts come in order, in batches of any size."""

    def __init__(self, cls: Classes):
        self.cls, self.mixer = cls, Mixer(cls.n_nodes)
        self.by_gate = np.zeros(GATES)
        self.by_cell = np.zeros(self.mixer.map.size, np.int64)
        self.rest: list[np.ndarray] | None = None

    def add(self, zero: np.ndarray, logits: np.ndarray, seen: np.ndarray, t: np.ndarray, ends: np.ndarray) -> None:
        """``zero`` and ``logits``: ``without_own`` of the nodes' and the tables' counts; ``seen``:
        the tables' totals."""
        self.add_packed(zero, self.packed(logits, seen), t, ends)

    @staticmethod
    def packed(logits: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """[order, slot, bit], the totals without the decision's own count."""
        return packed(logits, (np.maximum(seen, 1) - 1)[..., None])

    def add_packed(self, zero: np.ndarray, entries: np.ndarray, t: np.ndarray, ends: np.ndarray) -> None:
        for a, b in parts_of(ends):
            self._add(zero, entries, t[ends[a] : ends[b]], ends[a : b + 1] - ends[a])

    def _add(self, zero, entries, t, ends) -> None:
        _, node, bit, slots = self.cls.decisions(t, ends)
        x, gate = inputs(zero.ravel().take(2 * node + bit), [entries[k].ravel().take(2 * slots[k] + bit) for k in range(ORDERS)])
        new = [x, gate, node, bit]
        if self.rest is not None:
            new = [np.concatenate([a, b], axis=-1) for a, b in zip(self.rest, new)]
        whole = len(new[2]) // STEP * STEP
        self._learn(new, whole)
        self.rest = [a[..., whole:].copy() for a in new]

    def _learn(self, rows: list[np.ndarray], end: int) -> None:
        x, gate, node, bit = rows
        for a in range(0, end, STEP):
            b = min(a + STEP, end)
            by_gate, met, n = self.mixer.learn(x[:, a:b], gate[a:b], node[a:b], bit[a:b])
            self.by_gate += by_gate
            self.by_cell[met] += n

    def sums(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell of ``Mixer.flat``, decisions that met it, their sum of its value in fixed point)."""
        if self.rest is not None:
            self._learn(self.rest, len(self.rest[2]))
            self.rest = None
        n = np.concatenate([np.repeat(self.by_gate, 1 + ORDERS).astype(np.int64), self.by_cell])
        cell = np.flatnonzero(n)
        return cell, n[cell], np.rint(self.mixer.flat()[cell] * FIXED_POINT).astype(np.int64) * n[cell]


def score_batch(cls: Classes, m: Mixer, zero_in: np.ndarray, stretched: np.ndarray, seen: np.ndarray, t: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log10 probability of the classes of each row's tokens.  ``stretched`` and ``seen`` are
    the tables' log odds and evidence; ``zero_in`` the empty context's log odds by node."""
    return score_packed(cls, m, zero_in, packed(stretched, seen), t, ends)


def score_packed(cls: Classes, m: Mixer, zero_in: np.ndarray, entries: np.ndarray, t: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``score_batch``, of ``packed`` log odds and evidence."""
    out = np.zeros(len(ends) - 1)
    for a, b in parts_of(ends):
        own = ends[a : b + 1] - ends[a]
        token, node, bit, slots = cls.decisions(t[ends[a] : ends[b]], own)
        x, gate = inputs(zero_in.take(node), [entries[k].take(slots[k]) for k in range(ORDERS)])
        p = m.mixed(x, gate, node)
        lp = np.log10(np.where(bit == 1, p, 1 - p))
        row = np.repeat(np.arange(b - a), np.diff(own)).take(token)
        out[a:b] = np.bincount(row, lp, minlength=b - a)
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    python_tasks(spark)
    d = stage(
        narrow(docs).select("doc_id", held_out().alias("held_out"), F.spark_partition_id().alias("block"), text_of().alias("text"))
    )

    # 1. every block's distinct tokens with their training counts, and the corpus counts beside them
    def words(batches):
        import pyarrow as pa

        held: dict[int, list] = {}

        def joined(parts):
            h, c = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            u, inverse = np.unique(h, return_inverse=True)
            return u, np.bincount(inverse, c, minlength=len(u)).astype(np.int64)

        def rows(block, parts):
            u, c = joined(parts)
            for a in range(0, len(u), 65_536):
                k = len(u[a : a + 65_536])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, block), pa.int32()), pa.array(u[a : a + 65_536].view(np.int64)), pa.array(c[a : a + 65_536])], ["block", "h", "c"]
                )

        for b in batches:
            t, ends = tokens(b.column(2))
            train = np.repeat(~np.array(b.column(1).to_pylist(), bool), np.diff(ends))
            blocks = np.repeat(np.array(b.column(0).to_pylist()), np.diff(ends))
            for block in np.unique(blocks).tolist():
                own = blocks == block
                parts = held.setdefault(block, [])
                parts.append(joined([(t[own], train[own])]))
                if sum(len(p[0]) for p in parts[1:]) > max(500_000, len(parts[0][0])):
                    held[block] = [joined(parts)]
        for block, parts in held.items():
            yield from rows(block, parts)

    per_block = d.select("block", "held_out", "text").mapInArrow(words, "block int, h long, c long")
    w = W.Window.partitionBy("h")
    counted = per_block.groupBy("block", "h").agg(F.sum("c").alias("c")).select(
        "block", "h", F.sum("c").over(w).alias("total"), F.row_number().over(w.orderBy("block")).alias("k")
    )
    counted = counted.withColumn("first", F.col("k") == 1).drop("k")
    obs = Observation()
    counted = stage(
        counted.observe(
            obs,
            F.sum(F.when(F.col("first"), F.col("total")).otherwise(0)).alias("n"),
            F.sum((F.col("first") & (F.col("total") > 0)).cast("long")).alias("v"),
        )
    )
    n_all, v_all = int(obs.get["n"] or 0), int(obs.get["v"] or 0)
    vocab = counted.filter("first and total > 0").select("h", "total")
    top = [(r["h"], r["total"]) for r in vocab.orderBy(F.desc("total"), "h").limit(TOP_WORDS).collect()]
    rare_rows = (
        vocab.filter(~F.col("h").isin([h for h, _ in top]) if top else F.lit(True))
        # the hash as unsigned modulo a power of two is its low bits
        .groupBy(F.col("h").bitwiseAND(F.lit(RARE_CLASSES - 1)).alias("k"))
        .agg(F.sum("total").alias("t"), F.count(F.lit(1)).alias("v"))
        .collect()
    )
    rare = [(0, 0)] * RARE_CLASSES
    for r in rare_rows:
        rare[r["k"]] = (r["t"], r["v"])
    cls = Classes(top, rare)

    # 2. bit counts of every context slot over all training documents
    def count(batches):
        import pyarrow as pa
        import zstandard

        tables = np.zeros((ORDERS, 1 << SLOT_BITS, 2), np.uint32)
        root = np.zeros((cls.n_nodes, 2), np.int64)
        some, held = False, []

        def flush():
            ends = np.cumsum(np.concatenate([[0], *[np.diff(e) for _, e in held]]))
            add_counts(tables, root, cls, np.concatenate([t for t, _ in held]), ends)
            held.clear()

        for b in batches:
            held.append(tokens(b.column(0)))
            some = True
            if sum(len(t) for t, _ in held) >= COUNT_TOKENS:
                flush()
        if not some:
            return
        if held:
            flush()
        z = zstandard.ZstdCompressor(level=1)
        flat = tables.ravel()
        parts = [z.compress(flat[a : a + CHUNK].tobytes()) for a in range(0, len(flat), CHUNK)] + [z.compress(root.tobytes())]
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(parts) - 1), -1], pa.int32()), pa.array(parts, pa.binary())], ["chunk", "raw"])

    def add(key, batch):
        import pyarrow as pa
        import zstandard

        z = zstandard.ZstdDecompressor()
        dtype = np.int64 if key[0].as_py() < 0 else np.uint32
        total = None
        for raw in batch.column("raw"):
            x = np.frombuffer(z.decompress(raw.as_py()), dtype)
            total = x.copy() if total is None else total + x
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "raw": pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary())})

    train = d.filter(~F.col("held_out")).select("text").coalesce(MAX_TRAIN_TASKS)
    summed = train.mapInArrow(count, "chunk int, raw binary").groupBy("chunk").applyInArrow(add, "chunk int, raw binary")
    import zstandard

    tables = np.zeros((ORDERS, 1 << SLOT_BITS, 2), np.uint32)
    root = np.zeros((cls.n_nodes, 2), np.int64)
    for r in summed.collect():  # the tables' fixed size: ORDERS << SLOT_BITS pairs
        raw = zstandard.ZstdDecompressor().decompress(bytes(r["raw"]))
        if r["chunk"] < 0:
            root += np.frombuffer(raw, np.int64).reshape(-1, 2)
        else:
            tables.ravel()[r["chunk"] * CHUNK :][: len(raw) // 4] = np.frombuffer(raw, np.uint32)

    # 3. weights and map, online over all training documents of each block; then their means
    seen = np.minimum(tables.sum(-1), 60_000).astype(np.uint16)
    unseen = spark.sparkContext.broadcast(
        (without_own(root).astype(np.float32), np.stack([Learner.packed(without_own(tables[k]), seen[k]) for k in range(ORDERS)]))
    )

    def learn(batches):
        import pyarrow as pa

        held: dict[int, Learner] = {}
        for b in batches:
            blocks = np.array(b.column(0).to_pylist())
            for block in np.unique(blocks).tolist():
                t, ends = tokens(b.column(1).filter(pa.array(blocks == block)))
                held.setdefault(block, Learner(cls)).add_packed(*unseen.value, t, ends)
        for learner in held.values():
            cell, n, total = learner.sums()
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(n), pa.array(total)], ["cell", "n", "total"])

    mixer = Mixer(cls.n_nodes)
    if len(cls.nodes):
        blocks = d.filter(~F.col("held_out")).select("block", "text").coalesce(MAX_TRAIN_TASKS)
        sums = blocks.mapInArrow(learn, "cell int, n long, total long").groupBy("cell")
        # a decimal sum: n times a value in fixed point may pass 64 bits on a huge corpus
        means = sums.agg((F.sum(F.col("total").cast("decimal(38,0)")).cast("double") / F.sum("n") / FIXED_POINT).alias("mean")).collect()
        mixer.set(np.array([r["cell"] for r in means], np.int64), np.array([r["mean"] for r in means]))
    stretched = spark.sparkContext.broadcast(
        (stretch(root).astype(np.float32), np.stack([packed(stretch(tables[k]), seen[k]) for k in range(ORDERS)]))
    )
    del tables

    # 4. every document of a block with the block's counts
    def judge(left, right):
        import pyarrow as pa

        h = right.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, c = h[order], right.column("total").to_numpy()[order]
        zero_in, entries = stretched.value
        out = []
        for b in left.to_batches(max_chunksize=256):
            t, ends = tokens(b.column("text"))
            own, inverse = np.unique(t, return_inverse=True)  # looked up in order, each once
            at = np.searchsorted(h, own)
            if len(h) == 0 or (h[np.minimum(at, len(h) - 1)] != own).any():
                raise ValueError("a block lacks counts of its own words")
            n = c[at].astype(float)[inverse]
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            base = np.log10((n + 0.5) / (n_all + 0.5 * (v_all + 1)))
            k = cls.of(t) - len(cls.hashes)
            r = cls.rare[np.maximum(k, 0)]
            share = np.where(k >= 0, np.log10((n + 0.5) / (r[:, 0] + 0.5 * (r[:, 1] + 1))), 0.0)
            rows = len(ends) - 1
            total = score_packed(cls, mixer, zero_in, entries, t, ends) + np.bincount(row, share, minlength=rows)
            size = np.diff(column_bytes(b.column("text"))[1])
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id"), b.column("held_out"), pa.array(np.diff(ends), pa.int64()),
                        pa.array(np.bincount(row, n > 0, minlength=rows).astype(np.int64)), pa.array(np.full(rows, n_all), pa.int64()),
                        pa.array(np.bincount(row, base, minlength=rows)), pa.array(total), pa.array(-total / np.log10(2) / np.maximum(size, 1)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
                )
            )
        return pa.Table.from_batches(out, schema=schema_of(pa))

    def schema_of(pa):
        return pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])

    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    counts = counted.select("block", "h", "total")
    return d.select("block", "doc_id", "held_out", "text").groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(judge, result)
