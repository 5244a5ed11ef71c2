"""Near-duplicate documents by min-max hashing with banding and exact confirmation.

Each of ``PERMUTATIONS`` hash functions is evaluated once per shingle and gives two signature
values, its minimum and its maximum.  The 2 x 80 values form 32 bands of five: a pair at
similarity 0.8 shares no band with probability (1 - 0.8^5)^32 < 4e-6.

1. Documents with equal shingle sets (128-bit digest and size) form a class; only its smallest
   id goes on, so exact copies never meet in a bucket.
2. In each bucket every member is paired with the bucket's smallest id (a linear number of
   pairs), the pairs are confirmed on the full sets, and components are formed.
3. Buckets that still hold several components are dealt to cells of bounded size (blocks of
   the bucket, two by two).  A cell counts the intersections of all its members that lie in
   different components and gives back only links that join components, so no such link is
   lost and no pairs are written out.

Edge rules: words are ``[^\\x20\\x09-\\x0D]+`` after lowering A-Z; a text with fewer words than
a shingle has its whole sequence as its one shingle; null, empty or blank texts have
no shingles and link with nothing; rows with one id are one document; a row without id
links with nothing, has no component and is kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import column_bytes, lower, mix, narrow, python_tasks, span_hashes, stage, staged_rows, tasks_for, text_key, word_spans
from tillpoint.llm.components import components

PERMUTATIONS = 80
BAND = 5
BANDS = 2 * PERMUTATIONS // BAND
#: Most members, and most shingles, that a block of a bucket holds on average.
BLOCK_MEMBERS = 1024
BLOCK_SHINGLES = 2 << 20
#: Cells of the membership matrix that are dense at a time.
DENSE = 4 << 20
_RNG = np.random.default_rng(20_011)
_XOR = _RNG.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows, offsets by row) of an Arrow text column."""
    raw, offsets = column_bytes(array)
    data = lower(raw)
    s, e, row = word_spans(data, offsets)
    h = span_hashes(data, s, e)
    first = np.searchsorted(row, np.arange(len(array) + 1))
    parts, ends = [], np.zeros(len(array) + 1, np.int64)
    for r in range(len(array)):
        w = h[first[r] : first[r + 1]]
        if not len(w):
            got = w
        else:
            n = min(k, len(w))
            acc = np.full(len(w) - n + 1, n, np.uint64)
            for j in range(n):
                acc = mix(acc * _STEP + w[j : len(w) - n + 1 + j])
            acc.sort()
            got = acc[np.concatenate([[True], acc[1:] != acc[:-1]])]
        parts.append(got)
        ends[r + 1] = ends[r] + len(got)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), ends


def band_keys(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """[rows with shingles, BANDS] keys; ``ends`` has only rows with shingles."""
    starts = ends[:-1]
    sig = np.empty((2 * PERMUTATIONS, len(starts)), np.uint64)
    for p in range(PERMUTATIONS):
        v = (sets ^ _XOR[p]) * _MUL[p]
        sig[2 * p] = np.minimum.reduceat(v, starts)
        sig[2 * p + 1] = np.maximum.reduceat(v, starts)
    keys = np.empty((len(starts), BANDS), np.uint64)
    for b in range(BANDS):
        acc = np.full(len(starts), b + 1, np.uint64)
        for j in range(BAND):
            acc = mix(acc * _STEP + sig[b * BAND + j])
        keys[:, b] = acc
    return keys


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, tkey, n_shingles, d1, d2 (digest of the set), bands."""
    python_tasks(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sets, ends = shingle_sets(b.column(2), k)
            n = np.diff(ends)
            some = np.flatnonzero(n)
            d1, d2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            flat = np.zeros(0, np.uint64)
            if len(some):
                live = np.append(ends[:-1][some], ends[-1])
                d1[some] = np.add.reduceat(mix(sets + _STEP), live[:-1])
                d2[some] = np.bitwise_xor.reduceat(mix(sets * _STEP), live[:-1])
                flat = band_keys(sets, live).ravel()
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]), pa.int32()), pa.array(flat.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), lists],
                ["doc_id", "tkey", "n_shingles", "d1", "d2", "bands"],
            )

    rows = narrow(docs).select("doc_id", text_key().alias("tkey"), "text")
    return rows.mapInArrow(run, "doc_id long, tkey long, n_shingles long, d1 long, d2 long, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union; ``ak`` and
    ``bk`` tell which of the texts that share an id is meant."""
    t = texts.select(F.col("doc_id").alias("id"), F.col("tkey").alias("k"), "text")
    both = (
        pairs.join(t.withColumnRenamed("text", "ta"), (F.col("a") == F.col("id")) & (F.col("ak") == F.col("k"))).drop("id", "k")
        .join(t.withColumnRenamed("text", "tb"), (F.col("b") == F.col("id")) & (F.col("bk") == F.col("k"))).drop("id", "k")
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sa, ea = shingle_sets(batch.column(2), k)
            sb, eb = shingle_sets(batch.column(3), k)
            ok = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                x, y = sa[ea[r] : ea[r + 1]], sb[eb[r] : eb[r + 1]]
                if len(x) and len(y):
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    same = int((y[at] == x).sum())
                    ok[r] = 100 * same >= percent * (len(x) + len(y) - same)
            yield batch.select([0, 1]).filter(pa.array(ok))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def joining_links(sets: list[np.ndarray], comps: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs (larger, smaller) of component ids that links between members join: all links
    between members of different components are tested, and those that close a cycle left out."""
    ids, at, size = np.unique(comps, return_inverse=True, return_counts=True)
    if len(ids) < 2:
        return []
    n, lens = len(sets), np.array([len(x) for x in sets], np.int64)
    rows = np.flatnonzero(at != size.argmax())  # a link between components has an end here
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(n), lens), times > 1
    col = np.where(shared, np.cumsum(shared) - 1, -1)[col]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    same = np.zeros((len(rows), n), np.float32)
    width, total = max(1, DENSE // n), int(shared.sum())
    for lo in range(0, total, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((n, min(width, total - lo)), np.float32)
        m[owner[a:b], col[a:b] - lo] = 1
        same += m[rows] @ m.T
    linked = 100 * same >= percent * (lens[rows, None] + lens[None, :] - same)
    x, y = np.nonzero(linked & (at[rows, None] != at[None, :]))
    x, y = at[rows[x]], at[y]
    root, out = list(range(len(ids))), []
    for k in np.unique(np.maximum(x, y) * len(ids) + np.minimum(x, y)).tolist():
        a, b = divmod(k, len(ids))
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(ids[max(a, b)]), int(ids[min(a, b)])))
    return out


def links_in_cells(left: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``left`` (key, rep, rk, comp, blocks) -> links (a, b) between components of a bucket.

    A bucket of g blocks has a cell for each two of them, so each member goes to g cells."""
    block = F.pmod(F.xxhash64("rep", "rk"), F.col("blocks"))
    t = texts.select(F.col("doc_id").alias("id"), F.col("tkey").alias("k"), "text")
    cells = (
        left.join(t, (F.col("rep") == F.col("id")) & (F.col("rk") == F.col("k")))
        .withColumn("block", block)
        .select("key", "comp", "text", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
        .select("key", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "comp", "text")
    )
    cells = cells.repartition(tasks_for(left.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        import pyarrow as pa

        now, sets, comps = None, [], []

        def flush():
            got = joining_links(sets, np.array(comps, np.int64), percent)
            sets.clear()
            comps.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[s] for p in got], pa.int64()) for s in (0, 1)], ["a", "b"])

        for b in batches:
            flat, ends = shingle_sets(b.column(4), k)
            for r, cell in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                if cell != now:
                    if sets:
                        yield flush()
                    now = cell
                sets.append(flat[ends[r] : ends[r + 1]].copy())
                comps.append(b.column(3)[r].as_py())
        if sets:
            yield flush()

    return cells.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, tkey, n_shingles, component_id, kept of every row."""
    sig = stage(signatures(docs, k))
    real = sig.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # a class goes on as one of its rows: (id, text), as rows that share an id may be in several classes
    least = F.min(F.struct("doc_id", "tkey")).alias("r")
    classes = stage(real.groupBy("d1", "d2", "n_shingles").agg(least).select("d1", "d2", "n_shingles", F.col("r.doc_id").alias("rep"), F.col("r.tkey").alias("rk")))
    classed = real.join(classes, ["d1", "d2", "n_shingles"])
    own = classed.filter((F.col("doc_id") == F.col("rep")) & (F.col("tkey") == F.col("rk")))
    members = own.select("rep", "rk", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")).distinct()
    buckets = members.groupBy("key").agg(F.min(F.struct("rep", "rk")).alias("s"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    # only members of buckets with company: (key, rep, rk, n, m, mk)
    met = stage(members.join(buckets.select("key", F.col("s.rep").alias("m"), F.col("s.rk").alias("mk")), "key"))
    star = met.filter("rep != m").select(F.col("rep").alias("a"), F.col("rk").alias("ak"), F.col("m").alias("b"), F.col("mk").alias("bk")).distinct()
    ids = met.select(F.col("rep").alias("doc_id"), F.col("rk").alias("tkey")).distinct()
    rows = narrow(docs).withColumn("tkey", text_key())
    texts = stage(rows.join(ids, ["doc_id", "tkey"], "left_semi").dropDuplicates(["doc_id", "tkey"]))
    # rows that share an id are one document, so their classes are linked through it
    several = stage(classed.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo != hi").select("doc_id", "lo"))
    links = confirmed(star, texts, k, percent)
    if staged_rows(several):
        links = links.union(classed.join(several, "doc_id").filter("rep != lo").select(F.col("rep").alias("a"), F.col("lo").alias("b")).distinct())
    links = stage(links)
    roots = components(links)
    # buckets that still hold several components; their smallest ids have been tested
    lab = met.join(roots, met["rep"] == roots["node"], "left").select("key", "m", "mk", "rep", "rk", "n", F.coalesce("root", "rep").alias("comp"))
    mixed = lab.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_MEMBERS, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"),
    ).filter("lo != hi").select("key", "blocks")
    left = lab.filter("rep != m OR rk != mk").join(mixed, "key").select("key", "rep", "rk", "comp", "blocks")
    late = stage(links_in_cells(left, texts, k, percent))
    if staged_rows(late):
        roots = components(roots.toDF("a", "b").union(late))
    by_class = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        "d1", "d2", "n_shingles", F.coalesce("root", "rep").alias("comp")
    )
    out = sig.select("doc_id", "tkey", "n_shingles", "d1", "d2").join(by_class, ["d1", "d2", "n_shingles"], "left")
    comp = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("comp", "doc_id"))
    return out.withColumn("component_id", comp).select(
        "doc_id", "tkey", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def components_of_documents(docs: DataFrame) -> DataFrame:
    """The digest of every document: two-word shingles, similarity 0.8."""
    return near_duplicates(docs, k=2).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one_of_each(docs: DataFrame, k: int = 5) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component, with all columns."""
    kept = near_duplicates(docs, k).filter("kept").select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).distinct()
    d = docs.withColumn("__tkey", text_key())
    return d.join(kept, d["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (d["__tkey"] == kept["__key"]), "left_semi").drop("__tkey")
