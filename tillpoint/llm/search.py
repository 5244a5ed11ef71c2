"""Ranked lexical search with per-term geometric blocks.

Terms are maximal runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters.  The
score is an integer form of BM25, see ``part`` and ``weights``; N, L and df are counted over all
documents before any document is scored.

Method: documents are indexed in shards of ``SHARD_DOCS``.  A shard lines its documents up by
similarity (nearest of ``LEADERS`` leaders by cosine, the leaders chained to their nearest
neighbours), and cuts every term's posting list into blocks of similar documents, about ``BLOCK``
each.  A block stores the maximum of each coordinate over its documents, rounded up to a byte.
For an item, lists are read from the one that can add most; a block is skipped only if its
summary's score, an upper bound, is below the item's k-th score so far, and the rest of the lists
only if all of them together are.  All others are scored exactly.  The k best go on from shard
to shard of a task, so later shards skip more.

Plan: one pass over the texts stages term counts (coordinates that no item has are left out: they
enter neither scores nor bounds), an aggregate gives N, L and df, and one pass over the staged rows
searches; a task emits at most k rows an item, and Spark's ranking limits them before its shuffle.
Items are the given queries: they are read in blocks of ``ITEM_BYTES`` of text, and every block is
searched against all rows.  In a task, items go in batches of at most ``BATCH_TERMS`` distinct
terms (or one item), so memory is bounded by that and the shard, whatever the corpus.

Edge rules: null, empty and term-free texts have no terms: no document finds them, and as
items they find nothing.  Rows that repeat a doc_id are ranked each; a missing doc_id comes last among
equals.  Items are rows too: a repeated item_id gets its ranks per row.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tillpoint.llm.common import narrow, python_tasks, stage

TOP = 10
SHARD_DOCS = 4096
#: A task searches about this many shards, whatever the corpus.
TASK_SHARDS = 2
LEADERS = 64
BLOCK = 64
BATCH_TERMS = 4096
ITEM_BYTES = 32 << 20
#: One step of a block summary: parts are below 1,000,000, so 8 bits hold them rounded up.
STEP = 4096
#: A summary takes its block's rows in parts of this size, which stay in the processor's cache.
GATHER_BYTES = 256 << 10
_TERM_BYTES = bytes(k + 32 if 65 <= k <= 90 else k if 48 <= k <= 57 or 97 <= k <= 122 or k >= 128 else 32 for k in range(256))

ORACLE_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
  UNION ALL
  SELECT 'q', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark
), counts AS (SELECT kind, id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT id, sum(tf)::BIGINT AS n FROM counts WHERE kind = 'd' GROUP BY id),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
norms AS (SELECT id, 25 + (75 * n * n_docs) // n_terms AS m FROM lengths, corpus),
rarity AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, corpus WHERE kind = 'd' GROUP BY term, n_docs
), scores AS (
  SELECT q.id AS item_id, d.id AS doc_id, sum(q.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m)))::BIGINT AS score
  FROM counts q JOIN counts d ON d.term = q.term AND d.kind = 'd' JOIN rarity r ON r.term = q.term JOIN norms USING (id)
  WHERE q.kind = 'q' GROUP BY q.id, d.id
), placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 10
""".replace("JOIN norms USING (id)", "JOIN norms m ON m.id = d.id")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def part(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one unit of weight scores: saturating in tf, falling with the document's length n."""
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for k in df.tolist()], np.int64)


class Best:
    """The k best documents of an item: highest score, then lowest id, missing ids last."""

    def __init__(self, k: int):
        self.k, self.floor = k, 0  # a score below the floor can't enter
        self.score = self.gone = self.doc = np.zeros(0, np.int64)

    def add(self, score: np.ndarray, gone: np.ndarray, doc: np.ndarray) -> None:
        use = (score >= self.floor) & (score > 0)
        if not use.any():
            return
        score, gone, doc = (np.concatenate([a, b[use]]) for a, b in ((self.score, score), (self.gone, gone), (self.doc, doc)))
        first = np.lexsort((doc, gone, -score))[: self.k]
        self.score, self.gone, self.doc = score[first], gone[first], doc[first]
        if len(first) == self.k:
            self.floor = int(self.score[-1])


class Shard:
    """Posting lists of the documents of a shard in geometric blocks, over ``n_terms`` terms.
    ``row``, ``term``, ``part``: the postings; ``weight``: of each term."""

    def __init__(self, n_rows: int, n_terms: int, row: np.ndarray, term: np.ndarray, part: np.ndarray, weight: np.ndarray):
        self.parts = np.zeros((n_rows, n_terms), np.int32)
        self.parts[row, term] = part
        place = self._line_up(weight)
        order = np.lexsort((place[row], term))
        self.row, term = row[order], term[order]
        df = np.bincount(term, minlength=n_terms)
        clusters = np.clip(-(-df // BLOCK), 1, LEADERS)[term]
        cluster = self.leader[self.row] * clusters // LEADERS  # neighbouring leaders join in short lists
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (cluster[1:] != cluster[:-1])
        self.starts = np.append(np.flatnonzero(new), len(term))  # of each block in the postings
        self.first = np.searchsorted(term[self.starts[:-1]], np.arange(n_terms + 1))  # of each term in the blocks
        self.summary = self._summaries()
        self.most = self.parts.max(axis=0, initial=0).astype(np.int64)

    def _line_up(self, weight: np.ndarray) -> np.ndarray:
        """The place of every document when similar ones stand together."""
        x = self.parts * weight.astype(np.float32)
        norm = np.sqrt((x * x).sum(axis=1)) + 1
        x /= norm[:, None]
        lead = x[np.linspace(0, len(x) - 1, LEADERS).astype(np.int64)]
        near, chain, left = lead @ lead.T, [0], set(range(1, LEADERS))
        while left:
            chain.append(max(left, key=lambda k: (near[chain[-1], k], -k)))
            left.remove(chain[-1])
        like = x @ lead[chain].T
        self.leader = like.argmax(axis=1)
        place = np.empty(len(x), np.int64)
        place[np.lexsort((-like[np.arange(len(x)), self.leader], self.leader))] = np.arange(len(x))
        return place

    def _summaries(self) -> np.ndarray:
        """The coordinatewise maximum of each block, in steps rounded up."""
        small = (-(-self.parts // STEP)).astype(np.uint8)
        out = np.zeros((len(self.starts) - 1, small.shape[1]), np.uint8)
        some = max(1, GATHER_BYTES // max(1, small.shape[1]))
        starts = self.starts.tolist()
        for summary, a, b in zip(out, starts, starts[1:]):  # a block holds no more rows than the shard
            for at in range(a, b, some):
                np.maximum(summary, small[self.row[at : min(at + some, b)]].max(axis=0), out=summary)
        return out

    def search(self, cols: np.ndarray, coef: np.ndarray, best: Best, gone: np.ndarray, doc: np.ndarray) -> int:
        """Put the documents that score high for an item (its terms and their weights times
        counts) into ``best``; how many were scored."""
        most = self.most[cols] * coef
        order = np.argsort(-most, kind="stable")
        rest = np.cumsum(most[order][::-1])[::-1]
        seen, scored = np.zeros(len(self.parts), bool), 0
        for t, ahead in zip(order.tolist(), rest.tolist()):
            if ahead == 0 or ahead < best.floor:
                break  # documents in no list read so far score no more than that
            lo, hi = self.first[cols[t]], self.first[cols[t] + 1]
            bound = (self.summary[lo:hi, cols].astype(np.int64) * STEP) @ coef
            blocks = lo + np.argsort(-bound, kind="stable")
            bound = bound[blocks - lo].tolist()
            at, step = 0, 1
            while at < len(blocks) and bound[at] >= best.floor:
                some = [b for b, x in zip(blocks[at : at + step].tolist(), bound[at : at + step]) if x >= best.floor]
                rows = np.concatenate([self.row[self.starts[b] : self.starts[b + 1]] for b in some])
                rows = rows[~seen[rows]]
                seen[rows] = True
                scored += len(rows)
                best.add(self.parts[np.ix_(rows, cols)].astype(np.int64) @ coef, gone[rows], doc[rows])
                at, step = at + step, 2 * step
        return scored


def batches_of_items(items: list[tuple[int, np.ndarray, np.ndarray]]) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Items in turn, as long as a batch has at most ``BATCH_TERMS`` distinct terms."""
    out, own = [], set()
    for x in items:
        more = own | set(x[1].tolist())
        if out and len(more) <= BATCH_TERMS:
            out[-1].append(x)
            own = more
        else:
            out.append([x])
            own = set(x[1].tolist())
    return out


# --------------------------------------------------------------------------
# the Spark plan
# --------------------------------------------------------------------------


def term_counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms), and the places in ``vocabulary`` and counts of the terms it holds;
    only documents with a term; staged."""
    python_tasks(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        own = {t: k for k, t in enumerate(vocabulary)}
        known = own.keys()
        for b in batches:
            ids, n, terms, tfs = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                words = terms_of(t) if t else ()
                if words:
                    c = Counter(words)
                    held = sorted((own[w], c[w]) for w in c.keys() & known)
                    ids.append(i)
                    n.append(len(words))
                    terms.append([x for x, _ in held])
                    tfs.append([x for _, x in held])
            arrays = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "tfs"])

    return stage(narrow(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>"))


def _search_block(docs: DataFrame, items: list[tuple[int | None, bytes]], top: int) -> DataFrame:
    """item (its place in ``items``), item_id, doc_id, score: every task's best; staged."""
    spark = docs.sparkSession
    counted = [(i, Counter(terms_of(t))) for i, t in items]
    vocabulary = sorted(set().union(*(c for _, c in counted)))
    place = {t: k for k, t in enumerate(vocabulary)}
    rows = term_counts(docs, vocabulary)
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # at most the items' terms
        df[r["term"]] = r["count"]
    weight = weights(df, n_docs)
    queries = []
    for k, (_, c) in enumerate(counted):
        own = sorted((place[t], n) for t, n in c.items() if df[place[t]] and weight[place[t]])
        if own:
            queries.append((k, np.array([t for t, _ in own]), np.array([n * int(weight[t]) for t, n in own], np.int64)))
    item_ids = [i for i, _ in items]

    def run(batches):
        import pyarrow as pa

        plans = []
        for group in batches_of_items(queries):
            terms = np.unique(np.concatenate([t for _, t, _ in group]))
            local = np.full(len(weight), -1, np.int64)
            local[terms] = np.arange(len(terms))
            plans.append((terms, local, group))
        best = {k: Best(top) for k, _, _ in queries}
        held, size = [], 0

        def shard():
            nonlocal held, size
            t = pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
            doc, gone = t["doc_id"].fill_null(0).to_numpy(), t["doc_id"].is_null().to_numpy().astype(np.int64)
            n_of = t["n"].to_numpy()
            terms, tfs = t["terms"].combine_chunks(), t["tfs"].combine_chunks()
            row = np.repeat(np.arange(len(t)), terms.value_lengths().to_numpy())
            term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
            got = part(tf, n_of[row], n_docs, n_terms)
            for own, local, group in plans:
                use = local[term] >= 0
                index = Shard(len(t), len(own), row[use], local[term[use]], got[use], weight[own])
                for k, cols, coef in group:
                    index.search(local[cols], coef, best[k], gone, doc)

        for b in batches:
            while b.num_rows:
                some = b.slice(0, SHARD_DOCS - size)
                held.append(some)
                size += some.num_rows
                b = b.slice(some.num_rows)
                if size == SHARD_DOCS:
                    shard()
        if held:
            shard()
        for k, x in best.items():
            n = len(x.score)
            if n:
                cols = [pa.array([k] * n, pa.int64()), pa.array([item_ids[k]] * n, pa.int64()), pa.array(x.doc, pa.int64(), mask=x.gone > 0), pa.array(x.score, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["item", "item_id", "doc_id", "score"])

    tasks = max(1, -(-n_docs // (TASK_SHARDS * SHARD_DOCS)))
    dealt = rows.filter(F.size("terms") > 0).repartition(tasks, F.xxhash64("doc_id", "n", "terms"))
    found = dealt.mapInArrow(run, "item long, item_id long, doc_id long, score long")
    order = W.Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return stage(ranked.select("item_id", "rank", "doc_id", "score"))


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank from 1, doc_id, score: the ``top`` best documents of every item."""
    rows = items.select(F.col(id_col).cast("long"), F.col(text_col)).filter(F.octet_length(F.col(text_col)) > 0)
    out, block, size = None, [], 0

    def flush():
        nonlocal out, block, size
        got = _search_block(docs, block, top)
        out = got if out is None else out.union(got)
        block, size = [], 0

    for i, text in rows.toLocalIterator():
        block.append((i, text.encode()))
        size += len(block[-1][1])
        if size >= ITEM_BYTES:
            flush()
    if block or out is None:
        flush()
    return out
