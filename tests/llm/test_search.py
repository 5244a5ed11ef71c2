"""Ranked lexical search, against brute force."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import frame
from tillpoint.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(data, items, top=10):
    docs = [(i, Counter(terms(t))) for i, t in data]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = Counter()
    for q, text in items:
        scores = []
        for i, c, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if s > 0:
                scores.append((-s, i is None, i or 0))
        for k, (s, gone, i) in enumerate(sorted(scores)[:top]):
            out[q, k + 1, None if gone else i, -s] += 1
    return out


def found(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


@pytest.fixture(scope="module")
def items(data):
    rng = random.Random(4)
    texts = [t for _, t in data if t and len(t) > 100]
    out = [(k, " ".join(rng.sample(rng.choice(texts).split(), 12))) for k in range(25)]
    out += [(50, "THE the É é an-be_an"), (51, None), (52, ""), (53, " -- "), (54, "nowhere"), (55, texts[0]), (56, texts[0]), (56, "ng"), (57, "der"), (None, "ou sh")]
    return out


@pytest.mark.parametrize("shard,block,terms_of_batch", [(4096, 64, 4096), (7, 2, 40), (16, 3, 1)])
def test_search_is_exact(spark, data, none, items, monkeypatch, shard, block, terms_of_batch):
    """Also with many shards, small blocks and batches of one item."""
    for name, x in (("SHARD_DOCS", shard), ("BLOCK", block), ("BATCH_TERMS", terms_of_batch), ("GATHER_BYTES", 500)):
        monkeypatch.setattr(search, name, x)
    docs = frame(spark, data).repartition(2)
    assert found(search.ranked(docs, item_frame(spark, items))) == brute(data, items)
    assert search.ranked(none, item_frame(spark, items)).count() == 0
    assert search.ranked(docs, item_frame(spark, [])).count() == 0


def test_items_in_several_blocks(spark, docs, data, items, monkeypatch):
    monkeypatch.setattr(search, "ITEM_BYTES", 2000)
    got = search.ranked(docs, item_frame(spark, items), top=3)
    assert found(got) == brute(data, items, 3)


def corpus(rng, topics=12, docs=1500, words=30, hot=300):
    """Documents of topics with words of their own, and a large group of copies."""
    out = []
    for k in range(docs):
        z = k % topics
        out.append([rng.choice([z * 50 + rng.randrange(50), 600 + rng.randrange(40)]) for _ in range(words)])
    return out + [out[3]] * hot


@pytest.mark.parametrize("block", [4, 64])
def test_blocks_skip_documents_but_lose_none(monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    rng = random.Random(8)
    docs = corpus(rng)
    n_terms = 640
    counts = [Counter(d) for d in docs]
    row = np.repeat(np.arange(len(docs)), [len(c) for c in counts])
    term = np.array([t for c in counts for t in c])
    tf = np.array([n for c in counts for n in c.values()])
    n = np.array([len(d) for d in docs])[row]
    part = search.part(tf, n, len(docs), int(sum(map(len, docs))))
    weight = search.weights(np.bincount(term, minlength=n_terms), len(docs))
    shard = search.Shard(len(docs), n_terms, row, term, part, weight)
    # every posting is in one block of its term, and no summary is below a document of its block
    own = np.repeat(np.arange(n_terms), np.diff(shard.starts[shard.first]))
    assert sorted(zip(shard.row.tolist(), own.tolist())) == sorted(zip(row.tolist(), term.tolist()))
    for b in range(len(shard.starts) - 1):
        rows = shard.row[shard.starts[b] : shard.starts[b + 1]]
        assert (shard.parts[rows].max(axis=0) <= shard.summary[b].astype(np.int64) * search.STEP).all()
    every, scored = 0, 0
    doc, gone = np.arange(len(docs))[::-1].copy(), np.zeros(len(docs), np.int64)
    for _ in range(40):
        q = Counter(rng.sample(rng.choice(docs), 8))
        cols = np.array(sorted(q))
        coef = weight[cols] * np.array([q[t] for t in sorted(q)])
        best = search.Best(10)
        scored += shard.search(cols, coef, best, gone, doc)
        full = shard.parts[:, cols].astype(np.int64) @ coef
        every += int((full > 0).sum())
        want = np.lexsort((doc, -full))[:10]
        assert best.doc.tolist() == doc[want].tolist() and best.score.tolist() == full[want].tolist()
    assert scored < 0.5 * every


def test_block_summaries_take_little_more_than_lining_up():
    """Their time follows the postings: one pass over each block's rows, none over all blocks' at once."""
    rng = np.random.default_rng(3)
    n, n_terms = 2048, 3000
    key = np.unique(np.repeat(np.arange(n), 100) * n_terms + (n_terms * rng.random(100 * n) ** 3).astype(np.int64))
    weight = np.ones(n_terms, np.int64)
    shard = search.Shard(n, n_terms, key // n_terms, key % n_terms, rng.integers(1, 1_000_000, len(key)), weight)

    def seconds(f, *args):
        begun = time.process_time()
        f(*args)
        return time.process_time() - begun

    assert min(seconds(shard._summaries) for _ in range(2)) < 6 * max(seconds(shard._line_up, weight) for _ in range(2))
