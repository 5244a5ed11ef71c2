"""Token alignment, against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from tests.llm.conftest import frame
from tillpoint.llm import alignment
from tillpoint.llm.common import tokenizer_path

EXTRA = [
    (700, "\x00 nul"), (701, "a  b\n\nc \n d\te"), (702, "▁ mark"), (703, "<|endoftext|> <s> <0x41> </s>"), (704, " lead"),
    (705, "tail \n"), (706, "日本 語。\nÄ ½ Ａ"), (707, "x"), (708, "\nword"), (709, "a▁b c"),
]


def ends(parts):
    at, out = 0, []
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def overlaps(ea, eb):
    out, starts_a, starts_b = [], [0, *ea[:-1]], [0, *eb[:-1]]
    for i in range(len(ea)):
        out += [(i, j) for j in range(len(eb)) if starts_a[i] < eb[j] and starts_b[j] < ea[i]]
    return out


def test_align_finds_all_overlaps_in_any_cutting():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 60)
        p = rng.choice([0.05, 0.5, 0.95])
        cuts = [sorted({n, *(k for k in range(1, n) if rng.random() < q)}) for q in (p, rng.choice([p, 0.3]))]
        if rng.random() < 0.5:  # long equal stretches between a few irregular groups
            cuts = [sorted({*range(1, n + 1)} - set(rng.sample(range(1, n + 1), min(2, n - 1))) | {n}) for _ in range(2)]
        a, b = (bytes(y - x for x, y in zip([0, *c], c)) for c in cuts)
        la, lb = alignment.links(a, b)
        assert list(zip(la.tolist(), lb.tolist())) == overlaps(*cuts)
    assert [x.tolist() for x in alignment.links(b"", b"")] == [[], []]
    # one equal stretch is one jump, whatever its length
    assert [x[:3] for x in alignment.align(b"\1" * 1000, b"\1" * 1000)] == [[0], [0], [0], [1000]]


def brute(data):
    from tokenizers import Tokenizer
    import sentencepiece

    ta = Tokenizer.from_file(tokenizer_path())
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.TOKENIZER_B))
    table = {}
    for k in range(256):  # the byte-level alphabet
        own = 33 <= k <= 126 or 161 <= k <= 172 or 174 <= k <= 255
        table[chr(k) if own else chr(256 + sum(not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255) for x in range(k)))] = k
    docs, counts = [], Counter()
    for i, text in data:
        a, b = (ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)) if text else ([], [])
        bytes_a = [bytes(table[c] for c in ta.id_to_token(k)) for k in a]
        bytes_b = [bytes([int(tb.id_to_piece(k)[3:5], 16)]) if tb.is_byte(k) else tb.id_to_piece(k).replace("▁", " ").encode() for k in b]
        want = (" " + text).encode() if text else b""
        if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            a, b, bytes_a, bytes_b = [], [], [], []
        ea, eb = ends(bytes_a), ends(bytes_b)
        common = sorted(set(ea) & set(eb))
        groups, x, y = [], 0, 0
        for c in common:
            x2, y2 = ea.index(c, x) + 1, eb.index(c, y) + 1
            groups.append(",".join(map(str, a[x:x2])) + "|" + ",".join(map(str, b[y:y2])))
            x, y = x2, y2
        at, links, starts_a, starts_b = 0, [], [0, *ea], [0, *eb]
        for p in range(len(a)):
            while at < len(b) and eb[at] <= starts_a[p]:
                at += 1
            q = at
            while q < len(b) and starts_b[q] < ea[p]:
                links.append((a[p], b[q]))
                q += 1
        counts.update(links)
        docs.append((i, len(a), len(b), groups, links))
    high = Counter()
    for (p, q), n in counts.items():
        high[q] = max(high[q], n)
    out = Counter()
    for i, n_a, n_b, groups, links in docs:
        best = sum(counts[x] == high[x[1]] for x in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out[i, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), sha] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("pieces,block", [(400_000, 8 << 20), (500, 2000)])
def test_alignment_of_documents(spark, data, none, monkeypatch, pieces, block):
    """With ordinary settings; and with many blocks and a cache that turns over."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    rows = data + EXTRA
    got = alignment.aligned(frame(spark, rows).repartition(3)).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == brute(rows)
    assert alignment.aligned(none).count() == 0


def test_pieces_are_exact_however_small_the_cache(data, monkeypatch):
    enc = alignment.Encoders(tokenizer_path(), tokenizer_path(alignment.TOKENIZER_B))
    texts = [t or "" for _, t in data + EXTRA]
    whole = [enc._whole(t) if t else None for t in texts]
    assert enc.encode(texts) == whole
    monkeypatch.setattr(alignment, "CACHE_PIECES", 300)
    assert [x for t in texts for x in enc.encode([t])] == whole
    assert enc.encode(texts[::-1]) == whole[::-1]
