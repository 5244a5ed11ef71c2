"""Aligning the tokens of two tokenizers, and counting which ids they link.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (sentencepiece) the text,
to which it adds that space.  Where tokens of both end at one byte, they are cut into groups;
inside a group, tokens whose byte ranges overlap are linked.

Method (diagonal run skipping, ``align``): with ``d`` the shift between the indexes of A and B,
stretches in which token k of A and token k + d of B end together are jumped by exponential
probing of the two end arrays, and narrowed by halving.  Where the ends part, the irregular
group is resolved token by token up to the next common end, which gives the new shift.

Plan: one Python pass encodes and aligns every document and stages, per document, its digests and
its id pairs with their counts.  Documents come in blocks of ``BLOCK_BYTES`` of text; a block stages
its own summed pairs once (pre-aggregation), so the shuffle carries a pair once per block, not once
per link.  Spark sums the pairs over all blocks, finds the highest count of every B id, and gives
each block the counts of its pairs; the block's documents then look theirs up.

Edge rules: a null or empty text, or one that either tokenizer doesn't give back byte by byte, has
no tokens: zeros and ``''``.  Rows that repeat an id, or have none, are documents of their own.  An empty
table gives no rows.  The rarest of many pairs are kept like any other.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tillpoint.llm.common import narrow, python_tasks, single_threaded_tokenizers, stage, text_of, tokenizer_path

TOKENIZER_B = "piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20
#: Pieces remembered by a Python worker (two generations, as in ``tokens``).
CACHE_PIECES = 400_000
MARK = "▁"
DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long"
SCHEMA = DIGEST + ", n_best long, count_sum long, groups_sha256 string"


# --------------------------------------------------------------------------
# the aligner
# --------------------------------------------------------------------------


def align(a: bytes, b: bytes) -> tuple[list[int], list[int], list[int], list[int]]:
    """Links in byte order from the byte lengths of all tokens of A and of B, whose sums are
    equal: (index in a), (index in b), and which of them are jumped stretches, and how long.
    Ends are compared from a common start on, so tokens end together as long as lengths agree."""
    si: list[int] = []
    sj: list[int] = []
    at: list[int] = []
    runs: list[int] = []
    link_a, link_b = si.append, sj.append
    i, d, n = 0, 0, len(a)  # token i of A begins together with token i + d of B
    while i < n:
        j = i + d
        link_a(i)
        link_b(j)
        ahead = a[i] - b[j]  # how far A's end is beyond B's
        i += 1
        if not ahead:
            k, step = i, 2  # tokens up to k on this diagonal end together
            while a[k : k + step] == b[k + d : k + d + step] and k + step <= n:
                k += step
                step += step
            while step > 1:
                step >>= 1
                if a[k : k + step] == b[k + d : k + d + step] and k + step <= n:
                    k += step
            if k > i:
                at.append(len(si) - 1)
                runs.append(k - i + 1)
                i = k
        else:  # irregular: token by token up to the next common end
            while ahead:
                if ahead < 0:
                    link_b(j)
                    link_a(i)
                    ahead += a[i]
                    i += 1
                else:
                    j += 1
                    link_a(i - 1)
                    link_b(j)
                    ahead -= b[j]
            d = j + 1 - i
    return si, sj, at, runs


def links(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping pairs (index in a, index in b), in byte order."""
    si, sj, at, runs = (np.array(x, np.int64) for x in align(a, b))
    n = np.ones(len(si), np.int64)
    n[at] = runs
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(si, n) + within, np.repeat(sj, n) + within


# --------------------------------------------------------------------------
# encoding with both tokenizers
# --------------------------------------------------------------------------


class Encoders:
    """Ids of both tokenizers for whole texts, checked byte by byte."""

    def __init__(self, path_a: str, path_b: str):
        single_threaded_tokenizers()
        import sentencepiece

        from tillpoint.llm.tokens import Encoder

        self.a = Encoder(path_a)
        self.a.t.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = self._byte_alphabet()
        size = self.a.t.get_vocab_size()
        self.bytes_a = [bytes(map(alphabet.__getitem__, self.a.t.id_to_token(k) or "")) for k in range(size)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode()
            for k, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if size > 65_536 or len(self.bytes_b) > 65_536:
            raise ValueError("ids wider than 16 bits")
        if max(map(len, self.bytes_a + self.bytes_b)) > 255:
            raise ValueError("tokens longer than 255 bytes")
        self.len_a = np.array(list(map(len, self.bytes_a)), np.uint8)
        self.len_b = np.array(list(map(len, self.bytes_b)), np.uint8)
        # a piece of B holds its mark, if any, before all else: words are then encoded apart
        self.cut = not any(MARK in p.lstrip(MARK) for p in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.cut &= not any("\n" in self.b.id_to_piece(k) for k in range(self.b.get_piece_size()))
        # piece -> ids of A, ids of B (None if B does not give the piece back); younger and older
        self.young: tuple[dict, dict] = ({}, {})
        self.old: tuple[dict, dict] = ({}, {})

    def _byte_alphabet(self) -> dict[str, int]:
        """The character by which a byte-level vocabulary writes each byte: printable bytes are
        themselves, the others the code points from 256 on, in order."""
        out, other = {}, 256
        for k in range(256):
            if 33 <= k <= 126 or 161 <= k <= 172 or 174 <= k <= 255:
                out[chr(k)] = k
            else:
                out[chr(other)], other = k, other + 1
        return out

    def _whole(self, text: str) -> tuple[bytes, bytes] | None:
        a = self.a.t.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        want = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return None
        return np.array(a, "<u2").tobytes(), np.array(b, "<u2").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Remember pieces: each stands for a space and itself, or from a line break on for itself.
        A encodes them in one text, as it never merges across their starts."""
        raw = [p.encode() if p[:1] == "\n" else b" " + p.encode() for p in pieces]
        a = np.array(self.a.t.encode_batch_fast([b"".join(raw).decode()], add_special_tokens=False)[0].ids, np.int64)
        ends = np.append(0, np.cumsum(self.len_a[a], dtype=np.int64))
        want = np.append(0, np.cumsum(list(map(len, raw))))
        cut = np.searchsorted(ends, want)
        joined = b"".join(map(self.bytes_a.__getitem__, a.tolist()))
        if ends[-1] != want[-1] or (ends[cut] != want).any() or joined != b"".join(raw):
            raise ValueError("tokenizer A does not give its text back byte by byte")
        packed, cut = a.astype("<u2").tobytes(), (2 * cut).tolist()
        self.young[0].update((p, packed[x:y]) for p, x, y in zip(pieces, cut, cut[1:]))
        got = self.b.encode(pieces, num_threads=1)
        breaks = [p[:1] == "\n" for p in pieces]
        got = [x[1:] if own else x for x, own in zip(got, breaks)]  # after B's own space
        shown = [b"".join(map(self.bytes_b.__getitem__, x)) for x in got]
        packed = array("H", chain.from_iterable(got)).tobytes()
        cut = (2 * np.append(0, np.cumsum(list(map(len, got))))).tolist()
        self.young[1].update((p, packed[x:y] if s == r else None) for p, x, y, s, r in zip(pieces, cut, cut[1:], shown, raw))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Little-endian 16-bit ids of A and B for each text, or None if it has no tokens."""
        from tillpoint.llm.tokens import _piecewise

        parts = [t.replace("\n", " \n").split(" ") if t and self.cut and _piecewise(t) else None for t in texts]
        need = set().union(*(p for p in parts if p))
        if len(self.young[0]) > CACHE_PIECES:
            self.old, self.young = self.young, ({}, {})
        need -= self.young[0].keys()
        for p in need & self.old[0].keys():
            self.young[0][p], self.young[1][p] = self.old[0][p], self.old[1][p]
        need -= self.young[0].keys()
        if need:
            self._learn(sorted(need))
        in_a, in_b = self.young[0].__getitem__, self.young[1].__getitem__
        out = []
        for t, p in zip(texts, parts):
            try:
                out.append((b"".join(map(in_a, p)), b"".join(map(in_b, p))))
            except TypeError:  # not piece by piece
                out.append(self._whole(t) if t else None)
        return out


_LOADED: dict[tuple[str, str], Encoders] = {}


def encoders(path_a: str, path_b: str) -> Encoders:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Encoders(path_a, path_b)
    return _LOADED[path_a, path_b]


# --------------------------------------------------------------------------
# a batch of documents
# --------------------------------------------------------------------------

#: How many decimal digits a 16-bit id has.
_DIGITS = np.array([len(str(k)) for k in range(65_536)], np.int64)


class Aligned:
    """All documents with tokens of one batch, aligned in one pass: documents end at a common
    byte, so no group crosses from one to the next."""

    def __init__(self, enc: Encoders, texts: list[str]):
        got = enc.encode(texts)
        live = [x for x in got if x is not None]
        self.enc = enc
        self.a = np.frombuffer(b"".join(x[0] for x in live), "<u2").astype(np.int64)
        self.b = np.frombuffer(b"".join(x[1] for x in live), "<u2").astype(np.int64)
        self.n_a = np.array([len(x[0]) // 2 if x else 0 for x in got], np.int64)
        self.n_b = np.array([len(x[1]) // 2 if x else 0 for x in got], np.int64)
        len_a, len_b = enc.len_a[self.a], enc.len_b[self.b]
        self.la, self.lb = links(len_a.tobytes(), len_b.tobytes())
        end_a, end_b = np.cumsum(len_a, dtype=np.int64), np.cumsum(len_b, dtype=np.int64)
        self.closes = end_a[self.la] == end_b[self.lb]
        self.first = np.searchsorted(self.la, np.append(0, np.cumsum(self.n_a)))  # links before each document
        self.n_links = np.diff(self.first)
        self.n_groups = np.diff(np.append(0, np.cumsum(self.closes))[self.first])

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups; the empty string without tokens."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        ga, gb = self.la[self.closes], self.lb[self.closes]
        last_a[ga] = last_b[gb] = 1
        # tokens of A stand after all earlier groups' tokens of B, tokens of B after their group's of A
        place_a = np.arange(len(self.a)) + np.append(0, gb + 1)[np.cumsum(last_a) - last_a]
        place_b = np.arange(len(self.b)) + np.append(ga + 1, 0)[np.cumsum(last_b) - last_b]
        ids = np.empty(len(self.a) + len(self.b), np.int32)
        sign = np.full(len(ids), ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        sign[place_a[ga]], sign[place_b[gb]] = ord("|"), ord(";")
        ends = np.append(0, np.cumsum(_DIGITS[ids] + 1))
        raw = np.empty(ends[-1], np.uint8)
        raw[ends[1:] - 1] = sign
        at, left = ends[1:] - 2, ids
        while len(at):  # the last digit not yet written
            more = left // 10
            raw[at] = left - 10 * more + 48
            live = more > 0
            at, left = at[live] - 1, more[live]
        raw, at = raw.tobytes(), ends[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(at, at[1:])]

    def pairs(self) -> np.ndarray:
        """The id pair of every link, as A's id and B's id in 32 bits."""
        return ((self.a[self.la] << 16) | self.b[self.lb]).astype(np.uint32)


# --------------------------------------------------------------------------
# the Spark plan
# --------------------------------------------------------------------------


def _staged(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (``pairs``: places in the block's pairs; ``n``: how often each) and of
    blocks (``doc_id`` null; ``pairs``: the block's pairs, ascending; ``n``: their links)."""
    python_tasks(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc = encoders(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def flush():
            nonlocal held, size, block
            keys = np.concatenate([x[6] for x in held]) if held else np.zeros(0, np.uint32)
            times = np.concatenate([x[7] for x in held]) if held else np.zeros(0, np.int64)
            pairs, place = np.unique(keys, return_inverse=True)
            links = np.bincount(place, times, len(pairs)).astype(np.int64)
            rows, at = [], 0
            for i, n_a, n_b, n_groups, n_links, digest, k, t in held:
                own = place[at : at + len(k)].astype("<u4")
                at += len(k)
                rows.append((block, False, i, n_a, n_b, n_groups, n_links, digest, own.tobytes(), t.astype("<u4").tobytes()))
            rows.append((block, True, None, 0, 0, 0, int(links.sum()), "", pairs.astype("<u4").tobytes(), links.astype("<i8").tobytes()))
            held, size, block = [], 0, block + 1
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
            names = ["block", "summed", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "n"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            got = Aligned(enc, texts)
            all_pairs, digests = got.pairs(), got.digests()
            for k, i in enumerate(ids):
                own, t = np.unique(all_pairs[got.first[k] : got.first[k + 1]], return_counts=True)
                held.append((i, int(got.n_a[k]), int(got.n_b[k]), int(got.n_groups[k]), int(got.n_links[k]), digests[k], own, t))
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES:
                yield flush()
        if held:
            yield flush()

    rows = narrow(docs).select("doc_id", text_of().alias("text"))
    schema = "block long, summed boolean, " + DIGEST + ", groups_sha256 string, pairs binary, n binary"
    return stage(rows.mapInArrow(run, schema))


def _block_pairs(staged: DataFrame) -> DataFrame:
    """block, a, b, links: the summed pairs of every block, one row each."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for block, pairs, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                p = np.frombuffer(pairs, "<u4")
                cols = [np.full(len(p), block), (p >> 16).astype(np.int32), (p & 0xFFFF).astype(np.int32), np.frombuffer(n, "<i8")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["block", "a", "b", "links"])

    return staged.filter("summed").select("block", "pairs", "n").mapInArrow(run, "block long, a int, b int, links long")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a, b, links over the whole corpus, and whether no other A id is linked more often with b.
    Partitions of the window are bounded by A's vocabulary."""
    total = blocks.groupBy("a", "b").agg(F.sum("links").alias("links"))
    return total.withColumn("best", F.col("links") == F.max("links").over(W.Window.partitionBy("b")))


def _looked_up(left, right):
    """The documents of one block with the counts of their pairs."""
    import pyarrow as pa

    own = right.sort_by([("a", "ascending"), ("b", "ascending")])
    links, best = own["links"].to_numpy(), own["best"].to_numpy().astype(np.int64)
    sums, bests = [], []
    for pairs, n in zip(left["pairs"].to_pylist(), left["n"].to_pylist()):
        at, t = np.frombuffer(pairs, "<u4"), np.frombuffer(n, "<u4").astype(np.int64)
        sums.append(int((links[at] * t).sum()))
        bests.append(int((best[at] * t).sum()))
    cols = [left[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), left["groups_sha256"]]
    return pa.table(cols, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def aligned(docs: DataFrame, tokenizer_a: str | None = None, tokenizer_b: str | None = None) -> DataFrame:
    """One row per document, see ``SCHEMA``."""
    staged = _staged(docs, tokenizer_a or tokenizer_path(), tokenizer_b or tokenizer_path(TOKENIZER_B))
    blocks = stage(_block_pairs(staged))
    counts = stage(pair_counts(blocks))
    given = blocks.select("block", "a", "b").join(counts, ["a", "b"])
    own = staged.filter("NOT summed").drop("summed")
    return own.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(_looked_up, SCHEMA)
