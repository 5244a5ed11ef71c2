"""What tasks remember and look up: pieces of words (tokens), packed contexts (lm)."""

import numpy as np

from tillpoint.llm import lm, packing, tokens
from tillpoint.llm.common import tokenizer_path


def test_a_million_pieces_stay_known(monkeypatch):
    calls = []
    monkeypatch.setattr(tokens._Pieces, "encode", lambda self, piece, space: calls.append(piece) or b"")
    pieces = tokens._Pieces(tokens.encoder(tokenizer_path()).t, np.dtype("<u2"))
    for k in range(1_200_000):
        pieces[f"w{k}"]
    assert len(calls) == 1_200_000
    pieces["w0"]
    assert len(calls) == 1_200_000 and len(pieces) + len(pieces.old) < 2 * tokens.CACHE_PIECES


def test_packed_entries_are_the_tables_numbers():
    counts = np.arange(1 << 16)
    table = (counts / (counts + 1.5)).astype(np.float32)
    seen = counts.astype(np.uint16)
    assert np.array_equal(lm.trust(seen), table)
    assert np.array_equal(lm.evidence(seen), np.searchsorted([1, 4, 31], counts, side="right"))
    rng = np.random.default_rng(2)
    logits = rng.normal(0, 4, len(counts)).astype(np.float16)
    zero = rng.normal(0, 2, len(counts)).astype(np.float32)
    at = rng.integers(0, len(counts), (lm.ORDERS, len(counts)))
    x, gate = lm.inputs(zero, [lm.packed(logits, seen).take(a) for a in at])
    assert np.array_equal(x[0], zero) and all(np.array_equal(x[1 + k], zero + table[a] * (logits[a] - zero)) for k, a in enumerate(at))
    assert np.array_equal(gate, np.searchsorted([1, 4, 31], at[2], side="right") * 4 + np.searchsorted([1, 4, 31], at[1], side="right"))
    assert np.array_equal(lm.Learner.packed(np.zeros((4, 2)), np.array([0, 1, 2, 9])) >> 16, [[0, 0], [0, 0], [1, 1], [8, 8]])


def test_runs_number_ascending_values():
    for x in ([], [4], [1, 1, 1], [0, 0, 2, 5, 5, 9]):
        x = np.array(x, np.int64)
        _, place, n = np.unique(x, return_inverse=True, return_counts=True)
        got = packing.runs(x)
        assert np.array_equal(got[0], place) and np.array_equal(got[1], n)
