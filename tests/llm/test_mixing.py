"""Mixing sources to target weights."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tillpoint.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    """Documents with columns whose names clash with internal ones."""
    return spark.createDataFrame(
        [(i, t, s, 1.0, 2, 3) for i, t, s in rows], "doc_id long, text string, source string, p double, sid long, size long"
    )


def brute_targets(sizes):
    """Share by weight, cap what is above, share again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    out, free, rest = {}, set(order), sum(sizes.values())
    while True:
        total = sum(weight[s] for s in free)
        above = {s for s in free if rest * weight[s] / total > 3 * sizes[s]}
        if not above:
            return out | {s: rest * weight[s] / total for s in free}
        out |= {s: 3.0 * sizes[s] for s in above}
        free -= above
        rest -= sum(3 * sizes[s] for s in above)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for k in range(900):
        s = rng.choice(["hot"] * 6 + ["a", "b", "Z", "é", "small", "", None])
        n = int(rng.paretovariate(0.7) * 3) % 4000 if s != "small" else 1
        out.append((k, " ".join(["w"] * n) + rng.choice(["", "\n", " \t"]), s))
    out += [(901, None, "a"), (902, "", "only empty"), (903, " \n", None), (0, out[0][1], out[0][2]), out[5], (None, "x y", "b"), (None, None, None)]
    return out


@pytest.mark.parametrize("leaf,fan", [(4096, 256), (16, 3)])
def test_mix_meets_targets(spark, rows, monkeypatch, leaf, fan):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN", fan)
    got = mixing.mixed(table(spark, rows)).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, size(t), s) for i, t, s in rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for i, t, s in rows:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    want = brute_targets(dict(sizes))
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-12, abs=1e-9)
        assert r["taken"] == r["copies"] * r["size"]
        if r["size"]:  # a rate is rounded to one of its two neighbours
            assert abs(r["copies"] - want[s] / sizes[s]) < 1
            assert r["copies"] <= 3
        else:
            assert r["copies"] == 0
        taken[s] += r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        # exact up to a word or two, unless one document outweighs the others
        assert abs(taken[s] - want[s]) <= max(2, 2 * largest[s] - sizes[s])
    again = mixing.mixed(table(spark, rows[::-1]).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_of_nothing(spark):
    assert mixing.mixed(table(spark, [])).count() == 0
    got = mixing.mixed(table(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert sorted((r["size"], r["source_size"], r["target"], r["taken"]) for r in got) == [(0, 0, 0.0, 0)] * 2


def test_pivot_keeps_words_and_expectations():
    size, start = [7, 9, 12, 8, 15], [0.2, 0.7, 0.5, 0.9, 0.35]
    luck = iter(np.random.default_rng(1).random(10**6).tolist())
    mean, runs = np.zeros(5), 20_000
    for _ in range(runs):
        p = list(start)
        left = mixing.pivot(size, p, list(range(5)), luck)
        assert sum(a * b for a, b in zip(size, p)) == pytest.approx(sum(a * b for a, b in zip(size, start)))
        assert all(x in (0.0, 1.0) for k, x in enumerate(p) if k != left)
        mean += p
    assert np.abs(mean / runs - start).max() < 0.02
    p = [0.0, 1.0, 0.5, 1.0, 0.0]
    assert mixing.pivot(size, p, list(range(5)), luck) == 2 and p == [0.0, 1.0, 0.5, 1.0, 0.0]


def test_settle_meets_the_owed_words():
    rng, luck = random.Random(2), iter(np.random.default_rng(3).random(10**6).tolist())
    for _ in range(200):
        size = [rng.randint(1, 2 ** rng.randint(1, 11)) for _ in range(60)]
        p = [rng.random() for _ in size]
        owed = sum(a * b for a, b in zip(size, p))
        mixing.settle(size, p, list(range(60)), luck)
        assert abs(sum(a * b for a, b in zip(size, p)) - owed) <= min(size) / 2 + 1e-6 and set(p) <= {0.0, 1.0}
    size, p = [5000, 3], [0.3, 0.5]  # nothing can make up for the large one
    mixing.settle(size, p, [0, 1], luck)
    assert p == [0.0, 1.0]


def test_settle_keeps_expectations_while_the_pool_can_pay():
    size, start = [9, 9, 8, 8, 7, 7, 6, 6, 5, 5, 4, 4, 3, 3, 2, 2, 1, 1, 1, 1] * 2, 0.4
    luck, mean, runs = iter(np.random.default_rng(5).random(10**6).tolist()), np.zeros(40), 5000
    for _ in range(runs):
        p = [start] * 40
        mixing.settle(size, p, list(range(40)), luck)
        mean += p
    assert np.abs(mean / runs - start)[:-1].max() < 0.06  # the very last one goes to the nearer side
