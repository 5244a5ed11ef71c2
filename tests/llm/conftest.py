import random

import pytest

LETTERS = ["an", "be", "ti", "or", "the", "sh", "é", "ng", "ou", "re"]


def words(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows():
    """(doc_id, text): plain, copies, near copies, repeated lines, null, empty, blank, one word, very long,
    no words of its own, repeated rows and a missing id."""
    rng = random.Random(5)
    base = [words(rng, 120) + "\n" + words(rng, 60) + ".\n" + words(rng, 40) for _ in range(12)]
    passage = words(rng, 130)
    lines = "\n".join(words(rng, 12) for _ in range(12))
    out = list(enumerate(base))
    out += [(100, base[0]), (101, base[0]), (102, base[1].replace("the", "THE", 1) + " tail"), (103, base[1] + " ou")]
    out += [(200 + k, words(rng, 30) + " " + passage + " " + words(rng, 30)) for k in range(3)]
    out += [(300 + k, words(rng, 8) + "\n" + lines + "\n" + words(rng, 9)) for k in range(4)]
    out += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one"), (405, "a b"), (406, "<|endoftext|> x  y\tz\n\n\\### ok </turn>")]
    out += [(500, words(rng, 6000)), (501, "der " * 700), (502, "Ab#$% x*** y&&& " * 40)]
    out += [(600, base[5]), (600, base[5]), (None, base[6]), (None, None)]
    return out


def frame(spark, data):
    """Documents with columns whose names clash with internal and result names."""
    return spark.createDataFrame(
        [(i, t, "x", "s", len(t or ""), 7, 8, "y") for i, t in data],
        "doc_id long, text string, lang string, source string, n_chars long, tkey long, slot long, kept string",
    )


@pytest.fixture(scope="session")
def data():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, data):
    return frame(spark, data).cache()


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
