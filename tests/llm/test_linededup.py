"""Line dedup: what is shuffled, and what decides when fingerprints collide."""

import os
import random
import string

from pyspark.sql import functions as F

from tillpoint.llm import linededup


def shuffled(spark) -> dict[str, int]:
    """Bytes of each of Spark's shuffle files."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    paths = [files.apply(k).getPath() for k in range(files.size())]
    return {p: os.path.getsize(p) for p in paths if os.path.basename(p).startswith("shuffle_") and os.path.exists(p)}


def test_texts_that_do_not_repeat_are_not_shuffled_to_be_counted(spark, monkeypatch):
    rng = random.Random(9)
    line = lambda: "".join(rng.choices(string.ascii_letters + string.digits, k=400))
    passage = [line() for _ in range(4)]
    texts = ["\n".join([line() for _ in range(12)] + (passage if k < 3 else [])) for k in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").cache()
    assert docs.count() == 600
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables too large to broadcast
    before, seen = shuffled(spark), {}
    # files may be cleaned up later, so they are noted after every step
    monkeypatch.setattr(linededup, "stage", lambda df, f=linededup.stage: (f(df), seen.update(shuffled(spark)))[0])
    try:
        got = linededup.remove_repeated_passages(docs).collect()
        seen |= shuffled(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len({r["text"] for r in got}) == 600 and sum(r["__removed"] for r in got) == 8
    written = sum(n for p, n in seen.items() if p not in before)
    # twice whole, to meet the places that may repeat and those that go; 5.7 times when all chunks and pairs went
    assert written < 2.5 * sum(map(len, texts))


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    rng = random.Random(10)
    data = [(None if k == 5 else k % 30, "\n".join(f"line {rng.randint(0, 25)}" if rng.random() < 0.9 else "" for _ in range(rng.randint(1, 20)))) for k in range(40)]
    docs = spark.createDataFrame([*data, data[3], (50, None)], "doc_id long, text string")
    want = sorted(map(str, linededup.remove_repeated_passages(docs).collect()))
    monkeypatch.setattr(linededup, "fingerprints", lambda d, f=linededup.fingerprints: f(d).withColumn("fp", F.pmod("fp", F.lit(3))))
    assert sorted(map(str, linededup.remove_repeated_passages(docs).collect())) == want
    assert len(set(want)) > 1 and any("__removed=0" not in x for x in want)
