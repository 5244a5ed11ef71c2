"""Exact quantiles by prefix refinement."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.functions import stats
from tillpoint.operators import eda, score

EDGE = [0.0, -0.0, 1.0, -1.0, 2.0**-1074, -(2.0**-1074), 2.0**-1022, 2.0**-1022 - 2.0**-1074, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1 / 3, 1e-310, 2.0**52, 2.0**53 + 2]


def raw(x):
    bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -bits if x < 0 else bits


def test_images_are_the_bits_of_the_double(spark):
    rng = random.Random(1)
    xs = EDGE + [s * math.ldexp(rng.choice([1.0, rng.random() + 1, 2 - 2.0**-52]), e) for e in range(-1074, 1024, 7) for s in (1, -1)]
    xs += [y for e in range(-60, 60) for y in (2.0**e, math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf))]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", stats.ordered_bits(F.col("x")).alias("b")).collect()
    for r in rows:
        assert r.b == raw(r.x), r.x
        assert stats.from_ordered_bits(r.b) == r.x
    odd = spark.createDataFrame([(float("nan"),), (None,)], "x double").select(stats.ordered_bits(F.col("x")).alias("b")).collect()
    assert odd[0].b > max(r.b for r in rows) and odd[1].b is None and math.isnan(stats.from_ordered_bits(odd[0].b))


def test_quantiles_equal_percentile(spark):
    rng = random.Random(2)
    n = 3001
    data = [
        (
            rng.paretovariate(0.3),  # a very long tail
            float(rng.randint(-3, 3)),  # few values
            rng.gauss(0, 1) * 10.0 ** rng.randint(-300, 300),
            7.5,  # constant
            1e9 + k * 1e-6,  # values that agree in their leading bits
            float(rng.randint(0, 10**6)) if rng.random() < 0.2 else None,
            None,
            k,
        )
        for k in range(n)
    ]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double, f double, g double, h long")
    cols, qs = list("abcdefgh"), (0.0, 0.05, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0)
    got = stats.exact_quantiles(df, cols, qs)
    want = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*map(F.lit, qs))).alias(c) for c in cols]).first()
    for c in cols:
        assert got[c] == (want[c] if want[c] is not None else [None] * len(qs)), c
    clean = np.array([r[0] for r in data])
    assert got["a"] == pytest.approx(np.percentile(clean, [100 * q for q in qs]).tolist(), rel=1e-9)
    assert stats.exact_quantiles(df.filter("a < 0"), ["a"]) == {"a": [None] * 5}
    assert stats.exact_quantiles(df.limit(1), {"z": F.lit(3.0)}) == {"z": [3.0] * 5}


def test_hot_value_does_not_hide_the_rest(spark):
    """A third of all rows on one value, the others one by one around it."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 500.0).otherwise(F.col("id") / 9).alias("x"))
    got = stats.exact_quantiles(df, ["x"], (0.1, 0.5, 0.9))["x"]
    assert got == df.select(F.percentile("x", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))).first()[0]


def test_no_plan_buffers_all_values(spark):
    df = spark.range(100).select(F.col("id").alias("merchant_id"), F.col("id").cast("double").alias("v"), (F.col("id") % 2).alias("target"))
    for out in (eda.column_quartiles(df, ["v"]), eda.rate_by_quartile_bin(df, ["v"]), score.iqr_fence(df, "v")):
        assert "percentile" not in out._jdf.queryExecution().toString().lower()
    assert eda.column_quartiles(df, ["v"]).collect()[0][1:] == (0.0, 24.75, 49.5, 74.25, 99.0)
    bins = {r.bin: (r.lo, r.hi, r.n_merchants) for r in eda.rate_by_quartile_bin(df, ["v"]).collect()}
    assert bins == {1: (-0.01, 0.0, 1), 2: (0.0, 24.0, 24), 3: (24.0, 49.0, 25), 4: (49.0, 74.0, 25), 5: (74.0, 99.0, 25)}
    none = df.filter("v < 0")
    assert eda.rate_by_quartile_bin(none, ["v"]).count() == 0 and score.iqr_fence(none, "v").count() == 0
