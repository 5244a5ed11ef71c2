"""Exact quantiles of several columns without a buffer of their values.

``F.percentile`` keeps every distinct value of a column in one task.  Here a double is mapped to
a 64-bit integer of the same order (``ordered_bits``), and the order statistics that the
quantiles need are found by refining prefixes of these integers, 16 bits a round: one hash
aggregate counts the rows of each prefix of every column (partially aggregated map-side, at
most 65,536 rows a column), a running sum finds the prefixes that hold a wanted rank, and only
their rows enter the next round.  At most four rounds over a staged copy of the columns; a prefix
whose rows are all equal is done at once.  The driver sees counts, and two prefixes a quantile.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.sources.sinks import stage

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
ROUND_BITS = 16
COLUMNS_A_SCAN = 6

_LEAST_NORMAL = 2.0**-1022
_INF_BITS = 0x7FF0000000000000
_NAN_BITS = 0x7FF8000000000000


def _guess(size: Column) -> Column:
    return F.floor(F.log2(size)).cast("double")


def _exponent(size: Column, guess: Column) -> Column:
    two = F.lit(2.0)
    return F.when(size < F.pow(two, guess), guess - 1).when(size >= F.pow(two, guess + 1), guess + 1).otherwise(guess)


def _bits(x: Column, size: Column, exponent: Column) -> Column:
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0**52)
    normal = (exponent + 1023).try_cast("bigint") * F.lit(2**52) + fraction.try_cast("bigint")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).try_cast("bigint")  # multiples of 2**-1074
    bits = (
        F.when(size == F.lit(float("inf")), F.lit(_INF_BITS))
        .when(size == 0, F.lit(0).cast("bigint"))
        .when(size < F.lit(_LEAST_NORMAL), tiny)
        .otherwise(normal)
    )
    signed = bits * F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(F.isnan(x), F.lit(_NAN_BITS)).when(x.isNotNull(), signed)


def ordered_bits(x: Column) -> Column:
    """A bigint with the order of the double ``x``: its IEEE 754 bits, negated for a negative one.

    The exponent is the logarithm's floor, put right by comparing with exact powers of two; the
    quotient by that power and the scaled fraction are exact.  Both zeros give 0; NaN comes last,
    as in Spark's order; NULL stays NULL."""
    x = x.cast("double")
    size = F.abs(x)
    return _bits(x, size, _exponent(size, _guess(size)))


def _images(df: DataFrame, exprs: Sequence[Column]) -> DataFrame:
    """``ordered_bits`` of every expression as c0, c1, ..., step by step, so that no step's
    expression is repeated within the next one's."""
    n = range(len(exprs))
    df = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(exprs)])
    df = df.select("*", *[F.abs(f"x{i}").alias(f"s{i}") for i in n])
    df = df.select("*", *[_guess(F.col(f"s{i}")).alias(f"g{i}") for i in n])
    df = df.select("*", *[_exponent(F.col(f"s{i}"), F.col(f"g{i}")).alias(f"e{i}") for i in n])
    return df.select(*[_bits(F.col(f"x{i}"), F.col(f"s{i}"), F.col(f"e{i}")).alias(f"c{i}") for i in n])


def from_ordered_bits(bits: int) -> float:
    """The double of an image (the driver's side of ``ordered_bits``)."""
    return -from_ordered_bits(-bits) if bits < 0 else struct.unpack("<d", struct.pack("<q", bits))[0]


def _order_statistics(images: DataFrame, wanted: dict[int, set[int]]) -> dict[tuple[int, int], int]:
    """(column, rank from 0) -> image, for the wanted ranks of columns ``c0``, ``c1``, ..."""
    found: dict[tuple[int, int], int] = {}
    # (column, prefix) -> [(rank among the prefix's rows, rank among all)]; first one prefix holds all
    open_: dict[tuple[int, int], list[tuple[int, int]]] = {(i, 0): [(r, r) for r in sorted(ranks)] for i, ranks in wanted.items()}
    for left in range(64 - ROUND_BITS, -1, -ROUND_BITS):
        if not open_:
            break
        parts, live = [], sorted({i for i, _ in open_})
        for k in range(0, len(live), COLUMNS_A_SCAN):  # few columns a scan keep the generated code small
            cells = []
            for i in live[k : k + COLUMNS_A_SCAN]:
                c = F.col(f"c{i}")
                parent = F.lit(0).cast("bigint") if left + ROUND_BITS == 64 else F.shiftright(c, left + ROUND_BITS)
                cell = F.struct(F.lit(i).alias("i"), parent.alias("parent"), F.shiftright(c, left).alias("prefix"), c.alias("image"))
                cells.append(F.when(c.isNotNull() & parent.isin([p for j, p in open_ if j == i]), cell))
            parts.append(images.select(F.explode(F.array(*cells)).alias("x")).filter("x IS NOT NULL").select("x.*"))
        counted = (
            reduce(DataFrame.union, parts)
            .groupBy("i", "parent", "prefix")
            .agg(F.count(F.lit(1)).alias("n"), F.min("image").alias("lo"), F.max("image").alias("hi"))
        )
        before = F.sum("n").over(Window.partitionBy("i", "parent").orderBy("prefix")) - F.col("n")
        holds = [
            (F.col("i") == i) & (F.col("parent") == p) & (F.col("before") <= r) & (F.lit(r) < F.col("before") + F.col("n"))
            for (i, p), ranks in open_.items()
            for r, _ in ranks
        ]
        rows = counted.withColumn("before", before).filter(reduce(Column.__or__, holds)).collect()  # at most one a rank
        ahead: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for row in rows:
            for r, whole in open_[row["i"], row["parent"]]:
                if row["before"] <= r < row["before"] + row["n"]:
                    if row["lo"] == row["hi"]:
                        found[row["i"], whole] = row["lo"]
                    else:
                        ahead.setdefault((row["i"], row["prefix"]), []).append((r - row["before"], whole))
        open_ = ahead
    return found


def exact_quantiles(
    df: DataFrame, cols: Sequence[str] | Mapping[str, Column], qs: Sequence[float] = QUARTILES
) -> dict[str, list[float | None]]:
    """The ``qs`` quantiles of each column, with linear interpolation between order statistics
    (position ``(n - 1) * q``); NULLs are left out, and a column without values gives None."""
    exprs = dict(cols) if isinstance(cols, Mapping) else {c: F.col(c) for c in cols}
    images = stage(_images(df, list(exprs.values())))
    counts = images.agg(*[F.count(c).alias(c) for c in images.columns]).first()
    places = {i: [(n - 1) * float(q) for q in qs] for i, n in enumerate(counts) if n}
    wanted = {i: {f(at) for at in own for f in (math.floor, math.ceil)} for i, own in places.items()}
    found = _order_statistics(images, wanted)

    def at(i: int, place: float) -> float:
        lo, hi = math.floor(place), math.ceil(place)
        a, b = (from_ordered_bits(found[i, k]) for k in (lo, hi))
        return a if found[i, lo] == found[i, hi] else (hi - place) * a + (place - lo) * b

    return {name: [at(i, p) for p in places[i]] if i in places else [None] * len(qs) for i, name in enumerate(exprs)}
