"""Geohash of a (longitude, latitude) pair as pure Column arithmetic.

Spark has no geohash built-in, so the encoding is written out: ``5 * precision``
bits, longitude takes the even bit positions (counted from the most
significant end) and latitude the odd ones; each group of 5 bits indexes the
base-32 alphabet.  The integer cell of each axis is ``floor(fraction * 2^bits)``
clamped at both edges, which is the same bisection the textbook encoder
performs: a coordinate beyond the map (longitude outside [-180, 180], latitude outside
[-90, 90]) gets the cell at the edge it lies beyond.  NULL in -> NULL out.  Everything
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the geohash base-32 alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _cell(value: Column, lo: float, span: float, bits: int) -> Column:
    top = (1 << bits) - 1
    raw = F.floor((value - F.lit(lo)) / F.lit(span) * F.lit(float(1 << bits)))
    return F.least(F.greatest(raw, F.lit(0)), F.lit(top)).cast("long")


def geohash(lng: Column, lat: Column, precision: int) -> Column:
    total = 5 * precision
    lon_bits = (total + 1) // 2
    lat_bits = total // 2
    lon_cell = _cell(lng, -180.0, 360.0, lon_bits)
    lat_cell = _cell(lat, -90.0, 180.0, lat_bits)
    chars = []
    for c in range(precision):
        value = F.lit(0).cast("long")
        for b in range(5):
            j = 5 * c + b  # global bit index from the most significant end
            if j % 2 == 0:
                src, nbits, i = lon_cell, lon_bits, j // 2
            else:
                src, nbits, i = lat_cell, lat_bits, j // 2
            bit = F.shiftright(src, nbits - 1 - i).bitwiseAND(F.lit(1))
            value = value + F.shiftleft(bit, 4 - b)
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (value + 1).cast("int"), 1))
    out = F.concat(*chars)
    return F.when(lng.isNotNull() & lat.isNotNull(), out)
