"""Geohash of a (longitude, latitude) point as a pure column expression.

The cell index on each axis is computed arithmetically, the two indices are
merged into one Morton (bit-interleaved) code as a linear sum of shifted bits
(every index is referenced once per bit, so the expression grows linearly and
subexpression elimination computes each index once), and the code is printed
in base 32 with ``conv`` and mapped onto the geohash alphabet with
``translate``.  Everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash base-32 alphabet, and the digits Spark's ``conv``
# prints for base 32.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
CONV_BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _cell(v: Column, lo: float, span: float, bits: int) -> Column:
    cells = 1 << bits
    idx = F.floor((v - F.lit(lo)) * F.lit(float(cells)) / F.lit(span))
    return F.least(idx, F.lit(cells - 1)).cast("bigint")


def geohash(lon: Column | str, lat: Column | str, precision: int) -> Column:
    """Geohash string of ``precision`` characters; null for a null or
    out-of-range coordinate."""
    if not 1 <= precision <= 12:
        raise ValueError("precision must be within 1..12")
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    lon_idx = _cell(lon, -180.0, 360.0, lon_bits)
    lat_idx = _cell(lat, -90.0, 180.0, lat_bits)
    # Bit b of the code (b = 0 is the most significant) comes from longitude
    # when b is even and from latitude when b is odd, most significant first.
    terms = []
    for b in range(nbits):
        idx, width = (lon_idx, lon_bits) if b % 2 == 0 else (lat_idx, lat_bits)
        src = width - 1 - b // 2
        bit = F.shiftright(idx, src).bitwiseAND(F.lit(1))
        terms.append(F.shiftleft(bit, nbits - 1 - b))
    code = terms[0]
    for t in terms[1:]:
        code = code.bitwiseOR(t)
    text = F.lpad(F.conv(code.cast("string"), 10, 32), precision, "0")
    hashed = F.translate(text, CONV_BASE32_DIGITS, GEOHASH_ALPHABET)
    valid = lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0)
    return F.when(valid, hashed)
