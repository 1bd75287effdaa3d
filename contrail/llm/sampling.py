"""Bounded samples of labelled rows, for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = 1 << 30


def bounded(rows: DataFrame, keys: list[str], sample: int) -> DataFrame:
    """At most ``sample`` rows, chosen by a hash of ``keys`` (unique), in a fixed
    order.  A hash filter first leaves about twice the sample, so the top-n
    below gathers that many rows and not ``sample`` rows of every task."""
    share = min(1.0, 2 * sample / max(1, rows.count()))
    few = rows.where(F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(_SPACE)) < int(share * _SPACE))
    return few.orderBy(F.xxhash64(*keys), *keys).limit(sample)
