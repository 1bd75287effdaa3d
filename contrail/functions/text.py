"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs, newlines,
    Unicode spaces), unlike ``trim`` which removes blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
