"""Column expressions (no UDFs): geohash, units, flight phase, text, time."""

from contrail.functions.flight import (  # noqa: F401
    flight_phase, knots, feet, PHASES,
)
from contrail.functions.geo import geohash  # noqa: F401
from contrail.functions.text import py_strip  # noqa: F401
from contrail.functions.timefn import epoch_to_ntz, hour_floor, ntz_to_epoch  # noqa: F401
