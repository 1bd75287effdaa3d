"""Unit conversions and the flight-phase classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion factors and phase labels / thresholds (feet).
METRES_TO_FEET = 3.28084
MS_TO_KNOTS = 1.94384
PHASE_GROUND = "Ground / Taxi"
PHASE_LOW = "Low Altitude / Approach"
PHASE_MID = "Mid Altitude"
PHASE_HIGH = "High Cruise"
PHASE_UNKNOWN = "Unknown"
LOW_CEILING_FT = 10000
HIGH_FLOOR_FT = 28000
PHASES = (PHASE_GROUND, PHASE_LOW, PHASE_MID, PHASE_HIGH, PHASE_UNKNOWN)


def feet(metres: Column) -> Column:
    return metres * F.lit(METRES_TO_FEET)


def knots(ms: Column) -> Column:
    return ms * F.lit(MS_TO_KNOTS)


def flight_phase(on_ground: Column, altitude_ft: Column) -> Column:
    """Ground first; a null ``on_ground`` falls through to the altitude bands.
    Both band edges belong to the middle band."""
    return (
        F.when(on_ground, F.lit(PHASE_GROUND))
        .when(altitude_ft < LOW_CEILING_FT, F.lit(PHASE_LOW))
        .when(altitude_ft.between(LOW_CEILING_FT, HIGH_FLOOR_FT), F.lit(PHASE_MID))
        .when(altitude_ft > HIGH_FLOOR_FT, F.lit(PHASE_HIGH))
        .otherwise(F.lit(PHASE_UNKNOWN))
    )
