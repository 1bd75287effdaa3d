"""contrail: a Spark-native medallion engine for aircraft state vectors.

Raw payloads (JSON) -> Bronze (raw rows) -> Silver (typed, latest row per
aircraft and position time) -> Gold (hour x country x geohash sector x flight
phase aggregates with an hourly density rank) -> dashboard datasets and
data-quality reports.  Every operator is a ``DataFrame -> DataFrame`` function
built from Spark's own operators; only sinks run actions.
"""

__version__ = "0.1.0"
