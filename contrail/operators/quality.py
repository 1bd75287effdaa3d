"""Data-quality checks.  Every check returns rows of
``(layer, check, observed, failed_rows, passed)``; one aggregate job per
layer computes all of a layer's numbers.  ``assert_passed`` is the thin
raising wrapper a scheduler calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.timefn import ntz_to_epoch, valid_epoch
from contrail.operators.parse import slot, typed_slot
from contrail.schemas import MIN_VECTOR_SLOTS, SLOT_TYPES

CHECK_COLUMNS = ("layer", "check", "observed", "failed_rows", "passed")


def _rows(layer: str, named: dict[str, tuple[Column, Column]], source: DataFrame) -> DataFrame:
    """Evaluate ``{check: (observed, failed_rows)}`` aggregates in one pass
    and turn them into check rows (``passed`` = no failed rows)."""
    aggs = []
    for i, (obs, failed) in enumerate(named.values()):
        aggs += [obs.cast("bigint").alias(f"o{i}"), failed.cast("bigint").alias(f"f{i}")]
    one = source.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"o{i}").alias("observed"),
                 F.col(f"f{i}").alias("failed_rows"))
        for i, name in enumerate(named)]))
    return one.select(stack.alias("c")).select(
        F.lit(layer).alias("layer"), "c.check",
        F.coalesce("c.observed", F.lit(0)).alias("observed"),
        F.coalesce("c.failed_rows", F.lit(0)).alias("failed_rows"),
        (F.coalesce("c.failed_rows", F.lit(0)) == 0).alias("passed"))


def null_checks(df: DataFrame, layer: str, required) -> DataFrame:
    """Null count of every column; only ``required`` columns fail on nulls."""
    named = {}
    for c in df.columns:
        nulls = F.sum(F.col(c).isNull().cast("bigint"))
        named[f"nulls:{c}"] = (nulls, nulls if c in required else F.lit(0))
    return _rows(layer, named, df)


def duplicate_checks(df: DataFrame, layer: str, key) -> DataFrame:
    """Rows beyond the first of every repeated key (map-side combined
    count per key, then one small aggregate)."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    extra = F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0))
    return _rows(layer, {"duplicate_keys:" + ",".join(key):
                         (F.count(F.when(F.col("n") > 1, True)), extra)}, per_key)


def length_checks(df: DataFrame, layer: str, limits: dict[str, int]) -> DataFrame:
    named = {}
    for c, limit in limits.items():
        over = F.count(F.when(F.length(c) > limit, True))
        named[f"max_length:{c}<={limit}"] = (F.max(F.length(c)), over)
    return _rows(layer, named, df)


def row_count_check(df: DataFrame, layer: str) -> DataFrame:
    """Fails when the layer is empty."""
    n = F.count(F.lit(1))
    return _rows(layer, {"row_count>0": (n, F.when(n == 0, 1).otherwise(0))}, df)


def freshness_check(df: DataFrame, layer: str, ts_col: str, now: Column,
                    max_lag_seconds: int) -> DataFrame:
    """Lag between ``now`` and the newest ``ts_col``; fails beyond the limit."""
    lag = ntz_to_epoch(now) - ntz_to_epoch(F.max(ts_col))
    return _rows(layer, {f"freshness:{ts_col}<={max_lag_seconds}s":
                         (lag, F.when(lag.isNull() | (lag > max_lag_seconds), 1).otherwise(0))}, df)


def type_drift_checks(vectors: DataFrame, layer: str = "bronze") -> DataFrame:
    """Per typed slot: values present as text but not parsable as the slot's
    type (the data-level face of schema drift)."""
    named = {}
    for name, kind in SLOT_TYPES.items():
        if kind == "string":
            continue
        raw = slot(name)
        parsed = raw.try_cast("double" if kind == "bigint" else kind)
        bad = F.count(F.when(raw.isNotNull() & parsed.isNull(), True))
        named[f"parsable:{name}"] = (F.count(raw), bad)
    tpos = typed_slot("time_position")
    named["in_range:time_position"] = (F.count(tpos), F.count(F.when(~valid_epoch(tpos), True)))
    return _rows(layer, named, vectors)


def schema_drift(df: DataFrame, expected, layer: str) -> list[tuple]:
    """Schema-level drift (metadata only, no job): columns missing, extra,
    or of another type than the fixed schema.  Returns check tuples in the
    column order of ``CHECK_COLUMNS``; the data-level face of drift is
    ``type_drift_checks``."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    out = []
    for name in sorted(set(have) | set(want)):
        ok = have.get(name) == want.get(name)
        out.append((layer, f"schema:{name}:{want.get(name, '-')}",
                    0 if name in have else 1, 0 if ok else 1, ok))
    return out


def combine(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def quarantine(vectors: DataFrame, min_slots: int = MIN_VECTOR_SLOTS) -> DataFrame:
    """Rejected or suspicious vectors, one row per (vector, reason):
    ``short_vector`` (rejected by the record path), ``unparsable:<slot>``
    (value present, not of the slot's type) and ``out_of_range:time_position``
    (no valid epoch: dropped by the Silver path)."""
    reasons = [F.when(F.coalesce(F.size("state"), F.lit(-1)) < min_slots,
                      F.lit("short_vector"))]
    for name, kind in SLOT_TYPES.items():
        if kind == "string":
            continue
        raw = slot(name)
        parsed = raw.try_cast("double" if kind == "bigint" else kind)
        reasons.append(F.when(raw.isNotNull() & parsed.isNull(), F.lit(f"unparsable:{name}")))
    reasons.append(F.when(~valid_epoch(typed_slot("time_position")), F.lit("out_of_range:time_position")))
    return vectors.select(
        slot("icao24").alias("icao24"), slot("time_position").alias("time_position_raw"),
        "ingested_at", F.size("state").alias("slots"),
        F.explode(F.array_compact(F.array(*reasons))).alias("reason"))


def flag_nulls(silver_rows: DataFrame) -> DataFrame:
    """Flag instead of drop: every row kept, with one boolean per defect."""
    return silver_rows.select(
        "*",
        F.col("icao24").isNull().alias("missing_icao24"),
        F.col("time_position").isNull().alias("missing_time_position"),
        (F.col("longitude").isNull() | F.col("latitude").isNull()).alias("missing_position"),
        F.col("baro_altitude").isNull().alias("missing_altitude"),
        F.col("on_ground").isNull().alias("missing_on_ground"),
        F.col("callsign").isNull().alias("missing_callsign"),
        F.col("origin_country").isNull().alias("missing_country"),
    )


def assert_passed(checks: DataFrame) -> None:
    """Raise when any check failed (collects only the failing check rows)."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise ValueError("Data quality checks failed: " + "; ".join(
            f"{r.layer}/{r.check}: {r.failed_rows} rows" for r in failed))
