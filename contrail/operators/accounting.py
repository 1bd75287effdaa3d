"""What became of every landed value, and how its fields changed.

A *unit* is a state vector of a payload, a record, or whatever else was landed in
their place.  ``units`` gives each unit of a set of stored Bronze values exactly
one outcome, so the outcomes of a load add up to what was landed:

* ``unparsable``: a value that is not JSON; ``file_skipped``: a good value beside
  such a one; ``empty_array``, ``empty_payload``: nothing inside;
* ``not_a_record``: a number, text, null, or a vector that is no array;
* ``null_icao24``, ``null_time_position``, ``invalid_time_position``: no key;
* ``superseded``: another row of the load has the key and wins; ``silver``: the
  rows that go on.

``variant_drift`` discovers the fields of each load's values by aggregation and
holds them against the expected ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.timefn import epoch_to_ntz
from contrail.operators.bronze_silver import field
from contrail.schemas import MIN_VECTOR_SLOTS, SLOT_TYPES, SLOTS
from contrail.sources.bronze import elements, variant_rows


def _is(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).startswith(kind)


def units(values: DataFrame) -> DataFrame:
    """load, source_file, vector, s, outcome (null: has a key), icao24,
    time_position of every unit.  ``values``: rows of ``stored_values``."""
    whole = F.when(F.col("bad_text").isNotNull(), "unparsable").when(F.col("file_skipped"), "file_skipped")
    rows = values.select("load", "source_file", "bad_text", "raw_data", whole.alias("whole"), elements("raw_data").alias("inside"))
    rows = rows.withColumn("whole", F.coalesce("whole", F.when(F.size("inside") == 0, "empty_array")))
    # a value that is settled whole stays one unit
    rows = rows.select("load", "source_file", "bad_text", "whole", F.explode(
        F.when(F.col("whole").isNotNull(), F.array("raw_data")).otherwise(F.col("inside"))).alias("raw_data"))
    states = F.when(F.col("whole").isNull(), F.try_variant_get("raw_data", "$.states", "array<variant>"))
    item = lambda is_vector, v, outcome: F.struct(F.lit(is_vector).alias("vector"), v.alias("s"), outcome.alias("outcome"))
    none, raw = F.lit(None).cast("string"), F.col("raw_data")
    vectors = F.transform(states, lambda v: item(True, v, F.when(~_is(v, "ARRAY"), "not_a_record")))
    single = F.array(item(False, raw, F.coalesce("whole", F.when(~_is(raw, "OBJECT"), "not_a_record"))))
    inside = F.when(states.isNull(), single).when(F.size(states) == 0, F.array(item(False, raw, F.coalesce(none, F.lit("empty_payload"))))) \
              .otherwise(vectors)
    rows = rows.select("load", "source_file", "bad_text", F.explode(inside).alias("u")).select("load", "source_file", "bad_text", "u.*")
    open_ = F.col("outcome").isNull()
    rows = rows.select("*", *[F.when(open_, field(c)).alias(c) for c in ("icao24", "time_position")],
                       F.when(open_, field("time_position", "string")).alias("time_text"))
    rows = rows.withColumn("epoch", F.col("time_position")).withColumn("time_position", epoch_to_ntz(F.col("epoch")))
    return rows.withColumn("outcome", F.coalesce("outcome", F.when(F.col("icao24").isNull(), "null_icao24")
                           .when(F.col("time_text").isNull(), "null_time_position")
                           .when(F.col("time_position").isNull(), "invalid_time_position"))).drop("epoch", "time_text")


def landed(values: DataFrame) -> DataFrame:
    """load, n: units by the sizes of the landed arrays alone."""
    inside = elements("raw_data")
    per = F.transform(inside, lambda v: F.greatest(F.lit(1), F.coalesce(F.size(F.try_variant_get(v, "$.states", "array<variant>")), F.lit(1))))
    whole = F.col("bad_text").isNotNull() | F.col("file_skipped") | (F.size(inside) == 0)
    n = F.when(whole, 1).otherwise(F.aggregate(per, F.lit(0), lambda a, b: a + b))
    return values.groupBy("load").agg(F.sum(n).alias("n"))


def conservation(values: DataFrame) -> DataFrame:
    """load, outcome, n: every unit counted once (keys are counted by load)."""
    rows = units(values)
    # rows without a key are combined before the shuffle: their key columns are null
    key = [F.when(F.col("outcome").isNull(), F.col(c)).alias(c) for c in ("icao24", "time_position")]
    per_key = rows.select("load", "outcome", *key).groupBy("load", "outcome", "icao24", "time_position").agg(F.count(F.lit(1)).alias("n"))
    named = F.when(F.col("outcome").isNotNull(), F.array(F.struct(F.col("outcome").alias("outcome"), F.col("n").alias("n")))) \
             .otherwise(F.array(F.struct(F.lit("silver").alias("outcome"), F.lit(1).cast("long").alias("n")),
                                F.struct(F.lit("superseded").alias("outcome"), (F.col("n") - 1).alias("n"))))
    return per_key.select("load", F.explode(named).alias("o")).groupBy("load", "o.outcome").agg(F.sum("o.n").alias("n")).where("n > 0")


def rejects(values: DataFrame) -> DataFrame:
    """Units that are lost to Silver for what they are, with their raw text."""
    rows = units(values).where("outcome IS NOT NULL AND outcome NOT LIKE 'empty%' AND outcome <> 'file_skipped'")
    return rows.select("load", "source_file", "outcome", F.coalesce("bad_text", F.to_json("s")).alias("raw_text"))


# --- drift of the raw fields ----------------------------------------------------------

_KINDS = {"string": ("string",), "bigint": ("number", "string"), "double": ("number", "string"), "boolean": ("boolean", "string")}
_ANY = ("string", "number", "boolean", "array", "object", "mixed")
_RECORD_ONLY = {"time_fetched": ("number",)}

#: Expected fields of each shape and the kinds that a field may have.
EXPECTED = {
    "payload": {"time": ("number",), "fetched_at": ("number",), "states": ("array",)},
    "record": {c: _KINDS[k] for c, k in SLOT_TYPES.items()} | _RECORD_ONLY,
    "vector": {f"slot_{k}": _ANY for k in range(MIN_VECTOR_SLOTS) if k not in SLOTS.values()}
    | {c: _KINDS[SLOT_TYPES[c]] for c in SLOTS},
}


def _kind(schema: Column) -> Column:
    kind = F.regexp_extract(schema, "^[A-Z]+", 0)
    out = F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number")
    for name, label in (("STRING", "string"), ("BOOLEAN", "boolean"), ("ARRAY", "array"), ("OBJECT", "object"), ("VOID", "null")):
        out = out.when(kind == name, label)
    return out.otherwise("mixed")


def discovered(values: DataFrame) -> DataFrame:
    """load, shape, field, found, n: kind of every field (or vector slot) over all
    readable values of a load, by one aggregate that is combined before its
    shuffle.  The values are read once: an object gives its fields and its slots."""
    objects = variant_rows(values.where("bad_text IS NULL AND NOT file_skipped")).select(
        "load", F.try_variant_get("raw_data", "$.states", "array<variant>").alias("states"),
        F.map_entries(F.try_variant_get("raw_data", "$", "map<string,variant>")).alias("fields"))
    cell = lambda shape, name, v: F.struct(shape.alias("shape"), name.alias("field"), v.alias("v"))
    shape = F.when(F.col("states").isNotNull(), "payload").otherwise("record")
    names = {k: c for c, k in SLOTS.items()}
    names = F.array(*[F.lit(names.get(k)) for k in range(max(names) + 1)])
    slot = lambda v, k: cell(F.lit("vector"), F.coalesce(F.get(names, k), F.concat(F.lit("slot_"), k.cast("string"))), v)
    vectors = F.transform("states", lambda s: F.transform(F.try_variant_get(s, "$", "array<variant>"), slot))
    cells = (F.transform("fields", lambda e: cell(shape, e["key"], e["value"])), F.flatten(F.filter(vectors, lambda s: s.isNotNull())))
    return objects.select("load", F.inline(F.concat(*[F.coalesce(c, F.array()) for c in cells]))).groupBy("load", "shape", "field").agg(
        _kind(F.schema_of_variant_agg("v")).alias("found"), F.count(F.lit(1)).alias("n"))


def variant_drift(values: DataFrame) -> DataFrame:
    """load, shape, field, found, n, status: ``same``, ``retyped`` (of a kind the
    field may not have), ``new`` or ``vanished`` (no value of a shape that the
    load has).  Nulls alone are no change."""
    found = discovered(values)
    want = F.create_map(*[x for shape, fields in EXPECTED.items() for x in (F.lit(shape), F.array(*[
        F.struct(F.lit(f).alias("field"), F.array(*map(F.lit, kinds)).alias("kinds")) for f, kinds in fields.items()]))])
    expected = found.select("load", "shape").distinct().select("load", "shape", F.explode(F.element_at(want, F.col("shape"))).alias("e")) \
                    .select("load", "shape", "e.field", "e.kinds")
    status = F.when(F.col("kinds").isNull(), "new").when(F.col("found").isNull(), "vanished") \
              .when((F.col("found") == "null") | F.array_contains("kinds", F.col("found")), "same").otherwise("retyped")
    return found.join(expected, ["load", "shape", "field"], "full").select(
        "load", "shape", "field", "found", F.coalesce("n", F.lit(0)).cast("long").alias("n"), status.alias("status"))
