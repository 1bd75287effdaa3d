"""The batch run: landing JSON -> Bronze -> Silver -> Gold -> checks.

A pass reads the new landing files only, as one load of the Bronze table, and
takes that load through the other layers (``ingest_load``); the incremental stream
does the same with each micro-batch.  Each layer is written before the next reads
it, which cuts the lineage, lets a lost executor recompute from the last written
layer, and keeps every job's plan short.  Intermediate tables live under the shared
folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contrail.operators import accounting as A
from contrail.operators import gold as G
from contrail.operators import quality as Q
from contrail.operators import silver as S
from contrail.operators.bronze_silver import bronze_silver_rows, bronze_vectors
from contrail.plans import catalog_tables as CT
from contrail.plans import gold_state as GS
from contrail.plans import tables
from contrail.schemas import GOLD_COLUMNS, SILVER
from contrail.sources.bronze import ledger_path, load_files, read_bronze, read_ledger, stored_values


@dataclass
class RunResult:
    silver_rows: int
    gold_rows: int
    checks: DataFrame


def build_gold(spark: SparkSession, silver: DataFrame, gold_path: str, full: bool = True) -> None:
    """Aggregate, materialize the aggregate, rank it without re-shuffling it
    (distinct-level join), and publish Gold (all of it, or the days it has)."""
    with tables.written(spark, G.sector_aggregates(G.base_vectors(silver)), "gold_aggregates") as agg:
        tables.refresh_gold(spark, G.rank_sectors(agg, materialized=True).select(*GOLD_COLUMNS), gold_path, full)


def refresh_gold_days(spark: SparkSession, silver_path: str, days: DataFrame, gold_path: str) -> None:
    """Recompute and publish Gold for the touched days (``day``) only."""
    scope = tables.read_days(spark, silver_path, tables.SILVER, tables.DAY).join(days, tables.DAY, "left_semi")
    build_gold(spark, scope.drop(tables.DAY), gold_path, full=False)


def upsert_layers(spark: SparkSession, wh: str, rows: DataFrame, table: str | None = None) -> None:
    """Upsert written Silver rows and bring the Gold state, the sketches and Gold up to
    date.  A row and what it supersedes have the same (hour, aircraft), so only those
    pairs are aggregated again from Silver.  The state is published before Gold and
    Gold's touched hours are folded from it as a whole: a batch done again after a
    failure at any point gives the same tables.  ``table``: the catalog table in buckets
    that Silver is."""
    pairs = rows.select(F.col("icao24"), G.hour_floor(F.col("time_position")).alias("snapshot_hour")).distinct()
    if not tables.exists(spark, f"{wh}/gold_sketches/_SUCCESS"):     # published last: Silver from before the state was kept
        stored = tables.read_silver(spark, f"{wh}/silver")
        pairs = pairs.unionByName(stored.select("icao24", G.hour_floor(F.col("time_position")).alias("snapshot_hour"))).distinct()
    with tables.written(spark, pairs, "touched") as touched:
        if table:
            CT.upsert_silver(spark, table, f"{wh}/silver", rows)
        else:
            tables.upsert_silver(spark, f"{wh}/silver", rows)
        GS.refresh_state(spark, f"{wh}/silver", f"{wh}/gold_state", touched)
        GS.refresh_gold_hours(spark, f"{wh}/gold_state", f"{wh}/gold", f"{wh}/gold_sketches", touched)


def ingest_load(spark: SparkSession, warehouse: str, load: str, mode: str = "upsert", check: bool = True,
                max_lag_seconds: int | None = None, fail_on_drift: bool = False, table: str | None = None) -> list[tuple]:
    """Take one finished Bronze load through the other layers; returns its check
    rows.  Everything is written per load, overwriting what an earlier attempt left;
    ``accounting`` is written last and marks the load as done.

    The gates see this load only, and before Silver is touched: row counts and the
    newest times are observed while its rows are written, the ledger counts its
    values, and every landed unit must have exactly one outcome."""
    wh = warehouse.rstrip("/")
    bronze = f"{wh}/bronze"
    values = stored_values(spark, bronze, load)
    objects = read_bronze(spark, bronze, load)
    seen = Observation()
    rows = bronze_silver_rows(objects).observe(seen, F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("now"),
                                               F.max("time_position").alias("newest"))
    with tables.written(spark, rows, "silver_rows") as rows:
        of_load = f"load={load}"
        tables.overwrite(Q.quarantine(bronze_vectors(objects)), f"{wh}/quarantine/{of_load}")
        tables.overwrite(A.rejects(values).drop("load"), f"{wh}/rejects/{of_load}")
        tables.overwrite(A.variant_drift(values).drop("load"), f"{wh}/drift/{of_load}")
        with tables.written(spark, A.conservation(values).drop("load"), "accounting") as outcomes:
            checks = _load_checks(spark, wh, load, values, seen.get, outcomes, max_lag_seconds, fail_on_drift)
            failed = [c for c in checks if not c[-1]]
            if not (check and failed):
                _publish_rows(spark, wh, rows, mode, of_load, table)
            tables.overwrite(outcomes, f"{wh}/accounting/{of_load}")
    if check and failed:
        raise ValueError("Data quality checks failed: " + "; ".join(f"{c[0]}/{c[1]}: {c[3]} rows" for c in failed))
    return checks


def _load_checks(spark, wh, load, values, seen, outcomes, max_lag_seconds, fail_on_drift) -> list[tuple]:
    n_values = read_ledger(spark, f"{wh}/bronze").where(F.col("load") == load).agg(F.sum("n_values")).first()[0] or 0
    total = outcomes.agg(F.sum("n")).first()[0] or 0
    landed = A.landed(values).agg(F.sum("n")).first()[0] or 0
    drifted = {r["status"]: r["count"] for r in spark.read.parquet(f"{wh}/drift/load={load}").groupBy("status").count().collect()}
    rows = [("bronze", "row_count>0", n_values, int(n_values == 0)), ("silver_input", "row_count>0", seen["n"], int(seen["n"] == 0)),
            ("bronze", "conservation", landed, abs(landed - total)),
            *[("bronze", f"fields_{s}", drifted.get(s, 0), drifted.get(s, 0) if fail_on_drift and s == "retyped" else 0)
              for s in ("new", "retyped", "vanished")]]
    if max_lag_seconds is not None and seen["newest"] is not None:
        lag = int((seen["now"] - seen["newest"].replace(minute=0, second=0, microsecond=0)).total_seconds())
        rows.append(("gold", f"freshness:snapshot_hour<={max_lag_seconds}s", lag, int(lag > max_lag_seconds)))
    return [(*r, r[-1] == 0) for r in rows]


def _publish_rows(spark: SparkSession, wh: str, rows: DataFrame, mode: str, of_load: str, table: str | None) -> None:
    if mode == "upsert":
        upsert_layers(spark, wh, rows, table)
    elif mode == "append":
        tables.overwrite(S.latest(rows), f"{wh}/silver_append/{of_load}")
    else:
        raise ValueError(mode)


def unfinished_loads(spark: SparkSession, warehouse: str) -> list[str]:
    """Loads of the ledger that a run has not taken to the end."""
    wh = warehouse.rstrip("/")
    done = {name for name in tables.folders(spark, f"{wh}/accounting") if tables.exists(spark, f"{wh}/accounting/{name}/_SUCCESS")}
    ledger = ledger_path(f"{wh}/bronze")
    return sorted(name.removeprefix("load=") for name in tables.folders(spark, ledger)
                  if name.startswith("load=") and name not in done and tables.exists(spark, f"{ledger}/{name}/_SUCCESS"))


def run(spark: SparkSession, landing: str, warehouse: str, mode: str = "upsert",
        multi_line: bool = False, ingested_at="file", check: bool = True, force: bool = False,
        days: tuple[str, str] | None = None, max_lag_seconds: int | None = None, fail_on_drift: bool = False,
        database: str | None = None, n_buckets: int = CT.BUCKETS) -> RunResult:
    """One pass over the landing files that are new or changed since the last one
    (``force``: all; ``days``: of these date partitions only).  ``mode="upsert"``
    keeps one row per key across runs; ``mode="append"`` reproduces the
    append-only Silver.

    Writes ``bronze`` with its load ledger, ``silver``, ``gold_state`` (partial aggregates
    per group, aircraft and callsign), ``gold``, ``gold_sketches`` (mergeable distinct
    counts), ``country_hourly`` (the hourly country summary) and, per load, ``quarantine`` (suspicious vectors),
    ``rejects`` (what did not reach Silver, with its text), ``drift`` (fields that are
    new, vanished or of another type) and ``accounting`` (units by outcome) below
    ``warehouse``.  A load that an earlier run did not finish is done first.

    ``database``: ``silver`` (in ``n_buckets`` buckets by aircraft), ``gold`` and
    ``country_hourly`` are tables of this database over those folders, made if absent."""
    wh = warehouse.rstrip("/")
    if mode not in ("upsert", "append"):
        raise ValueError(mode)
    if database and mode != "upsert":
        raise ValueError("a database needs upserts")
    table = f"{database}.silver" if database else None
    if table:
        CT.create_silver(spark, table, f"{wh}/silver", n_buckets)
    load_files(spark, landing, f"{wh}/bronze", multi_line, ingested_at, force=force, days=days)
    rows = []
    for load in unfinished_loads(spark, wh):
        rows += ingest_load(spark, wh, load, mode, check, max_lag_seconds, fail_on_drift, table)
    if mode == "upsert":
        silver = tables.read_silver(spark, f"{wh}/silver")
    else:
        silver = spark.read.schema(SILVER).parquet(f"{wh}/silver_append") if tables.exists(spark, f"{wh}/silver_append") \
            else spark.createDataFrame([], SILVER)
        build_gold(spark, silver, f"{wh}/gold")
    tables.overwrite(G.country_hourly(silver), f"{wh}/country_hourly")
    if database:
        CT.create_gold(spark, f"{database}.gold", f"{wh}/gold")
        CT.create_summary(spark, f"{database}.country_hourly", f"{wh}/country_hourly")
    gold = tables.read_gold(spark, f"{wh}/gold")
    loaded = spark.createDataFrame(rows, "layer string, check string, observed long, failed_rows long, passed boolean")
    checks = Q.combine(loaded, Q.row_count_check(gold, "gold"), Q.duplicate_checks(silver, "silver", ("icao24", "time_position")))
    if check:
        # Append mode piles up repeated keys by design: reported, not raised.
        Q.assert_passed(checks if mode == "upsert"
                        else checks.filter(~checks.check.startswith("duplicate")))
    counts = silver.agg(F.count(F.lit(1)).alias("n")).first()
    return RunResult(counts.n, gold.count(), checks)
