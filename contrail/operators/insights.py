"""Dashboard datasets over the Gold (and Silver) tables.

Each panel is a DataFrame function; a caller collects only the small final
result.  Panels take the Gold frame they should describe, so passing
``top_gold(gold, 5000)`` reproduces a dashboard that looks only at the
newest 5000 groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.schemas import GOLD_COLUMNS

# Dashboard page sizes, top-k sizes, and the KPI label shown
# when there is no Gold row.
GOLD_PAGE = 5000
SILVER_PAGE = 5000
TOP_COUNTRIES = 10
TOP_SCATTER_COUNTRIES = 5
NO_COUNTRY = "N/A"


def top_gold(gold: DataFrame, n: int = GOLD_PAGE) -> DataFrame:
    """Newest hours first, densest groups first; the group key breaks ties
    so the page is deterministic (planned as TakeOrderedAndProject)."""
    return gold.orderBy(
        F.col("snapshot_hour").desc_nulls_last(),
        F.col("hourly_sector_density_rank").asc_nulls_last(),
        F.col("origin_country").asc_nulls_last(),
        F.col("spatial_sector").asc_nulls_last(),
        F.col("flight_phase").asc_nulls_last(),
    ).limit(n)


def top_silver(silver: DataFrame, n: int = SILVER_PAGE) -> DataFrame:
    """Newest positions first (a null time sorts first, as in the warehouse's
    descending order), aircraft address as tie-break."""
    return silver.orderBy(F.col("time_position").desc_nulls_first(),
                          F.col("icao24").asc_nulls_last()).limit(n)


def kpi_cards(gold: DataFrame) -> DataFrame:
    """One row: summed aircraft counts over the groups (an aircraft seen in
    several groups counts in each), mean of the group mean speeds (and the
    aircraft-weighted mean), and the country with the most Gold rows (ties:
    alphabetically first).

    Computed as a per-country aggregate followed by a one-row aggregate:
    both stages are map-side combined, no value list reaches one task.
    """
    per_country = gold.groupBy("origin_country").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("unique_aircraft_count").alias("su"),
        F.sum("airborne_aircraft_count").alias("sa"),
        F.sum("avg_ground_speed_knots").alias("ss"),
        F.count("avg_ground_speed_knots").alias("cs"),
        F.sum(F.col("avg_ground_speed_knots") * F.col("unique_aircraft_count")).alias("ws"),
        F.sum(F.when(F.col("avg_ground_speed_knots").isNotNull(),
                     F.col("unique_aircraft_count"))).alias("wn"),
    )
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per_country.agg(
        F.coalesce(F.sum("su"), F.lit(0)).cast("bigint").alias("total_tracked_aircraft"),
        F.coalesce(F.sum("sa"), F.lit(0)).cast("bigint").alias("airborne_aircraft_volume"),
        F.coalesce(F.min_by("origin_country", F.struct(-F.col("n"), F.col("origin_country"))),
                   F.lit(NO_COUNTRY)).alias("busiest_country"),
        F.when(rows == 0, F.lit(0.0))
         .otherwise(F.round(F.sum("ss") / F.sum("cs"), 4)).alias("avg_ground_speed_knots"),
        # the unweighted mean of group means above is the dashboard's figure;
        # this one weights each group by its aircraft
        F.round(F.sum("ws") / F.sum("wn"), 4).alias("aircraft_weighted_speed_knots"),
        rows.cast("bigint").alias("gold_rows"),
    )


def country_volume(gold: DataFrame, n: int = TOP_COUNTRIES) -> DataFrame:
    return (gold.groupBy("origin_country")
                .agg(F.sum("unique_aircraft_count").alias("unique_aircraft_count"))
                .orderBy(F.col("unique_aircraft_count").desc(), F.col("origin_country"))
                .limit(n))


def hourly_traffic(gold: DataFrame) -> DataFrame:
    return gold.groupBy("snapshot_hour").agg(
        F.sum("airborne_aircraft_count").alias("airborne_aircraft_count"),
        F.sum("ground_aircraft_count").alias("ground_aircraft_count"),
    )


def geo_rows(gold: DataFrame) -> DataFrame:
    """Gold rows with a sector center and an airborne altitude."""
    return gold.dropna(subset=["sector_center_lon", "sector_center_lat",
                               "avg_airborne_altitude_ft"])


def country_frequency(rows: DataFrame) -> DataFrame:
    return rows.groupBy("origin_country").count()


def top_countries(rows: DataFrame, k: int = TOP_SCATTER_COUNTRIES) -> DataFrame:
    """The ``k`` most frequent countries (ties: alphabetical)."""
    return (country_frequency(rows)
            .orderBy(F.col("count").desc(), F.col("origin_country")).limit(k))


def top_country_rows(gold: DataFrame, k: int = TOP_SCATTER_COUNTRIES) -> DataFrame:
    """Rows of the ``k`` countries with the most located Gold rows (ties:
    alphabetical).  The country list is at most ``k`` rows, so it is
    broadcast into a left-semi join."""
    clean = geo_rows(gold)
    top = top_countries(clean, k).select("origin_country")
    return clean.join(F.broadcast(top), "origin_country", "left_semi").select(*GOLD_COLUMNS)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, one row per column (one pass)."""
    cols = df.columns
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count").select(
        "column_name", F.coalesce("null_count", F.lit(0)).cast("bigint").alias("null_count"))


def null_mask(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).isNull().alias(c) for c in df.columns])
