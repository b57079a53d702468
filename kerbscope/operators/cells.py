"""Hotspot roll-up: one row per grid cell.

Three branches read the cleaned events, each only its own columns, and meet on
``grid_id`` where all of them are already hash partitioned:

* additive totals through (cell, day),
* the three modes through (cell, value) counts,
* exact distinct vehicles through distinct (cell, vehicle) pairs.

No branch sends a cell's raw events to one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.operators.totals import centroid, combine_days, daily_totals, share

MODES = {
    "police_station": "police_station",
    "junction_name": "junction_name",
    "top_vehicle_type": "vehicle_type",
}


def value_counts(events: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Row counts per (keys, one of the columns); the other columns are null.

    All columns are counted in a single pass as grouping sets.
    """
    sets = [[F.col(k) for k in keys] + [F.col(c)] for c in columns]
    counted = events.groupingSets(sets, *keys, *columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.coalesce(*[F.col(c) for c in columns]).isNotNull())


def most_frequent(column: str, n: str = "n") -> Column:
    """Aggregate over value counts: highest count, then the smallest value."""
    candidate = F.when(
        F.col(column).isNotNull(), F.struct(-F.col(n), F.col(column).alias("value"))
    )
    return F.min(candidate)["value"]


def cell_modes(events: DataFrame) -> DataFrame:
    counts = value_counts(events, ["grid_id"], list(MODES.values()))
    return counts.groupBy("grid_id").agg(
        *[most_frequent(source).alias(name) for name, source in MODES.items()]
    )


def cell_vehicles(events: DataFrame) -> DataFrame:
    pairs = events.filter("vehicle_number IS NOT NULL").select("grid_id", "vehicle_number")
    return pairs.distinct().groupBy("grid_id").agg(F.count(F.lit(1)).alias("unique_vehicles"))


def cell_totals(events: DataFrame) -> DataFrame:
    daily = daily_totals(events, "grid_id", centroid=True)
    return combine_days(daily, "grid_id", centroid=True)


def rates(cells: DataFrame) -> DataFrame:
    """Means and shares from the totals."""
    return cells.withColumns(
        {
            "impact_sum": F.col("impact_sum").cast("double"),
            "impact_avg": F.col("impact_sum").cast("double") / F.col("rows"),
            "peak_hour_share": share("peak_rows"),
            "junction_share": share("junction_rows"),
        }
    )


def with_centroid(cells: DataFrame) -> DataFrame:
    return cells.withColumns({"latitude": centroid("lat"), "longitude": centroid("lon")})


def hotspot_cells(events: DataFrame, vehicles: Callable[[DataFrame], DataFrame] = cell_vehicles) -> DataFrame:
    """The thirteen named aggregates per cell, plus ``rows`` (events in the cell).

    ``vehicles`` counts the distinct vehicles of each cell; ``cell_vehicles_approx`` does
    so by sketches.
    """
    joined = (
        cell_totals(events)
        .join(cell_modes(events), "grid_id", "left")
        .join(vehicles(events), "grid_id", "left")
    )
    return with_centroid(rates(joined)).select(
        "grid_id",
        "latitude",
        "longitude",
        "grid_lat",
        "grid_lon",
        "violation_count",
        F.coalesce("unique_vehicles", F.lit(0)).cast("bigint").alias("unique_vehicles"),
        "impact_sum",
        "impact_avg",
        "peak_hour_share",
        "junction_share",
        "active_days",
        *[F.coalesce(name, F.lit("")).alias(name) for name in MODES],
        "rows",
    )
