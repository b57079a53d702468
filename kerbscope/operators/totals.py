"""Exact additive totals in two steps.

Step one adds whole numbers per (keys, day) with map-side combining, so even a
key with a third of all events leaves each map task as a handful of rows.  The
day in the key also bounds the 64-bit sums: a day's events in one group, not
the whole history.  Step two adds the day rows as decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.operators.cleaning import UNIT

DEGREE_UNITS = 1e12  # offsets from the cell centre are added in 1e-12 degree steps


def _offset(coordinate: str, centre: str) -> Column:
    return F.rint((F.col(coordinate) - F.col(centre)) * F.lit(DEGREE_UNITS)).cast("bigint")


def daily_totals(events: DataFrame, *keys: str, centroid: bool = False) -> DataFrame:
    aggregates = [
        F.count(F.lit(1)).alias("rows"),
        F.count("id").alias("ids"),
        F.sum("impact_units").alias("impact_units"),
        F.sum("is_peak_hour").alias("peak_rows"),
        F.sum("near_junction").alias("junction_rows"),
    ]
    if centroid:
        aggregates += [
            F.sum(_offset("latitude", "grid_lat")).alias("lat_units"),
            F.sum(_offset("longitude", "grid_lon")).alias("lon_units"),
            F.min("grid_lat").alias("grid_lat"),
            F.min("grid_lon").alias("grid_lon"),
        ]
    return events.groupBy(*keys, "date").agg(*aggregates)


def exact_impact(units: Column) -> Column:
    return F.sum(units.cast("decimal(19,0)")) * F.expr(UNIT)


def combine_days(daily: DataFrame, *keys: str, centroid: bool = False) -> DataFrame:
    """Day rows -> one row per key; ``active_days`` counts the day rows."""
    aggregates = [
        F.sum("rows").alias("rows"),
        F.sum("ids").alias("violation_count"),
        exact_impact(F.col("impact_units")).alias("impact_sum"),
        F.sum("peak_rows").alias("peak_rows"),
        F.sum("junction_rows").alias("junction_rows"),
        F.count(F.lit(1)).alias("active_days"),
    ]
    if centroid:
        aggregates += [
            F.sum(F.col("lat_units").cast("decimal(19,0)")).alias("lat_units"),
            F.sum(F.col("lon_units").cast("decimal(19,0)")).alias("lon_units"),
            F.min("grid_lat").alias("grid_lat"),
            F.min("grid_lon").alias("grid_lon"),
        ]
    return daily.groupBy(*keys).agg(*aggregates)


def centroid(axis: str) -> Column:
    """Mean coordinate from the exact offset total."""
    mean_offset = F.col(f"{axis}_units").cast("double") / F.col("rows")
    return F.col(f"grid_{axis}") + mean_offset / F.lit(DEGREE_UNITS)


def share(part: str) -> Column:
    return F.col(part) / F.col("rows")
