"""Station roll-up and station priority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.numeric import sort_value
from kerbscope.operators.scaling import minmax
from kerbscope.operators.totals import exact_impact, share

PRIORITY_BANDS = ("Critical", "High")


def station_rollup(events: DataFrame) -> DataFrame:
    """One row per station of the event; events without a station are left out.

    Aggregates (station, cell) first, which spreads a dominant station over its
    cells and turns the distinct cell count into a plain count.
    """
    per_cell = (
        events.filter("police_station IS NOT NULL")
        .groupBy("police_station", "grid_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("id").alias("ids"),
            exact_impact(F.col("impact_units")).alias("impact"),
            F.sum("is_peak_hour").alias("peak_rows"),
            F.sum("near_junction").alias("junction_rows"),
        )
    )
    totals = per_cell.groupBy("police_station").agg(
        F.sum("ids").alias("violation_count"),
        F.sum("impact").cast("double").alias("impact_sum"),
        F.sum("rows").alias("rows"),
        F.sum("peak_rows").alias("peak_rows"),
        F.sum("junction_rows").alias("junction_rows"),
        F.count(F.lit(1)).alias("unique_hotspots"),
    )
    return totals.select(
        "police_station",
        "violation_count",
        "impact_sum",
        share("peak_rows").alias("peak_hour_share"),
        share("junction_rows").alias("junction_share"),
        "unique_hotspots",
    )


def high_priority_counts(hotspots: DataFrame) -> DataFrame:
    """Critical and High cells per modal station of the cell."""
    return (
        hotspots.filter(F.col("risk_band").isin(*PRIORITY_BANDS))
        .groupBy("police_station")
        .agg(F.count(F.lit(1)).alias("high_priority_hotspots"))
    )


def with_high_priority(stations: DataFrame, hotspots: DataFrame) -> DataFrame:
    return stations.join(high_priority_counts(hotspots), "police_station", "left").fillna(
        0, subset=["high_priority_hotspots"]
    )


def score_stations(stations: DataFrame) -> DataFrame:
    """Add ``station_priority_score``; the input is read twice, so stage it first."""
    scaled = minmax(
        stations,
        {
            "_impact": F.log1p("impact_sum"),
            "_count": F.log1p("violation_count"),
            "_high": F.col("high_priority_hotspots").cast("double"),
        },
        factor=1.0,
    )
    score = 100 * (
        0.45 * F.col("_impact")
        + 0.25 * F.col("_count")
        + 0.20 * F.col("_high")
        + 0.10 * F.col("peak_hour_share")
    )
    return scaled.withColumn("station_priority_score", score).drop("_impact", "_count", "_high")


def order_stations(stations: DataFrame) -> DataFrame:
    return stations.orderBy(sort_value(F.col("station_priority_score")).desc(), "police_station")
