"""Patrol shift plan for the highest ranked cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.functions.numeric import half_even
from kerbscope.operators.totals import combine_days, daily_totals


def grid_hours(events: DataFrame, top: DataFrame) -> DataFrame:
    """Events and impact per (cell, hour) of the cells in ``top``.

    ``top`` is the output of a limit, so the broadcast side has at most that
    many rows and the events are reduced before any shuffle.
    """
    chosen = events.join(F.broadcast(top.select("grid_id")), "grid_id", "left_semi")
    hourly = combine_days(daily_totals(chosen, "grid_id", "hour"), "grid_id", "hour")
    return hourly.select(
        "grid_id", "hour", F.col("violation_count").alias("events"), F.col("impact_sum").alias("impact")
    )


def best_hours(hourly: DataFrame, hours: int = 3) -> DataFrame:
    """``"HH:00, HH:00, HH:00"`` per cell: impact, then events, then the earlier hour."""
    order = Window.partitionBy("grid_id").orderBy(
        F.desc("impact"), F.desc("events"), F.asc("hour")
    )
    chosen = hourly.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= hours)
    in_order = F.sort_array(F.collect_list(F.struct("place", "hour")))
    return chosen.groupBy("grid_id").agg(
        F.array_join(
            F.transform(in_order, lambda x: F.format_string("%02d:00", x["hour"])), ", "
        ).alias("best_enforcement_hours")
    )


def shift_plan(events: DataFrame, top: DataFrame, hours: int = 3) -> DataFrame:
    """``top``: ranked and classified cells, already limited."""
    plan = best_hours(grid_hours(events, top), hours)
    return top.join(plan, "grid_id").select(
        "priority_rank",
        "grid_id",
        "latitude",
        "longitude",
        "police_station",
        "junction_name",
        "risk_band",
        half_even(F.col("congestion_impact_score"), 2).alias("congestion_impact_score"),
        "best_enforcement_hours",
        "recommended_action",
    )
