"""Month x hour profile and its roll-up to hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.functions.numeric import half_even
from kerbscope.operators.totals import combine_days, daily_totals


def month_hour_totals(events: DataFrame) -> DataFrame:
    """Violations and exact impact per (month, hour)."""
    daily = daily_totals(events, "hour").withColumn("month", F.substring("date", 1, 7))
    return combine_days(daily, "month", "hour").select(
        "month", "hour", F.col("violation_count").alias("violations"), F.col("impact_sum").alias("impact")
    )


def month_hour_profile(events: DataFrame) -> DataFrame:
    return month_hour_totals(events).withColumn("impact", F.col("impact").cast("double"))


def hour_profile(month_hours: DataFrame) -> DataFrame:
    """Hours over all months, with the bar width relative to the busiest hour."""
    hours = month_hours.groupBy("hour").agg(
        F.sum("violations").alias("violations"),
        half_even(F.sum("impact").cast("double"), 2).alias("impact"),
    )
    # An hour column has at most 24 values, so this window sees at most 24 rows.
    highest = F.max("impact").over(Window.partitionBy())
    return hours.withColumn("bar_width", F.try_divide(100 * F.col("impact"), highest))
