"""Distinct vehicles over growing histories, exactly and by mergeable sketches.

An exact count needs every (cell, vehicle) pair to meet once.  A sketch is a few
kilobytes for any number of vehicles and merges, so one pass makes a sketch for each
(cell, month), and the count of any span of months is a union of its sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.operators.windows import valid_windows

#: Sketches keep at most 2 ** LG_SIZE numbers.
LG_SIZE = 12
#: Relative error that is exceeded in about one of a thousand sketches of that size.
ERROR_BOUND = 0.05


def _seen(events: DataFrame) -> DataFrame:
    return events.where("vehicle_number IS NOT NULL AND month IS NOT NULL")


def cell_vehicles_approx(events: DataFrame, lg_size: int = LG_SIZE) -> DataFrame:
    """Rows ``grid_id``, ``unique_vehicles``: one shuffled sketch for each cell and map task."""
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("vehicle_number", F.lit(lg_size)))
    return events.where("vehicle_number IS NOT NULL").groupBy("grid_id").agg(sketch.alias("unique_vehicles"))


def monthly_sketches(events: DataFrame, lg_size: int = LG_SIZE) -> DataFrame:
    """Rows ``grid_id``, ``month``, ``sketch``."""
    return _seen(events).groupBy("grid_id", "month").agg(F.hll_sketch_agg("vehicle_number", F.lit(lg_size)).alias("sketch"))


def _along_windows(monthly: DataFrame, index: DataFrame, running) -> DataFrame:
    """One row for each window and cell with the running value of the months before the window."""
    over = Window.partitionBy("grid_id").orderBy("month_idx")
    rows = monthly.join(F.broadcast(index), "month")  # one row per calendar month
    through = rows.select(
        "grid_id",
        running.over(over.rowsBetween(Window.unboundedPreceding, 0)).alias("value"),
        valid_windows(over).alias("windows"),
    )
    return through.select("grid_id", "value", F.explode("windows").alias("window_id"))


def history_vehicles_approx(sketches: DataFrame, index: DataFrame) -> DataFrame:
    """Rows ``window_id``, ``grid_id``, ``approx_vehicles``: vehicles of all months before each window.

    No event is read again for a later window; cells without vehicles have no row.
    """
    found = _along_windows(sketches, index, F.hll_union_agg("sketch"))
    return found.select("window_id", "grid_id", F.hll_sketch_estimate("value").alias("approx_vehicles"))


def history_vehicles(events: DataFrame, index: DataFrame) -> DataFrame:
    """Rows ``window_id``, ``grid_id``, ``unique_vehicles``, exact: each pair counts in its first month."""
    firsts = _seen(events).groupBy("grid_id", "vehicle_number").agg(F.min("month").alias("month"))
    new = firsts.groupBy("grid_id", "month").agg(F.count(F.lit(1)).alias("n"))
    return _along_windows(new, index, F.sum("n")).select("window_id", "grid_id", F.col("value").alias("unique_vehicles"))
