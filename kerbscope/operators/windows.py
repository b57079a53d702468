"""Walk-forward windows: every month after the first is tested on all months before it.

Facts are aggregated once per (cell, month).  A cell's history for window w is
the running total of its months before w, so a window costs one row per known
cell; no month is aggregated again for each later window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.operators.cells import most_frequent, rates, value_counts, with_centroid
from kerbscope.operators.totals import combine_days, daily_totals
from kerbscope.staging import stage

ADDITIVE = (
    "rows",
    "violation_count",
    "impact_sum",
    "peak_rows",
    "junction_rows",
    "active_days",
    "lat_units",
    "lon_units",
)


def month_index(table: DataFrame) -> DataFrame:
    """Distinct months in order: month, month_idx from 1, n_months.

    One row per calendar month, which bounds the ordered window and every
    broadcast of this table.
    """
    months = table.filter("month IS NOT NULL").select("month").distinct()
    return months.select(
        "month",
        F.row_number().over(Window.orderBy("month")).alias("month_idx"),
        F.count(F.lit(1)).over(Window.partitionBy()).cast("int").alias("n_months"),
    )


def _window_rows(index: DataFrame, final: bool) -> DataFrame:
    """One row per window with the ordered month list; no rows for fewer than two months
    unless the window after the last month is wanted."""
    listed = index.agg(F.sort_array(F.collect_set("month")).alias("months"))
    last = F.size("months") + (1 if final else 0)
    return listed.filter(last >= 2).select(
        "months", F.explode(F.sequence(F.lit(2), last)).alias("window_id")
    )


def walk_forward_windows(index: DataFrame, final: bool = False) -> DataFrame:
    """(window_id, role, month) with roles hist, last, prev and test."""
    rows = _window_rows(index, final)
    w, months = F.col("window_id"), F.col("months")

    def tagged(role: str, part: Column) -> Column:
        return F.transform(part, lambda m: F.struct(F.lit(role).alias("role"), m.alias("month")))

    hist = F.slice(months, F.lit(1), w - 1)
    last = F.slice(months, w - 1, F.lit(1))
    prev = F.when(w > 2, F.slice(months, F.greatest(w - 2, F.lit(1)), F.lit(1))).otherwise(
        F.array().cast("array<string>")
    )
    test = F.slice(months, w, F.lit(1))
    roles = F.concat(tagged("hist", hist), tagged("last", last), tagged("prev", prev), tagged("test", test))
    return rows.select("window_id", F.explode(roles).alias("r")).select("window_id", "r.role", "r.month")


def window_labels(index: DataFrame) -> DataFrame:
    """(window_id, train_months, test_month) of the tested windows."""
    rows = _window_rows(index, final=False)
    return rows.select(
        "window_id",
        F.array_join(F.slice("months", F.lit(1), F.col("window_id") - 1), ",").alias("train_months"),
        F.get("months", F.col("window_id") - 1).alias("test_month"),
    )


@dataclass(frozen=True)
class MonthlyFacts:
    """Staged (cell, month) totals and the month index over them."""

    cells: DataFrame
    index: DataFrame


def monthly_facts(events: DataFrame) -> MonthlyFacts:
    daily = daily_totals(events, "grid_id", centroid=True).withColumn(
        "month", F.substring("date", 1, 7)
    )
    cells = stage(combine_days(daily, "grid_id", "month", centroid=True), "monthly-cells")
    index = stage(month_index(cells), "months")
    return MonthlyFacts(cells.join(F.broadcast(index), "month"), index)


def month_population(facts: MonthlyFacts) -> DataFrame:
    """Cell tables of the single months, keyed by month_idx."""
    return rates(facts.cells)


def valid_windows(over: Window) -> Column:
    """Windows for which a running total through this month is the latest one."""
    following = F.lead("month_idx").over(over)
    return F.sequence(F.col("month_idx") + 1, F.coalesce(following, F.col("n_months") + 1))


def history_population(facts: MonthlyFacts, final: bool = False) -> DataFrame:
    """Cell tables of all months before each window, keyed by window_id.

    ``final`` keeps the window after the last month, whose history is everything.
    """
    over = Window.partitionBy("grid_id").orderBy("month_idx")
    through = over.rowsBetween(Window.unboundedPreceding, 0)
    totals = facts.cells.select(
        "grid_id",
        "grid_lat",
        "grid_lon",
        "n_months",
        *[F.sum(c).over(through).alias(c) for c in ADDITIVE],
        valid_windows(over).alias("windows"),
    )
    rows = totals.withColumn("window_id", F.explode("windows")).drop("windows")
    if not final:
        rows = rows.filter(F.col("window_id") <= F.col("n_months"))
    return with_centroid(rates(rows))


def history_modes(events: DataFrame, index: DataFrame) -> DataFrame:
    """Most frequent station and junction per (window_id, grid_id), final window included."""
    columns = ["police_station", "junction_name"]
    monthly = value_counts(events, ["grid_id", "month"], columns).join(F.broadcast(index), "month")
    over = Window.partitionBy("grid_id", *columns).orderBy("month_idx")
    running = monthly.select(
        "grid_id",
        *columns,
        F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
        valid_windows(over).alias("windows"),
    )
    rows = running.withColumn("window_id", F.explode("windows"))
    return rows.groupBy("window_id", "grid_id").agg(
        *[most_frequent(c).alias(c) for c in columns]
    )
