"""Positions and running totals over a whole ordered table.

A window without partition keys sends every row to one task.  Here the rows are
range partitioned by the sort key into blocks, each block is numbered in
parallel, and every block is shifted by the totals of the blocks before it.  The
block number is written with the rows, so a recomputed task can never see
another split.  Small tables go the same way; Spark merges their blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.functions.numeric import sort_value
from kerbscope.staging import stage


def running_total(
    table: DataFrame,
    amount: Column,
    order: Sequence[Column],
    name: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: the inclusive running sum of ``amount`` in ``order`` within ``by``.

    ``order`` must be total within ``by``.  The number of blocks is the session's
    ``spark.sql.shuffle.partitions``.
    """
    split = stage(
        table.repartitionByRange(*[F.col(c) for c in by], *order).withColumns(
            {"_block": F.spark_partition_id(), "_amount": amount}
        ),
        "blocks",
    )
    # One row per (population, block): as many rows as blocks plus populations.
    totals = split.groupBy(*by, "_block").agg(F.sum("_amount").alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.withColumn("_shift", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    inside = (
        Window.partitionBy(*by, "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        split.withColumn("_inside", F.sum("_amount").over(inside))
        .join(shift.drop("_total"), [*by, "_block"])
        .withColumn(name, F.col("_shift") + F.col("_inside"))
        .drop("_block", "_amount", "_inside", "_shift")
    )


def by_score(score: str, key: str = "grid_id") -> list[Column]:
    """Score descending, then key: the total order every ranking uses."""
    return [sort_value(F.col(score)).desc(), F.col(key).asc()]


def with_rank(table: DataFrame, score: str, name: str, key: str = "grid_id") -> DataFrame:
    """Rank 1..n of the whole table as the first column."""
    ranked = running_total(table, F.lit(1), by_score(score, key), name)
    return ranked.select(F.col(name).cast("int").alias(name), *table.columns)


def top_ranked(table: DataFrame, score: str, name: str, n: int, key: str = "grid_id") -> DataFrame:
    """The first ``n`` rows with their rank; only ``n`` rows are ever numbered."""
    head = table.orderBy(*by_score(score, key)).limit(n)
    rank = F.row_number().over(Window.orderBy(*by_score(score, key)))
    return head.select(rank.alias(name), *table.columns)


def top_per_group(
    table: DataFrame, by: Sequence[str], score: str, n: int, name: str = "position"
) -> DataFrame:
    """First ``n`` rows per group; Spark trims every map task to ``n`` rows per group first."""
    window = Window.partitionBy(*by).orderBy(*by_score(score))
    # Per group the last task sees n rows from each map task, whatever the group's size.
    return table.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def average_rank(table: DataFrame, value: str, name: str, by: Sequence[str]) -> DataFrame:
    """Add the ascending rank of ``value`` (not null) within ``by``; equal values share the mean rank.

    Equal values are counted before any shuffle, the running total of the counts
    gives each value's last position, and the rank comes back by an equality
    join, which Spark sizes (broadcast) or splits (skewed value) at run time.
    """
    counts = table.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, F.col("_n"), [F.col(value)], "_last", by)
    rank = F.col("_last") - (F.col("_n") - 1) / F.lit(2.0)
    return table.join(placed.select(*by, value, rank.alias(name)), [*by, value])
