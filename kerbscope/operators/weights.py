"""Severity and footprint weights that are kept in tables instead of settings.

The tables are joined: Spark broadcasts a side whose measured size allows it and
shuffles both else, so a table of weights may have any number of rows.  A record's
severity depends on its violation text alone, hence each distinct text is rated
once and the records join the rated texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.text import with_items
from kerbscope.settings import CleanSettings, hundredths
from kerbscope.staging import stage


@dataclass(frozen=True)
class WeightTables:
    """Written tables with rows ``key``, ``hundredths``, one for each key."""

    severity: DataFrame
    footprint: DataFrame


def weight_table(table: DataFrame, key_col: str, weight_col: str) -> DataFrame:
    """Rows ``key``, ``hundredths`` int; written, so that its size is known.

    Rows without key or weight are left out, of several weights of a key the
    largest counts, and a weight with more than two decimals is an error.
    """
    cents = F.col(weight_col).cast("decimal(30,10)") * 100
    wrong = F.raise_error(F.concat(F.lit("weight has more than two decimals: "), F.col(weight_col).cast("string")))
    whole = F.when(cents == F.floor(cents), cents.cast("int")).otherwise(wrong)
    known = table.where(F.col(key_col).isNotNull() & F.col(weight_col).isNotNull())
    rows = known.select(F.col(key_col).alias("key"), whole.alias("hundredths"))
    return stage(rows.groupBy("key").agg(F.max("hundredths").alias("hundredths")), "weights")


def _or_other(weight: str) -> Column:
    return F.lit(hundredths(weight))


def text_severities(events: DataFrame, tables: WeightTables, settings: CleanSettings) -> DataFrame:
    """Rows ``violation_type``, ``_severity``: the largest weight among the items of each distinct text."""
    texts = events.select("violation_type").where("violation_type IS NOT NULL").distinct()
    items = with_items(texts, "violation_type", "items").select("violation_type", F.explode("items").alias("key"))
    weight = F.coalesce("hundredths", _or_other(settings.other_severity))
    return stage(items.join(tables.severity, "key", "left").groupBy("violation_type").agg(F.max(weight).alias("_severity")), "severities")


def join_weights(events: DataFrame, tables: WeightTables, settings: CleanSettings) -> DataFrame:
    """``events`` with ``_severity`` and ``_vehicle`` in hundredths, the other weight where a table has none."""
    rated = events.join(text_severities(events, tables, settings), "violation_type", "left")
    vehicle = F.upper(F.coalesce("vehicle_type", F.lit("OTHERS")))
    footprint = tables.footprint.select(F.col("key").alias("_key"), F.col("hundredths").alias("_vehicle"))
    return (
        rated.withColumn("_key", vehicle)
        .join(footprint, "_key", "left")
        .drop("_key")
        .withColumns({"_severity": F.coalesce("_severity", _or_other(settings.other_severity)), "_vehicle": F.coalesce("_vehicle", _or_other(settings.other_footprint))})
    )
