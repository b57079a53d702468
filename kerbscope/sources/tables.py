"""Table and summary sinks, and their readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blanks around a text are part of it, in both directions.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header; a field with a comma is quoted.  An older table is replaced."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, null fields kept, UTF-8.  An older table is replaced."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_events(events: DataFrame, path: str, months_only: bool = False) -> None:
    """Cleaned events as parquet by month.

    An older table is replaced; with ``months_only`` just its months that occur in
    ``events``, and the others stay as they are.  Rows are rebalanced by (month, day),
    so that a month is written by as many tasks as its days need and AQE splits a day
    that is too large for one.
    """
    writer = events.hint("rebalance", F.col("month"), F.col("date")).write.mode("overwrite").partitionBy("month")
    writer.option("partitionOverwriteMode", "dynamic" if months_only else "static").parquet(path)


def read_events(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The table that ``write_events`` wrote, from month ``first`` to ``last``; other months' files are not opened.

    The month is a text whatever the folders' names look like.
    """
    fields = [f for f in spark.read.parquet(path).schema if f.name != "month"]
    events = spark.read.schema(T.StructType([*fields, T.StructField("month", T.StringType())])).parquet(path)
    if first is not None:
        events = events.where(F.col("month") >= first)
    return events if last is None else events.where(F.col("month") <= last)


def read_or_empty(
    spark: SparkSession, schema: str, read: Callable[[DataFrameReader], DataFrame]
) -> DataFrame:
    """Declared schema; a table that was never written reads as empty."""
    try:
        return read(spark.read.schema(schema))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_csv_table(spark: SparkSession, path: str, schema, optional: bool = False) -> DataFrame:
    """A table that ``write_csv`` wrote; only an ``optional`` one may be absent, and reads as empty."""
    options = {**_CSV, "multiLine": True}
    if optional:
        return read_or_empty(spark, schema, lambda reader: reader.options(**options).csv(path))
    return spark.read.schema(schema).options(**options).csv(path)
