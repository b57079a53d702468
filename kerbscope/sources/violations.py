"""Readers of raw violation records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbscope.functions.timeformats import infer_formats
from kerbscope.staging import stage

RAW_COLUMNS = (
    "id",
    "created_datetime",
    "latitude",
    "longitude",
    "violation_type",
    "vehicle_type",
    "vehicle_number",
    "police_station",
    "junction_name",
)
_COORDINATES = ("latitude", "longitude")
_TORN = "_torn_record"
_FIELDS = "_header_fields"

# ---------------------------------------------------------------- fixed values
# Cell texts that a CSV scan reads as missing.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# ------------------------------------------------------------ end fixed values


def require_utc(spark: SparkSession) -> None:
    """Texts without a zone are UTC, so the session zone must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (is {zone!r})")


def normalise(raw: DataFrame) -> DataFrame:
    """The nine raw columns with one type each, whatever the format.

    Ids are texts or, where they are whole numbers of any width, long.  Unreadable
    coordinates become null; columns that are doubles already stay as they are, so
    that filters on them reach the scan.
    """
    kinds = dict(raw.dtypes)
    typed = {c: F.col(c).try_cast("double") for c in _COORDINATES if kinds[c] != "double"}
    if kinds["id"] not in ("bigint", "string"):
        typed["id"] = F.col("id").cast("long" if kinds["id"] in ("tinyint", "smallint", "int") else "string")
    return raw.select(*RAW_COLUMNS).withColumns(typed)


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field may hold a line break: some line has an odd number of quotes.

    A scan of the lines that is split like any other and parses nothing.
    """
    value = F.col("value")
    odd = (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1
    return not spark.read.text(path).where(odd).isEmpty()


def _csv_cells(spark: SparkSession, path: str, columns: tuple[str, ...], multi_line: bool | None, damaged: bool) -> DataFrame:
    """The wanted columns as texts with missing marks read; ``_TORN`` with them if ``damaged``."""
    require_utc(spark)
    if multi_line is None:
        # A packed file cannot be split anyway.
        multi_line = path.rstrip("/").endswith(".gz") or has_line_breaks(spark, path)
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options, inferSchema=False).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if damaged:
        schema = schema.add(_TORN, T.StringType())
    rows = spark.read.schema(schema).options(**options, enforceSchema=False, columnNameOfCorruptRecord=_TORN).csv(path)
    cells = [F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)).alias(c) for c in columns]
    return rows.select(*cells, *([_TORN, F.lit(len(header)).alias(_FIELDS)] if damaged else []))


def read_csv(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...] = RAW_COLUMNS,
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV with a header, commas and doubled quotes; columns are found by header name, ids are texts.

    A missing path raises Spark's PATH_NOT_FOUND.  The header alone is read for
    the column names; nothing is inferred from the data.  Line breaks inside quotes
    belong to the field, and a file that has them cannot be split; without any, as
    ``has_line_breaks`` finds out unless ``multi_line`` tells, files are split.  A record
    with too few or too many fields is an error when all columns are read.
    """
    whole = set(RAW_COLUMNS) <= set(columns)
    cells = _csv_cells(spark, path, columns, multi_line, whole)
    if not whole:
        return cells
    torn = F.raise_error(F.concat(F.lit("torn or malformed record: "), F.substring(_TORN, 1, 200)))
    return normalise(cells.withColumn("id", F.when(F.col(_TORN).isNull(), F.col("id")).otherwise(torn)))


# ------------------------------------------------------------------ landing


@dataclass(frozen=True)
class Landed:
    """An input read once: its sound records, the others, and what the pass learned."""

    rows: DataFrame  # the nine columns, typed
    rejects: DataFrame  # cause, record
    seen: int  # records read, rejected ones included
    time_formats: tuple[str, ...]


def _fields(record: Column) -> Column:
    """Number of fields of a raw record: commas outside quotes, and one."""
    plain = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def reject_cause(short: bool, cells: bool) -> Column:
    """Why a record cannot be used; null for a sound one.

    More fields than the header has; with ``short`` also fewer; with ``cells`` also a
    coordinate that is there and is no number.
    """
    fields = _fields(F.col(_TORN))
    causes = [F.when(fields > F.col(_FIELDS), F.lit("too many fields"))]
    if short:
        causes.append(F.when(fields < F.col(_FIELDS), F.lit("too few fields")))
    for name in _COORDINATES if cells else ():
        wrong = F.col(name).isNotNull() & F.col(name).try_cast("double").isNull()
        causes.append(F.when(wrong, F.lit(f"{name} is no number")))
    return F.coalesce(*causes)


def land_csv(spark: SparkSession, path: str, multi_line: bool | None = None, reject_cells: bool = True) -> Landed:
    """Reads a CSV once into a table of typed records beside a table of those that cannot be used.

    Later steps scan columns instead of parsing texts again.  Ids become numbers if
    all of them are whole numbers, which the same pass finds out.  A record without
    its last fields has missing values there, but where ``multi_line`` is False files
    are split unseen, it may be half of one, and it is rejected.  An unreadable
    coordinate rejects its record, or is a missing value without ``reject_cells``.
    """
    cells = _csv_cells(spark, path, RAW_COLUMNS, multi_line, True)
    formats = infer_formats(cells, "created_datetime")
    cause = reject_cause(multi_line is False, reject_cells)
    marked = cells.withColumn("cause", cause)
    rejected = F.col("cause").isNotNull()
    pass_over = Observation("landing")
    marked = marked.observe(
        pass_over,
        F.count(F.lit(1)).alias("seen"),
        F.count_if(~rejected & F.col("id").isNotNull() & F.col("id").try_cast("long").isNull()).alias("text_ids"),
    )
    record = F.when(rejected, F.coalesce(_TORN, F.to_json(F.struct(*RAW_COLUMNS))))
    coordinates = [F.col(c).try_cast("double").alias(c) for c in _COORDINATES]
    kept = [c for c in RAW_COLUMNS if c not in _COORDINATES]
    landed = stage(marked.select(*kept, *coordinates, "cause", record.alias("record"), rejected.alias("rejected")), "landed", ("rejected",))
    rows = landed.where("not rejected").select(*RAW_COLUMNS)
    if not pass_over.get["text_ids"]:
        rows = rows.withColumn("id", F.col("id").cast("long"))
    return Landed(rows, landed.where("rejected").select("cause", "record"), pass_over.get["seen"], formats)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rows ``cause``, ``records``."""
    return rejects.groupBy("cause").agg(F.count(F.lit(1)).alias("records"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    require_utc(spark)
    return normalise(spark.read.parquet(path))


def is_csv(path: str) -> bool:
    return path.rstrip("/").endswith((".csv", ".csv.gz"))


def read_violations(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """CSV or parquet by the path's ending; of a CSV the records that can be used, unreadable coordinates missing."""
    return land_csv(spark, path, multi_line, reject_cells=False).rows if is_csv(path) else read_parquet(spark, path)
