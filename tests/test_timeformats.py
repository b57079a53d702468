"""Formats of time columns: what a first value stands for, and strict reading by it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbscope.functions.calendar import parse_instant
from kerbscope.functions.timeformats import ISO, MIXED, formats_of, guess_format, infer_formats
from kerbscope.operators.cleaning import clean_events
from kerbscope.settings import CleanSettings

ZONE = "[XXX][XX][X]"


@pytest.mark.parametrize(
    "text, pattern",
    [
        ("2023-11-20 00:28:46+00", ISO),
        ("2023-11-20T00:28:46.123Z", ISO),
        (" 2023-11-20", ISO),
        ("20/11/2023 00:28", "d/M/yyyy H:m"),
        ("11/20/2023 00:28", "M/d/yyyy H:m"),
        ("01/02/2023", "M/d/yyyy"),
        ("13.02.2023 7:05:09", "d.M.yyyy H:m:s"),
        ("2023/11/20 00:28:46.5", "yyyy/M/d H:m:s.SSSSSSSSS"),
        ("20-11-2023T10:00:00+0530", f"d-M-yyyy'T'H:m:s{ZONE}"),
        ("3/4/2023 7:05 PM", "M/d/yyyy h:m a"),
        ("3/4/2023 7:05:01pm Z", f"M/d/yyyy h:m:sa {ZONE}"),
        ("20 Nov 2023 00:28", "d MMM yyyy H:m"),
        ("20-November-2023", "d-MMMM-yyyy"),
        ("May 3, 2023 10:00", "MMM d, yyyy H:m"),
        ("January 3 2023", "MMMM d yyyy"),
        ("not-a-date", None),
        ("", None),
        ("13/13/2023", None),
        ("20/11/23", None),
        ("20/11-2023", None),
        ("2023/13/01", None),
        ("20/11/2023 later", None),
        ("20 Foo 2023", None),
        ("12:30", None),
    ],
)
def test_guess(text, pattern):
    assert guess_format(text) == pattern


def read(spark, texts, formats):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    found = rows.select("i", F.expr(f"date_format({parse_instant('t', formats)}, 'yyyy-MM-dd HH:mm:ss.SSS')").alias("at")).collect()
    return [at for _, at in sorted(found)]


def test_a_column_is_read_by_one_format_alone(spark):
    texts = ["20/11/2023 00:28", "1/2/2023 5:07", "02/20/2023 00:28", "2023-11-20 00:28", "31/02/2023 00:00", "20/11/2023 00:28:00", "x", None, "", "20/11/2023"]
    assert read(spark, texts, formats_of(texts[0])) == ["2023-11-20 00:28:00.000", "2023-02-01 05:07:00.000", *[None] * 8]
    halves = ["11/20/2023 12:05 AM", "1/2/2023 1:00 pm", "13/1/2023 1:00 PM", "1/1/2023 13:00 PM", "1/1/2023 01:00"]
    assert read(spark, halves, formats_of(halves[0])) == ["2023-11-20 00:05:00.000", "2023-01-02 13:00:00.000", None, None, None]


def test_zones_fractions_and_month_names(spark):
    zoned = ["20/11/2023 10:00:00+05:30", "20/11/2023 10:00:00+0530", "20/11/2023 10:00:00Z", "20/11/2023 10:00:00-01"]
    wanted = ["2023-11-20 04:30:00.000"] * 2 + ["2023-11-20 10:00:00.000", "2023-11-20 11:00:00.000"]
    assert read(spark, zoned, formats_of(zoned[0])) == wanted
    assert read(spark, ["2023/11/20 00:28:46.5"], formats_of("2023/11/20 00:28:46.5")) == ["2023-11-20 00:28:46.500"]
    assert read(spark, ["20 Nov 2023 01:02", "3 dec 2023 4:05"], formats_of("20 Nov 2023 01:02")) == ["2023-11-20 01:02:00.000", "2023-12-03 04:05:00.000"]


def test_without_a_usable_first_value_each_text_is_read_by_itself(spark):
    assert formats_of(None) == (ISO,) and formats_of("junk") == (ISO, *MIXED)
    texts = ["junk", "2023-11-20 01:00:00", "03/04/2023 10:00", "20/04/2023", "20.04.2023 7:05:01", "Nov 3, 2023 4:05 PM", "3 November 2023", None]
    found = read(spark, texts, formats_of(texts[0]))
    assert [at and at[:19] for at in found] == [
        None, "2023-11-20 01:00:00", "2023-03-04 10:00:00", "2023-04-20 00:00:00", "2023-04-20 07:05:01", "2023-11-03 16:05:00", "2023-11-03 00:00:00", None,
    ]


def test_first_value_by_an_order_or_as_read(spark):
    rows = spark.createDataFrame([(3, "11/20/2023"), (1, None), (2, "20/11/2023")], "id int, t string").repartition(3)
    assert infer_formats(rows, "t", by=F.col("id")) == ("d/M/yyyy",)
    assert infer_formats(rows.coalesce(1).where("id > 2"), "t") == ("M/d/yyyy",)
    assert infer_formats(rows.where("t is null"), "t") == (ISO,)
    assert infer_formats(rows.where("t is null"), "t", by=F.col("id")) == (ISO,)


def test_cleaning_follows_the_format(spark):
    columns = "id long, created_datetime string, latitude double, longitude double, violation_type string, vehicle_type string, vehicle_number string, police_station string, junction_name string"
    rows = [(i, t, 12.5, 77.5, "NO PARKING", None, None, None, None) for i, t in enumerate(["20/11/2023 20:28", "01/12/2023 00:00", "2023-11-20 00:00:00"])]
    table = spark.createDataFrame(rows, columns)
    settings = CleanSettings(time_formats=infer_formats(table, "created_datetime", by=F.col("id")))
    found = {r.id: r for r in clean_events(table, settings).collect()}
    assert {i: (r.date, r.hour) for i, r in found.items()} == {0: ("2023-11-21", 1), 1: ("2023-12-01", 5)}
    assert found[0].created_at_ist == dt.datetime(2023, 11, 21, 1, 58)
    assert {r.id for r in clean_events(table).collect()} == {2}  # without a format only ISO is read
