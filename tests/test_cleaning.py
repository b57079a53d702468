"""Edge cases of the cleaning stage on small literal tables."""

import pytest
from pyspark.sql import functions as F

from kerbscope.functions.text import strip, with_items
from kerbscope.operators import cleaning
from kerbscope.settings import CleanSettings, hundredths

SETTINGS = CleanSettings()

PARSE_CASES = [
    (None, []),
    ("", []),
    (" \t\n", []),
    ('["NO PARKING","WRONG PARKING"]', ["NO PARKING", "WRONG PARKING"]),
    ('["NO PARKING", "WRONG PARKING"]', ["NO PARKING", "WRONG PARKING"]),
    ("['double parking' , 'x']", ["DOUBLE PARKING", "X"]),
    ('  [" parking in a main road ", "", "  "]  ', ["PARKING IN A MAIN ROAD"]),
    ('[" wide "]', ["WIDE"]),
    ("[]", []),
    ('["A",]', ["A"]),
    ('["it\'s", \'B\']', ["IT'S", "B"]),
    (r"['it\'s']", ["IT'S"]),
    (r'["say \"x\""]', ['SAY "X"']),
    ('["A, B"]', ["A, B"]),
    ("[1, 'two']", ["1", "TWO"]),
    ("NO PARKING", ["NO PARKING"]),
    ("  no parking ", ["no parking"]),
    ('["A"] junk', ['["A"] junk']),
    ('["A"] junk ["b"]', ['["A"] junk ["b"]']),
    ('["a", b]', ['["a", b]']),
    ('["A"', ['["A"']),
    ('["A" "b"', ['["A" "b"']),
    ("[S]", ["[S]"]),
    ('"no parking"', ["NO PARKING"]),
    ("'no parking'", ["NO PARKING"]),
    ("('a', 'b')", ["('A', 'B')"]),
    ("('a',)", ["('A',)"]),
    ("('a')", ["A"]),
    ("42", ["42"]),
]


def test_parse_items(spark):
    rows = [(i, text) for i, (text, _) in enumerate(PARSE_CASES)]
    df = spark.createDataFrame(rows, "i int, t string")
    got = {r.i: r.items for r in with_items(df, "t", "items").collect()}
    assert got == {i: expected for i, (_, expected) in enumerate(PARSE_CASES)}


def test_parse_survives_long_lists_and_texts(spark):
    names = [f"PARKING {i}" for i in range(20000)]
    long_list = "[" + ",".join(f'"{n}"' for n in names) + "]"
    escaped = '["' + r"\"" * 20000 + '"]'
    df = spark.createDataFrame([(1, long_list), (2, escaped)], "i int, t string")
    got = {r.i: r.items for r in with_items(df, "t", "items").collect()}
    assert got[1] == names
    assert got[2] == ['"' * 20000]


def test_strip(spark):
    texts = [" a b ", "\t x ", "", None, "\x1f\x1c", "ok"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.s for r in df.select(F.expr(strip("t")).alias("s")).collect()]
    assert got == [None if t is None else t.strip() for t in texts]


def test_local_time(spark):
    cases = {
        "2023-11-20 00:28:46+00": "2023-11-20 05:58:46",
        "2023-11-30 20:00:00+00": "2023-12-01 01:30:00",
        "2023-11-20 00:28:46.250+00": "2023-11-20 05:58:46",
        "2023-11-20T00:28:46Z": "2023-11-20 05:58:46",
        "2023-11-20 05:28:46+05:00": "2023-11-20 05:58:46",
        "2023-11-20 00:28:46": "2023-11-20 05:58:46",
        "not-a-date": None,
        "12:30:00": None,
        "": None,
    }
    df = spark.createDataFrame(
        [(k, 1.0, 1.0) for k in [*cases, None]],
        "created_datetime string, latitude double, longitude double",
    )
    kept = cleaning.keep_complete(df, SETTINGS).select(
        "created_datetime", F.date_format("created_at_ist", "yyyy-MM-dd HH:mm:ss").alias("t")
    )
    got = {r.created_datetime: r.t for r in kept.collect()}
    assert got == {k: v for k, v in cases.items() if v}


def test_incomplete_rows_are_dropped(spark):
    rows = [(1, 1.0, 1.0), (2, None, 1.0), (3, 1.0, None), (4, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double").withColumn(
        "created_datetime", F.lit("2024-01-01 00:00:00")
    )
    assert [r.id for r in cleaning.keep_complete(df, SETTINGS).collect()] == [1]


def test_calendar(spark):
    stamps = [f"2024-01-05 {h:02d}:30:00" for h in (7, 8, 10, 11, 16, 17, 20, 21)]
    days = [f"2024-01-{d:02d} 12:00:00" for d in (5, 6, 7, 8)]
    df = spark.createDataFrame([(s,) for s in stamps + days], "s string").withColumn(
        "created_at_ist", F.col("s").cast("timestamp")
    )
    rows = {r.s: r for r in cleaning.add_calendar(df, SETTINGS).collect()}
    assert [rows[s].is_peak_hour for s in stamps] == [0, 1, 1, 0, 0, 1, 1, 0]
    assert [rows[d].is_weekend for d in days] == [0, 1, 1, 0]
    assert [rows[d].weekday for d in days] == ["Friday", "Saturday", "Sunday", "Monday"]
    first = rows[stamps[0]]
    assert (first.date, first.month, first.hour) == ("2024-01-05", "2024-01", 7)


@pytest.mark.parametrize(
    "name, flag",
    [
        (None, 0),
        ("", 0),
        ("  ", 0),
        ("\t", 0),
        ("NO JUNCTION", 0),
        ("no junction", 0),
        (" No Junction ", 1),
        ("Main Street", 1),
    ],
)
def test_junction_flag(spark, name, flag):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(F.expr(cleaning.junction_flag("n")).alias("f")).first().f == flag


def weigh(spark, rows):
    df = spark.createDataFrame(
        rows, "violation_items array<string>, vehicle_type string, junction_name string, is_peak_hour int"
    )
    return cleaning.add_weights(df, SETTINGS).collect()


def test_weights_and_exact_impact(spark):
    rows = weigh(
        spark,
        [
            (["XX PARKING"], "CAR", None, 0),
            (["NO PARKING", "DOUBLE PARKING", "XX"], "scooter", "J1", 1),
            (["PARKING ON FOOTPATH"], None, "J1", 0),
            (["NO PARKING", "NO PARKING"], " CAR", None, 1),
        ],
    )
    assert [str(r.violation_severity) for r in rows] == ["0.75", "1.55", "1.10", "1.00"]
    assert [str(r.vehicle_pcu) for r in rows] == ["1.00", "0.40", "1.00", "1.00"]
    assert [str(r.incident_impact) for r in rows] == [
        "0.75000000",
        "0.93000000",
        "1.37500000",
        "1.20000000",
    ]
    assert [r.impact_units for r in rows] == [75000000, 93000000, 137500000, 120000000]


def test_other_severity_counts_even_when_listed_weights_are_lower(spark):
    low = CleanSettings(severity={"NO PARKING": "0.10"})
    df = spark.createDataFrame([(["NO PARKING"],), (["NO PARKING", "ELSE"],)], "i array<string>")
    got = df.select(F.expr(cleaning.severity_hundredths("i", low)).alias("s")).collect()
    assert [r.s for r in got] == [10, 75]


def test_weights_with_three_decimals_are_refused():
    with pytest.raises(ValueError):
        hundredths("1.005")


@pytest.mark.parametrize(
    "lat, lon, cell",
    [
        (12.9815, 77.61049, "12.982,77.61"),
        (12.9825, 78.0, "12.982,78.0"),
        (-0.0004, 0.0006, "-0.0,0.001"),
    ],
)
def test_cells(spark, lat, lon, cell):
    df = spark.createDataFrame([(lat, lon)], "latitude double, longitude double")
    assert cleaning.add_cells(df).first().grid_id == cell


def test_texts_are_parsed_once(spark, folder):
    from kerbscope.sources.event_mapping import read_event_violations

    plan = cleaning.clean_events(read_event_violations(spark, folder))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract_all") == 1
    assert text.count("try_cast") == 1
