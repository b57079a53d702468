import pytest
from pyspark.errors import AnalysisException

from kerbscope.operators.cleaning import clean_events
from kerbscope.plans.ranking import clean_sample, event_table, hotspots
from kerbscope.sources import violations as vio
from kerbscope.sources.tables import read_csv_table, read_events, write_csv, write_events, write_json


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text(
        "extra,id,created_datetime,latitude,longitude,violation_type,vehicle_type,vehicle_number,"
        "police_station,junction_name\n"
        'x,1,2024-01-01 00:00:00+00,12.5,77.5,"[""NO PARKING"",""A, B""]",CAR,NA,S1,n/a\n'
        "x,2,2024-01-01,oops,NaN,NULL,,V1,None,J\n",
        encoding="utf-8",
    )
    first, second = vio.read_violations(spark, str(path)).orderBy("id").collect()
    assert first.violation_type == '["NO PARKING","A, B"]'
    assert (first.latitude, first.vehicle_number, first.junction_name) == (12.5, None, None)
    assert (second.latitude, second.longitude, second.violation_type) == (None, None, None)
    assert (second.vehicle_type, second.police_station, second.junction_name) == (None, None, "J")


def test_one_column_scan_is_pruned(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("id,a,b\n1,x,y\n2,x,y\n")
    ids = vio.read_csv(spark, str(path), columns=("id",))
    assert ids.count() == 2
    assert "ReadSchema: struct<id:string>" in ids._jdf.queryExecution().executedPlan().toString()


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException) as error:
        vio.read_violations(spark, f"{tmp_path}/none.csv")
    assert error.value.getCondition() == "PATH_NOT_FOUND"


def test_session_zone_is_checked(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError):
            vio.read_violations(spark, f"{tmp_path}/none.csv")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_absent_table_is_empty_with_schema(spark, tmp_path):
    empty = read_csv_table(spark, f"{tmp_path}/absent", "a int, b string", optional=True)
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_absent_mandatory_table_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException) as error:
        read_csv_table(spark, f"{tmp_path}/absent", "a int, b string")
    assert error.value.getCondition() == "PATH_NOT_FOUND"


HEADER = "id,created_datetime,latitude,longitude,violation_type,vehicle_type,vehicle_number,police_station,junction_name\n"
TORN = HEADER + '1,2024-01-01 00:00:00+00,12.5,77.5,"[""NO PARKING""]",CAR,V1,S1,"MAIN\nROAD"\n2,2024-01-01 00:00:00+00,12.5,77.5,X,CAR,V2,S1,J\n'


def test_quoted_line_breaks_belong_to_the_field(spark, tmp_path):
    (tmp_path / "v.csv").write_text(TORN)
    first, second = vio.read_violations(spark, f"{tmp_path}/v.csv").orderBy("id").collect()
    assert (first.id, first.junction_name, second.id) == (1, "MAIN\nROAD", 2)


def test_a_torn_record_is_an_error(spark, tmp_path):
    (tmp_path / "v.csv").write_text(TORN)
    with pytest.raises(Exception, match="torn or malformed record"):
        vio.read_csv(spark, f"{tmp_path}/v.csv", multi_line=False).collect()


def test_files_are_split_unless_a_field_holds_a_line_break(spark, tmp_path):
    (tmp_path / "torn.csv").write_text(TORN)
    (tmp_path / "plain.csv").write_text(HEADER + '1,2024-01-01,12.5,77.5,"[""X"", ""Y""]",CAR,V1,"S ""1""",J\n')
    (tmp_path / "empty.csv").write_text(HEADER)
    found = [vio.has_line_breaks(spark, f"{tmp_path}/{name}.csv") for name in ("torn", "plain", "empty")]
    assert found == [True, False, False]
    plan = vio.read_csv(spark, f"{tmp_path}/plain.csv")
    assert plan.collect()[0].police_station == 'S "1"'
    assert vio.land_csv(spark, f"{tmp_path}/empty.csv").rows.collect() == []


def test_a_torn_record_is_rejected_when_files_are_split_unseen(spark, tmp_path):
    (tmp_path / "v.csv").write_text(TORN)
    landed = vio.land_csv(spark, f"{tmp_path}/v.csv", multi_line=False)
    assert landed.seen == 3 and vio.reject_counts(landed.rejects).collect() == [("too few fields", 1)]
    assert landed.rejects.first().record == 'ROAD"' and {r.id for r in landed.rows.collect()} == {1, 2}


GOOD = '2024-01-01 00:00:00+00,12.5,77.5,"[""NO PARKING""]",CAR,V1,S1,J'


def test_rejects_by_cause_and_the_run_goes_on(spark, tmp_path):
    lines = [
        f"a1,{GOOD}",
        f"7,{GOOD},more",
        "8,2024-01-01 00:00:00+00,north,77.5,X,CAR,V1,S1,J",
        "9,2024-01-01 00:00:00+00,12.5,east,X,CAR,V1,S1,J",
        "10,2024-01-01 00:00:00+00,12.5",
        f"12,{GOOD}",
        f"NA,{GOOD}",
    ]
    (tmp_path / "v.csv").write_text(HEADER + "\n".join(lines) + "\n")
    landed = vio.land_csv(spark, f"{tmp_path}/v.csv")
    causes = {r.cause: r.records for r in vio.reject_counts(landed.rejects).collect()}
    assert causes == {"too many fields": 1, "latitude is no number": 1, "longitude is no number": 1}
    assert landed.seen == 7 and {r.record[:2] for r in landed.rejects.collect()} == {"7,", '{"'}
    rows = {r.id: r for r in landed.rows.collect()}
    assert set(rows) == {"a1", "10", "12", None}  # one text id makes all of them texts
    assert rows["10"].latitude == 12.5 and rows["10"].longitude is None  # what is not there is missing
    assert sorted(str(r.id) for r in clean_events(landed.rows).collect()) == ["12", "None", "a1"]
    (tmp_path / "n.csv").write_text(HEADER + "\n".join(lines[1:]) + "\n")
    again = vio.land_csv(spark, f"{tmp_path}/n.csv")
    assert dict(again.rows.dtypes)["id"] == "bigint" and {r.id for r in again.rows.collect()} == {10, 12, None}


def test_text_ids_are_counted_and_sampled_by_number_first(spark):
    schema = "id string, created_datetime string, latitude double, longitude double, violation_type string, vehicle_type string, vehicle_number string, police_station string, junction_name string"
    ids = ["b", "10", "9", None, "a"]
    rows = spark.createDataFrame([(i, "2024-01-01", 12.5, 77.5, "NO PARKING", "CAR", "V", "S", "J") for i in ids], schema)
    cleaned = clean_events(vio.normalise(rows))
    assert [r.id for r in clean_sample(cleaned, 4).collect()] == ["9", "10", None, "a"]
    assert [r.violation_count for r in hotspots(event_table(rows)).collect()] == [4]


def test_months_are_replaced_one_by_one_and_read_alone(spark, tmp_path):
    def table(rows):
        return spark.createDataFrame(rows, "id long, month string, date string")

    path = f"{tmp_path}/events"
    write_events(table([(1, "2024-01", "2024-01-05"), (2, "2024-02", "2024-02-05"), (3, "2024-03", "2024-03-01")]), path)
    write_events(table([(4, "2024-02", "2024-02-09"), (5, "2024-04", "2024-04-01")]), path, months_only=True)
    rows = read_events(spark, path)
    assert dict(rows.dtypes)["month"] == "string"
    assert sorted((r.id, r.month) for r in rows.collect()) == [(1, "2024-01"), (3, "2024-03"), (4, "2024-02"), (5, "2024-04")]
    some = read_events(spark, path, "2024-02", "2024-03")
    assert sorted(r.id for r in some.collect()) == [3, 4]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    for part in (tmp_path / "events" / "month=2024-01").glob("*.parquet"):
        part.write_text("not opened when other months are read")
    assert sorted(r.id for r in some.collect()) == [3, 4]
    write_events(table([(6, "2024-01", "2024-01-05")]), path)
    assert [r.id for r in read_events(spark, path).collect()] == [6]


def test_ids_have_one_type(spark, tmp_path):
    rows = [(i, "2024-01-01", 12.5, 77.5, "x", None, None, None, None) for i in range(1, 13)]
    names = HEADER.strip().split(",")
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, ["int", "string", "double", "double"] + ["string"] * 5)))
    write_csv(df, f"{tmp_path}/v.csv")
    df.write.parquet(f"{tmp_path}/v.parquet")
    both = [vio.read_violations(spark, f"{tmp_path}/v.{kind}") for kind in ("csv", "parquet")]
    assert both[0].schema == both[1].schema
    assert [r.id for r in both[0].orderBy("id").collect()] == list(range(1, 13))


def test_missing_coordinates_are_filtered_in_the_scan(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", 12.5, 77.5), (2, "2024-01-01 00:00:00", None, 77.5), (3, "2024-01-01 00:00:00", float("nan"), 77.5)]
    df = spark.createDataFrame(rows, "id long, created_datetime string, latitude double, longitude double")
    df.selectExpr("*", *[f"'[\"NO PARKING\"]' AS {c}" for c in vio.RAW_COLUMNS[4:]]).write.parquet(f"{tmp_path}/v.parquet")
    cleaned = clean_events(vio.read_violations(spark, f"{tmp_path}/v.parquet"))
    assert [r.id for r in cleaned.collect()] == [1]
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(latitude)" in plan and "IsNotNull(longitude)" in plan


def test_sinks_keep_text(spark, tmp_path):
    df = spark.createDataFrame([("12.9,77.5", 'say "ನಮ"', None), ("  ", "two\nlines", 1)], "g string, t string, n int")
    write_csv(df, f"{tmp_path}/c")
    assert sorted(read_csv_table(spark, f"{tmp_path}/c", df.schema).collect()) == sorted(df.collect())
    write_json(df, f"{tmp_path}/j")
    parts = sorted((tmp_path / "j").glob("part-*"))
    line = "".join(f.read_text(encoding="utf-8") for f in parts)
    assert "ನಮ" in line and '"n":null' in line and '"g":"  "' in line
