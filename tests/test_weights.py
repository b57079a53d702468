"""Weights from tables, and vehicles by sketches."""

import random

import pytest

from kerbscope.operators import vehicles, weights, windows
from kerbscope.operators.cells import hotspot_cells
from kerbscope.operators.cleaning import clean_events
from kerbscope.settings import CleanSettings

COLUMNS = "id long, created_datetime string, latitude double, longitude double, violation_type string, vehicle_type string, vehicle_number string, police_station string, junction_name string"


def table(spark, rows):
    return weights.weight_table(spark.createDataFrame(rows, "name string, weight string"), "name", "weight")


def events(spark, kinds):
    rows = [(i, "2024-01-01 00:00:00", 12.5, 77.5, text, vehicle, None, None, None) for i, (text, vehicle) in enumerate(kinds)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


KINDS = [
    ("NO PARKING", "car"),
    ('["NO PARKING","DOUBLE PARKING"]', None),
    ("['odd parking']", "SPACESHIP"),
    ("['NO PARKING', 'ODD PARKING', 'WRONG PARKING']", "BUS"),
    ("  PARKING  ", "OTHERS"),
]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])  # a side is broadcast, or both are shuffled
def test_weights_of_tables(spark, threshold):
    severity = table(spark, [("NO PARKING", "1.10"), ("DOUBLE PARKING", "3.00"), ("DOUBLE PARKING", "2.00"), ("PARKING", "0.10"), (None, "9.00"), ("X", None)])
    footprint = table(spark, [("CAR", "0.50"), ("BUS", "4.25"), ("OTHERS", "0.20")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        cleaned = clean_events(events(spark, KINDS), CleanSettings(), weights.WeightTables(severity, footprint))
        plan = cleaned._jdf.queryExecution().executedPlan().toString()
        found = {r.id: (float(r.violation_severity), float(r.vehicle_pcu), r.impact_units) for r in cleaned.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert ("SortMergeJoin" in plan) == (threshold == "-1")
    assert {i: f[:2] for i, f in found.items()} == {0: (1.1, 0.5), 1: (3.0, 0.2), 2: (0.75, 1.0), 3: (1.1, 4.25), 4: (0.1, 0.2)}
    assert all(units == round(s * 100) * round(v * 100) * 10_000 for s, v, units in found.values())


def test_tables_with_the_given_weights_change_nothing(spark):
    settings = CleanSettings()
    both = weights.WeightTables(table(spark, list(settings.severity.items())), table(spark, list(settings.footprint.items())))
    raw = events(spark, KINDS * 3 + [(f"['{name}', 'NO PARKING']", v) for name in settings.severity for v in settings.footprint])
    plain, joined = clean_events(raw), clean_events(raw, settings, both)
    assert plain.columns == joined.select(plain.columns).columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, joined.select(plain.columns).collect()))


def test_empty_tables_leave_the_other_weights(spark):
    none = table(spark, [])
    found = clean_events(events(spark, KINDS), CleanSettings(), weights.WeightTables(none, none)).collect()
    assert {(float(r.violation_severity), float(r.vehicle_pcu)) for r in found} == {(0.75, 1.0)} and len(found) == 5


def test_a_weight_with_three_decimals_is_an_error(spark):
    with pytest.raises(Exception, match="more than two decimals"):
        table(spark, [("A", "1.005")]).collect()


def history(spark, seed=1):
    rnd = random.Random(seed)
    months = ["2024-01", "2024-02", "2024-03", "2024-04"]
    rows = []
    for cell, n in (("hot", 30_000), ("warm", 800), ("cold", 5)):
        rows += [(cell, rnd.choice(months[: 2 if cell == "cold" else 4]), f"V{rnd.randrange(n)}" if rnd.random() < 0.98 else None) for _ in range(n)]
    rows += [("bare", "2024-02", None), ("cold", None, "V1")]
    return rows, spark.createDataFrame(rows, "grid_id string, month string, vehicle_number string").repartition(4)


def test_vehicles_of_each_history(spark):
    rows, table_ = history(spark)
    index = windows.month_index(table_)
    months = [r.month for r in index.orderBy("month_idx").collect()]
    wanted = {}
    for w in range(2, len(months) + 2):
        for cell, month, vehicle in rows:
            if vehicle and month in months[: w - 1]:
                wanted.setdefault((w, cell), set()).add(vehicle)
    wanted = {key: len(found) for key, found in wanted.items()}
    assert {(r.window_id, r.grid_id): r.unique_vehicles for r in vehicles.history_vehicles(table_, index).collect()} == wanted
    approx = {(r.window_id, r.grid_id): r.approx_vehicles for r in vehicles.history_vehicles_approx(vehicles.monthly_sketches(table_), index).collect()}
    assert approx.keys() == wanted.keys()
    assert all(abs(approx[k] - n) <= max(1, vehicles.ERROR_BOUND * n) for k, n in wanted.items())


def test_cells_with_vehicles_by_sketch(spark, events_folder="/root/testdata/sf0.001"):
    from kerbscope.plans.ranking import event_table
    from kerbscope.sources.event_mapping import read_event_violations

    cleaned = event_table(read_event_violations(spark, events_folder))
    exact = {r.grid_id: r for r in hotspot_cells(cleaned).collect()}
    found = {r.grid_id: r for r in hotspot_cells(cleaned, vehicles.cell_vehicles_approx).collect()}
    assert exact.keys() == found.keys()
    for cell, r in exact.items():
        assert abs(found[cell].unique_vehicles - r.unique_vehicles) <= max(1, vehicles.ERROR_BOUND * r.unique_vehicles)
        assert found[cell].impact_sum == r.impact_sum
    plan = vehicles.cell_vehicles_approx(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
