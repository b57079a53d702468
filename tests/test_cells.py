"""Roll-ups against plain accumulators, and the degenerate cases."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbscope.operators import cells, profiles, scoring, shifts, stations
from kerbscope.plans import ranking
from kerbscope.settings import BANDS


def tally(rows, key):
    """Plain accumulators: what each key's events add up to, one event at a time."""
    found = {}
    for row in rows:
        if row[key] is None:
            continue
        t = found.setdefault(row[key], {"n": 0, "impact": 0, "peak": 0, "junction": 0, "lat": 0.0, "lon": 0.0, "sets": {}, "votes": {}})
        t["n"] += 1
        t["impact"] += row["impact_units"]
        t["peak"] += row["is_peak_hour"]
        t["junction"] += row["near_junction"]
        t["lat"] += row["latitude"]
        t["lon"] += row["longitude"]
        for name in ("vehicle_number", "date", "grid_id"):
            if row[name] is not None:
                t["sets"].setdefault(name, set()).add(row[name])
        for name in ("police_station", "junction_name", "vehicle_type"):
            if row[name] is not None:
                votes = t["votes"].setdefault(name, {})
                votes[row[name]] = votes.get(row[name], 0) + 1
    return found


def most_voted(votes):
    """The value with most votes, the smallest of equal ones; no votes, an empty text."""
    best = max(votes.values(), default=0)
    return min((value for value, n in votes.items() if n == best), default="")


@pytest.fixture(scope="module")
def local(events):
    return events.toPandas()


@pytest.fixture(scope="module")
def rolled(events):
    return cells.hotspot_cells(events).toPandas().set_index("grid_id").sort_index()


@pytest.fixture(scope="module")
def rows(events):
    return [r.asDict() for r in events.collect()]


def test_rollup_matches_plain_accumulators(rows, rolled):
    expected = tally(rows, "grid_id")
    assert sorted(expected) == sorted(rolled.index)
    for cell, t in expected.items():
        got = rolled.loc[cell]
        assert got["violation_count"] == t["n"]
        assert got["unique_vehicles"] == len(t["sets"].get("vehicle_number", ()))
        assert got["active_days"] == len(t["sets"]["date"])
        exact = {
            "latitude": t["lat"] / t["n"],
            "longitude": t["lon"] / t["n"],
            "impact_sum": t["impact"] / 1e8,
            "impact_avg": t["impact"] / 1e8 / t["n"],
            "peak_hour_share": t["peak"] / t["n"],
            "junction_share": t["junction"] / t["n"],
        }
        assert {name: got[name] for name in exact} == pytest.approx(exact, rel=0, abs=1e-9)
        modes = (("police_station", "police_station"), ("junction_name", "junction_name"), ("top_vehicle_type", "vehicle_type"))
        assert all(got[out] == most_voted(t["votes"].get(name, {})) for out, name in modes)


def test_one_cell_holds_a_large_share(local, rolled):
    # the mapping concentrates events, so the comparison covers a hot cell
    assert rolled["violation_count"].max() > 20 * rolled["violation_count"].median()


def test_station_rollup_matches_plain_accumulators(events, rows):
    expected = tally(rows, "police_station")
    got = {r.police_station: r for r in stations.station_rollup(events).collect()}
    assert set(got) == set(expected)
    for name, t in expected.items():
        row = got[name]
        assert (row.violation_count, row.unique_hotspots) == (t["n"], len(t["sets"]["grid_id"]))
        values = (t["impact"] / 1e8, t["peak"] / t["n"], t["junction"] / t["n"])
        assert (row.impact_sum, row.peak_hour_share, row.junction_share) == pytest.approx(values, rel=0, abs=1e-7)


def test_distinct_vehicles_shuffle_on_pairs(events):
    plan = cells.cell_vehicles(events)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(grid_id" in plan and "vehicle_number" in plan.split("hashpartitioning")[2]
    assert "SinglePartition" not in plan


def test_mode_ties_nulls_and_all_null(spark):
    rows = [("a", "y"), ("a", "x"), ("a", None), ("a", None), ("b", None), ("c", "z"), ("c", "z"), ("c", "a")]
    df = spark.createDataFrame(rows, "grid_id string, police_station string").withColumns(
        {"junction_name": F.lit("J"), "vehicle_type": F.lit(None).cast("string")}
    )
    got = {r.grid_id: r for r in cells.cell_modes(df).collect()}
    assert [got[g].police_station for g in "abc"] == ["x", None, "z"]
    assert [got[g].junction_name for g in "abc"] == ["J", "J", "J"]
    assert all(got[g].top_vehicle_type is None for g in "abc")


def test_bands(spark):
    scores = [80.0, 79.999, 60.0, 59.999, 40.0, 39.999, 0.0, None, float("nan")]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    rows = df.select(
        "i",
        scoring.risk_band(F.col("s")).alias("band"),
        scoring.enforcement_action(F.col("s")).alias("action"),
    ).orderBy("i")
    got = [(r.band, r.action) for r in rows.collect()]
    names = ["Critical", "High", "High", "Medium", "Medium", "Watch", "Watch", "Watch", "Watch"]
    actions = {b[0]: b[2] for b in BANDS}
    assert got == [(n, actions[n]) for n in names]


def test_best_hours(spark):
    rows = [
        ("a", 5, 1, 9.0), ("a", 7, 2, 9.0), ("a", 3, 2, 9.0), ("a", 1, 1, 1.0),
        ("b", 23, 1, 1.0), ("b", 2, 1, 2.0),
    ]
    df = spark.createDataFrame(rows, "grid_id string, hour int, events long, impact double")
    got = {r.grid_id: r.best_enforcement_hours for r in shifts.best_hours(df).collect()}
    assert got == {"a": "03:00, 07:00, 05:00", "b": "02:00, 23:00"}


def test_high_counts_default_to_zero(spark):
    station = spark.createDataFrame([("S1", 1), ("S2", 1)], "police_station string, n int")
    hot = spark.createDataFrame(
        [("S1", "High"), ("S1", "Critical"), ("S1", "Watch"), ("S2", "Medium")],
        "police_station string, risk_band string",
    )
    got = {r.police_station: r.high_priority_hotspots for r in stations.with_high_priority(station, hot).collect()}
    assert got == {"S1": 2, "S2": 0}


def test_profile_adds_up(events, local):
    profile = profiles.month_hour_profile(events).toPandas()
    assert profile["violations"].sum() == len(local)
    assert profile["impact"].sum() == pytest.approx(local["impact_units"].sum() / 1e8)
    hours = profiles.hour_profile(profiles.month_hour_totals(events)).toPandas()
    assert hours["violations"].sum() == len(local)
    assert hours["bar_width"].max() == 100


def test_rank_and_top_agree(events):
    hot = ranking.hotspots(events)
    full = ranking.rank_hotspots(hot).filter("priority_rank <= 40").toPandas()
    top = ranking.top_hotspots(hot, 40).toPandas()
    order = full.sort_values("priority_rank").reset_index(drop=True)
    pd.testing.assert_frame_equal(top.sort_values("priority_rank").reset_index(drop=True), order)
    assert sorted(ranking.rank_hotspots(hot).toPandas()["priority_rank"]) == list(range(1, hot.count() + 1))


def test_plan_covers_the_top_cells(events):
    plan = ranking.shift_plan(events, ranking.hotspots(events), top_n=7).toPandas()
    assert list(plan["priority_rank"]) == list(range(1, 8))
    assert plan["congestion_impact_score"].is_monotonic_decreasing


def test_results_do_not_depend_on_partitioning(spark, events):
    def snapshot(partitions, pieces):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        hot = ranking.rank_hotspots(ranking.hotspots(events.repartition(pieces)))
        return hot.toPandas().sort_values("grid_id").reset_index(drop=True)

    try:
        first = snapshot(1, 1)
        for partitions, pieces in ((4, 7), (200, 23)):
            pd.testing.assert_frame_equal(first, snapshot(partitions, pieces), check_exact=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
