"""Windows, features, search and the published reference points."""

import math

import pytest

from kerbscope.operators import blending, windows
from kerbscope.operators.features import month_scores, prediction_features
from kerbscope.plans import backtest as bt
from kerbscope.plans import model
from kerbscope.settings import CANDIDATES, FEATURES

EVENT = (
    "id long, grid_id string, date string, month string, hour int, is_peak_hour int, near_junction int, "
    "impact_units long, latitude double, longitude double, grid_lat double, grid_lon double, "
    "police_station string, junction_name string"
)


def make_events(spark, rows):
    """rows: (cell, date, peak, junction, impact, station)."""
    data = [
        (i, g, d, d[:7], 8, peak, near, int(impact * 1e8), 1.0, 2.0, 1.0, 2.0, st, None)
        for i, (g, d, peak, near, impact, st) in enumerate(rows)
    ]
    return spark.createDataFrame(data, EVENT)


@pytest.fixture(scope="module")
def three_months(spark):
    rows = []
    for month, counts in (("2024-01", {"a": 5, "b": 2, "c": 1}), ("2024-02", {"a": 1, "b": 4}), ("2024-04", {"b": 1, "d": 3})):
        for cell, n in counts.items():
            rows += [(cell, f"{month}-{1 + i % 2:02d}", i % 2, 1, 1.0, "S" + cell) for i in range(n)]
    return make_events(spark, rows)


def test_month_index_is_dense_over_present_months(three_months):
    rows = windows.month_index(three_months).orderBy("month").collect()
    assert [(r.month, r.month_idx, r.n_months) for r in rows] == [
        ("2024-01", 1, 3),
        ("2024-02", 2, 3),
        ("2024-04", 3, 3),
    ]


def test_windows_and_roles(three_months):
    index = windows.month_index(three_months)
    got = {(r.window_id, r.role, r.month[-1]) for r in windows.walk_forward_windows(index, final=True).collect()}
    assert got == {
        (2, "hist", "1"), (2, "last", "1"), (2, "test", "2"),
        (3, "hist", "1"), (3, "hist", "2"), (3, "last", "2"), (3, "prev", "1"), (3, "test", "4"),
        (4, "hist", "1"), (4, "hist", "2"), (4, "hist", "4"), (4, "last", "4"), (4, "prev", "2"),
    }


def test_history_is_all_earlier_months(three_months):
    facts = windows.monthly_facts(three_months)
    rows = windows.history_population(facts, final=True).collect()
    got = {(r.window_id, r.grid_id): (r.violation_count, r.active_days) for r in rows}
    assert got == {
        (2, "a"): (5, 2), (2, "b"): (2, 2), (2, "c"): (1, 1),
        (3, "a"): (6, 3), (3, "b"): (6, 4), (3, "c"): (1, 1),
        (4, "a"): (6, 3), (4, "b"): (7, 5), (4, "c"): (1, 1), (4, "d"): (3, 2),
    }


def test_features(three_months):
    facts = windows.monthly_facts(three_months)
    scores = month_scores(facts)
    score = {(r.month_idx, r.grid_id): r.score for r in scores.collect()}
    rows = {(r.window_id, r.grid_id): r for r in prediction_features(three_months, facts, scores).collect()}
    assert len(rows) == 10
    first, later = rows[(2, "c")], rows[(3, "c")]
    assert first.prev_month == 0.0 and first.trend_raw == score[(1, "c")]  # no month before
    assert later.last_month == 0.0 and later.prev_month == score[(1, "c")]  # missing last month
    assert later.trend_raw == -score[(1, "c")]
    for w in (2, 3, 4):
        for f in FEATURES:
            values = [r[f] for (window, _), r in rows.items() if window == w]
            assert min(values) == 0.0 and max(values) in (0.0, pytest.approx(100.0))
    assert rows[(4, "a")].police_station == "Sa"


def test_fewer_than_two_months_give_empty_results(spark):
    events = make_events(spark, [("a", "2024-01-01", 0, 0, 1.0, "S"), ("b", "2024-01-02", 1, 0, 1.0, "S")])
    results = bt.backtest(events)
    assert results.count() == 0 and "ndcg_at_50" in results.columns
    means = bt.metric_means(results).first()
    assert means.backtest_windows == 0 and means.precision_at_20 is None
    prepared = model.prepare(events)
    detail = model.candidate_backtest(prepared)
    assert detail.count() == 0
    assert model.weight_search(detail).count() == 0


def test_no_events_give_empty_results(spark, three_months):
    nothing = three_months.filter("id < 0")
    assert bt.backtest(nothing).count() == 0
    assert model.prepare(nothing).features.count() == 0


def detail_rows(spark, per_candidate):
    rows = []
    for candidate, windows_ in per_candidate.items():
        for i, (n50, p50, rho, p100) in enumerate(windows_):
            rows.append((candidate, i, n50, p50, rho, p100))
    return spark.createDataFrame(
        rows,
        "candidate int, window_id int, ndcg_at_50 double, precision_at_50 double, "
        "spearman_score_correlation double, precision_at_100 double",
    )


def test_objective_counts_missing_correlation_as_zero_and_ties_keep_order(spark):
    same = [(0.5, 0.4, None, 0.2), (0.7, 0.2, 0.5, 0.4)]
    search = blending.objective(detail_rows(spark, {2: same, 1: same, 3: [(0.1, 0.1, 0.1, 0.1)]}))
    best = model.best_candidate(search).first()
    assert best.candidate == 1
    assert best.objective == pytest.approx(0.45 * 0.6 + 0.25 * 0.3 + 0.2 * 0.25 + 0.1 * 0.3)
    assert [best[f] for f in FEATURES] == list(CANDIDATES[0])


# ---------------------------------------------------------------- fixed values
# Published results, used as reference points.
BLEND_BACKTEST = [  # ndcg@50, precision@50, spearman, precision@100 per test month
    (0.9175, 0.68, 0.7633, 0.69),
    (0.9484, 0.78, 0.7929, 0.74),
    (0.957, 0.72, 0.779, 0.7),
    (0.957, 0.68, 0.7915, 0.74),
    (0.902, 0.56, 0.735, 0.61),
]
BLEND_OBJECTIVE = 0.816439
STATIONS = [  # name, violations, impact, peak share, junction share, cells, high cells, score
    ("Upparpet", 34468, 35573.02975, 0.35116629917604736, 0.9946617152141116, 102, 4, 93.51166299176047),
    ("Shivajinagar", 28044, 25612.45425, 0.4330694622735701, 0.8128654970760234, 144, 4, 89.84628948538789),
    ("HAL Old Airport", 20819, 19927.1745, 0.2827705461357414, 0.0, 311, 1, 69.15760509894238),
    ("Malleshwaram", 22200, 21056.03325, 0.39094594594594595, 0.33531531531531533, 220, 0, 66.15190876955404),
    ("Kengeri", 464, 457.397, 0.23922413793103448, 0.0, 79, 0, 4.469958926011251),
    ("No Police Station", 339, 440.58575, 0.1887905604719764, 0.05309734513274336, 85, 0, 1.887905604719764),
]
TOP_COMPONENTS = (100.0, 55.00774393391843, 100.0, 49.30854681478123, 14.882841597305438)
TOP_SCORE = 75.17107482468826
# ------------------------------------------------------------ end fixed values


def test_published_objective(spark):
    search = blending.objective(detail_rows(spark, {2: BLEND_BACKTEST}))
    assert round(search.first().objective, 6) == BLEND_OBJECTIVE


def test_published_station_scores(spark):
    from kerbscope.operators.stations import order_stations, score_stations

    schema = (
        "police_station string, violation_count long, impact_sum double, peak_hour_share double, "
        "junction_share double, unique_hotspots long, high_priority_hotspots long, published double"
    )
    # the rows include the lowest and highest value of every scaled column
    scored = order_stations(score_stations(spark.createDataFrame(STATIONS, schema))).collect()
    assert [r.police_station for r in scored] == [s[0] for s in STATIONS]
    for r in scored:
        assert r.station_priority_score == pytest.approx(r.published, abs=1e-12)


def test_published_top_score():
    weights = (0.40, 0.25, 0.15, 0.10, 0.10)
    assert math.isclose(sum(w * c for w, c in zip(weights, TOP_COMPONENTS, strict=True)), TOP_SCORE)


def test_candidates_sum_to_one():
    assert all(math.isclose(sum(c), 1.0) for c in CANDIDATES)


def test_metrics_stay_in_range(events):
    rows = bt.backtest(events).collect()
    assert len(rows) == 5
    for r in rows:
        for k in (20, 50, 100):
            assert r[f"precision_at_{k}"] * k == pytest.approx(r[f"hit_count_at_{k}"])
            assert 0 <= r[f"ndcg_at_{k}"] <= 1
        assert -1 <= r.spearman_score_correlation <= 1
    ordered = sorted(rows, key=lambda r: r.test_month)
    for a, b in zip(ordered, ordered[1:], strict=False):
        assert b.train_rows == a.train_rows + a.test_rows


def test_a_station_without_a_mean_takes_the_median(spark):
    from kerbscope.operators.features import features_of

    rows = [(2, f"c{k}", s, float(h)) for k, (s, h) in enumerate([("A", 10), ("A", 30), ("B", 50), ("C", 80), ("C", 90)])]
    history = spark.createDataFrame(rows, "window_id int, grid_id string, police_station string, history double").selectExpr(
        "*", "false is_final", "0D latitude", "0D longitude", "'' junction_name", "0D peak_hour_weight_score", "0D junction_proximity_score", "0D repeat_hotspot_density_score"
    )
    scores = spark.createDataFrame([], "month_idx int, grid_id string, score double")
    whole = spark.createDataFrame([(2, "A", 20.0), (2, "B", 40.0), (2, "C", 85.0)], "window_id int, police_station string, station double")
    found = {r.grid_id: r.station for r in features_of(history, whole.where("police_station != 'B'"), scores).collect()}
    # B takes the median 50 of all cells; A has 20 and C 85.
    assert found == {"c0": 0.0, "c1": 0.0, "c2": pytest.approx(100 * 30 / 65), "c3": 100.0, "c4": 100.0}
    found = {r.grid_id: r.station for r in features_of(history, whole, scores).collect()}
    assert found["c2"] == pytest.approx(100 * 20 / 65)
