"""SQL twins of the queries, for DuckDB over the same parquet tables.

Written from the definitions: windows are built by joining every event to every
window it belongs to, ranks by window functions, modes by counting and sorting.
"""

from __future__ import annotations

from checks.queries import KS, SINKS
from checks.records import leaves_sql
from kerbscope.operators.scoring import COMPONENTS
from kerbscope.plans.model import RANKED_COLUMNS
from kerbscope.sources.event_mapping import VEHICLES, VIOLATION_TEXTS

# ---------------------------------------------------------------- fixed values
# Stated here a second time, so that a wrong value in the library shows.
SEVERITY = {'NO PARKING': '1.00',
 'WRONG PARKING': '1.05',
 'PARKING IN A MAIN ROAD': '1.40',
 'DOUBLE PARKING': '1.55',
 'PARKING NEAR ROAD CROSSING': '1.60',
 'PARKING NEAR TRAFFIC LIGHT OR ZEBRA CROSS': '1.65',
 'PARKING OPPOSITE TO ANOTHER PARKED VEHICLE': '1.45',
 'PARKING NEAR BUSTOP/SCHOOL/HOSPITAL ETC': '1.35',
 'PARKING OTHER THAN BUS STOP': '1.25',
 'PARKING ON FOOTPATH': '1.10'}

OTHER_SEVERITY = '0.75'

VEHICLE_FOOTPRINT = {'MOPED': '0.35',
 'SCOOTER': '0.40',
 'MOTOR CYCLE': '0.40',
 'PASSENGER AUTO': '0.75',
 'GOODS AUTO': '0.85',
 'CAR': '1.00',
 'JEEP': '1.00',
 'VAN': '1.10',
 'MAXI-CAB': '1.20',
 'LGV': '1.35',
 'TEMPO': '1.45',
 'MINI LORRY': '1.60',
 'LORRY/GOODS VEHICLE': '1.90',
 'HGV': '2.10',
 'TANKER': '2.20',
 'BUS (BMTC/KSRTC)': '2.50',
 'PRIVATE BUS': '2.50',
 'TOURIST BUS': '2.50',
 'SCHOOL VEHICLE': '2.25',
 'FACTORY BUS': '2.40'}

BANDS = (('Critical', 80, 'Tow-away patrol + barricade edge + peak-hour officer'),
 ('High', 60, 'Focused patrol during top 2 peak hours'),
 ('Medium', 40, 'Warning drive + repeat-offender monitoring'),
 ('Watch', None, 'Observe through weekly dashboard'))

FEATURES = ('history', 'last_month', 'trend', 'station', 'peak_junction')

CANDIDATES = ((1.0, 0.0, 0.0, 0.0, 0.0),
 (0.7, 0.3, 0.0, 0.0, 0.0),
 (0.55, 0.35, 0.1, 0.0, 0.0),
 (0.5, 0.3, 0.1, 0.1, 0.0),
 (0.45, 0.35, 0.1, 0.05, 0.05),
 (0.4, 0.35, 0.1, 0.1, 0.05),
 (0.35, 0.45, 0.1, 0.05, 0.05),
 (0.35, 0.35, 0.15, 0.1, 0.05),
 (0.3, 0.45, 0.15, 0.05, 0.05),
 (0.3, 0.4, 0.1, 0.1, 0.1),
 (0.25, 0.5, 0.1, 0.1, 0.05),
 (0.25, 0.45, 0.15, 0.1, 0.05))

SCORE_FORMULA = ('0.40*ViolationFrequency + 0.25*RepeatHotspotDensity + 0.15*JunctionProximity + '
 '0.10*PeakHourFactor + 0.10*VehicleBlockageWeight')
# ------------------------------------------------------------ end fixed values

# Items each mapped text parses to.
PARSED = (
    ("NO PARKING", "PARKING ON FOOTPATH"),
    ("DOUBLE PARKING",),
    ("WRONG PARKING",),
    ("NO PARKING",),
    ("no parking",),
    ("JUMPING SIGNAL",),
    (),
    (),
    ("PARKING IN A MAIN ROAD", "DEFECTIVE NUMBER PLATE"),
    ("NO PARKING",),
    ("PARKING NEAR ROAD CROSSING", "XX PARKING"),
)


def q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def rnd(expr: str, digits: int) -> str:
    scale = f"{float(10**digits)}::DOUBLE"
    return f"round_even(({expr}) * {scale}, 0) / {scale}"


def six(name: str) -> str:
    return f"{rnd(name, 6)} AS {name}"


def two(name: str) -> str:
    return f"{rnd(name, 2)} AS {name}"


def _case(key: str, pairs, other: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v}" for k, v in pairs) + f" ELSE {other} END"


def _list(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]::VARCHAR[]"


VIOLATIONS = f"""
violations AS (
  SELECT event_id AS id,
    CASE WHEN event_id % 97 = 0 THEN 'not-a-date'
         WHEN event_id % 193 = 0 THEN NULL
         ELSE strftime(ts - to_months((event_id % 6)::INTEGER), '%Y-%m-%d %H:%M:%S') || '+00'
    END AS created_datetime,
    CASE WHEN event_id % 101 <> 0 THEN 12.9::DOUBLE
         + (((user_id % 97) * (user_id % 97)) // 97) / 1000.0::DOUBLE
         + ((event_id % 9) - 4) / 10000.0::DOUBLE END AS latitude,
    CASE WHEN event_id % 103 <> 0 THEN 77.5::DOUBLE
         + ((event_id % 5) * (event_id % 3)) / 1000.0::DOUBLE
         + ((event_id % 7) - 3) / 10000.0::DOUBLE END AS longitude,
    {_case("event_id % 11", [(i, q(t)) for i, t in enumerate(VIOLATION_TEXTS)], "NULL")} AS violation_type,
    {_case("event_id % 8", [(i, q(t)) for i, t in enumerate(VEHICLES)], "NULL")} AS vehicle_type,
    CASE WHEN event_id % 29 <> 0 THEN 'V' || (event_id % 400) END AS vehicle_number,
    CASE WHEN user_id % 13 <> 12 THEN 'STN' || (user_id % 13) END AS police_station,
    CASE user_id % 6 WHEN 0 THEN 'NO JUNCTION' WHEN 1 THEN NULL WHEN 2 THEN '  '
         WHEN 3 THEN 'No Junction' ELSE 'JN' || (user_id % 6) || '-' || event_type END AS junction_name
  FROM events),
parsed AS (
  SELECT *, {_case("coalesce(violation_type, '')",
                   [(q(t), _list(p)) for t, p in zip(VIOLATION_TEXTS, PARSED, strict=True) if t],
                   "[]::VARCHAR[]")} AS items,
    try_strptime(left(created_datetime, 19), '%Y-%m-%d %H:%M:%S') + INTERVAL 330 MINUTE AS local_ts
  FROM violations)"""

CALENDAR = """
calendar AS (
  SELECT *, strftime(local_ts, '%Y-%m-%d') AS date, strftime(local_ts, '%Y-%m') AS month,
    dayname(local_ts) AS weekday, hour(local_ts)::INTEGER AS hour,
    CASE WHEN hour(local_ts) IN (8, 9, 10, 17, 18, 19, 20) THEN 1 ELSE 0 END AS is_peak_hour,
    CASE WHEN isodow(local_ts) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM parsed
  WHERE local_ts IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL)"""

FLAG = """CASE WHEN trim(coalesce(junction_name, '')) <> ''
    AND upper(coalesce(junction_name, '')) <> 'NO JUNCTION' THEN 1 ELSE 0 END"""

_SEVERITY = _case("x", [(q(k), f"{v}::DECIMAL(4,2)") for k, v in SEVERITY.items()], f"{OTHER_SEVERITY}::DECIMAL(4,2)")
_VEHICLE = _case(
    "upper(coalesce(vehicle_type, 'OTHERS'))",
    [(q(k), f"{v}::DECIMAL(4,2)") for k, v in VEHICLE_FOOTPRINT.items()],
    "1.00::DECIMAL(4,2)",
)

CLEAN = f"""
weighted AS (
  SELECT *, {FLAG} AS near_junction,
    list_max(list_transform(items, lambda x: {_SEVERITY})) AS violation_severity,
    {_VEHICLE} AS vehicle_pcu,
    {rnd("latitude", 3)} AS grid_lat, {rnd("longitude", 3)} AS grid_lon
  FROM calendar
  WHERE len(list_filter(items, lambda x: contains(x, 'PARKING'))) > 0),
clean AS (
  SELECT *, true AS parking_violation,
    CASE near_junction WHEN 1 THEN 1.25 ELSE 1.00 END::DECIMAL(3,2) AS junction_weight,
    CASE is_peak_hour WHEN 1 THEN 1.20 ELSE 1.00 END::DECIMAL(3,2) AS peak_weight,
    violation_severity * vehicle_pcu
      * CASE near_junction WHEN 1 THEN 1.25 ELSE 1.00 END::DECIMAL(3,2)
      * CASE is_peak_hour WHEN 1 THEN 1.20 ELSE 1.00 END::DECIMAL(3,2) AS incident_impact,
    grid_lat || ',' || grid_lon AS grid_id,
    CAST(round_even((latitude - grid_lat) * 1e12::DOUBLE, 0) AS BIGINT) AS lat_off,
    CAST(round_even((longitude - grid_lon) * 1e12::DOUBLE, 0) AS BIGINT) AS lon_off
  FROM weighted)"""


def mode_of(source: str, keys: str, column: str, name: str) -> str:
    """CTE: most frequent value per key, smallest on ties."""
    return f"""
{name} AS (
  SELECT {keys}, {column} FROM (
    SELECT {keys}, {column},
      row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {column}) AS rn
    FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}, {column}) WHERE rn = 1)"""


def cell_tables(source: str, keys: str, out: str) -> str:
    """CTEs: roll-up with modes, then scores, per population ``keys`` + grid_id."""
    pop = [k.strip() for k in keys.split(",") if k.strip()]
    group = ", ".join([*pop, "grid_id"])
    over = f"PARTITION BY {', '.join(pop)}" if pop else ""

    def mm(x: str) -> str:
        lo, hi = f"min({x}) OVER ({over})", f"max({x}) OVER ({over})"
        return f"CASE WHEN {hi} = {lo} THEN 0 ELSE (({x}) - {lo}) / ({hi} - {lo}) END"

    modes = ",".join(
        mode_of(source, group, c, f"{out}_{c}") for c in ("police_station", "junction_name", "vehicle_type")
    )
    using = f"USING ({group})"
    return f"""{modes},
{out}_plain AS (
  SELECT {group}, min(grid_lat) AS grid_lat, min(grid_lon) AS grid_lon,
    min(grid_lat) + (sum(lat_off)::DOUBLE / count(*)) / 1e12::DOUBLE AS latitude,
    min(grid_lon) + (sum(lon_off)::DOUBLE / count(*)) / 1e12::DOUBLE AS longitude,
    count(*) AS n_rows, count(id) AS violation_count,
    count(DISTINCT vehicle_number) AS unique_vehicles,
    sum(incident_impact)::DOUBLE AS impact_sum,
    sum(incident_impact)::DOUBLE / count(*) AS impact_avg,
    sum(is_peak_hour)::DOUBLE / count(*) AS peak_hour_share,
    sum(near_junction)::DOUBLE / count(*) AS junction_share,
    count(DISTINCT date) AS active_days
  FROM {source} GROUP BY {group}),
{out}_cells AS (
  SELECT p.*, coalesce(police_station, '') AS police_station,
    coalesce(junction_name, '') AS junction_name, coalesce(vehicle_type, '') AS top_vehicle_type,
    violation_count::DOUBLE / greatest(active_days, 1) AS repeat_density,
    ln(1 + violation_count) AS log_count,
    ln(1 + impact_sum) * (0.65 + 0.35 * peak_hour_share) AS slow
  FROM {out}_plain p LEFT JOIN {out}_police_station {using}
    LEFT JOIN {out}_junction_name {using} LEFT JOIN {out}_vehicle_type {using}),
{out}_parts AS (
  SELECT *, 100 * ({mm("log_count")}) AS parking_violation_frequency_score,
    100 * ({mm("repeat_density")}) AS repeat_hotspot_density_score,
    100 * junction_share AS junction_proximity_score,
    100 * peak_hour_share AS peak_hour_weight_score,
    100 * ({mm("impact_avg")}) AS vehicle_blockage_score,
    100 * ({mm("slow")}) AS estimated_speed_drop_score
  FROM {out}_cells),
{out} AS (
  SELECT *, parking_violation_frequency_score AS parking_violation_density_score,
    vehicle_blockage_score AS road_occupancy_score,
    junction_proximity_score AS road_importance_score,
    0.40::DOUBLE * parking_violation_frequency_score + 0.25::DOUBLE * repeat_hotspot_density_score
      + 0.15::DOUBLE * junction_proximity_score + 0.10::DOUBLE * peak_hour_weight_score
      + 0.10::DOUBLE * vehicle_blockage_score AS congestion_impact_score
  FROM {out}_parts)"""


def _band(column: int) -> str:
    parts = [f"WHEN congestion_impact_score >= {b[1]} THEN {q(b[column])}" for b in BANDS if b[1] is not None]
    return "CASE " + " ".join(parts) + f" ELSE {q(BANDS[-1][column])} END"


HOTSPOTS = f"""{cell_tables("clean", "", "scored")},
hotspots AS (
  SELECT *, {q(SCORE_FORMULA)} AS score_formula, {_band(0)} AS risk_band, {_band(2)} AS recommended_action,
    CAST(row_number() OVER (ORDER BY {rnd("congestion_impact_score", 9)} DESC, grid_id) AS INTEGER) AS priority_rank
  FROM scored)"""

STATIONS = f"""
rolled AS (
  SELECT police_station, count(id) AS violation_count, sum(incident_impact)::DOUBLE AS impact_sum,
    sum(is_peak_hour)::DOUBLE / count(*) AS peak_hour_share,
    sum(near_junction)::DOUBLE / count(*) AS junction_share,
    count(DISTINCT grid_id) AS unique_hotspots
  FROM clean WHERE police_station IS NOT NULL GROUP BY police_station)"""


def _mm_all(x: str) -> str:
    return (
        f"CASE WHEN max({x}) OVER () = min({x}) OVER () THEN 0 "
        f"ELSE ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) END"
    )


STATION_SCORES = f"""{STATIONS},
counted AS (
  SELECT r.*, coalesce(h.n, 0) AS high_priority_hotspots,
    ln(1 + impact_sum) AS li, ln(1 + violation_count) AS lc, coalesce(h.n, 0)::DOUBLE AS hc
  FROM rolled r LEFT JOIN (
    SELECT police_station, count(*) AS n FROM hotspots
    WHERE risk_band IN ('Critical', 'High') GROUP BY police_station) h USING (police_station)),
stations AS (
  SELECT *, 100 * (0.45::DOUBLE * {_mm_all("li")} + 0.25::DOUBLE * {_mm_all("lc")}
    + 0.20::DOUBLE * {_mm_all("hc")} + 0.10::DOUBLE * peak_hour_share) AS station_priority_score
  FROM counted),
ordered_stations AS (
  SELECT *, row_number() OVER (ORDER BY {rnd("station_priority_score", 9)} DESC, police_station) AS place
  FROM stations)"""

GRID_HOURS = """
grid_hours AS (
  SELECT grid_id, hour, count(id) AS events, sum(incident_impact) AS impact
  FROM clean WHERE grid_id IN (SELECT grid_id FROM hotspots WHERE priority_rank <= 40)
  GROUP BY grid_id, hour)"""

SHIFTS = f"""{GRID_HOURS},
places AS (
  SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY impact DESC, events DESC, hour) AS place
  FROM grid_hours),
shifts AS (
  SELECT h.priority_rank, grid_id, h.latitude, h.longitude, h.police_station, h.junction_name,
    h.risk_band, {rnd("h.congestion_impact_score", 2)} AS congestion_impact_score,
    b.best_enforcement_hours, h.recommended_action
  FROM hotspots h JOIN (
    SELECT grid_id, string_agg(lpad(hour::VARCHAR, 2, '0') || ':00', ', ' ORDER BY place) AS best_enforcement_hours
    FROM places WHERE place <= 3 GROUP BY grid_id) b USING (grid_id))"""

PROFILE = """
profile AS (
  SELECT month, hour, count(id) AS violations, sum(incident_impact) AS impact
  FROM clean GROUP BY month, hour)"""

HOURS = f"""{PROFILE},
hours AS (
  SELECT hour, CAST(sum(violations) AS BIGINT) AS violations, {rnd("sum(impact)::DOUBLE", 2)} AS impact
  FROM profile GROUP BY hour)"""

INDEX = """
idx AS (
  SELECT month, CAST(row_number() OVER (ORDER BY month) AS INTEGER) AS i,
    CAST(count(*) OVER () AS INTEGER) AS n FROM (SELECT DISTINCT month FROM clean)),
wins AS (
  SELECT w.i AS window_id, 'hist' AS role, h.month FROM
    (SELECT i FROM idx UNION ALL SELECT max(n) + 1 FROM idx) w JOIN idx h ON h.i < w.i
  UNION ALL
  SELECT i + 1, 'last', month FROM idx
  UNION ALL
  SELECT i + 2, 'prev', month FROM idx WHERE i + 1 <= n
  UNION ALL
  SELECT i, 'test', month FROM idx WHERE i >= 2),
labels AS (
  SELECT window_id, string_agg(month, ',' ORDER BY month) AS train_months,
    (SELECT month FROM idx WHERE i = window_id) AS test_month
  FROM wins WHERE role = 'hist' AND window_id <= (SELECT max(n) FROM idx) GROUP BY window_id)"""

WALK = f"""{INDEX},
fan AS (SELECT w.window_id, w.role, c.* FROM clean c JOIN wins w USING (month)),
{cell_tables("fan", "window_id, role", "walk").lstrip()},
test AS (SELECT window_id, grid_id, congestion_impact_score AS actual FROM walk WHERE role = 'test')"""


def quality(by: str) -> str:
    """CTEs from predicted(by, grid_id, predicted) and test to ``quality``."""
    keys = ", ".join(f"p.{k.strip()}" for k in by.split(","))
    gains = []
    for k in KS:
        gains.append(
            f"coalesce(sum(CASE WHEN position <= {k} THEN coalesce(actual, 0) / log2(position + 1) END), 0) AS dcg_{k}, "
            f"CAST(count(*) FILTER (WHERE position <= {k} AND actual_position <= {k}) AS BIGINT) AS hits_{k}"
        )
    ideals = ", ".join(
        f"sum(CASE WHEN actual_position <= {k} THEN actual / log2(actual_position + 1) END) AS ideal_{k}" for k in KS
    )
    columns = []
    for k in KS:
        columns += [
            f"{rnd(f'hits_{k} / {float(k)}::DOUBLE', 4)} AS precision_at_{k}",
            f"hits_{k} AS hit_count_at_{k}",
            f"{rnd(f'CASE WHEN ideal_{k} = 0 THEN 0 ELSE dcg_{k} / ideal_{k} END', 4)} AS ndcg_at_{k}",
        ]
    return f"""
placed_actual AS (
  SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY {rnd("actual", 9)} DESC, grid_id) AS actual_position
  FROM test),
placed AS (
  SELECT p.*, a.actual, a.actual_position,
    row_number() OVER (PARTITION BY {keys} ORDER BY {rnd("predicted", 9)} DESC, grid_id) AS position
  FROM predicted p LEFT JOIN placed_actual a USING (window_id, grid_id)),
gains AS (SELECT {by}, {", ".join(gains)} FROM placed GROUP BY {by}),
ideals AS (SELECT window_id, {ideals} FROM placed_actual GROUP BY window_id),
common AS (
  SELECT {by}, rank() OVER (PARTITION BY {by} ORDER BY x)
      + (count(*) OVER (PARTITION BY {by}, x) - 1) / 2.0::DOUBLE AS rx,
    rank() OVER (PARTITION BY {by} ORDER BY y)
      + (count(*) OVER (PARTITION BY {by}, y) - 1) / 2.0::DOUBLE AS ry
  FROM (SELECT {by}, {rnd("predicted", 9)} AS x, {rnd("actual", 9)} AS y FROM placed WHERE actual IS NOT NULL)),
correlation AS (
  SELECT {by}, count(*) AS common_hotspots, CASE WHEN count(*) >= 3 THEN
    covar_pop(rx, ry) / nullif(stddev_pop(rx) * stddev_pop(ry), 0) END AS spearman
  FROM common GROUP BY {by}),
quality AS (
  SELECT {by}, l.train_months, l.test_month, coalesce(common_hotspots, 0) AS common_hotspots,
    {rnd("spearman", 4)} AS spearman_score_correlation, {", ".join(columns)}
  FROM gains JOIN ideals USING (window_id) LEFT JOIN correlation USING ({by})
    JOIN labels l USING (window_id))"""


BACKTEST = f"""{WALK},
predicted AS (SELECT window_id, grid_id, congestion_impact_score AS predicted FROM walk WHERE role = 'hist'
  AND window_id <= (SELECT max(n) FROM idx)),
{quality("window_id").lstrip()},
sizes AS (
  SELECT window_id, CAST(sum(n_rows) FILTER (WHERE role = 'hist') AS BIGINT) AS train_rows,
    CAST(sum(n_rows) FILTER (WHERE role = 'test') AS BIGINT) AS test_rows,
    count(*) FILTER (WHERE role = 'hist') AS predicted_hotspots,
    count(*) FILTER (WHERE role = 'test') AS actual_hotspots
  FROM walk GROUP BY window_id),
backtest AS (SELECT * FROM quality JOIN sizes USING (window_id))"""

BACKTEST_COLUMNS = ", ".join(
    [
        "train_months",
        "test_month",
        "train_rows",
        "test_rows",
        "predicted_hotspots",
        "actual_hotspots",
        "common_hotspots",
        "spearman_score_correlation",
        *[f"{m}_at_{k}" for k in KS for m in ("precision", "hit_count", "ndcg")],
    ]
)


def _scale(x: str) -> str:
    lo, hi = f"min({x}) OVER (PARTITION BY window_id)", f"max({x}) OVER (PARTITION BY window_id)"
    return f"CASE WHEN {hi} = {lo} THEN 0 ELSE 100 * ({x} - {lo}) / ({hi} - {lo}) END"


FEATURE_TABLES = f"""{WALK},
station_means AS (
  SELECT window_id, police_station, avg(congestion_impact_score) AS station
  FROM walk WHERE role = 'hist' GROUP BY window_id, police_station),
raw_features AS (
  SELECT h.window_id, h.grid_id, h.latitude, h.longitude, h.police_station, h.junction_name,
    h.congestion_impact_score AS history, h.peak_hour_weight_score, h.junction_proximity_score,
    h.repeat_hotspot_density_score, coalesce(l.congestion_impact_score, 0) AS last_month,
    coalesce(p.congestion_impact_score, 0) AS prev_month, s.station,
    coalesce(l.congestion_impact_score, 0) - coalesce(p.congestion_impact_score, 0) AS trend_raw,
    0.55::DOUBLE * h.peak_hour_weight_score + 0.45::DOUBLE * h.junction_proximity_score AS peak_junction
  FROM walk h
    LEFT JOIN walk l ON l.role = 'last' AND l.window_id = h.window_id AND l.grid_id = h.grid_id
    LEFT JOIN walk p ON p.role = 'prev' AND p.window_id = h.window_id AND p.grid_id = h.grid_id
    JOIN station_means s ON s.window_id = h.window_id AND s.police_station = h.police_station
  WHERE h.role = 'hist'),
features AS (
  SELECT * REPLACE ({_scale("history")} AS history, {_scale("last_month")} AS last_month,
      {_scale("station")} AS station, {_scale("peak_junction")} AS peak_junction),
    {_scale("trend_raw")} AS trend
  FROM raw_features)"""

_BLEND = " + ".join(f"f.{name} * c.{name}" for name in FEATURES)
_CANDIDATE_ROWS = ", ".join(
    "(" + ", ".join([str(i), *[f"{w}::DOUBLE" for w in row]]) + ")" for i, row in enumerate(CANDIDATES, 1)
)

SEARCH = f"""{FEATURE_TABLES},
candidates(candidate, {", ".join(FEATURES)}) AS (VALUES {_CANDIDATE_ROWS}),
predicted AS (
  SELECT c.candidate, f.window_id, f.grid_id, {_BLEND} AS predicted
  FROM features f, candidates c WHERE f.window_id <= (SELECT max(n) FROM idx)),
{quality("candidate, window_id").lstrip()},
means AS (
  SELECT candidate, avg(ndcg_at_50) AS ndcg_at_50, avg(precision_at_50) AS precision_at_50,
    avg(coalesce(spearman_score_correlation, 0)) AS spearman, avg(precision_at_100) AS precision_at_100
  FROM quality GROUP BY candidate),
search AS (
  SELECT c.*, m.* EXCLUDE (candidate), 0.45::DOUBLE * ndcg_at_50 + 0.25::DOUBLE * precision_at_50
    + 0.20::DOUBLE * spearman + 0.10::DOUBLE * precision_at_100 AS objective
  FROM candidates c JOIN means m USING (candidate)),
best AS (SELECT * FROM search ORDER BY {rnd("objective", 9)} DESC, candidate LIMIT 1),
hybrid AS (SELECT * FROM quality WHERE candidate = (SELECT candidate FROM best))"""

_HYBRID_COLUMNS = ", ".join(
    [
        "test_month",
        "train_months",
        "common_hotspots",
        "spearman_score_correlation",
        *[f"{m}_at_{k}" for k in KS for m in ("precision", "ndcg")],
    ]
)
_MEANS = ["spearman_score_correlation", *[f"{m}_at_{k}" for m in ("precision", "ndcg") for k in KS]]

BLEND_SUMMARY = f"""
blend AS (
  SELECT (SELECT history FROM best) AS history, (SELECT last_month FROM best) AS last_month,
    (SELECT trend FROM best) AS trend, (SELECT station FROM best) AS station,
    (SELECT peak_junction FROM best) AS peak_junction, count(*) AS backtest_windows,
    {", ".join(f"{rnd(f'avg({c})', 4)} AS {c}" for c in _MEANS[1:])},
    {rnd("avg(coalesce(spearman_score_correlation, 0))", 4)} AS spearman_score_correlation
  FROM hybrid)"""

_EXACT = ("grid_id", "latitude", "longitude", "police_station", "junction_name")


def ranked(weights: str) -> str:
    return f"""
blended AS (
  SELECT f.*, {_BLEND} AS model_priority_score
  FROM features f, {weights} c WHERE f.window_id > (SELECT max(n) FROM idx)),
ranked AS (
  SELECT CAST(row_number() OVER (ORDER BY {rnd("model_priority_score", 9)} DESC, grid_id) AS INTEGER) AS model_rank, *
  FROM blended)"""


RANKED_SELECT = ", ".join(
    [
        "model_rank",
        *[c if c in _EXACT else six(c) for c in RANKED_COLUMNS],
        six("model_priority_score"),
    ]
)

VIEW_COLUMNS = ", ".join(
    [
        "priority_rank, grid_id, latitude, longitude, police_station, junction_name",
        "violation_count, unique_vehicles",
        f"{rnd('100 * peak_hour_share', 1)} AS peak_hour_share",
        f"{rnd('100 * junction_share', 1)} AS junction_share",
        f"{rnd('congestion_impact_score', 2)} AS congestion_impact_score",
        *[f"{rnd(c, 1)} AS {c}" for c in COMPONENTS],
        "risk_band, recommended_action",
    ]
)
VIEW = f"""
view_rows AS (SELECT {VIEW_COLUMNS} FROM hotspots WHERE priority_rank <= 160)"""


def chain(*parts: str) -> str:
    return "WITH " + ",".join(p.rstrip() for p in parts) + "\n"


# What a CSV scan reads as missing is NULL, all else comes back as it was.
_CSV_SCAN = """SELECT id, created_datetime, latitude, longitude, nullif(violation_type, '') AS violation_type,
  vehicle_type, vehicle_number, police_station,
  CASE id % 13 WHEN 0 THEN 'MAIN' || chr(10) || 'ROAD "EAST", 2' WHEN 3 THEN 'A, B' WHEN 4 THEN 'say "no"'
    WHEN 5 THEN ' blank ends ' WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 6 THEN NULL ELSE junction_name END AS junction_name
  FROM violations"""


# What the records of the jobs say in words, stated a second time.
_INTERPRETATION = {
    "precision_at_k": "Share of predicted top-k enforcement hotspots that also appeared in the actual top-k next month.",
    "ndcg_at_k": "Ranking quality where higher-ranked actual high-impact hotspots are rewarded more.",
    "spearman_score_correlation": "Rank correlation between historical hotspot score and next-month hotspot score for repeated grid cells.",
}
_RUN_OUTPUTS = ("cleaned_sample_records", "hotspot_priority", "station_priority_summary", "enforcement_shift_plan", "month_hour_profile")
_MODEL_OUTPUTS = ("model_weight_search_top30", "hybrid_model_backtest", "hybrid_model_ranked_hotspots")
_TOP_TEXTS = ("grid_id", "police_station", "junction_name", "top_vehicle_type", "score_formula", "risk_band", "recommended_action")
_TOP_NUMBERS = (
    "priority_rank", "latitude", "longitude", "grid_lat", "grid_lon", "violation_count", "unique_vehicles", "impact_sum", "impact_avg",
    "peak_hour_share", "junction_share", "active_days", "repeat_density", *COMPONENTS, "congestion_impact_score",
)


def _listed(name: str, texts) -> dict[str, str]:
    return {f"{name}[{i}]": q(t) for i, t in enumerate(texts)}


def _record_sql() -> dict[str, str]:
    """The nested records of the jobs, one row for each leaf."""
    clean = (VIOLATIONS, CALENDAR, CLEAN)
    run = (
        """
one AS (SELECT *, (SELECT count(*) FROM violations) AS input_rows, (SELECT count(*) FROM clean) AS used,
    (SELECT count(*) FROM hotspots) AS cells, (SELECT count(*) FROM hotspots WHERE risk_band = 'Critical') AS critical
  FROM hotspots WHERE priority_rank = 1)"""
    )
    run_texts = {f"top_hotspot.{c}": c for c in _TOP_TEXTS} | _listed("outputs", _RUN_OUTPUTS)
    run_numbers = {"input_rows": "input_rows", "parking_rows_used": "used", "hotspots": "cells", "critical_hotspots": "critical"}
    run_numbers |= {f"top_hotspot.{c}": c for c in _TOP_NUMBERS}

    means = "means AS (SELECT count(*) AS backtest_windows, " + ", ".join(f"{rnd(f'avg({c})', 4)} AS {c}" for c in _MEANS) + " FROM backtest)"
    texts = {"method": q("walk-forward next-month hotspot backtest")}
    texts |= {f"interpretation.{name}": q(text) for name, text in _INTERPRETATION.items()}
    months = [c.strip() for c in BACKTEST_COLUMNS.split(",")]
    place = "'metrics_by_month[' || (row_number() OVER (ORDER BY test_month) - 1) || ']."
    by_month = [
        f"SELECT {place}{c}' AS path, {c if c.endswith('_month') or c.endswith('_months') else 'NULL::VARCHAR'} AS text, "
        + ("NULL::DOUBLE" if c.endswith("_month") or c.endswith("_months") else six(f"{c}::DOUBLE").split(" AS ")[0])
        + " AS number FROM backtest"
        for c in months
    ]
    evaluation = leaves_sql("means", texts, {"backtest_windows": "backtest_windows"} | {f"metrics_mean.{c}": c for c in _MEANS})

    model_texts = {"model": q("hybrid learned ranking model")} | _listed("features", FEATURES) | _listed("outputs", _MODEL_OUTPUTS)
    model_numbers = {f"best_weights.{f}": f for f in FEATURES} | {"backtest_windows": "backtest_windows"} | {f"metrics_mean.{c}": c for c in _MEANS}
    return {
        "run_record": chain(*clean, HOTSPOTS, run) + leaves_sql("one", run_texts, run_numbers),
        "evaluation_record": chain(*clean, BACKTEST, "\n" + means) + evaluation + "\nUNION ALL " + "\nUNION ALL ".join(by_month),
        "model_record": chain(*clean, SEARCH, BLEND_SUMMARY) + leaves_sql("blend", model_texts, model_numbers),
    }


# The first time by id tells whether its column has the day or the month first.
_FORMATS = """,
written AS (
  SELECT id, try_strptime(left(created_datetime, 19), '%Y-%m-%d %H:%M:%S') AS moment FROM violations),
forms AS (
  SELECT id, moment,
    CASE WHEN id % 41 = 40 THEN strftime(moment, '%Y-%m-%d %H:%M:%S') ELSE strftime(moment, '%d/%m/%Y %H:%M') END AS day_first,
    CASE WHEN id % 43 = 42 THEN strftime(moment, '%d/%m/%Y %H:%M') ELSE strftime(moment, '%m/%d/%Y %I:%M:%S %p') END AS month_first
  FROM written),
first AS (SELECT left(arg_min(day_first, id), 2)::INTEGER > 12 AS day FROM forms WHERE day_first IS NOT NULL),
times AS (
  SELECT id, moment, day, CASE WHEN day THEN try_strptime(day_first, '%d/%m/%Y %H:%M') ELSE try_strptime(day_first, '%m/%d/%Y %H:%M') END AS a,
    try_strptime(month_first, '%m/%d/%Y %I:%M:%S %p') AS b
  FROM forms, first)
SELECT id, strftime(moment + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS iso, 'iso' AS iso_format,
  strftime(a + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS day_first, CASE WHEN day THEN 'd/M/yyyy H:m' ELSE 'M/d/yyyy H:m' END AS day_first_format,
  strftime(b + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS month_first, 'M/d/yyyy h:m:s a' AS month_first_format
FROM times"""

_REJECTS = """
SELECT CASE WHEN id % 67 = 4 THEN 'X' || id ELSE id::VARCHAR END AS id,
  CASE WHEN cause IS NULL AND NOT short THEN latitude END AS latitude,
  CASE WHEN cause IS NULL AND NOT short AND trim(junction_name) <> '' THEN junction_name END AS junction_name, cause
FROM (SELECT *, id % 61 = 3 AS short,
        CASE WHEN id % 61 = 3 THEN NULL WHEN id % 53 = 1 THEN 'too many fields' WHEN id % 59 = 2 THEN 'latitude is no number' END AS cause
      FROM violations)"""

_BY_MONTH = """
SELECT id, date, month, hour, grid_id, vehicle_type FROM clean WHERE month < (SELECT max(month) FROM clean)
UNION ALL
SELECT id, date, month, hour, grid_id, 'CORRECTED' FROM clean WHERE month = (SELECT max(month) FROM clean) AND id % 2 = 0"""

_VEHICLES = """
SELECT window_id, grid_id, count(DISTINCT vehicle_number) AS unique_vehicles, true AS within_bound
FROM clean JOIN (SELECT window_id, month FROM wins WHERE role = 'hist') USING (month)
WHERE vehicle_number IS NOT NULL GROUP BY window_id, grid_id"""


def _plain_sql() -> dict[str, str]:
    clean = (VIOLATIONS, CALENDAR, CLEAN)
    hot = (*clean, HOTSPOTS)
    weights = ("violation_severity", "vehicle_pcu", "junction_weight", "peak_weight", "incident_impact")
    as_double = ", ".join(f"{w}::DOUBLE AS {w}" for w in weights)
    means = ", ".join(f"{rnd(f'avg({c})', 4)} AS {c}" for c in _MEANS)
    station_cols = (
        f"police_station, violation_count, {six('impact_sum')}, {six('peak_hour_share')}, "
        f"{six('junction_share')}, unique_hotspots"
    )
    candidate_6 = f"(SELECT * FROM (VALUES {_CANDIDATE_ROWS}) v(candidate, {', '.join(FEATURES)}) WHERE candidate = 6)"
    span = {
        c: f"greatest(0.000001::DOUBLE, max({c}) OVER () - min({c}) OVER ())" for c in ("latitude", "longitude")
    }
    record = (
        "'HP-' || CASE WHEN priority_rank < 10000 THEN lpad(priority_rank::VARCHAR, 4, '0') "
        "ELSE priority_rank::VARCHAR END AS record_id"
    )
    records = f"{record}, junction_name, police_station, risk_band, congestion_impact_score, recommended_action"
    blend_cols = ", ".join([*FEATURES, "backtest_windows", *_MEANS])
    stations_of_clean = (*clean, HOTSPOTS, STATION_SCORES)
    return {
        "csv_scan": chain(VIOLATIONS) + _CSV_SCAN,
        "clean_events": chain(*clean)
        + f"""SELECT id, strftime(local_ts, '%Y-%m-%d %H:%M:%S') AS created_at_ist,
          array_to_string(items, ' | ') AS violation_items, parking_violation, date, month, weekday, hour,
          is_peak_hour, is_weekend, near_junction, {as_double}, grid_lat, grid_lon, grid_id FROM clean""",
        "parse_items": chain(VIOLATIONS)
        + "SELECT id, array_to_string(items, ' | ') AS items, len(items)::INTEGER AS n_items FROM parsed",
        "calendar_features": chain(VIOLATIONS, CALENDAR)
        + "SELECT id, date, month, weekday, hour, is_peak_hour, is_weekend FROM calendar",
        "junction_flag": chain(VIOLATIONS) + f"SELECT id, {FLAG} AS near_junction FROM violations",
        "incident_impact": chain(*clean) + f"SELECT id, {as_double} FROM clean",
        "grid_bins": chain(VIOLATIONS)
        + f"""SELECT id, grid_lat, grid_lon, grid_lat || ',' || grid_lon AS grid_id FROM (
          SELECT id, {rnd("latitude", 3)} AS grid_lat, {rnd("longitude", 3)} AS grid_lon
          FROM violations WHERE latitude IS NOT NULL AND longitude IS NOT NULL)""",
        "clean_sample": chain(*clean)
        + """SELECT id, date, hour, grid_id, incident_impact::DOUBLE AS incident_impact
          FROM clean ORDER BY id LIMIT 5000""",
        "hotspot_rollup": chain(*clean, cell_tables("clean", "", "scored"))
        + f"""SELECT grid_id, latitude, longitude, grid_lat, grid_lon, violation_count, unique_vehicles,
          {six("impact_sum")}, {six("impact_avg")}, {six("peak_hour_share")}, {six("junction_share")}, active_days
          FROM scored""",
        "hotspot_modes": chain(*hot)
        + "SELECT grid_id, police_station, junction_name, top_vehicle_type FROM hotspots",
        "minmax_scale": chain(*hot)
        + f"""SELECT grid_id, {rnd(_mm_all("violation_count::DOUBLE"), 6)} AS scaled_count,
          {rnd(_mm_all("impact_sum"), 6)} AS scaled_impact, 0.0::DOUBLE AS scaled_constant FROM hotspots""",
        "hotspot_scores": chain(*hot)
        + f"SELECT grid_id, {six('repeat_density')}, {', '.join(six(c) for c in COMPONENTS)} FROM hotspots",
        "risk_bands": chain(*hot)
        + f"SELECT grid_id, {six('congestion_impact_score')}, risk_band, recommended_action FROM hotspots",
        "hotspot_ranked": chain(*hot)
        + f"""SELECT priority_rank, grid_id, latitude, longitude, violation_count, unique_vehicles, active_days,
          police_station, junction_name, top_vehicle_type, {six("congestion_impact_score")}, score_formula,
          risk_band, recommended_action FROM hotspots ORDER BY priority_rank""",
        "station_rollup": chain(*clean, STATIONS) + f"SELECT {station_cols} FROM rolled",
        "station_priority": chain(*stations_of_clean)
        + f"SELECT {station_cols}, high_priority_hotspots, {six('station_priority_score')} FROM stations",
        "grid_hour": chain(*hot, GRID_HOURS)
        + f"SELECT grid_id, hour, events, {rnd('impact::DOUBLE', 6)} AS impact FROM grid_hours",
        "shift_plan": chain(*hot, SHIFTS) + "SELECT * FROM shifts ORDER BY priority_rank",
        "month_hour_profile": chain(*clean, PROFILE)
        + f"SELECT month, hour, violations, {rnd('impact::DOUBLE', 6)} AS impact FROM profile",
        "hour_profile": chain(*clean, HOURS)
        + f"SELECT *, {rnd('100 * impact / max(impact) OVER ()', 6)} AS bar_width FROM hours",
        "kpi_strip": chain(*stations_of_clean, SEARCH, BLEND_SUMMARY)
        + f"""SELECT CAST(sum(violation_count) AS BIGINT) AS total_violations, count(*) AS hotspots,
          count(*) FILTER (WHERE risk_band = 'Critical') AS critical,
          count(*) FILTER (WHERE risk_band = 'High') AS high,
          count(*) FILTER (WHERE risk_band = 'Medium') AS medium,
          count(*) FILTER (WHERE risk_band = 'Watch') AS watch,
          {rnd("max(congestion_impact_score)", 6)} AS top_score,
          count(*) FILTER (WHERE risk_band IN ('Critical', 'High')) AS high_or_critical,
          (SELECT count(*) FROM stations) AS stations,
          (SELECT police_station FROM ordered_stations WHERE place = 1) AS top_station,
          (SELECT junction_name FROM hotspots WHERE priority_rank = 1) AS top_junction,
          (SELECT {rnd("100 * precision_at_50", 6)} FROM blend) AS model_precision_at_50,
          (SELECT {rnd("100 * ndcg_at_50", 6)} FROM blend) AS model_ndcg_at_50,
          (SELECT {rnd("spearman_score_correlation", 6)} FROM blend) AS model_spearman_score_correlation,
          (SELECT {rnd("100 * history", 6)} FROM blend) AS blend_history,
          (SELECT {rnd("100 * last_month", 6)} FROM blend) AS blend_last_month
          FROM hotspots""",
        "run_summary": chain(*hot)
        + f"""SELECT (SELECT count(*) FROM violations) AS input_rows, (SELECT count(*) FROM clean) AS parking_rows_used,
          (SELECT count(*) FROM hotspots) AS hotspots,
          (SELECT count(*) FROM hotspots WHERE risk_band = 'Critical') AS critical_hotspots,
          grid_id AS top_grid_id, violation_count AS top_violation_count, unique_vehicles AS top_unique_vehicles,
          police_station AS top_police_station, {rnd("congestion_impact_score", 6)} AS top_score,
          risk_band AS top_risk_band FROM hotspots WHERE priority_rank = 1""",
        "month_index": chain(*clean, INDEX) + "SELECT month, i AS month_idx, n AS n_months FROM idx",
        "walk_forward_windows": chain(*clean, INDEX)
        + "SELECT window_id, role, month FROM wins WHERE window_id <= (SELECT max(n) FROM idx)",
        "precision_at_k": chain(*clean, BACKTEST)
        + "SELECT test_month, "
        + ", ".join(f"precision_at_{k}, hit_count_at_{k}" for k in KS)
        + " FROM backtest",
        "ndcg_at_k": chain(*clean, BACKTEST)
        + f"SELECT test_month, {', '.join(f'ndcg_at_{k}' for k in KS)} FROM backtest",
        "spearman": chain(*clean, BACKTEST)
        + "SELECT test_month, common_hotspots, spearman_score_correlation FROM backtest",
        "backtest": chain(*clean, BACKTEST) + f"SELECT {BACKTEST_COLUMNS} FROM backtest",
        "metric_means": chain(*clean, BACKTEST)
        + f"SELECT count(*) AS backtest_windows, {means} FROM backtest",
        "station_context": chain(*clean, FEATURE_TABLES)
        + f"""SELECT window_id, police_station, {six("station")}, {six("median_score")} FROM station_means JOIN (
          SELECT window_id, median(congestion_impact_score) AS median_score FROM walk WHERE role = 'hist'
          GROUP BY window_id) USING (window_id)""",
        "feature_scale": chain(*clean, FEATURE_TABLES)
        + f"SELECT window_id, grid_id, {', '.join(six(f) for f in FEATURES)} FROM features",
        "prediction_features": chain(*clean, FEATURE_TABLES)
        + f"SELECT window_id, {', '.join(c if c in _EXACT else six(c) for c in RANKED_COLUMNS)} FROM features",
        "blend_rank": chain(*clean, FEATURE_TABLES, ranked(candidate_6))
        + f"SELECT {RANKED_SELECT} FROM ranked",
        "weight_search": chain(*clean, SEARCH)
        + f"""SELECT {", ".join(FEATURES)}, {", ".join(six(c) for c in ("objective", "precision_at_50", "ndcg_at_50", "spearman"))}
          FROM search ORDER BY objective DESC LIMIT 30""",
        "best_blend": chain(*clean, SEARCH, BLEND_SUMMARY) + f"SELECT {blend_cols} FROM blend",
        "hybrid_backtest": chain(*clean, SEARCH) + f"SELECT {_HYBRID_COLUMNS} FROM hybrid",
        "final_ranking": chain(*clean, SEARCH, ranked("best")) + f"SELECT {RANKED_SELECT} FROM ranked",
        "view_hotspots": chain(*hot, VIEW) + "SELECT * FROM view_rows",
        "view_stations": chain(*stations_of_clean)
        + f"""SELECT police_station, violation_count, high_priority_hotspots, unique_hotspots,
          {rnd("100 * peak_hour_share", 1)} AS peak_hour_share,
          {rnd("station_priority_score", 2)} AS station_priority_score FROM ordered_stations WHERE place <= 20""",
        "view_shifts": chain(*hot, SHIFTS)
        + """SELECT priority_rank, police_station, junction_name, risk_band, congestion_impact_score,
          best_enforcement_hours, recommended_action FROM shifts""",
        "summary_hotspots": chain(*hot)
        + f"""SELECT priority_rank, police_station, junction_name, violation_count,
          {rnd("congestion_impact_score", 2)} AS congestion_impact_score, risk_band, recommended_action
          FROM hotspots WHERE priority_rank <= 15""",
        "summary_stations": chain(*stations_of_clean)
        + f"""SELECT police_station, violation_count, {two("impact_sum")}, {two("peak_hour_share")},
          {two("junction_share")}, unique_hotspots, high_priority_hotspots, {two("station_priority_score")}
          FROM ordered_stations WHERE place <= 10""",
        "summary_shifts": chain(*hot, SHIFTS)
        + f"""SELECT priority_rank, grid_id, {two("latitude")}, {two("longitude")}, police_station, junction_name,
          risk_band, {two("congestion_impact_score")}, best_enforcement_hours, recommended_action
          FROM shifts WHERE priority_rank <= 20""",
        "view_model": chain(*clean, SEARCH, ranked("best"))
        + f"""SELECT model_rank, police_station, junction_name,
          {", ".join(f"{rnd(c, 2)} AS {c}" for c in ("model_priority_score", "history", "last_month"))}
          FROM ranked WHERE model_rank <= 20""",
        "view_backtest": chain(*clean, SEARCH)
        + """SELECT test_month, precision_at_20, precision_at_50, precision_at_100, ndcg_at_50,
          spearman_score_correlation FROM hybrid""",
        "view_filtered": chain(*hot, VIEW)
        + """SELECT priority_rank, grid_id, police_station, congestion_impact_score, risk_band
          FROM view_rows WHERE risk_band = 'Medium' AND police_station = 'STN1'""",
        "view_map_points": chain(*hot, VIEW)
        + f"""SELECT priority_rank, grid_id,
          {rnd(f"5 + 90 * ((longitude - min(longitude) OVER ()) / {span['longitude']})", 6)} AS x,
          {rnd(f"95 - 90 * ((latitude - min(latitude) OVER ()) / {span['latitude']})", 6)} AS y,
          {rnd("greatest(10.0, least(34.0, 6 + congestion_impact_score / 3.1::DOUBLE))", 6)} AS dot_size
          FROM view_rows""",
        "view_preview_points": chain(*hot)
        + f"""SELECT *, {rnd(f"5 + 90 * ((longitude - min(longitude) OVER ()) / {span['longitude']})", 6)} AS x,
          {rnd(f"95 - 90 * ((latitude - min(latitude) OVER ()) / {span['latitude']})", 6)} AS y,
          {rnd("greatest(8.0, least(34.0, 7 + congestion_impact_score / 4.0::DOUBLE))", 6)} AS dot_size
          FROM (SELECT priority_rank, {six("latitude")}, {six("longitude")}, police_station, junction_name,
            violation_count, {two("congestion_impact_score")}, risk_band, recommended_action
            FROM hotspots WHERE priority_rank <= 120)""",
        "view_records": chain(*hot, VIEW) + f"SELECT {records} FROM view_rows",
        "view_json_feed": chain(*hot, VIEW)
        + f"SELECT to_json(r)::VARCHAR AS record FROM (SELECT {records} FROM view_rows) r",
        "station_filter_list": chain(*hot, VIEW)
        + """SELECT police_station, CAST(min(priority_rank) AS INTEGER) AS first_rank FROM view_rows
          WHERE priority_rank <= 80 GROUP BY police_station ORDER BY first_rank LIMIT 8""",
        "sink_roundtrip": chain(*hot, SHIFTS, PROFILE)
        + """SELECT 'enforcement_shift_plan' AS table_name, count(*) AS n_rows FROM shifts
          UNION ALL SELECT 'quoted_grid_id', count(*) FROM shifts
          UNION ALL SELECT 'month_hour_profile', count(*) FROM profile
          UNION ALL SELECT 'hotspot_priority', count(*) FROM hotspots
          UNION ALL SELECT 'absent', 0""",
        "calendar_formats": chain(VIOLATIONS).rstrip() + _FORMATS,
        "csv_rejects": chain(VIOLATIONS) + _REJECTS,
        "sink_events_by_month": chain(*clean) + _BY_MONTH,
        "vehicles_approx": chain(*clean, INDEX) + _VEHICLES,
        "incident_impact_by_table": chain(*clean) + f"SELECT id, {as_double} FROM clean",
        **_record_sql(),
    }


# Texts that may be empty; an empty text is read again as missing.
_MAY_BE_EMPTY = {
    "hotspot_ranked": ("police_station", "junction_name", "top_vehicle_type"),
    "shift_plan": ("police_station", "junction_name"),
    "final_ranking": ("police_station", "junction_name"),
}


def _read_again(name: str, sql: str) -> str:
    texts = ", ".join(f"nullif({c}, '') AS {c}" for c in _MAY_BE_EMPTY.get(name, ()))
    return f"SELECT * REPLACE ({texts}) FROM ({sql})" if texts else sql


def all_sql() -> dict[str, str]:
    """What is written and read again is the table itself."""
    found = _plain_sql()
    return found | {f"sink_{name}": _read_again(name, found[name]) for name in SINKS}
