"""Hotspots, stations, shift plan and profile from cleaned events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kerbscope.operators import ordering, shifts, stations
from kerbscope.operators.cells import hotspot_cells
from kerbscope.operators.cleaning import clean_events
from kerbscope.operators.scoring import COMPONENTS, classify, score_cells
from kerbscope.settings import CleanSettings
from kerbscope.staging import stage

SCORE = "congestion_impact_score"

EVENT_COLUMNS = (
    "id",
    "date",
    "month",
    "hour",
    "is_peak_hour",
    "near_junction",
    "impact_units",
    "latitude",
    "longitude",
    "grid_lat",
    "grid_lon",
    "grid_id",
    "police_station",
    "junction_name",
    "vehicle_type",
    "vehicle_number",
)

HOTSPOT_COLUMNS = (
    "grid_id",
    "latitude",
    "longitude",
    "grid_lat",
    "grid_lon",
    "violation_count",
    "unique_vehicles",
    "impact_sum",
    "impact_avg",
    "peak_hour_share",
    "junction_share",
    "active_days",
    "police_station",
    "junction_name",
    "top_vehicle_type",
    "repeat_density",
    *COMPONENTS,
    SCORE,
    "score_formula",
    "risk_band",
    "recommended_action",
)


def event_table(violations: DataFrame, settings: CleanSettings | None = None) -> DataFrame:
    """Cleaned events written once, with the columns later steps read.

    Most plans pass over the events several times (totals, modes, vehicles,
    hours); each pass then scans only its own columns instead of parsing the raw
    texts again.
    """
    return stage(clean_events(violations, settings).select(*EVENT_COLUMNS), "events")


def hotspots(events: DataFrame) -> DataFrame:
    """Scored and classified cells, unranked.

    The cell table is written once: scaling reads it for the bounds and again for
    the scores, and the events are not scanned a second time.
    """
    cells = stage(hotspot_cells(events), "cells")
    return classify(score_cells(cells)).select(*HOTSPOT_COLUMNS)


def rank_hotspots(scored: DataFrame) -> DataFrame:
    """All cells with ``priority_rank`` 1..n."""
    return ordering.with_rank(scored, SCORE, "priority_rank")


def top_hotspots(scored: DataFrame, n: int) -> DataFrame:
    """The first ``n`` cells with ``priority_rank``; the other cells are never ranked."""
    return ordering.top_ranked(scored, SCORE, "priority_rank", n)


def station_summary(events: DataFrame, scored: DataFrame) -> DataFrame:
    """Scored stations; the small joined table is written once for its bounds."""
    rolled = stations.with_high_priority(stations.station_rollup(events), scored)
    return stations.score_stations(stage(rolled, "stations"))


def shift_plan(events: DataFrame, scored: DataFrame, top_n: int = 40, hours: int = 3) -> DataFrame:
    return shifts.shift_plan(events, top_hotspots(scored, top_n), hours).orderBy("priority_rank")


def clean_sample(events: DataFrame, n: int = 5000) -> DataFrame:
    """First ``n`` cleaned rows by id; tables have no file order.  Of text ids, numbers come first, by value."""
    if dict(events.dtypes)["id"] != "string":
        return events.orderBy("id").limit(n)
    return events.orderBy(F.col("id").try_cast("decimal(38,0)").asc_nulls_last(), "id").limit(n)


def counted_event_table(violations: DataFrame, settings: CleanSettings | None = None) -> tuple[DataFrame, int]:
    """Event table and the number of input rows, from one pass over the input."""
    seen = Observation("violations")
    events = event_table(violations.observe(seen, F.count(F.lit(1)).alias("rows")), settings)
    return events, seen.get["rows"]


def sample_of(events: DataFrame, violations: DataFrame, n: int = 5000, settings: CleanSettings | None = None) -> DataFrame:
    """The cleaned sample with all cleaned columns: only the chosen raw rows are cleaned again."""
    chosen = clean_sample(events.select("id"), n)
    raw = violations.join(F.broadcast(chosen.distinct()), "id", "left_semi")  # n ids at most
    return clean_sample(clean_events(raw, settings), n)


def run_summary(input_rows: int, events: DataFrame, scored: DataFrame) -> DataFrame:
    """One record: input rows, rows kept, cells, critical cells and the top cell."""
    top = top_hotspots(scored, 1)
    return scored.agg(
        F.count(F.lit(1)).alias("hotspots"),
        F.count_if(F.col("risk_band") == "Critical").alias("critical_hotspots"),
    ).select(
        F.lit(input_rows).cast("long").alias("input_rows"),
        events.agg(F.count(F.lit(1))).scalar().alias("parking_rows_used"),
        "hotspots",
        "critical_hotspots",
        top.select(F.struct("*")).scalar().alias("top_hotspot"),
    )
