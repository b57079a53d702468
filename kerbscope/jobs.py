"""Batch jobs: read, compute, write.

    spark-submit kerbscope/jobs.py hotspots --input <csv or parquet> --output <folder>

The input is the argument, else the ``KERBSCOPE_INPUT`` setting, else
``data/violations.csv`` (for ``views``, the tables in ``outputs``).  ``hotspots``,
``evaluate`` and ``model`` also take the ``cleaned_events`` folder of ``clean``, which is
known by its columns.  Every table becomes a folder under the output and replaces an
older one; ``clean --months-only`` replaces the months that occur in its input.  Records
of a CSV that cannot be used end up in ``rejected_records``, counted by cause in
``rejected_causes``, and the run goes on without them.
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kerbscope.functions.timeformats import infer_formats
from kerbscope.operators.cleaning import clean_events
from kerbscope.operators.profiles import hour_profile, month_hour_profile
from kerbscope.operators.stations import order_stations
from kerbscope.plans import backtest as bt
from kerbscope.plans import model, ranking, views
from kerbscope.settings import FEATURES, INTERPRETATION, KS, CleanSettings
from kerbscope.sources import tables as sinks
from kerbscope.sources.tables import (
    read_csv_table,
    read_or_empty,
    write_csv,
    write_events,
    write_json,
)
from kerbscope.sources.violations import is_csv, land_csv, read_parquet, reject_counts
from kerbscope.staging import remove_staged, stage

DEFAULT_INPUT = "data/violations.csv"
DEFAULT_TABLES = "outputs"


def resolve_input(argument: str | None, default: str = DEFAULT_INPUT) -> str:
    return argument or os.environ.get("KERBSCOPE_INPUT") or default


def _is_cleaned(spark: SparkSession, source: str) -> bool:
    return not is_csv(source) and set(ranking.EVENT_COLUMNS) <= set(spark.read.parquet(source).columns)


@dataclass(frozen=True)
class Source:
    """Raw records, how to clean them, and their number where reading told it."""

    rows: DataFrame
    settings: CleanSettings
    seen: int | None = None


def open_source(spark: SparkSession, source: str, output: str, multi_line: bool | None = None) -> Source:
    """Raw records of a CSV, whose rejected ones are written beside the output, or of a parquet table."""
    settings = CleanSettings()
    if not is_csv(source):
        rows = read_parquet(spark, source)
        return Source(rows, replace(settings, time_formats=infer_formats(rows, "created_datetime")))
    landed = land_csv(spark, source, multi_line)
    write_json(landed.rejects, f"{output}/rejected_records")
    write_json(reject_counts(landed.rejects).orderBy("cause"), f"{output}/rejected_causes")
    return Source(landed.rows, replace(settings, time_formats=landed.time_formats), landed.seen)


def read_events(spark: SparkSession, source: str, output: str, multi_line: bool | None = None) -> DataFrame:
    """Events for a plan: the table of the ``clean`` job as it is, or raw records cleaned once."""
    if _is_cleaned(spark, source):
        return sinks.read_events(spark, source)
    opened = open_source(spark, source, output, multi_line)
    return ranking.event_table(opened.rows, opened.settings)


def run_clean(spark: SparkSession, source: str, output: str, multi_line: bool | None = None, months_only: bool = False) -> None:
    """Cleaned events as parquet by month, which the other jobs take as input, and the input's size."""
    opened = open_source(spark, source, output, multi_line)
    seen = Observation("violations")
    raw = opened.rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    write_events(clean_events(raw, opened.settings), f"{output}/cleaned_events", months_only)
    input_rows = opened.seen if opened.seen is not None else seen.get["rows"]
    record = spark.range(1).select(F.lit(input_rows).cast("long").alias("input_rows"))
    write_json(record, f"{output}/clean_summary")


def _rows_cleaned(spark: SparkSession, source: str) -> int | None:
    """What the ``clean`` job wrote beside its table; null if the table was moved alone."""
    beside = f"{os.path.dirname(source.rstrip('/'))}/clean_summary"
    record = read_or_empty(spark, "input_rows long", lambda reader: reader.json(beside)).first()
    return record["input_rows"] if record else None


HOTSPOT_TABLES = (
    "cleaned_sample_records",
    "hotspot_priority",
    "station_priority_summary",
    "enforcement_shift_plan",
    "month_hour_profile",
)
MODEL_TABLES = ("model_weight_search_top30", "hybrid_model_backtest", "hybrid_model_ranked_hotspots")


def _names(tables: tuple[str, ...]):
    return F.array(*[F.lit(name) for name in tables]).alias("outputs")


def hotspot_summary(input_rows: int | None, events: DataFrame, hot: DataFrame) -> DataFrame:
    return ranking.run_summary(input_rows, events, hot).select("*", _names(HOTSPOT_TABLES))


def run_hotspots(spark: SparkSession, source: str, output: str, multi_line: bool | None = None) -> None:
    """Hotspots, stations, shift plan, profile, sample and the run summary."""
    if _is_cleaned(spark, source):
        cleaned = sinks.read_events(spark, source)
        events, sample = cleaned.select(*ranking.EVENT_COLUMNS), ranking.clean_sample(cleaned)
        input_rows = _rows_cleaned(spark, source)
    else:
        opened = open_source(spark, source, output, multi_line)
        events, input_rows = ranking.counted_event_table(opened.rows, opened.settings)
        sample = ranking.sample_of(events, opened.rows, settings=opened.settings)
        input_rows = opened.seen if opened.seen is not None else input_rows
    hot = stage(ranking.hotspots(events), "hotspots")
    tables = (
        sample.withColumn("violation_items", F.to_json("violation_items")),
        ranking.rank_hotspots(hot).orderBy("priority_rank"),
        order_stations(ranking.station_summary(events, hot)),
        ranking.shift_plan(events, hot),
        month_hour_profile(events).orderBy("month", "hour"),
    )
    for name, table in zip(HOTSPOT_TABLES, tables, strict=True):
        write_csv(table, f"{output}/{name}")
    write_json(hotspot_summary(input_rows, events, hot), f"{output}/run_summary")


def backtest_summary(results: DataFrame, ks=KS) -> DataFrame:
    """One record: method, number of windows, metric means and the rows per month."""
    means = bt.metric_means(results, ks)
    names = [c for c in means.columns if c != "backtest_windows"]
    month = F.struct("test_month", F.struct(*results.columns).alias("row"))
    rows = results.agg(F.transform(F.sort_array(F.collect_list(month)), lambda m: m["row"]))
    return means.select(
        F.lit("walk-forward next-month hotspot backtest").alias("method"),
        "backtest_windows",
        F.struct(*names).alias("metrics_mean"),
        rows.scalar().alias("metrics_by_month"),  # one element per tested month
        F.struct(*[F.lit(text).alias(name) for name, text in INTERPRETATION.items()]).alias("interpretation"),
    )


def run_evaluation(spark: SparkSession, source: str, output: str, multi_line: bool | None = None) -> None:
    """Back-test of the plain score."""
    events = read_events(spark, source, output, multi_line)
    results = stage(bt.backtest(events), "backtest-result")
    write_csv(results.orderBy("test_month"), f"{output}/prediction_quality_backtest")
    summary = backtest_summary(results)
    write_json(summary, f"{output}/prediction_quality_summary")


def model_summary(hybrid: DataFrame, search: DataFrame) -> DataFrame:
    blend = model.best_blend(hybrid, search)
    names = [c for c in blend.columns if c not in ("backtest_windows", "best_weights")]
    return blend.select(
        F.lit("hybrid learned ranking model").alias("model"),
        F.array(*[F.lit(f) for f in FEATURES]).alias("features"),
        "best_weights",
        "backtest_windows",
        F.struct(*names).alias("metrics_mean"),
        _names(MODEL_TABLES),
    )


def run_model(spark: SparkSession, source: str, output: str, multi_line: bool | None = None) -> None:
    """Blend search, the winner's back-test and the final ranking."""
    events = read_events(spark, source, output, multi_line)
    prepared = model.prepare(events)
    detail = stage(model.candidate_backtest(prepared), "candidates")
    search = stage(model.weight_search(detail), "search")
    hybrid = model.hybrid_backtest(detail, search)
    tables = (
        model.search_top(search).drop("candidate"),
        hybrid.orderBy("test_month"),
        model.final_ranking(prepared, search).orderBy("model_rank"),
    )
    for name, table in zip(MODEL_TABLES, tables, strict=True):
        write_csv(table, f"{output}/{name}")
    write_json(model_summary(hybrid, search), f"{output}/hybrid_model_summary")


HOTSPOT_SCHEMA = (
    "priority_rank int, grid_id string, latitude double, longitude double, grid_lat double, "
    "grid_lon double, violation_count bigint, unique_vehicles bigint, impact_sum double, "
    "impact_avg double, peak_hour_share double, junction_share double, active_days bigint, "
    "police_station string, junction_name string, top_vehicle_type string, repeat_density double, "
    + ", ".join(f"{c} double" for c in ranking.COMPONENTS)
    + ", congestion_impact_score double, score_formula string, risk_band string, recommended_action string"
)
STATION_SCHEMA = (
    "police_station string, violation_count bigint, impact_sum double, peak_hour_share double, "
    "junction_share double, unique_hotspots bigint, high_priority_hotspots bigint, "
    "station_priority_score double"
)
SHIFT_SCHEMA = (
    "priority_rank int, grid_id string, latitude double, longitude double, police_station string, "
    "junction_name string, risk_band string, congestion_impact_score double, "
    "best_enforcement_hours string, recommended_action string"
)
PROFILE_SCHEMA = "month string, hour int, violations bigint, impact double"
MODEL_SCHEMA = (
    "model_rank int, grid_id string, latitude double, longitude double, police_station string, "
    "junction_name string, "
    + ", ".join(f"{c} double" for c in model.RANKED_COLUMNS[5:])
    + ", model_priority_score double"
)
HYBRID_SCHEMA = (
    "test_month string, train_months string, common_hotspots bigint, "
    "spearman_score_correlation double, "
    + ", ".join(f"{m}_at_{k} double" for k in KS for m in ("precision", "ndcg"))
)
RUN_SCHEMA = (
    "input_rows bigint, parking_rows_used bigint, hotspots bigint, critical_hotspots bigint, "
    + "top_hotspot struct<"
    + ", ".join(field.replace(" ", ": ") for field in HOTSPOT_SCHEMA.split(", "))
    + ">, outputs array<string>"
)
EVALUATION_SCHEMA = (
    "method string, backtest_windows bigint, metrics_mean struct<spearman_score_correlation: double, "
    + ", ".join(f"{m}_at_{k}: double" for m in ("precision", "ndcg") for k in KS)
    + ">, metrics_by_month array<struct<train_months: string, test_month: string, train_rows: bigint, "
    "test_rows: bigint, predicted_hotspots: bigint, actual_hotspots: bigint, common_hotspots: bigint, "
    "spearman_score_correlation: double, "
    + ", ".join(f"precision_at_{k}: double, hit_count_at_{k}: bigint, ndcg_at_{k}: double" for k in KS)
    + ">>, interpretation struct<"
    + ", ".join(f"{name}: string" for name in INTERPRETATION)
    + ">"
)
SUMMARY_SCHEMA = (
    "model string, features array<string>, best_weights struct<"
    + ", ".join(f"{f}: double" for f in FEATURES)
    + ">, backtest_windows bigint, metrics_mean struct<"
    + ", ".join(f"{m}_at_{k}: double" for m in ("precision", "ndcg") for k in KS)
    + ", spearman_score_correlation: double>, outputs array<string>"
)


def _blank(c: str):
    return F.coalesce(c, F.lit(""))


def run_views(spark: SparkSession, source: str, output: str, multi_line: bool | None = None) -> None:
    """View tables from the written tables; only the model's tables may be absent, and read as empty."""

    def table(name: str, schema: str, optional: bool = False) -> DataFrame:
        return read_csv_table(spark, f"{source}/{name}", schema, optional)

    hot = stage(table("hotspot_priority", HOTSPOT_SCHEMA), "hotspots").drop("priority_rank")
    hot = hot.withColumns({c: _blank(c) for c in ("police_station", "junction_name", "top_vehicle_type")})
    station = table("station_priority_summary", STATION_SCHEMA)
    view = views.hotspot_view(hot)
    summary = read_or_empty(
        spark, SUMMARY_SCHEMA, lambda reader: reader.json(f"{source}/hybrid_model_summary")
    )
    blend = summary.select("metrics_mean.*", "best_weights")
    out = {
        "hotspots": view,
        "stations": views.station_view(station),
        "shifts": views.shift_view(table("enforcement_shift_plan", SHIFT_SCHEMA)),
        "hours": hour_profile(table("month_hour_profile", PROFILE_SCHEMA)).orderBy("hour"),
        "model": views.model_view(table("hybrid_model_ranked_hotspots", MODEL_SCHEMA, optional=True)),
        "backtest": views.backtest_view(table("hybrid_model_backtest", HYBRID_SCHEMA, optional=True)),
        "map_points": views.map_points(view),
        "preview_points": views.preview_points(hot),
        "records": views.record_view(view),
        "station_filter": views.station_filter_list(view),
        "summary_hotspots": views.summary_hotspots(hot),
        "summary_stations": views.summary_stations(station),
        "summary_shifts": views.summary_shifts(table("enforcement_shift_plan", SHIFT_SCHEMA)),
        "kpi": views.kpi_strip(hot, station, blend),
    }
    for name, frame in out.items():
        write_json(frame, f"{output}/views/{name}")


JOBS = {
    "clean": run_clean,
    "hotspots": run_hotspots,
    "evaluate": run_evaluation,
    "model": run_model,
    "views": run_views,
}


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one batch job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--input")
    parser.add_argument("--output", default=DEFAULT_TABLES)
    parser.add_argument("--split-lines", action="store_true", help="split CSV files without looking for line breaks in fields")
    parser.add_argument("--months-only", action="store_true", help="clean: replace the months of the input and keep the others")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.appName(f"kerbscope-{args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    try:
        default = DEFAULT_TABLES if args.job == "views" else DEFAULT_INPUT
        options = {"months_only": True} if args.job == "clean" and args.months_only else {}
        JOBS[args.job](spark, resolve_input(args.input, default), args.output, False if args.split_lines else None, **options)
    finally:
        remove_staged(spark)
        spark.stop()


if __name__ == "__main__":
    main()
