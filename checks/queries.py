"""One query per operator, over the violations made from the given ``events`` table.

Results round computed doubles to six decimals so that two engines whose
logarithms differ in the last bit can be compared; exact values are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.records import leaves
from kerbscope import jobs
from kerbscope.functions.calendar import local_time
from kerbscope.functions.numeric import half_even
from kerbscope.functions.text import with_items
from kerbscope.functions.timeformats import infer_formats
from kerbscope.operators import cells, cleaning, profiles, scaling, shifts, stations, vehicles, weights, windows
from kerbscope.operators.features import (
    history_with_station,
    population_median,
    station_means,
)
from kerbscope.operators.scoring import COMPONENTS
from kerbscope.plans import backtest as bt
from kerbscope.plans import model, ranking, views
from kerbscope.settings import CANDIDATES, FEATURES, KS, CleanSettings
from kerbscope.sources import tables
from kerbscope.sources.event_mapping import read_event_violations
from kerbscope.sources.violations import land_csv, read_violations
from kerbscope.staging import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
SETTINGS = CleanSettings()


def _six(name: str) -> Column:
    return half_even(F.col(name), 6).alias(name)


def violations(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read_event_violations(spark, folder)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_events(violations(spark, folder))


def event_table(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned events as a table, for the plans that pass over them more than once."""
    return ranking.event_table(violations(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.hotspots(event_table(spark, folder))


# ------------------------------------------------------------------- cleaning


def clean_events(spark, folder):
    weights = ("violation_severity", "vehicle_pcu", "junction_weight", "peak_weight", "incident_impact")
    return events(spark, folder).select(
        "id",
        F.date_format("created_at_ist", "yyyy-MM-dd HH:mm:ss").alias("created_at_ist"),
        F.array_join("violation_items", " | ").alias("violation_items"),
        "parking_violation",
        "date",
        "month",
        "weekday",
        "hour",
        "is_peak_hour",
        "is_weekend",
        "near_junction",
        *[F.col(w).cast("double").alias(w) for w in weights],
        "grid_lat",
        "grid_lon",
        "grid_id",
    )


def parse_items(spark, folder):
    parsed = with_items(violations(spark, folder), "violation_type", "parsed")
    return parsed.select(
        "id", F.array_join("parsed", " | ").alias("items"), F.size("parsed").alias("n_items")
    )


def calendar_features(spark, folder):
    complete = cleaning.keep_complete(violations(spark, folder), SETTINGS)
    return cleaning.add_calendar(complete, SETTINGS).select(
        "id", "date", "month", "weekday", "hour", "is_peak_hour", "is_weekend"
    )


def junction_flag(spark, folder):
    return violations(spark, folder).select(
        "id", F.expr(cleaning.junction_flag("junction_name")).alias("near_junction")
    )


def incident_impact(spark, folder):
    names = ("violation_severity", "vehicle_pcu", "junction_weight", "peak_weight", "incident_impact")
    return events(spark, folder).select("id", *[F.col(n).cast("double").alias(n) for n in names])


def grid_bins(spark, folder):
    located = violations(spark, folder).dropna(subset=["latitude", "longitude"])
    return cleaning.add_cells(located).select("id", "grid_lat", "grid_lon", "grid_id")


def clean_sample(spark, folder):
    return ranking.clean_sample(events(spark, folder)).select(
        "id", "date", "hour", "grid_id", F.col("incident_impact").cast("double").alias("incident_impact")
    )


# ----------------------------------------------------------- cells and scores


def hotspot_rollup(spark, folder):
    return cells.hotspot_cells(event_table(spark, folder)).select(
        "grid_id",
        "latitude",
        "longitude",
        "grid_lat",
        "grid_lon",
        "violation_count",
        "unique_vehicles",
        _six("impact_sum"),
        _six("impact_avg"),
        _six("peak_hour_share"),
        _six("junction_share"),
        "active_days",
    )


def hotspot_modes(spark, folder):
    modes = cells.cell_modes(events(spark, folder))
    return modes.select("grid_id", *[F.coalesce(m, F.lit("")).alias(m) for m in cells.MODES])


def minmax_scale(spark, folder):
    totals = stage(cells.rates(cells.cell_totals(events(spark, folder))), "cell-totals")
    inputs = {
        "scaled_count": F.col("violation_count").cast("double"),
        "scaled_impact": F.col("impact_sum"),
        "scaled_constant": F.col("violation_count") * F.lit(0.0),
    }
    return scaling.minmax(totals, inputs, factor=1.0).select("grid_id", *[_six(c) for c in inputs])


def hotspot_scores(spark, folder):
    return scored(spark, folder).select("grid_id", _six("repeat_density"), *[_six(c) for c in COMPONENTS])


def risk_bands(spark, folder):
    return scored(spark, folder).select(
        "grid_id", _six(ranking.SCORE), "risk_band", "recommended_action"
    )


def hotspot_ranked(spark, folder):
    return (
        ranking.rank_hotspots(scored(spark, folder))
        .orderBy("priority_rank")
        .select(
            "priority_rank",
            "grid_id",
            "latitude",
            "longitude",
            "violation_count",
            "unique_vehicles",
            "active_days",
            "police_station",
            "junction_name",
            "top_vehicle_type",
            _six(ranking.SCORE),
            "score_formula",
            "risk_band",
            "recommended_action",
        )
    )


# -------------------------------------------------------------------- rollups


def _station_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "police_station",
        "violation_count",
        _six("impact_sum"),
        _six("peak_hour_share"),
        _six("junction_share"),
        "unique_hotspots",
        *more,
    )


def station_rollup(spark, folder):
    return _station_columns(stations.station_rollup(events(spark, folder)))


def _station_summary(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    cleaned = event_table(spark, folder)
    hot = ranking.hotspots(cleaned)
    return cleaned, hot, ranking.station_summary(cleaned, hot)


def station_priority(spark, folder):
    _, _, summary = _station_summary(spark, folder)
    return _station_columns(
        stations.order_stations(summary), "high_priority_hotspots", _six("station_priority_score")
    )


def grid_hour(spark, folder):
    cleaned = event_table(spark, folder)
    top = ranking.top_hotspots(ranking.hotspots(cleaned), 40)
    return shifts.grid_hours(cleaned, top).select(
        "grid_id", "hour", "events", half_even(F.col("impact").cast("double"), 6).alias("impact")
    )


def _plan(spark, folder) -> DataFrame:
    cleaned = event_table(spark, folder)
    return ranking.shift_plan(cleaned, ranking.hotspots(cleaned))


def shift_plan(spark, folder):
    return _plan(spark, folder)


def month_hour_profile(spark, folder):
    return profiles.month_hour_profile(events(spark, folder)).select(
        "month", "hour", "violations", _six("impact")
    )


def hour_profile(spark, folder):
    hours = profiles.hour_profile(profiles.month_hour_totals(events(spark, folder)))
    return hours.select("hour", "violations", "impact", _six("bar_width"))


def run_summary(spark, folder):
    raw = violations(spark, folder)
    cleaned, input_rows = ranking.counted_event_table(raw)
    summary = ranking.run_summary(input_rows, cleaned, ranking.hotspots(cleaned))
    top = "top_hotspot."
    return summary.select(
        "input_rows",
        "parking_rows_used",
        "hotspots",
        "critical_hotspots",
        F.col(top + "grid_id").alias("top_grid_id"),
        F.col(top + "violation_count").alias("top_violation_count"),
        F.col(top + "unique_vehicles").alias("top_unique_vehicles"),
        F.col(top + "police_station").alias("top_police_station"),
        half_even(F.col(top + ranking.SCORE), 6).alias("top_score"),
        F.col(top + "risk_band").alias("top_risk_band"),
    )


# ----------------------------------------------------------- windows, metrics


def month_index(spark, folder):
    return windows.month_index(events(spark, folder))


def walk_forward_windows(spark, folder):
    return windows.walk_forward_windows(windows.month_index(events(spark, folder)))


def _backtest(spark, folder) -> DataFrame:
    return bt.backtest(events(spark, folder))


def backtest(spark, folder):
    return _backtest(spark, folder)


def precision_at_k(spark, folder):
    names = [f"{m}_at_{k}" for k in KS for m in ("precision", "hit_count")]
    return _backtest(spark, folder).select("test_month", *names)


def ndcg_at_k(spark, folder):
    return _backtest(spark, folder).select("test_month", *[f"ndcg_at_{k}" for k in KS])


def spearman(spark, folder):
    return _backtest(spark, folder).select(
        "test_month", "common_hotspots", "spearman_score_correlation"
    )


def metric_means(spark, folder):
    return bt.metric_means(_backtest(spark, folder))


# ---------------------------------------------------------------------- model


def station_context(spark, folder):
    cleaned = event_table(spark, folder)
    history = stage(history_with_station(cleaned, windows.monthly_facts(cleaned)), "history")
    medians = population_median(history, "history")
    return (
        station_means(history)
        .join(F.broadcast(medians), "window_id")  # one row per window
        .select("window_id", "police_station", _six("station"), _six("median_score"))
    )


def feature_scale(spark, folder):
    prepared = model.prepare(event_table(spark, folder))
    return prepared.features.select("window_id", "grid_id", *[_six(f) for f in FEATURES])


def prediction_features(spark, folder):
    prepared = model.prepare(event_table(spark, folder))
    exact = ("grid_id", "latitude", "longitude", "police_station", "junction_name")
    return prepared.features.select(
        "window_id", *[c if c in exact else _six(c) for c in model.RANKED_COLUMNS]
    )


def _weights_row(spark: SparkSession, candidate: int) -> DataFrame:
    schema = ", ".join(f"{f} double" for f in FEATURES)
    return spark.createDataFrame([CANDIDATES[candidate - 1]], schema)


def _ranked(df: DataFrame) -> DataFrame:
    exact = ("grid_id", "latitude", "longitude", "police_station", "junction_name")
    return df.orderBy("model_rank").select(
        "model_rank",
        *[c if c in exact else _six(c) for c in model.RANKED_COLUMNS],
        _six("model_priority_score"),
    )


def blend_rank(spark, folder):
    prepared = model.prepare(event_table(spark, folder))
    final = prepared.features.filter("is_final")
    return _ranked(model.blend_rank(final, _weights_row(spark, 6)))


def _search(spark, folder) -> tuple[model.PreparedWindows, DataFrame, DataFrame]:
    prepared = model.prepare(event_table(spark, folder))
    detail = stage(model.candidate_backtest(prepared), "candidates")
    return prepared, detail, model.weight_search(detail)


def weight_search(spark, folder):
    _, _, search = _search(spark, folder)
    names = ("objective", "precision_at_50", "ndcg_at_50", "spearman")
    return model.search_top(search).select(*FEATURES, *[_six(c) for c in names])


def best_blend(spark, folder):
    _, detail, search = _search(spark, folder)
    blend = model.best_blend(model.hybrid_backtest(detail, search), search)
    return blend.select(*[F.col(f"best_weights.{f}").alias(f) for f in FEATURES], *blend.columns[:-1])


def hybrid_backtest(spark, folder):
    _, detail, search = _search(spark, folder)
    return model.hybrid_backtest(detail, search)


def final_ranking(spark, folder):
    prepared, _, search = _search(spark, folder)
    return _ranked(model.final_ranking(prepared, search))


# ---------------------------------------------------------------------- views


def view_hotspots(spark, folder):
    return views.hotspot_view(scored(spark, folder))


def view_stations(spark, folder):
    return views.station_view(_station_summary(spark, folder)[2])


def view_shifts(spark, folder):
    return views.shift_view(_plan(spark, folder))


def summary_hotspots(spark, folder):
    return views.summary_hotspots(scored(spark, folder))


def summary_stations(spark, folder):
    return views.summary_stations(_station_summary(spark, folder)[2])


def summary_shifts(spark, folder):
    return views.summary_shifts(_plan(spark, folder))


def view_model(spark, folder):
    prepared, _, search = _search(spark, folder)
    return views.model_view(model.final_ranking(prepared, search))


def view_backtest(spark, folder):
    _, detail, search = _search(spark, folder)
    return views.backtest_view(model.hybrid_backtest(detail, search))


def view_filtered(spark, folder):
    view = views.hotspot_view(scored(spark, folder))
    return views.filtered(view, band="Medium", station="STN1").select(
        "priority_rank", "grid_id", "police_station", ranking.SCORE, "risk_band"
    )


def view_map_points(spark, folder):
    points = views.map_points(views.hotspot_view(scored(spark, folder)))
    return points.select("priority_rank", "grid_id", _six("x"), _six("y"), _six("dot_size"))


def view_preview_points(spark, folder):
    points = views.preview_points(scored(spark, folder))
    made = ("x", "y", "dot_size")
    return points.select(*[_six(c) if c in made else c for c in points.columns])


def view_records(spark, folder):
    return views.record_view(views.hotspot_view(scored(spark, folder)))


def station_filter_list(spark, folder):
    return views.station_filter_list(views.hotspot_view(scored(spark, folder)))


def view_json_feed(spark, folder):
    return views.json_feed(views.record_view(views.hotspot_view(scored(spark, folder))))


def kpi_strip(spark, folder):
    cleaned, hot, summary = _station_summary(spark, folder)
    prepared = model.prepare(cleaned)
    detail = stage(model.candidate_backtest(prepared), "candidates")
    search = model.weight_search(detail)
    blend = model.best_blend(model.hybrid_backtest(detail, search), search)
    strip = views.kpi_strip(hot, summary, blend)
    doubles = [f.name for f in strip.schema.fields if f.dataType.simpleString() == "double"]
    return strip.select(*[_six(c) if c in doubles else c for c in strip.columns])


def csv_scan(spark, folder):
    """Raw records through a CSV file, with line breaks, quotes, commas and missing marks in them."""
    odd = {
        0: 'MAIN\nROAD "EAST", 2',
        1: "NA",
        2: "n/a",
        3: "A, B",
        4: 'say "no"',
        5: " blank ends ",
        6: "null",
    }
    rule = F.lit(None).cast("string")
    for k, text in odd.items():
        rule = F.when(F.col("id") % 13 == k, F.lit(text)).otherwise(rule)
    raw = violations(spark, folder)
    path = f"{new_path(spark, 'violations')}.csv"
    tables.write_csv(raw.withColumn("junction_name", F.when(F.col("id") % 13 > 6, F.col("junction_name")).otherwise(rule)), path)
    return read_violations(spark, path)


def calendar_formats(spark, folder):
    """Three time columns, each written in one form but for a few strays, and each read by its own first value.

    Every 41st time of the day-first column is in ISO form and every 43rd of the
    month-first one is day first; a column's format does not read them.
    """
    at = F.col("created_datetime").try_cast("timestamp")
    usual = {"day_first": "dd/MM/yyyy HH:mm", "month_first": "MM/dd/yyyy hh:mm:ss a"}
    strays = {"day_first": (41, "yyyy-MM-dd HH:mm:ss"), "month_first": (43, "dd/MM/yyyy HH:mm")}
    columns = {"iso": F.col("created_datetime")}
    for name, form in usual.items():
        step, stray = strays[name]
        columns[name] = F.when(F.col("id") % step == step - 1, F.date_format(at, stray)).otherwise(F.date_format(at, form))
    table = violations(spark, folder).select("id", *[c.alias(n) for n, c in columns.items()])
    out = [F.col("id")]
    for name in columns:
        formats = infer_formats(table, name, by=F.col("id"))
        local = F.expr(local_time(name, SETTINGS.zone, formats))
        out += [F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias(name), F.lit(formats[0]).alias(f"{name}_format")]
    return table.select(*out)


def csv_rejects(spark, folder):
    """A CSV with damaged records, text ids and short records: the sound rows and the rejected ones with their cause."""
    raw = violations(spark, folder)
    key = F.when(F.col("id") % 67 == 4, F.concat(F.lit("X"), "id")).otherwise(F.col("id").cast("string"))
    north = F.when(F.col("id") % 59 == 2, F.lit("north")).otherwise(F.col("latitude").cast("string"))
    line = F.to_csv(F.struct(key.alias("id"), "created_datetime", north.alias("latitude"), *raw.columns[3:]), {"escape": "\""})
    line = F.when(F.col("id") % 53 == 1, F.concat(line, F.lit(",one,more"))).otherwise(line)
    line = F.when(F.col("id") % 61 == 3, F.concat_ws(",", key, F.lit(""))).otherwise(line)
    path = f"{new_path(spark, 'damaged')}.csv"
    # One column whose name is the header, written as it is.
    raw.select(line.alias(",".join(raw.columns))).write.options(header=True, sep="\x01", quote="").csv(path)
    landed = land_csv(spark, path)
    sound = landed.rows.select("id", "latitude", "junction_name", F.lit(None).cast("string").alias("cause"))
    number = F.coalesce(F.get_json_object("record", "$.id"), F.regexp_extract("record", "^([^,]*),", 1))
    none = [F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("string").alias("junction_name")]
    return sound.unionByName(landed.rejects.select(number.alias("id"), *none, "cause"))


def sink_events_by_month(spark, folder):
    """All cleaned events by month, then a corrected last month alone: the other months stay."""
    cleaned = events(spark, folder).select("id", "date", "month", "hour", "grid_id", "vehicle_type")
    path = new_path(spark, "events-by-month")
    tables.write_events(cleaned, path)
    latest = tables.read_events(spark, path).agg(F.max("month")).first()[0]
    corrected = cleaned.where((F.col("month") == latest) & (F.col("id") % 2 == 0))
    tables.write_events(corrected.withColumn("vehicle_type", F.lit("CORRECTED")), path, months_only=True)
    return tables.read_events(spark, path)


def vehicles_approx(spark, folder):
    """Vehicles of each cell before each window: the exact count, and whether the sketch is within the bound."""
    cleaned = event_table(spark, folder)
    index = stage(windows.month_index(cleaned), "months")
    exact = vehicles.history_vehicles(cleaned, index)
    approx = vehicles.history_vehicles_approx(stage(vehicles.monthly_sketches(cleaned), "sketches"), index)
    off = F.abs(F.col("approx_vehicles") - F.col("unique_vehicles"))
    near = off <= F.greatest(F.lit(1.0), vehicles.ERROR_BOUND * F.col("unique_vehicles"))
    return exact.join(approx, ["window_id", "grid_id"], "full").select("window_id", "grid_id", "unique_vehicles", F.coalesce(near, F.lit(False)).alias("within_bound"))


def incident_impact_by_table(spark, folder):
    """As ``incident_impact``, with the weights of two tables."""

    def table(pairs: dict[str, str], key: str) -> DataFrame:
        return weights.weight_table(spark.createDataFrame(list(pairs.items()), f"{key} string, weight string"), key, "weight")

    by_table = weights.WeightTables(table(SETTINGS.severity, "violation"), table(SETTINGS.footprint, "vehicle"))
    names = ("violation_severity", "vehicle_pcu", "junction_weight", "peak_weight", "incident_impact")
    return cleaning.clean_events(violations(spark, folder), SETTINGS, by_table).select("id", *[F.col(n).cast("double").alias(n) for n in names])


def _written_record(spark, record: DataFrame, schema: str) -> DataFrame:
    """A nested record written as JSON and read back by its declared schema, leaf by leaf."""
    path = new_path(spark, "record")
    tables.write_json(record, path)
    return leaves(spark.read.schema(schema).json(path))


def run_record(spark, folder):
    cleaned, input_rows = ranking.counted_event_table(violations(spark, folder))
    return _written_record(spark, jobs.hotspot_summary(input_rows, cleaned, stage(ranking.hotspots(cleaned), "hotspots")), jobs.RUN_SCHEMA)


def evaluation_record(spark, folder):
    return _written_record(spark, jobs.backtest_summary(stage(_backtest(spark, folder), "backtest")), jobs.EVALUATION_SCHEMA)


def model_record(spark, folder):
    _, detail, search = _search(spark, folder)
    return _written_record(spark, jobs.model_summary(model.hybrid_backtest(detail, search), search), jobs.SUMMARY_SCHEMA)


def _through_csv(name: str, query: Query) -> Query:
    """The table of another query, written and read back."""

    def run(spark, folder):
        table = query(spark, folder)
        path = new_path(spark, name)
        tables.write_csv(table, path)
        return tables.read_csv_table(spark, path, table.schema)

    return run


#: Tables that the jobs write; each is compared whole after writing and reading.
SINKS = ("hotspot_ranked", "station_priority", "shift_plan", "month_hour_profile", "backtest", "weight_search", "final_ranking")


def sink_roundtrip(spark, folder):
    """Profile, plan and hotspot tables through CSV, and a table that was never written."""
    cleaned, hot, _ = _station_summary(spark, folder)
    written = {
        "enforcement_shift_plan": ranking.shift_plan(cleaned, hot),
        "month_hour_profile": profiles.month_hour_profile(cleaned),
        "hotspot_priority": hot,
    }
    sizes = []
    for name, table in written.items():
        path = new_path(spark, name)
        tables.write_csv(table, path)
        again = tables.read_csv_table(spark, path, table.schema)
        sizes.append(again.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")))
        if name == "enforcement_shift_plan":
            cell_ids = again.filter(F.col("grid_id").contains(",")).agg(
                F.lit("quoted_grid_id").alias("table_name"), F.count(F.lit(1)).alias("n_rows")
            )
            sizes.append(cell_ids)
    absent = tables.read_csv_table(spark, new_path(spark, "absent"), hot.schema, optional=True)
    sizes.append(absent.agg(F.lit("absent").alias("table_name"), F.count(F.lit(1)).alias("n_rows")))
    out = sizes[0]
    for part in sizes[1:]:
        out = out.unionByName(part)
    return out


def all_queries() -> dict[str, Query]:
    found = _plain_queries()
    return found | {f"sink_{name}": _through_csv(name, found[name]) for name in SINKS}


def _plain_queries() -> dict[str, Query]:
    return {
        "csv_scan": csv_scan,
        "clean_events": clean_events,
        "parse_items": parse_items,
        "calendar_features": calendar_features,
        "junction_flag": junction_flag,
        "incident_impact": incident_impact,
        "grid_bins": grid_bins,
        "clean_sample": clean_sample,
        "hotspot_rollup": hotspot_rollup,
        "hotspot_modes": hotspot_modes,
        "minmax_scale": minmax_scale,
        "hotspot_scores": hotspot_scores,
        "risk_bands": risk_bands,
        "hotspot_ranked": hotspot_ranked,
        "station_rollup": station_rollup,
        "station_priority": station_priority,
        "grid_hour": grid_hour,
        "shift_plan": shift_plan,
        "month_hour_profile": month_hour_profile,
        "hour_profile": hour_profile,
        "kpi_strip": kpi_strip,
        "run_summary": run_summary,
        "month_index": month_index,
        "walk_forward_windows": walk_forward_windows,
        "precision_at_k": precision_at_k,
        "ndcg_at_k": ndcg_at_k,
        "spearman": spearman,
        "backtest": backtest,
        "metric_means": metric_means,
        "station_context": station_context,
        "feature_scale": feature_scale,
        "prediction_features": prediction_features,
        "blend_rank": blend_rank,
        "weight_search": weight_search,
        "best_blend": best_blend,
        "hybrid_backtest": hybrid_backtest,
        "final_ranking": final_ranking,
        "view_hotspots": view_hotspots,
        "view_stations": view_stations,
        "view_shifts": view_shifts,
        "summary_hotspots": summary_hotspots,
        "summary_stations": summary_stations,
        "summary_shifts": summary_shifts,
        "view_model": view_model,
        "view_backtest": view_backtest,
        "view_filtered": view_filtered,
        "view_map_points": view_map_points,
        "view_preview_points": view_preview_points,
        "view_records": view_records,
        "view_json_feed": view_json_feed,
        "station_filter_list": station_filter_list,
        "sink_roundtrip": sink_roundtrip,
        "calendar_formats": calendar_formats,
        "csv_rejects": csv_rejects,
        "sink_events_by_month": sink_events_by_month,
        "vehicles_approx": vehicles_approx,
        "incident_impact_by_table": incident_impact_by_table,
        "run_record": run_record,
        "evaluation_record": evaluation_record,
        "model_record": model_record,
    }
