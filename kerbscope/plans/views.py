"""Serving tables behind the command view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.numeric import half_even, sort_value
from kerbscope.operators.scaling import with_bounds
from kerbscope.operators.scoring import COMPONENTS
from kerbscope.operators.stations import order_stations
from kerbscope.plans.ranking import SCORE, top_hotspots
from kerbscope.settings import FEATURES


def _rounded(column: str, digits: int) -> Column:
    return half_even(F.col(column), digits).alias(column)


def _percent(column: str, digits: int = 1) -> Column:
    return half_even(100 * F.col(column), digits).alias(column)


def hotspot_view(scored: DataFrame, n: int = 160) -> DataFrame:
    return top_hotspots(scored, n).select(
        "priority_rank",
        "grid_id",
        "latitude",
        "longitude",
        "police_station",
        "junction_name",
        "violation_count",
        "unique_vehicles",
        _percent("peak_hour_share"),
        _percent("junction_share"),
        _rounded(SCORE, 2),
        *[_rounded(c, 1) for c in COMPONENTS],
        "risk_band",
        "recommended_action",
    )


def station_view(stations: DataFrame, n: int = 20) -> DataFrame:
    return order_stations(stations).limit(n).select(
        "police_station",
        "violation_count",
        "high_priority_hotspots",
        "unique_hotspots",
        _percent("peak_hour_share"),
        _rounded("station_priority_score", 2),
    )


def shift_view(plan: DataFrame, n: int = 40) -> DataFrame:
    return plan.orderBy("priority_rank").limit(n).select(
        "priority_rank",
        "police_station",
        "junction_name",
        "risk_band",
        _rounded(SCORE, 2),
        "best_enforcement_hours",
        "recommended_action",
    )


def summary_hotspots(scored: DataFrame, n: int = 15) -> DataFrame:
    return top_hotspots(scored, n).select(
        "priority_rank",
        "police_station",
        "junction_name",
        "violation_count",
        _rounded(SCORE, 2),
        "risk_band",
        "recommended_action",
    )


def _two_digits(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.select(*[_rounded(c, 2) if c in doubles else c for c in df.columns])


def summary_stations(stations: DataFrame, n: int = 10) -> DataFrame:
    return _two_digits(order_stations(stations).limit(n))


def summary_shifts(plan: DataFrame, n: int = 20) -> DataFrame:
    return _two_digits(plan.orderBy("priority_rank").limit(n))


def model_view(ranked: DataFrame, n: int = 20) -> DataFrame:
    return ranked.orderBy("model_rank").limit(n).select(
        "model_rank",
        "police_station",
        "junction_name",
        _rounded("model_priority_score", 2),
        _rounded("history", 2),
        _rounded("last_month", 2),
    )


def backtest_view(hybrid: DataFrame) -> DataFrame:
    names = ("precision_at_20", "precision_at_50", "precision_at_100", "ndcg_at_50", "spearman_score_correlation")
    return hybrid.select("test_month", *[_rounded(c, 4) for c in names])


def filtered(view: DataFrame, band: str = "All", station: str = "All") -> DataFrame:
    """Equality filters; ``All`` adds no predicate."""
    if band != "All":
        view = view.filter(F.col("risk_band") == band)
    if station != "All":
        view = view.filter(F.col("police_station") == station)
    return view


def map_points(
    view: DataFrame, smallest: float = 10.0, base: float = 6.0, divisor: float = 3.1
) -> DataFrame:
    """Map place in percent and dot size; the span is that of the whole view, however large it is.

    The older preview map is ``map_points(top 120, smallest=8, base=7, divisor=4)``.
    """
    spans = {c: F.col(c) for c in ("latitude", "longitude")}

    def place(c: str) -> Column:
        return (F.col(c) - F.col(f"lo_{c}")) / F.greatest(F.lit(0.000001), F.col(f"hi_{c}") - F.col(f"lo_{c}"))

    size = F.greatest(
        F.lit(smallest), F.least(F.lit(34.0), F.lit(base) + F.col(SCORE) / F.lit(divisor))
    )
    placed = with_bounds(view, spans).withColumns({"x": 5 + 90 * place("longitude"), "y": 95 - 90 * place("latitude"), "dot_size": size})
    return placed.select(*view.columns, "x", "y", "dot_size")


def preview_points(scored: DataFrame, n: int = 120) -> DataFrame:
    """Points of the older preview map: coordinates at six decimals, score at two."""
    points = top_hotspots(scored, n).select(
        "priority_rank",
        _rounded("latitude", 6),
        _rounded("longitude", 6),
        "police_station",
        "junction_name",
        "violation_count",
        _rounded(SCORE, 2),
        "risk_band",
        "recommended_action",
    )
    return map_points(points, smallest=8.0, base=7.0, divisor=4.0)


def record_view(view: DataFrame) -> DataFrame:
    """Record ids such as HP-0001; longer ranks keep all digits."""
    return view.select(
        F.format_string("HP-%04d", "priority_rank").alias("record_id"),
        "junction_name",
        "police_station",
        "risk_band",
        SCORE,
        "recommended_action",
    )


def station_filter_list(view: DataFrame, first: int = 80, n: int = 8) -> DataFrame:
    """Stations in order of first appearance among the first hotspots."""
    head = view.filter(F.col("priority_rank") <= first)
    seen = head.groupBy("police_station").agg(F.min("priority_rank").alias("first_rank"))
    return seen.orderBy("first_rank").limit(n)


def json_feed(view: DataFrame) -> DataFrame:
    """One JSON record per row, null fields kept, text outside ASCII kept as it is."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return view.select(record.alias("record"))


def kpi_strip(
    scored: DataFrame,
    stations: DataFrame,
    blend: DataFrame | None = None,
) -> DataFrame:
    """One row of headline numbers.

    The top station (by station score) and the top junction (of the first
    hotspot) can be different places, so they are separate columns.  Without a
    model the model columns are 0.
    """
    band = F.col("risk_band")
    # The first in ranking order by one aggregate each, so no table is read twice.
    first = F.struct((-sort_value(F.col(SCORE))).alias("s"), "grid_id", "junction_name")
    station = F.struct((-sort_value(F.col("station_priority_score"))).alias("s"), "police_station")
    places = stations.agg(F.count(F.lit(1)).alias("n"), F.min(station).alias("first"))
    base = scored.agg(
        F.sum("violation_count").alias("total_violations"),
        F.count(F.lit(1)).alias("hotspots"),
        F.count_if(band == "Critical").alias("critical"),
        F.count_if(band == "High").alias("high"),
        F.count_if(band == "Medium").alias("medium"),
        F.count_if(band == "Watch").alias("watch"),
        F.max(SCORE).alias("top_score"),
        F.min(first).alias("_first"),
    ).withColumn("_places", places.select(F.struct("n", "first.police_station")).scalar())
    model = ["precision_at_50", "ndcg_at_50", "spearman_score_correlation"]
    if blend is None:
        zero = F.lit(0.0)
        numbers = {"model_" + c: zero for c in model} | {"blend_history": zero, "blend_last_month": zero}
    else:
        summary = blend.select(
            F.struct(*model, F.col("best_weights.history"), F.col("best_weights.last_month"))
        ).scalar()
        base = base.withColumn("_m", summary)
        factor = {"precision_at_50": 100.0, "ndcg_at_50": 100.0, "spearman_score_correlation": 1.0}
        numbers = {
            "model_" + c: F.coalesce(F.col(f"_m.{c}") * f, F.lit(0.0)) for c, f in factor.items()
        } | {
            f"blend_{w}": F.coalesce(100.0 * F.col(f"_m.{w}"), F.lit(0.0))
            for w in FEATURES[:2]
        }
    return base.withColumns(
        {
            "high_or_critical": F.col("high") + F.col("critical"),
            "stations": F.col("_places.n"),
            "top_station": F.col("_places.police_station"),
            "top_junction": F.col("_first.junction_name"),
            **numbers,
        }
    ).drop("_m", "_first", "_places")
