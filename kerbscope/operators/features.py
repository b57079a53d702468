"""Prediction features per (window, cell)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.operators.ordering import running_total
from kerbscope.operators.scaling import feature_minmax
from kerbscope.operators.scoring import score_cells
from kerbscope.operators.windows import (
    MonthlyFacts,
    history_modes,
    history_population,
    month_population,
)
from kerbscope.settings import FEATURES
from kerbscope.staging import stage


def month_scores(facts: MonthlyFacts) -> DataFrame:
    """(month_idx, grid_id, score): each month scored within its own population."""
    return score_cells(month_population(facts), ["month_idx"]).select(
        "month_idx", "grid_id", F.col("congestion_impact_score").alias("score")
    )


def scored_history(facts: MonthlyFacts, final: bool = False) -> DataFrame:
    return score_cells(history_population(facts, final), ["window_id"])


def station_means(history: DataFrame, by: tuple[str, ...] = ("window_id",)) -> DataFrame:
    """Mean cell score per modal station; partial sums, so a dominant station is no hot spot."""
    return history.groupBy(*by, "police_station").agg(F.avg("history").alias("station"))


def population_median(table: DataFrame, value: str, by: tuple[str, ...] = ("window_id",)) -> DataFrame:
    """Exact median of ``value`` per population from value counts and their running total."""
    counts = table.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    placed = running_total(counts, F.col("n"), [F.col(value)], "through", by)
    sizes = table.groupBy(*by).agg(F.count(value).alias("total"))  # one row per population
    middle = placed.join(F.broadcast(sizes), list(by)).filter(
        (F.col("through") - F.col("n") < F.floor(F.col("total") / 2) + 1)
        & (F.col("through") >= F.floor((F.col("total") + 1) / 2))
    )
    return middle.groupBy(*by).agg(
        ((F.min(value) + F.max(value)) / 2).alias("median_score")
    )


def history_with_station(events: DataFrame, facts: MonthlyFacts) -> DataFrame:
    """Scored history of every window (the final one too) with its modal names."""
    modes = history_modes(events, facts.index)
    scored = scored_history(facts, final=True)
    return scored.join(modes, ["window_id", "grid_id"], "left").select(
        "window_id",
        (F.col("window_id") > F.col("n_months")).alias("is_final"),
        "grid_id",
        "latitude",
        "longitude",
        F.coalesce("police_station", F.lit("")).alias("police_station"),
        F.coalesce("junction_name", F.lit("")).alias("junction_name"),
        F.col("congestion_impact_score").alias("history"),
        "peak_hour_weight_score",
        "junction_proximity_score",
        "repeat_hotspot_density_score",
    )


def _as_of(scores: DataFrame, months_back: int, name: str) -> DataFrame:
    return scores.select(
        (F.col("month_idx") + months_back).alias("window_id"), "grid_id", F.col("score").alias(name)
    )


def prediction_features(events: DataFrame, facts: MonthlyFacts, scores: DataFrame) -> DataFrame:
    """Five features per (window, cell), each 0..100 within its window.

    A cell whose station has no mean takes the median score of its window.
    """
    history = stage(history_with_station(events, facts), "history")
    return features_of(history, station_means(history), scores)


def features_of(history: DataFrame, means: DataFrame, scores: DataFrame) -> DataFrame:
    """The median is worked out only if a station has no mean, which the written table tells at once."""
    joined = (
        history.join(_as_of(scores, 1, "last_month"), ["window_id", "grid_id"], "left")
        .join(_as_of(scores, 2, "prev_month"), ["window_id", "grid_id"], "left")
        .fillna(0.0, subset=["last_month", "prev_month"])
        .join(means, ["window_id", "police_station"], "left")
    )
    trend = F.col("last_month") - F.col("prev_month")
    peak_junction = 0.55 * F.col("peak_hour_weight_score") + 0.45 * F.col("junction_proximity_score")
    raw = stage(joined.withColumns({"trend_raw": trend, "trend": trend, "peak_junction": peak_junction}), "features")
    if not raw.where("station IS NULL").isEmpty():
        medians = population_median(history, "history")
        raw = raw.join(medians, "window_id").withColumn("station", F.coalesce("station", "median_score")).drop("median_score")
        raw = stage(raw, "features")
    return feature_minmax(raw, FEATURES, ["window_id"])
