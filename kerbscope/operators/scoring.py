"""Cell scores, priority score, bands and actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.operators.scaling import minmax
from kerbscope.settings import BANDS, SCORE_FORMULA

COMPONENTS = (
    "parking_violation_frequency_score",
    "repeat_hotspot_density_score",
    "junction_proximity_score",
    "peak_hour_weight_score",
    "vehicle_blockage_score",
    "parking_violation_density_score",
    "estimated_speed_drop_score",
    "road_occupancy_score",
    "road_importance_score",
)


def _banded(score: Column, column: int) -> Column:
    out = None
    for entry in BANDS:
        if entry[1] is None:
            return out.otherwise(F.lit(entry[column]))
        reached = ~F.isnan(score) & (score >= F.lit(float(entry[1])))
        label = F.lit(entry[column])
        out = F.when(reached, label) if out is None else out.when(reached, label)
    return out


def risk_band(score: Column) -> Column:
    """Critical, High, Medium or Watch; a missing score is Watch."""
    return _banded(score, 0)


def enforcement_action(score: Column) -> Column:
    return _banded(score, 2)


def score_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Component scores and the priority score, scaled within each ``by`` population."""
    density = F.col("violation_count") / F.greatest(F.col("active_days"), F.lit(1))
    slow = F.log1p("impact_sum") * (0.65 + 0.35 * F.col("peak_hour_share"))
    scaled = minmax(
        cells.withColumn("repeat_density", density),
        {
            "parking_violation_frequency_score": F.log1p("violation_count"),
            "repeat_hotspot_density_score": F.col("repeat_density"),
            "vehicle_blockage_score": F.col("impact_avg"),
            "estimated_speed_drop_score": slow,
        },
        by,
    )
    named = scaled.withColumns(
        {
            "junction_proximity_score": 100 * F.col("junction_share"),
            "peak_hour_weight_score": 100 * F.col("peak_hour_share"),
            "parking_violation_density_score": F.col("parking_violation_frequency_score"),
            "road_occupancy_score": F.col("vehicle_blockage_score"),
        }
    ).withColumn("road_importance_score", F.col("junction_proximity_score"))
    priority = (
        0.40 * F.col("parking_violation_frequency_score")
        + 0.25 * F.col("repeat_hotspot_density_score")
        + 0.15 * F.col("junction_proximity_score")
        + 0.10 * F.col("peak_hour_weight_score")
        + 0.10 * F.col("vehicle_blockage_score")
    )
    return named.withColumn("congestion_impact_score", priority)


def classify(scored: DataFrame) -> DataFrame:
    score = F.col("congestion_impact_score")
    return scored.withColumns(
        {
            "score_formula": F.lit(SCORE_FORMULA),
            "risk_band": risk_band(score),
            "recommended_action": enforcement_action(score),
        }
    )
