"""Walk-forward back-test of the plain score: all windows in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.functions.numeric import half_even
from kerbscope.operators.features import month_scores, scored_history
from kerbscope.operators.metrics import exact_mean, ranking_quality, with_actual
from kerbscope.operators.windows import MonthlyFacts, monthly_facts, window_labels
from kerbscope.settings import KS
from kerbscope.staging import stage


def actual_scores(scores: DataFrame) -> DataFrame:
    """Scores of the tested months (all but the first), keyed by window."""
    return scores.filter("month_idx >= 2").select(
        F.col("month_idx").alias("window_id"), "grid_id", F.col("score").alias("actual")
    )


def window_sizes(facts: MonthlyFacts) -> DataFrame:
    """Event rows on both sides of each window, from one row per month."""
    months = facts.cells.groupBy("month_idx").agg(
        F.sum("rows").alias("test_rows"), F.count(F.lit(1)).alias("actual_hotspots")
    )
    earlier = Window.orderBy("month_idx").rowsBetween(Window.unboundedPreceding, -1)
    return months.select(
        F.col("month_idx").alias("window_id"),
        F.sum("test_rows").over(earlier).alias("train_rows"),
        "test_rows",
        "actual_hotspots",
    )


def backtest_facts(facts: MonthlyFacts, ks: Sequence[int] = KS) -> DataFrame:
    scores = stage(month_scores(facts), "month-scores")
    actual = actual_scores(scores)
    predicted = scored_history(facts).select(
        "window_id", "grid_id", F.col("congestion_impact_score").alias("predicted")
    )
    base = stage(with_actual(predicted, actual, max(ks)), "backtest")
    predicted_sizes = base.groupBy("window_id").agg(F.count(F.lit(1)).alias("predicted_hotspots"))
    groups = (
        window_labels(facts.index)
        .join(window_sizes(facts), "window_id")
        .join(predicted_sizes, "window_id")
        .select(
            "window_id",
            "train_months",
            "test_month",
            "train_rows",
            "test_rows",
            "predicted_hotspots",
            "actual_hotspots",
        )
    )
    return ranking_quality(base, actual, groups, lambda df: df, ["window_id"], ks).drop("window_id")


def backtest(events: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """One row per test month; no rows with fewer than two months."""
    return backtest_facts(monthly_facts(events), ks)


def metric_means(results: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """Means over the windows, four decimals; windows without a correlation are left out of its mean."""
    names = [f"{m}_at_{k}" for m in ("precision", "ndcg") for k in ks]
    return results.agg(
        F.count(F.lit(1)).alias("backtest_windows"),
        *[
            half_even(exact_mean(c), 4).alias(c)
            for c in ["spearman_score_correlation", *names]
        ],
    )
