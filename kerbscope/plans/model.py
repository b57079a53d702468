"""Blend search, the winner's back-test and the final ranking."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.numeric import half_even
from kerbscope.operators import blending, ordering
from kerbscope.operators.features import month_scores, prediction_features
from kerbscope.operators.metrics import exact_mean, ranking_quality, with_actual
from kerbscope.operators.windows import MonthlyFacts, monthly_facts, window_labels
from kerbscope.plans.backtest import actual_scores
from kerbscope.settings import CANDIDATES, FEATURES, KS
from kerbscope.staging import stage

RANKED_COLUMNS = (
    "grid_id",
    "latitude",
    "longitude",
    "police_station",
    "junction_name",
    "history",
    "peak_hour_weight_score",
    "junction_proximity_score",
    "repeat_hotspot_density_score",
    "last_month",
    "prev_month",
    "station",
    "trend_raw",
    "trend",
    "peak_junction",
)


@dataclass(frozen=True)
class PreparedWindows:
    """Features and actual scores of every window, computed once for all candidates."""

    facts: MonthlyFacts
    features: DataFrame
    scores: DataFrame


def prepare(events: DataFrame) -> PreparedWindows:
    facts = monthly_facts(events)
    scores = stage(month_scores(facts), "month-scores")
    return PreparedWindows(facts, prediction_features(events, facts, scores), scores)


def candidate_backtest(
    prepared: PreparedWindows,
    candidates: Sequence[Sequence[float]] = CANDIDATES,
    ks: Sequence[int] = KS,
) -> DataFrame:
    """Quality per (candidate, window)."""
    actual = actual_scores(prepared.scores)
    features = prepared.features.filter(~F.col("is_final")).select("window_id", "grid_id", *FEATURES)
    base = stage(with_actual(features, actual, max(ks)), "windows")
    numbers = F.array(*[F.lit(i) for i in range(1, len(candidates) + 1)])
    groups = window_labels(prepared.facts.index).withColumn("candidate", F.explode(numbers))
    return ranking_quality(
        base,
        actual,
        groups,
        lambda df: blending.per_candidate(df, candidates),
        ["candidate", "window_id"],
        ks,
    )


def weight_search(detail: DataFrame, candidates: Sequence[Sequence[float]] = CANDIDATES) -> DataFrame:
    return blending.objective(detail, candidates)


def search_top(search: DataFrame, n: int = 30) -> DataFrame:
    return blending.order_candidates(search).limit(n)


def best_candidate(search: DataFrame) -> DataFrame:
    """One row; stays a table, so the winner is joined and never collected."""
    return blending.order_candidates(search).limit(1)


def hybrid_backtest(detail: DataFrame, search: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """The winner's rows of the detail table, without evaluating it again."""
    winner = best_candidate(search).select("candidate").scalar()
    return detail.filter(F.col("candidate") == winner).select(
        "test_month",
        "train_months",
        "common_hotspots",
        "spearman_score_correlation",
        *[f"{m}_at_{k}" for k in ks for m in ("precision", "ndcg")],
    )


def best_blend(hybrid: DataFrame, search: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """Summary record: the winning weights and its metric means (missing correlation counts as 0)."""
    weights = best_candidate(search).select(F.struct(*FEATURES)).scalar()
    names = [f"{m}_at_{k}" for m in ("precision", "ndcg") for k in ks]
    means = hybrid.agg(
        F.count(F.lit(1)).alias("backtest_windows"),
        *[half_even(exact_mean(c), 4).alias(c) for c in names],
        half_even(exact_mean(blending.spearman_or_zero()), 4).alias("spearman_score_correlation"),
    )
    return means.withColumn("best_weights", weights)


def blend_rank(features: DataFrame, weights: DataFrame) -> DataFrame:
    """Rank cells by the blend; ``weights`` is a one-row table of the five weights."""
    w = weights.select(F.struct(*FEATURES)).scalar()
    scored = (
        features.select(*RANKED_COLUMNS)
        .withColumn("_w", w)
        .withColumn("model_priority_score", blending.blend_score(F.col("_w")))
        .drop("_w")
    )
    return ordering.with_rank(scored, "model_priority_score", "model_rank")


def final_ranking(prepared: PreparedWindows, search: DataFrame) -> DataFrame:
    """All months as history, ranked with the winning weights."""
    return blend_rank(prepared.features.filter("is_final"), best_candidate(search))
