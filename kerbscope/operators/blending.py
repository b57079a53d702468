"""Feature blends: candidate weights, blend score, objective and choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.numeric import sort_value
from kerbscope.operators.metrics import exact_mean
from kerbscope.settings import CANDIDATES, FEATURES


def candidate_array(candidates: Sequence[Sequence[float]] = CANDIDATES) -> Column:
    """Literal array of (candidate, weights): the parameter list itself, not data."""
    rows = []
    for number, weights in enumerate(candidates, start=1):
        fields = [f"'{f}', {float(w)!r}D" for f, w in zip(FEATURES, weights, strict=True)]
        rows.append(f"named_struct('candidate', {number}, {', '.join(fields)})")
    return F.expr(f"array({', '.join(rows)})")


def blend_score(weight: Column) -> Column:
    """Weighted sum of the feature columns; ``weight`` is a struct with one field per feature."""
    total = F.lit(0.0)
    for f in FEATURES:
        total = total + F.col(f) * weight[f]
    return total


def per_candidate(features: DataFrame, candidates: Sequence[Sequence[float]] = CANDIDATES) -> DataFrame:
    """Every row once per candidate, with the candidate's blend score as ``predicted``."""
    fanned = features.withColumn("_w", F.explode(candidate_array(candidates)))
    return fanned.withColumns(
        {"candidate": F.col("_w.candidate"), "predicted": blend_score(F.col("_w"))}
    ).drop("_w")


def spearman_or_zero() -> Column:
    return F.coalesce("spearman_score_correlation", F.lit(0.0))


def objective(
    results: DataFrame, candidates: Sequence[Sequence[float]] = CANDIDATES
) -> DataFrame:
    """One row per candidate: weights, objective and the metric means behind it."""
    means = results.groupBy("candidate").agg(
        exact_mean("ndcg_at_50").alias("ndcg_at_50"),
        exact_mean("precision_at_50").alias("precision_at_50"),
        exact_mean(spearman_or_zero()).alias("spearman"),
        exact_mean("precision_at_100").alias("precision_at_100"),
    )
    score = (
        0.45 * F.col("ndcg_at_50")
        + 0.25 * F.col("precision_at_50")
        + 0.20 * F.col("spearman")
        + 0.10 * F.col("precision_at_100")
    )
    weight = F.get(candidate_array(candidates), F.col("candidate") - 1)
    return means.select(
        "candidate",
        *[weight[f].alias(f) for f in FEATURES],
        score.alias("objective"),
        "precision_at_50",
        "ndcg_at_50",
        "spearman",
    )


def order_candidates(search: DataFrame) -> DataFrame:
    """Best objective first; equal objectives keep the candidate order."""
    return search.orderBy(sort_value(F.col("objective")).desc(), "candidate")
