"""Ranking quality: Precision@k, NDCG@k and Spearman per window.

The input ``base`` has one row per (window, predicted cell) with the cell's
actual next-month score and its place in the actual top list, both null where
the cell did not occur.  Everything after that is grouped: the top lists are cut
to k rows per group inside the map tasks, the sums combine map-side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.numeric import half_even, sort_value
from kerbscope.operators.ordering import average_rank, top_per_group

WINDOW = "window_id"


def discounted(gain: Column, position: Column) -> Column:
    return gain / F.log2(position + 1)


def dcg(gain: str, position: str, k: int) -> Column:
    """Aggregate: discounted gain of the first k places; 0 for no rows."""
    inside = F.when(F.col(position) <= k, discounted(F.col(gain), F.col(position)))
    return F.coalesce(F.sum(inside), F.lit(0.0))


def pearson(x: str, y: str) -> Column:
    """Aggregate: correlation, null for a constant side (``corr`` fails there)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def actual_top(actual: DataFrame, k: int) -> DataFrame:
    """The k best actual cells of each window, at most windows x k rows."""
    return top_per_group(actual, [WINDOW], "actual", k, "actual_position")


def with_actual(predicted: DataFrame, actual: DataFrame, k: int) -> DataFrame:
    top = actual_top(actual, k).select(WINDOW, "grid_id", "actual_position")
    placed = actual.join(F.broadcast(top), [WINDOW, "grid_id"], "left")
    return predicted.join(placed, [WINDOW, "grid_id"], "left")


def top_list_quality(scored: DataFrame, by: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """DCG and hits of the predicted top k per group."""
    top = top_per_group(scored, by, "predicted", max(ks), "position")
    gains = top.withColumn("gain", F.coalesce("actual", F.lit(0.0)))
    aggregates = []
    for k in ks:
        hit = (F.col("position") <= k) & (F.col("actual_position") <= k)
        aggregates += [
            dcg("gain", "position", k).alias(f"dcg_{k}"),
            F.count_if(hit).alias(f"hit_count_at_{k}"),
        ]
    return gains.groupBy(*by).agg(*aggregates)


def ideal_quality(actual: DataFrame, ks: Sequence[int]) -> DataFrame:
    ideal = actual_top(actual, max(ks))
    return ideal.groupBy(WINDOW).agg(
        *[dcg("actual", "actual_position", k).alias(f"ideal_{k}") for k in ks]
    )


def rank_correlation(
    base: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    by: Sequence[str],
) -> DataFrame:
    """Spearman over the cells that occur on both sides; null below three of them.

    The actual side does not depend on the candidate, so it is ranked once per
    window before the candidates fan out.
    """
    common = base.filter("actual IS NOT NULL").withColumn("_y", sort_value(F.col("actual")))
    pairs = predict(average_rank(common, "_y", "actual_rank", [WINDOW]))
    pairs = pairs.withColumn("_x", sort_value(F.col("predicted"))).select(*by, "_x", "actual_rank")
    ranked = average_rank(pairs, "_x", "predicted_rank", by)
    n = F.count(F.lit(1))
    return ranked.groupBy(*by).agg(
        n.alias("common_hotspots"),
        F.when(n >= 3, pearson("predicted_rank", "actual_rank")).alias("spearman"),
    )


def ranking_quality(
    base: DataFrame,
    actual: DataFrame,
    groups: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    by: Sequence[str],
    ks: Sequence[int],
) -> DataFrame:
    """One row per row of ``groups`` (its columns include ``by``), groups without overlap too."""
    top = top_list_quality(predict(base), by, ks)
    correlation = rank_correlation(base, predict, by)
    out = (
        groups.join(top, list(by), "left")
        .join(correlation, list(by), "left")
        .join(ideal_quality(actual, ks), WINDOW, "left")
    )
    columns = {
        "common_hotspots": F.coalesce("common_hotspots", F.lit(0)).cast("bigint"),
        "spearman_score_correlation": half_even(F.col("spearman"), 4),
    }
    for k in ks:
        hits = F.coalesce(f"hit_count_at_{k}", F.lit(0)).cast("bigint")
        ndcg = F.try_divide(F.col(f"dcg_{k}"), F.col(f"ideal_{k}"))
        columns[f"precision_at_{k}"] = half_even(hits / F.lit(float(k)), 4)
        columns[f"hit_count_at_{k}"] = hits
        columns[f"ndcg_at_{k}"] = half_even(F.coalesce(ndcg, F.lit(0.0)), 4)
    return out.select(*groups.columns, *[c.alias(name) for name, c in columns.items()])


def exact_mean(column: str | Column) -> Column:
    """Aggregate: mean of four-decimal metrics, added exactly."""
    c = F.col(column) if isinstance(column, str) else column
    return F.try_divide(
        F.sum(c.cast("decimal(12,4)")).cast("double"), F.count(c)
    )
