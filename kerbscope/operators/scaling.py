"""Min-max scaling against a whole population.

The bounds are one aggregated row per population.  Without keys that row comes
back as a scalar subquery; with keys (one population per calendar month or test
window) it comes back through a broadcast join, whose size is bounded by the
number of months.  A window over the whole population is never used: it would
move every row to one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.numeric import finite_or_zero, scaled


def _bound_columns(inputs: Mapping[str, Column]) -> list[Column]:
    """Aggregates lo_/hi_ per name."""
    parts = []
    for name, c in inputs.items():
        parts += [F.min(c).alias(f"lo_{name}"), F.max(c).alias(f"hi_{name}")]
    return parts


def with_bounds(df: DataFrame, inputs: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Add lo_/hi_ columns, the population's lowest and highest value of every input.

    ``df`` is read twice, so its costly part should be a staged table.
    """
    if by:
        per_population = df.groupBy(*by).agg(*_bound_columns(inputs))
        return df.join(F.broadcast(per_population), list(by))
    # inline() makes the subquery's fields plain columns: as expressions they
    # would be copied into everything computed from them, hundreds of times over.
    bounds = df.agg(F.struct(*_bound_columns(inputs)).alias("bounds")).scalar()
    return df.select("*", F.inline(F.array(bounds)))


def _without_bounds(df: DataFrame, inputs: Mapping[str, Column]) -> DataFrame:
    return df.drop(*[f"{side}_{name}" for name in inputs for side in ("lo", "hi")])


def minmax(
    df: DataFrame, inputs: Mapping[str, Column], by: Sequence[str] = (), factor: float = 100.0
) -> DataFrame:
    """Add one column per name: factor * (x - lo) / (hi - lo); flat populations give 0."""
    added = {
        name: F.lit(factor) * scaled(c, F.col(f"lo_{name}"), F.col(f"hi_{name}"))
        for name, c in inputs.items()
    }
    return _without_bounds(with_bounds(df, inputs, by).withColumns(added), inputs)


def feature_minmax(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Replace each column by 0..100 within its population; null, NaN and infinity count as 0."""
    inputs = {name: finite_or_zero(F.col(name)) for name in columns}
    replaced = {}
    for name, c in inputs.items():
        lo, hi = F.col(f"lo_{name}"), F.col(f"hi_{name}")
        replaced[name] = F.when(lo == hi, F.lit(0.0)).otherwise(
            F.lit(100.0) * (c - lo) / (hi - lo)
        )
    return _without_bounds(with_bounds(df, inputs, by).withColumns(replaced), inputs)
