"""Numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column, digits: int) -> Column:
    """Round by scale, round-half-even, unscale; stays in double arithmetic.

    ``round()`` rounds halves up on the decimal text, which puts 12.9825 in
    another cell than the scale/unscale rule does.
    """
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def finite_or_zero(c: Column) -> Column:
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def scaled(c: Column, lo: Column, hi: Column) -> Column:
    """(c - lo) / (hi - lo); a constant or empty population gives 0, null stays null."""
    flat = lo.isNull() | (lo == hi)
    return F.when(flat, F.lit(0.0)).otherwise((c - lo) / (hi - lo))


def sort_value(score: Column) -> Column:
    """Score as compared in rankings: nine decimals, so last-bit noise cannot reorder ties."""
    return half_even(score, 9)
