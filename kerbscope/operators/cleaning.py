"""Raw violation records -> cleaned, weighted, binned events.

One narrow projection and one filter: no shuffle, whole-stage code generation,
and only the columns a later step reads are computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.functions.calendar import (
    day_key,
    local_time,
    month_key,
    weekday_name,
    weekend_flag,
)
from kerbscope.functions.numeric import half_even
from kerbscope.functions.text import compute_once, literal, literals, not_blank, with_items
from kerbscope.operators.weights import WeightTables, join_weights
from kerbscope.settings import KEPT_WORD, NO_JUNCTION, CleanSettings, hundredths

# One impact unit: a product of four two-digit weights is whole in it.
UNIT = "0.00000001BD"


def lookup(weights: dict[str, str], key: str, other: str) -> str:
    """Hundredths for ``key``; the fallback for unknown or null keys."""
    pairs = ", ".join(f"{literal(k)}, {hundredths(v)}" for k, v in weights.items())
    return f"coalesce(try_element_at(map({pairs}), {key}), {hundredths(other)})"


def severity_hundredths(items: str, settings: CleanSettings) -> str:
    """Highest weight among the items; an item outside the table has the other weight.

    Membership tests instead of a lambda over the items keep the expression
    inside the generated code.
    """
    other = hundredths(settings.other_severity)
    present = [
        f"case when array_contains({items}, {literal(name)}) then {hundredths(weight)} end"
        for name, weight in settings.severity.items()
    ]
    names = literals(settings.severity)
    unlisted = f"case when size(array_except({items}, array({names}))) > 0 then {other} end"
    return f"coalesce(greatest({', '.join([unlisted, *present])}), {other})"


def vehicle_hundredths(vehicle: str, settings: CleanSettings) -> str:
    """A missing vehicle type counts as ``OTHERS``, which the default table does not list."""
    key = f"upper(coalesce({vehicle}, 'OTHERS'))"
    return lookup(settings.footprint, key, settings.other_footprint)


def junction_flag(name: str) -> str:
    """1 for a named junction; the sentinel is compared without stripping."""
    named = f"{not_blank(name)} and upper({name}) != {literal(NO_JUNCTION)}"
    return f"case when {named} then 1 else 0 end"


def peak_flag(hour: str, settings: CleanSettings) -> str:
    hours = ", ".join(str(h) for h in settings.peak_hours)
    return f"cast({hour} in ({hours}) as int)"


def _as_weight(column: str) -> str:
    return f"cast(cast({column} as decimal(6,0)) * 0.01BD as decimal(4,2))"


def _columns(expressions: dict[str, str]) -> dict:
    return {name: F.expr(sql) for name, sql in expressions.items()}


def keep_complete(violations: DataFrame, settings: CleanSettings) -> DataFrame:
    """Rows with a readable time, latitude and longitude (NaN counts as missing)."""
    time = local_time("created_datetime", settings.zone, settings.time_formats)
    # On the raw columns first: these reach the scan, and no time text is parsed in vain.
    placed = violations.filter("latitude IS NOT NULL").filter("longitude IS NOT NULL")
    placed = placed.filter("created_datetime IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)")
    return compute_once(placed, "created_at_ist", time).filter("created_at_ist IS NOT NULL")


def keep_parking(events: DataFrame) -> DataFrame:
    """Rows where any parsed item names parking."""
    parsed = with_items(events, "violation_type", "violation_items")
    # The separator is no part of the word, so no match can span two items.
    flagged = F.array_join("violation_items", "\n").contains(KEPT_WORD)
    return parsed.withColumn("parking_violation", flagged).filter("parking_violation")


def add_calendar(events: DataFrame, settings: CleanSettings) -> DataFrame:
    ts = "created_at_ist"
    hour = f"hour({ts})"
    return events.withColumns(
        _columns(
            {
                "date": day_key(ts),
                "month": month_key(ts),
                "weekday": weekday_name(ts),
                "hour": hour,
                "is_peak_hour": peak_flag(hour, settings),
                "is_weekend": weekend_flag(ts),
            }
        )
    )


def add_weights(events: DataFrame, settings: CleanSettings, tables: WeightTables | None = None) -> DataFrame:
    """Severity, footprint and the two conditional weights, then their exact product.

    The first two come from ``tables`` if given, else from the settings as part of
    the expression.  ``impact_units`` is the product in whole 1e-8 units: sums of it
    are exact and the same under any partitioning.  ``incident_impact`` is the same
    number as a decimal.
    """
    expressions = {"near_junction": junction_flag("junction_name")}
    if tables is None:
        expressions |= {
            "_severity": severity_hundredths("violation_items", settings),
            "_vehicle": vehicle_hundredths("vehicle_type", settings),
        }
    else:
        events = join_weights(events, tables, settings)
    parts = events.withColumns(_columns(expressions))
    at_junction, at_peak = hundredths(settings.junction_weight), hundredths(settings.peak_weight)
    weighted = parts.withColumns(
        _columns(
            {
                "_junction": f"if(near_junction = 1, {at_junction}, 100)",
                "_peak": f"if(is_peak_hour = 1, {at_peak}, 100)",
            }
        )
    ).withColumn("impact_units", F.expr("bigint(_severity) * _vehicle * _junction * _peak"))
    return weighted.withColumns(
        _columns(
            {
                "violation_severity": _as_weight("_severity"),
                "vehicle_pcu": _as_weight("_vehicle"),
                "junction_weight": _as_weight("_junction"),
                "peak_weight": _as_weight("_peak"),
                "incident_impact": f"cast(cast(impact_units as decimal(18,0)) * {UNIT} as decimal(17,8))",
            }
        )
    ).drop("_severity", "_vehicle", "_junction", "_peak")


def add_cells(events: DataFrame, digits: int = 3) -> DataFrame:
    """Grid cell of about 100 m and its text id."""
    binned = events.withColumns(
        {
            "grid_lat": half_even(F.col("latitude"), digits),
            "grid_lon": half_even(F.col("longitude"), digits),
        }
    )
    return binned.withColumn("grid_id", F.expr("concat_ws(',', string(grid_lat), string(grid_lon))"))


def clean_events(violations: DataFrame, settings: CleanSettings | None = None, tables: WeightTables | None = None) -> DataFrame:
    """The whole cleaning stage, lazily; with weights from ``tables``, two joins and a pass over the texts more."""
    settings = settings or CleanSettings()
    events = keep_parking(keep_complete(violations, settings))
    return add_cells(add_weights(add_calendar(events, settings), settings, tables))
