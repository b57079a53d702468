"""Instant parsing and local calendar fields, as SQL text."""

from __future__ import annotations

from kerbscope.functions.text import literal
from kerbscope.functions.timeformats import ISO

WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def parse_instant(text: str, formats: tuple[str, ...] = (ISO,)) -> str:
    """Instant by the first of ``formats`` that reads the whole text; null if none does.

    ISO is read by a cast.  The date check keeps bare times out, which a cast would
    complete with today's date.  Text without a zone is UTC because the session
    zone is UTC.
    """
    cast = f"case when trim({text}) like '____-%' then try_cast({text} as timestamp) end"
    reads = [cast if f == ISO else f"try_to_timestamp({text}, {literal(f)})" for f in formats]
    return reads[0] if len(reads) == 1 else f"coalesce({', '.join(reads)})"


def local_time(text: str, zone: str, formats: tuple[str, ...] = (ISO,)) -> str:
    return f"from_utc_timestamp({parse_instant(text, formats)}, '{zone}')"


def day_key(ts: str) -> str:
    return f"cast(cast({ts} as date) as string)"


def month_key(ts: str) -> str:
    return f"substring({day_key(ts)}, 1, 7)"


def weekday_name(ts: str) -> str:
    """English day name from the weekday number, so no locale is involved."""
    names = ", ".join(f"'{n}'" for n in WEEKDAY_NAMES)
    return f"get(array({names}), weekday({ts}))"


def weekend_flag(ts: str) -> str:
    return f"cast(weekday({ts}) >= 5 as int)"
