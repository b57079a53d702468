"""The date-time format of a text column, found from its first value.

A column is read by one format: its first value names it, and values written in
another way are missing.  ISO texts need no format; each of them is read by a
cast, which takes all ISO forms.  Where the first value is in no known form, every
value is read by itself, month first wherever both readings are possible.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a cast instead of a pattern.
ISO = "iso"

_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_LONG_MONTHS = "january february march april may june july august september october november december".split()

_SEPARATOR = r"([-/. ])"
_DATES = (
    re.compile(rf"(?P<a>\d{{4}}){_SEPARATOR}(?P<b>\d{{1,2}})\2(?P<c>\d{{1,2}})"),
    re.compile(rf"(?P<a>\d{{1,2}}){_SEPARATOR}(?P<b>\d{{1,2}})\2(?P<c>\d{{4}})"),
    re.compile(rf"(?P<a>\d{{1,2}}){_SEPARATOR}(?P<b>[A-Za-z]+)\2(?P<c>\d{{4}})"),
    re.compile(r"(?P<a>[A-Za-z]+)( )(?P<b>\d{1,2})(?P<comma>,?) (?P<c>\d{4})"),
)
_TIME = re.compile(r"(?P<gap>[ T])\d{1,2}:\d{1,2}(?P<second>:\d{1,2})?(?P<fraction>\.\d{1,9})?(?P<half> ?[AaPp][Mm])?")
_ZONE = re.compile(r"(?P<gap> ?)(Z|[+-]\d{2}(:?\d{2})?)")

_ZONE_PATTERN = "[XXX][XX][X]"
_CLOCKS = (f"[ H:m[:s[.SSSSSSSSS]]][ ]{_ZONE_PATTERN}", "[ ]h:m[:s][ ]a")

#: What a column without a usable first value is read by, after ISO; earlier ones win.
MIXED = tuple(
    date + clock
    for date in ("M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "M.d.yyyy", "d.M.yyyy", "yyyy/M/d", "yyyy.M.d", "d MMM yyyy", "d MMMM yyyy", "MMM d[,] yyyy", "MMMM d[,] yyyy")
    for clock in _CLOCKS
)


def _month_name(word: str) -> str | None:
    """``may`` is both short and long."""
    if word.lower() in _MONTHS:
        return "MMM"
    return "MMMM" if word.lower() in _LONG_MONTHS else None


def _date_pattern(found: re.Match) -> str | None:
    first, second, third, gap = found["a"], found["b"], found["c"], found[2]
    if first.isdigit() and len(first) == 4:
        whole = gap != "-" and 1 <= int(second) <= 12 and 1 <= int(third) <= 31
        return f"yyyy{gap}M{gap}d" if whole else None
    if first.isalpha():
        month = _month_name(first)
        return month and f"{month} d{found['comma']} yyyy"
    if second.isalpha():
        month = _month_name(second)
        return month and f"d{gap}{month}{gap}yyyy"
    a, b = int(first), int(second)
    if 1 <= a <= 12 and 1 <= b <= 31:
        return f"M{gap}d{gap}yyyy"
    return f"d{gap}M{gap}yyyy" if 1 <= b <= 12 and 13 <= a <= 31 else None


def guess_format(text: str) -> str | None:
    """``ISO``, a Spark date-time pattern, or None where the form is not known.

    Of day and month the month comes first, unless only the day can.
    """
    if re.match(r"\s*\d{4}-\d", text):
        return ISO
    for form in _DATES:
        found = form.match(text)
        if not found:
            continue
        pattern = _date_pattern(found)
        rest = text[found.end() :]
        time = _TIME.match(rest)
        if pattern and time:
            clock = "h:m" if time["half"] else "H:m"
            clock += ":s" if time["second"] else ""
            clock += ".SSSSSSSSS" if time["fraction"] else ""
            clock += ("" if not time["half"] else " a" if time["half"][0] == " " else "a")
            pattern += {" ": " ", "T": "'T'"}[time["gap"]] + clock
            rest = rest[time.end() :]
            zone = _ZONE.match(rest)
            if zone:
                pattern, rest = pattern + zone["gap"] + _ZONE_PATTERN, rest[zone.end() :]
        if pattern and not rest:
            return pattern
    return None


def formats_of(first: str | None) -> tuple[str, ...]:
    """How to read a column whose first value is ``first`` (None: it has no value)."""
    if first is None:
        return (ISO,)
    guess = guess_format(first)
    return (ISO, *MIXED) if guess is None else (guess,)


def infer_formats(rows: DataFrame, column: str, by: Column | None = None) -> tuple[str, ...]:
    """How to read ``column``, from its first value that is not null.

    First in the order of ``by``, an aggregate that reads these two columns; or in the
    order in which Spark reads the table, which stops at the first value it meets.
    """
    known = rows.where(F.col(column).isNotNull())
    if by is None:
        first = known.select(column).first()
    else:
        first = known.agg(F.min_by(F.col(column), by)).first()
    return formats_of(first[0] if first else None)
