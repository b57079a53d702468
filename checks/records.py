"""Nested records as rows, one for each leaf, so that two engines can be compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbscope.functions.numeric import half_even


def _leaves(value: Column, path: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        parts = [_leaves(value[f.name], F.concat(path, F.lit(f".{f.name}")), f.dataType) for f in kind.fields]
        return F.concat(*parts)
    if isinstance(kind, T.ArrayType):
        return F.flatten(F.transform(value, lambda x, i: _leaves(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), kind.elementType)))
    text = value if isinstance(kind, T.StringType) else F.lit(None).cast("string")
    number = F.lit(None).cast("double") if isinstance(kind, T.StringType) else half_even(value.cast("double"), 6)
    return F.array(F.struct(path.alias("path"), text.alias("text"), number.alias("number")))


def leaves(records: DataFrame) -> DataFrame:
    """Rows ``path``, ``text``, ``number`` (six decimals) of all leaves of all fields."""
    parts = [_leaves(F.col(f.name), F.lit(f.name), f.dataType) for f in records.schema.fields]
    return records.select(F.inline(F.concat(*parts)))


def leaves_sql(table: str, texts: dict[str, str], numbers: dict[str, str]) -> str:
    """The same rows in SQL: path -> expression over the one row of ``table``."""
    rows = [f"SELECT '{path}' AS path, ({x})::VARCHAR AS text, NULL::DOUBLE AS number FROM {table}" for path, x in texts.items()]
    rows += [
        f"SELECT '{path}', NULL::VARCHAR, round_even(({x})::DOUBLE * 1000000.0::DOUBLE, 0) / 1000000.0::DOUBLE FROM {table}"
        for path, x in numbers.items()
    ]
    return "\nUNION ALL ".join(rows)
