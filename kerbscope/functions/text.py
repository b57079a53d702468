"""Text expressions: white space strip and the list-literal parser.

The functions take and return SQL text; ``F.expr`` turns the finished text into
one column, which is much quicker to build than hundreds of column objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Every character that counts as white space when a text is stripped.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ------------------------------------------------------------ end fixed values


def literal(text: str) -> str:
    """SQL literal of a text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(texts) -> str:
    return ", ".join("null" if t is None else literal(t) for t in texts)


def strip(x: str) -> str:
    """Remove all leading and trailing white space (``trim`` alone removes spaces only)."""
    visible = f"ascii({x}) between 33 and 126 and ascii(right({x}, 1)) between 33 and 126"
    return f"case when {visible} then {x} else btrim({x}, {literal(WHITE_SPACE)}) end"


def not_blank(x: str) -> str:
    return f"({strip(x)}) != ''"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once.

    The body of a higher-order function also stays out of the generated code, so
    the stage around a long expression remains small enough to be compiled well.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _read_array(body: str, element: str) -> str:
    options = "map('allowBackslashEscapingAnyCharacter', 'true')"
    return f"from_json(concat('[', {body}, ']'), 'array<{element}>', {options})"


_QUOTED = literal(r'"[^"\\\n\r]*"')
_SEPARATOR = literal(r'""\s*,\s*')
_INSIDE = literal(r'(?U)"[\s\x1c-\x1f]*([^"\\\n\r]*?)[\s\x1c-\x1f]*"')
_LAST_COMMA = literal(r",\s*([\])])$")


def _plain_list(quoted: str) -> str:
    """True when a text is only quoted strings between brackets, separated by commas.

    The strings are emptied and all but the last are removed; what remains of
    such a list is an empty pair of quotes or nothing.
    """
    emptied = f"regexp_replace({quoted}, {_QUOTED}, '\"\"')"
    rest = f"regexp_replace({emptied}, {_SEPARATOR}, '')"
    return f"startswith({quoted}, '[') and {rest} in ('[\"\"]', '[]')"


def _tidy(items: str) -> str:
    return f"filter(transform({items}, x -> upper({strip('x')})), x -> x != '')"


def _no_last_comma(x: str) -> str:
    return f"regexp_replace({x}, {_LAST_COMMA}, '$1')"


def _list_items(text: str) -> str:
    """A list is read as the only element of an outer array, so text after its
    closing bracket makes the whole read fail instead of being dropped."""
    inner = "get(parsed, 0)"
    complete = f"size(parsed) = 1 and not exists({inner}, x -> x is null)"
    body = f"case when {complete} then {_tidy(inner)} else array({text}) end"
    return _let("parsed", _read_array(_no_last_comma(text), "array<string>"), body)


def _one_item(item: str, text: str) -> str:
    return f"case when {item} is not null then array(upper({strip(item)})) else array({text}) end"


def _scalar_item(text: str) -> str:
    only = "case when size(members) = 1 then get(members, 0) end"
    return _let("members", _read_array(text, "string"), _let("only", only, _one_item("only", text)))


def _tuple_item(text: str) -> str:
    """A parenthesised text is its content; a tuple is spelled out as one item."""
    spelled = """concat('(', array_join(transform(members, x -> concat("'", x, "'")), ', '),
        case when size(members) = 1 then ',)' else ')' end)"""
    item = f"case when size(members) = 1 and body = {text} then get(members, 0) else {spelled} end"
    found = _let("item", item, _one_item("item", text))
    inside = "substring(body, 2, length(body) - 2)"
    return _let("body", _no_last_comma(text), _let("members", _read_array(inside, "string"), found))


def _any_literal(text: str) -> str:
    """Lists with escapes or odd spacing, quoted scalars, tuples, broken literals."""
    first, last = f"left({text}, 1)", f"right({text}, 1)"
    return f"""case
        when {first} = '[' and {last} = ']' then {_list_items(text)}
        when {first} = {last} and {first} in ("'", '"') then {_scalar_item(text)}
        when {first} = '(' and {last} = ')' then {_tuple_item(text)}
        else array({text}) end"""


def compute_once(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add a costly column that later filters read.

    It leaves through ``explode(array(...))``, one row out per row in.  A filter
    on it then stays above, where a plain projection would be copied into the
    filter and computed again for every row.
    """
    return df.selectExpr("*", f"explode(array({value})) as {name}")


def with_items(df: DataFrame, source: str, name: str) -> DataFrame:
    """Add ``name``: the items of the list literal in ``source``.

    * null or blank -> empty array
    * a list -> its elements, stripped, upper-cased, blanks removed
    * a quoted scalar, or a parenthesised tuple of strings -> one upper-cased item
    * a number -> one item
    * anything that does not parse -> the stripped text as one item, case kept

    Bare text and lists of plain strings, nearly all real rows, are read inside
    the generated code; only the others reach the JSON parser.
    """
    double_quoted = "case when contains(_text, '\"') then _text else replace(_text, \"'\", '\"') end"
    contents = f"regexp_extract_all(upper(_quoted), {_INSIDE}, 1)"
    common = f"""case
        when _text is null or _text = '' then cast(array() as array<string>)
        when left(_text, 1) not in ('[', '(', "'", '"') then array(_text)
        when {_plain_list("_quoted")} then array_remove({contents}, '') end"""
    prepared = (
        df.withColumn("_text", F.expr(strip(source)))
        .withColumn("_quoted", F.expr(double_quoted))
        .withColumn("_common", F.expr(common))
    )
    rare = _let("t", "_text", _any_literal("t"))
    return compute_once(prepared, name, f"coalesce(_common, {rare})").drop("_text", "_quoted", "_common")
