"""Merkle audit against a direct comparison."""

import duckdb
import pytest

from checks.compare import connect, difference
from kerbscope.llm import merkle, queries


def copies(spark, a, b):
    frames = [spark.createDataFrame([(*r, "n", 1) for r in rows], "file string, position long, payload string, node string, bytes int") for rows in (a, b)]
    depth = merkle.depth_for(*frames)
    return [merkle.build(f, depth) for f in frames]


def found(spark, a, b):
    return sorted(tuple(r) for r in merkle.audit(*copies(spark, a, b)).collect())


BASE = [("f", i, f"record {i}") for i in (0, 1, 2, 63, 64, 65, 4095, 4096, 70_000)] + [("g", 5, "x")]


def test_equal_copies_have_equal_roots_and_no_findings(spark):
    first, second = copies(spark, BASE, BASE[::-1])
    assert sorted(merkle.roots(first).collect()) == sorted(merkle.roots(second).collect())
    assert merkle.audit(first, second).collect() == []


def test_damage_is_located_with_its_offset(spark):
    other = [r for r in BASE if r[1] != 65]
    other[2] = ("f", 2, "Record 2")
    other += [("f", 100, "new"), ("h", 1, "hh")]
    size = {r[:2]: len(r[2]) for r in BASE}
    before = {p: sum(n for (f, q), n in size.items() if f == "f" and q < p) for p in (2, 65, 100)}
    assert found(spark, BASE, other) == [
        ("f", 2, "changed", before[2], 8, 8),
        ("f", 65, "missing", before[65], 9, None),
        ("f", 100, "extra", before[100], None, 3),
        ("h", 1, "extra", 0, None, 2),
    ]


def test_nulls_repeats_and_empty_copies(spark):
    odd = [(None, 1, "a"), ("f", None, "b"), ("f", 3, None), ("f", 3, None), ("f", 4, "")]
    assert found(spark, odd, odd[::-1]) == []
    assert [r[:3] for r in found(spark, odd, [*odd[:3], odd[4]])] == [("f", 3, "changed")]
    changed = [(None, 1, "A"), ("f", None, "B"), ("f", 3, ""), ("f", 3, None), ("f", 4, None)]
    assert [r[:3] for r in found(spark, odd, changed)] == [("", 1, "changed"), ("f", -1, "changed"), ("f", 3, "changed"), ("f", 4, "changed")]
    assert found(spark, [], []) == []
    assert [r[2] for r in found(spark, BASE, [])] == ["missing"] * len(BASE)


def test_repeats_in_any_order_have_one_hash(spark):
    rows = [("f", 1, x) for x in ("a", "b", "b", "c")]
    assert found(spark, rows, rows[::-1]) == []
    assert [r[1] for r in found(spark, rows, [*rows[:3], ("f", 1, "a")])] == [1]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_like_sql(spark, folder):
    con: duckdb.DuckDBPyConnection = connect(folder)
    result = queries.op2_merkle_audit(spark, folder).toPandas()
    assert difference(result, con.sql(queries.oracle_sql()["op2_merkle_audit"]).df()) is None
    con.close()


def test_very_long_payloads_and_clashing_columns(spark):
    names = ["file", "position", "payload", "node", "hash", "bytes", "records", "id", "kind", "offset"]
    pages = spark.createDataFrame(
        [(i, f"https://host/{i}", f"{i} " * 800_000, *[f"{n}{i}" for n in names]) for i in range(4)],
        "page_id long, url string, html string, " + ", ".join(f"`{n}` string" for n in names),
    )
    first = merkle.warc_records(pages)
    second = merkle.warc_records(pages.selectExpr("page_id", "url", "IF(page_id = 2, concat(left(html, 1599999), '!'), html) AS html"))
    assert first.columns == ["file", "position", "payload"]
    depth = merkle.depth_for(first, second)
    (damage,) = merkle.audit(*(merkle.build(c, depth) for c in (first, second))).collect()
    assert (damage["file"], damage.position, damage.kind, damage.bytes == damage.other_bytes) == ("host", 2, "changed", True)
    assert damage.bytes > 1_600_000 and damage.offset == sum(len(r.payload) for r in first.collect() if r.position < 2)
