"""Fill-in-middle against a plain version, unit by unit."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import connect
from kerbscope.llm import middle, queries

FOLDER = "/root/testdata/sf0.001"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("azAZ@[`{ \n\0<é߿ࠀ￿\U0001f600\U0010ffff"), st.characters(codec="utf-8"))), max_size=5))
def test_every_unit_end_is_found(texts):
    coded = [t.encode() for t in texts]
    units = middle.Units(coded)
    found = [UNIT.findall(t) for t in texts]
    assert units.count.tolist() == [len(f) for f in found]
    for k in range(max(map(len, found), default=0) + 1):
        ends = units.end_of(np.minimum(units.count, k))
        assert [t[:e].decode() for t, e in zip(coded, ends.tolist())] == ["".join(f[:k]) for f in found]


def test_transform_and_restore(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abcXYZ <>PSM\n éß日😀", k=rnd.randrange(60))) for _ in range(400)]
    texts += ["has <P> in it", "has <M>", "<S>", "<", "P>", "", None, "x", "é" * 8, "a" * 8, "ab cd " * 100_000, "z" * 1_000_000]
    rows = [(k, t, "form", 1, "o") for k, t in enumerate(texts)] + [(None, "no id here", "f", 2, "o"), (3, "another text of three", "f", 2, "o"), (3, texts[3], "f", 2, "o")]
    table = spark.createDataFrame(rows, "doc_id long, text string, form string, n int, output string")
    found = middle.transform(table).withColumn("back", middle.restore(F.col("output"), F.col("form"))).collect()
    wanted = sorted((str(r[0]), *map(str, plain(r[0], r[1])), r[1] or "") for r in rows)
    assert sorted(tuple(map(str, r)) for r in found) == wanted
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert middle.transform(table.where("false")).collect() == []


def test_query_equals_its_sql(spark):
    found = sorted(tuple(r[c] for c in sorted(r.asDict())) for r in queries.op12_swar_middle(spark, FOLDER).collect())
    table = connect(FOLDER).sql(queries.oracle_sql()["op12_swar_middle"])
    order = sorted(range(len(table.columns)), key=lambda k: table.columns[k])
    assert found == sorted(tuple(row[k] for k in order) for row in table.fetchall())
