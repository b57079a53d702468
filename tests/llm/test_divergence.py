"""The source audit and its perfect hashes against plain versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from checks.compare import connect, difference
from kerbscope.llm import divergence, perfect, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "text string, lang string, source string, doc_id long, term string, part int, value string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(t, lang, s, 1, "x", 9, "v") for t, lang, s in rows], SCHEMA).repartition(parts)


def plain(rows, min_docs=3, top=200):
    """The audit by dictionaries and whole numbers without bounds."""
    docs = [("" if lang is None else lang, s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for t, lang, s in rows]
    docs = [(lang, s, ["".join(c.lower() if c.isascii() else c for c in w) for w in words]) for lang, s, words in docs]
    used, uses, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        used[lang].update(set(words))
        groups[lang].add(source)
        for key in ((lang, source), (lang, None)):
            uses[key].update(words)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(w for w, n in used[lang].items() if n >= min_docs)
        p = {}
        for s in [*sources, None]:
            total = sum(uses[lang, s][w] for w in kept)
            p[s] = {w: 1 + 10**9 * (uses[lang, s][w] + 1) // (total + len(kept)) for w in kept}

        def far(s, t, w):
            return (p[s][w] - p[t][w]) ** 2 // p[t][w]

        for s in sources:
            pairs = [(t, sum(far(s, t, w) for w in kept)) for t in sources if t != s]
            terms = [(w, far(s, None, w)) for w in kept if uses[lang, s][w] and p[s][w] > p[None][w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out |= {(lang, s, part, item, value, rank + 1) for rank, (item, value) in enumerate(found[:most])}
    return out


def rows_of(table):
    assert table.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = table.collect()
    assert len(set(found)) == len(found)
    return {tuple(r) for r in found}


def made(seed=5, docs=160):
    rnd = random.Random(seed)
    words = ["the", "Été", "été", "O'Neil", "naïve", "日本", "Ünder", "a1b", "x_y", "K", "k"] + [f"w{'abcdefghij'[k % 10] * (k // 10 + 1)}" for k in range(60)]
    return [
        (" ".join(rnd.choices(words, k=rnd.randrange(40))), rnd.choice(["en", "en", "en", "fr", None, ""]), rnd.choice(["s1", "s1", "s1", "s2", "sé", None]))
        for _ in range(docs)
    ] + [(None, "en", "s9"), ("", "xx", "s1"), ("12 !", "xx", "s2"), ("alone " * 5, "yy", "s1"), ("KELVIN K", "en", "s1")]


@pytest.mark.parametrize("options", [{}, {"shard_terms": 7, "broadcast_bytes": 600}, {"top": 3}])
def test_audit_of_made_texts(spark, options):
    rows = made()
    assert rows_of(divergence.audit(frame(spark, rows), **options)) == plain(rows, top=options.get("top", 200))


def test_many_partial_counts_blocks_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "MERGE", 2)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    rows = made(6, 60) + made(6, 60) + [("hot words of one source", "en", "s1")] * 200
    assert rows_of(divergence.audit(frame(spark, rows, 9), shard_terms=16)) == plain(rows)


def test_empty_table_and_very_long_text(spark):
    assert rows_of(divergence.audit(frame(spark, []))) == set()
    rows = [("long word " * 200_000, "en", "s1"), ("word " + "x" * 300_000, "en", "s2"), ("word", "en", "s2"), ("word long", "en", "s3"), ("long", "en", "s3")]
    assert rows_of(divergence.audit(frame(spark, rows))) == plain(rows)


def test_one_shard_beyond_the_bound_is_an_error(spark):
    with pytest.raises(ValueError, match="broadcast_bytes"):
        divergence.audit(frame(spark, made()), broadcast_bytes=2).collect()


def test_query_equals_its_sql(spark):
    found = queries.op11_source_divergence(spark, FOLDER).toPandas()
    assert difference(found, connect(FOLDER).sql(queries.oracle_sql()["op11_source_divergence"]).df()) is None


def test_shares_stay_exact_for_large_counts():
    count = np.array([0, 7, 10**12, 3 * 10**14], np.int64)
    assert divergence.shares(count, 3 * 10**14 + 5, 10**9).tolist() == [1 + 10**9 * (c + 1) // (3 * 10**14 + 5 + 10**9) for c in count.tolist()]


def test_perfect_hash_numbers_every_key_and_no_other(monkeypatch):
    for n in (0, 1, 3, 5000):
        keys = pa.array(sorted(f"key {k}ß".encode() for k in range(n)), pa.binary())
        made = perfect.PerfectHash.of(keys)
        words = pa.array([*keys.to_pylist(), b"", b"other", *(f"no {k}".encode() for k in range(3000))], pa.binary())
        found = made.find(words, perfect.key_hashes(words)) if n else np.full(len(words), -1)
        assert found.tolist() == [*range(n), *[-1] * 3002]
        assert sorted(made.place.tolist()) == list(range(n)) and not len(made.spare)
    real = perfect.key_hashes
    monkeypatch.setattr(perfect, "key_hashes", lambda keys: real(keys) // np.uint64(2**62))  # four hashes for all keys
    keys = pa.array(sorted(f"k{k}".encode() for k in range(40)), pa.binary())
    made = perfect.PerfectHash.of(keys)
    assert len(made.spare) > 30
    assert made.find(keys, perfect.key_hashes(keys)).tolist() == list(range(40))
    assert made.find(pa.array([b"z"]), perfect.key_hashes(pa.array([b"z"]))).tolist() == [-1]


def test_shards_follow_sparks_own_hash(spark):
    words = ["a", "ö", "word", "日本", ""]
    table = spark.createDataFrame([(w,) for w in words], "term string")
    found = table.select((F.shiftrightunsigned(F.xxhash64("term"), 33) % 7).alias("s")).collect()
    hashes = np.array([xxhash.xxh64_intdigest(w.encode(), perfect.SEED) for w in words], np.uint64)
    assert [r.s for r in found] == perfect.shard_of(hashes, 7).tolist()
