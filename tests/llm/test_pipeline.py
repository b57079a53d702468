"""The pipeline's stages, each on its own input."""

import os

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from kerbscope.llm import winnow
from kerbscope.staging import stage

FOLDER = "/root/testdata/sf0.01"


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    letters = docs.limit(1).selectExpr("-1L doc_id", "'123 !!' text", "lang", "source", "n_chars")
    docs = docs.unionByName(letters).cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = [set(texts)]
    tables = [docs]
    for name, function in pipeline.STAGES[:-1]:
        out = function(spark, tables[-1], FOLDER).cache()
        assert out.columns == docs.columns, name
        tables.append(out)
        kept.append({r.doc_id for r in out.select("doc_id").collect()})
        assert kept[-1] <= kept[-2]
    assert kept[0] - kept[1] == {-1}
    gone = kept[1] - kept[2]
    assert sum(toxic.get(i, 0) for i in gone) >= 0.8 * sum(toxic.get(i, 0) for i in kept[1])
    assert sum(toxic.get(i, 1) == 0 for i in gone) <= 0.02 * len(kept[1])
    after = {r.doc_id: (r.text, r.n_chars) for r in tables[3].collect()}
    for i in kept[2] - kept[3]:  # only texts of which nothing new is left go
        assert i not in after
    before = {}
    for i in sorted(kept[2]):
        lines = [" ".join(x.split()) for x in winnow.split_lines(texts[i])[::2] if x.strip()]
        if i in after:
            own = [" ".join(x.split()) for x in winnow.split_lines(after[i][0])[::2] if x.strip()]
            assert set(lines) - set(own) <= set(before) and (after[i][0] == texts[i] or after[i][1] == len(after[i][0]))
        else:
            assert set(lines) <= set(before)
        before |= dict.fromkeys(lines)
    packed = pipeline.STAGES[-1][1](spark, tables[-1], FOLDER).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    length = {}
    for r in packed:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert length == {i: len(tokenizer.encode(after[i][0], add_special_tokens=False).ids) + 1 for i in kept[4]}


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is pipeline.run
    rows = pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 100


def test_stages_on_nulls_and_repeated_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, "s", 0), (None, "the text of nobody", None, "s", 1), (2, "a text", "en", None, 6), (2, "a text", "en", None, 6), (3, "", "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for rows in (docs, docs.where("false")):
        out = rows
        for _, function in pipeline.STAGES[:-1]:
            out = function(spark, out, FOLDER)
        assert [r.doc_id for r in out.orderBy("doc_id").collect()] == ([None, 2] if rows is docs else [])


def test_lettered_texts_stay_where_no_language_can_be_learned(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = ["the first text of all", "un autre texte", "123 !!", "", None]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(texts)], schema)
    unread = docs.unionByName(spark.createDataFrame([(8, None, "en", "s", 0), (9, "45", "en", "s", 0)], schema))
    for rows in (docs, unread):
        out = pipeline.STAGES[0][1](spark, rows, FOLDER)
        assert sorted((r.doc_id, r.text, r.lang) for r in out.collect()) == [(0, texts[0], None), (1, texts[1], None)]
    for _, function in pipeline.STAGES:
        docs = function(spark, docs, FOLDER)
    assert {r.doc_id for r in docs.collect()} == {0, 1}
    named = spark.createDataFrame([(i, t, "und", "s", 0) for i, t in enumerate(texts)], schema)
    assert {r.doc_id for r in pipeline.STAGES[0][1](spark, named, FOLDER).collect()} == {0, 1}


def test_texts_that_share_an_id_are_compared_each_by_itself(spark):
    words = [f"w{k}" for k in range(400)]
    a, b, c, d = (" ".join(words[k : k + 60]) for k in (0, 100, 200, 300))
    rows = [(1, a), (2, b), (2, c), (2, c), (2, f"{a} more"), (3, f"{c} end"), (4, d), (5, f"{d} end"), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.keep_one_of_each_group(spark, docs, FOLDER)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text) for r in out.collect())) == sorted([(0, a), (1, a), (2, b), (2, c), (4, d)])


def test_columns_of_the_documents_pass_every_stage_unchanged(spark):
    """Whatever their names: operators make columns of these names themselves."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ["score", "predicted", "_hash", "hash", "lang_pred", "lettered", "n_lines", "removed", "_key", "key", "row", "_made", "_row", "id", "body", "spans", "count"]
    docs = docs.select("*", *[F.concat(F.lit(f"{n} of "), "doc_id").alias(n) for n in names])
    docs = docs.unionByName(docs.limit(3))
    out = docs
    for name, function in pipeline.STAGES[:-1]:
        out = stage(function(spark, out, FOLDER), "stage")
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        rows = out.collect()
        assert rows and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names), name


def test_stages_without_any_label(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = pipeline.drop_toxic(spark, docs, str(tmp_path))
    clean = out.count()
    assert out.columns == docs.columns and 0.5 * docs.count() < clean <= docs.count()


def test_no_task_of_the_packing_holds_two_python_workers(spark, monkeypatch):
    given = []
    pack = pipeline.packing.pack
    monkeypatch.setattr(pipeline.packing, "pack", lambda table, capacity: given.append(table) or pack(table, capacity))
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (None, "four"), (2, None)], "doc_id long, text string")
    out = pipeline.pack_sequences(spark, docs, FOLDER)
    assert "MapInArrow" not in given[0]._jdf.queryExecution().executedPlan().toString()
    assert not os.path.exists(given[0]._staged_path)  # numbered, it is read no more
    assert sorted((r.doc_id or 0, r.piece, r.start) for r in out.collect()) == [(0, 0, 0), (1, 0, 0), (2, 0, 0), (2, 0, 0)]
