"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbscope.llm import groups, language, packing, toxicity, winnow
from kerbscope.llm.common import read_table
from kerbscope.staging import discard, scratch, stage

CAPACITY = 2048


def _others(docs: DataFrame, *without: str):
    """All columns but those in one, so that no column an operator makes replaces any of them."""
    names = [n for n in docs.columns if n not in without]
    return F.struct(*[docs[n] for n in names]).alias("row")


def _columns(docs: DataFrame, **made) -> list:
    """The columns of ``docs`` out of ``row``, but for those that are ``made``."""
    return [made[n].alias(n) if n in made else F.col("row").getField(n).alias(n) for n in docs.columns]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (6): texts without a letter have no language and go.

    The classifier learns from the labelled rows of ``docs``; the predicted language
    fills a missing one and replaces none.  Where nothing could be learned, texts with
    a letter stay as they are.
    """
    model = language.train(docs)
    found = language.predict(docs.select("text", _others(docs)), model, ["row"], letter=True)
    guess = F.col("lang_pred") if model.languages else F.lit(None).cast("string")
    lang = {"lang": F.coalesce(F.col("row.lang"), guess)} if "lang" in docs.columns else {}
    return found.where("lettered").select(*_columns(docs, **lang))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (8): texts that score one half or more go."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.predict(docs.select("text", _others(docs)), model, ["row"]).where("predicted = 0").select(*_columns(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (4): later repeated runs of lines are cut; a text of which nothing is left goes."""
    cut = winnow.remove_repeats(docs.select("doc_id", "text", _others(docs, "text")))
    emptied = (F.size("removed") > 0) & (F.trim("text") == "")
    left = cut.where(~F.coalesce(emptied, F.lit(False)))
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.when(F.size("removed") > 0, F.char_length("text")).otherwise(F.col("row.n_chars"))
        made["n_chars"] = counted.cast(docs.schema["n_chars"].dataType)
    return left.select(*_columns(docs, **made))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (10): of each group of near duplicates the smallest id stays.

    Rows with a null id are in no group and stay; of rows that repeat id and text one
    stays.  Where an id has several texts, each is compared by itself, and the
    smallest id, then the smallest hash of the text, stays.
    """
    rows = docs.where("doc_id is not null").select("doc_id", "text", _others(docs, "text"), F.xxhash64("text").alias("hash"))
    clashing = stage(rows.groupBy("doc_id").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a <> b"), "clashing")
    key = "doc_id"
    if not clashing.isEmpty():
        key = "key"
        # Written, as the numbers must not change; they follow the order.
        keys = stage(rows.select("doc_id", "hash").distinct().orderBy("doc_id", "hash").withColumn(key, F.monotonically_increasing_id()), "keys")
        rows = stage(rows.join(keys, ["doc_id", "hash"]), "numbered")
    found = groups.near_duplicates(rows.select(key, "text"), id_col=key)
    kept = stage(found.where(F.col(key) == F.col("component_id")).select(key).distinct(), "kept")
    one = rows.join(kept, key, "left_semi").dropDuplicates([key])
    return one.select(*_columns(docs, text=F.col("text"))).unionByName(docs.where("doc_id is null"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (9): pieces of at most 2,048 tokens and their places in the sequences.

    The pieces are written before they are numbered: a task in which two Python
    functions follow each other holds two workers, which an executor keeps.
    """
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)
    cut = stage(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "cut")
    packed = packing.pack(cut, CAPACITY)
    discard(cut)  # pack has written them with their numbers
    return packed


STAGES = [
    ("language ID", keep_known_language),
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("best-fit packing", pack_sequences),
]

#: SQL has no kernel regression, learned grammar, winnowing or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last.  What a stage wrote for itself and read is deleted."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        with scratch(spark):
            kept = stage(function(spark, docs, sf_dir), name.replace(" ", "-"), result=True)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
