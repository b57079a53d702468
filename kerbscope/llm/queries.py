"""The registered queries of this subpackage, each over its whole table.

Every query gets its rows from an operator beside it and only derives the
columns that the contract names; SQL twins stand where SQL can say the same.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbscope.llm import bpe, divergence, groups, katz, language, lattice, merkle, middle, onebit, packing, quality, toxicity, winnow
from kerbscope.llm.common import crc_fold, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lattice_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(read_table(spark, folder, "embeddings"), threshold=0.9)


def damaged_copies(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two copies of the archive, damaged by fixed arithmetic on the page id.

    First copy: every 1,747th page from 3 was never written.  Second copy: of every
    997 pages number 13 has another first character, of every 1,499 number 7 is
    lost, of every 1,999 number 5 was written twice.
    """
    page = F.col("page_id")
    first = pages.where(~F.coalesce(page % 1747 == 3, F.lit(False)))
    kept = pages.where(~F.coalesce(page % 1499 == 7, F.lit(False)))
    broken = F.when(page % 997 == 13, F.concat(F.lit("X"), F.substring("html", 2, 2**31 - 1))).otherwise(F.col("html"))
    second = kept.withColumn("html", broken)
    return first, second.unionByName(second.where(page % 1999 == 5))


def op2_merkle_audit(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each damaged record and one (position -1) for each file, by comparing the trees of two copies."""
    copies = [merkle.warc_records(c) for c in damaged_copies(read_table(spark, folder, "pages"))]
    depth = merkle.depth_for(*copies)
    first, second = (merkle.build(c, depth) for c in copies)
    found = merkle.audit(first, second)
    a = merkle.roots(first).select("file", "hash", "bytes")
    b = merkle.roots(second).select("file", F.col("hash").alias("other"), F.col("bytes").alias("other_bytes"))
    files = a.join(b, "file", "full").select(
        "file",
        F.lit(-1).cast("long").alias("position"),
        F.when(F.col("hash").eqNullSafe(F.col("other")), "same file").otherwise("other file").alias("kind"),
        F.lit(0).cast("long").alias("offset"),
        "bytes",
        "other_bytes",
    )
    return found.unionByName(files).fillna(0, ["bytes", "other_bytes"])


_OP2_SQL = r"""
WITH pages_2 AS (
  SELECT page_id AS position, regexp_extract(coalesce(url, ''), '^[a-z]+://([^/]*)', 1) AS file,
         strlen('WARC/1.0') + strlen('WARC-Type: response') + strlen('WARC-Target-URI: ') + strlen('Content-Length: ') + 14
           + strlen(coalesce(url, '')) + strlen(strlen(html)::varchar) + strlen(html) AS bytes,
         page_id % 1747 = 3 AS not_a, page_id % 1499 = 7 AS not_b, page_id % 997 = 13 AND substr(html, 1, 1) <> 'X' AS broken, page_id % 1999 = 5 AS twice
  FROM pages),
placed AS (
  SELECT *, coalesce(sum(CASE WHEN not_a THEN 0 ELSE bytes END) OVER (PARTITION BY file ORDER BY position
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM pages_2),
apart AS (
  SELECT file, position, CASE WHEN not_b THEN 'missing' WHEN not_a THEN 'extra' ELSE 'changed' END AS kind, place,
         CASE WHEN not_a THEN 0 ELSE bytes END AS bytes,
         CASE WHEN not_b THEN 0 ELSE bytes * CASE WHEN twice THEN 2 ELSE 1 END END AS other_bytes
  FROM placed WHERE (not_a OR not_b OR broken OR twice) AND NOT (not_a AND not_b)),
files AS (
  SELECT file, sum(CASE WHEN NOT not_a THEN bytes END) AS bytes,
         sum(CASE WHEN NOT not_b THEN bytes * CASE WHEN twice THEN 2 ELSE 1 END END) AS other_bytes
  FROM pages_2 GROUP BY file)
SELECT file, position::bigint AS position, kind, place::bigint AS "offset", bytes::bigint AS bytes, other_bytes::bigint AS other_bytes FROM apart
UNION ALL
SELECT file, -1::bigint, CASE WHEN file IN (SELECT file FROM apart) THEN 'other file' ELSE 'same file' END, 0::bigint, coalesce(bytes, 0)::bigint, coalesce(other_bytes, 0)::bigint
FROM files WHERE bytes IS NOT NULL OR other_bytes IS NOT NULL
"""


def op3_katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = F.coalesce(crc_fold("doc_id", 7) == 2, F.lit(False))
    return katz.score(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_winnowed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every text without its repeated runs, and which lines were removed."""
    return winnow.remove_repeats(read_table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_lines",
        F.coalesce(F.aggregate("removed", F.lit(0), lambda n, r: n + r["end"] - r["start"] + 1), F.lit(0)).alias("n_removed"),
        F.array_join(F.transform("removed", lambda r: F.concat_ws("-", r["start"], r["end"])), " ").alias("removed_lines"),
        "text",
    )


def op5_onebit_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return onebit.search(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_kernel_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False))
    model = language.train(docs.where(~held_out))
    return language.predict(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_bitmap_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(read_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_clause_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False))
    model = toxicity.train(docs, read_table(spark, folder, "labels").where(~held_out))
    return toxicity.predict(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_configuration_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op10_group_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return groups.near_duplicates(read_table(spark, folder, "documents"), percent=80)


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read_table(spark, folder, "documents"), min_docs=3, top=200)


_OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
used AS (
  SELECT row, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row, lang, source, unnest(terms) AS term FROM docs)),
kept AS (SELECT lang, term FROM used GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
named AS (SELECT DISTINCT lang, source, false AS whole FROM docs UNION ALL SELECT DISTINCT lang, '', true FROM docs),
seen AS (
  SELECT lang, source, false AS whole, term, count(*) AS n FROM used GROUP BY lang, source, term
  UNION ALL SELECT lang, '', true, term, count(*) FROM used GROUP BY lang, term),
counted AS (
  SELECT g.lang, g.source, g.whole, k.term, coalesce(s.n, 0) AS n, z.v
  FROM named g JOIN kept k ON k.lang = g.lang JOIN sizes z ON z.lang = g.lang
  LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.whole = g.whole AND s.term = k.term),
shared AS (
  SELECT lang, source, whole, term, n,
         1 + (1000000000::hugeint * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source, whole) + v) AS p
  FROM counted),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  WHERE NOT a.whole AND NOT b.whole GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM named a JOIN named b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  WHERE NOT a.whole AND NOT b.whole),
terms AS (
  SELECT a.lang, a.source, a.term AS item, (a.p - b.p) * (a.p - b.p) // b.p AS value
  FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND NOT a.whole AND b.whole
  WHERE a.n > 0 AND a.p > b.p),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms))
SELECT lang, source, part, item, value::bigint AS value, rank::integer AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op12_swar_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = middle.transform(read_table(spark, folder, "documents"))
    restored = middle.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


_OP12_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit,
         sha256('1:' || coalesce(doc_id::varchar, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(unit) AS n, ('0x' || h[1:8])::bigint AS h1, ('0x' || h[9:16])::bigint AS h2,
         ('0x' || h[17:24])::bigint AS h3, ('0x' || h[25:32])::bigint AS h4
  FROM units),
placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(unit[1:a], ''), '') AS prefix, coalesce(array_to_string(unit[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(unit[b + 1:n], ''), '') AS suffix
  FROM placed),
written AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
  FROM parts)
SELECT doc_id, n::bigint AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::bigint END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::bigint END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM written
"""


def op13_risk_controlled(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.filter_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT row, i, array_to_string(words[i:i + 4], ' ') AS five
  FROM (SELECT row, words, unnest(generate_series(1, len(words) - 4)) AS i FROM docs)),
again AS (
  SELECT row, count(DISTINCT place) AS n
  FROM (SELECT row, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS place
        FROM (SELECT *, count(*) OVER (PARTITION BY row, five) AS uses FROM windows) WHERE uses > 1)
  GROUP BY row),
lines AS (
  SELECT row, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS line FROM docs),
counted AS (
  SELECT d.row, doc_id, lang, len(words)::bigint AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols,
         len(line)::bigint AS n_lines, (len(line) - len(list_distinct(line)))::bigint AS n_dup_lines, coalesce(a.n, 0)::bigint AS n_repeat_words
  FROM docs d JOIN lines USING (row) LEFT JOIN again a USING (row)),
rated AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         [len([c FOR c IN [500, 300, 200, 100, 50, 20, 10] IF 1000 * n_symbols > c * word_chars]),
          len([c FOR c IN [15000, 12000, 10000, 9000, 8000, 7500, 7000, 6500, 6000] IF 1000 * word_chars > c * n_words]),
          len([c FOR c IN [1500, 2000, 2500, 3000, 3500, 4000] IF 1000 * word_chars < c * n_words]),
          len([c FOR c IN [900, 800, 700, 600, 500, 400, 300, 200] IF 1000 * n_dup_lines > c * n_lines]),
          len([c FOR c IN [175, 150, 125, 100, 75, 50] IF 1000 * n_repeat_words > c * n_words])] AS levels
  FROM counted),
told AS (SELECT doc_id, min(quality) AS label FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)),
judged AS (
  SELECT lang, label, unnest([1, 2, 3, 4, 5]) AS rule, unnest(levels) AS level
  FROM (SELECT DISTINCT lang, doc_id, levels, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words FROM rated WHERE NOT base_failed) JOIN told USING (doc_id)),
tested AS (
  SELECT lang, rule, cut, count(*) FILTER (label = 1) AS n, count(*) FILTER (label = 0) AS bad,
         count(*) FILTER (label = 1 AND level >= cut) AS k, count(*) FILTER (label = 0 AND level >= cut) AS caught
  FROM judged, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS cut) WHERE cut <= [7, 9, 6, 8, 6][rule] GROUP BY lang, rule, cut),
bounded AS (
  SELECT *, (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.01) + (n - j) * ln(0.99)))
             FROM (SELECT unnest(generate_series(0, k)) AS j)) AS tail
  FROM tested WHERE n > k),
sound AS (
  SELECT *, (SELECT count(*) FROM bounded o WHERE o.lang = b.lang AND o.rule = b.rule AND o.cut >= b.cut
             AND o.tail <= 0.05 / (5 * (SELECT count(DISTINCT lang) FROM judged WHERE label = 1))) AS passed
  FROM bounded b),
chosen AS (
  SELECT lang, rule, cut FROM sound WHERE passed = [7, 9, 6, 8, 6][rule] - cut + 1 AND caught * n > k * bad
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY caught * n - k * bad DESC, cut DESC) = 1),
rejected AS (SELECT DISTINCT row FROM rated r JOIN chosen c ON c.lang = r.lang AND r.levels[c.rule] >= c.cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND row NOT IN (SELECT row FROM rejected) AS kept
FROM rated
"""


def queries() -> dict[str, Query]:
    return {
        "op1_lattice_near_duplicates": op1_lattice_near_duplicates,
        "op2_merkle_audit": op2_merkle_audit,
        "op3_katz_scores": op3_katz_scores,
        "op4_winnowed_lines": op4_winnowed_lines,
        "op5_onebit_neighbours": op5_onebit_neighbours,
        "op6_kernel_language": op6_kernel_language,
        "op7_bitmap_bpe": op7_bitmap_bpe,
        "op8_clause_toxicity": op8_clause_toxicity,
        "op9_configuration_packing": op9_configuration_packing,
        "op10_group_jaccard": op10_group_jaccard,
        "op11_source_divergence": op11_source_divergence,
        "op12_swar_middle": op12_swar_middle,
        "op13_risk_controlled": op13_risk_controlled,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_merkle_audit": _OP2_SQL,
        "op11_source_divergence": _OP11_SQL,
        "op12_swar_middle": _OP12_SQL,
        "op13_risk_controlled": _OP13_SQL,
    }
