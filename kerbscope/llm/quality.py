"""Quality rules whose cutoffs are chosen under a guarantee on false rejections.

Counts of a text give a few shares (``RULES``), each with a fixed row of cutoffs
from lenient to strict.  Labelled documents are the holdout that decides which
cutoffs may be used, for each stratum by itself:

* of the clean ones (label 1) that a cutoff rejects, the exact binomial upper
  bound (Clopper and Pearson) must not exceed the rule's part of ``risk``;
* the error ``alpha`` is divided among all rules of all strata, and within a rule
  cutoffs are tested from lenient to strict until one fails, which needs no
  further division.  So with probability ``1 - alpha`` no cutoff that is let
  through, in any stratum, rejects more than its part of clean documents, and all
  rules together at most ``risk``;
* among those let through the one that parts bad from clean documents best is
  used; where none rejects relatively more bad ones than clean ones, or where
  labels are too few to prove anything, the rule is off.

The cutoffs do not depend on the labels, so every label serves as holdout.
Documents that fail the base rule (few words, many repeats) are not judged again
and not counted.  One pass over the texts writes the counts; all else is sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.arrays import mix, release, text_slices
from kerbscope.staging import scratch, stage

RISK = 0.05
ALPHA = 0.05
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SLICE_BYTES = 4_000_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects where ``part`` is above (or below) ``cutoff`` thousandths of ``whole``."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[int, ...]
    above: bool = True

    def level(self) -> Column:
        """How many of the cutoffs reject the row: all from its own strictness on, as they are nested."""
        part, whole = F.col(self.part) * 1000, F.col(self.whole)
        hits = [(part > whole * c if self.above else part < whole * c).cast("int") for c in self.cutoffs]
        return sum(hits[1:], hits[0])


RULES = (
    Rule("symbols", "n_symbols", "word_chars", (500, 300, 200, 100, 50, 20, 10)),
    Rule("long words", "word_chars", "n_words", (15000, 12000, 10000, 9000, 8000, 7500, 7000, 6500, 6000)),
    Rule("short words", "word_chars", "n_words", (1500, 2000, 2500, 3000, 3500, 4000), above=False),
    Rule("repeated lines", "n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300, 200)),
    Rule("repeated words", "n_repeat_words", "n_words", (175, 150, 125, 100, 75, 50)),
)


# ------------------------------------------------------------------ counts


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def repeated_words(codes: np.ndarray, row: np.ndarray, n: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of ``n`` words that its text has twice or more.

    Windows are brought together by a hash and compared word by word.
    """
    count = len(codes) - n + 1
    inside = np.zeros(len(codes), bool)
    if count <= 0:
        return inside
    start = np.flatnonzero(row[:count] == row[n - 1 :])
    name = mix(row[start].astype(np.uint64) + np.uint64(1))
    for k in range(n):
        name = mix(name + codes[start + k].astype(np.uint64))
    order = np.argsort(name, kind="stable")
    alike = name[order][1:] == name[order][:-1]
    a, b = start[order[1:][alike]], start[order[:-1][alike]]
    differ = row[a] != row[b]
    for k in range(n):
        differ |= codes[a + k] != codes[b + k]
    if differ.any():
        keys = np.stack([*(codes[start + k] for k in range(n)), row[start]])
        order = np.lexsort(keys)
        alike = (keys[:, order[1:]] == keys[:, order[:-1]]).all(0)
        a, b = start[order[1:][alike]], start[order[:-1][alike]]
    edge = np.zeros(len(codes) + 1, np.int64)
    starts = np.union1d(a, b)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def text_counts(texts: pa.Array) -> list[np.ndarray]:
    """``COUNTS`` of each text (no nulls)."""
    lists = pc.ascii_split_whitespace(texts)
    words, sizes = lists.flatten(), lists.value_lengths().to_numpy()
    full = pc.not_equal(words, "")
    filled = full.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)[filled]
    words, sizes = words.filter(full), np.bincount(row, minlength=len(sizes))
    chars = _per_text(pc.utf8_length(words).to_numpy(), sizes)
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    repeats = _per_text(repeated_words(codes, row), sizes)

    joined = pa.concat_arrays([texts])  # a copy that begins at 0
    ends = np.r_[0, np.cumsum(pc.binary_length(joined).to_numpy().astype(np.int64))]
    data = joined.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    base = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset] if len(joined) else 0
    symbols = np.diff(np.searchsorted(np.flatnonzero(_SYMBOL[raw[base : base + ends[-1]]]), ends))

    split = pc.split_pattern(texts, "\n")
    lines = split.flatten()
    line_row = np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())
    held = pc.not_equal(pc.ascii_trim_whitespace(lines), "")
    line_row = line_row[held.to_numpy(zero_copy_only=False)]
    coded = lines.filter(held).dictionary_encode()
    n_lines = np.bincount(line_row, minlength=len(texts))
    pairs = np.unique(line_row * max(1, len(coded.dictionary)) + coded.indices.to_numpy())
    distinct = np.bincount(pairs // max(1, len(coded.dictionary)), minlength=len(texts))
    return [sizes, chars, symbols, n_lines, n_lines - distinct, repeats]


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Rows ``id``, ``stratum`` string (null: empty), ``COUNTS`` long and ``base_failed``; one a row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(2), SLICE_BYTES):
                rows = batch.slice(part.start, part.stop - part.start)
                made = [pa.array(v.astype(np.int64)) for v in text_counts(rows.column(2))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *made], ["id", "stratum", *COUNTS])
            release()

    source = docs.select(
        docs[id_col].alias("id"),
        F.coalesce(docs[stratum_col].cast("string"), F.lit("")).alias("stratum"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    kind = source.schema["id"].dataType.simpleString()
    fields = ", ".join(f"{n} long" for n in COUNTS)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return source.mapInArrow(run, f"id {kind}, stratum string, {fields}").withColumn("base_failed", failed)


# ------------------------------------------------------------------ cutoffs


def binomial_tail(hits: int, trials: int, chance: float) -> float:
    """Probability of at most ``hits`` in ``trials``, by its terms from the last one down."""
    if hits >= trials:
        return 1.0
    if hits > chance * trials:  # beyond the mean the terms do not fall; not needed there in full
        return 1.0 - _upper_tail(hits + 1, trials, chance)
    term = exp(lgamma(trials + 1) - lgamma(hits + 1) - lgamma(trials - hits + 1) + hits * log(chance) + (trials - hits) * log1p(-chance))
    total = 0.0
    for k in range(hits, -1, -1):
        total += term
        if term < total * 1e-18:
            break
        term *= k / (trials - k + 1) * (1 - chance) / chance
    return min(1.0, total)


def _upper_tail(hits: int, trials: int, chance: float) -> float:
    return binomial_tail(trials - hits, trials, 1 - chance)


def upper_bound(hits: int, trials: int, error: float) -> float:
    """Largest chance under which at most ``hits`` still has probability ``error``."""
    low, high = hits / trials if trials else 1.0, 1.0
    if hits >= trials:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(hits, trials, middle) > error else (low, middle)
    return high


def choose_level(clean: list[int], bad: list[int], risk: float, error: float) -> tuple[int, float]:
    """Least level that is rejected (0: rule off) and the bound on the share of clean ones that have it.

    ``clean`` and ``bad`` count the labelled documents by level, the number of
    cutoffs that reject them.
    """
    n_clean, n_bad = sum(clean), sum(bad)
    best, gain = 0, 0
    # The most lenient cutoff rejects the highest level alone.
    for level in range(len(clean) - 1, 0, -1):
        rejected, caught = sum(clean[level:]), sum(bad[level:])
        if not n_clean or binomial_tail(rejected, n_clean, risk) > error:
            break
        if caught * n_clean - rejected * n_bad > gain:
            best, gain = level, caught * n_clean - rejected * n_bad
    return best, upper_bound(sum(clean[best:]), n_clean, error) if best else 0.0


def cutoffs(rated: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Rows ``stratum``, ``rule``, ``level`` int, ``bound`` double for each rule that may be used; it rejects from that level on.

    ``rated`` has the rows of ``counts``.  Labels other than 0 and 1, null ids and
    ids with both labels are left out; rows that repeat an id and all counts count once.
    """
    told = (
        labels.select(labels[id_col].alias("id"), labels[label_col].alias("label"))
        .where("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    levels = F.explode(F.array(*[F.struct(F.lit(rule.name).alias("rule"), rule.level().alias("level")) for rule in RULES]))
    judged = rated.where(~F.col("base_failed")).distinct().join(told, "id").select("stratum", "label", levels.alias("l"))
    table = stage(judged.groupBy("stratum", "l.rule", "label", "l.level").agg(F.count(F.lit(1)).alias("n")), "levels")
    strata = table.where("label = 1").select("stratum").distinct().count()
    error = alpha / max(1, strata * len(RULES))
    part = risk / len(RULES)
    cut_rows = {rule.name: len(rule.cutoffs) for rule in RULES}

    def choose(key: tuple, rows: pa.Table) -> pa.Table:
        name = key[1].as_py()
        by = [[0] * (cut_rows[name] + 1), [0] * (cut_rows[name] + 1)]
        for label, level, n in zip(*(rows[c].to_pylist() for c in ("label", "level", "n"))):
            by[int(label)][level] += n
        level, bound = choose_level(by[1], by[0], part, error)
        return pa.table({"stratum": [key[0].as_py()], "rule": [name], "level": pa.array([level], pa.int32()), "bound": pa.array([bound], pa.float64())})

    # At most two rows for each cutoff of a rule meet in a call.
    return table.groupBy("stratum", "rule").applyInArrow(choose, "stratum string, rule string, level int, bound double").where("level > 0")


def judge(rated: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rated`` with ``rejected_by`` array (names of the rules, in their order) and ``kept`` boolean.

    A stratum without a row in ``chosen`` has no rule; then only the base rule decides.
    """
    used = stage(chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "level"))).alias("used")), "cutoffs")
    hits = [F.when(rule.level() >= F.col("used")[rule.name], F.lit(rule.name)) for rule in RULES]
    rejected = F.filter(F.array(*hits), lambda name: name.isNotNull())
    by = F.when(F.col("base_failed") | F.col("used").isNull(), F.array().cast("array<string>")).otherwise(rejected)
    return rated.join(used, "stratum", "left").withColumn("rejected_by", by).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("used")


def filter_documents(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    alpha: float = ALPHA,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
) -> DataFrame:
    """Rows ``id_col``, ``stratum``, ``COUNTS`` long, ``base_failed``, ``rejected_by``, ``kept``; one a row of ``docs``.

    A null text counts as empty and fails the base rule; null and repeated ids are
    kept row for row; no labels: only the base rule decides.  Other columns are not read.
    """
    rated = stage(counts(docs, id_col, text_col, stratum_col), "counts")
    with scratch(docs.sparkSession):
        chosen = stage(cutoffs(rated, labels, risk, alpha, id_col, label_col), "chosen", result=True)
    return judge(rated, chosen).withColumnRenamed("id", id_col)
