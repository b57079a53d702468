"""Repeated runs of lines, found by winnowing over line hashes.

A line ends at a line break or at the end of a sentence.  A *window* is the least
number of lines from some line on (or up to some line) that has ``min_words`` words.

1. *Fingerprints.*  Of every window, the line with the least hash, led by its number
   of words, is a fingerprint.
   A run of ``min_words`` words that occurs twice holds the window that begins with
   it in both places, hence a fingerprint at the same place in both; so nothing is
   lost, whatever lies around the run.
2. *Positions.*  Fingerprints that occur once in all texts end here, and with them
   most texts.  The others are brought back to their texts.
3. *Extension.*  In these texts, each window whose fingerprint was met is named by a
   hash of its lines, and so is the window that ends at each line further on:
   matches grow line by line both ways for as long as such a window occurred before.
   A window that is not the first of its name (by id, then place) is a repeat.
4. *Deletion.*  The union of a text's repeats is cut.

By these steps a line is deleted if and only if it lies in a run of ``min_words``
words that occurred before.  A deleted line equals an earlier one, hence the first
occurrence of every line stays.  Very common lines make few rows: only their
fingerprints are counted, and windows around them are told apart by all their lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.arrays import mix, release, text_slices
from kerbscope.staging import scratch, stage

MIN_WORDS = 25
SLICE_BYTES = 4_000_000

_BREAK = re.compile(r"((?<=[.!?])[ \t]+|\n)")
_SPACE = " \t\n\r\x0b\x0c"
_BLANK = np.zeros(256, bool)
_BLANK[list(_SPACE.encode())] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


def split_lines(text: str) -> list[str]:
    """Lines and what separates them, in turn: as many separators as lines, but one."""
    return _BREAK.split(text)


@dataclass(frozen=True)
class Lines:
    """The lines with a word of several texts, one after the other."""

    hashes: np.ndarray
    words: np.ndarray  # number of words
    first: np.ndarray  # first line of each text, and the end

    def ranks(self) -> np.ndarray:
        """Hashes led by the number of words, most first: lines of few words, which many texts have, are rarely least."""
        return (np.uint64(255) - np.minimum(self.words, 255).astype(np.uint64)) << np.uint64(56) | self.hashes >> np.uint64(8)

    @staticmethod
    def of(texts: list[bytes]) -> Lines:
        """Words lie between ASCII white space; how much of it there is within a line does not count, case does."""
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        base = np.cumsum([0, *(len(t) + 1 for t in texts)])
        blank = _BLANK[raw]
        solid = ~blank
        starts = np.flatnonzero(solid & np.r_[True, blank[:-1]])
        if not len(starts):
            return Lines(np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64))
        ends = np.flatnonzero(solid & np.r_[blank[1:], True]) + 1
        # A line begins where the gap before the word has a break, or follows the end of a sentence.
        breaks = np.cumsum(raw == 10, dtype=np.int32)
        gap = ends[:-1]
        sentence = _STOP[raw[gap - 1]] & ((raw[gap] == 32) | (raw[gap] == 9))
        begins = np.flatnonzero(np.r_[True, (breaks[starts[1:]] > breaks[gap - 1]) | sentence])
        last = np.r_[begins[1:], len(starts)] - 1
        # One space before each word but for the first of a line: the words joined by one.
        kept = solid | np.r_[solid[1:], False]
        place = np.cumsum(kept, dtype=np.int32)
        joined = np.where(solid, raw, 32)[kept].astype(np.uint8).tobytes()
        cuts = zip((place[starts[begins]] - 1).tolist(), place[ends[last] - 1].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b]) for a, b in cuts], np.uint64)
        return Lines(hashes, last - begins + 1, np.searchsorted(starts[begins], base))


@dataclass(frozen=True)
class Windows:
    """First and last line of windows, in the order of the lines."""

    start: np.ndarray
    end: np.ndarray

    def least(self, ranks: np.ndarray) -> np.ndarray:
        """The line of least rank in each, the last of equal ones."""
        best = self.start.copy()
        for step in range(1, int((self.end - self.start).max(initial=0)) + 1):
            at = self.start + step
            inside = np.flatnonzero(at <= self.end)
            better = inside[ranks[at[inside]] <= ranks[best[inside]]]
            best[better] = at[better]
        return best

    def names(self, hashes: np.ndarray) -> np.ndarray:
        """A hash of the lines of each."""
        name = mix(hashes[self.start])
        for step in range(1, int((self.end - self.start).max(initial=0)) + 1):
            at = self.start + step
            inside = np.flatnonzero(at <= self.end)
            name[inside] = mix(name[inside] * np.uint64(0xBF58476D1CE4E5B9) + hashes[at[inside]])
        return name


def windows_from(lines: Lines, min_words: int) -> Windows:
    """For each line the least number of lines from it on with ``min_words`` words, if its text has them."""
    total = np.r_[0, np.cumsum(lines.words)]
    bound = np.repeat(lines.first[1:], np.diff(lines.first))
    start = np.arange(len(lines.words))
    end = np.searchsorted(total, total[:-1] + min_words) - 1
    held = end < bound
    return Windows(start[held], end[held])


def windows_to(lines: Lines, min_words: int) -> Windows:
    """For each line the least number of lines up to it with ``min_words`` words, if its text has them."""
    total = np.r_[0, np.cumsum(lines.words)]
    bound = np.repeat(lines.first[:-1], np.diff(lines.first))
    end = np.arange(len(lines.words))
    start = np.searchsorted(total, total[1:] - min_words, "right") - 1
    held = start >= bound
    return Windows(start[held], end[held])


def fingerprints(lines: Lines, min_words: int) -> np.ndarray:
    """The lines that are least in a window."""
    return np.unique(windows_from(lines, min_words).least(lines.ranks()))


def extensions(lines: Lines, met: np.ndarray, min_words: int) -> Windows:
    """Windows that may be repeats: those with a fingerprint among ``met`` (hashes), and the ones
    up to a line that begin as one of these does."""
    ahead = windows_from(lines, min_words)
    hit = np.isin(lines.hashes[ahead.least(lines.ranks())], met)
    # Where the window that begins at a line ends, if it was met.
    ends = np.full(len(lines.words) + 1, -1)
    ends[ahead.start[hit]] = ahead.end[hit]
    back = windows_to(lines, min_words)
    also = (ends[back.start] >= 0) & (ends[back.start] != back.end)
    return Windows(np.r_[ahead.start[hit], back.start[also]], np.r_[ahead.end[hit], back.end[also]])


def cut(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the lines in the union of ``spans``, and that union as runs (first and last line)."""
    parts = split_lines(text)
    place = [k for k, line in enumerate(parts[::2]) if line.strip(_SPACE)]
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    gone = {i for start, end in runs for i in range(2 * place[start], 2 * place[end] + 2)}
    return "".join(part for i, part in enumerate(parts) if i not in gone), runs


# ------------------------------------------------------------------ the tables


def _slices(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch.column(text_at), SLICE_BYTES):
            yield batch.slice(part.start, part.stop - part.start)
        release()


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values))


def text_lines(texts: DataFrame, min_words: int) -> DataFrame:
    """Of rows ``id``, ``text`` (no nulls): ``id``, ``body``, ``count``, ``hashes``, ``words`` and ``prints``, the hashes of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches, 1):
            raw = rows.column(1).cast(pa.binary()).to_pylist()
            lines = Lines.of(raw)
            found = fingerprints(lines, min_words)
            edges = np.searchsorted(found, lines.first)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([crc32(t) for t in raw], pa.int64()),
                    pa.array(np.diff(lines.first).astype(np.int32)),
                    _lists(lines.hashes.view(np.int64), lines.first),
                    _lists(lines.words.astype(np.int32), lines.first),
                    _lists(lines.hashes[found].view(np.int64), edges),
                ],
                ["id", "body", "count", "hashes", "words", "prints"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, body long, count int, hashes array<long>, words array<int>, prints array<long>")


def named_windows(texts: DataFrame, min_words: int) -> DataFrame:
    """Of rows ``id``, ``body``, ``hashes``, ``words``, ``met``: ``name``, ``id``, ``body``, ``start``, ``end`` of each window that may be a repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # All texts of the batch at once; a fingerprint met is so for any of them.
            hashes, words, met = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3, 4))
            first = np.r_[0, np.cumsum(batch.column(2).value_lengths().to_numpy())]
            lines = Lines(hashes.view(np.uint64), words.astype(np.int64), first)
            found = extensions(lines, np.unique(met.view(np.uint64)), min_words)
            row = np.searchsorted(first, found.start, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.names(lines.hashes).view(np.int64)),
                    *(batch.column(k).take(pa.array(row)) for k in (0, 1)),
                    *(pa.array((at - first[row]).astype(np.int32)) for at in (found.start, found.end)),
                ],
                ["name", "id", "body", "start", "end"],
            )
            release()

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"name long, id {kind}, body long, start int, end int")


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later repeated runs cut out of the text, then ``n_lines`` int and ``removed`` array.

    ``removed`` holds the first and last line of each deleted run, counting the
    lines that have a word from 0.  Before means a smaller id, or earlier in the same
    text; texts under one id follow a checksum.  Rows that repeat id and text are
    one text and are cut alike.  Null texts stay null (0 lines); rows with a null id
    are left as they are and nothing is compared with them.  All other columns are
    kept; ones named like the two new ones are replaced.
    """
    kept = docs.drop("n_lines", "removed")
    names = kept.columns
    texts = kept.select(kept[id_col].alias("id"), kept[text_col].alias("text")).where("id is not null and text is not null")
    with scratch(docs.sparkSession):
        # Written, because it is read often and costs more to make than to read.
        lines = stage(text_lines(texts, min_words), "lines")
        prints = lines.select("id", "body", F.explode("prints").alias("print"))
        met = stage(prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print"), "met")
        # As many prints as the text has lines at most.
        of_text = prints.join(met, "print").groupBy("id", "body").agg(F.collect_set("print").alias("met"))
        opened = lines.select("id", "body", "hashes", "words").join(of_text, ["id", "body"])
        found = stage(named_windows(opened, min_words), "windows")
        place = F.struct("id", "body", "start")
        first = found.groupBy("name").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("name", "first")
        later = found.join(stage(first, "firsts"), "name").where(place != F.col("first"))
        counts = lines.select("id", "body", "count")
        spans = later.select("id", "body", F.struct("start", "end").alias("span")).unionByName(counts, allowMissingColumns=True)
        cuts = stage(spans.groupBy("id", "body").agg(F.collect_set("span").alias("spans"), F.max("count").alias("count")), "spans", result=True)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                spans, count = part.column(2).to_pylist(), part.column(3).to_pylist()
                removed: list[list[dict]] = [[] for _ in spans]
                # Texts whose lines are counted and of which nothing goes are not opened.
                opened = [i for i, own in enumerate(spans) if own or count[i] is None]
                new, order = [], np.arange(len(part))
                for i, text in zip(opened, part.column(1).take(pa.array(opened, pa.int64())).to_pylist()):
                    if count[i] is None:
                        count[i] = len(Lines.of([(text or "").encode()]).words)
                    if spans[i]:
                        text, runs = cut(text, [(s["start"], s["end"]) for s in spans[i]])
                        removed[i] = [{"start": a, "end": b} for a, b in runs]
                    order[i] = len(part) + len(new)
                    new.append(text)
                texts = pa.concat_arrays([part.column(1), pa.array(new, pa.string())]).take(pa.array(order))
                made = [texts, pa.array(count, pa.int32()), pa.array(removed, shape)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], ["row", "text", "n_lines", "removed"])
            release()

    rest = [n for n in names if n != text_col]
    row = F.struct(*[kept[n] for n in rest]) if rest else F.struct(F.lit(0).alias("none"))
    body = F.crc32(F.col("text").cast("binary")).cast("long")
    whole = kept.select(row.alias("row"), kept[id_col].alias("id"), kept[text_col].alias("text")).withColumn("body", body)
    joined = whole.join(cuts, ["id", "body"], "left").select("row", "text", "spans", "count")
    rows = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(apply, f"row {rows}, text string, n_lines int, removed array<struct<start: int, end: int>>")
    return out.select(*[F.col("text").alias(n) if n == text_col else F.col("row").getField(n).alias(n) for n in names], "n_lines", "removed")
