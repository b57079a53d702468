"""Fill-in-middle transformation; places of units found by arithmetic on eight bytes at a time.

A unit is a run of ASCII letters or one other code point.  UTF-8 bytes are viewed
as 64-bit words.  A byte ends a unit if the next byte does not continue a code
point and the two are not both letters; letters and continuing bytes are marked
in the top bits of a word by additions and shifts that cannot carry into the next
byte.  ``bitwise_count`` gives the units of each word and a running total their
number before each word.  The end of unit ``k`` is then a search in the totals for
the word and a look at eight prefix counts for the byte within it.

Two cuts split a text into prefix, middle and suffix, which are written as

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

and texts that are empty, hold a mark or are not drawn stay plain.  Cuts and draws
come from a SHA-256 of the id, so they do not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.arrays import release, text_slices

MARKS = (b"<P>", b"<S>", b"<M>")
#: Of a hundred texts, how many are cut, and how many of these put the suffix first.
CUT = 90
SUFFIX_FIRST = 20

SLICE_BYTES = 4_000_000


def _all(byte: int) -> np.uint64:
    return np.uint64(int.from_bytes(bytes([byte]) * 8, "little"))


_TOP, _LOW, _ONES, _CASE = _all(0x80), _all(0x7F), _all(0x01), _all(0x20)
_FROM_A, _PAST_Z = _all(0x80 - ord("a")), _all(0x80 - ord("z") - 1)


def unit_ends(words: np.ndarray) -> np.ndarray:
    """Top bit of every byte that ends a unit, in consecutive little-endian words of padded text."""
    low = (words | _CASE) & _LOW
    letter = (low + _FROM_A) & ~(low + _PAST_Z) & ~words & _TOP
    inner = words & ~(words << np.uint64(1)) & _TOP

    def following(marks: np.ndarray) -> np.ndarray:
        moved = marks >> np.uint64(8)
        moved[:-1] |= marks[1:] << np.uint64(56)
        return moved

    return _TOP & ~following(inner) & ~(letter & following(letter))


class Units:
    """Unit ends of several texts; each text has a word or more, of which a zero byte or more is padding."""

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) for t in texts], np.int64)
        full = size // 8
        last = np.cumsum(full + 1) - 1
        self.first = last - full
        buffer = bytearray(8 * (int(last[-1]) + 1 if len(texts) else 0))
        for at, text in zip((self.first * 8).tolist(), texts):
            buffer[at : at + len(text)] = text
        self.ends = unit_ends(np.frombuffer(buffer, "<u8"))
        self.ends[last] &= (np.uint64(1) << (8 * (size % 8)).astype(np.uint64)) - np.uint64(1)
        self.total = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)
        self.before = np.where(self.first > 0, self.total[self.first - 1], 0) if len(texts) else self.first
        self.count = self.total[last] - self.before

    def end_of(self, unit: np.ndarray) -> np.ndarray:
        """For each text, the bytes up to the end of its ``unit``-th unit (from 1); 0 for unit 0."""
        if not len(unit):
            return unit
        wanted = self.before + unit
        word = np.minimum(np.searchsorted(self.total, wanted), len(self.total) - 1)
        ends = self.ends[word]
        rank = wanted - (self.total[word] - np.bitwise_count(ends))
        upto = ((ends >> np.uint64(7)) * _ONES).astype("<u8").view(np.uint8).reshape(-1, 8)
        place = (upto < rank[:, None]).sum(1)
        return np.where(unit > 0, (word - self.first) * 8 + place + 1, 0)


def draws(id_column: Column) -> list[Column]:
    """Four numbers below 2**32 from the id written in decimals; a null id counts as no digits."""
    name = F.concat(F.lit("1:"), F.coalesce(id_column.cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Rows ``id_col``, ``n`` long, ``form``, ``prefix_chars``, ``middle_chars`` long, ``output``; one a row of ``docs``.

    ``n`` counts the units of the text; the lengths count code points and are null
    where ``form`` is plain.  A null text counts as empty.  Rows that repeat an id
    are cut by the same draws, each by its own ``n``.  Other columns are not read,
    texts are never split over tasks, and nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1), SLICE_BYTES):
                rows = batch.slice(part.start, part.stop - part.start)
                texts = rows.column(1).cast(pa.binary()).to_pylist()
                h1, h2, h3, h4 = (rows.column(k).to_numpy() for k in range(2, 6))
                units = Units(texts)
                one, two = h1 % (units.count + 1), h2 % (units.count + 1)
                first, second = (units.end_of(k).tolist() for k in (np.minimum(one, two), np.maximum(one, two)))
                form, prefix, middle, out = [], [], [], []
                for i, text in enumerate(texts):
                    if h3[i] % 100 >= cut or not text or any(mark in text for mark in MARKS):
                        form.append("plain")
                        prefix.append(None)
                        middle.append(None)
                        out.append(text)
                        continue
                    a, b = first[i], second[i]
                    head, inner, tail = text[:a], text[a:b], text[b:]
                    p, s, m = MARKS
                    swap = h4[i] % 100 < suffix_first
                    form.append("spm" if swap else "psm")
                    prefix.append(len(head.decode()))
                    middle.append(len(inner.decode()))
                    out.append(b"".join([s, tail, p, head, m, inner] if swap else [p, head, s, tail, m, inner]))
                made = [pa.array(units.count), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([rows.column(0), *made], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])
            release()

    source = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *[h.alias(f"h{k}") for k, h in enumerate(draws(docs[id_col]))])
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that such an output was made of.

    A cut text holds no mark, and none can arise at a seam (each begins with the
    only ``<`` that it has), so every mark stands in the output once.
    """
    mark = [m.decode() for m in MARKS]

    def until(text: Column, n: int) -> Column:
        return F.substring_index(text, mark[n], 1)

    def behind(n: int) -> Column:
        return F.substring_index(output, mark[n], -1)

    psm = F.concat(until(behind(0), 1), behind(2), until(behind(1), 2))
    spm = F.concat(until(behind(0), 2), behind(2), until(behind(1), 0))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
