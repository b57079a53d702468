"""Packing of token sequences by a configuration linear program.

A *configuration* is a multiset of piece lengths that fits one sequence.  The
program asks for as few configurations as possible so that every length of the
histogram is covered.  It is solved on the histogram alone, which has at most
``capacity`` entries however many documents there are:

* multiplicative weights keep one price per length, high where coverage lags;
* a knapsack dynamic program over the prices finds, for every length at once,
  the best configuration that holds it; those within ``SLACK`` of the best get
  a share of the demand, and the prices of what they cover fall (no length is
  covered ahead of the others by more than a step, nor beyond its demand);
* the shares are rounded and cut to what is still there, and what is left over
  goes into free room by best fit, longest first.

The pieces themselves stay distributed: the n-th piece of a length takes the
n-th slot that the plan has for that length.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.llm.arrays import release, text_slices
from kerbscope.staging import stage

ROUNDS = 64
SLACK = 0.02
RATE = 4.0

#: Words kept per worker with their ids, and the longest of them in bytes.
CACHED_WORDS = 450_000
CACHED_LENGTH = 64
SLICE_BYTES = 2_000_000


# ------------------------------------------------------------------ tokens


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ASCII white space; what ends a letter of the first 256 characters or a digit; and
#: marks.  Marks at the end of a word, right after a letter or digit, are tokens of
#: their own, so the word is the same as without them.  Not with an apostrophe, which
#: may begin a suffix, nor a bar, which ends special tokens.
_BLANK = _class((0x09, 0x0D), (0x20, 0x20))
_ALNUM = _class((ord("a"), ord("z")), (ord("0"), ord("9")))
_AFTER_C3 = _class((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))
_MARK = _class((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7B), (0x7D, 0x7E))
_FIRST_BLANK = re.compile(rb"[\x09-\x0d ]")


def _lower(data: bytes) -> bytes:
    """ASCII letters in lower case, as the tokenizer has them, but for words with ``<|``.

    A special token is one in its own spelling only, so such words stay for the
    tokenizer to judge.
    """
    low = data.lower()
    at = data.find(b"<|")
    if at < 0:
        return low
    kept = bytearray(low)
    while at >= 0:
        start = max(data.rfind(blank, 0, at) for blank in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) + 1
        end = _FIRST_BLANK.search(data, at)
        stop = end.start() if end else len(data)
        kept[start:stop] = data[start:stop]
        at = data.find(b"<|", stop)
    return bytes(kept)


def split_words(data: bytes) -> tuple[pa.BinaryArray, np.ndarray]:
    """The parts between ASCII white space, marks at their ends apart, and where each begins."""
    raw = np.frombuffer(data, np.uint8)
    blank = _BLANK[raw]
    begins = ~blank
    begins[1:] &= blank[:-1]
    last = np.flatnonzero(~blank & np.r_[blank[1:], True])
    last = last[_MARK[raw[last]]]
    if len(last):
        place = np.arange(len(raw), dtype=np.int32 if len(raw) < 2**31 else np.int64)
        place[_MARK[raw]] = -1
        before = np.maximum.accumulate(place)[last]
        before = before[before >= 0]
        byte = raw[before]
        letter = _ALNUM[byte] | (_AFTER_C3[byte] & (raw[before - 1] == 0xC3) & (before > 0))
        begins[before[letter] + 1] = True
    starts = np.flatnonzero(begins)
    held = ~blank
    solid = raw[held]
    offsets = (np.cumsum(held) - held)[starts] if len(starts) else starts
    ends = np.append(offsets, len(solid)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(solid.tobytes())]), starts


def _as_bytes(words: pa.BinaryArray) -> list[bytes]:
    """As ``to_pylist`` of an array without nulls, some times faster."""
    data = words.buffers()[2]
    raw = data.to_pybytes() if data is not None else b""
    edges = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    return [raw[a:b] for a, b in zip(edges, edges[1:])]


class WordIds:
    """Ids of words (unsigned little-endian 32 bit) by the tokenizer.

    Words met lately are kept, in two generations: when the younger is full it
    becomes the older, whose words come back as they are met.  Results do not depend
    on what is kept.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def of(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        known, old = self.young, self.old
        new = [w for w in words if w not in known]
        known.update({w: old[w] for w in new if w in old})
        new = [w for w in new if w not in old]
        for k in range(0, len(new), 10_000):
            self._learn(new[k : k + 10_000])
        found = list(map(known.__getitem__, words))
        for word in new:
            if len(word) > CACHED_LENGTH:
                del known[word]
        if len(known) > CACHED_WORDS // 2:
            self.old, self.young = known, {}
        return found

    def _learn(self, words: list[bytes]) -> None:
        """Words of plain letters have one end mark each, so many are encoded as one
        text and told apart by it; all others are encoded one by one."""
        plain = [w for w in words if w.isalpha() and len(w) <= CACHED_LENGTH]
        other = []
        for word in words:
            if not word.isalpha() or len(word) > CACHED_LENGTH:
                text = word.decode()
                (plain if len(word) <= CACHED_LENGTH and text.isalpha() and max(text) < "\u0100" else other).append(word)
        groups = [plain[k : k + 100] for k in range(0, len(plain), 100)]
        texts = [b" ".join(group).decode() for group in groups]
        for group, made in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(made.ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) != len(group):
                other += group
                continue
            data = ids.tobytes()
            self.young.update(zip(group, [data[a:b] for a, b in zip([0, *stops], stops)]))
        for word, made in zip(other, self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)):
            self.young[word] = np.array(made.ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def text_ids(texts: list[bytes], tokenizer_path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by ``end_id``, and how many each has.

    The tokenizer drops white space and no token spans it, so a text is the row of
    its words' ids.  A text is worked on in parts that end at white space.
    """
    known = _word_ids(tokenizer_path)
    data = _lower(b"\n".join([*texts, b""]))
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    made, sizes = [], np.zeros(len(texts), np.int64)
    at = 0
    while at < len(data):
        stop = _FIRST_BLANK.search(data, min(at + SLICE_BYTES, len(data) - 1)).end()
        words, starts = split_words(data[at:stop])
        coded = words.dictionary_encode()
        ids = known.of(_as_bytes(coded.dictionary))
        length = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        code = coded.indices.to_numpy()
        many = length[code]
        ends = np.cumsum(many, dtype=np.int32)
        shift = (np.cumsum(length, dtype=np.int32) - length)[code] - (ends - many)
        place = np.repeat(shift, many)
        place += np.arange(len(place), dtype=np.int32)
        made.append(flat[place])
        row = np.searchsorted(first, starts + at, "right") - 1
        sizes += np.bincount(row, many, len(texts)).astype(np.int64)
        at = stop
    whole = np.concatenate([np.empty(0, "<u4"), *made])
    return np.insert(whole, np.cumsum(sizes), end_id), sizes + 1


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``id_col``, ``piece`` int, ``start`` long, ``length`` long, ``ids`` binary.

    A document is its tokens, then ``end_id``; ids are packed as unsigned
    little-endian 32-bit numbers.  Only a document of more than ``capacity`` ids
    is cut, into pieces of ``capacity`` and a rest.  Each distinct word of a slice of
    texts is looked up once.  A null text counts as empty: one piece with the end
    alone.  Null and repeated ids are kept, row for row; other columns are not read.
    """

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = rows.column(1).cast(pa.binary()).fill_null(b"").to_pylist()
        ids, sizes = text_ids(texts, tokenizer_path, end_id)
        many = -(-sizes // capacity)
        row = np.repeat(np.arange(len(sizes)), many)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        start = piece * capacity
        length = np.minimum(sizes[row] - start, capacity)
        edges = np.r_[0, np.cumsum(length * 4)].astype(np.int32)
        data = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(ids.tobytes())])
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), data],
            ["id", "piece", "start", "length", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1), SLICE_BYTES):
                yield cut(batch.slice(part.start, part.stop - part.start))
                release()

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


# ------------------------------------------------------------------ the program


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity``: the best total price, and the last piece taken (-1: none)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room], last[room] = best[room - 1], -1
        n = fits[room]
        if n:
            worth = prices[:n] + best[room - lengths[:n]]
            k = int(worth.argmax())
            if worth[k] > best[room] + 1e-15:
                best[room], last[room] = worth[k], k
    return best, last


def _unwind(last: np.ndarray, lengths: np.ndarray, room: int) -> list[int]:
    taken = []
    while room > 0:
        k = last[room]
        if k < 0:
            room -= 1
        else:
            taken.append(int(k))
            room -= int(lengths[k])
    return taken


def configuration_program(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[dict[tuple[int, ...], float], float]:
    """Fractional configurations (lengths, longest first) and a lower bound on any packing.

    Scaled prices are a solution of the dual, so the best round's value bounds
    the number of sequences from below.
    """
    lengths = np.array(sorted(counts))
    demand = np.array([counts[n] for n in lengths], float)
    covered = np.zeros(len(lengths))
    use: dict[tuple[int, ...], float] = {}
    bound = 0.0
    for step in range(rounds):
        # Weights start at the volume prices and fall with coverage.
        ahead = covered - covered.min(initial=0)
        prices = lengths / capacity * np.exp(-RATE * ahead)
        best, last = knapsack(lengths, prices, capacity)
        bound = max(bound, float(demand @ prices) / best[capacity])
        value = prices + best[capacity - lengths]
        lag = (step + 1) / rounds - covered
        # Lengths behind schedule ask first; a configuration grows until one of its lengths is ahead.
        due, most = (step + 1) / rounds, min(1.0, (step + 2) / rounds)
        for k in np.argsort((covered - due) * demand, kind="stable"):
            if covered[k] >= due or value[k] < (1 - SLACK) * best[capacity]:
                continue
            taken = Counter([int(k), *_unwind(last, lengths, capacity - int(lengths[k]))])
            amount = min((most - covered[j]) * demand[j] / a for j, a in taken.items())
            if amount <= 0:
                continue
            config = tuple(sorted((int(lengths[j]) for j in taken.elements()), reverse=True))
            use[config] = use.get(config, 0.0) + amount
            for j, a in taken.items():
                covered[j] += a * amount / demand[j]
    return use, bound


def _round(use: dict[tuple[int, ...], float], left: Counter, carry: bool) -> Counter:
    """Whole configurations that ``left`` can fill, fullest first; what they take goes from ``left``.

    The fractions are carried along from one configuration to the next, or dropped.
    """
    chosen: Counter = Counter()
    carried = 0.0
    for config in sorted(use, key=lambda c: (-sum(c), c)):
        wanted = use[config] + (carried if carry else 0.0)
        carried = wanted - int(wanted)
        need = Counter(config)
        fits = min(int(wanted), *(left[n] // a for n, a in need.items()))
        if fits > 0:
            chosen[config] += fits
            for n, a in need.items():
                left[n] -= fits * a
    return chosen


def _fill(chosen: Counter, left: Counter, capacity: int) -> Counter:
    """What is left goes by best fit, longest first; sequences of equal content are handled together."""
    room: dict[int, Counter] = {}
    for config, n in chosen.items():
        room.setdefault(capacity - sum(config), Counter())[config] += n
    for length in sorted((n for n, c in left.items() if c), reverse=True):
        todo = left[length]
        while todo:
            free = min((f for f in room if f >= length and room[f]), default=None)
            if free is None:
                per = capacity // length
                full, rest = divmod(todo, per)
                for size, n in ((per, full), (rest, 1)):
                    if size and n:
                        room.setdefault(capacity - size * length, Counter())[(length,) * size] += n
                todo = 0
                continue
            config, n = room[free].popitem()
            used = min(n, todo)
            if n > used:
                room[free][config] = n - used
            if not room[free]:
                del room[free]
            room.setdefault(free - length, Counter())[(*config, length)] += used
            todo -= used
    final: Counter = Counter()
    for kinds in room.values():
        for config, n in kinds.items():
            final[tuple(sorted(config, reverse=True))] += n
    return final


def plan(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[Counter, float]:
    """How many sequences of each configuration hold exactly ``counts``; and the lower bound.

    Of the two ways to round, the one with fewer sequences is taken: carried
    fractions suit many small shares, dropped ones few pieces of each length.
    """
    pieces = Counter({int(n): int(c) for n, c in counts.items() if c > 0})
    if not pieces:
        return Counter(), 0.0
    use, bound = configuration_program(pieces, capacity, rounds)
    plans = []
    for carry in (True, False):
        left = pieces.copy()
        plans.append(_fill(_round(use, left, carry), left, capacity))
    return min(plans, key=lambda p: sum(p.values())), bound


@dataclass(frozen=True)
class Slots:
    """The plan as sorted arrays: slot number within all slots, by length."""

    before: np.ndarray  # slots of smaller lengths, by length
    first: np.ndarray  # first slot of each entry
    per: np.ndarray  # pieces of that length in one sequence
    sequence: np.ndarray  # first sequence of the entry
    offset: np.ndarray  # place of the first piece
    size: np.ndarray  # the length

    @staticmethod
    def of(chosen: Counter, capacity: int) -> Slots:
        rows, base = [], 0
        for config in sorted(chosen):
            at = 0
            for length, per in sorted(Counter(config).items(), reverse=True):
                rows.append((length, base, per, at, chosen[config]))
                at += length * per
            base += chosen[config]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        slots = table[:, 2] * table[:, 4]
        total = np.zeros(capacity + 2, np.int64)
        np.add.at(total, table[:, 0] + 1, slots)
        return Slots(np.cumsum(total), np.cumsum(slots) - slots, table[:, 2], table[:, 1], table[:, 3], table[:, 0])

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``number``-th piece (from 0) of each length."""
        slot = self.before[length] + number
        entry = np.searchsorted(self.first, slot, "right") - 1
        within = slot - self.first[entry]
        return self.sequence[entry] + within // self.per[entry], self.offset[entry] + within % self.per[entry] * self.size[entry]


# ------------------------------------------------------------------ the table


def pack(table: DataFrame, capacity: int, rounds: int = ROUNDS, length_col: str = "length") -> DataFrame:
    """All columns of ``table``, then ``sequence_id`` long and ``offset`` long.

    Every row is one piece; its length must be from 1 to ``capacity``, anything
    else (null too) is an error.  Rows are numbered within (task, length) as they
    are written; the tasks' counts by length, at most ``capacity`` rows a task, are
    summed before each, so no length meets in one task.  The driver sees the
    histogram only.  Columns of ``table`` named like the two new ones are replaced.
    """
    kept = table.drop("sequence_id", "offset")
    names = kept.columns
    at = names.index(length_col)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch.column(at)
            length = sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(length) and (length.min() < 1 or length.max() > capacity):
                raise ValueError(f"a length is not from 1 to {capacity}")
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
            local = np.empty(len(order), np.int64)
            local[order] = rank + seen[ordered]
            np.add.at(seen, length, 1)
            inner = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema)) if names else None
            yield pa.RecordBatch.from_arrays([inner, pa.array(length), pa.array(np.full(len(length), part, np.int32)), pa.array(local)], ["row", "length", "part", "local"])

    numbered = stage(kept.mapInArrow(number, f"row {kept.schema.simpleString()}, length long, part int, local long"), "pieces")
    by_task = numbered.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = {r.length: r.n for r in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen, _ = plan(histogram, capacity, rounds)
    slots = Slots.of(chosen, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(k).to_numpy() for k in (1, 2))
            sequence, offset = slots.place(length, number)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(offset)], ["row", "sequence_id", "offset"])

    rows = numbered.join(starts, ["part", "length"]).select("row", "length", (F.col("before") + F.col("local")).alias("number"))
    placed = rows.mapInArrow(place, f"row {kept.schema.simpleString()}, sequence_id long, offset long")
    return placed.select(*[F.col("row").getField(n).alias(n) for n in names], "sequence_id", "offset")
