"""Katz back-off language model: discounted counts, exact back-off weights, log10 scores of whole texts.

A model of order ``n`` predicts a word from the ``n - 1`` words before it.  Counts up
to ``TOP`` are discounted by Good-Turing, per order, and

    P(w | h) = d(c(hw)) c(hw) / C(h)   if hw was seen in training,
               a(h) P(w | h')          else,

where ``h'`` is ``h`` without its first word and ``a(h)`` is what the discounts set free
over the probability of all words not seen after ``h``, so every distribution
sums to one.  A word never seen backs off to one class of unknown words.

Texts are kept in blocks of some megabytes.  Statistics of n-grams live in
written tables dealt by ranges of the n-gram's hash (``ranges``): a block sends each of
its *distinct* n-grams once with the block's own count, the range adds them up and
answers each block in the order it asked.  There is a round for the n-grams of each
order and one for its contexts, whose weights need the probabilities of the
order below; these a block works out by the recursion above from the answers it
has.  A word that makes up a third of all tokens is one entry a block like any
other.  The range's task holds its own n-grams only; the number of ranges follows
the number of blocks.

n-grams are named by 64-bit hashes; a clash would merge two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.arrays import mix, pack, release, split_words, text_slices, unpack, word_numbers
from kerbscope.llm.ranges import answer, answers_of, asks, totals_of, with_answers
from kerbscope.staging import scratch, stage

ORDER = 2
TOP = 5
BLOCK_BYTES = 8_000_000

#: Hashes of what stands before and after a text; a word holds no white space, so none has these.
START, END = (xxhash.xxh64_intdigest(mark) for mark in (b"\n\n", b"\n"))


# ------------------------------------------------------------------ blocks


def number_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each distinct word (the end included, most frequent first), word numbers, tokens a text."""
    words, sizes = split_words(texts)
    number, names = word_numbers(words)
    names = np.append(names, np.uint64(END))
    ends = np.cumsum(sizes + 1) - 1
    tokens = np.full(len(number) + len(sizes), len(names) - 1)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner] = number
    rank = np.argsort(-np.bincount(tokens, minlength=len(names)), kind="stable")
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    return names[rank], place[tokens], sizes + 1


@dataclass
class Block:
    """Texts of a block by the numbers of their words, which are numbered within the block."""

    names: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    train: np.ndarray

    @staticmethod
    def read(names: bytes, tokens: bytes, sizes: bytes, train: bytes) -> Block:
        return Block(unpack(names, np.uint64), unpack(tokens, np.uint32).astype(np.int64), unpack(sizes, np.int64), unpack(train, np.uint8).astype(bool))

    def grams(self, order: int) -> list[Grams]:
        """Distinct n-grams of every order up to ``order``."""
        rank = np.argsort(self.names)
        place = np.empty_like(rank)
        place[rank] = np.arange(len(rank))
        learn = np.repeat(self.train, self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        which = place[self.tokens]
        none = np.empty(0, np.int64)
        found = [Grams(self.names[rank], np.bincount(which[learn], minlength=len(rank)), which, none, none, none)]
        # Names of the n-grams that end at each token, and of one that ends before a text.
        token = self.names[self.tokens]
        ending, padding = token, np.uint64(START)
        for _ in range(1, order):
            before = np.empty_like(ending)
            before[1:] = ending[:-1]
            before[first] = padding
            ending = mix(mix(before) + token)
            padding = mix(mix(np.array([padding])) + np.uint64(START))[0]
            names, at, which = np.unique(ending, return_index=True, return_inverse=True)
            contexts, own = np.unique(before[at], return_inverse=True)
            found.append(Grams(names, np.bincount(which[learn], minlength=len(names)), which, contexts, own, found[-1].which[at]))
        return found


@dataclass
class Grams:
    """Distinct n-grams of one order of a block, in order of their names."""

    names: np.ndarray
    counts: np.ndarray  # in training
    which: np.ndarray  # the n-gram that ends at each token
    contexts: np.ndarray  # names of what stands before the last word
    context: np.ndarray  # the context of each n-gram
    lower: np.ndarray  # the n-gram without its first word, one order below


def blocks(docs: DataFrame, train: Column, id_col: str, text_col: str) -> DataFrame:
    """Written table of blocks; a text is never split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch.column(1), BLOCK_BYTES):
                own = batch.slice(rows.start, rows.stop - rows.start)
                names, tokens, sizes = number_words(own.column(1))
                ids = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.concat_arrays([own.column(0)]))
                learn = own.column(2).fill_null(False).to_numpy(zero_copy_only=False)
                data = [pack(names), pack(tokens.astype(np.uint32)), pack(sizes.astype(np.int64)), pack(learn.astype(np.uint8))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | made], pa.int64()), ids, *(pa.array([x], pa.binary()) for x in data)],
                    ["block", "ids", "names", "tokens", "sizes", "train"],
                )
                made += 1

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), train.alias("train"))
    kind = source.schema["id"].dataType.simpleString()
    return stage(source.mapInArrow(run, f"block long, ids array<{kind}>, names binary, tokens binary, sizes binary, train binary"), "texts")


# ------------------------------------------------------------------ the model


def discounts(frequency: list[int]) -> np.ndarray:
    """Good-Turing discount of each count from 0 to ``TOP`` + 1 (and more): 1 above ``TOP``.

    ``frequency[r - 1]`` is how many n-grams have count ``r``, up to ``TOP`` + 1.
    Where the formula gives no share between 0 and 1 (sparse or odd counts), the
    count loses the share of an absolute discount instead.
    """
    n = [0, *frequency]
    rest = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else 1.0
    fixed = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
    out = np.ones(TOP + 2)
    for r in range(1, TOP + 1):
        share = 0.0
        if n[r] and rest < 1:
            share = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest)
        out[r] = share if 0 < share < 1 else 1 - min(0.9, max(0.1, fixed)) / r
    return out


@dataclass(frozen=True)
class Unigrams:
    tokens: int
    types: int
    discount: np.ndarray
    unknown: float  # probability of the class of unknown words
    scale: float

    @staticmethod
    def of(totals: list[int]) -> Unigrams:
        """From the frequencies of counts 1 to ``TOP`` + 1, the tokens and the types."""
        frequency, tokens, types = totals[: TOP + 1], totals[TOP + 1], totals[TOP + 2]
        cut = discounts(frequency)
        if not tokens:
            return Unigrams(0, 0, cut, 1.0, 0.0)
        free = sum((1 - cut[r]) * r * frequency[r - 1] for r in range(1, TOP + 1)) / tokens
        if free <= 0:  # no count is discounted: one token's worth for the unknown
            return Unigrams(tokens, types, cut, 1 / (tokens + 1), 1 / (tokens + 1))
        return Unigrams(tokens, types, cut, free, 1 / tokens)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discount[np.minimum(counts, TOP + 1)] * counts * self.scale, self.unknown)


def _count(begins: np.ndarray, columns: list[np.ndarray]) -> tuple[list[np.ndarray], list[int]]:
    """Total count of each entry's n-gram, twice, plus one for the entry that stands for it."""
    own = columns[0].astype(np.int64)
    total = np.add.reduceat(own, begins) if len(own) else own
    size = np.diff(np.r_[begins, len(own)])
    # The first entry with a count stands for the n-gram.
    before = np.cumsum(own > 0) - (own > 0)
    stands = (own > 0) & (before == np.repeat(before[begins], size))
    frequency = [int((total == r).sum()) for r in range(1, TOP + 2)]
    return [(2 * np.repeat(total, size) + stands).astype(np.uint64)], [*frequency, int(total.sum()), int((total > 0).sum())]


def _weigh(floor: float):
    def solve(begins: np.ndarray, sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[int]]:
        """Denominator and back-off weight of each context."""
        size = np.diff(np.r_[begins, len(sums[0])])
        total, free, covered = (np.add.reduceat(s, begins) for s in sums)
        full = (total > 0) & (free <= 0)  # nothing was discounted: one count's worth
        below = np.where(full, total + 1, np.maximum(total, 1))
        share = np.where(full, 1.0, free) / below
        weight = np.where(total > 0, share / np.maximum(1 - covered, floor), 1.0)
        return [np.repeat(np.where(total > 0, below, 0.0), size), np.repeat(weight, size)], [int((total > 0).sum())]

    return solve


def log_chances(grams: list[Grams], counts: list[np.ndarray], cuts: list[np.ndarray], contexts: list[tuple], single: Unigrams) -> np.ndarray:
    """log10 P of the last word of each n-gram of the highest order there are contexts for, order by order.

    ``counts`` and ``contexts`` (denominators and weights) are what the ranges answered.
    """
    value = np.log10(single.probability(counts[0]))
    for k, (below, weight) in enumerate(contexts, 1):
        own, seen = grams[k], counts[k]
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = np.log10(cuts[k][np.minimum(seen, TOP + 1)] * seen / below[own.context])
        value = np.where(seen > 0, direct, np.log10(weight[own.context]) + value[own.lower])
    return value


def score(docs: DataFrame, train: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``train_types`` long, ``base_score``, ``score`` double.

    The model of that ``order`` learns from the rows where ``train`` is true (null: false)
    and scores every row.  A null or empty text is the end token alone; a text,
    however long, is never split.  Null and repeated ids are kept row for row.
    Without training rows every word is unknown and has probability 1; a table
    without rows gives none.
    """
    if order < 1:
        raise ValueError("the order of the model must be 1 or more")
    kind = docs.schema[id_col].dataType.simpleString()
    out = "n_tokens long, n_known long, train_tokens long, train_types long, base_score double, score double"
    with scratch(docs.sparkSession):
        table = blocks(docs, train, id_col, text_col)
        bits = max(0, (table.count() - 1).bit_length())
        plain = table.select("block", "names", "tokens", "sizes", "train")

        def each_block(make):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row in range(batch.num_rows):
                        block, names, tokens, sizes, learn, *told = (c[row].as_py() for c in batch.columns)
                        yield from make(block, Block.read(names, tokens, sizes, learn), told)
                        release()

            return run

        def ask_grams(k: int):
            def ask(number: int, block: Block, told: list) -> Iterator[pa.RecordBatch]:
                own = block.grams(k)[-1]
                return asks(number, own.names, [own.counts.astype(np.uint32)], bits)

            return plain.mapInArrow(each_block(ask), "range int, block long, names binary, c0 binary")

        told_counts = [answer(ask_grams(k), [np.uint32], 1, _count, "n-grams") for k in range(1, order + 1)]
        totals = [totals_of(t, TOP + 3) for t in told_counts]
        single, cuts = Unigrams.of(totals[0]), [discounts(t[: TOP + 1]) for t in totals]
        told_contexts: list[DataFrame] = []

        def read(told: list, k: int) -> tuple[list[np.ndarray], np.ndarray, list[tuple]]:
            """Counts of the n-grams up to order ``k``, whether those of order ``k`` stand here, the contexts."""
            counts = [answers_of(t, "a0", np.uint64) for t in told[:k]]
            contexts = [(answers_of(t, "a0", np.float64), answers_of(t, "a1", np.float64)) for t in told[k:]]
            return [(c >> np.uint64(1)).astype(np.int64) for c in counts], (counts[-1] & np.uint64(1)).astype(bool), contexts

        def ask_contexts(k: int):
            def ask(number: int, block: Block, told: list) -> Iterator[pa.RecordBatch]:
                grams = block.grams(k)
                counts, stands, contexts = read(told, k)
                lower = log_chances(grams, counts, cuts, contexts, single)
                own, c = grams[-1].context[stands], counts[-1][stands]
                sums = [
                    np.bincount(own, values, len(grams[-1].contexts))
                    for values in (c, (1 - cuts[k - 1][np.minimum(c, TOP + 1)]) * c, 10 ** lower[grams[-1].lower[stands]])
                ]
                return asks(number, grams[-1].contexts, sums, bits)

            return each_block(ask)

        for k in range(2, order + 1):
            asked = with_answers(plain, *((t, ["a0"]) for t in told_counts[:k]), *((t, ["a0", "a1"]) for t in told_contexts))
            sums = "range int, block long, names binary, c0 binary, c1 binary, c2 binary"
            floor = single.unknown if k == 2 else 1e-12
            told_contexts.append(answer(asked.mapInArrow(ask_contexts(k), sums), [np.float64] * 3, 2, _weigh(floor), "contexts"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base_below = np.log10(single.tokens + single.types + 1)
            for batch in batches:
                for row in range(batch.num_rows):
                    ids = batch.column(5)[row].values
                    names, tokens, sizes, learn, *told = (batch.column(c)[row].as_py() for c in range(1, batch.num_columns) if c != 5)
                    block = Block.read(names, tokens, sizes, learn)
                    grams = block.grams(order)
                    counts, _, contexts = read(told, order)
                    value = log_chances(grams, counts, cuts, contexts, single)
                    first = np.cumsum(block.sizes) - block.sizes
                    base, word = np.log10(counts[0] + 1.0) - base_below, grams[0].which
                    found = [
                        block.sizes,
                        np.add.reduceat((counts[0] > 0).astype(np.int64)[word], first),
                        np.add.reduceat(base[word], first),
                        np.add.reduceat(value[grams[-1].which], first),
                    ]
                    constant = [np.full(len(first), n) for n in (single.tokens, single.types)]
                    yield pa.RecordBatch.from_arrays(
                        [ids, *map(pa.array, found[:2]), *map(pa.array, constant), *map(pa.array, found[2:])],
                        ["id", "n_tokens", "n_known", "train_tokens", "train_types", "base_score", "score"],
                    )
                    release()

        ready = with_answers(table.select(*plain.columns, "ids"), *((t, ["a0"]) for t in told_counts), *((t, ["a0", "a1"]) for t in told_contexts))
        scored = stage(ready.mapInArrow(run, f"id {kind}, {out}"), "scores", result=True)
    return scored.withColumnRenamed("id", id_col)
