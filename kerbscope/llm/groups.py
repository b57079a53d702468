"""Near-duplicate texts by a token-group matrix.

Texts whose shingle sets have a Jaccard similarity of at least ``percent`` / 100
are linked; the result is exact.

1. Shingles (five words) are counted over all texts by ranges of their hash, after
   each block of texts has counted its own.  A shingle that one text alone holds
   cannot be shared, so a text goes on only if its repeated shingles could make up
   the similarity.
2. Equal sets are one class, of which one text goes on.  These are partitioned into groups of
   similar sets (equal least hash; a large group is dealt to parts), and each
   group stores the union of its sets: one row of the matrix.
3. A set of ``n`` shingles that links into a group shares at least
   ``percent`` / 100 of them with the union; among its rarest shingles, as many as
   may be missing and one more, at least one must be shared.  Groups that share
   such a shingle are candidates.
4. For a candidate the overlap of each set with the other group's union is
   counted, and only sets that reach the bound are compared member by member.
5. In a first round each group meets the least group of each such shingle; what is
   linked by then becomes one component.  In a second round those candidates meet
   that are not yet within one component altogether.  So the parts of a large
   group of near copies meet one of them, not each other.

Links become components; within a pair of groups only what joins its sets is
written, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.arrays import mix, pack, release, split_words, text_slices, unpack, word_numbers
from kerbscope.llm.common import components
from kerbscope.llm.ranges import answer, answers_of, asks, with_answers
from kerbscope.staging import scratch, stage

WIDTH = 5
PERCENT = 80
CHUNK_BYTES = 5_000_000
#: Shingles of a range, about; and sets of a group, about.
RANGE = 1_000_000
GROUP = 128


# ------------------------------------------------------------------ shingles


def word_values(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, most frequent first, the number of each word in turn, and words a text."""
    words, sizes = split_words(texts)
    number, names = word_numbers(words)
    rank = np.argsort(-np.bincount(number, minlength=len(names)), kind="stable")
    place = np.empty(len(rank), np.uint32)
    place[rank] = np.arange(len(rank), dtype=np.uint32)
    return names[rank], place[number], sizes


def shingles(names: np.ndarray, number: np.ndarray, sizes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, in order, and the texts they belong to.

    A text of fewer than ``width`` words is one shingle; one without words has none.
    """
    value = names[number] if len(number) else np.empty(0, np.uint64)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    begins = np.cumsum(sizes) - sizes
    # What is no longer needed goes at once: these arrays are as long as the block has words.
    codes, rows = [], []
    code = np.zeros(len(value), np.uint64)
    for size in range(1, width + 1):
        n = len(value) - size + 1
        if n <= 0:
            break
        code = code[:n] * np.uint64(31)
        code += value[size - 1 :]
        code = mix(code)
        at = np.flatnonzero(row[:n] == row[size - 1 :]) if size == width else begins[sizes == size]
        codes.append(mix(code[at] + np.uint64(size)))
        rows.append(row[at])
    if not codes:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    del value, row, code, at
    code, row = np.concatenate(codes), np.concatenate(rows)
    del codes, rows
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    del order
    # The sort is stable, so within a hash the texts are in order and repeats stand together.
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    return code[new], row[new]


def set_names(code: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each text's set and two independent names of it."""
    sizes = np.bincount(row, minlength=n)
    names = []
    for values in (code, mix(code + np.uint64(1))):
        name = np.zeros(n, np.uint64)
        for lane in range(4):  # sums of 16 bits are exact in a double
            part = np.bincount(row, (values >> np.uint64(16 * lane)) & np.uint64(0xFFFF), n)
            name = mix(name + part.astype(np.uint64))
        names.append(name.view(np.int64))
    return sizes, names[0], names[1]


@dataclass
class Block:
    """Texts by the numbers of their words, which are numbered within the block."""

    ids: pa.Array
    names: np.ndarray
    number: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def read(ids: pa.Array, names: bytes, number: bytes, sizes: bytes) -> Block:
        return Block(ids, unpack(names, np.uint64), unpack(number, np.uint32), unpack(sizes, np.int64))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shingles of the texts with an id, the texts, and where each shingle begins."""
        code, row = shingles(self.names, self.number, self.sizes, width)
        named = self.ids.is_valid().to_numpy(zero_copy_only=False)[row]
        code, row = code[named], row[named]
        return code, row, np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])


def text_blocks(texts: DataFrame, width: int) -> DataFrame:
    """Written table of blocks of texts, with the size of each text's set and two names of it."""

    def block(number_of: int, own: pa.RecordBatch) -> pa.RecordBatch:
        names, number, sizes = word_values(own.column(1))
        told = set_names(*shingles(names, number, sizes, width), len(own))
        data = [pack(names), pack(number), pack(sizes.astype(np.int64))]
        edges = pa.array([0, len(own)], pa.int32())
        lists = [pa.ListArray.from_arrays(edges, pa.concat_arrays([pa.array(x)] if isinstance(x, np.ndarray) else [x])) for x in (own.column(0), *told)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number_of], pa.int64()), lists[0], *(pa.array([x], pa.binary()) for x in data), *lists[1:]],
            ["block", "id", "names", "number", "sizes", "n", "x", "y"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch.column(1), CHUNK_BYTES):
                yield block(part << 32 | made, batch.slice(rows.start, rows.stop - rows.start))
                made += 1
                release()

    fields = "block long, id array<long>, names binary, number binary, sizes binary, n array<long>, x array<long>, y array<long>"
    return stage(texts.mapInArrow(run, fields), "texts")


def repeated_shingles(blocks: DataFrame, total: int, width: int, percent: int) -> DataFrame:
    """Rows ``id``, ``n``, ``shingles`` binary, ``least``: the shingles that occur in several texts, rarest first.

    Only texts whose repeated shingles could make up the similarity have a row.  A
    block asks for each of its distinct shingles once, with the number of its own
    texts that hold it; the range of the shingle's hash adds these up.  So a shingle
    that a third of all texts share is one entry for each block, and no list of the
    texts that hold a shingle is ever made.
    """
    bits = max(0, (total // RANGE).bit_length())
    columns = ["block", "id", "names", "number", "sizes"]

    def each_block(make):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids = batch.column(1)[i].values
                    number, names, tokens, sizes, *told = (batch.column(k)[i].as_py() for k in range(batch.num_columns) if k != 1)
                    yield from make(number, Block.read(ids, names, tokens, sizes), *told)
                    release()

        return run

    def ask(number: int, block: Block) -> Iterator[pa.RecordBatch]:
        code, _, begins = block.shingles(width)
        if len(code):
            yield from asks(number, code[begins], [np.diff(np.r_[begins, len(code)]).astype(np.uint32)], bits)

    def add(begins: np.ndarray, counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[int]]:
        size = np.diff(np.r_[begins, len(counts[0])])
        held = np.minimum(np.add.reduceat(counts[0].astype(np.int64), begins), 2**32 - 1)
        return [np.repeat(held, size).astype(np.uint32)], []

    def sets(number: int, block: Block, told: list[dict]) -> Iterator[pa.RecordBatch]:
        code, row, begins = block.shingles(width)
        held = np.repeat(answers_of(told, "a0", np.uint32), np.diff(np.r_[begins, len(code)]))
        n = np.bincount(row, minlength=len(block.sizes))
        code, row, held = code[held > 1], row[held > 1], held[held > 1]
        enough = percent * n <= 100 * np.bincount(row, minlength=len(n))
        kept = enough[row]
        code, row, held = code[kept], row[kept], held[kept]
        order = np.lexsort((code, held, row))
        code, row = code[order], row[order]
        edges = np.r_[0, np.flatnonzero(np.diff(row)) + 1, len(row)] if len(row) else np.array([0])
        ids = block.ids.to_numpy(zero_copy_only=False)
        for k in range(0, len(edges) - 1, 500):
            spans = list(zip(edges[k : k + 500], edges[k + 1 : k + 501]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(ids[row[a]]) for a, _ in spans], pa.int64()),
                    pa.array([int(n[row[a]]) for a, _ in spans], pa.int64()),
                    pa.array([code[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([int(mix(code[a:b]).min().view(np.int64)) for a, b in spans], pa.int64()),
                ],
                ["id", "n", "shingles", "least"],
            )

    plain = blocks.select(*columns)
    counted = answer(plain.mapInArrow(each_block(ask), "range int, block long, names binary, c0 binary"), [np.uint32], 1, add, "shingles")
    ready = with_answers(plain, (counted, ["a0"]))
    return ready.mapInArrow(each_block(sets), "id long, n long, shingles binary, least long")


# ------------------------------------------------------------------ groups


class Group:
    """Sets of a group: ids, sizes (with the shingles nobody else holds), shingles rarest first."""

    def __init__(self, members: list[dict]):
        self.ids = np.array([m["id"] for m in members], np.int64)
        self.n = np.array([m["n"] for m in members], np.int64)
        self.sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
        self.row = np.repeat(np.arange(len(members)), [len(s) for s in self.sets])
        self.every = np.concatenate(self.sets)
        self.union = np.unique(self.every)

    def rarest(self, percent: int) -> np.ndarray:
        """The shingles of which a linked set must share one, of any member."""
        need = -(-percent * self.n // 100)
        heads = [s[: max(0, len(s) - int(k) + 1)] for s, k in zip(self.sets, need)]
        return np.unique(np.concatenate(heads))

    def reaching(self, union: np.ndarray, percent: int) -> np.ndarray:
        """Members whose overlap with ``union`` allows a link."""
        at = np.searchsorted(union, self.every)
        at[at == len(union)] = 0
        overlap = np.bincount(self.row[union[at] == self.every], minlength=len(self.ids))
        return np.flatnonzero(100 * overlap >= percent * self.n)


def compare(a: Group, b: Group, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two groups (or within one): ids and the id that each is joined with."""
    own = a.reaching(b.union, percent)
    other = b.reaching(a.union, percent)
    if not len(own) or not len(other):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    shared = np.zeros((len(own), len(other)))
    columns = np.intersect1d(a.union, b.union, assume_unique=True)
    for k in range(0, len(columns), 4096):
        part = columns[k : k + 4096]
        sides = []
        for group, rows in ((a, own), (b, other)):
            held = np.zeros((len(group.ids), len(part)), np.float32)
            at = np.searchsorted(part, group.every)
            at[at == len(part)] = 0
            hit = part[at] == group.every
            held[group.row[hit], at[hit]] = 1
            sides.append(held[rows])
        shared += sides[0] @ sides[1].T
    linked = 100 * shared >= percent * (a.n[own][:, None] + b.n[other][None, :] - shared)
    linked &= a.ids[own][:, None] != b.ids[other][None, :]
    ids = np.concatenate([a.ids[own], b.ids[other]])
    root, m = np.arange(len(ids)), len(own)
    while True:
        new = root.copy()
        new[:m] = np.minimum(new[:m], np.where(linked, new[None, m:], len(ids)).min(1))
        new[m:] = np.minimum(new[m:], np.where(linked, new[:m, None], len(ids)).min(0))
        if (new == root).all():
            return ids, ids[root]
        root = new


def links_between(pairs: DataFrame, groups: DataFrame, percent: int, also: DataFrame | None = None) -> DataFrame:
    """Rows ``a``, ``b``: links between the groups of each pair, and within ``also`` (``members``, null ``others``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                members, others = (c[k].as_py() for c in batch.columns)
                a = Group(members)
                ids, roots = compare(a, Group(others) if others else a, percent)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(roots)], ["a", "b"])

    right = groups.select(F.col("group").alias("other"), F.col("members").alias("others"))
    opened = pairs.join(groups.select("group", "members"), "group").join(right, "other").select("members", "others")
    opened = opened if also is None else opened.unionByName(also)
    return opened.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    percent: int = PERCENT,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows ``id_col``, ``n_shingles`` long, ``component_id``: one for each row of ``docs``.

    ``component_id`` is the smallest id reachable by links, itself included.  Ids are
    whole numbers.  A null text counts as empty; empty sets link with nothing.  Rows
    with a null id link with nothing and have a null component.  Repeated rows are
    one text; if an id has texts with different sets, the least text stands for the
    id in all its rows.
    """
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    with scratch(docs.sparkSession):
        blocks = text_blocks(texts, width)
        sizes = stage(blocks.select(F.inline(F.arrays_zip("id", "n", "x", "y"))), "sizes", result=True)
        known = sizes.where("id is not null")
        several = stage(known.groupBy("id").agg(F.min(F.struct("n", "x", "y")).alias("a"), F.max(F.struct("n", "x", "y")).alias("b")).where("a <> b").select("id"), "several")
        if not several.isEmpty():
            plain = texts.join(several, "id", "left_anti")
            one = texts.join(several, "id").groupBy("id").agg(F.min("text").alias("text"))
            result = stage(near_duplicates(plain.unionByName(one), percent, width, "id", "text").where("id is not null").distinct(), "result", result=True)
            nameless = sizes.where("id is null").select("id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
            return known.select("id").join(result, "id").unionByName(nameless).withColumnRenamed("id", id_col)
        classes = stage(known.where("n > 0").groupBy("n", "x", "y").agg(F.min("id").alias("class")), "classes")
        total = sizes.agg(F.sum("n")).first()[0] or 0
        # One text of each class of equal sets goes on; rows that repeat an id are one.
        one = classes.select(F.col("class").alias("id"))
        sets = stage(repeated_shingles(blocks, total, width, percent).join(one, "id").dropDuplicates(["id"]), "sets")

        parts = stage(sets.groupBy("least").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts")), "parts")
        part = F.pmod(F.xxhash64("id"), F.col("parts"))
        dealt = sets.join(parts, "least").withColumn("group", F.xxhash64("least", part))
        groups = stage(dealt.groupBy("group").agg(F.collect_list(F.struct("id", "n", "shingles")).alias("members")), "groups")

        def matrix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    rare = Group(batch.column(1)[k].as_py()).rarest(percent)
                    yield pa.RecordBatch.from_arrays([pa.array(rare.view(np.int64)), pa.array([batch.column(0)[k].as_py()] * len(rare), pa.int64())], ["token", "group"])

        matrix = stage(groups.mapInArrow(matrix_rows, "token long, group long"), "matrix")

        within = groups.where(F.size("members") > 1).select("members", F.lit(None).cast(groups.schema["members"].dataType).alias("others"))
        # First each group meets the least group of each of its shingles.
        hubs = matrix.groupBy("token").agg(F.min("group").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("token", "hub")
        stars = stage(matrix.join(hubs, "token").where("group <> hub").select(F.col("hub").alias("group"), F.col("group").alias("other")).distinct(), "stars")
        links = stage(links_between(stars, groups, percent, within), "links")
        reach = components(links)
        # Groups whose sets are all of one component need not meet; of the others that share a shingle, all pairs do.
        inside = groups.select("group", F.explode("members.id").alias("node")).join(reach, "node", "left")
        part_of = F.coalesce("component", "node")
        whole = inside.groupBy("group").agg(F.min(part_of).alias("low"), F.max(part_of).alias("high"))
        kinds = whole.select("group", F.when(F.col("low") == F.col("high"), F.struct(F.lit(0).alias("mixed"), F.col("low").alias("name"))).otherwise(F.struct(F.lit(1).alias("mixed"), F.col("group").alias("name"))).alias("kind"))
        placed = matrix.join(stage(kinds, "kinds"), "group")
        open_tokens = placed.groupBy("token").agg(F.min("kind").alias("low"), F.max("kind").alias("high")).where("low <> high").select("token")
        placed = stage(placed.join(open_tokens, "token"), "placed")
        of_token = placed.select("token", "kind").distinct()
        meeting = of_token.join(of_token.withColumnRenamed("kind", "other_kind"), "token").where("kind < other_kind")
        sides = placed.select("token", F.col("kind").alias("other_kind"), F.col("group").alias("other"))
        apart = meeting.join(placed, ["token", "kind"]).join(sides, ["token", "other_kind"])
        apart = apart.select(F.least("group", "other").alias("group"), F.greatest("group", "other").alias("other")).distinct()
        later = stage(apart.join(stars, ["group", "other"], "left_anti"), "apart")
        more = stage(links_between(later, groups, percent), "more-links")
        if not more.isEmpty():
            reach = components(links.unionByName(more))
        named = classes.join(reach.select(F.col("node").alias("class"), "component"), "class", "left")
        named = stage(named.select("n", "x", "y", F.coalesce("component", "class").alias("component")), "named", result=True)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return sizes.join(named, ["n", "x", "y"], "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
