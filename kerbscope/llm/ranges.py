"""Blocks of texts that ask ranges of hashes for totals.

A block sends each of its distinct names once, with its own numbers, to the range
of the name's hash; the range's task answers each block in the order it asked.  So a
name that occurs everywhere is one entry a block, and a task holds its own range
only.  Answers come back to each block, ranges in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.arrays import pack, pack_sorted, range_edges, release, unpack, unpack_sorted
from kerbscope.staging import stage


def asks(block: int, names: np.ndarray, columns: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    at = range_edges(names, bits)
    own = np.flatnonzero(np.diff(at))
    data = [[pack_sorted(names[at[p] : at[p + 1]]) for p in own]]
    data += [[pack(c[at[p] : at[p + 1]]) for p in own] for c in columns]
    labels = ["range", "block", "names", *(f"c{k}" for k in range(len(columns)))]
    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([block] * len(own), pa.int64()), *(pa.array(d, pa.binary()) for d in data)], labels)


def answer(asked: DataFrame, columns: list, answers: int, solve: Callable, label: str) -> DataFrame:
    """Written table of the answers to each (block, range), and of the ranges' totals (block -1).

    ``solve`` gets, for all n-grams of a range in order of their names, where each
    name begins, and the columns; it returns an array for each answer, one
    value per entry, and the totals.
    """

    def one(rows: list[tuple]) -> pa.RecordBatch:
        # What is no longer needed goes at once: these arrays are as long as the range.
        names = [unpack_sorted(r[2]) for r in rows]
        sizes = np.cumsum([0, *map(len, names)])
        whole = np.concatenate(names)
        del names
        order = np.argsort(whole, kind="stable")
        whole = whole[order]
        begins = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
        del whole
        found, totals = solve(begins, [np.concatenate([unpack(r[3 + k], kind) for r in rows])[order] for k, kind in enumerate(columns)])
        back = []
        for values in found:
            flat = np.empty_like(values)
            flat[order] = values
            back.append([pack(flat[a:b]) for a, b in zip(sizes[:-1], sizes[1:])])
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[1] for r in rows] + [-1], pa.int64()),
                pa.array([rows[0][0]] * (n + 1), pa.int32()),
                *(pa.array([*b, None], pa.binary()) for b in back),
                pa.array([None] * n + [[int(t) for t in totals]], pa.list_(pa.int64())),
            ],
            ["block", "range", *(f"a{k}" for k in range(answers)), "totals"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield one(held)
                    held = []
                    release()
                held.append(row)
        if held:
            yield one(held)
        del held
        release()

    schema = ", ".join(["block long, range int", *(f"a{k} binary" for k in range(answers)), "totals array<long>"])
    dealt = asked.repartition("range").sortWithinPartitions("range", "block")
    return stage(dealt.mapInArrow(run, schema), label)


def totals_of(answers: DataFrame, n: int) -> list[int]:
    row = answers.where("block = -1").agg(*[F.sum(F.col("totals")[k]).alias(f"t{k}") for k in range(n)]).first()
    return [int(row[k] or 0) for k in range(n)]


def with_answers(table: DataFrame, *answers: tuple[DataFrame, list[str]]) -> DataFrame:
    """Each block with its answers, ranges in order; a block's answers are as large as the block."""
    for k, (told, columns) in enumerate(answers):
        rows = told.where("block >= 0").groupBy("block")
        parts = F.array_sort(F.collect_list(F.struct("range", *columns)))
        table = table.join(rows.agg(parts.alias(f"told{k}")), "block")
    return table


def answers_of(parts: list[dict], column: str, kind) -> np.ndarray:
    return np.concatenate([unpack(p[column], kind) for p in parts])
