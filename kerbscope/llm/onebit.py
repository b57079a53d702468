"""Nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to unit length and turned by a random rotation; the signs of
its coordinates are its code, one bit each.  With ``s`` the unit vector of those
signs and ``f`` its inner product with the turned vector (kept beside the
code), the inner product with a query ``q`` is estimated by ``<s, q> / f``, and the
error is at most ``width * sqrt((1 - f*f) / f / f / (dim - 1))`` but for chance:
``width`` counts standard deviations.  ``<s, q>`` comes from the packed bits alone: a
turned query is rounded to ``PLANES`` bits a coordinate, whose bit planes are
matched with the code by counting common bits; what the rounding may change is
added to the bound.

Every row is indexed; the index is made of blocks of rows.  Queries come in blocks
too, and both are dealt to a grid in which each pair of blocks meets once.  A first
pass over the grid reranks the few best estimates of each block, so that every
query knows ``k`` cosines; the least of them is its floor.  A second pass reranks, in
double precision on the original vectors, every code whose bound reaches the
floor; all others cannot be among the ``k`` nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.staging import scratch, stage

WIDTH = 3.0
PLANES = 6
BLOCK = 4096
QUERY_BLOCK = 128
#: Blocks of the index and of queries in a cell of the grid, once there are enough of them.
CELL = 16
QUERY_CELL = 64
#: Parts that a small index is dealt to.
PARTS = 48

_BLOCK = "dim int, ids binary, vectors binary, codes binary, factors binary, floors binary"


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """Random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def sound(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, lengths and flat values of the vectors that are not null, empty, zero or not finite."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    flat = values.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    fine = np.zeros(len(sizes), bool)
    fine[row[flat != 0]] = True
    fine[row[~np.isfinite(flat)]] = False
    return np.flatnonzero(fine), sizes, flat


def level(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, so that the largest component is near 1: their squares stay in range.

    The scaling is exact, hence cosines are those of the original vectors.
    """
    _, exponent = np.frexp(np.abs(vectors).max(1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors**2).sum(1))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of unit vectors packed into 64-bit words, and correction factors."""
    turned = unit @ turn.T
    dim = unit.shape[1]
    bits = np.zeros((len(unit), -(-dim // 64) * 64), bool)
    bits[:, :dim] = turned > 0
    return np.packbits(bits, axis=1, bitorder="little").view("<u8"), np.abs(turned).sum(1) / np.sqrt(dim)


def planes(turned: np.ndarray, many: int = PLANES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes (query x plane x word), lowest value, step, and the most that rounding changes a signed sum."""
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / (2**many - 1), 1e-30)
    whole = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint64)
    off = np.abs(low[:, None] + step[:, None] * whole - turned).sum(1)
    dim = turned.shape[1]
    bits = np.zeros((len(turned), many, -(-dim // 64) * 64), bool)
    bits[:, :, :dim] = (whole[:, None, :] >> np.arange(many, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8"), low, step, off


def estimates(codes: np.ndarray, factors: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries (rows) and codes (columns), and what rounding may change them by."""
    dim = turned.shape[1]
    plane, low, step, off = planes(turned)
    total = np.zeros((len(turned), len(codes)), np.int32)
    for j in range(plane.shape[1]):
        for w in range(codes.shape[1]):
            total += np.bitwise_count(plane[:, j, w, None] & codes[None, :, w]).astype(np.int32) << j
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    signed = 2 * (low[:, None] * ones + step[:, None] * total) - turned.sum(1)[:, None]
    scale = np.sqrt(dim) * factors
    return signed / scale, off[:, None] / scale


def blocks(table: DataFrame, size: int, id_col: str, vec_col: str, floor_col: str | None = None) -> DataFrame:
    """Blocks of at most ``size`` vectors of one dimension: ids, vectors, codes, correction factors, floors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, flat = sound(batch.column(1))
            first = np.cumsum(sizes) - sizes
            ids, floors = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for dim in np.unique(sizes[rows]):
                own = rows[sizes[rows] == dim]
                for k in range(0, len(own), size):
                    part = own[k : k + size]
                    vectors = level(flat[first[part][:, None] + np.arange(dim)])
                    codes, factors = encode(vectors / lengths(vectors)[:, None], rotation(int(dim)))
                    data = [ids[part].astype(np.int64), vectors, codes, factors, floors[part].astype(np.float64)]
                    yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in data)], [f.split()[0] for f in _BLOCK.split(", ")])

    floor = table[floor_col] if floor_col else F.lit(-2.0)
    known = table.select(table[id_col].cast("long").alias("id"), table[vec_col].cast("array<double>").alias("v"), floor.cast("double").alias("floor"))
    return known.where("id is not null and v is not null").mapInArrow(run, _BLOCK)


def best_of(ids, vectors, codes, factors, query_ids, queries, floors, k: int, width: float, first: bool):
    """For each query its ``k`` best rows of the block among those reranked: query ids, row ids, cosines; and how many were reranked.

    In the ``first`` pass the best estimates are reranked, then all whose bound reaches the floor.
    """
    norms, query_norms = lengths(vectors), lengths(queries)
    turned = (queries / query_norms[:, None]) @ rotation(vectors.shape[1]).T
    guess, rounding = estimates(codes, factors, turned)
    if first:
        many = min(k + 1, len(ids))
        chosen = np.zeros(guess.shape, bool)
        np.put_along_axis(chosen, np.argpartition(-guess, many - 1, axis=1)[:, :many], True, axis=1)
    else:
        error = width * np.sqrt(np.maximum(0, 1 - factors**2) / max(1, vectors.shape[1] - 1)) / factors
        chosen = guess + rounding + error >= floors[:, None] - 1e-9
    out = []
    for q in np.flatnonzero(chosen.any(1)):
        rows = np.flatnonzero(chosen[q])
        rows = rows[ids[rows] != query_ids[q]]
        score = vectors[rows] @ queries[q] / (norms[rows] * query_norms[q])
        order = np.lexsort((ids[rows], -score))
        found = ids[rows][order]
        _, once = np.unique(found, return_index=True)  # a repeated id counts once
        order = order[np.sort(once)][:k]
        out.append((np.full(len(order), query_ids[q]), ids[rows][order], score[order]))
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return tuple(np.concatenate(c) for c in zip(none, *out)), int(chosen.sum())


def _numbers(many: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))


def search(
    table: DataFrame,
    queries: Column,
    k: int = 5,
    width: float = WIDTH,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Rows ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest by cosine.

    ``queries`` says which rows of ``table`` are queries; all other ids are
    candidates.  Equal scores go by the smaller id.  Vectors that are null, empty,
    zero or hold a null or non-finite component take no part, nor do rows without
    an id; only vectors of one dimension are compared.  A repeated id counts once,
    by its best score.  No queries or no candidates: no rows.
    """
    spark = table.sparkSession
    with scratch(spark):
        asked = table.where(queries).select(table[id_col].cast("long").alias("id"), table[vec_col].alias("v"))
        index = stage(blocks(table, BLOCK, id_col, vec_col), "index")
        many = index.count()
        parts = max(-(-many // CELL), min(many, PARTS), 1)
        rows = index.select("*", F.pmod(F.xxhash64("ids"), F.lit(parts).cast("long")).alias("part"))

        def grid(own: DataFrame, floor_col: str | None, first: bool) -> DataFrame:
            """For each query and row of its best ones in each block, the score."""
            cut = stage(blocks(own, QUERY_BLOCK, "id", "v", floor_col), "queries")
            spread = max(1, -(-cut.count() // QUERY_CELL))
            column = F.pmod(F.xxhash64("ids"), F.lit(spread).cast("long"))
            left = rows.drop("floors").withColumn("cell", F.explode(_numbers(spread)))
            right = cut.select(
                "dim", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"), "floors", column.alias("cell"), F.explode(_numbers(parts)).alias("part")
            )
            met = left.join(right, ["dim", "part", "cell"])
            names = ["dim", "ids", "vectors", "codes", "factors", "query_ids", "queries", "floors"]

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row in range(batch.num_rows):
                        dim, *data = (c[row].as_py() for c in batch.columns)
                        kinds = (np.int64, np.float64, "<u8", np.float64, np.int64, np.float64, np.float64)
                        shapes = (-1, (-1, dim), (-1, -(-dim // 64)), -1, -1, (-1, dim), -1)
                        values = (np.frombuffer(d, kind).reshape(shape) for d, kind, shape in zip(data, kinds, shapes))
                        found, _ = best_of(*values, k, width, first)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

            found = met.select(*names).mapInArrow(run, "query_id long, vec_id long, score double")
            return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

        def ranked(found: DataFrame) -> DataFrame:
            """The best k of each id's best scores; Spark keeps k rows a query and task before it shuffles."""
            order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

        nearest = stage(ranked(grid(asked, None, True)), "first-pass")
        known = nearest.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        again = asked.join(known, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
        best = grid(again, "floor", False).unionByName(nearest.drop("rank"))
        once = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        result = stage(ranked(once), "nearest", result=True)
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
