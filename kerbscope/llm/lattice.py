"""Near-duplicate vectors by lattice hashing.

Each table turns the unit vectors by random orthonormal projections into
``blocks`` points of eight dimensions and decodes each to the nearest point of
the E8 lattice; the lattice points together name a cell.  A vector is entered in
its own cell and in the ``probes - 1`` neighbouring cells that its decoding came
nearest to.  Vectors that share a cell which is the own cell of one of them are
candidates, and only pairs whose cosine reaches the threshold in double precision
are links.

Pairs are never written out.  A cell is worked on in pieces of at most
``2 * PIECE`` vectors (a larger cell as all pairs of its parts), a task counts
each vector's links there and joins what is linked.  A pair that also meets in
an earlier cell is left to that cell: the task works out the cells of the linked
vectors again and compares, so a link counts once.  Equal vectors are one
candidate that counts as many.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.arrays import mix
from kerbscope.llm.common import components
from kerbscope.llm.onebit import level, sound
from kerbscope.staging import scratch, stage

TABLES = 12
BLOCKS = 2
PROBES = 16
#: Size of the lattice in standard deviations of a projected coordinate of a random vector.
SCALE = 1.7
PIECE = 512
#: Pieces of a cell of up to so many vectors are looked through together.
SMALL = 48
#: Vectors whose cells a task keeps, 1.6 kB each.
KNOWN_VECTORS = 60_000


# ------------------------------------------------------------------ E8


def _nearest_d8(points: np.ndarray) -> np.ndarray:
    """Nearest points of D8: integers with an even sum."""
    near = np.rint(points)
    off = points - near
    worst = np.abs(off).argmax(1)
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    toward = np.where(off[odd, worst[odd]] >= 0, 1.0, -1.0)
    near[odd, worst[odd]] += toward
    return near


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """Nearest points of E8: of D8, or of D8 shifted by one half; ties go to D8."""
    plain = _nearest_d8(points)
    shifted = _nearest_d8(points - 0.5) + 0.5
    closer = ((points - shifted) ** 2).sum(1) < ((points - plain) ** 2).sum(1)
    return np.where(closer[:, None], shifted, plain)


@lru_cache(maxsize=1)
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, made from its definition."""
    found = []
    for i in range(8):
        for j in range(i):
            for a in (-1, 1):
                for b in (-1, 1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    found.append(v)
    signs = 1 - 2 * ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return np.vstack([np.array(found), signs[signs.prod(1) > 0] / 2])


@lru_cache(maxsize=8)
def _projections(dim: int, tables: int, blocks: int, seed: int = 11) -> np.ndarray:
    """For each table, ``8 * blocks`` rows; orthonormal as long as the dimension allows."""
    draw = np.random.default_rng((seed, dim))
    out = np.empty((tables, 8 * blocks, dim))
    for t in range(tables):
        rows = []
        while len(rows) < 8 * blocks:
            q, r = np.linalg.qr(draw.standard_normal((dim, dim)))
            rows.extend((q * np.sign(np.diag(r))).T)
        out[t] = np.array(rows[: 8 * blocks])
    return out


def _point_code(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit name of lattice points; a clash only adds candidates."""
    code = np.full(points.shape[0], salt, np.uint64)
    twice = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    for k in range(8):
        code = mix(code * np.uint64(31) + twice[:, k] + np.uint64(1))
    return code


def cells(unit: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """Names of the cells of unit vectors: vector x (table, probe), own cells first in each table.

    The probes beside the own cell change one block's lattice point to one of its
    neighbours, in order of the distance this adds.
    """
    n, dim = unit.shape
    around = shortest()
    unit_scale = scale / np.sqrt(dim)  # in standard deviations of a projected coordinate
    out = np.empty((n, tables, probes), np.uint64)
    for t, turn in enumerate(_projections(dim, tables, blocks)):
        points = (unit @ turn.T).reshape(n, blocks, 8) / unit_scale
        near, own, extra = np.empty_like(points), np.empty((n, blocks), np.uint64), []
        for b in range(blocks):
            near[:, b] = nearest_e8(points[:, b])
            own[:, b] = _point_code(near[:, b], 2 * b + 1)
            # Distance added by a neighbour v: |v|^2 - 2 <rest, v>, and |v|^2 = 2 for all.
            extra.append(2 - 2 * (points[:, b] - near[:, b]) @ around.T)
        out[:, t, 0] = _join(own, t)
        if probes > 1:
            added = np.concatenate(extra, axis=1)
            pick = np.argpartition(added, probes - 2, axis=1)[:, : probes - 1]
            pick = np.take_along_axis(pick, np.argsort(np.take_along_axis(added, pick, 1), axis=1, kind="stable"), 1)
            for p in range(probes - 1):
                block, v = pick[:, p] // 240, pick[:, p] % 240
                moved = own.copy()
                rows = np.arange(n)
                points_moved = near[rows, block] + around[v]
                for b in range(blocks):
                    at = block == b
                    moved[at, b] = _point_code(points_moved[at], 2 * b + 1)
                out[:, t, p + 1] = _join(moved, t)
    return out.reshape(n, tables * probes).astype(np.int64)


def _join(codes: np.ndarray, table: int) -> np.ndarray:
    joined = np.full(codes.shape[0], 1_000_003 * (table + 1), np.uint64)
    for b in range(codes.shape[1]):
        joined = mix(joined + codes[:, b])
    # The table's number leads, so that cells are in order of their tables.
    return (joined >> np.uint64(8)) | (np.uint64(table) << np.uint64(56))


# ------------------------------------------------------------------ one cell


class _Cells:
    """Cells of vectors by id, kept while a task works on cells that share vectors."""

    def __init__(self, shape: tuple):
        self.shape, self.known = shape, {}

    def of(self, ids: np.ndarray, unit: np.ndarray) -> np.ndarray:
        new = [i for i, node in enumerate(ids.tolist()) if node not in self.known]
        if len(self.known) + len(new) > KNOWN_VECTORS:
            self.known.clear()
            new = list(range(len(ids)))
        for k in range(0, len(new), 2048):
            part = new[k : k + 2048]
            self.known.update(zip(ids[part].tolist(), cells(unit[part], *self.shape)))
        return np.array([self.known[node] for node in ids.tolist()])


#: Below this share of linked pairs they are listed one by one.
SPARSE = 0.05


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` vectors the first one it is joined with by the links ``a``, ``b``."""
    root = np.arange(n)
    while True:
        new = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _left_to(cell: int, linked: np.ndarray, among: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (vector x home vector, which stands at ``among``) those that first meet in ``cell``.

    A pair meets where one holds the other's own cell; ``own`` has the cells by
    vector, table and probe.  Near copies meet in the first tables, so that few
    pairs are left to look through in the later ones.
    """
    last = (cell >> 56) + 1
    table = 0
    while table < last and np.count_nonzero(linked) > SPARSE * linked.size:
        held = own[:, table]
        cells_at_home, lives = np.unique(held[:, 0], return_inverse=True)
        at = np.searchsorted(cells_at_home, held)
        at[at == len(cells_at_home)] = 0
        row, probe = np.nonzero((cells_at_home[at] == held) & (held < cell))
        holds = np.zeros((len(own), len(cells_at_home)), bool)
        holds[row, at[row, probe]] = True
        linked &= ~holds[:, lives[among]]
        linked &= ~holds[among][:, lives].T
        table += 1
    a, b = np.nonzero(linked)
    b = among[b]
    for table in range(table, last):
        held = own[:, table]
        kept = np.empty(len(a), bool)
        for k in range(0, len(a), 50_000):
            x, y = held[a[k : k + 50_000]], held[b[k : k + 50_000]]
            kept[k : k + 50_000] = ~(((x == y[:, :1]) & (x < cell)).any(1) | ((y == x[:, :1]) & (y < cell)).any(1))
        a, b = a[kept], b[kept]
    return a, b


def work_cell(cell: int, part: np.ndarray, across: bool, home: np.ndarray, ids: np.ndarray, weight: np.ndarray, unit: np.ndarray, threshold: float, known: _Cells):
    """Links of one piece of a cell: ids, how many links each has that first meet here, and what it is joined with.

    A pair meets where it shares a cell that is the own cell of one of the two.
    ``across``: only pairs of different parts count.
    """
    homes = np.flatnonzero(home)
    linked = unit @ unit[homes].T >= threshold
    linked[homes, np.arange(len(homes))] = False
    if across:
        linked &= part[:, None] != part[None, homes]
    some = linked.any(1)
    some[homes] |= linked.any(0)
    if not some.any():
        return None
    some = np.flatnonzero(some)
    linked = linked[np.ix_(some, np.flatnonzero(np.isin(homes, some)))]
    own = known.of(ids[some], unit[some]).reshape(len(some), known.shape[0], known.shape[2])
    a, b = _left_to(cell, linked, np.flatnonzero(home[some]), own)
    if not len(a):
        return None
    n, weight, away = len(some), weight[some], ~home[some][a]
    # Two vectors at home are linked both ways, one that is not at home and one that is are so once.
    count = np.bincount(a, weight[b], n) + np.bincount(b[away], weight[a[away]], n)
    new = np.zeros(n, bool)
    new[a] = new[b] = True
    return ids[some][new], count[new].astype(np.int64), ids[some][_roots(n, a, b)][new]


def work_cells(rows: dict[str, np.ndarray], vectors: np.ndarray, threshold: float, known: _Cells) -> list[tuple]:
    """Whole pieces in order; pieces without a link are found for all small ones at once."""
    unit = vectors / np.sqrt((vectors**2).sum(1))[:, None]
    key = np.stack([rows[k] for k in ("cell", "low", "high")])
    edges = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, len(unit)]
    size, group = np.diff(edges), np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    open_groups = size > SMALL
    homes = np.flatnonzero(rows["home"] & ~open_groups[group])
    n = size[group[homes]]
    left = np.repeat(homes, n)
    right = np.repeat(edges[group[homes]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    for k in range(0, len(left), 100_000):
        a, b = left[k : k + 100_000], right[k : k + 100_000]
        close = (np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold - 1e-9) & (a != b)
        open_groups[group[a[close]]] = True
    # Their cells are worked out together: a call costs more than a vector.
    mine = np.flatnonzero(open_groups[group])
    _, once = np.unique(rows["node"][mine], return_index=True)
    for k in range(0, len(once), KNOWN_VECTORS // 2):
        part = mine[once[k : k + KNOWN_VECTORS // 2]]
        known.of(rows["node"][part], unit[part])
    out = []
    for g in np.flatnonzero(open_groups):
        own = slice(edges[g], edges[g + 1])
        made = work_cell(
            int(rows["cell"][own][0]), rows["part"][own], rows["low"][own][0] < rows["high"][own][0], rows["home"][own], rows["node"][own], rows["weight"][own], unit[own], threshold, known
        )
        if made:
            out.append(made)
    return out


# ------------------------------------------------------------------ the table


def near_duplicates(
    table: DataFrame,
    threshold: float = 0.9,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    probes: int = PROBES,
    scale: float = SCALE,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Rows ``id_col``, ``n_links`` long, ``component_id`` long, ``kept`` boolean: one per id.

    ``n_links`` counts the other ids whose cosine reaches ``threshold``;
    ``component_id`` is the smallest id reachable by links; ``kept`` says that this
    is the id itself.  Vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing, and vectors link only within one
    dimension.  Repeated rows of an id count once; if its vectors differ, one of
    them (by a hash) stands for the id.  Rows with a null id are one row that
    links with nothing and is not kept.
    Found pairs are exact; a pair at the very threshold is missed about once in 60
    with the values above, one of cosine 0.95 about never.
    """
    shape = (tables, blocks, probes, scale)
    wide = table.schema[vec_col].dataType.elementType.typeName() != "float"
    rows = table.select(table[id_col].cast("long").alias("id"), table[vec_col].alias("v"))
    content = F.struct(F.xxhash64("v", F.size("v")).alias("x"), F.xxhash64(F.size("v"), F.lit(5), "v").alias("y"))
    with scratch(table.sparkSession):
        named = stage(rows.groupBy("id").agg(F.min(content).alias("k")), "vectors", result=True)
        classes = stage(named.where("id is not null").groupBy("k").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight")), "classes")
        only = rows.withColumn("k", content).join(classes.select("k", F.col("node").alias("id"), "weight"), ["id", "k"])

        def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good, sizes, flat = sound(batch.column(1))
                start = np.cumsum(sizes) - sizes
                ids, weight = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
                for dim in np.unique(sizes[good]):
                    for own in np.array_split(good[sizes[good] == dim], 1 + len(good) // 1024):
                        if not len(own):
                            continue
                        vectors = level(flat[start[own][:, None] + np.arange(dim)])
                        found = cells(vectors / np.sqrt((vectors**2).sum(1))[:, None], *shape)
                        data = [v.tobytes() for v in (vectors if wide else vectors.astype(np.float32))]
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[own]), pa.array(weight[own]), pa.array(data, pa.binary()), lists], ["node", "weight", "vector", "cells"]
                        )

        once = only.select("id", F.col("v").cast("array<double>").alias("v"), "weight").dropDuplicates(["id"])
        entered = stage(once.mapInArrow(enter, "node long, weight long, vector binary, cells array<long>"), "entered")
        placed = entered.select("node", F.octet_length("vector").alias("size"), F.posexplode("cells").alias("at", "cell"))
        entries = placed.select("node", "size", "cell", (F.col("at") % probes == 0).alias("home"))
        shared = entries.groupBy("cell", "size").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("home")).where("n > 1 and home")
        # A large cell is dealt to parts, and each pair of parts is a piece of its own.
        parts = stage(shared.select("cell", "size", F.ceil(F.col("n") / PIECE).cast("int").alias("parts")), "cells")
        part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
        pieces = entries.join(parts, ["cell", "size"]).withColumn("part", part).select(
            "node", "cell", "size", "home", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
        )
        pieces = pieces.select("node", "cell", "size", "home", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
        carried = pieces.join(entered.select("node", "weight", "vector"), "node")
        key = ["cell", "low", "high"]
        keyed = carried.repartition(*key, "size").sortWithinPartitions("size", *key, "node")
        columns = [*key, "size", "home", "part", "node", "weight", "vector"]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = _Cells(shape)

            def results(rows: pa.Table) -> Iterator[pa.RecordBatch]:
                sizes = rows.column("size").to_numpy()
                for size in np.unique(sizes):
                    own = rows.filter(pa.array(sizes == size))
                    fields = {k: own.column(k).to_numpy(zero_copy_only=False) for k in columns[:-1]}
                    vectors = np.frombuffer(b"".join(own.column("vector").to_pylist()), np.float64 if wide else np.float32)
                    found = work_cells(fields, vectors.reshape(own.num_rows, -1).astype(np.float64), threshold, known)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)], ["node", "links", "root"])

            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows > 20_000:
                    whole = pa.Table.from_batches(held)
                    fields = np.stack([whole.column(k).to_numpy() for k in (*key, "size")])
                    change = np.flatnonzero((fields[:, 1:] != fields[:, :-1]).any(0))
                    last = int(change[-1]) + 1 if len(change) else 0
                    if last:
                        yield from results(whole.slice(0, last))
                    held = whole.slice(last).to_batches()
                    rows = whole.num_rows - last
            if held:
                yield from results(pa.Table.from_batches(held))

        keyed = keyed.select(*columns)
        links = stage(keyed.mapInArrow(work, "node long, links long, root long"), "links")
        reach = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
        count = links.groupBy("node").agg(F.sum("links").alias("links"))
        sound_nodes = entered.select("node", F.lit(1).alias("sound"))
        summed = (
            classes.join(sound_nodes, "node", "left")
            .join(count, "node", "left")
            .join(reach, "node", "left")
            .select("k", "node", "weight", "sound", "links", "component")
        )
        summed = stage(summed, "summary", result=True)
    linked = F.col("sound").isNotNull()
    component = F.when(linked, F.coalesce("component", "node")).otherwise(F.col("id"))
    return (
        named.join(summed, "k", "left")
        .select(
            F.col("id").alias(id_col),
            F.when(linked & F.col("id").isNotNull(), F.coalesce("links", F.lit(0)) + F.col("weight") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("id").isNotNull(), component).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )
