"""Lattice near duplicates and one-bit search, against every pair."""

import numpy as np
import pytest

from kerbscope.llm import lattice, onebit, queries
from kerbscope.llm.common import components

from pyspark.sql import functions as F

DIM = 24


def near(rng, base, cosine):
    base = base / np.linalg.norm(base)
    other = rng.standard_normal(len(base))
    other -= other @ base * base
    return cosine * base + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


@pytest.fixture(scope="module")
def vectors():
    """A large group of near copies, small ones, equal vectors and vectors of no use."""
    rng = np.random.default_rng(4)
    rows = []
    for size, cosine in ((700, 0.99), (40, 0.96), (3, 0.94), (2, 0.93)):
        centre = rng.standard_normal(DIM)
        rows += [near(rng, centre, cosine) for _ in range(size)]
    rows += [rng.standard_normal(DIM) for _ in range(150)]
    rows += [rows[800] * 3.0, rows[800], rows[0]]
    vectors = [list(map(float, v)) for v in rows]
    bad = [None, [], [0.0] * DIM, [float("nan")] + [1.0] * (DIM - 1), [1.0] * (DIM - 1) + [None], [float("inf")] * DIM, [1.0, 2.0], [1.0, 2.0]]
    order = rng.permutation(len(vectors) + len(bad))
    both = vectors + bad
    return [(int(n), both[i]) for n, i in enumerate(order)]


def exact(rows):
    good = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    cos = np.full((len(good), len(good)), -2.0)
    for a, (_, x) in enumerate(good):
        for b, (_, y) in enumerate(good):
            if len(x) == len(y):
                cos[a, b] = x @ y / np.linalg.norm(x) / np.linalg.norm(y)
    np.fill_diagonal(cos, -2)
    return [i for i, _ in good], cos


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, weight int, cell string").repartition(5)


def flood(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(linked)):
        x, y = find(ids[a]), find(ids[b])
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_e8_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    points = rng.standard_normal((500, 8)) * 3
    near_points = lattice.nearest_e8(points)
    around = lattice.shortest()
    assert len(np.unique(around, axis=0)) == 240 and set((around**2).sum(1)) == {2.0}
    best = ((points - near_points) ** 2).sum(1)
    assert all((((points - near_points - v) ** 2).sum(1) >= best - 1e-9).all() for v in around)
    twice = np.rint(near_points * 2).astype(int)
    assert ((twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)).all() and (near_points.sum(1) % 2 == 0).all()


def test_cells_do_not_depend_on_the_company():
    rng = np.random.default_rng(1)
    unit = rng.standard_normal((300, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    assert (lattice.cells(unit) == np.vstack([lattice.cells(unit[:7]), lattice.cells(unit[7:])])).all()


def test_pairs_share_a_cell_that_is_the_own_cell_of_one():
    rng = np.random.default_rng(2)
    first = rng.standard_normal((600, 64))
    first /= np.linalg.norm(first, axis=1)[:, None]
    for cosine, least in ((0.9, 0.95), (0.95, 0.995)):
        second = np.array([near(rng, v, cosine) for v in first])
        a, b = lattice.cells(first), lattice.cells(second)
        met = [bool(np.isin(x[:: lattice.PROBES], y).any() or np.isin(y[:: lattice.PROBES], x).any()) for x, y in zip(a, b)]
        assert np.mean(met) >= least


@pytest.mark.parametrize("piece", [lattice.PIECE, 60])
def test_links_like_every_pair(spark, vectors, monkeypatch, piece):
    monkeypatch.setattr(lattice, "PIECE", piece)
    ids, cos = exact(vectors)
    linked = cos >= 0.9
    assert not ((cos > 0.9 - 1e-9) & (cos < 0.9 + 1e-9)).any()
    degree, root = dict(zip(ids, linked.sum(1))), flood(ids, linked)
    out = {r.vec_id: r for r in lattice.near_duplicates(table(spark, vectors + vectors[:5])).collect()}
    assert sorted(out) == [i for i, _ in vectors]
    assert {i: r.n_links for i, r in out.items()} == {i: degree.get(i, 0) for i in out}
    assert {i: r.component_id for i, r in out.items()} == {i: root.get(i, i) for i in out}
    assert all(r.kept == (r.component_id == i) for i, r in out.items())


def test_floats_null_ids_and_an_empty_table(spark, vectors):
    few = vectors[:40] + [(None, vectors[0][1])]
    rows = lattice.near_duplicates(table(spark, few, "float")).collect()
    nameless = [r for r in rows if r.vec_id is None]
    assert len(rows) == 41 and [(r.n_links, r.component_id, r.kept) for r in nameless] == [(0, None, False)]
    assert lattice.near_duplicates(table(spark, [])).collect() == []


def test_one_bit_bound_holds():
    rng = np.random.default_rng(3)
    unit = rng.standard_normal((400, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    codes, factors = onebit.encode(unit, onebit.rotation(64))
    assert codes.shape == (400, 1)
    signs = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little") * 2.0 - 1
    exact_guess = (unit @ onebit.rotation(64).T) @ signs.T / (8 * factors)
    guess, rounding = onebit.estimates(codes, factors, unit @ onebit.rotation(64).T)
    assert (np.abs(guess - exact_guess) <= rounding + 1e-9).all() and rounding.max() < 0.2
    error = onebit.WIDTH * np.sqrt((1 - factors**2) / 63) / factors
    assert (np.abs(guess - unit @ unit.T) <= error + rounding + 1e-9).mean() > 0.99


def test_estimates_of_odd_dimensions():
    rng = np.random.default_rng(6)
    for dim in (1, 2, 63, 65, 200):
        unit = rng.standard_normal((50, dim))
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        turn = onebit.rotation(dim)
        codes, factors = onebit.encode(unit, turn)
        guess, rounding = onebit.estimates(codes, factors, unit @ turn.T)
        signs = np.where(unit @ turn.T > 0, 1.0, -1.0)
        assert (np.abs(guess - (unit @ turn.T) @ signs.T / (np.sqrt(dim) * factors)) <= rounding + 1e-9).all()


def test_few_rows_are_reranked_once_the_floor_is_known():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((200, 64))
    rows = np.concatenate([[near(rng, c, 0.95) for _ in range(10)] for c in centres])
    codes, factors = onebit.encode(rows / onebit.lengths(rows)[:, None], onebit.rotation(64))
    asked, ids = rows[::50], np.arange(len(rows))
    cos = (rows @ asked.T / onebit.lengths(rows)[:, None] / onebit.lengths(asked)).T
    floors = np.sort(cos, axis=1)[:, -6]
    found, reranked = onebit.best_of(ids, rows, codes, factors, ids[::50], asked, floors, 5, onebit.WIDTH, False)
    assert reranked < 0.1 * cos.size
    want = {(50 * q, j) for q in range(len(asked)) for j in [b for b in np.argsort(-cos[q]) if b != 50 * q][:5]}
    assert len(want & set(zip(found[0].tolist(), found[1].tolist()))) >= 0.99 * len(want)


def test_very_large_and_very_small_vectors_take_part(spark):
    rng = np.random.default_rng(10)
    base = rng.standard_normal(DIM)
    rows = [(i, [float(x) * scale for x in near(rng, base, 0.97)]) for i, scale in enumerate([1.0, 1e200, 1e-200, 1e300, 5e-300, 1e-30])]
    links = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_duplicates(table(spark, rows)).collect()}
    assert links == dict.fromkeys(range(6), (5, 0))
    found = onebit.search(table(spark, rows), F.col("vec_id") == 0).collect()
    plain = [np.array(v) / np.abs(v).max() for _, v in rows]
    cos = {i: v @ plain[0] / np.linalg.norm(v) / np.linalg.norm(plain[0]) for i, v in enumerate(plain) if i}
    assert [r.vec_id for r in found] == sorted(cos, key=lambda i: -cos[i]) and all(abs(r.score - cos[r.vec_id]) < 1e-12 for r in found)


def test_search_like_every_pair(spark, vectors):
    ids, cos = exact(vectors)
    out = onebit.search(table(spark, vectors + vectors[:30]), F.col("vec_id") % 5 == 0).collect()
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for a, query in enumerate(ids):
        if query % 5:
            assert query not in found
            continue
        order = sorted((-cos[a, b], ids[b]) for b in range(len(ids)) if cos[a, b] > -2)[:5]
        rows = sorted(found.get(query, []))
        assert [r for r, _, _ in rows] == list(range(1, len(order) + 1))
        for _, other, score in rows:
            assert score == pytest.approx(cos[a, ids.index(other)], abs=1e-12)
        assert [(-round(s, 12), v) for _, v, s in rows] == sorted((-round(s, 12), v) for _, v, s in rows)
        hit += len({v for _, v, _ in rows} & {v for _, v in order})
        total += len(order)
    assert hit >= 0.99 * total


def test_search_of_nothing(spark, vectors):
    assert onebit.search(table(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert onebit.search(table(spark, vectors[:3]), F.lit(False)).collect() == []
    assert onebit.search(table(spark, [(0, [1.0, 0.0]), (None, [1.0, 0.0])]), F.col("vec_id") == 0).collect() == []


def test_registered_queries_on_the_given_vectors(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, cos = exact(rows)
    links = {r.vec_id: r.n_links for r in queries.op1_lattice_near_duplicates(spark, folder).collect()}
    assert links == dict(zip(ids, (cos >= 0.9).sum(1)))
    found = {(r.query_id, r.vec_id) for r in queries.op5_onebit_neighbours(spark, folder).collect()}
    want = {(q, ids[b]) for a, q in enumerate(ids) if q % 50 == 0 for b in np.lexsort((ids, -cos[a]))[:5]}
    assert len(found) == len(want) and len(found & want) >= 0.95 * len(want)


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1400)]
    odd = [(2000, 2000), (None, 5), (2001, 2002), (2002, 2001)]
    edges = spark.createDataFrame(path + star + odd, "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == dict.fromkeys(range(301), 0) | dict.fromkeys(range(1000, 1400), 1000) | {2001: 2001, 2002: 2001}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
