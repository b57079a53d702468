"""Scaling, ordering and the ranking metrics on small tables and against pandas."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbscope.operators import ordering
from kerbscope.operators.features import population_median
from kerbscope.operators.metrics import ranking_quality, with_actual
from kerbscope.operators.scaling import feature_minmax, minmax
from kerbscope.staging import run_folder, shared_folder, stage


def test_minmax_spread_null_constant_single(spark):
    df = stage(
        spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0), (3, None, 5.0)], "k int, x double, c double"),
        "t",
    )
    rows = minmax(df, {"sx": F.col("x"), "sc": F.col("c")}).orderBy("k").collect()
    assert [r.sx for r in rows] == [0.0, 100.0, None]
    assert [r.sc for r in rows] == [0.0, 0.0, 0.0]
    one = minmax(df.filter("k = 1"), {"sx": F.col("x")}, factor=1.0).collect()
    assert [r.sx for r in one] == [0.0]
    nothing = minmax(df.withColumn("x", F.lit(None).cast("double")), {"sx": F.col("x")}).collect()
    assert [r.sx for r in nothing] == [0.0, 0.0, 0.0]


def test_minmax_per_population(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 9.0)], "w string, x double")
    got = {(r.w, r.x): r.s for r in minmax(df, {"s": F.col("x")}, ["w"]).collect()}
    assert got == {("a", 1.0): 0.0, ("a", 3.0): 100.0, ("b", 9.0): 0.0}


def test_feature_scale_replaces_what_is_not_finite(spark):
    values = [2.0, None, float("nan"), float("inf"), float("-inf"), -2.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r.x for r in feature_minmax(df, ["x"]).orderBy("i").collect()]
    assert got == [100.0, 50.0, 50.0, 50.0, 50.0, 0.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows tie on one value, in one of three populations."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        hot = rng.random() < 0.66
        rows.append((i, "hot" if hot else rng.choice("ab"), 1.0 if hot else float(rng.randrange(40))))
    return stage(spark.createDataFrame(rows, "id int, w string, x double"), "skewed"), pd.DataFrame(
        rows, columns=["id", "w", "x"]
    )


def test_running_total_equals_a_count(spark, skewed):
    df, local = skewed
    expected = local.sort_values(["w", "x", "id"]).assign(t=lambda d: d.groupby("w").cumcount() + 1)
    order = [F.col("x"), F.col("id")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for blocks in ("1", "4", "63"):
            spark.conf.set("spark.sql.shuffle.partitions", blocks)
            got = ordering.running_total(df, F.lit(1), order, "t", ["w"]).toPandas()
            merged = got.merge(expected, on="id")
            assert len(got) == 3000 and (merged["t_x"] == merged["t_y"]).all()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ranking_has_no_single_task(skewed):
    df, _ = skewed
    ranked = ordering.running_total(df, F.lit(1), [F.col("x"), F.col("id")], "t", [])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    rows_in_one_task = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(rows_in_one_task) <= 1  # only the block totals, one row per block
    assert ranked.count() == 3000


def test_average_rank(skewed):
    df, local = skewed
    expected = local.assign(r=local.groupby("w")["x"].rank(method="average"))
    got = ordering.average_rank(df, "x", "r", ["w"]).toPandas()
    merged = got.merge(expected, on="id")
    assert len(got) == 3000 and (merged["r_x"] == merged["r_y"]).all()


def test_population_median(skewed):
    df, local = skewed
    got = population_median(df, "x", ("w",)).toPandas().set_index("w")["median_score"]
    assert got.to_dict() == local.groupby("w")["x"].median().to_dict()


def quality(spark, predicted, actual, ks=(2, 3)):
    """predicted, actual: (window, cell, score) lists."""
    windows = sorted({w for w, *_ in predicted})
    p = spark.createDataFrame(predicted, "window_id int, grid_id string, predicted double")
    a = spark.createDataFrame(actual, "window_id int, grid_id string, actual double")
    base = stage(with_actual(p, a, max(ks)), "base")
    groups = spark.createDataFrame([(w,) for w in windows], "window_id int")
    out = ranking_quality(base, a, groups, lambda df: df, ["window_id"], ks)
    return {r.window_id: r for r in out.collect()}


def test_perfect_disjoint_and_short_lists(spark):
    cells = [("a", 9.0), ("b", 5.0), ("c", 1.0)]
    predicted = [(1, c, s) for c, s in cells] + [(2, c, s) for c, s in cells] + [(3, "a", 1.0)]
    actual = [(1, c, s) for c, s in cells] + [(2, c.upper(), s) for c, s in cells] + [(3, "a", 0.0)]
    got = quality(spark, predicted, actual)
    assert (got[1].precision_at_2, got[1].ndcg_at_3, got[1].spearman_score_correlation) == (1.0, 1.0, 1.0)
    assert (got[2].precision_at_2, got[2].hit_count_at_3, got[2].ndcg_at_2) == (0.0, 0, 0.0)
    assert (got[2].common_hotspots, got[2].spearman_score_correlation) == (0, None)
    assert (got[3].precision_at_2, got[3].hit_count_at_2) == (0.5, 1)  # divided by k, one cell only
    assert got[3].ndcg_at_2 == 0.0  # ideal gain is zero


def test_ndcg_by_hand(spark):
    predicted = [(1, "a", 3.0), (1, "b", 2.0), (1, "c", 1.0)]
    actual = [(1, "b", 10.0), (1, "c", 4.0), (1, "z", 6.0)]
    got = quality(spark, predicted, actual)[1]
    gain = 10 / math.log2(3) + 4 / math.log2(4)
    ideal = 10 + 6 / math.log2(3) + 4 / math.log2(4)
    assert got.ndcg_at_3 == round(gain / ideal, 4)
    assert got.ndcg_at_2 == round((10 / math.log2(3)) / (10 + 6 / math.log2(3)), 4)


def test_spearman_ties_short_and_constant(spark):
    x = [1.0, 2.0, 2.0, 3.0, 7.0]
    y = [2.0, 1.0, 4.0, 4.0, 9.0]
    predicted = [(1, str(i), v) for i, v in enumerate(x)]
    actual = [(1, str(i), v) for i, v in enumerate(y)]
    predicted += [(2, "a", 1.0), (2, "b", 2.0)]
    actual += [(2, "a", 1.0), (2, "b", 2.0)]
    predicted += [(3, c, 5.0) for c in "abcd"]
    actual += [(3, c, float(i)) for i, c in enumerate("abcd")]
    got = quality(spark, predicted, actual)
    expected = pd.Series(x).rank().corr(pd.Series(y).rank())
    assert got[1].spearman_score_correlation == round(expected, 4)
    assert (got[2].common_hotspots, got[2].spearman_score_correlation) == (2, None)
    assert (got[3].common_hotspots, got[3].spearman_score_correlation) == (4, None)


def test_staging_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert run_folder(spark).startswith(named) and run_folder(spark).endswith(spark.sparkContext.applicationId)


def test_a_cluster_needs_a_named_folder():
    from types import SimpleNamespace

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", applicationId="app")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError):
        shared_folder(session)
