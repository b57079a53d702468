"""Who deletes staged tables, and when."""

from pathlib import Path

import pytest

from checks.queries import all_queries
from kerbscope.staging import discard, run_folder, scratch, stage

SMALL = "/root/testdata/sf0.001"


class New:
    """What is in the application's folder since now."""

    def __init__(self, spark):
        self.folder = Path(run_folder(spark))
        self.before = set(self._paths())

    def _paths(self):
        return list(self.folder.iterdir()) if self.folder.exists() else []

    def names(self):
        return sorted(p.name.split("-")[0] for p in self._paths() if p not in self.before)


@pytest.fixture
def folder(spark):
    return New(spark)


def left(folder):
    return folder.names()


def test_a_scratch_deletes_its_own_tables_but_not_results(spark, folder):
    free = stage(spark.range(3), "free")
    with scratch(spark):
        with scratch(spark):
            first = stage(spark.range(5), "first")
            kept = stage(first.selectExpr("id + 1 as id"), "kept", result=True)
            assert left(folder) == ["first", "free", "kept"]
        assert left(folder) == ["free", "kept"] and kept.count() == 5
        top = stage(kept, "top", result=True)
    assert left(folder) == ["free", "top"] and top.count() == 5
    discard(top)
    discard(free)
    discard(spark.range(2))
    assert left(folder) == []


def test_a_failure_deletes_too(spark, folder):
    with pytest.raises(ZeroDivisionError):
        with scratch(spark):
            stage(spark.range(3), "gone")
            assert left(folder) == ["gone"]
            raise ZeroDivisionError
    assert left(folder) == []
    stage(spark.range(1), "after")
    assert left(folder) == ["after"]


@pytest.mark.parametrize("name", ["hotspot_ranked", "final_ranking", "csv_rejects", "vehicles_approx"])
def test_nothing_is_left_of_a_query_once_its_result_is_written(spark, folder, tmp_path, name):
    with scratch(spark):
        all_queries()[name](spark, SMALL).write.parquet(f"{tmp_path}/result")
        assert left(folder)
    # CSV and event tables that a query writes for itself are its input, not staged tables.
    assert set(left(folder)) <= {"damaged", "events"}
    assert spark.read.parquet(f"{tmp_path}/result").count() > 0
