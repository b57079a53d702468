"""Registered queries leave nothing in the shared folder once their handle is closed."""

from pathlib import Path

import pytest

import corpus_pipeline
from kerbscope.llm import queries
from kerbscope.staging import run_folder, scratch

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [*queries.queries(), "pipeline"])
def test_nothing_is_left(spark, tmp_path, name):
    folder = Path(run_folder(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    query = corpus_pipeline.run if name == "pipeline" else queries.queries()[name]
    with scratch(spark):
        query(spark, SMALL).write.parquet(f"{tmp_path}/result")
    assert not folder.exists() or set(folder.iterdir()) <= before
    assert spark.read.parquet(f"{tmp_path}/result").count() > 0
