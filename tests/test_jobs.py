import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from kerbscope import jobs
from kerbscope.sources.event_mapping import read_event_violations
from kerbscope.sources.tables import write_csv


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    source = f"{root}/violations.csv"
    write_csv(read_event_violations(spark, "/root/testdata/sf0.001"), source)
    out = f"{root}/out"
    jobs.run_hotspots(spark, source, out)
    jobs.run_hotspots(spark, source, out)  # a second run replaces the tables
    jobs.run_views(spark, out, f"{out}/before")
    jobs.run_evaluation(spark, source, out)
    jobs.run_model(spark, source, out)
    jobs.run_views(spark, out, out)
    return out


def record(path):
    lines = [x for f in sorted(Path(path).glob("part-*")) for x in f.read_text().splitlines()]
    return [json.loads(x) for x in lines]


def test_run_summary(written):
    (summary,) = record(f"{written}/run_summary")
    assert summary["input_rows"] == 1000
    assert summary["parking_rows_used"] == 615
    assert summary["hotspots"] == 21
    assert summary["top_hotspot"]["priority_rank"] == 1
    assert len(summary["outputs"]) == 5


def test_csv_tables_have_headers_and_quoted_ids(written):
    text = next(Path(f"{written}/enforcement_shift_plan").glob("part-*.csv")).read_text()
    assert text.startswith("priority_rank,grid_id,latitude,longitude,police_station,")
    assert '"12.' in text
    search = next(Path(f"{written}/model_weight_search_top30").glob("part-*.csv")).read_text()
    assert search.splitlines()[0] == (
        "history,last_month,trend,station,peak_junction,objective,precision_at_50,ndcg_at_50,spearman"
    )
    assert len(search.splitlines()) == 13


def test_summaries(written):
    (plain,) = record(f"{written}/prediction_quality_summary")
    assert plain["backtest_windows"] == 5
    assert [m["test_month"] for m in plain["metrics_by_month"]] == sorted(
        m["test_month"] for m in plain["metrics_by_month"]
    )
    assert set(plain["interpretation"]) == {"precision_at_k", "ndcg_at_k", "spearman_score_correlation"}
    (blend,) = record(f"{written}/hybrid_model_summary")
    assert sum(blend["best_weights"].values()) == pytest.approx(1.0)
    assert set(blend["metrics_mean"]) >= {"precision_at_20", "ndcg_at_100", "spearman_score_correlation"}


def test_views_without_and_with_model(written):
    (before,) = record(f"{written}/before/views/kpi")
    (after,) = record(f"{written}/views/kpi")
    assert before["model_precision_at_50"] == 0 and before["blend_history"] == 0
    assert after["model_precision_at_50"] > 0
    assert record(f"{written}/before/views/model") == []
    assert len(record(f"{written}/views/model")) == 20
    assert [r["hour"] for r in record(f"{written}/views/hours")] == list(range(24))


def test_clean_job_writes_months(spark, tmp_path):
    source, out = f"{tmp_path}/v.parquet", f"{tmp_path}/out"
    read_event_violations(spark, "/root/testdata/sf0.001").write.parquet(source)
    jobs.run_clean(spark, source, out)
    again = spark.read.parquet(f"{out}/cleaned_events")
    assert again.count() == 615
    assert len(list(Path(f"{out}/cleaned_events").glob("month=*"))) == 6


def tables(out):
    return {
        p.name: sorted(line for f in p.glob("part-*") for line in f.read_text().splitlines())
        for p in Path(out).iterdir()
        if p.is_dir() and p.name not in ("cleaned_events", "clean_summary", "views", "before", "rejected_records", "rejected_causes")
    }


def test_jobs_take_the_cleaned_table(spark, written, tmp_path):
    source, out = f"{tmp_path}/v.parquet", f"{tmp_path}/out"
    read_event_violations(spark, "/root/testdata/sf0.001").write.parquet(source)
    jobs.run_clean(spark, source, out)
    for job in (jobs.run_hotspots, jobs.run_evaluation, jobs.run_model):
        job(spark, f"{out}/cleaned_events", out)
    first, second = tables(written), tables(out)
    assert set(first) == set(second)
    for name in set(first) - {"cleaned_sample_records"}:
        assert first[name] == second[name], name
    assert len(first["cleaned_sample_records"]) == len(second["cleaned_sample_records"])


def test_views_need_their_tables(spark, tmp_path):
    with pytest.raises(AnalysisException) as error:
        jobs.run_views(spark, f"{tmp_path}/nowhere", f"{tmp_path}/out")
    assert error.value.getCondition() == "PATH_NOT_FOUND"


def test_input_resolution(monkeypatch):
    monkeypatch.setenv("KERBSCOPE_INPUT", "from-setting")
    assert jobs.resolve_input("given") == "given"
    assert jobs.resolve_input(None) == "from-setting"
    monkeypatch.delenv("KERBSCOPE_INPUT")
    assert jobs.resolve_input(None) == jobs.DEFAULT_INPUT
    assert jobs.resolve_input(None, jobs.DEFAULT_TABLES) == jobs.DEFAULT_TABLES
