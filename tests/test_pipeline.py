"""End-to-end pipeline on vacancy rows rendered from the small test tables."""

import os

from jobtide.config import ForecastConfig
from jobtide.plans import queries as Q
from jobtide.plans.models import TreeParams
from jobtide.plans.pipeline import PipelineConfig, analyze_results, run_pipeline
from jobtide.plans.prepare import prepare
from jobtide.sources import proxy
from jobtide.sources.vacancies import read_results

SF = "/root/testdata/sf0.001"


def test_run_pipeline_end_to_end(spark, tmpdir_path):
    raw_path = os.path.join(tmpdir_path, "raw")
    proxy.raw_vacancies(spark, SF).repartition(2).write.options(
        sep=";", header="true", quote='"', escape='"').csv(raw_path)
    out = os.path.join(tmpdir_path, "out")
    cfg = PipelineConfig(
        input_path=raw_path, output_dir=out, prep=Q.proxy_prep_config(),
        forecast=ForecastConfig(grid=[{"freq": "M", "outlier_removal": False},
                                      {"freq": "W", "outlier_removal": True}], top_k=2),
        tree_params=TreeParams(rf_trees=5, gbt_rounds=3))
    res = run_pipeline(spark, cfg)
    fc = res.forecasts.collect()
    assert fc and all(r["forecast"] >= 0 and r["forecast"] == int(r["forecast"]) for r in fc)
    assert {r["step"] for r in fc} == set(range(1, 7))
    summary = res.summary.first()
    assert summary["horizon"] == 6 and summary["rf_wins"] + summary["gbt_wins"] >= 1
    back = read_results(spark, out)
    assert set(back) >= {"forecasts", "metrics", "best_models", "summary"}
    assert back["metrics"].count() == res.metrics.count()
    ana = analyze_results(spark, out)
    assert ana["forecast_summary"].filter("series = 'total_demand'").first()["horizon"] == 6
    assert ana["mean_metrics"].count() >= 1
    assert ana["comparison"].count() == len({r["series"] for r in fc}) == ana["forecast_summary"].first()["n_targets"]
    assert res.log["series"] > 1 and res.log["anomalies"] >= res.log["repaired"] >= res.log["repaired_series"]
    assert not spark._jsparkSession.sharedState().cacheManager().cachedData().size()


def test_drop_original(spark):
    raw = proxy.raw_vacancies(spark, SF)
    cfg = Q.proxy_prep_config()
    cfg.drop_original = True
    out = prepare(raw, cfg)
    assert "organization" not in out.columns and "date_creation" not in out.columns
    assert "organization_encoded" in out.columns and "work_places" in out.columns


def test_union_batches_and_head(spark):
    from jobtide.operators.report import head_rows
    from jobtide.sources.vacancies import union_batches
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    u = union_batches(a, b).orderBy("id").collect()
    assert u[0]["b"] is None and u[1]["a"] is None and u[1]["b"] == 3.0
    assert head_rows(union_batches(a, b), 1, "id").first()["id"] == 1


def test_total_without_group_column(spark):
    import datetime as dt
    from jobtide.operators.spans import demand_series
    rows = [(1, dt.datetime(2019, 1, 5), dt.datetime(2019, 3, 5), 2),
            (2, dt.datetime(2019, 2, 5), dt.datetime(2019, 3, 5), 3)]
    sp = spark.createDataFrame(rows, "id int, start_ts timestamp, end_ts timestamp, weight long")
    out = {(r["series"], str(r["period"])): r["value"]
           for r in demand_series(sp, "M", group_col=None).collect()}
    assert out[("total_demand", "2019-01-31")] == 2.0
    assert out[("total_demand", "2019-02-28")] == 5.0
    assert {k[0] for k in out} == {"total_demand"}
