"""Pooled training, validation origins, fixed configurations (ML-08, ML-10, API-02, API-03)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from jobtide.config import ForecastConfig
from jobtide.plans import forecast as FC
from jobtide.plans import models as M
from jobtide.sources import proxy

SF = "/root/testdata/sf0.001"
SMALL = M.TreeParams(rf_trees=5, gbt_rounds=3)
GRID = [{"freq": "M", "outlier_removal": False}, {"freq": "W", "outlier_removal": True}, {"freq": "2W", "outlier_removal": False}]


@pytest.fixture()
def fits(monkeypatch):
    made = []
    real = M.fit
    monkeypatch.setattr(M, "fit", lambda make, train, params=None, features=M.FEATURES: (made.append(make), real(make, train, params, features))[1])
    return made


@pytest.mark.parametrize("grid, top_k", [(GRID[:1], 1), (GRID, 4)])
def test_fits_do_not_depend_on_grid_or_targets(spark, fits, grid, top_k):
    res = FC.run_forecast(proxy.order_spans(spark, SF), ForecastConfig(grid=grid, top_k=top_k), SMALL)
    assert len(fits) == 4                                    # two models, validation and all rows
    fc = res.forecasts.collect()
    names = {r["series"] for r in fc}
    assert len(names) == top_k + 1 and "total_demand" in names
    assert all(r["forecast"] >= 0 and r["forecast"] == int(r["forecast"]) for r in fc) and len(fc) == 6 * len(names)
    assert {r["series"] for r in res.best_models.collect()} == {r["series"] for r in res.metrics.collect()} == names
    table = res.search.orderBy("config_id").collect()
    assert [r["freq"] for r in table] == [c["freq"] for c in grid] and sum(r["is_best"] for r in table) == 1
    assert max(r["best_r2"] for r in table) == [r["best_r2"] for r in table if r["is_best"]][0]


def test_search_alone_needs_two_fits(spark, fits):
    found = FC.config_search(proxy.order_spans(spark, SF), ForecastConfig(grid=GRID), SMALL)
    assert len(fits) == 2 and found.best in GRID and found.table.count() == 3
    none = FC.config_search(proxy.order_spans(spark, SF), ForecastConfig(grid=GRID, min_points=10_000), SMALL)
    assert none.best is None and none.table.where("best_r2 IS NULL").count() == 3


def test_stated_configuration_and_repair_switch(spark, fits):
    spans = proxy.order_spans(spark, SF)
    cfg = ForecastConfig(config={"freq": "2W"}, repair=False, top_k=1)
    res = FC.run_forecast(spans, cfg, SMALL)
    assert res.log == {} and [r["freq"] for r in res.search.collect()] == ["2W"]
    raw = FC._series_for(spans, "2W", cfg)
    assert sorted(map(tuple, res.series.collect())) == sorted(map(tuple, raw.collect()))


def _series(n, name="s", scale=1.0):
    rng = random.Random(n)
    return [(name, dt.date(2020, 1, 5) + dt.timedelta(days=7 * i), scale * (100 + 10 * math.sin(i / 3) + rng.random())) for i in range(n)]


def test_rolling_origins_split_as_stated(spark):
    df = spark.createDataFrame(_series(40), "series string, period date, y double")
    pos = {r["period"]: k for k, r in enumerate(df.orderBy("period").collect())}
    for origin, last in ((0, 40), (1, 34), (2, 28)):
        rows = M.chrono_split(df, periods=6, origin=origin).collect()
        assert {pos[r["period"]] for r in rows if r["is_train"]} == set(range(last - 6))
        assert {pos[r["period"]] for r in rows if not r["is_train"]} == set(range(last - 6, last))


def test_validation_periods_change_the_metrics(spark, fits):
    ts = spark.createDataFrame(_series(60), "series string, period date, value double")
    out = {}
    for key, cfg in {"fifth": ForecastConfig(), "last": ForecastConfig(validation_periods=6),
                     "two": ForecastConfig(validation_periods=6, validation_origins=2)}.items():
        before = len(fits)
        met = FC.forecast_targets(ts, ["s"], cfg, "W", SMALL)[0]
        out[key] = {r["model"]: r["rmse"] for r in met.collect()}
        assert len(fits) - before == (6 if key == "two" else 4)
    assert len({tuple(sorted(v.items())) for v in out.values()}) == 3


def test_scale_uses_training_rows_only_and_forecasts_are_in_own_units(spark):
    small, large = _series(60, "small"), _series(60, "large", 1000.0)
    ts = spark.createDataFrame(small + large, "series string, period date, value double")
    feats = FC._features([(0, ts, {"small": 0, "large": 1})], ForecastConfig())
    split = M.scaled(M.chrono_split(feats, 0.8)).collect()
    for key, rows in (("0:0", small), ("0:1", large)):
        mean = sum(v for *_, v in rows[:48]) / 48
        mine = sorted((r["period"], r["scale"], r["y"]) for r in split if r["series"] == key)
        assert all(abs(s - mean) < 1e-6 * mean and abs(y * s - v) < 1e-6 * v for (_, s, y), (*_, v) in zip(mine, rows))
    fc = FC.forecast_targets(ts, ["small", "large"], ForecastConfig(), "W", M.TreeParams(rf_trees=20, gbt_rounds=10))[2]
    got = {r["series"]: r["m"] for r in fc.groupBy("series").agg(F.avg("forecast").alias("m")).collect()}
    assert 80 < got["small"] < 120 and 80_000 < got["large"] < 120_000


def test_too_short_series_have_no_forecast(spark):
    ts = spark.createDataFrame(_series(8), "series string, period date, value double")
    assert FC.forecast_targets(ts, ["s"], ForecastConfig(), "W", SMALL) is None
