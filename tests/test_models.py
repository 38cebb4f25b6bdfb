"""Metrics, selection and recursion (ML-07, ML-09, AGG-21)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from jobtide.plans import models as M


def test_metrics_arithmetic(spark):
    rows = [("s", "m", 1.0, 2.0), ("s", "m", 3.0, 3.0), ("s", "m", 5.0, 3.0),
            ("k", "m", 2.0, 1.0), ("k", "m", 2.0, 3.0)]
    df = spark.createDataFrame(rows, "series string, model string, y double, y_hat double")
    out = {r["series"]: r for r in M.metrics(df).collect()}
    s = out["s"]
    assert abs(s["mae"] - 1.0) < 1e-12
    assert abs(s["rmse"] - math.sqrt(5 / 3)) < 1e-12
    assert abs(s["r2"] - (1 - 5 / 8)) < 1e-12
    assert out["k"]["r2"] is None                     # constant target (Q19)


def test_best_model_tie_goes_to_second(spark):
    rows = [("a", M.RF, 1.0, 2.0, 0.0), ("a", M.GBT, 1.0, 2.0, 0.0),
            ("b", M.RF, 1.0, 1.0, 0.0), ("b", M.GBT, 1.0, 3.0, 0.0)]
    df = spark.createDataFrame(rows, "series string, model string, mae double, rmse double, r2 double")
    best = {r["series"]: r["best_model"] for r in M.best_model(df).collect()}
    assert best == {"a": M.GBT, "b": M.RF}


def _loop(h, steps):
    h = list(h)
    out = []
    for _ in range(steps):
        v = max(0.0, float(round((h[-1] + h[-2]) / 2)))   # Python round: half to even
        h.append(v)
        out.append(v)
    return out


def test_recursive_closed_form(spark):
    vals = [float(v) for v in [3, 8, 5, 6, 9, 1, 2, 7, 4, 4, 5, 6, 1, 2, 3, 10, 11, 12, 13, 5, 6, 8,
                               9, 10, 11, 3, 4]]
    ps = [dt.date(2019, 1, 31)]
    for _ in vals[1:]:
        d = ps[-1] + dt.timedelta(days=1)
        nxt = dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)
        ps.append(nxt - dt.timedelta(days=1))
    df = spark.createDataFrame([("a", p, v) for p, v in zip(ps, vals)],
                               "series string, period date, value double")
    h = M.history(df, 24)
    fc = M.recursive_forecast(h, M.column_predictor(F.col("ma_3")), 6, "M").orderBy("step").collect()
    assert [r["forecast"] for r in fc] == _loop(vals[-24:], 6)
    assert fc[0]["period"] == dt.date(2021, 4, 30)
    assert [r["step"] for r in fc] == list(range(1, 7))


def test_forest_fit_predicts_finite(spark):
    from jobtide.operators.features import make_features
    ps = [dt.date(2019, 1, 1) + dt.timedelta(days=7 * i) for i in range(40)]
    df = spark.createDataFrame([("a", p, float(10 + (i % 5))) for i, p in enumerate(ps)],
                               "series string, period date, value double")
    feats = make_features(df)
    model = M.fit(M.forest, feats, M.TreeParams(rf_trees=5))
    preds = [r["prediction"] for r in M.predict(model, feats).collect()]
    assert len(preds) == 40 and all(math.isfinite(p) for p in preds)


def test_recursive_exact_ma_and_weekly_step(spark):
    vals = [float(v) for v in range(1, 31)]
    ps = [dt.date(2020, 1, 5) + dt.timedelta(days=7 * i) for i in range(len(vals))]
    df = spark.createDataFrame([("w", p, v) for p, v in zip(ps, vals)],
                               "series string, period date, value double")
    h = M.history(df, 24)
    fc = M.recursive_forecast(h, M.column_predictor(F.col("ma_3")), 3, "W",
                              exact_ma=True).orderBy("step").collect()
    hist = vals[-24:]
    exp = []
    for _ in range(3):
        v = max(0.0, float(round(sum(hist[-3:]) / 3)))
        hist.append(v)
        exp.append(v)
    assert [r["forecast"] for r in fc] == exp
    assert fc[0]["period"] == ps[-1] + dt.timedelta(days=7)
    monthly = M.recursive_forecast(h, M.column_predictor(F.col("ma_3")), 2, "W",
                                   step="month").orderBy("step").collect()
    assert ps[-1] == dt.date(2020, 7, 26)
    assert monthly[0]["period"] == dt.date(2020, 8, 26)   # last period + 1 month
