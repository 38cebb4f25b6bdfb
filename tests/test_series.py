"""Series operators against straightforward pandas/numpy re-computations."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from jobtide.operators import series as TS


def _long(spark, data: dict[str, list[float]], start=dt.date(2019, 1, 31)):
    rows = []
    for name, vals in data.items():
        p = pd.Timestamp(start)
        for v in vals:
            rows.append((name, p.date(), None if v is None else float(v)))
            p = p + pd.offsets.MonthEnd(1)
    return spark.createDataFrame(rows, "series string, period date, value double")


def _flagged(spark, name, vals, marked):
    flags = TS.anomaly_flags(_long(spark, {name: vals}))
    month = F.months_between("period", F.lit(dt.date(2019, 1, 31))).cast("int")
    return flags.withColumn("is_anomaly", month.isin(*marked))


def _fixed(df):
    return [r["fixed"] for r in df.orderBy("period").collect()]


def test_sequential_repair_worked_by_hand(spark):
    # Window of 8 neighbours each way, here the whole series.
    # 900 among [10, 20, 30, 40, 800]: 90 % quantile 496 < 900, so 496; then
    # 800 among [10, 20, 30, 40, 496]: 90 % quantile 313.6 < 800, so 313.
    vals = [10, 20, 900, 800, 30, 40]
    assert _fixed(TS.repair_sequential(_flagged(spark, "a", vals, [2, 3]))) == [10, 20, 496, 313, 30, 40]
    # The window form takes the original 900 as a neighbour of 800: 90 % quantile of [10, 20, 900, 30, 40] is 556.
    assert _fixed(TS.repair_window(_flagged(spark, "a", vals, [2, 3]))) == [10, 20, 496, 556, 30, 40]
    # A low value takes the 25 % quantile: of [100, 120, 140, 160] it is 115.
    assert _fixed(TS.repair_sequential(_flagged(spark, "a", [100, 120, 0, 140, 160], [2]))) == [100, 120, 115, 140, 160]


def test_sequential_repair_of_the_total_by_hand(spark):
    name = "total_demand"
    # Up to the cap of 80000 the mean of the neighbours: (100 + 200 + 300 + 500) / 4 = 275.
    assert _fixed(TS.repair_sequential(_flagged(spark, name, [100, 200, 7000, 300, 500], [2]))) == [100, 200, 275, 300, 500]
    # Above it the larger of the 75 % quantile (350) and 60 % of the value (54000).
    assert _fixed(TS.repair_sequential(_flagged(spark, name, [100, 200, 90000, 300, 500], [2]))) == [100, 200, 54000, 300, 500]


def test_window_repair_uses_original_neighbours(spark):
    vals = [100.0] * 20
    vals[5], vals[6] = 900.0, 800.0
    df = _long(spark, {"a": vals})
    flags = TS.anomaly_flags(df)
    rep = {r["period"]: r["fixed"] for r in TS.repair_window(flags).collect()}
    seq = {r["period"]: r["fixed"] for r in TS.repair_sequential(flags).collect()}
    ps = sorted(rep)
    # non-sequential: the 7th value sees the original 900 among its neighbours
    assert rep[ps[5]] == 100.0 and seq[ps[5]] == 100.0
    assert all(v >= 0 for v in rep.values())


def test_anomaly_rules_constant_series(spark):
    df = _long(spark, {"c": [5.0] * 12, "z": [0.0] * 10 + [3.0, 0.0]})
    f = {(r["series"], r["period"]): r for r in TS.anomaly_flags(df).collect()}
    assert not any(r["is_anomaly"] for k, r in f.items() if k[0] == "c")
    # median 0: any change is a jump
    assert sum(r["rule_jump"] for k, r in f.items() if k[0] == "z") == 3


def test_cubic_fill_four_points_is_the_cubic(spark):
    # y = t^3 on month-end ordinals: not-a-knot with 4 knots is the cubic itself
    ps = pd.date_range("2019-01-31", periods=7, freq="ME")
    t = np.array([p.toordinal() for p in ps], dtype=float)
    t0 = t - t[0]
    y = (t0 / 10.0) ** 3
    vals = [float(y[0]), float(y[1]), None, float(y[3]), None, None, float(y[6])]
    df = spark.createDataFrame([("a", p.date(), v) for p, v in zip(ps, vals)],
                               "series string, period date, value double")
    out = {r["period"]: r["value"] for r in TS.interpolate_cubic(df).collect()}
    for p, exp in zip(ps, y):
        assert abs(out[p.date()] - exp) < 1e-6 * max(1.0, abs(exp))


def test_outlier_removal_linear(spark):
    vals = [10.0] * 30
    vals[15] = 1000.0
    df = _long(spark, {"a": vals, "short": [1.0, 2.0, 100.0]})
    out = {(r["series"], r["period"]): r["value"]
           for r in TS.remove_outliers(df, 3.0, method="linear").collect()}
    a = [v for (s, _), v in sorted(out.items()) if s == "a"]
    assert max(a) == 10.0
    short = [v for (s, _), v in sorted(out.items()) if s == "short"]
    assert short == [1.0, 2.0, 100.0]   # three points: untouched


def test_decompose_matches_numpy(spark):
    rng = np.random.default_rng(1)
    n = 40
    y = 100 + np.arange(n) * 2.0 + 10 * np.sin(np.arange(n) * 2 * np.pi / 12) + rng.normal(0, 1, n)
    df = _long(spark, {"a": list(y), "short": list(y[:23]), "edge": list(y[:24])})
    allrows = TS.decompose(df).orderBy("period").collect()
    assert {r["series"] for r in allrows} == {"a", "edge"}     # 23 points: skipped
    d = [r for r in allrows if r["series"] == "a"]
    w = np.r_[0.5, np.ones(11), 0.5] / 12
    trend = np.full(n, np.nan)
    for i in range(6, n - 6):
        trend[i] = np.dot(w, y[i - 6:i + 7])
    det = y - trend
    pm = np.array([np.nanmean(det[i::12]) for i in range(12)])
    pm -= pm.mean()
    seas = np.tile(pm, n // 12 + 1)[:n]
    for i, r in enumerate(d):
        assert abs(r["seasonal"] - seas[i]) < 1e-9
        if np.isnan(trend[i]):
            assert r["trend"] is None
        else:
            assert abs(r["trend"] - trend[i]) < 1e-9


def test_cubic_outlier_removal_changes_only_masked_points(spark):
    from jobtide.plans import queries as Q
    sf = "/root/testdata/sf0.01"
    orig = {(r["series"], r["period"]): r["value"] for r in Q._series(spark, sf, "W").collect()}
    lin = {(r["series"], r["period"]): r["is_outlier"]
           for r in Q.ts02_outliers_linear_z2(spark, sf).collect()}
    cub = {(r["series"], r["period"]): r["value"] for r in Q.QUERIES["ts02_outliers_cubic_z2"](spark, sf).collect()}
    masked = {k for k, v in lin.items() if v}
    assert masked
    assert all(cub[k] == orig[k] for k in orig if k not in masked)
    assert all(cub[k] != orig[k] for k in masked)


def _spline_system(x, y, xq):
    """Second derivatives from the dense system of the same conditions."""
    n, h = len(x), np.diff(x)
    d = np.diff(y) / h
    a, r = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1:i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        r[i] = 6 * (d[i] - d[i - 1])
    a[0, :3], a[-1, -3:] = (h[1], -(h[0] + h[1]), h[0]), (h[-1], -(h[-2] + h[-1]), h[-2])
    m = np.linalg.solve(a, r)
    k = int(np.searchsorted(x, xq)) - 1
    u, v, w = x[k + 1] - xq, xq - x[k], h[k]
    return (m[k] * u ** 3 + m[k + 1] * v ** 3) / (6 * w) + (y[k] / w - m[k] * w / 6) * u + (y[k + 1] / w - m[k + 1] * w / 6) * v


def test_cubic_fill_equals_the_dense_system(spark):
    import datetime as dt
    import random
    rng = random.Random(1)
    rows = []
    for name, n in (("a", 30), ("b", 6), ("c", 4), ("d", 3), ("e", 50), ("f", 2), ("g", 1), ("h", 8)):
        t = dt.date(2020, 1, 5)
        for i in range(n):
            t += dt.timedelta(days=rng.choice([7, 7, 28, 31]))
            edge = name in "bcdf" and i in (0, n - 1)
            rows.append((name, t, None if name == "h" else rng.uniform(0, 100) if edge or rng.random() < 0.7 else None))
    df = spark.createDataFrame(rows, "series string, period date, value double")
    out = {(r["series"], r["period"]): r["value"] for r in TS.interpolate_cubic(df).collect()}
    assert len(out) == len(rows)
    filled = 0
    for name in "abcdefgh":
        pts = [(t.toordinal(), v, t) for s, t, v in rows if s == name]
        known = [p for p in pts if p[1] is not None]
        for o, v, t in pts:
            if v is not None:
                assert out[name, t] == v
            elif len(known) < 2 or not known[0][0] < o < known[-1][0]:
                assert out[name, t] is None
            else:
                x, y = np.array([p[0] for p in known], float), np.array([p[1] for p in known])
                want = _spline_system(x, y, float(o)) if len(known) >= 4 else np.interp(o, x, y)
                assert abs(out[name, t] - want) < 1e-9 * max(1, abs(want))
                filled += 1
    assert filled > 10
