"""TS-08 features on short series (lags beyond the series, MA fallbacks, diffs)."""

import datetime as dt

from jobtide.operators.features import FEATURES, make_features


def test_short_series_features(spark):
    ps = [dt.date(2019, 1, 31), dt.date(2019, 2, 28), dt.date(2019, 3, 31), dt.date(2019, 4, 30)]
    df = spark.createDataFrame([("a", p, float(v)) for p, v in zip(ps, [1, 2, 3, 10])],
                               "series string, period date, value double")
    rows = make_features(df).orderBy("period").collect()
    mean = (1 + 2 + 3 + 10) / 4
    assert [r["lag_1"] for r in rows] == [0.0, 1.0, 2.0, 3.0]
    assert all(r["lag_4"] == 0.0 and r["lag_12"] == 0.0 for r in rows)
    assert [r["ma_3"] for r in rows] == [mean, mean, mean, 2.0]
    assert all(r["ma_6"] == mean for r in rows)
    assert [r["diff_1"] for r in rows] == [0.0, 1.0, 1.0, 7.0]   # contains y(t) (Q5)
    assert all(r["diff_4"] == 0.0 for r in rows)
    assert [r["is_quarter_end"] for r in rows] == [0, 0, 1, 0]
    assert set(FEATURES) <= set(rows[0].asDict())


def test_leak_free_diff(spark):
    ps = [dt.date(2019, m, 1) for m in range(1, 7)]
    df = spark.createDataFrame([("a", p, float(v)) for p, v in zip(ps, [1, 4, 9, 16, 25, 36])],
                               "series string, period date, value double")
    rows = make_features(df, leak_free=True).orderBy("period").collect()
    assert [r["diff_1"] for r in rows] == [0.0, 0.0, 3.0, 5.0, 7.0, 9.0]
