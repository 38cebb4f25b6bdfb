"""TS-01 on the period-edge fixtures (FIXTURES.md F3) and properties."""

import datetime as dt
import random

from pyspark.sql import functions as F

from jobtide.operators.spans import demand_series

D = dt.date


def _spans(spark, rows):
    return spark.createDataFrame(
        [(i, g, dt.datetime.combine(a, dt.time()), dt.datetime.combine(b, dt.time()), w)
         for i, (g, a, b, w) in enumerate(rows)],
        "id long, grp string, start_ts timestamp, end_ts timestamp, weight long")


def _get(df, series):
    return {r["period"]: r["value"] for r in df.filter(F.col("series") == series).collect()}


def test_month_edges(spark):
    rows = [("a", D(2019, 1, 15), D(2019, 3, 10), 1),
            ("a", D(2019, 1, 15), D(2019, 1, 30), 10),
            ("a", D(2019, 1, 31), D(2019, 2, 1), 100)]
    out = _get(demand_series(_spans(spark, rows), "M", min_activity=1), "a")
    assert out == {D(2019, 1, 31): 101.0, D(2019, 2, 28): 1.0}


def test_week_edges(spark):
    rows = [("a", D(2019, 1, 16), D(2019, 2, 6), 1)]
    out = _get(demand_series(_spans(spark, rows), "W", min_activity=1), "a")
    assert out == {D(2019, 1, 20): 1.0, D(2019, 1, 27): 1.0, D(2019, 2, 3): 1.0}


def test_two_week_parity(spark):
    # grid starts in the week of 2019-01-14; a span one week later never meets it
    rows = [("a", D(2019, 1, 14), D(2019, 3, 1), 1), ("a", D(2019, 1, 23), D(2019, 3, 1), 10)]
    out = _get(demand_series(_spans(spark, rows), "2W", min_activity=1), "a")
    assert set(out) == {D(2019, 1, 20), D(2019, 2, 3), D(2019, 2, 17)}
    assert all(v == 1.0 for v in out.values())
    grid = _get(demand_series(_spans(spark, rows), "2W", min_activity=1, align="grid"), "a")
    assert grid[D(2019, 2, 3)] == 11.0


def test_no_active_group_goes_to_total(spark):
    rows = [("a", D(2019, 1, 15), D(2019, 4, 10), 1), ("b", D(2019, 2, 15), D(2019, 4, 10), 2)]
    out = demand_series(_spans(spark, rows), "M", min_activity=5)
    names = {r["series"] for r in out.select("series").distinct().collect()}
    assert names == {"total", "total_demand"}
    assert _get(out, "total") == _get(out, "total_demand")


def test_events_equal_explode_and_total_is_sum(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        a = D(2018, 1, 1) + dt.timedelta(days=rnd.randrange(0, 700))
        b = a + dt.timedelta(days=rnd.randrange(0, 200))
        rows.append((rnd.choice("abcd"), a, b, rnd.randrange(1, 9)))
    sp = _spans(spark, rows)
    for freq in ("M", "W", "2W"):
        ev = demand_series(sp, freq, min_activity=5, method="events")
        ex = demand_series(sp, freq, min_activity=5, method="explode")
        a = sorted(ev.collect())
        b = sorted(ex.collect())
        assert a == b
        per = ev.filter("series <> 'total_demand'").groupBy("period").agg(F.sum("value").alias("s"))
        tot = ev.filter("series = 'total_demand'").join(per, "period")
        assert tot.filter(F.abs(F.col("value") - F.col("s")) > 1e-9).count() == 0
        # every series has every period
        counts = {r["count"] for r in ev.groupBy("series").count().collect()}
        assert len(counts) == 1


def test_brute_force_month(spark):
    rows = [("a", D(2019, 1, 15), D(2019, 5, 2), 3), ("a", D(2019, 2, 1), D(2019, 2, 28), 5),
            ("a", D(2019, 3, 31), D(2019, 6, 1), 7)]
    out = _get(demand_series(_spans(spark, rows), "M", min_activity=1), "a")
    # brute force: months from the start month up to, not including, the end month
    exp = {}
    for _, a, b, w in rows:
        y, m = a.year, a.month
        while (y, m) < (b.year, b.month):
            nxt = D(y + (m == 12), m % 12 + 1, 1)
            exp[nxt - dt.timedelta(days=1)] = exp.get(nxt - dt.timedelta(days=1), 0) + w
            y, m = nxt.year, nxt.month
    for k in out:
        assert out[k] == exp.get(k, 0)
    assert min(out) == D(2019, 1, 31) and max(out) == D(2019, 5, 31)


def test_end_inclusive(spark):
    rows = [("a", D(2019, 1, 15), D(2019, 3, 10), 1)]
    out = _get(demand_series(_spans(spark, rows), "M", min_activity=1, end_inclusive=True), "a")
    assert out == {D(2019, 1, 31): 1.0, D(2019, 2, 28): 1.0, D(2019, 3, 31): 1.0}
