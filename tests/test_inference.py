"""Inferred date forms, row counts on the way, equal-width bins, mergeable distinct counts (FN-08, AGG-06/08/24/29)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobtide.config import PrepConfig
from jobtide.functions.scalar import parse_timestamp
from jobtide.operators import encode as E
from jobtide.operators import report as R
from jobtide.operators import series as TS
from jobtide.operators.dateforms import infer_date_formats, resolve
from jobtide.plans.prepare import PrepLog, clean_rows, prepare


def _parsed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    formats = infer_date_formats(df, ["d", "absent"])
    return [r["ts"] for r in df.select("i", parse_timestamp("d", formats["d"]).alias("ts")).orderBy("i").collect()], formats["d"]


def test_year_first_dates_need_no_formats(spark):
    texts = ["2019-01-02T03:04:05+0300", "2019-01-02T03:04:05Z", "2019-01-02T03:04:05.123", "2019-01-02 03:04", "2019-1-2",
             " 2019-01-02 03:04:05 -02:30 ", "2019-02-30", "03:04:05", "2019", "", None, "now", "2019-01-02x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    got = [r["ts"] for r in df.select("i", parse_timestamp("d").alias("ts")).orderBy("i").collect()]
    d = dt.datetime
    assert got == [d(2019, 1, 2, 0, 4, 5), d(2019, 1, 2, 3, 4, 5), d(2019, 1, 2, 3, 4, 5, 123000), d(2019, 1, 2, 3, 4), d(2019, 1, 2),
                   d(2019, 1, 2, 5, 34, 5), None, None, None, None, None, None, None]


@pytest.mark.parametrize("texts, want", [
    (["13.02.2019", "01.02.2019 10:00"], [(2019, 2, 13), (2019, 2, 1)]),
    (["01/02/2019", "3/4/2019 1:05 PM"], [(2019, 1, 2), (2019, 3, 4)]),                     # nothing tells: month first
    (["01/02/2019", "31/12/2019"], [(2019, 2, 1), (2019, 12, 31)]),                          # a day in first place
    (["01.02.2019", "12.31.2019"], [(2019, 1, 2), (2019, 12, 31)]),                          # a day in second place
    (["2019/3/4", "20190305", "5 Mar 2019", "March 6, 2019", "07.03.19"], [(2019, 3, 4), (2019, 3, 5), (2019, 3, 5), (2019, 3, 6), (2019, 3, 7)]),
    (["soon", "", None, "99/99/2019"], [None] * 4),
])
def test_forms_are_inferred_per_column(spark, texts, want):
    got, _ = _parsed(spark, texts)
    assert [g and (g.year, g.month, g.day) for g in got] == want


def test_both_orders_are_tried_where_both_places_hold_days():
    assert resolve([("{1}/{2}/yyyy", 5, 31, 31)]) == ("d/M/yyyy", "M/d/yyyy")
    assert resolve([("other", 9, None, None), ("yyyy/M/d", 1, 2019, 3), ("{1}.{2}.yyyy", 2, 9, 9)]) == ("d.M.yyyy", "yyyy/M/d")


def test_counts_are_taken_while_preparing(spark):
    rows = [("Инженер", "2", "IT", "2019-03-01", None), ("инженер", "2", "IT", "someday", "0"), ("инженер", "2", None, "2019-03-01", "0"),
            ("инженер", "2", "IT", "1999-01-01", "0"), ("инженер", "2", "IT", "junk", "1"), ("повар", "1", "IT", "2019-03-01", "0")]
    raw = spark.createDataFrame(rows, "title string, work_places string, industry string, date_creation string, date_creation_mistake string")
    log = PrepLog()
    out = prepare(raw, PrepConfig(), log=log)
    assert out.count() == 1
    assert log.counts() == {"rows_read": 6, "title_kept": 5, "date_kept": 3, "order_kept": 3, "industry_kept": 2, "window_kept": 1, "unread_date_creation": 1}
    assert {r["step"]: r["pct_of_read"] for r in log.table(spark).collect()}["title_kept"] == 83.3333
    cleaned = clean_rows(raw)
    assert cleaned.count() == 1 and set(cleaned.columns) == {c for c in out.columns if not c.endswith("_encoded")}


def test_equal_width_where_edges_collapse(spark):
    df = spark.createDataFrame([(0.0, 1.0)] * 95 + [(float(k), 2.0) for k in (1, 2, 3, 4, 100)], "x double, t double")
    bins = E.fit_numeric_bins(df, ["x"], 10, fence=None, min_edges=3)["x"]
    assert bins.edges == [10.0 * i for i in range(11)]
    got = {r["b"]: r["n"] for r in df.groupBy(E.bin_index(F.col("x"), bins).alias("b")).agg(F.count("*").alias("n")).collect()}
    assert got == {0: 99, 9: 1}
    assert E.fit_numeric_bins(df, ["x"], 10)["x"].edges is None     # clipped to one value: the global mean for all


def test_large_maps_are_joined_and_small_ones_broadcast(spark):
    df = spark.createDataFrame([(f"c{i % 200}", f"d{i % 300}", float(i)) for i in range(900)], "a string, b string, work_places double")
    wide = E.target_encode(df, ["a", "b"], broadcast_max_bytes=1 << 20)
    none = E.target_encode(df, ["a", "b"], broadcast_max_bytes=0)
    one = E.target_encode(df, ["a", "b"], broadcast_max_bytes=200 * 70)
    rows = [sorted(map(tuple, x.collect())) for x in (wide, none, one)]
    assert rows[0] == rows[1] == rows[2]
    hints = [x._jdf.queryExecution().analyzed().toString().count("strategy=broadcast") for x in (wide, none, one)]
    assert hints == [2, 0, 1]


def test_sketches_merge_alike_for_any_split(spark):
    df = spark.range(20_000).select((F.col("id") % 7000).alias("a"), (F.col("id") % 3).cast("string").alias("b"), F.lit(None).cast("string").alias("c"), "id")
    counts = []
    for k in (1, 2, 5):
        parts = [R.distinct_sketches(df.where(f"id % {k} = {j}"), ["a", "b", "c"]) for j in range(k)]
        merged = parts[0]
        for p in parts[1:]:
            merged = merged.unionByName(p)
        counts.append({r["feature"]: r["distinct"] for r in R.distinct_counts(R.merge_sketches(merged)).collect()})
    assert counts[0] == counts[1] == counts[2]
    assert counts[0]["b"] == 3 and counts[0]["c"] == 0 and abs(counts[0]["a"] - 7000) <= 4 * R.SKETCH_ERROR * 7000


def test_series_log_counts_cells_and_series(spark):
    day = lambda i: dt.date(2020, 1, 31) + dt.timedelta(days=31 * i)
    rows = [("a", day(i), 10.0 + i % 2) for i in range(30)] + [("b", day(i), 500.0 if i in (5, 20) else 10.0 + i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "series string, period date, value double")
    log = TS.SeriesLog()
    flags = TS.anomaly_flags(df).collect()
    fixed = {(r["series"], r["period"]): r["value"] for r in TS.detect_and_repair(df, log=log).collect()}
    changed = {(s, p) for s, p, v in rows if fixed[s, p] != v}
    TS.remove_outliers(df, 3.0, log=log).collect()
    flagged = {(r["series"], r["period"]) for r in flags if r["is_anomaly"]}
    assert log.counts() == {"series": 2, "anomalies": len(flagged), "anomalies_series": len({s for s, _ in flagged}), "repaired": len(changed),
                            "repaired_series": len({s for s, _ in changed}), "outliers": 2, "outliers_series": 1}
    counts = {r["series"]: r["outliers"] for r in TS.outlier_counts(TS.outlier_mask(df, 3.0)).collect()}
    assert counts == {"a": 0, "b": 2}


def test_date_texts_are_counted_by_outline_before_their_shapes(spark):
    from jobtide.operators.dateforms import date_shapes
    texts = ["2019-01-02", "2019-1-2", "13/2/2019", "1/31/2019", "1/31/2019", "5 Mar 2019", "20190102", "soon", "x 5 Mar 2019", "2019-01-02T03:04:05+0300", "", None]
    shapes = date_shapes(spark.createDataFrame([(t,) for t in texts], "d string"), ["d"])
    got = {r["shape"]: (r["n"], r["first"], r["second"]) for r in shapes.collect()}
    assert got == {"yyyy-M-d": (2, 2019, 1), "{1}/{2}/yyyy": (3, 13, 31), "d MMM yyyy": (1, None, None), "yyyyMMdd": (1, None, None),
                   "other": (2, None, None), "yyyy-M-d'T'H:m:sXX": (1, 2019, 1)}
    plan = shapes._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate"):].split("\n", 1)[1]            # what runs for each row, before the first count
    assert "RLIKE" in below and "regexp_extract" not in below


def test_edge_spaces_as_the_regular_expression_takes_them(spark):
    from jobtide.functions.scalar import trim_space
    edges = [chr(i) for i in (*range(1, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2030), 0x205F, 0x2060, 0x3000, 0xFEFF)]
    df = spark.createDataFrame([(f"{e}a{e}b {e}",) for e in edges] + [(" ",), ("",), (None,)], "t string")
    assert not df.where(~trim_space("t").eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).collect()


def test_rows_cleaned_for_some_columns_are_parsed_once(spark):
    rows = [("инженер", "2", "IT", "2019-03-01"), ("инженер", "9", "IT", "1999-01-01"), ("инженер", "3", None, "2019-03-01"), ("повар", "1", "IT", "2019-03-01")]
    raw = spark.createDataFrame(rows, "title string, work_places string, industry string, date_creation string")
    some = clean_rows(raw, columns=["work_places", "absent"])
    assert some.columns == ["work_places"] and [tuple(r) for r in some.collect()] == [(2,)]
    assert "rlike" not in some._jdf.queryExecution().optimizedPlan().toString().lower()
    assert clean_rows(raw).select("work_places").collect() == some.collect()


def test_preparation_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    rows = [("инженер", "2", "IT", f"2019-03-{1 + i % 28:02d}", "soon" if i % 3 else "13.02.2019") for i in range(40)]
    df = spark.createDataFrame(rows, "title string, work_places string, industry string, date_creation string, date_posted string")
    raw = df.withColumn("date_creation", F.udf(seen).asNondeterministic()("date_creation"))
    assert prepare(raw, PrepConfig()).count() == 40
    assert read.value == 40


def test_forms_are_inferred_for_columns_with_unread_texts(spark, monkeypatch):
    from jobtide.plans import prepare as P
    asked = []
    infer = P.infer_date_formats
    monkeypatch.setattr(P, "infer_date_formats", lambda df, columns: asked.append(list(columns)) or infer(df, columns))
    rows = [("инженер", "2", "IT", "2019-03-01", "0", "13.02.2019", "1.5.2019"), ("инженер", "3", "IT", "01.04.2019", "1", "2019-02-14", None),
            ("инженер", "4", "IT", " 2019-05-01 10:20 ", "0", "soon", "2019-06-01T01:00:00+0300")]
    names = "title work_places industry date_creation date_creation_mistake date_posted date_inactivation".split()
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    log = P.PrepLog()
    got = {r["work_places"]: r for r in prepare(raw, PrepConfig(), log=log).collect()}
    assert asked == [["date_posted", "date_inactivation"]]          # the flagged text is not read, whatever its form
    d = dt.datetime
    assert {k: (r["date_creation_processed"], r["date_posted_processed"], r["date_posted_month"], r["date_end"]) for k, r in got.items()} == {
        2: (d(2019, 3, 1), d(2019, 2, 13), 2, d(2019, 5, 1)), 4: (d(2019, 5, 1, 10, 20), None, None, d(2019, 5, 31, 22))}
    assert log.counts()["unread_date_posted"] == 1 and log.counts()["title_kept"] == 3


def test_joint_features_give_the_same_maps(spark):
    df = spark.createDataFrame([(2018 + i % 3, i % 12 + 1 if i % 7 else None, f"c{i % 4}", float(i % 5) if i % 11 else None) for i in range(200)],
                               "y int, m int, c string, work_places double")
    one, all_ = (sorted(map(tuple, E.encoding_maps(df, ["y", "m", "c"], {}, "work_places", 10, 2.0, joint).collect())) for joint in ([("y", "m")], ()))
    assert len(one) == len(all_) == 3 + 13 + 4
    for a, b in zip(one, all_):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])
    with pytest.raises(ValueError, match="numeric"):
        E.encoding_maps(df, ["y", "c"], {}, "work_places", 10, 2.0, [("y", "c")])
