"""Delimited sources: columns by name, line breaks in quoted fields, types, null markers (SRC-01..06, SRC-08, PRJ-06)."""

import csv
import datetime as dt
import io
import os
import random

import pytest

from jobtide.config import PrepConfig
from jobtide.sources import delimited as D
from jobtide.sources.vacancies import infer_types, read_extract, read_prepared, read_raw, read_results
from jobtide.streaming.ingest import ingest_available


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return os.path.join(folder, name)


def _csv(header, rows, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, delimiter=";", lineterminator=end)
    w.writerow(header)
    w.writerows(rows)
    return out.getvalue()


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_columns_are_matched_by_name(spark, tmpdir_path):
    _put(tmpdir_path, "a.csv", _csv(["title", "industry", "work_places"], [["инженер", "IT", "7"]]))
    _put(tmpdir_path, "b.csv", "﻿" + _csv(["title", "work_places", "industry"], [["инженер 2", "8", "HR"], ["инженер 3", "9", "a\nb"]]))
    _put(tmpdir_path, "empty.csv", "")
    got = _rows(read_raw(spark, tmpdir_path), "title", "industry", "work_places")
    assert got == [("инженер", "IT", "7"), ("инженер 2", "HR", "8"), ("инженер 3", "a\nb", "9")]
    _put(tmpdir_path, "c.csv", _csv(["title", "work_places", "branch"], [["x", "1", "y"]]))
    with pytest.raises(ValueError, match="branch"):
        read_raw(spark, tmpdir_path)
    both = D.read_by_name(spark, tmpdir_path, allow_missing=True)
    assert both.columns == ["title", "industry", "work_places", "branch"] and both.count() == 4


def test_without_the_survey_another_header_fails(spark, tmpdir_path):
    _put(tmpdir_path, "a.csv", _csv(["title", "industry"], [["инженер", "IT"]]))
    _put(tmpdir_path, "b.csv", _csv(["industry", "title"], [["IT", "инженер"]]))
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, tmpdir_path, multiline=False).collect()


def test_names_of_odd_headers():
    assert D.header_names('"a ""b""";;c;C\r') == ('a "b"', "_c1", "c2", "C3")
    assert D.header_names('"a\nb";c') == ("a\nb", "c")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_line_ends_and_splits(spark, tmpdir_path, small_splits, end):
    rng = random.Random(3)
    parts = ["word", '"', ";", "\n", "\n\n", "é中", " ", "", "\r", "x;\"y\"\nz"]
    rows = [[str(i), "".join(rng.choices(parts, k=rng.randint(0, 8))), "t" + "".join(rng.choices(["a", "\n", '""'], k=4)) + "t", "end"] for i in range(800)]
    rows += [["800", "long " + "line\n" * 4000, "t", "end"]]            # one record over several splits
    path = _put(tmpdir_path, "in.csv", _csv(["id", "title", "b", "c"], rows, end))
    df = read_raw(spark, path)
    assert [f.crosses for f in D.survey(spark, path)] == [True]
    assert D._lines(spark, [path]).rdd.getNumPartitions() >= 8
    same = lambda s: (s or "").replace("\r\n", "\n").replace("\r", "\n").strip()  # noqa: E731  the CSV parser trims and normalises
    got = sorted((int(r["id"]), same(r["title"]), same(r["b"]), r["c"]) for r in df.collect())
    assert got == [(int(i), same(t), same(b), c) for i, t, b, c in rows]


def test_files_without_breaks_stay_split(spark, tmpdir_path, small_splits):
    rows = [[str(i), f"инженер {i}", "x" * 20] for i in range(400)]
    path = _put(tmpdir_path, "plain.csv", _csv(["id", "title", "c"], rows))
    df = read_raw(spark, path)
    assert os.path.getsize(path) > 3 * 4096 and df.rdd.getNumPartitions() >= 4
    assert _rows(df, "id", "title", "c") == sorted(tuple(r) for r in rows)


def test_ragged_rows_in_both_kinds_of_files(spark, tmpdir_path):
    body = ["title;a;b", "инженер;1", "инженер;1;2;3", "", '"ин;""жен""ер";1;2']
    _put(tmpdir_path, "a.csv", "\n".join(body) + "\n")
    _put(tmpdir_path, "b.csv", "\n".join([*body, '"x\ny";5']) + "\n")
    one = [('ин;"жен"ер', "1", "2"), ("инженер", "1", "2"), ("инженер", "1", None)]
    got = [tuple(r) for r in read_raw(spark, tmpdir_path).collect()]
    assert sorted(got, key=repr) == sorted(one * 2 + [("x\ny", "5", None)], key=repr)
    kept = [tuple(r) for r in D.read_by_name(spark, tmpdir_path, skip_long=True).collect()]
    assert len(kept) == 5 and ("инженер", "1", "2") not in kept


def test_types_are_the_narrowest_that_all_files_fit(spark, tmpdir_path):
    names = ["i", "d", "t", "b", "e", "mixed", "big"]
    _put(tmpdir_path, "a.csv", _csv(names, [["1", "2", "NaN", "True", "NA", "true", "1"], ["-5", "", "x", "false", "", "", "2"]]))
    _put(tmpdir_path, "b.csv", _csv(names[::-1], [["9" * 25, "3", "null", "", "7", "2.5", "08"]]))
    df = read_extract(spark, tmpdir_path)
    assert dict(df.dtypes) == {"i": "bigint", "d": "double", "t": "string", "b": "boolean", "e": "double", "mixed": "string", "big": "double"}
    assert sorted(r["i"] for r in df.collect()) == [-5, 1, 8]
    assert infer_types(df.select("t").limit(0)) == {"t": "double"}


def test_prepared_file_with_markers_and_odd_weights(spark, tmpdir_path):
    names = ["date_creation_processed", "date_end", "work_places", "industry"]
    rows = [["2019-01-01", "2019-02-01 10:00:00", w, g] for w, g in
            [("NaN", "IT"), ("2.5", "NA"), ("inf", "IT"), ("abc", "HR"), ("1e400", "IT"), ("3", ""), ("", "null")]]
    path = _put(tmpdir_path, "p.csv", _csv(names, rows) + "2019-01-01;2019-02-01;4;IT;more\n2019-01-01;bad\n")
    got = sorted(((r["work_places"], r["industry"], r["date_end"]) for r in read_prepared(spark, path, "csv").collect()), key=repr)
    end = dt.datetime(2019, 2, 1, 10)
    assert got == sorted([(1.0, "IT", end), (2.5, None, end), (1.0, "IT", end), (1.0, "HR", end), (1.0, "IT", end), (3.0, None, end), (1.0, None, end), (1.0, None, None)], key=repr)
    whole = _put(tmpdir_path, "w.csv", _csv(names, [["2019-01-01", "2019-02-01", w, "IT"] for w in ("3", "", "NaN")]))
    df = read_prepared(spark, whole, "csv")
    assert dict(df.dtypes)["work_places"] == "bigint" and sorted(r["work_places"] for r in df.collect()) == [1, 1, 3]
    path = os.path.join(tmpdir_path, "parquet")
    df.selectExpr("date_creation_processed", "date_end", "cast('nan' as double) work_places", "'NaN' industry").write.parquet(path)
    assert {(r["work_places"], r["industry"]) for r in read_prepared(spark, path).collect()} == {(1.0, None)}


def test_extract_without_title(spark, tmpdir_path):
    from jobtide.plans.pipeline import prepare_vacancies
    path = _put(tmpdir_path, "x.csv", _csv(["industry", "work_places", "date_creation", "extra", "base_salary_min"],
                [["IT", "от 2 до 4", "2019-03-01", "5", "10"], ["HR", "7", "2019-03-02T10:00:00+0300", "NA", "x"], ["HR", "7", "", "6", "1"]]) + "IT;1;2019-01-01;1;1;1\n")
    out = prepare_vacancies(spark, path, raw=False)
    assert dict(out.dtypes)["extra"] == "bigint"
    assert _rows(out, "industry", "work_places") == [("HR", 7), ("IT", 3)]
    with pytest.raises(ValueError, match="title"):
        prepare_vacancies(spark, path)


def test_ingest_matches_names_per_file_and_refuses_unknown_ones(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    _put(src, "a.csv", _csv(["title", "industry", "work_places", "date_creation"], [["инженер 1", "IT", "7", "2019-03-01"]]))
    _put(src, "b.csv", _csv(["date_creation", "work_places", "industry", "title"], [["2019-03-02", "8", "IT\nHR", "инженер 2"]]))
    run = lambda: ingest_available(spark, src, os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck"), PrepConfig())
    assert _rows(run(), "title", "work_places", "industry") == [("инженер 1", 7, "IT"), ("инженер 2", 8, "IT\nHR")]
    _put(src, "c.csv", _csv(["title", "work_places", "industry", "date_creation"], [["инженер 3", "9", "IT", "2019-03-03"]]))
    assert len(run().collect()) == 3
    _put(src, "d.csv", _csv(["name", "work_places"], [["инженер 4", "1"]]))
    with pytest.raises(Exception, match="title"):
        run()


def test_only_absent_results_are_left_out(spark, tmpdir_path):
    assert read_results(spark, tmpdir_path) == {}
    _put(os.path.join(tmpdir_path, "metrics"), "x.parquet", "not parquet")
    with pytest.raises(Exception, match="(?i)parquet|read|file"):
        read_results(spark, tmpdir_path)["metrics"].collect()


def test_the_survey_is_one_job_over_all_splits(spark, tmpdir_path, small_splits):
    path = _put(tmpdir_path, "in.csv", _csv(["id", "title"], [[str(i), "x\ny" * 9] for i in range(900)]))
    assert D._lines(spark, [path]).rdd.getNumPartitions() >= 4
    spark.sparkContext.setJobGroup("survey-once", "")
    try:
        assert [f.crosses for f in D.survey(spark, path)] == [True]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("survey-once")) == 1


def test_only_the_wanted_kinds_of_records_are_assembled():
    lines = ["id;t", 'a;"x', "y", '";z', "plain;1", 'b;"open', "still"]
    batch = D.pa.RecordBatch.from_arrays([D.pa.array(["f"] * 7), D.pa.array([0] * 7, D.pa.int64()), D.pa.array(lines)], names=["file", "start", "value"])
    made = lambda kinds, quoted=False: [(r["kind"], r["text"]) for b in D._assemble({("f", 0): quoted}, kinds)(iter([batch])) for r in b.to_pylist()]
    assert made(("record",)) == [("record", 'a;"x\ny\n";z'), ("record", "plain;1")]
    assert made(("head", "tail")) == [("tail", 'b;"open\nstill')]
    assert made(("head", "tail"), True)[0] == ("head", 'id;t\na;"x')
