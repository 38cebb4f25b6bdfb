"""Sources and preparation on hand-made rows (FIXTURES.md F1)."""

import os

import pytest
from pyspark.sql import functions as F

from jobtide.config import PrepConfig
from jobtide.operators.encode import target_encode
from jobtide.plans.prepare import prepare
from jobtide.sources.vacancies import read_prepared_csv, read_raw

HEADER = ("title;work_places;industry;date_creation;date_creation_mistake;date_inactivation;"
          "date_last_updated;region;base_salary_min;vac_url")
ROWS = [
    'Инженер-конструктор;от 3 до 8;IT;2019-03-01;0;2019-05-01;;Москва;50000;u1',
    'ведущий ИНЖЕНЕР;5;IT;2019-04-01;0;;2019-06-15;Москва;60000;u2',
    'инженер;"от 4";Build;2019-05-01;1;2019-06-01;;"Санкт; Петербург";70000;u3',
    '"Инженер ""А""";abc;;2019-06-01;0;;;Казань;;u4',
    'Бухгалтер;3;IT;2019-04-01;0;;;Москва;55000;u5',
    'Инженер;2;Build',
    'Инженер;7;Build;2019-07-01;0;2019-06-01;;Казань;80000;u7;extra;fields',
]


def _write(tmp, name, lines):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_raw_scan_ragged_rows(spark, tmpdir_path):
    p = _write(tmpdir_path, "raw.csv", [HEADER] + ROWS)
    df = read_raw(spark, p)
    rows = df.collect()
    assert len(rows) == 7
    short = [r for r in rows if r["title"] == "Инженер" and r["work_places"] == "2"][0]
    assert short["date_creation"] is None            # padded
    long_ = [r for r in rows if r["work_places"] == "7"][0]
    assert long_["vac_url"] == "u7"                  # extra fields cut
    quoted = [r for r in rows if r["region"] and ";" in r["region"]]
    assert quoted and quoted[0]["region"] == "Санкт; Петербург"
    assert any(r["title"] == 'Инженер "А"' for r in rows)


def test_missing_title_is_reported(spark, tmpdir_path):
    p = _write(tmpdir_path, "bad.csv", ["название вакансии;work_places", "x;1"])
    with pytest.raises(ValueError, match="название"):
        read_raw(spark, p)


def test_multiline_field(spark, tmpdir_path):
    p = _write(tmpdir_path, "ml.csv", [HEADER, 'инженер "по\nлиниям";1;IT;2019-03-01;0;;;М;1;u'])
    p2 = _write(tmpdir_path, "ml2.csv", [HEADER, '"инженер по\nлиниям";1;IT;2019-03-01;0;;;М;1;u'])
    rows = read_raw(spark, p2, multiline=True).collect()
    assert len(rows) == 1 and "\n" in rows[0]["title"]
    assert os.path.exists(p)


def test_line_breaks_and_date_formats_reach_every_path(spark, tmpdir_path):
    from jobtide.plans.pipeline import prepare_vacancies
    from jobtide.sources.vacancies import read_prepared
    from jobtide.streaming.ingest import ingest_available
    names = "title;work_places;industry;date_creation;region"
    rows = ['"инженер по\nлиниям";2;IT;2019/03/01;"М\nО"', "инженер;3;IT;2019-03-02;М"]
    src = f"{tmpdir_path}/in"
    os.mkdir(src)
    _write(src, "ml.csv", [names, *rows])
    cfg = PrepConfig(date_formats=("yyyy-MM-dd", "yyyy/MM/dd"), min_samples=1)
    out = f"{tmpdir_path}/prepared"
    prepare_vacancies(spark, src, out, cfg=cfg, fmt="csv")
    assert sorted(r["work_places"] for r in read_prepared(spark, out, "csv").collect()) == [2, 3]
    got = ingest_available(spark, src, f"{tmpdir_path}/sink", f"{tmpdir_path}/ck", cfg).collect()
    assert sorted((r["title"], r["work_places"]) for r in got) == [("инженер", 3), ("инженер по\nлиниям", 2)]


def test_prepared_scan_skips_long_rows(spark, tmpdir_path):
    lines = ["date_creation_processed;date_end;work_places;industry",
             "2019-01-01;2019-02-01;3;IT", "2019-01-01;2019-02-01;3", "2019-01-01;2019-02-01;3;IT;x"]
    df = read_prepared_csv(spark, _write(tmpdir_path, "prep.csv", lines))
    assert df.count() == 2


def test_prepare_fixture(spark, tmpdir_path):
    p = _write(tmpdir_path, "raw.csv", [HEADER] + ROWS)
    cfg = PrepConfig(date_lo="2019-01-01", date_hi="2019-12-31")
    out = prepare(read_raw(spark, p), cfg)
    rows = {r["title"]: r for r in out.collect()}
    assert "Бухгалтер" not in rows                    # title filter
    assert "vac_url" not in out.columns               # deny list
    r = rows["Инженер-конструктор"]
    assert r["work_places"] == 5 and r["vacancy_duration"] == 61
    r2 = rows["ведущий ИНЖЕНЕР"]
    assert str(r2["date_end"].date()) == "2019-06-15"  # last update when no inactivation
    # flagged creation date → null → dropped; unknown industry dropped; end < start dropped
    assert "инженер" not in rows and 'Инженер "А"' not in rows
    assert all(r["work_places"] != 7 for r in rows.values())
    enc = [c for c in out.columns if c.endswith("_encoded")]
    assert "industry_encoded" in enc and "base_salary_min_encoded" in enc


def test_target_encoding_smoothing(spark):
    rows = [("a", 10.0)] * 12 + [("b", 1.0)] * 2
    df = spark.createDataFrame(rows, "cat string, work_places double")
    g = (12 * 10 + 2 * 1) / 14
    out = {r["cat"]: r["cat_encoded"] for r in target_encode(df, ["cat"]).distinct().collect()}
    assert abs(out["a"] - 10.0) < 1e-12
    assert abs(out["b"] - (1.0 * 2 + g * 10) / 12) < 1e-12
    lo, hi = 1.0, 10.0
    assert all(lo <= v <= hi for v in out.values())
