"""Registered queries of the input paths and the preparation, each with its DuckDB SQL.

Files are rendered from the given tables into the session's scratch folder, in
the odd forms the sources must read: columns in another order, line breaks and
separators inside fields, short and long rows, null markers, mixed date forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import encode as E
from ..operators import report as R
from ..operators.dateforms import infer_date_formats
from ..session import stored
from ..sources import proxy
from ..sources.tables import table
from ..sources.vacancies import infer_types, read_extract, read_prepared, read_raw, union_batches
from . import oracle as O
from .pipeline import prepare_vacancies, scratch_path
from .prepare import PrepLog, prepare

SPAN_COLS = ("vacancy_id", "industry", "date_creation_processed", "date_end", "vacancy_duration",
             "work_places")
CSV = {"sep": ";", "header": "true", "quote": '"', "escape": '"'}


def proxy_prep_config():
    from .queries import proxy_prep_config as cfg
    return cfg()


def _write_lines(line: Column, df: DataFrame, header: str, path: str) -> None:
    """``line`` of every row as it is, below ``header``: rows no CSV writer would write."""
    df.select(line.alias(header)).write.options(sep="\x01", header="true", quote="").csv(path)


# --- SRC-01: files of different column order, some with records over line ends ------------

_MIXED = ("vacancy_id", "title", "work_places", "industry", "region")


def src01_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = stored(proxy.raw_vacancies(spark, sf_dir).select(*_MIXED))       # two kinds of files are written from it
    odd = F.pmod(F.col("vacancy_id").cast("long"), F.lit(2)) == 1
    path = scratch_path(spark, "mixed")
    raw.where(odd).write.options(**CSV).csv(f"{path}/plain")
    broken = F.concat("region", F.lit('\n"'), "vacancy_id", F.lit('";\n'), "region")
    raw.where(~odd).withColumn("region", broken).select(*_MIXED[::-1]).write.options(**CSV).csv(f"{path}/broken")
    return read_raw(spark, [f"{path}/plain", f"{path}/broken"]).select(*_MIXED)


_SRC01 = f"""WITH {O.RAW_CTE}
SELECT vacancy_id, title, trim(work_places) AS work_places, industry,
       CASE WHEN CAST(vacancy_id AS BIGINT) % 2 = 1 THEN region
            ELSE region || chr(10) || '"' || vacancy_id || '";' || chr(10) || region END AS region
FROM raw"""


# --- SRC-03: short and long raw rows ------------------------------------------------------------

def src03_ragged_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    form = F.pmod("c_custkey", F.lit(3))
    line = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", F.when(form != 1, F.col("c_mktsegment")),
                       F.when(form == 2, F.lit("more;and more")))
    path = scratch_path(spark, "ragged")
    _write_lines(line, cust, "vacancy_id;title;industry", path)
    return read_raw(spark, path)


_SRC03 = """SELECT CAST(c_custkey AS VARCHAR) AS vacancy_id, c_name AS title,
       CASE WHEN c_custkey % 3 <> 1 THEN c_mktsegment END AS industry FROM customer"""


# --- SRC-04/05/06, PRJ-06: a prepared file with markers, odd weights and long rows -----------------

def _weight_form() -> Column:
    form = F.pmod("o_orderkey", F.lit(8))
    price = F.format_string("%.2f", F.col("o_totalprice"))
    return (F.when(form == 0, F.lit("NaN")).when(form == 1, price).when(form == 2, F.lit("abc")).when(form == 3, F.lit(""))
            .when(form == 4, F.lit("inf")).otherwise(form.cast("string")))


def _prepared_file(spark: SparkSession, sf_dir: str) -> str:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    key = F.col("o_orderkey")
    group = F.when(F.pmod(key, F.lit(5)) == 0, F.lit("NA")).otherwise(F.col("o_orderpriority"))
    line = F.concat_ws(";", key.cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
                       F.when(F.col("o_orderstatus") == "P", F.lit("never")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
                       _weight_form(), group, F.when(F.col("o_orderstatus") == "O", F.lit("TRUE")).otherwise(F.lit("False")),
                       F.when(F.pmod(key, F.lit(11)) == 0, F.lit("one too many")))
    path = scratch_path(spark, "prepared-csv")
    _write_lines(line, orders, "id;date_creation_processed;date_end;work_places;industry;is_open", path)
    return path


_PREP_CTE = """
f AS (SELECT o_orderkey AS id, o_orderdate AS start, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS stop, o_orderkey % 8 AS form,
             round(o_totalprice, 2) AS price, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS industry, o_orderstatus = 'O' AS is_open
      FROM orders WHERE o_orderkey % 11 <> 0)"""


def src04_prepared_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_prepared(spark, _prepared_file(spark, sf_dir), "csv")
    return df.select("id", "date_creation_processed", "date_end", F.round("work_places", 6).alias("work_places"), "industry")


_SRC04 = f"""WITH {_PREP_CTE}
SELECT CAST(id AS VARCHAR) AS id, CAST(start AS TIMESTAMP) AS date_creation_processed, CAST(stop AS TIMESTAMP) AS date_end,
       CASE WHEN form = 1 THEN price WHEN form IN (5, 6, 7) THEN CAST(form AS DOUBLE) ELSE 1.0 END AS work_places, industry FROM f"""


def src04_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_extract(spark, _prepared_file(spark, sf_dir))
    return df.select("id", "work_places", "industry", "is_open", F.lit(dict(df.dtypes)["work_places"]).alias("weight_type"))


_SRC04_TYPES = f"""WITH {_PREP_CTE}
SELECT id, CASE WHEN form IN (0, 3) THEN NULL WHEN form = 1 THEN printf('%.2f', price) WHEN form = 2 THEN 'abc' WHEN form = 4 THEN 'inf'
                ELSE CAST(form AS VARCHAR) END AS work_places, industry, is_open, 'string' AS weight_type FROM f"""


# --- API-01 on an already filtered extract, without titles -------------------------------------------

def api01_extract_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = C.keep_titles(proxy.raw_vacancies(spark, sf_dir), O.PROXY_KEYWORD).drop("title", "vac_url", "federal_district")
    path = scratch_path(spark, "extract")
    raw.write.options(**CSV).csv(path)
    out = prepare_vacancies(spark, path, raw=False, cfg=proxy_prep_config())
    return out.select(F.col("vacancy_id").cast("string").alias("vacancy_id"), *SPAN_COLS[1:])


# --- FN-08: date forms inferred per column ------------------------------------------------------------

_FORMS = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss'+0300'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'.125'", "yyyy-MM-dd HH:mm",
          "yyyy-M-d", "dd.MM.yyyy HH:mm:ss", "M/d/yyyy h:mm a", "d MMM yyyy", "yyyyMMdd", "'no date'")


def fn08_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    ts = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.pmod(key * 37, F.lit(86400)))
    text = F.when(F.lit(False), F.lit(""))
    for k, form in enumerate(_FORMS):
        text = text.when(F.pmod(key, F.lit(len(_FORMS))) == k, F.date_format(ts, form))
    df = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select(key.alias("id"), text.alias("date_creation"))
    formats = infer_date_formats(df, ["date_creation"])
    out = C.dates(df, (("date_creation", None),), formats)
    return out.select("id", "date_creation_processed", "date_creation_year", "date_creation_month", "date_creation_day_of_year")


_FN08 = """WITH t AS (SELECT o_orderkey AS id, o_orderkey % 11 AS form, CAST(o_orderdate AS TIMESTAMP) + to_seconds((o_orderkey * 37) % 86400) AS ts FROM orders),
d AS (SELECT id, CASE WHEN form IN (0, 5, 8, 9) THEN date_trunc('day', ts) WHEN form = 1 THEN ts - INTERVAL 3 HOUR WHEN form IN (2, 6) THEN ts
                      WHEN form = 3 THEN ts + INTERVAL 125 MILLISECOND WHEN form IN (4, 7) THEN date_trunc('minute', ts) END AS d FROM t)
SELECT id, CAST(d AS TIMESTAMP) AS date_creation_processed, CAST(year(d) AS INTEGER) AS date_creation_year, CAST(month(d) AS INTEGER) AS date_creation_month,
       CAST(dayofyear(d) AS INTEGER) AS date_creation_day_of_year FROM d"""


# --- AGG-24: counts taken while the preparation runs ----------------------------------------------------

def agg24_prepare_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = proxy.raw_vacancies(spark, sf_dir).withColumn(
        "date_posted", F.when(F.pmod(F.col("vacancy_id").cast("long"), F.lit(13)) == 0, F.lit("soon")).otherwise(F.col("date_posted")))
    log = PrepLog()
    prepare(raw, proxy_prep_config(), log=log).write.format("noop").mode("overwrite").save()
    return log.table(spark)


def _agg24_sql() -> str:
    start = "date_creation_processed"
    end = f"coalesce(date_inactivation_processed, date_last_updated_processed, {start} + INTERVAL 77 DAY)"
    tests = {"date_kept": f"{start} IS NOT NULL", "order_kept": f"{end} >= {start}", "industry_kept": "industry <> 'Unknown'",
             "window_kept": f"{start} BETWEEN TIMESTAMP '{O.PROXY_LO}' AND TIMESTAMP '{O.PROXY_HI}'"}
    rows, so_far = ["SELECT 'rows_read' AS step, count(*) AS n FROM raw", "SELECT 'title_kept', count(*) FROM base"], []
    for name, test in tests.items():
        so_far.append(test)
        rows.append(f"SELECT '{name}', count(*) FROM base WHERE {' AND '.join(so_far)}")
    for d, _ in O.DATES:
        rows.append(f"SELECT 'unread_{d}', " + ("count(*) FROM base WHERE CAST(vacancy_id AS BIGINT) % 13 = 0" if d == "date_posted" else "0"))
    return f"""WITH {O.RAW_CTE},{O._base_cte()},
n AS ({" UNION ALL ".join(rows)})
SELECT step, CAST(n AS BIGINT) AS rows, round(100.0 * n / (SELECT n FROM n WHERE step = 'rows_read'), 4) AS pct_of_read FROM n"""


# --- AGG-06: equally wide bins where quantile edges collapse -----------------------------------------------

def agg06_equal_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of which nine in ten values are one: its quantile edges are two, its bins equally wide."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    df = orders.select(F.when(F.pmod("o_orderkey", F.lit(19)) == 0, F.col("o_totalprice")).otherwise(F.lit(1000.0)).alias("x"),
                       F.col("o_totalprice").alias("target"))
    bins = E.fit_numeric_bins(df, ["x"], 10, fence=None, min_edges=3)
    index = E.bin_index(E.numeric_value("x", bins["x"], already_numeric=True), bins["x"])
    return df.groupBy(index.alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("target"), 4).alias("mean"))


_AGG06 = """WITH d AS (SELECT CASE WHEN o_orderkey % 19 = 0 THEN o_totalprice ELSE 1000.0 END AS x, o_totalprice AS target FROM orders),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM d)
SELECT CAST(greatest(len(list_filter(range(0, 11), lambda i: CASE WHEN i = 10 THEN hi ELSE lo + i * (hi - lo) / 10 END < x)) - 1, 0) AS INTEGER) AS bin,
       count(*) AS n, round(avg(target), 4) AS mean FROM d, e GROUP BY 1"""


# --- AGG-08: mergeable distinct counts ----------------------------------------------------------------------

def agg08_distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts from sketches of three batches, against the exact ones and the sketches' error bound."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    cols = ("o_custkey", "o_orderpriority", "o_orderdate")
    batches = [R.distinct_sketches(orders.where(F.pmod("o_orderkey", F.lit(3)) == k), cols) for k in range(3)]
    merged = R.distinct_counts(R.merge_sketches(union_batches(*batches)))
    exact = orders.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cols])))
    exact = exact.groupBy("feature").agg(F.countDistinct("v").alias("exact"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.ceil(4 * R.SKETCH_ERROR * F.col("exact"))
    return exact.join(merged, "feature").select("feature", "exact", near.alias("within_bound"))


_AGG08 = " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS exact, true AS within_bound FROM orders"
                            for c in ("o_custkey", "o_orderpriority", "o_orderdate"))


# --- AGG-16: both salary columns -----------------------------------------------------------------------------

def agg16_salary_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders", "o_custkey", "o_totalprice").join(
        table(spark, sf_dir, "customer", "c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return R.fenced_histograms(df, ["o_totalprice", "c_acctbal"])


def _agg16_sql() -> str:
    parts = []
    for c in ("o_totalprice", "c_acctbal"):
        parts.append(f"""SELECT * FROM (WITH s AS (SELECT {c} FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
q AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM s),
f AS (SELECT {c} FROM s, q WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
{O._hist_sql("f", c, c)})""")
    return "\nUNION ALL\n".join(parts)


# --- SET-01, UDF-04 ----------------------------------------------------------------------------------------------

def set01_union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with different columns: the second one has no priority."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    first = orders.where("o_orderkey % 2 = 0")
    return union_batches(first, orders.where("o_orderkey % 2 <> 0").select("o_orderstatus", "o_orderkey"))


_SET01 = "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders"


def udf04_encode_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice").withColumn("o_totalprice", F.floor("o_totalprice"))
    out = E.process_categorical_feature(df, ["o_custkey"], target="o_totalprice", min_samples=15)
    return out.select("o_orderkey", F.round("o_custkey_encoded", 6).alias("encoded"))


_UDF04 = """WITH o AS (SELECT o_orderkey, o_custkey, CAST(floor(o_totalprice) AS DOUBLE) AS p FROM orders),
g AS (SELECT avg(p) AS g FROM o),
m AS (SELECT o_custkey, avg(p) AS m, count(*) AS n FROM o GROUP BY 1)
SELECT o_orderkey, round(CASE WHEN n < 15 THEN (m * n + g * 15) / (n + 15) ELSE m END, 6) AS encoded FROM o JOIN m USING (o_custkey), g"""


QUERIES = {f.__name__: f for f in (
    src01_mixed_files, src03_ragged_csv, src04_prepared_csv, src04_inferred_types, api01_extract_spans, fn08_dates, agg24_prepare_log,
    agg06_equal_width, agg08_distinct_sketches, agg16_salary_histograms, set01_union_batches, udf04_encode_one)}

ORACLE = {
    "src01_mixed_files": _SRC01, "src03_ragged_csv": _SRC03, "src04_prepared_csv": _SRC04, "src04_inferred_types": _SRC04_TYPES,
    "api01_extract_spans": O.prepared_spans_sql(), "fn08_dates": _FN08, "agg24_prepare_log": _agg24_sql(), "agg06_equal_width": _AGG06,
    "agg08_distinct_sketches": _AGG08, "agg16_salary_histograms": _agg16_sql(), "set01_union_batches": _SET01, "udf04_encode_one": _UDF04,
}
