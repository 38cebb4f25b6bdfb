"""Vacancy-shaped views over the test tables.

The forecasting operators work on any *spans* table
``(id, grp, start_ts, end_ts, weight)``. Over the TPC-H-like tables an
order is a vacancy: it opens at ``o_orderdate``, closes at its last
shipment, weighs the quantity ordered, and its industry is the customer's
market segment.

``raw_vacancies`` goes one step further and renders the same rows as the
all-string table the preparation stage expects, so the whole preparation
path (weight text, date text with mistake flags, categories, numbers) runs
on data that grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

SPAN_COLS = ("id", "grp", "start_ts", "end_ts", "weight")


def _lines_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: last shipment, quantity, line count, lowest part key.

    Aggregated by ``l_orderkey`` so the later join with ``orders`` on the
    same key reuses this hash partitioning.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey",
               "l_quantity", "l_shipdate")
    return li.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_shipdate").alias("first_ship"),
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("n_lines"),
        F.min("l_partkey").alias("first_part"),
    )


def order_spans(spark: SparkSession, sf_dir: str, end_after_start: bool = True,
                group: str = "segment") -> DataFrame:
    """Spans from orders: (id, grp, start_ts, end_ts, weight).

    end = last shipment, else order date + 77 days; weight = total quantity
    (BIGINT), 1 when the order has no lines. ``end_after_start`` applies the
    preparation filter end >= start. ``group`` is the customer's market
    segment (5 groups) or nation (25 groups).
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    li = _lines_per_order(spark, sf_dir).select("l_orderkey", "last_ship", "qty")
    df = (orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
          .join(cust, orders.o_custkey == cust.c_custkey, "left"))
    if group == "nation":
        nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
        df = df.join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        grp = F.col("n_name")
    else:
        grp = F.col("c_mktsegment")
    spans = df.select(
        F.col("o_orderkey").alias("id"),
        grp.alias("grp"),
        F.col("o_orderdate").alias("start_ts"),
        F.coalesce(F.col("last_ship"),
                   F.col("o_orderdate") + F.expr("INTERVAL 77 DAYS")).alias("end_ts"),
        F.coalesce(F.col("qty").cast("bigint"), F.lit(1).cast("bigint")).alias("weight"),
    )
    if end_after_start:
        spans = spans.filter(F.col("end_ts") >= F.col("start_ts"))
    return spans


def raw_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string vacancy rows derived from orders, lines, parts, customers, nations.

    Column meaning follows the vacancy schema; every value comes from the
    tables, rendered in the text forms the parsers must handle.
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_totalprice", "o_orderdate", "o_orderpriority")
    li = _lines_per_order(spark, sf_dir)
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                 "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    df = (orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
          .join(cust, orders.o_custkey == cust.c_custkey, "left")
          .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
          .join(part, F.col("first_part") == part.p_partkey, "left"))
    qty = F.coalesce(F.col("qty"), F.lit(0.0)).cast("bigint")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    # Weight text in the forms seen in vacancy data; the form is chosen by
    # the order key, the numbers come from the order's quantity.
    form = F.pmod(F.col("o_orderkey"), F.lit(10))
    work_places = (
        F.when(form == 0, qty.cast("string"))
        .when(form == 1, F.concat(F.lit("от "), (qty % 7 + 1).cast("string"), F.lit(" до "),
                                  (qty % 11 + 8).cast("string")))
        .when(form == 2, F.concat(F.lit("от "), (qty % 20).cast("string")))
        .when(form == 3, F.concat(F.lit("до "), (qty % 9 + 1).cast("string")))
        .when(form == 4, F.lit(None).cast("string"))
        .when(form == 5, F.concat((qty % 6).cast("string"), F.lit(".9")))
        .when(form == 6, F.lit("abc"))
        .when(form == 7, (qty * 400).cast("string"))
        .when(form == 8, F.concat(F.lit("-"), (qty % 3).cast("string")))
        .otherwise(F.concat(F.lit(" "), (qty % 5 + 1).cast("string"), F.lit("e1 "))))
    status = F.col("o_orderstatus")
    return df.select(
        F.col("o_orderkey").cast("string").alias("vacancy_id"),
        F.col("p_name").alias("title"),
        work_places.alias("work_places"),
        # Negative balances stand for an unknown industry.
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("industry"),
        day("o_orderdate").alias("date_creation"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (status == "P"), F.lit("1"))
         .otherwise(F.lit("0")).alias("date_creation_mistake"),
        day("first_ship").alias("date_posted"),
        F.lit("0").alias("date_posted_mistake"),
        F.when(status != "O", day("last_ship")).alias("date_inactivation"),
        F.when(status == "O", day("last_ship")).alias("date_last_updated"),
        day("o_orderdate").alias("date_modify_inner_info"),
        F.lit("0").alias("date_modify_inner_info_mistake"),
        F.col("o_orderpriority").alias("employment_type"),
        status.alias("education_requirements_education_type"),
        F.col("n_name").alias("region"),
        F.col("p_type").alias("profession"),
        F.col("c_name").alias("organization"),
        F.col("o_totalprice").cast("string").alias("base_salary_min"),
        F.col("c_acctbal").cast("string").alias("base_salary_max"),
        F.col("n_lines").cast("string").alias("experience_requirements"),
        F.lit("x").alias("vac_url"),
        F.lit("y").alias("federal_district"),
    )
