"""Vacancy files (SRC-01..SRC-07).

Raw files: ``;``-separated UTF-8 text with a header row, quoted fields with
doubled quotes, every value read as text, columns matched by name. Prepared
files and filtered extracts also get null markers and inferred types.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import REQUIRED_FOR_FORECAST
from ..functions.scalar import is_decimal, parse_timestamp, to_number
from ..operators.clean import check_required, check_title, mark_nulls
from .delimited import CSV_OPTIONS, EXTRA, all_string_schema, read_by_name

# Kinds of text a column was seen to hold, as bits.
INTEGER, DECIMAL, BOOLEAN, TEXT = 1, 2, 4, 8


def header_of(spark: SparkSession, path: str, sep: str = ";") -> list[str]:
    """Column names from one file's header line only (no data pass)."""
    return spark.read.options(**{**CSV_OPTIONS, "sep": sep}).csv(path).columns


def _read_lines(spark: SparkSession, path, skip_long: bool, check) -> DataFrame:
    """One record a line, all headers alike; a file with another header fails the job."""
    names = header_of(spark, path)
    check(names)
    df = (spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false" if not skip_long else "true")
          .schema(all_string_schema(names, extra=skip_long)).csv(path))
    return df.filter(F.col(EXTRA).isNull()).drop(EXTRA) if skip_long else df


def read_raw(spark: SparkSession, path, multiline: bool = True, check: bool = True) -> DataFrame:
    """SRC-01 + SRC-03: every field as text; short rows padded with null, extra fields cut.
    SRC-02: ``title`` must exist.

    Columns are matched by name over files of any column order, and quoted fields may go over
    line ends; that takes one more pass over the lines. With ``multiline`` off there is no such
    pass, all files must have the first one's header, and rows with line breaks are broken.
    """
    checker = check_title if check else lambda names: None
    if multiline:
        return read_by_name(spark, path, check=checker)
    return _read_lines(spark, path, False, checker)


# --- types of text columns (SRC-04) ---------------------------------------------------

def _kind(c: str) -> Column:
    x = F.trim(F.col(f"`{c}`"))
    return (F.when(x.isNull(), 0).when(x.rlike(r"^[+-]?[0-9]+$") & x.try_cast("bigint").isNotNull(), INTEGER)
            .when(is_decimal(x), DECIMAL).when(F.lower(x).isin("true", "false"), BOOLEAN).otherwise(TEXT))


def _type_of(kinds: int) -> str:
    if kinds & TEXT or kinds & BOOLEAN and kinds & (INTEGER | DECIMAL):
        return "string"
    if kinds & BOOLEAN:
        return "boolean"
    return "bigint" if kinds == INTEGER else "double"


def infer_types(df: DataFrame, columns=None) -> dict[str, str]:
    """SRC-04: type of every text column over all rows, in one aggregate.

    bigint < double < text; boolean where all values are; a column without values is double.
    """
    columns = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"] if columns is None else list(columns)
    if not columns:
        return {}
    row = df.agg(*[F.coalesce(F.bit_or(_kind(c)), F.lit(0)).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    return {c: _type_of(row[i]) for i, c in enumerate(columns)}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as their inferred types."""
    def cast(c: str) -> Column:
        kind = types.get(c, "string")
        x = F.col(f"`{c}`")
        return x if kind == "string" else (to_number(x) if kind == "double" else F.trim(x).try_cast(kind)).alias(c)
    return df.select(*[cast(c) for c in df.columns])


# --- prepared files and filtered extracts ----------------------------------------------

def read_extract(spark: SparkSession, path, multiline: bool = True, infer: bool = True,
                 required=()) -> DataFrame:
    """SRC-04 + SRC-05: an already filtered or prepared delimited file.

    Rows with *more* fields than the header are left out, short rows kept, null
    markers become null, and with ``infer`` columns get the type that all their values fit.
    """
    def check(names):
        check_required(names, required)
    df = read_by_name(spark, path, skip_long=True, check=check) if multiline else _read_lines(spark, path, True, check)
    df = mark_nulls(df)
    return typed(df, infer_types(df)) if infer else df


def read_prepared_csv(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """SRC-04 + SRC-06: a prepared file as text; the four forecasting columns must be present."""
    return read_extract(spark, path, multiline, infer=False, required=REQUIRED_FOR_FORECAST)


def read_prepared(spark: SparkSession, path, fmt: str = "parquet", multiline: bool = True) -> DataFrame:
    """SRC-06 + SRC-05 + PRJ-06 on the four forecasting columns.

    Null markers are null; dates as timestamps, unreadable ones null; weights as numbers, whole
    if all of them are, else doubles; missing, unreadable and infinite weights are 1.
    """
    df = read_prepared_csv(spark, path, multiline) if fmt == "csv" else mark_nulls(spark.read.parquet(path))
    check_required(df.columns, REQUIRED_FOR_FORECAST)
    kinds = dict(df.dtypes)
    weight, kind = F.col("work_places"), kinds["work_places"]
    if kind == "string":
        kind = infer_types(df, ["work_places"])["work_places"]
        kind = kind if kind == "bigint" else "double"
        weight = weight.try_cast("bigint") if kind == "bigint" else to_number(weight)
    if kind in ("double", "float"):
        weight = F.when(~F.isnan(weight) & (F.abs(weight) != float("inf")), weight.cast("double"))
    elif not kind.startswith("decimal"):
        weight = weight.try_cast("bigint")
    df = df.withColumn("work_places", F.coalesce(weight, F.lit(1)))
    dates = {c: parse_timestamp(c) if kinds[c] == "string" else F.col(c).cast("timestamp")
             for c in ("date_creation_processed", "date_end")}
    return df.withColumns(dates)


def read_results(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """SRC-07: result tables written by :mod:`jobtide.plans.sinks`; tables that were not written are left out."""
    names = ("forecasts", "metrics", "best_models", "summary")
    out = {}
    for n in names:
        try:
            out[n] = spark.read.parquet(f"{folder}/{n}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return out


def union_batches(*frames: DataFrame) -> DataFrame:
    """SET-01: union of separately processed batches, columns matched by name,
    columns absent from a batch filled with null."""
    if not frames:
        raise ValueError("no batches")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
