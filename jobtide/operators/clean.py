"""Row-level preparation steps (SRC-02/05, PRJ-01/04/05/06/08, FLT-01..05/12, FN-01/08/11).

Each step is a ``DataFrame -> DataFrame`` function, so a pipeline is a chain
of ``df.transform(step)``. Optional columns are handled at plan time: a step
whose input column is absent is skipped (PRJ-08).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import TITLE_LOOKALIKES
from ..functions.scalar import (DATE_FORMATS, DATE_PARTS, UNKNOWN, date_parts, null_markers, parse_timestamp,
                                parse_weight, unflag, whole_days)


def check_title(columns: list[str]) -> None:
    """SRC-02: the raw table must have ``title``; otherwise name look-alikes."""
    if "title" in columns:
        return
    similar = [c for c in columns if any(w in c.lower() for w in TITLE_LOOKALIKES)]
    hint = f"; similar columns: {similar}" if similar else ""
    raise ValueError(f"column 'title' not found{hint}")


def check_required(columns: list[str], required) -> None:
    """SRC-06: required columns of the prepared table."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def drop_denied(df: DataFrame, names) -> DataFrame:
    """PRJ-01: ``drop`` ignores names that are absent."""
    return df.drop(*names)


def mark_nulls(df: DataFrame) -> DataFrame:
    """SRC-05 on every string column."""
    return df.select(*[null_markers(f.name).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f.name) for f in df.schema.fields])


def title_matches(keyword: str, col: str = "title") -> Column:
    return F.lower(F.col(col)).contains(keyword.lower())


def keep_titles(df: DataFrame, keyword: str | None, col: str = "title") -> DataFrame:
    """FLT-01 (+FN-02): title contains the keyword, any case (Unicode lower)."""
    return df.filter(title_matches(keyword, col)) if keyword else df


def weights(df: DataFrame, col: str = "work_places") -> DataFrame:
    """FN-01 in place."""
    return df.withColumn(col, parse_weight(col))


def dates(df: DataFrame, date_columns, formats=DATE_FORMATS) -> DataFrame:
    """FN-08 + FLT-12 + FN-11: ``{d}_processed`` and its parts, for present columns.
    ``formats`` are one tuple for all, or a tuple per column."""
    cols = set(df.columns)
    for d, flag in date_columns:
        if d not in cols:
            continue
        own = formats.get(d, DATE_FORMATS) if isinstance(formats, dict) else formats
        ts = parse_timestamp(unflag(d, flag if flag in cols else None), own)
        df = df.withColumn(f"{d}_processed", ts)
        df = df.select("*", *date_parts(f"{d}_processed", d))
    return df


def reread_dates(df: DataFrame, date_columns, infer) -> DataFrame:
    """:func:`dates` again for the texts that it could not read without formats, by those that
    ``infer(df, columns)`` finds for the columns that hold such texts; other columns are left as they are.
    Text without a digit fits no form, and a failed reading is dear, so it is not tried."""
    flags = {d: flag if flag in df.columns else None for d, flag in date_columns if f"{d}_processed" in df.columns}
    if not flags:
        return df
    left = {d: F.when(F.col(d).cast("string").rlike("[0-9]"), unflag(d, flag)) for d, flag in flags.items()}
    unread = [F.bool_or(left[d].isNotNull() & F.col(f"{d}_processed").isNull()) for d in flags]
    found = df.agg(*unread).first()
    columns = [d for d, some in zip(flags, found) if some]
    for d, formats in (infer(df, columns) if columns else {}).items():
        if formats:
            read = f"{d}_processed"
            df = df.withColumn(read, parse_timestamp(left[d], formats, year_first=F.col(read)))
            parts = date_parts(read, d)
            df = df.withColumns(dict(zip([f"{d}_{p}" for p in DATE_PARTS], parts)))
    return df


def fill_unknown(df: DataFrame, features) -> DataFrame:
    """FN-06 in place on present text columns."""
    cols = set(df.columns)
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c)
                       if c in features and c in cols else F.col(c) for c in df.columns])


def span_end(df: DataFrame, default_days: int = 77,
             lo_days: int = 1, hi_days: int = 365) -> DataFrame:
    """PRJ-04 + PRJ-05: end = inactivation, else last update, else start + 77 days;
    duration in whole days, null → 77, clipped to 1..365."""
    cols = set(df.columns)
    start = F.col("date_creation_processed")
    ends = [F.col(c) for c in ("date_inactivation_processed", "date_last_updated_processed")
            if c in cols]
    fallback = start + F.expr(f"INTERVAL {int(default_days)} DAYS")
    df = df.withColumn("date_end", F.coalesce(*ends, fallback))
    dur = F.coalesce(whole_days("date_end", start), F.lit(default_days).cast("bigint"))
    return df.withColumn("vacancy_duration",
                         F.least(F.greatest(dur, F.lit(lo_days)), F.lit(hi_days)).cast("int"))


def validity(df: DataFrame, date_lo: str, date_hi: str) -> dict[str, Column]:
    """FLT-02..05, in order: creation known; end ≥ creation; industry known;
    creation within [lo, hi] (the upper bound compares at midnight)."""
    start = F.col("date_creation_processed")
    out = {"date_kept": start.isNotNull(), "order_kept": F.col("date_end") >= start}
    if "industry" in df.columns:
        out["industry_kept"] = F.coalesce(F.col("industry"), F.lit(UNKNOWN)) != UNKNOWN
    out["window_kept"] = start.between(F.to_timestamp(F.lit(date_lo)), F.to_timestamp(F.lit(date_hi)))
    return out


def keep_valid(df: DataFrame, date_lo: str, date_hi: str) -> DataFrame:
    for keep in validity(df, date_lo, date_hi).values():
        df = df.filter(keep)
    return df


def kept_counts(df: DataFrame, date_lo: str, date_hi: str) -> list[Column]:
    """AGG-24: rows that pass each of these filters and all before it."""
    out, so_far = [], F.lit(True)
    for name, keep in validity(df, date_lo, date_hi).items():
        so_far = so_far & keep
        out.append(F.count_if(so_far).alias(name))
    return out


def coerce_types(df: DataFrame) -> DataFrame:
    """PRJ-06: two timestamps; weight numeric, null → 1."""
    return (df.withColumn("date_creation_processed", F.col("date_creation_processed").cast("timestamp"))
            .withColumn("date_end", F.col("date_end").cast("timestamp"))
            .withColumn("work_places", F.coalesce(F.col("work_places").try_cast("bigint"),
                                                  F.lit(1).cast("bigint"))))
