"""Model features of a series (TS-08: WIN-01..03, FN-13), for all
series at once, each computed by windows partitioned by series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import calendar_features
from .series import fill_edges

# Lags, window lengths and feature order of the source system's models.
LAGS = (1, 2, 3, 4, 8, 12)
MA_WINDOWS = (3, 6, 12)
FEATURES = ("month", "quarter", "year", "day_of_year", "is_quarter_end", "is_year_end",
            "lag_1", "lag_2", "lag_3", "lag_4", "lag_8", "lag_12",
            "ma_3", "ma_6", "ma_12", "diff_1", "diff_4")


def make_features(series: DataFrame, leak_free: bool = False) -> DataFrame:
    """``(series, period, y, <FEATURES>, pos, n)``.

    Faithful mode: lags missing → 0; trailing means over *full* windows
    shifted by one, otherwise the whole-series mean (Q6); differences of
    order 1 and 4 *not* shifted (Q5). ``leak_free`` shifts the differences
    by one and uses the expanding mean of past values instead.
    """
    df = fill_edges(series.select("series", "period", "value")).withColumnRenamed("value", "y")
    w = Window.partitionBy("series").orderBy("period")
    whole = Window.partitionBy("series")
    y = F.col("y")
    cols = [*calendar_features("period")]
    cols += [F.coalesce(F.lag(y, k).over(w), F.lit(0.0)).alias(f"lag_{k}") for k in LAGS]
    for k in MA_WINDOWS:
        frame = w.rowsBetween(-k, -1)
        full = F.count(y).over(frame) == k
        if leak_free:
            fallback = F.coalesce(F.avg(y).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0.0))
        else:
            fallback = F.avg(y).over(whole)
        cols.append(F.when(full, F.avg(y).over(frame)).otherwise(fallback).alias(f"ma_{k}"))
    base = F.lag(y, 1).over(w) if leak_free else y
    for k, name in ((1, "diff_1"), (4, "diff_4")):
        shift = k + 1 if leak_free else k
        cols.append(F.coalesce(base - F.lag(y, shift).over(w), F.lit(0.0)).alias(name))
    return df.select("series", "period", "y", *cols,
                     F.row_number().over(w).alias("pos"),
                     F.count(F.lit(1)).over(whole).alias("n"))
