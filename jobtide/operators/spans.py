"""Interval → demand series (TS-01 and its parts: JOIN-03..06, AGG-11..13, FLT-06..08).

A *span* is a weighted interval ``(grp, start_ts, end_ts, weight)``. A span is
active in every period from the period of its start up to, **not including**,
the period of its end (``end_inclusive=True`` includes it). Periods are
months (``M``, labelled by the month's last day), weeks (``W``, Monday..Sunday,
labelled by the Sunday) or two-week steps (``2W``) on a grid that starts at
the week of the earliest start.

Plan shape, chosen for very large span tables:

1. one pass over the spans: ``groupBy(grp, start_period, end_period)`` with
   map-side partial aggregation. Its size is bounded by
   groups × periods², independent of the row count, and hot groups collapse
   in the map-side combine, so skew cannot pile rows into one task;
2. the calendar bounds are two scalars of that compact table;
3. each compact row becomes two difference events (+w at its first period,
   −w after its last), summed per (series, period) and turned into levels
   by a running sum over a window partitioned by series — no row is
   expanded per period.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

FREQS = ("M", "W", "2W")
TOTAL = "total_demand"
FALLBACK_GROUP = "total"
# A Monday; week indexes count whole weeks from it.
EPOCH_MONDAY = "1970-01-05"


def period_index(ts: Column, freq: str) -> Column:
    """Index of the month (``M``) or Monday-based week (``W``/``2W``) containing ``ts``."""
    if freq == "M":
        return (F.year(ts).cast("long") * 12 + F.month(ts) - 1).cast("long")
    days = F.datediff(F.to_date(ts), F.lit(EPOCH_MONDAY).cast("date"))
    return F.floor(days / 7).cast("long")


def period_start(idx: Column, freq: str) -> Column:
    """First day of the period with index ``idx`` (FN-14)."""
    if freq == "M":
        return F.make_date((idx / 12).cast("int"), (idx % 12 + 1).cast("int"), F.lit(1))
    return F.date_add(F.lit(EPOCH_MONDAY).cast("date"), (idx * 7).cast("int"))


def period_label(idx: Column, freq: str) -> Column:
    """Label of the period: month end, or the Sunday closing the week (FN-15)."""
    if freq == "M":
        return F.last_day(period_start(idx, freq))
    return F.date_add(period_start(idx, freq), 6)


def _check_freq(freq: str) -> None:
    if freq not in FREQS:
        raise ValueError(f"freq must be one of {FREQS}, got {freq!r}")


def compact_spans(spans: DataFrame, freq: str, group_col: str = "grp",
                  start_col: str = "start_ts", end_col: str = "end_ts",
                  weight_col: str = "weight") -> DataFrame:
    """FLT-06 + pre-aggregation: ``(grp, s, e, w, n)`` per group and period pair."""
    _check_freq(freq)
    valid = spans.filter(F.col(start_col).isNotNull() & F.col(end_col).isNotNull())
    return valid.groupBy(
        F.col(group_col).alias("grp"),
        period_index(F.col(start_col), freq).alias("s"),
        period_index(F.col(end_col), freq).alias("e"),
    ).agg(F.sum(F.col(weight_col).cast("double")).alias("w"),
          F.count(F.lit(1)).alias("n"))


def active_groups(compact: DataFrame, min_activity: int) -> DataFrame:
    """FLT-07: groups with at least ``min_activity`` spans (null group never active)."""
    return (compact.filter(F.col("grp").isNotNull())
            .groupBy("grp").agg(F.sum("n").alias("n_spans"))
            .filter(F.col("n_spans") >= min_activity)
            .select("grp"))


@dataclass(frozen=True)
class Calendar:
    """Period grid: ``n`` periods, the first being period index ``g``."""
    freq: str
    g: int
    n: int
    step: int  # period indexes per grid step (2 for 2W)

    def label(self, b: Column) -> Column:
        return period_label(F.lit(self.g) + b * self.step, self.freq)


def _calendar(lo, hi, freq: str, end_inclusive: bool) -> Calendar | None:
    if lo is None:
        return None
    lo, hi = int(lo), int(hi) + (1 if end_inclusive else 0)
    step = 2 if freq == "2W" else 1
    n = max(0, (hi - lo + step - 1) // step)
    return Calendar(freq, lo, n, step)


def _span_buckets(compact: DataFrame, cal: Calendar, end_inclusive: bool,
                  align: str) -> DataFrame:
    """First grid step ``bs`` and the step after the last ``be`` of every compact row."""
    s = F.col("s") - F.lit(cal.g)
    e = F.col("e") - F.lit(cal.g) + F.lit(1 if end_inclusive else 0)
    if cal.step == 1:
        return compact.select("grp", "w", s.alias("bs"), e.alias("be"))
    if align == "span":
        # Each span's own two-week dates start at its own week: only spans an
        # even number of weeks after the grid start ever meet the grid (Q4).
        compact = compact.filter(F.pmod(s, F.lit(2)) == 0)
    elif align != "grid":
        raise ValueError("align must be 'span' or 'grid'")
    return compact.select("grp", "w", F.floor((s + 1) / 2).cast("long").alias("bs"),
                          F.floor((e + 1) / 2).cast("long").alias("be"))


def demand_series(spans: DataFrame, freq: str = "M", min_activity: int = 10,
                  group_col: str | None = "grp", start_col: str = "start_ts",
                  end_col: str = "end_ts", weight_col: str = "weight",
                  end_inclusive: bool = False, align: str = "span",
                  method: str = "events", total_name: str = TOTAL) -> DataFrame:
    """TS-01: long demand table ``(series STRING, period DATE, value DOUBLE)``.

    One series per active group (every period present, missing = 0) plus
    ``total_name`` = sum over the active groups. Without a group column the
    result is the total over all spans. With no active group every span goes
    to the group ``'total'`` (FLT-08).
    """
    _check_freq(freq)
    total_only = group_col is None
    if total_only:
        spans = spans.withColumn("_grp", F.lit(FALLBACK_GROUP))
        group_col = "_grp"
    compact = compact_spans(spans, freq, group_col, start_col, end_col, weight_col)
    compact = cut_lineage(compact)
    # One job for the calendar bounds and the number of active groups.
    per_group = compact.groupBy("grp").agg(F.sum("n").alias("n"), F.min("s").alias("lo"),
                                           F.max("e").alias("hi"))
    row = per_group.agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.count_if(F.col("grp").isNotNull() & (F.col("n") >= min_activity)).alias("n_active"),
    ).first()
    cal = _calendar(row["lo"], row["hi"], freq, end_inclusive)
    spark = spans.sparkSession
    if cal is None or cal.n == 0:
        return spark.createDataFrame([], "series string, period date, value double")

    if group_col == "_grp":
        active = compact.select("grp").distinct()
    elif row["n_active"] > 0:
        active = active_groups(compact, min_activity)
    else:
        compact = compact.withColumn("grp", F.lit(FALLBACK_GROUP))
        active = compact.select("grp").distinct()
    # JOIN-06: only spans of active groups (the active list is tiny).
    act = compact.join(active, "grp", "left_semi")
    buckets = _span_buckets(act, cal, end_inclusive, align).filter(F.col("be") > F.col("bs"))

    if method == "events":
        # JOIN-03 as difference events + running sum (WIN-12).
        ev = buckets.select("grp", F.explode(F.array(
            F.struct(F.col("bs").alias("b"), F.col("w").alias("d")),
            F.struct(F.col("be").alias("b"), (-F.col("w")).alias("d")))).alias("ev"))
        deltas = (ev.select("grp", "ev.b", "ev.d").filter(F.col("b") < cal.n)
                  .groupBy("grp", "b").agg(F.sum("d").alias("d")))
    elif method == "explode":
        # JOIN-03 as one row per active period (UDF-03), for comparison.
        deltas = (buckets.select("grp", "w", F.explode(F.sequence(
            F.col("bs"), F.least(F.col("be"), F.lit(cal.n)) - 1)).alias("b"))
            .groupBy("grp", "b").agg(F.sum("w").alias("d")))
    else:
        raise ValueError("method must be 'events' or 'explode'")

    # JOIN-05: every active series gets every period of the grid.
    grid = active.select("grp", F.explode(F.sequence(F.lit(0), F.lit(cal.n - 1))).alias("b"))
    dense = grid.join(deltas, ["grp", "b"], "left").fillna(0.0, subset=["d"])
    if method == "events":
        w = (Window.partitionBy("grp").orderBy("b")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        level = F.sum("d").over(w)
    else:
        level = F.col("d")
    series = dense.select(F.col("grp").alias("series"), F.col("b"), level.alias("value"))
    # AGG-12: the total is the sum over active series only.
    total = series.groupBy("b").agg(F.sum("value").alias("value")).select(
        F.lit(total_name).alias("series"), "b", "value")
    # AGG-13: without a group column the result is the total alone.
    out = total if total_only else series.unionByName(total)
    return out.select("series", cal.label(F.col("b")).alias("period"),
                      F.col("value").cast("double").alias("value"))


def wide(series_long: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Sink-only pivot to ``period × series`` (JOIN-07 / SNK-03). ``names``
    fixes the pivot columns and avoids an extra distinct pass."""
    return (series_long.groupBy("period").pivot("series", names)
            .agg(F.first("value")).orderBy("period"))
