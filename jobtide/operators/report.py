"""Overview aggregates, top-k and summaries (AGG-07..10, 14..17, 22..29, TOP-01..06).

Every function returns a small DataFrame computed in one aggregation pass
(partial aggregation map-side, so hot keys cost nothing extra). Top-k lists
order by the measure and then by name, so ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import short_label, year_month
from .quantiles import OrderStats, quantiles


def _r(c, n: int = 6):
    return F.round(c, n)


def weight_summary(df: DataFrame, w: str = "work_places") -> DataFrame:
    """AGG-07: mean, median, max, 99th percentile of the weight."""
    median, p99 = quantiles(df, w, [0.5, 0.99])
    return df.agg(_r(F.avg(w)).alias("mean"), _r(F.lit(median).cast("double")).alias("median"),
                  F.max(w).cast("double").alias("max"),
                  _r(F.lit(p99).cast("double")).alias("p99"))


def value_counts(df: DataFrame, c: str, k: int | None = None) -> DataFrame:
    """AGG-09 / TOP-01 / TOP-03: frequency table without nulls, most frequent first."""
    out = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    if k is not None:
        out = out.orderBy(F.desc("count"), F.asc(c)).limit(k)
    return out


def group_stats(df: DataFrame, g: str = "industry", w: str = "work_places") -> DataFrame:
    """AGG-10: per group sum, mean, count of the weight, rounded to 2."""
    return df.groupBy(g).agg(_r(F.sum(w).cast("double"), 2).alias("total"),
                             _r(F.avg(w), 2).alias("mean"),
                             F.count(w).alias("n"))


def top_groups(df: DataFrame, g: str = "industry", w: str = "work_places",
               k_total: int = 20, min_count: int = 10, k_mean: int = 15,
               label_len: int = 25) -> DataFrame:
    """TOP-02 + FLT-10 + FN-05: 20 groups by total weight, then, of those with
    at least 10 rows, 15 by mean weight; labels cut for display."""
    stats = group_stats(df, g, w)
    top = stats.orderBy(F.desc("total"), F.asc(g)).limit(k_total)
    stable = top.filter(F.col("n") >= min_count)
    return (stable.orderBy(F.desc("mean"), F.asc(g)).limit(k_mean)
            .withColumn("label", short_label(g, label_len)))


def monthly_counts(df: DataFrame, ts: str = "date_creation_processed") -> DataFrame:
    """AGG-14: rows per calendar month (labelled by month end), empty months = 0."""
    m = df.filter(F.col(ts).isNotNull()).select(F.last_day(F.col(ts)).alias("month"))
    counts = m.groupBy("month").agg(F.count(F.lit(1)).alias("count"))
    b = m.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    # Calendar of month ends between the bounds: one row, exploded; tiny.
    cal = b.select(F.explode(F.sequence(F.col("lo"), F.col("hi"),
                                        F.expr("INTERVAL 1 MONTH"))).alias("m0"))
    cal = cal.select(F.last_day("m0").alias("month"))
    return cal.join(counts, "month", "left").select(
        "month", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def histogram(df: DataFrame, x, bins: int = 50, name: str = "x") -> DataFrame:
    """AGG-15: equal-width histogram over [min, max] with ``bins`` bins; the
    maximum falls into the last bin; a constant column puts all in bin 0."""
    return histograms(df, {name: x}, bins)


def _grouped_histogram(pairs: DataFrame, bounds: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """Equal-width histograms of ``feature, v`` rows, one pass for all features; ``bounds`` are each one's least and greatest value."""
    low = F.create_map(*[F.lit(x) for f, (lo, _) in bounds.items() for x in (f, lo)])[F.col("feature")]
    width = F.create_map(*[F.lit(x) for f, (lo, hi) in bounds.items() for x in (f, (hi - lo) / bins)])[F.col("feature")]
    idx = F.when(width > 0, F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return (pairs.select("feature", idx.cast("int").alias("bin")).groupBy("feature", "bin")
            .agg(F.count(F.lit(1)).alias("count")))


def histograms(df: DataFrame, columns: dict, bins: int = 50, fences: dict | None = None) -> DataFrame:
    """AGG-15 for several columns at once: two passes over ``df`` whatever their number, one for all bounds, one for all counts.

    ``fences`` leaves out values of a column outside its (low, high).
    """
    values = [F.struct(F.lit(name).alias("feature"), (F.col(x) if isinstance(x, str) else x).cast("double").alias("v")) for name, x in columns.items()]
    pairs = df.select(F.inline(F.array(*values))).where("v IS NOT NULL AND NOT isnan(v)")
    if fences:
        keep = F.lit(False)
        for name in columns:
            lo, hi = fences.get(name) or (None, None)
            keep = keep | ((F.col("feature") == name) & (F.col("v").between(lo, hi) if lo is not None else F.lit(True)))
        pairs = pairs.where(keep)
    found = pairs.groupBy("feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    bounds = {r["feature"]: (r["lo"], r["hi"]) for r in found}
    if not bounds:
        return df.sparkSession.createDataFrame([], "feature string, bin int, count bigint")
    return _grouped_histogram(pairs, bounds, bins)


def fenced_histograms(df: DataFrame, columns: list[str], bins: int = 50) -> DataFrame:
    """AGG-16: histograms of the values inside each column's interquartile fence (FLT-09); all columns share the passes."""
    qs = OrderStats(df, {c: F.col(c) for c in columns}).quantiles({c: [0.25, 0.75] for c in columns})
    fences = {c: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for c, (q1, q3) in qs.items() if q1 is not None}
    return histograms(df, {c: c for c in columns}, bins, fences)


def iqr_fence(df: DataFrame, c: str) -> DataFrame:
    """FLT-09: keep Q1 − 1.5·IQR ≤ x ≤ Q3 + 1.5·IQR."""
    q1, q3 = quantiles(df, c, [0.25, 0.75])
    if q1 is None:
        return df.limit(0)
    iqr = q3 - q1
    return df.filter(F.col(c).between(q1 - 1.5 * iqr, q3 + 1.5 * iqr))


def retention_of(df: DataFrame, keep) -> DataFrame:
    """AGG-24: rows kept / rows read in %, in one pass (``keep`` is a predicate)."""
    return df.agg(F.count(F.lit(1)).alias("rows_read"),
                  F.count_if(keep).alias("rows_kept")).select(
        "rows_read", "rows_kept",
        _r(F.col("rows_kept") * 100.0 / F.nullif(F.col("rows_read"), F.lit(0)), 4)
        .alias("retention_pct"))


def overview(df: DataFrame, ts: str = "date_creation_processed", w: str = "work_places",
             g: str = "industry") -> DataFrame:
    """AGG-26 + AGG-08: rows, time span, total weight, distinct groups."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  year_month(F.min(ts)).alias("first_month"),
                  year_month(F.max(ts)).alias("last_month"),
                  F.sum(w).cast("bigint").alias("total_weight"),
                  F.countDistinct(g).alias("groups"))


#: log2 of a distinct sketch's registers, and its relative standard error.
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, columns) -> DataFrame:
    """AGG-08, mergeable: ``feature, register, rank``, at most 2^``SKETCH_BITS`` rows per column.

    A value's hash names a register by its leading bits; the register keeps the longest run of zeros that
    followed, plus one. Sketches of batches are stored and merged later in any order and
    grouping, to the same rows; a value that two batches hold counts once. Nulls do not count.
    """
    h = F.xxhash64(F.col("v"))
    rest = F.shiftleft(h, SKETCH_BITS)
    rank = F.when(rest == 0, F.lit(65 - SKETCH_BITS)).otherwise(65 - F.length(F.bin(rest)))
    values = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]
    rows = df.select(F.inline(F.array(*values))).where("v IS NOT NULL").select(
        "feature", F.shiftrightunsigned(h, 64 - SKETCH_BITS).cast("int").alias("register"), rank.cast("int").alias("rank"))
    # a column without values has a sketch, too
    empty = df.sparkSession.createDataFrame([(c, 0, 0) for c in columns], "feature string, register int, rank int")
    return merge_sketches(rows.unionByName(empty))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per feature: every register's largest rank."""
    return sketches.groupBy("feature", "register").agg(F.max("rank").alias("rank"))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """``feature, distinct``: the likeliest number of values for the ranks' counts, with a relative standard error of ``SKETCH_ERROR``."""
    m = 1 << SKETCH_BITS
    ranks = sketches.where("rank > 0").groupBy("feature", "rank").agg(F.count("*").alias("n"))
    per = sketches.select("feature").distinct().join(
        ranks.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("rank", "n"))).alias("c"), F.sum("n").alias("used")), "feature", "left")
    free = f"(({m} - coalesce(used, 0)) / {m}D)"
    # registers by rank, from the longest runs down; then those without any value
    seen = f"aggregate(sequence({64 - SKETCH_BITS}, 1), 0D, (z, k) -> 0.5D * (z + coalesce(try_element_at(c, k), 0L)))"
    unseen = (f"aggregate(sequence(1, 40), named_struct('x', {free}, 'y', 1D, 's', {free}), "
              "(a, k) -> named_struct('x', a.x * a.x, 'y', a.y * 2, 's', a.s + a.x * a.x * a.y), a -> a.s)")
    found = f"CASE WHEN coalesce(used, 0) = 0 THEN 0L ELSE cast(round({m}D * {m} / (2 * ln(2D)) / ({seen} + {m} * {unseen})) AS long) END"
    return per.select("feature", F.expr(found).alias("distinct"))


def encoded_profile(df: DataFrame) -> DataFrame:
    """AGG-25: min, max, mean of every ``*_encoded`` column, as long rows."""
    cols = [c for c in df.columns if c.endswith("_encoded")]
    wide = df.agg(*[e for c in cols for e in (
        _r(F.min(c)).alias(f"{c}__min"), _r(F.max(c)).alias(f"{c}__max"),
        _r(F.avg(c)).alias(f"{c}__mean"))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").alias("min_value"),
                 F.col(f"{c}__max").alias("max_value"), F.col(f"{c}__mean").alias("mean_value"))
        for c in cols])))


def series_totals(series_long: DataFrame, k: int | None = 10,
                  total_name: str = "total_demand") -> DataFrame:
    """AGG-17 + TOP-04: total per series (the total series excluded), largest
    first; at most min(k, #series) rows."""
    t = (series_long.filter(F.col("series") != total_name).groupBy("series")
         .agg(F.sum("value").alias("total")))
    if k is not None:
        w = Window.orderBy(F.desc("total"), F.asc("series"))
        # The ranking runs over one row per series (small by construction).
        t = t.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return t


def head_rows(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """TOP-06: the first ``n`` rows as a sample (ordered when a key is given)."""
    return (df.orderBy(order_by) if order_by else df).limit(n)
