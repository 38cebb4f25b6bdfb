"""Operators on the long series table ``(series, period, value)`` (TS-02..TS-07,
WIN-04..WIN-09, AGG-18..20).

Every statistic is a window partitioned by ``series``: a series has one row
per calendar period, so a window partition is bounded by the calendar
length, never by the data volume, and series run in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

TOTAL = "total_demand"


@dataclass
class SeriesLog:
    """AGG-29: counts taken while series are repaired and outliers removed, without a scan of their own.

    ``counts`` is there once the tables have been computed; a log serves one repair and one removal.
    """
    repair: Observation = field(default_factory=Observation)
    outliers: Observation = field(default_factory=Observation)
    used: list = field(default_factory=list)

    def observe(self, which: Observation, df: DataFrame, **flags: Column) -> DataFrame:
        """Per flag the number of cells and of series that have one, and the number of series."""
        cols, metrics = {"_first": F.row_number().over(_wo()) == 1}, [F.count_if("_first").alias("series")]
        for name, flag in flags.items():
            cols[f"_{name}"] = flag
            cols[f"_{name}_first"] = flag & (F.count_if(flag).over(
                _wo().rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 1)
            metrics += [F.count_if(f"_{name}").alias(name), F.count_if(f"_{name}_first").alias(f"{name}_series")]
        self.used.append(which)
        return df.withColumns(cols).observe(which, *metrics).drop(*cols)

    def counts(self) -> dict[str, int]:
        return {k: v for o in self.used for k, v in o.get.items()}


def _w(series: str = "series"):
    return Window.partitionBy(series)


def _wo(series: str = "series", order: str = "period"):
    return Window.partitionBy(series).orderBy(order)


# --- fills and z-scores ----------------------------------------------------------

def fill_edges(df: DataFrame, col: str = "value") -> DataFrame:
    """WIN-05: back-fill, then forward-fill, then 0."""
    after = _wo().rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = _wo().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(col, F.coalesce(F.col(col), F.first(col, True).over(after),
                                         F.last(col, True).over(before), F.lit(0.0)))


def zscore_pop(col: str = "value") -> Column:
    """AGG-18: |x − mean| / population std over the series; no spread → null."""
    x = F.col(col)
    return F.abs(x - F.avg(x).over(_w())) / F.nullif(F.stddev_pop(x).over(_w()), F.lit(0.0))


def zscore_samp(col: str = "value") -> Column:
    """AGG-19: sample z-score (ddof 1), 0 when there is no spread."""
    x = F.col(col)
    sd = F.stddev_samp(x).over(_w())
    return F.when(sd > 0, F.abs(x - F.avg(x).over(_w())) / sd).otherwise(F.lit(0.0))


# --- anomaly detection (TS-04) ---------------------------------------------------

def anomaly_flags(series: DataFrame, threshold: float = 2.0, total_name: str = TOTAL,
                  total_cap: float = 80000.0, extreme_q: float = 0.90,
                  extreme_factor: float = 2.0, high_q: float = 0.95,
                  high_factor: float = 1.2, spike_factor: float = 1.5) -> DataFrame:
    """OR of four rules per series: z > threshold; above q90 and above
    2·median; very high (total: above the cap, else above 1.2·q95); a jump
    to either neighbour above 1.5·median."""
    x = F.col("value")
    w = _w()
    med = F.percentile(x, 0.5).over(w)
    q_ext = F.percentile(x, extreme_q).over(w)
    q_high = F.percentile(x, high_q).over(w)
    z = zscore_pop("value")
    jump_fwd = F.abs(x - F.lag(x, 1).over(_wo()))     # WIN-04
    jump_bwd = F.abs(x - F.lead(x, 1).over(_wo()))
    out = series.select(
        "series", "period", "value",
        z.alias("z"),
        F.coalesce(z > threshold, F.lit(False)).alias("rule_z"),
        ((x > q_ext) & (x > med * extreme_factor)).alias("rule_extreme"),
        F.when(F.col("series") == total_name, x > total_cap)
         .otherwise(x > q_high * high_factor).alias("rule_high"),
        (F.coalesce(jump_fwd > med * spike_factor, F.lit(False))
         | F.coalesce(jump_bwd > med * spike_factor, F.lit(False))).alias("rule_jump"),
    )
    return out.withColumn("is_anomaly", F.col("rule_z") | F.col("rule_extreme")
                          | F.col("rule_high") | F.col("rule_jump"))


# --- anomaly repair (TS-05) --------------------------------------------------------

def _q_sorted(arr: str, p: float) -> str:
    """SQL: linear-interpolation quantile of an already sorted, non-empty array."""
    pos = f"((size({arr}) - 1) * {p})"
    lo = f"(CAST(floor({pos}) AS INT) + 1)"
    hi = f"least({lo} + 1, size({arr}))"
    return (f"(element_at({arr}, {lo}) + (element_at({arr}, {hi}) - element_at({arr}, {lo}))"
            f" * ({pos} - floor({pos})))")


def _repair_value(orig: str, neigh: str, is_total: str, total_cap: float) -> str:
    """SQL: repaired value from the original and its neighbourhood array."""
    s = f"array_sort({neigh})"
    mean = f"(aggregate({neigh}, CAST(0.0 AS DOUBLE), (a, v) -> a + v) / size({neigh}))"
    total_fix = (f"CASE WHEN {orig} > {total_cap} "
                 f"THEN greatest({_q_sorted(s, 0.75)}, {orig} * 0.6) ELSE {mean} END")
    other_fix = (f"CASE WHEN {orig} > {_q_sorted(s, 0.9)} THEN {_q_sorted(s, 0.9)} "
                 f"ELSE {_q_sorted(s, 0.25)} END")
    fixed = f"CASE WHEN {is_total} THEN {total_fix} ELSE {other_fix} END"
    # truncate towards zero, then floor at 0
    return f"CASE WHEN size({neigh}) = 0 THEN {orig} ELSE greatest(CAST(0 AS DOUBLE), CAST(CAST({fixed} AS BIGINT) AS DOUBLE)) END"


def repair_window(flags: DataFrame, window: int = 8, total_name: str = TOTAL,
                  total_cap: float = 80000.0) -> DataFrame:
    """TS-05, non-sequential variant: each anomaly is repaired from the
    *original* values of its ±``window`` neighbours (WIN-06)."""
    before = _wo().rowsBetween(-window, -1)
    after = _wo().rowsBetween(1, window)
    df = flags.withColumn("_neigh", F.concat(F.collect_list("value").over(before),
                                             F.collect_list("value").over(after)))
    fixed = F.expr(_repair_value("value", "_neigh", f"series = '{total_name}'", total_cap))
    return df.select("series", "period", "value", "is_anomaly",
                     F.when(F.col("is_anomaly"), fixed).otherwise(F.col("value"))
                     .alias("fixed")).drop("_neigh")


def repair_sequential(flags: DataFrame, window: int = 8, total_name: str = TOTAL,
                      total_cap: float = 80000.0) -> DataFrame:
    """TS-05, faithful: anomalies repaired in time order, each repair visible
    to the later ones (Q13). A fold (``aggregate``) over the series' ordered
    values; the array holds one element per period of the calendar."""
    per = (flags.groupBy("series").agg(
        F.sort_array(F.collect_list(F.struct("period", "value", "is_anomaly"))).alias("pts")))
    vals = "transform(pts, p -> p.value)"
    idx = "filter(sequence(1, size(pts)), i -> pts[i - 1].is_anomaly)"
    neigh = (f"concat(slice(acc, greatest(1, i - {window}), i - greatest(1, i - {window})), "
             f"slice(acc, i + 1, least(size(acc), i + {window}) - i))")
    # acc is 1-based in element_at/slice; the lambda below rewrites position i.
    new_val = _repair_value("element_at(acc, i)", neigh, f"series = '{total_name}'", total_cap)
    fold = (f"aggregate({idx}, {vals}, (acc, i) -> "
            f"transform(acc, (v, j) -> IF(j + 1 = i, {new_val}, v)))")
    out = per.select("series", "pts", F.expr(fold).alias("fixed_vals"))
    return out.select("series", F.inline(F.arrays_zip(
        F.col("pts.period").alias("period"), F.col("pts.value").alias("value"),
        F.col("pts.is_anomaly").alias("is_anomaly"), F.col("fixed_vals").alias("fixed"))))


def detect_and_repair(series: DataFrame, threshold: float = 2.0, window: int = 8,
                      sequential: bool = True, total_name: str = TOTAL,
                      total_cap: float = 80000.0, log: SeriesLog | None = None) -> DataFrame:
    """TS-06: TS-04 → TS-05; returns the repaired long table. ``log`` counts anomalies and repaired cells."""
    flags = anomaly_flags(series, threshold, total_name, total_cap)
    rep = (repair_sequential if sequential else repair_window)(flags, window, total_name, total_cap)
    if log is not None:
        rep = log.observe(log.repair, rep, anomalies=F.col("is_anomaly"), repaired=F.col("fixed") != F.col("value"))
    return rep.select("series", "period", F.col("fixed").alias("value"))


# --- outlier removal and gap filling (TS-02, TS-03) ---------------------------------

def outlier_mask(series: DataFrame, threshold: float = 3.0, min_points: int = 4) -> DataFrame:
    """TS-02 mask: |z| > threshold (ddof 0) in series with > 3 known points → null."""
    n = F.count("value").over(_w())
    out = (n >= min_points) & F.coalesce(zscore_pop("value") > threshold, F.lit(False))
    return series.select("series", "period",
                         F.when(out, F.lit(None).cast("double")).otherwise(F.col("value"))
                         .alias("value"), out.alias("is_outlier"))


def interpolate_linear(series: DataFrame) -> DataFrame:
    """TS-03 linear mode: straight line through the nearest known neighbours
    over true time distances; ends are left null (filled later by WIN-05)."""
    t = F.unix_date(F.col("period")).cast("double")
    prev = _wo().rowsBetween(Window.unboundedPreceding, -1)
    nxt = _wo().rowsBetween(1, Window.unboundedFollowing)
    known_t = F.when(F.col("value").isNotNull(), t)
    df = series.select(
        "*", t.alias("_t"),
        F.last("value", True).over(prev).alias("_y0"), F.last(known_t, True).over(prev).alias("_t0"),
        F.first("value", True).over(nxt).alias("_y1"), F.first(known_t, True).over(nxt).alias("_t1"))
    lin = F.col("_y0") + (F.col("_y1") - F.col("_y0")) * (F.col("_t") - F.col("_t0")) / (
        F.col("_t1") - F.col("_t0"))
    return df.withColumn("value", F.coalesce(F.col("value"), lin)).drop(
        "_t", "_y0", "_t0", "_y1", "_t1")


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _spline_slopes() -> str:
    """SQL: second derivatives at the known points ``k`` (at least 4) of the cubic spline whose third
    derivative is continuous at the second and the second-to-last of them.

    The end conditions are put into the first and last inner equation, which leaves a tridiagonal
    system: one fold eliminates downwards, one substitutes upwards.
    """
    h = "transform(sequence(1, n - 1), i -> k[i].t - k[i - 1].t)"
    d = "transform(sequence(1, n - 1), i -> (k[i].y - k[i - 1].y) / h[i - 1])"
    g, e = "h[i - 1]", "h[i]"
    rows = f"""transform(sequence(1, n - 2), i -> struct(
        CASE WHEN i = 1 THEN 0D WHEN i = n - 2 THEN ({g} * {g} - {e} * {e}) / {g} ELSE {g} END AS a,
        CASE WHEN i = 1 THEN ({g} + {e}) * ({g} + 2 * {e}) / {e} WHEN i = n - 2 THEN ({g} + {e}) * (2 * {g} + {e}) / {g}
             ELSE 2 * ({g} + {e}) END AS b,
        CASE WHEN i = n - 2 THEN 0D WHEN i = 1 THEN ({e} * {e} - {g} * {g}) / {e} ELSE {e} END AS c,
        6 * (d[i] - d[i - 1]) AS r))"""
    down = """aggregate(q, array(struct(0D AS c, 0D AS r)), (acc, x) -> concat(acc, array(struct(
        x.c / (x.b - x.a * element_at(acc, -1).c) AS c,
        (x.r - x.a * element_at(acc, -1).r) / (x.b - x.a * element_at(acc, -1).c) AS r))))"""
    up = "aggregate(reverse(slice(w, 2, n - 2)), array(0D), (m, x) -> concat(array(x.r - x.c * m[0]), m))"
    ends = """concat(array(((h[0] + h[1]) * m[0] - h[0] * m[1]) / h[1]), slice(m, 1, n - 2),
        array(((h[n - 2] + h[n - 3]) * m[n - 3] - h[n - 2] * m[n - 4]) / h[n - 3]))"""
    inner = _let(rows, "q", _let(down, "w", _let(up, "m", ends)))
    return _let(h, "h", _let(d, "d", inner))


def interpolate_cubic(series: DataFrame) -> DataFrame:
    """TS-03 cubic mode: not-a-knot spline per series through its known points over true time
    distances; with fewer than 4 of them a straight line. Points before the first and after the last known one stay null.

    Built-in expressions only; series without gaps are passed on. A row is one series, i.e.
    as many points as the calendar has periods.
    """
    point = "struct(cast(unix_date(period) AS double) AS t, period, value AS y)"
    per = series.groupBy("series").agg(F.expr(f"array_sort(collect_list({point}))").alias("pts"),
                                       F.expr(f"array_sort(collect_list({point}) FILTER (WHERE value IS NOT NULL))").alias("k"))
    left, right, slope, turn = "k[j]", "k[j + 1]", "m[j]", "m[j + 1]"
    width, after, before = f"({right}.t - {left}.t)", f"({right}.t - p.t)", f"(p.t - {left}.t)"
    curve = f"""({slope} * power({after}, 3) + {turn} * power({before}, 3)) / (6 * {width})
        + ({left}.y / {width} - {slope} * {width} / 6) * {after} + ({right}.y / {width} - {turn} * {width} / 6) * {before}"""
    line = f"{left}.y + ({right}.y - {left}.y) * {before} / {width}"
    at = _let("size(filter(k, x -> x.t < p.t)) - 1", "j", f"CASE WHEN m IS NULL THEN {line} ELSE {curve} END")
    fill = f"transform(pts, p -> struct(p.period, CASE WHEN p.y IS NULL AND p.t > k[0].t AND p.t < k[n - 1].t THEN {at} ELSE p.y END AS value))"
    slopes = f"CASE WHEN n >= 4 THEN {_spline_slopes()} END"
    filled = _let("size(k)", "n", f"CASE WHEN n < 2 OR n = size(pts) THEN transform(pts, p -> struct(p.period, p.y AS value)) ELSE {_let(slopes, 'm', fill)} END")
    return per.select("series", F.expr(f"inline({filled})"))


def remove_outliers(series: DataFrame, threshold: float = 3.0, method: str = "cubic",
                    log: SeriesLog | None = None) -> DataFrame:
    """TS-02: mask → interpolate → WIN-05. Every series separately, the total too. ``log`` counts the outliers."""
    masked = outlier_mask(series, threshold)
    if log is not None:
        masked = log.observe(log.outliers, masked, outliers=F.col("is_outlier"))
    masked = masked.drop("is_outlier")
    filled = interpolate_cubic(masked) if method == "cubic" else interpolate_linear(masked)
    return fill_edges(filled)


# --- decomposition (TS-07) -------------------------------------------------------------

def decompose(series: DataFrame, period: int = 12, min_points: int = 24) -> DataFrame:
    """Additive decomposition: centred moving average trend (half weights at
    the ends for an even period), seasonal = phase mean of the detrended
    values minus the mean of the phase means, residual = the rest.
    Series shorter than ``min_points`` are skipped."""
    df = fill_edges(series.select("series", "period", "value"))
    df = df.withColumn("_n", F.count(F.lit(1)).over(_w())).filter(F.col("_n") >= min_points)
    x = F.col("value")
    half = period // 2
    if period % 2 == 0:
        inner = _wo().rowsBetween(-(half - 1), half - 1)
        trend = (F.sum(x).over(inner) + 0.5 * (F.lag(x, half).over(_wo())
                                               + F.lead(x, half).over(_wo()))) / period
    else:
        inner = _wo().rowsBetween(-half, half)
        full = F.count(x).over(inner) == period
        trend = F.when(full, F.avg(x).over(inner))
    df = df.select("series", "period", "value", trend.alias("trend"),
                   F.pmod(F.row_number().over(_wo()) - 1, F.lit(period)).alias("phase"))
    df = df.withColumn("_detr", F.col("value") - F.col("trend"))
    phase_mean = df.groupBy("series", "phase").agg(F.avg("_detr").alias("_pm"))
    phase_mean = phase_mean.withColumn(
        "seasonal", F.col("_pm") - F.avg("_pm").over(_w())).drop("_pm")
    out = df.join(phase_mean, ["series", "phase"], "left")
    return out.select("series", "period", "value", "trend", "seasonal",
                      (F.col("_detr") - F.col("seasonal")).alias("resid"), "phase")


def seasonal_by_month(decomposed: DataFrame) -> DataFrame:
    """AGG-20: mean seasonal effect per calendar month."""
    return decomposed.groupBy("series", F.month("period").alias("month")).agg(
        F.avg("seasonal").alias("seasonal_effect"))


def outlier_counts(masked: DataFrame) -> DataFrame:
    """AGG-29: outliers per series, from :func:`outlier_mask`."""
    return masked.groupBy("series").agg(F.count_if("is_outlier").alias("outliers"), F.count("*").alias("periods"))


def anomaly_counts(flags: DataFrame) -> DataFrame:
    """AGG-29: anomalies and rule hits per series."""
    return flags.groupBy("series").agg(
        F.count_if("is_anomaly").alias("anomalies"), F.count_if("rule_z").alias("z_hits"),
        F.count_if("rule_extreme").alias("extreme_hits"), F.count_if("rule_high").alias("high_hits"),
        F.count_if("rule_jump").alias("jump_hits"))
