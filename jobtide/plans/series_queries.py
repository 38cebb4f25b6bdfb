"""Registered queries of the series operators and the forecasting stage, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ForecastConfig
from ..operators import features as FT
from ..operators import report as R
from ..operators import series as TS
from ..operators import spans as S
from ..session import cut_lineage
from ..sources import proxy
from . import models as M
from . import oracle as O
from .forecast import forecast_targets, run_forecast

MIN_ACTIVITY = 5
# Orders of a nation from which on it is a series of its own in the nation queries.
NATION_ACTIVITY = 480


def _spans(spark, sf_dir, group="segment"):
    return proxy.order_spans(spark, sf_dir, group=group)


def _series(spark: SparkSession, sf_dir: str, freq: str = "M", group: str = "segment", least: int = MIN_ACTIVITY) -> DataFrame:
    return S.demand_series(_spans(spark, sf_dir, group), freq=freq, min_activity=least)


# --- TS-02/TS-03: cubic fill ----------------------------------------------------------------

def _cubic(threshold: float):
    def run(spark, sf_dir):
        filled = TS.remove_outliers(_series(spark, sf_dir, "W"), threshold, method="cubic")
        return filled.withColumn("value", F.round("value", 6))
    return run


def outliers_cubic_sql(freq: str = "W", threshold: float = 3.0) -> str:
    """The spline's second derivatives by elimination and substitution, one recursion step per known point."""
    return f"""WITH RECURSIVE {O.demand_ctes(freq, MIN_ACTIVITY)},
m AS (SELECT series, period, CAST(period - DATE '1970-01-01' AS DOUBLE) AS t,
        CASE WHEN count(value) OVER w >= 4 AND coalesce(abs(value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0) > {threshold}, false)
             THEN NULL ELSE value END AS v
      FROM ts WINDOW w AS (PARTITION BY series)),
k AS MATERIALIZED (SELECT series, t, v, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY series) AS n,
        lead(t) OVER w - t AS h, (lead(v) OVER w - v) / (lead(t) OVER w - t) AS d FROM m WHERE v IS NOT NULL WINDOW w AS (PARTITION BY series ORDER BY t)),
q AS MATERIALIZED (SELECT x.series, x.i, x.n, 6 * (x.d - p.d) AS r,
        CASE WHEN x.i = 1 THEN 0 WHEN x.i = x.n - 2 THEN p.h - x.h * x.h / p.h ELSE p.h END AS a,
        2 * (p.h + x.h) + CASE WHEN x.i = 1 THEN p.h * (p.h + x.h) / x.h ELSE 0 END + CASE WHEN x.i = x.n - 2 THEN x.h * (p.h + x.h) / p.h ELSE 0 END AS b,
        CASE WHEN x.i = x.n - 2 THEN 0 WHEN x.i = 1 THEN x.h - p.h * p.h / x.h ELSE x.h END AS c
      FROM k x JOIN k p ON p.series = x.series AND p.i = x.i - 1 WHERE x.i BETWEEN 1 AND x.n - 2 AND x.n >= 4),
f(series, i, c, r) AS (SELECT DISTINCT series, CAST(0 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM q
  UNION ALL SELECT q.series, q.i, q.c / (q.b - q.a * f.c), (q.r - q.a * f.r) / (q.b - q.a * f.c) FROM f JOIN q ON q.series = f.series AND q.i = f.i + 1),
g(series, i, s) AS (SELECT DISTINCT series, n - 1, CAST(0 AS DOUBLE) FROM q
  UNION ALL SELECT f.series, f.i, f.r - f.c * g.s FROM g JOIN f ON f.series = g.series AND f.i = g.i - 1 WHERE f.i >= 1),
i2 AS (SELECT series, i, s FROM g WHERE i < (SELECT max(n) FROM k WHERE k.series = g.series) - 1),
z AS (SELECT * FROM i2
  UNION ALL SELECT a.series, CAST(0 AS BIGINT), a.s + (a.s - b.s) * h0.h / h1.h FROM i2 a JOIN i2 b ON b.series = a.series AND b.i = 2 AND a.i = 1
    JOIN k h0 ON h0.series = a.series AND h0.i = 0 JOIN k h1 ON h1.series = a.series AND h1.i = 1
  UNION ALL SELECT a.series, a.i + 1, a.s + (a.s - b.s) * h0.h / h1.h FROM i2 a JOIN i2 b ON b.series = a.series AND b.i = a.i - 1
    JOIN k h0 ON h0.series = a.series AND h0.i = a.i AND a.i = h0.n - 2 JOIN k h1 ON h1.series = a.series AND h1.i = a.i - 1),
e AS (SELECT m.series, m.period, m.v AS v0, CASE WHEN m.v IS NOT NULL THEN m.v ELSE
        l.s * power(y.t - m.t, 3) / (6 * x.h) + u.s * power(m.t - x.t, 3) / (6 * x.h)
        + (x.v / x.h - l.s * x.h / 6) * (y.t - m.t) + (y.v / x.h - u.s * x.h / 6) * (m.t - x.t) END AS v
      FROM m LEFT JOIN k x ON m.v IS NULL AND x.series = m.series AND x.t < m.t AND x.t + x.h > m.t
      LEFT JOIN k y ON y.series = x.series AND y.i = x.i + 1
      LEFT JOIN z l ON l.series = x.series AND l.i = x.i LEFT JOIN z u ON u.series = x.series AND u.i = x.i + 1)
SELECT series, period, round(coalesce(v,
    first_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0), 6) AS value
FROM e"""


def agg29_outlier_counts(spark, sf_dir):
    return TS.outlier_counts(TS.outlier_mask(_series(spark, sf_dir, "W"), 2.0))


_AGG29_OUTLIERS = f"""WITH {O.demand_ctes("W", MIN_ACTIVITY)}
SELECT series, CAST(count_if(z > 2.0) AS BIGINT) AS outliers, count(*) AS periods FROM (
  SELECT series, abs(value - avg(value) OVER (PARTITION BY series)) / nullif(stddev_pop(value) OVER (PARTITION BY series), 0) AS z FROM ts) GROUP BY series"""


# --- AGG-29, TS-06: counts of the running repair ------------------------------------------------

def ts06_detect_and_repair(spark, sf_dir):
    return TS.detect_and_repair(_series(spark, sf_dir))


def agg29_series_log(spark, sf_dir):
    """One row: what the repair and the outlier removal counted on their way."""
    log = TS.SeriesLog()
    cut_lineage(TS.detect_and_repair(_series(spark, sf_dir), log=log))
    cut_lineage(TS.remove_outliers(_series(spark, sf_dir, "W"), 2.0, log=log))
    return spark.createDataFrame([tuple(log.counts().values())], ", ".join(f"{k} long" for k in log.counts()))


def _agg29_log_sql() -> str:
    repaired = O.repair_sequential_sql("M")
    return f"""WITH r AS ({repaired}), o AS ({_AGG29_OUTLIERS})
SELECT (SELECT count(DISTINCT series) FROM r) AS series, CAST(count_if(is_anomaly) AS BIGINT) AS anomalies,
  count(DISTINCT series) FILTER (is_anomaly) AS anomalies_series, CAST(count_if(fixed <> value) AS BIGINT) AS repaired,
  count(DISTINCT series) FILTER (fixed <> value) AS repaired_series, (SELECT CAST(sum(outliers) AS BIGINT) FROM o) AS outliers,
  (SELECT count(*) FROM o WHERE outliers > 0) AS outliers_series FROM r"""


# --- FLT-07/08, AGG-13, TOP-04/05 with groups that the limits tell apart -----------------------------

def flt07_active_nations(spark, sf_dir):
    return _series(spark, sf_dir, "M", "nation", NATION_ACTIVITY)


def top04_nation_totals(spark, sf_dir):
    return R.series_totals(_series(spark, sf_dir, "M", "nation"), 10)


def flt08_no_active_group(spark, sf_dir):
    """No group reaches the limit, so all spans are one group."""
    return _series(spark, sf_dir, "M", "nation", 1 << 40)


def agg13_total_only(spark, sf_dir):
    return S.demand_series(_spans(spark, sf_dir), freq="W", group_col=None)


_ONE_GROUP = O.SPANS_CTE.replace("c.c_mktsegment AS grp", "'total' AS grp")


# --- evaluation with closed-form models --------------------------------------------------------------

_OPENED = O.SPANS_NATION_CTE.replace("coalesce(li.last_ship, o.o_orderdate + INTERVAL 77 DAY) AS end_ts", "o.o_orderdate + INTERVAL 31 DAY AS end_ts")


def _naive(spark, sf_dir, periods=None, origin=0):
    split = M.chrono_split(FT.make_features(_series(spark, sf_dir)), periods=periods, origin=origin)
    return M.naive_predictions(split)


def agg23_win_counts_nation(spark, sf_dir):
    """New orders per nation and month: series in which neither model always wins."""
    opened = _spans(spark, sf_dir, "nation").withColumn("end_ts", F.expr("start_ts + INTERVAL 31 DAYS"))
    split = M.chrono_split(FT.make_features(S.demand_series(opened, freq="M", min_activity=MIN_ACTIVITY)), periods=12)
    best = M.best_model(M.metrics(M.naive_predictions(split)), M.LAST, M.SEASONAL)
    return M.win_counts(best).withColumn("share_pct", F.round("share_pct", 6))


def api03_rolling_validation(spark, sf_dir):
    """Metrics over the last 6 periods and the 6 before, each predicted from what came earlier."""
    preds = _naive(spark, sf_dir, periods=6, origin=0).unionByName(_naive(spark, sf_dir, periods=6, origin=1))
    return M.metrics(preds).select("series", "model", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


def _met_sql(freq: str, least: int, where: str, spans: str = O.SPANS_CTE) -> str:
    return f"""{O.demand_ctes(freq, least, spans)},
sp AS (SELECT series, period, value AS y, coalesce(lag(value, 1) OVER w, 0.0) AS lag_1, coalesce(lag(value, 12) OVER w, 0.0) AS lag_12,
         row_number() OVER w AS pos, count(*) OVER (PARTITION BY series) AS n FROM ts WINDOW w AS (PARTITION BY series ORDER BY period)),
pred AS (SELECT series, y, 'last_value' AS model, lag_1 AS y_hat FROM sp WHERE {where} UNION ALL SELECT series, y, 'seasonal_naive', lag_12 FROM sp WHERE {where}),
dev AS (SELECT *, y - y_hat AS e, y - avg(y) OVER (PARTITION BY series, model) AS d FROM pred),
met AS (SELECT series, model, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / nullif(sum(d * d), 0) AS r2 FROM dev GROUP BY series, model)"""


_API03 = f"WITH {_met_sql('M', MIN_ACTIVITY, 'pos > n - 12')}\nSELECT series, model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM met"

_AGG23 = f"""WITH {_met_sql('M', MIN_ACTIVITY, 'pos > n - 12', _OPENED)},
b AS (SELECT series, CASE WHEN max(rmse) FILTER (model = 'last_value') < max(rmse) FILTER (model = 'seasonal_naive') THEN 'last_value' ELSE 'seasonal_naive' END AS best_model
      FROM met GROUP BY series)
SELECT best_model, count(*) AS wins, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM b GROUP BY best_model"""


# --- SNK-05: best models round trip ----------------------------------------------------------------------

def snk05_best_roundtrip(spark, sf_dir):
    from ..sources.vacancies import read_results
    from .pipeline import scratch_path
    from .sinks import write_best
    folder = scratch_path(spark, "results")
    write_best(M.best_model(M.metrics(_naive(spark, sf_dir)), M.LAST, M.SEASONAL), f"{folder}/best_models")
    return read_results(spark, folder)["best_models"]


_SNK05 = f"""WITH {_met_sql('M', MIN_ACTIVITY, 'pos > floor(n * 0.8)')}
SELECT series, CASE WHEN max(rmse) FILTER (model = 'last_value') < max(rmse) FILTER (model = 'seasonal_naive') THEN 'last_value' ELSE 'seasonal_naive' END AS best_model
FROM met GROUP BY series"""


# --- ML-08, API-02: what a forecast must look like, whatever the models predict -----------------------------

def _shape(forecasts: DataFrame) -> DataFrame:
    ok = (F.col("forecast") >= 0) & (F.col("forecast") == F.floor("forecast"))
    return forecasts.select("series", "step", "period", ok.alias("whole_and_not_negative"))


def ml08_forecast_total(spark, sf_dir):
    return _shape(forecast_targets(_series(spark, sf_dir), [S.TOTAL], ForecastConfig(), "M")[2])


def ml08_forecast_pooled(spark, sf_dir):
    """The total and the top 5 series, one training table."""
    ts = cut_lineage(_series(spark, sf_dir))
    top = [r["series"] for r in R.series_totals(ts, 5).orderBy("rank").collect()]
    return _shape(forecast_targets(ts, [S.TOTAL, *top], ForecastConfig(), "M")[2])


def api02_forecast_pipeline(spark, sf_dir):
    return run_forecast(_spans(spark, sf_dir)).forecasts


def _ml08_sql(where: str = "") -> str:
    return f"""WITH {O.demand_ctes("M", MIN_ACTIVITY)},
e AS (SELECT series, max(period) AS last FROM ts {where} GROUP BY series)
SELECT series, CAST(s AS INTEGER) AS step, CAST(last + to_months(s) AS DATE) AS period, true AS whole_and_not_negative
FROM e, (SELECT unnest(range(1, 7)) AS s)"""


QUERIES = {f.__name__: f for f in (
    ts06_detect_and_repair, agg29_outlier_counts, agg29_series_log, flt07_active_nations, top04_nation_totals, flt08_no_active_group, agg13_total_only,
    agg23_win_counts_nation, api03_rolling_validation, snk05_best_roundtrip, ml08_forecast_total, ml08_forecast_pooled, api02_forecast_pipeline)}
QUERIES |= {"ts02_outliers_cubic": _cubic(3.0), "ts02_outliers_cubic_z2": _cubic(2.0)}

ORACLE = {
    "ts02_outliers_cubic": outliers_cubic_sql("W", 3.0), "ts02_outliers_cubic_z2": outliers_cubic_sql("W", 2.0),
    "ts06_detect_and_repair": f"SELECT series, period, fixed AS value FROM ({O.repair_sequential_sql('M')})",
    "agg29_outlier_counts": _AGG29_OUTLIERS, "agg29_series_log": _agg29_log_sql(),
    "flt07_active_nations": O.demand_series_sql("M", NATION_ACTIVITY, O.SPANS_NATION_CTE),
    "top04_nation_totals": f"""WITH {O.demand_ctes("M", MIN_ACTIVITY, O.SPANS_NATION_CTE)},
t AS (SELECT series, sum(value) AS total, CAST(row_number() OVER (ORDER BY sum(value) DESC, series) AS INTEGER) AS rank FROM ts WHERE series <> 'total_demand' GROUP BY series)
SELECT series, total, rank FROM t WHERE rank <= 10""",
    "flt08_no_active_group": O.demand_series_sql("M", 0, _ONE_GROUP),
    "agg13_total_only": f"SELECT * FROM ({O.demand_series_sql('W', 0, _ONE_GROUP)}) WHERE series = 'total_demand'",
    "agg23_win_counts_nation": _AGG23, "api03_rolling_validation": _API03, "snk05_best_roundtrip": _SNK05,
    "ml08_forecast_total": _ml08_sql("WHERE series = 'total_demand'"), "ml08_forecast_pooled": _ml08_sql(),
}
