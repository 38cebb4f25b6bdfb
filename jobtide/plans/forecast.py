"""API-02/03: configuration search, anomaly repair, pooled models and
recursive forecasts, result tables and the summary report.

Distributed parts: spans → series (one aggregation pass), every series
operator (windows by series), metrics and report aggregates. Models are
fitted on one table of all configurations or all targets, so the number of
fits depends on neither.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ForecastConfig
from ..functions.scalar import year_month
from ..operators import features as FT
from ..operators import report as R
from ..operators import series as TS
from ..operators import spans as S
from ..session import cut_lineage
from . import models as M


@dataclass
class SearchResult:
    table: DataFrame          # (config_id, freq, outlier_removal, n_periods, r2_rf, r2_gbt, best_r2)
    best: dict | None         # best configuration
    best_r2: float | None
    series: DataFrame | None  # series of the best configuration


@dataclass
class ForecastResult:
    series: DataFrame        # repaired long series of the best configuration
    forecasts: DataFrame     # (series, step, period, forecast)
    metrics: DataFrame       # (series, model, mae, rmse, r2)
    best_models: DataFrame   # (series, best_model)
    search: DataFrame
    summary: DataFrame       # one row
    log: dict                # AGG-29: series, anomalies, repaired cells and series


def _series_for(spans: DataFrame, freq: str, cfg: ForecastConfig) -> DataFrame:
    s = S.demand_series(spans, freq=freq, min_activity=cfg.min_activity)
    return cut_lineage(s)


@dataclass
class _Candidate:
    """One configuration's series, as built and as repaired, and its forecast targets."""
    config: dict
    raw: DataFrame
    repaired: DataFrame
    n_periods: int
    targets: list[str]
    log: dict


#: Series index of a total as it is before the repair, which the search is judged on.
_SEARCH = -1


def _candidates(spans: DataFrame, grid: list[dict], cfg: ForecastConfig, total_name: str, repair: bool) -> list[_Candidate]:
    """Every configuration's series; the configurations are independent jobs and run concurrently."""
    # Series per frequency are built once (the grid repeats W).
    freqs = list(dict.fromkeys(c["freq"] for c in grid))
    with ThreadPoolExecutor(max_workers=len(freqs)) as pool:
        by_freq = dict(zip(freqs, pool.map(lambda f: _series_for(spans, f, cfg), freqs)))

    def build(config: dict) -> _Candidate:
        ts = by_freq[config["freq"]]
        if config.get("outlier_removal"):
            ts = cut_lineage(TS.remove_outliers(ts, cfg.outlier_threshold, cfg.interpolation))
        log, fixed = TS.SeriesLog(), ts
        if repair:
            fixed = cut_lineage(TS.detect_and_repair(ts, cfg.anomaly_threshold, cfg.repair_window,
                                                     True, total_name, cfg.total_cap, log))
        # Every series of the dense grid has one row per calendar period.
        n_periods = fixed.filter(F.col("series") == total_name).count()
        # at most top_k names (TOP-04, TOP-05)
        top = [r["series"] for r in R.series_totals(fixed, cfg.top_k, total_name).orderBy("rank").collect()]
        targets = [total_name] + (top if n_periods >= cfg.min_forecast_points else [])
        return _Candidate(config, ts, fixed, n_periods, targets, log.counts() if repair else {})

    with ThreadPoolExecutor(max_workers=len(grid)) as pool:
        return list(pool.map(build, grid))


def _features(parts: list[tuple[int, DataFrame, dict[str, int]]], cfg: ForecastConfig) -> DataFrame:
    """One feature table of all parts ``(config index, series, {name: series index})``; ``series`` is ``config:index`` in it."""
    table = None
    for i, ts, names in parts:
        key = F.create_map(*[F.lit(x) for n, j in names.items() for x in (n, f"{i}:{j}")])
        one = ts.filter(F.col("series").isin(*names)).select(key[F.col("series")].alias("series"), "period", "value")
        table = one if table is None else table.unionByName(one)
    where = F.split("series", ":")
    return cut_lineage(FT.make_features(table, cfg.leak_free).withColumns(
        {"config_idx": where[0].cast("double"), "series_idx": where[1].cast("double")}))


def _validate(feats: DataFrame, cfg: ForecastConfig, params: M.TreeParams) -> DataFrame:
    """Test predictions of both models for every series of ``feats`` that is long enough (FLT-11).

    One fit per model and origin: the test rows of one origin are training rows of the next.
    """
    preds = feats.sparkSession.createDataFrame([], "series string, period date, y double, model string, y_hat double")
    for origin in range(cfg.validation_origins if cfg.validation_periods else 1):
        split = cut_lineage(M.scaled(M.chrono_split(feats, cfg.train_fraction, cfg.validation_periods, origin)))
        least = min(3, cfg.validation_periods or 3)
        # one row per configuration and target
        sizes = split.groupBy("series").agg(F.count_if("is_train").alias("a"), F.count_if(~F.col("is_train")).alias("b"))
        ok = {r["series"]: r["a"] for r in sizes.collect() if r["a"] >= 10 and r["b"] >= least}
        if ok:
            split = split.filter(F.col("series").isin(*ok))
            models = M.fit_both(M.sized(split.filter("is_train"), sum(ok.values())), params)
            preds = preds.unionByName(M.predict_both(models, split.filter("NOT is_train")))
    return preds


def _search_table(metrics: DataFrame, made: list[_Candidate]) -> DataFrame:
    """AGG-28 from the metrics of the configurations' totals."""
    rows = [(i, c.config["freq"], bool(c.config.get("outlier_removal")), c.n_periods) for i, c in enumerate(made)]
    configs = metrics.sparkSession.createDataFrame(rows, "config_id int, freq string, outlier_removal boolean, n_periods bigint")
    own = metrics.filter(F.col("series").endswith(f":{_SEARCH}")).withColumn("series", F.split("series", ":")[0])
    return cut_lineage(M.search_table(own, configs))


def config_search(spans: DataFrame, cfg: ForecastConfig, params: M.TreeParams | None = None,
                  total_name: str = S.TOTAL) -> SearchResult:
    """ML-10 + AGG-28: test R² of both models on the total for every
    configuration; the best max-R² wins, the first on ties.

    All configurations' totals are one training table with the configuration as a feature, so
    there is one fit per model whatever the grid.
    """
    made = _candidates(spans, cfg.grid, cfg, total_name, repair=False)
    parts = [(i, c.raw, {total_name: _SEARCH}) for i, c in enumerate(made) if c.n_periods >= cfg.min_points]
    if not parts:
        return SearchResult(_search_table(M.metrics(_validate_nothing(spans)), made), None, None, None)
    preds = _validate(_features(parts, cfg), cfg, params or M.TreeParams(seed=cfg.seed))
    return _found(_search_table(M.metrics(preds), made), made)


def _validate_nothing(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "series string, period date, y double, model string, y_hat double")


def _found(table: DataFrame, made: list[_Candidate]) -> SearchResult:
    top = table.filter("is_best").first()
    if top is None:
        return SearchResult(table, None, None, None)
    return SearchResult(table, dict(made[top["config_id"]].config), top["best_r2"], made[top["config_id"]].raw)


def _fit_all(feats: DataFrame, cfg: ForecastConfig, params: M.TreeParams) -> tuple[DataFrame, dict, DataFrame]:
    """(test predictions, models fitted on all rows, scale per series), validation and final fits at the same time."""
    final = feats.filter(F.col("series_idx") != _SEARCH).withColumn("is_train", F.lit(True))
    full = cut_lineage(M.scaled(final))
    with ThreadPoolExecutor(max_workers=2) as pool:
        last = pool.submit(lambda: M.fit_both(M.sized(full, full.count()), params))
        preds = _validate(feats, cfg, params)
        models = last.result()
    return preds, models, full.select("series", "scale", "config_idx", "series_idx").dropDuplicates(["series"])


def _forecasts(ts: DataFrame, keys: dict[str, str], metrics: DataFrame, models: dict, scales: DataFrame,
               cfg: ForecastConfig, freq: str):
    """(metrics, best models, forecasts) of the series in ``keys`` (name: key in the feature table), or None if none was validated.

    Each target takes the model with the lower validation RMSE; the recursive forecast runs for all targets of a model at once.
    """
    name_of = F.create_map(*[F.lit(x) for n, k in keys.items() for x in (k, n)])
    met = cut_lineage(metrics.filter(F.col("series").isin(*keys.values())).withColumn("series", name_of[F.col("series")]))
    best = cut_lineage(M.best_model(met))
    choice = {r["series"]: r["best_model"] for r in best.collect()}   # one row per target
    if not choice:
        return None
    own = scales.filter(F.col("series").isin(*keys.values())).withColumn("series", name_of[F.col("series")])
    hist = cut_lineage(M.history(ts.filter(F.col("series").isin(*choice)), 24).join(own, "series"))

    def run(name: str) -> DataFrame | None:
        chosen = [s for s, b in choice.items() if b == name]
        return cut_lineage(M.recursive_forecast(
            hist.filter(F.col("series").isin(*chosen)), M.model_predictor(models[name]), cfg.horizon, freq, cfg.step,
            exact_ma=cfg.leak_free, keep=("scale", "config_idx", "series_idx"))) if chosen else None

    with ThreadPoolExecutor(max_workers=2) as pool:
        made = [f for f in pool.map(run, models) if f is not None]
    return met, best, made[0] if len(made) == 1 else made[0].unionByName(made[1])


def forecast_targets(ts: DataFrame, names: list[str], cfg: ForecastConfig, freq: str,
                     params: M.TreeParams | None = None):
    """ML-08 for the bounded list of targets (total + top K), with one training table for all.

    Returns (metrics, best models, forecasts), or None where no target is long enough.
    """
    index = {n: j for j, n in enumerate(names)}
    preds, models, scales = _fit_all(_features([(0, ts, index)], cfg), cfg, params or M.TreeParams(seed=cfg.seed))
    return _forecasts(ts, {n: f"0:{j}" for n, j in index.items()}, M.metrics(preds), models, scales, cfg, freq)


def run_forecast(spans: DataFrame, cfg: ForecastConfig | None = None,
                 params: M.TreeParams | None = None, n_rows: int | None = None,
                 total_name: str = S.TOTAL) -> ForecastResult:
    """API-02: the whole forecasting stage on a spans table.

    The totals of all configurations and the targets of each are one training table: one fit per
    model judges the configurations and validates the targets, and one per model, on all rows, forecasts.
    """
    cfg = cfg or ForecastConfig()
    params = params or M.TreeParams(seed=cfg.seed)
    spans = spans.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        made = _candidates(spans, [cfg.config] if cfg.config else cfg.grid, cfg, total_name, cfg.repair)
    finally:
        spans.unpersist()
    parts = []
    for i, c in enumerate(made):
        if c.n_periods >= cfg.min_points:
            parts += [(i, c.raw, {total_name: _SEARCH}), (i, c.repaired, {n: j for j, n in enumerate(c.targets)})]
    if not parts:
        raise RuntimeError("no configuration had enough data")
    preds, models, scales = _fit_all(_features(parts, cfg), cfg, params)
    metrics = cut_lineage(M.metrics(preds))
    search = _found(_search_table(metrics, made), made)
    if search.best is None:
        raise RuntimeError("no configuration had enough data")
    i = search.table.filter("is_best").first()["config_id"]
    best = made[i]
    done = _forecasts(best.repaired, {n: f"{i}:{j}" for j, n in enumerate(best.targets)}, metrics, models, scales, cfg, search.best["freq"])
    if done is None:
        raise RuntimeError("no series long enough to forecast")
    summary = summary_report(best.repaired, done[0], done[1], search, len(best.targets) - 1, n_rows, cfg.horizon, total_name)
    return ForecastResult(best.repaired, done[2], done[0], done[1], search.table, summary, best.log)


def summary_report(ts: DataFrame, metrics: DataFrame, best: DataFrame, search: SearchResult,
                   n_series: int, n_rows: int | None, horizon: int,
                   total_name: str = S.TOTAL, models: tuple[str, str] = (M.RF, M.GBT),
                   prefixes: tuple[str, str] = ("rf", "gbt")) -> DataFrame:
    """SNK-06: one row — analysed period, rows, series, best configuration
    and R², mean metrics per model, wins per model, overall best (lower mean
    RMSE, ties to the second model), horizon.

    Each input is a small aggregate; their scalars (a fixed, small number)
    are assembled into the report row."""
    spark = ts.sparkSession
    period = ts.agg(year_month(F.min("period")).alias("first_period"),
                    year_month(F.max("period")).alias("last_period")).first()
    mm = {r["model"]: r for r in M.mean_metrics(metrics).collect()}
    wins = {r["best_model"]: r["wins"] for r in M.win_counts(best).collect()}
    a, b = (mm.get(m) for m in models)
    wa, wb = (int(wins.get(m, 0)) for m in models)
    n = wa + wb

    def g(r, k):
        return None if r is None else r[k]

    ra, rb = g(a, "mean_rmse"), g(b, "mean_rmse")
    overall = models[0] if (ra is not None and rb is not None and ra < rb) else models[1]
    row = (period["first_period"], period["last_period"], n_rows, n_series, json.dumps(search.best, sort_keys=True),
           search.best_r2, g(a, "mean_mae"), g(a, "mean_rmse"), g(a, "mean_r2"),
           g(b, "mean_mae"), g(b, "mean_rmse"), g(b, "mean_r2"), wa, wb,
           wa * 100.0 / n if n else 0.0, wb * 100.0 / n if n else 0.0, overall, horizon)
    pa, pb = prefixes
    schema = ("first_period string, last_period string, vacancies bigint, series_analysed int, "
              f"best_config string, best_r2 double, {pa}_mean_mae double, {pa}_mean_rmse double, "
              f"{pa}_mean_r2 double, {pb}_mean_mae double, {pb}_mean_rmse double, "
              f"{pb}_mean_r2 double, {pa}_wins int, {pb}_wins int, {pa}_share_pct double, "
              f"{pb}_share_pct double, overall_best string, horizon int")
    return spark.createDataFrame([row], schema)
