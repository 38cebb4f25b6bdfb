"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the test tables (or data Spark derives from them), so its work
grows with the tables. The matching SQL lives in :mod:`jobtide.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..config import PrepConfig
from ..functions.scalar import null_markers, parse_weight
from ..operators import features as FT
from ..operators import report as R
from ..operators import series as TS
from ..operators import spans as S
from ..sources import proxy
from . import oracle as O
from . import models as M
from .prepare import clean_rows, encoding_tables, prepare

Query = Callable[[SparkSession, str], DataFrame]

# The pipeline passes min_activity=5 to series construction.
MIN_ACTIVITY = 5


def _demand(freq: str, method: str = "events") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return S.demand_series(proxy.order_spans(spark, sf_dir), freq=freq,
                               min_activity=MIN_ACTIVITY, method=method)
    return run


def proxy_prep_config() -> PrepConfig:
    """Preparation settings for the order-based vacancy rows."""
    return PrepConfig(title_keyword=O.PROXY_KEYWORD, date_lo=O.PROXY_LO, date_hi=O.PROXY_HI)


def fn01_weight_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = proxy.raw_vacancies(spark, sf_dir)
    return raw.select("vacancy_id", F.col("work_places").alias("work_places_text"),
                      parse_weight(null_markers("work_places")).alias("work_places"))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(proxy.raw_vacancies(spark, sf_dir), proxy_prep_config())


def api01_prepared_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select(
        "vacancy_id", "industry", "date_creation_processed", "date_end", "vacancy_duration",
        "work_places")


def agg02_encoding_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps, _ = encoding_tables(proxy.raw_vacancies(spark, sf_dir), proxy_prep_config())
    return maps.select("feature", "key", "n", F.round("mean", 6).alias("mean"),
                       F.round("enc", 6).alias("enc"))


def agg25_encoded_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.encoded_profile(_prepared(spark, sf_dir))


def _series(spark: SparkSession, sf_dir: str, freq: str = "M") -> DataFrame:
    return _demand(freq)(spark, sf_dir)


def ts04_anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = TS.anomaly_flags(_series(spark, sf_dir))
    return f.withColumn("z", F.round("z", 6))


def ts05_repair_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TS.repair_window(TS.anomaly_flags(_series(spark, sf_dir)))


def ts05_repair_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TS.repair_sequential(TS.anomaly_flags(_series(spark, sf_dir)))


def agg18_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir, "W").select(
        "series", "period", "value", F.round(TS.zscore_pop(), 6).alias("z_pop"),
        F.round(TS.zscore_samp(), 6).alias("z_samp"))


def ts02_outliers_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _series(spark, sf_dir, "W")
    masked = TS.outlier_mask(s, 3.0)
    filled = TS.fill_edges(TS.interpolate_linear(masked))
    return filled.select("series", "period", "is_outlier", F.round("value", 6).alias("value"))


def ts07_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = TS.decompose(_series(spark, sf_dir))
    return d.select("series", "period", "value", *[F.round(c, 6).alias(c) for c in
                                                    ("trend", "seasonal", "resid")], "phase")


def agg20_seasonal_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = TS.seasonal_by_month(TS.decompose(_series(spark, sf_dir)))
    return m.withColumn("seasonal_effect", F.round("seasonal_effect", 6))


def ts08_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = FT.make_features(_series(spark, sf_dir))
    return f.withColumns({c: F.round(c, 6) for c in ("ma_3", "ma_6", "ma_12")})


QUERIES: dict[str, Query] = {
    "ts04_anomaly_flags": ts04_anomaly_flags,
    "ts05_repair_window": ts05_repair_window,
    "ts05_repair_sequential": ts05_repair_sequential,
    "agg18_zscores": agg18_zscores,
    "ts02_outliers_linear": ts02_outliers_linear,
    "ts07_decompose": ts07_decompose,
    "agg20_seasonal_by_month": agg20_seasonal_by_month,
    "ts08_features": ts08_features,
    "fn01_weight_parse": fn01_weight_parse,
    "api01_prepared_spans": api01_prepared_spans,
    "agg02_encoding_maps": agg02_encoding_maps,
    "agg25_encoded_profile": agg25_encoded_profile,
    "ts01_demand_monthly": _demand("M"),
    "ts01_demand_weekly": _demand("W"),
    "ts01_demand_2w": _demand("2W"),
    "join03_demand_monthly_explode": _demand("M", "explode"),
}

ORACLE: dict[str, str] = {
    "ts04_anomaly_flags": O.anomaly_flags_sql("M"),
    "ts05_repair_window": O.repair_window_sql("M"),
    "agg18_zscores": O.zscores_sql("W"),
    "ts02_outliers_linear": O.outliers_linear_sql("W"),
    "ts07_decompose": O.decompose_sql("M"),
    "agg20_seasonal_by_month": O.seasonal_by_month_sql("M"),
    "ts08_features": O.features_sql("M"),
    "fn01_weight_parse": O.weight_parse_sql(),
    "api01_prepared_spans": O.prepared_spans_sql(),
    "agg02_encoding_maps": O.encoding_maps_sql(),
    "agg25_encoded_profile": O.encoded_profile_sql(),
    "ts01_demand_monthly": O.demand_series_sql("M", MIN_ACTIVITY),
    "ts01_demand_weekly": O.demand_series_sql("W", MIN_ACTIVITY),
    "ts01_demand_2w": O.demand_series_sql("2W", MIN_ACTIVITY),
    "join03_demand_monthly_explode": O.demand_series_sql("M", MIN_ACTIVITY),
}


# --- report aggregates, top-k, labels -------------------------------------------------

def _spans(spark: SparkSession, sf_dir: str, group: str = "segment") -> DataFrame:
    return proxy.order_spans(spark, sf_dir, group=group)


def _cleaned(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return clean_rows(proxy.raw_vacancies(spark, sf_dir), proxy_prep_config(), columns)


def agg07_weight_summary(spark, sf_dir):
    return R.weight_summary(_cleaned(spark, sf_dir, "work_places"))


def agg26_overview(spark, sf_dir):
    return R.overview(_cleaned(spark, sf_dir, "date_creation_processed", "work_places", "industry"))


def agg09_value_counts(spark, sf_dir):
    return R.value_counts(_spans(spark, sf_dir, "nation"), "grp")


def top01_top15_groups(spark, sf_dir):
    return R.value_counts(_spans(spark, sf_dir, "nation"), "grp", 15)


def top03_top3_groups(spark, sf_dir):
    return R.value_counts(_spans(spark, sf_dir, "nation"), "grp", 3)


def agg10_group_stats(spark, sf_dir):
    return R.group_stats(_spans(spark, sf_dir, "nation"), "grp", "weight")


def top02_top_groups(spark, sf_dir):
    return R.top_groups(_spans(spark, sf_dir, "nation"), "grp", "weight")


def agg14_monthly_counts(spark, sf_dir):
    return R.monthly_counts(_spans(spark, sf_dir), "start_ts")


def agg15_weight_histograms(spark, sf_dir):
    sp = _spans(spark, sf_dir)
    return R.histograms(sp, {"weight": "weight", "log_weight": F.log(F.col("weight").cast("double") + 1.0)})


def agg16_salary_histogram(spark, sf_dir):
    from ..sources.tables import table
    orders = table(spark, sf_dir, "orders", "o_totalprice")
    return R.histogram(R.iqr_fence(orders, "o_totalprice"), "o_totalprice", 50, "o_totalprice")


def agg24_title_retention(spark, sf_dir):
    raw = proxy.raw_vacancies(spark, sf_dir)
    return R.retention_of(raw, F.lower(F.col("title")).contains(O.PROXY_KEYWORD))


def flt01_title_filter(spark, sf_dir):
    from ..operators.clean import keep_titles
    raw = proxy.raw_vacancies(spark, sf_dir)
    return keep_titles(raw, O.PROXY_KEYWORD).select("vacancy_id", "title")


def fn04_labels(spark, sf_dir):
    from ..functions.scalar import safe_name, short_label
    from ..sources.tables import table
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type")
    return part.select("p_partkey",
                       safe_name(F.concat_ws(" ", "p_brand", "p_type")).alias("safe_label"),
                       short_label("p_name", 8).alias("short_label"))


def top04_series_totals(spark, sf_dir):
    return R.series_totals(_series(spark, sf_dir, "M"), 10)


# --- evaluation path on closed-form models ---------------------------------------------

def _naive_split(spark, sf_dir, freq="M"):
    return M.chrono_split(FT.make_features(_series(spark, sf_dir, freq)))


def _naive_metrics(spark, sf_dir, freq="M"):
    return M.metrics(M.naive_predictions(_naive_split(spark, sf_dir, freq)))


def _round_metrics(df):
    return df.select(*[F.round(c, 6).alias(c) if c in ("mae", "rmse", "r2") else F.col(c)
                       for c in df.columns])


def agg21_metrics_naive(spark, sf_dir):
    return _round_metrics(_naive_metrics(spark, sf_dir))


def ml07_best_naive(spark, sf_dir):
    return M.best_model(_naive_metrics(spark, sf_dir), M.LAST, M.SEASONAL)


def agg22_mean_metrics_naive(spark, sf_dir):
    m = M.mean_metrics(_naive_metrics(spark, sf_dir))
    return m.select("model", *[F.round(c, 6).alias(c) for c in ("mean_mae", "mean_rmse", "mean_r2")])


def agg23_win_counts_naive(spark, sf_dir):
    w = M.win_counts(M.best_model(_naive_metrics(spark, sf_dir), M.LAST, M.SEASONAL))
    return w.withColumn("share_pct", F.round("share_pct", 6))


def join08_model_compare_naive(spark, sf_dir):
    m = _naive_metrics(spark, sf_dir)
    both = M.model_compare(m, M.LAST, M.SEASONAL, ("last", "seasonal"))
    return both.select("series", *[F.round(c, 6).alias(c) for c in ("rmse_last", "rmse_seasonal", "rmse_diff")])


def _naive_forecast(spark, sf_dir, freq="M"):
    return M.recursive_forecast(M.history(_series(spark, sf_dir, freq), 24),
                                M.column_predictor(F.col("ma_3")), 6, freq)


def ml09_recursive_naive(spark, sf_dir):
    return _naive_forecast(spark, sf_dir)


def snk03_forecast_pivot_naive(spark, sf_dir):
    fc = _naive_forecast(spark, sf_dir)
    names = [r["series"] for r in fc.select("series").distinct().collect()]
    return S.wide(fc.withColumnRenamed("forecast", "value"), sorted(names))


def agg27_forecast_summary_naive(spark, sf_dir):
    fc = _naive_forecast(spark, sf_dir)
    return M.forecast_summary(fc).withColumn("mean_forecast", F.round("mean_forecast", 6))


def agg28_best_config_naive(spark, sf_dir):
    return naive_config_search(spark, sf_dir)


def naive_config_search(spark, sf_dir):
    """AGG-28 over the frequencies with the closed-form models."""
    met = None
    grid = ("W", "2W", "M")
    for i, freq in enumerate(grid):
        m = _naive_metrics(spark, sf_dir, freq).filter(F.col("series") == S.TOTAL).withColumn("series", F.lit(str(i)))
        met = m if met is None else met.unionByName(m)
    configs = spark.createDataFrame(list(enumerate(grid)), "config_id int, freq string")
    t = M.search_table(met, configs, (M.LAST, M.SEASONAL), ("last", "seasonal"))
    return t.select("config_id", "freq", F.round("best_r2", 6).alias("best_r2"), "is_best")


QUERIES.update({
    "agg07_weight_summary": agg07_weight_summary,
    "agg26_overview": agg26_overview,
    "agg09_value_counts": agg09_value_counts,
    "top01_top15_groups": top01_top15_groups,
    "top03_top3_groups": top03_top3_groups,
    "agg10_group_stats": agg10_group_stats,
    "top02_top_groups": top02_top_groups,
    "agg14_monthly_counts": agg14_monthly_counts,
    "agg15_weight_histograms": agg15_weight_histograms,
    "agg16_salary_histogram": agg16_salary_histogram,
    "agg24_title_retention": agg24_title_retention,
    "flt01_title_filter": flt01_title_filter,
    "fn04_labels": fn04_labels,
    "top04_series_totals": top04_series_totals,
    "agg21_metrics_naive": agg21_metrics_naive,
    "ml07_best_naive": ml07_best_naive,
    "agg22_mean_metrics_naive": agg22_mean_metrics_naive,
    "agg23_win_counts_naive": agg23_win_counts_naive,
    "join08_model_compare_naive": join08_model_compare_naive,
    "ml09_recursive_naive": ml09_recursive_naive,
    "snk03_forecast_pivot_naive": snk03_forecast_pivot_naive,
    "agg27_forecast_summary_naive": agg27_forecast_summary_naive,
    "agg28_best_config_naive": agg28_best_config_naive,
})

ORACLE.update({
    "agg07_weight_summary": O.weight_summary_sql(),
    "agg26_overview": O.overview_sql(),
    "agg09_value_counts": O.value_counts_sql(),
    "top01_top15_groups": O.value_counts_sql(15),
    "top03_top3_groups": O.value_counts_sql(3),
    "agg10_group_stats": O.group_stats_sql(),
    "top02_top_groups": O.top_groups_sql(),
    "agg14_monthly_counts": O.monthly_counts_sql(),
    "agg15_weight_histograms": O.weight_histograms_sql(),
    "agg16_salary_histogram": O.salary_histogram_sql(),
    "agg24_title_retention": O.title_retention_sql(),
    "flt01_title_filter": O.title_filter_sql(),
    "fn04_labels": O.labels_sql(),
    "top04_series_totals": O.series_totals_sql(),
    "agg21_metrics_naive": O.metrics_naive_sql(),
    "ml07_best_naive": O.best_naive_sql(),
    "agg22_mean_metrics_naive": O.mean_metrics_naive_sql(),
    "agg23_win_counts_naive": O.win_counts_naive_sql(),
    "join08_model_compare_naive": O.model_compare_naive_sql(),
    "ml09_recursive_naive": O.recursive_naive_sql(),
    "snk03_forecast_pivot_naive": O.forecast_pivot_naive_sql(),
    "agg27_forecast_summary_naive": O.forecast_summary_naive_sql(),
    "agg28_best_config_naive": O.best_config_naive_sql(),
})


# --- sources, incremental ingest, models ---------------------------------------------------

_SPAN_COLS = ("vacancy_id", "industry", "date_creation_processed", "date_end", "vacancy_duration",
              "work_places")


# Rows of one rendered file: a file is written by one task, so their number grows with the rows.
_FILE_ROWS = 250_000


def _files_per_batch(spark, sf_dir, batches: int) -> int:
    """Files of each of so many batches: one, or more beyond ``_FILE_ROWS`` orders a file."""
    from ..sources.tables import table
    return max(1, -(-table(spark, sf_dir, "orders").count() // (batches * _FILE_ROWS)))


def _raw_csv(spark, sf_dir, files: int = 4) -> str:
    """Render the order-based vacancy rows as ``;`` CSV files (scratch folder)."""
    from .pipeline import scratch_path
    from .sinks import write_prepared
    path = scratch_path(spark, "raw-csv")
    write_prepared(proxy.raw_vacancies(spark, sf_dir).repartition(files), path, fmt="csv")
    return path


def src01_raw_csv_prepare(spark, sf_dir):
    from ..sources.vacancies import read_raw
    raw = read_raw(spark, _raw_csv(spark, sf_dir, 4 * _files_per_batch(spark, sf_dir, 4)))
    return prepare(raw, proxy_prep_config()).select(*_SPAN_COLS)


def src08_incremental_ingest(spark, sf_dir):
    """Four micro-batches, of one file each while the files are small."""
    from ..streaming.ingest import ingest_available
    from .pipeline import scratch_path
    each = _files_per_batch(spark, sf_dir, 4)
    src = _raw_csv(spark, sf_dir, 4 * each)
    out = ingest_available(spark, src, scratch_path(spark, "ingest-sink"),
                           scratch_path(spark, "ingest-ckpt"), proxy_prep_config(),
                           max_files_per_trigger=each)
    return out.select(*_SPAN_COLS)


QUERIES.update({
    "src01_raw_csv_prepare": src01_raw_csv_prepare,
    "src08_incremental_ingest": src08_incremental_ingest,
})
ORACLE.update({
    "src01_raw_csv_prepare": O.prepared_spans_sql(),
    "src08_incremental_ingest": O.prepared_spans_sql(),
})


# --- date parts, anomaly counts, sink round trips ---------------------------------------

def fn11_date_parts(spark, sf_dir):
    from ..functions.scalar import date_parts, parse_timestamp, unflag
    raw = proxy.raw_vacancies(spark, sf_dir)
    ts = parse_timestamp(unflag("date_creation", "date_creation_mistake"))
    return raw.select("vacancy_id", ts.alias("date_creation_processed")).select(
        "vacancy_id", "date_creation_processed", *date_parts("date_creation_processed", "date_creation"))


def agg29_anomaly_counts(spark, sf_dir):
    return TS.anomaly_counts(TS.anomaly_flags(_series(spark, sf_dir)))


def snk02_prepared_roundtrip(spark, sf_dir):
    from ..sources.vacancies import read_prepared
    from .pipeline import scratch_path
    from .sinks import write_prepared
    path = scratch_path(spark, "prepared")
    write_prepared(_prepared(spark, sf_dir), path, "parquet")
    return read_prepared(spark, path, "parquet").select(*_SPAN_COLS)


def snk04_metrics_roundtrip(spark, sf_dir):
    from ..sources.vacancies import read_results
    from .pipeline import scratch_path
    from .sinks import write_metrics
    folder = scratch_path(spark, "results")
    write_metrics(_naive_metrics(spark, sf_dir), f"{folder}/metrics")
    back = read_results(spark, folder)["metrics"]
    return _round_metrics(back.select("series", "model", "mae", "rmse", "r2"))


QUERIES.update({
    "fn11_date_parts": fn11_date_parts,
    "agg29_anomaly_counts": agg29_anomaly_counts,
    "snk02_prepared_roundtrip": snk02_prepared_roundtrip,
    "snk04_metrics_roundtrip": snk04_metrics_roundtrip,
})
ORACLE.update({
    "fn11_date_parts": O.date_parts_sql(),
    "agg29_anomaly_counts": O.anomaly_counts_sql(),
    "snk02_prepared_roundtrip": O.prepared_spans_sql(),
    "snk04_metrics_roundtrip": O.metrics_naive_sql(),
})


def snk06_summary_naive(spark, sf_dir):
    """SNK-06 on the closed-form models: the report row of the evaluation path."""
    from .forecast import SearchResult, summary_report
    table = naive_config_search(spark, sf_dir)
    top = table.filter("is_best").first()        # one row of three
    search = SearchResult(table, {"freq": top["freq"], "outlier_removal": False},
                          top["best_r2"], None)
    ts = _series(spark, sf_dir, "M")
    met = _naive_metrics(spark, sf_dir)
    best = M.best_model(met, M.LAST, M.SEASONAL)
    n_series = R.series_totals(ts, 10).count()
    n_rows = _spans(spark, sf_dir).count()
    rep = summary_report(ts, met, best, search, n_series, n_rows, 6, S.TOTAL,
                         (M.LAST, M.SEASONAL), ("last", "seasonal"))
    return rep.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c)
                        for c, t in rep.dtypes])


QUERIES["snk06_summary_naive"] = snk06_summary_naive
ORACLE["snk06_summary_naive"] = O.summary_naive_sql()


ORACLE["ts05_repair_sequential"] = O.repair_sequential_sql("M")


# The weekly proxy series have no point beyond |z| > 3 (the default), so these
# variants at |z| > 2 make the mask and the gap filling do work.
def ts02_outliers_linear_z2(spark, sf_dir):
    s = _series(spark, sf_dir, "W")
    filled = TS.fill_edges(TS.interpolate_linear(TS.outlier_mask(s, 2.0)))
    return filled.select("series", "period", "is_outlier", F.round("value", 6).alias("value"))


QUERIES["ts02_outliers_linear_z2"] = ts02_outliers_linear_z2
ORACLE["ts02_outliers_linear_z2"] = O.outliers_linear_sql("W", 2.0)


from . import input_queries, series_queries  # noqa: E402  they use this module's settings

for _more in (input_queries, series_queries):
    QUERIES.update(_more.QUERIES)
    ORACLE.update(_more.ORACLE)
