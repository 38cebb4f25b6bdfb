"""Result sinks (SNK-02..SNK-06). Tables are written with Spark writers;
nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.spans import wide


def write_prepared(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK-02: prepared table as Parquet (default) or ``;`` CSV with header."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(sep=";", header="true", encoding="UTF-8", quote='"', escape='"').csv(path)
    else:
        w.parquet(path)


def write_forecasts(forecasts: DataFrame, path: str, wide_form: bool = False) -> None:
    """SNK-03: forecasts, long ``(series, step, period, forecast)`` or wide
    ``period × series`` (pivot at the sink only)."""
    out = forecasts
    if wide_form:
        names = sorted(r["series"] for r in forecasts.select("series").distinct().collect())
        out = wide(forecasts.withColumnRenamed("forecast", "value"), names)
    out.write.mode("overwrite").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """SNK-04: metrics, one folder per model."""
    metrics.write.mode("overwrite").partitionBy("model").parquet(path)


def write_best(best: DataFrame, path: str) -> None:
    """SNK-05."""
    best.write.mode("overwrite").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """SNK-06: the one-row report as JSON and Parquet."""
    summary.coalesce(1).write.mode("overwrite").json(f"{path}_json")
    summary.write.mode("overwrite").parquet(path)


def write_results(result, folder: str, wide_forecast: bool = False) -> None:
    """All result tables of a :class:`~jobtide.plans.forecast.ForecastResult`."""
    write_forecasts(result.forecasts, f"{folder}/forecasts", wide_forecast)
    write_metrics(result.metrics, f"{folder}/metrics")
    write_best(result.best_models, f"{folder}/best_models")
    write_summary(result.summary, f"{folder}/summary")
    result.search.write.mode("overwrite").parquet(f"{folder}/search")
    result.series.write.mode("overwrite").parquet(f"{folder}/series")
