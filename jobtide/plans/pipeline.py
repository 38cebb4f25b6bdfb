"""API-01 and API-03: preparation entry point and the end-to-end pipeline.

Stage hand-over is a written table (Parquet by default) in a shared folder:
it cuts the lineage between preparation and forecasting, so a lost
executor during forecasting never re-runs the preparation.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from ..config import ForecastConfig, PrepConfig
from ..session import ensure_checkpoint_dir
from ..sources.vacancies import infer_types, read_extract, read_prepared, read_raw, typed
from . import sinks
from .forecast import ForecastResult, run_forecast
from .models import TreeParams
from .prepare import prepare, spans_of


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    base = spark.sparkContext.getCheckpointDir() or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/jobtide-io/{name}-{uuid.uuid4().hex}"


def prepare_vacancies(spark: SparkSession, input_path: str, output_path: str | None = None,
                      raw: bool = True, cfg: PrepConfig | None = None,
                      fmt: str = "parquet", multiline: bool | None = None) -> DataFrame:
    """API-01: read (raw text or an already filtered extract), prepare, and
    optionally write the prepared table (SNK-02). ``multiline`` None: as in ``cfg``."""
    cfg = cfg or PrepConfig()
    multiline = cfg.multiline if multiline is None else multiline
    if raw:
        df = read_raw(spark, input_path, multiline=multiline)
    else:
        cfg = replace(cfg, title_keyword=None)
        df = extract_columns(read_extract(spark, input_path, multiline, infer=False), cfg)
    prepared = prepare(df, cfg, check=raw)
    if output_path:
        sinks.write_prepared(prepared, output_path, fmt)
    return prepared


def extract_columns(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """SRC-04: types for the columns that preparation passes through; those that it parses stay text."""
    parsed = {cfg.target, "title", "industry", *cfg.categorical_columns, *cfg.numeric_columns, *cfg.deny_columns}
    parsed |= {c for pair in cfg.date_columns for c in pair}
    return typed(df, infer_types(df, [c for c in df.columns if c not in parsed]))


@dataclass
class PipelineConfig:
    """API-03 options."""
    input_path: str
    output_dir: str
    raw: bool = True
    skip_prepare: bool = False
    processed_path: str | None = None
    processed_format: str = "parquet"
    horizon: int = 6
    anomaly_threshold: float = 2.0
    # None: as in ``forecast``
    validation_periods: int | None = None
    validation_origins: int | None = None
    repair: bool | None = None
    config: dict | None = None
    prep: PrepConfig = field(default_factory=PrepConfig)
    forecast: ForecastConfig = field(default_factory=ForecastConfig)
    tree_params: TreeParams | None = None


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> ForecastResult:
    """API-03: prepare (or reuse a prepared table) → forecast → write results."""
    processed = cfg.processed_path or f"{cfg.output_dir.rstrip('/')}/prepared"
    if not cfg.skip_prepare:
        prepare_vacancies(spark, cfg.input_path, processed, cfg.raw, cfg.prep, cfg.processed_format)
    prepared = read_prepared(spark, processed, cfg.processed_format, cfg.prep.multiline)
    stated = {k: v for k in ("validation_periods", "validation_origins", "repair", "config") if (v := getattr(cfg, k)) is not None}
    fc = replace(cfg.forecast, horizon=cfg.horizon, anomaly_threshold=cfg.anomaly_threshold, **stated)
    result = run_forecast(spans_of(prepared), fc, cfg.tree_params, n_rows=prepared.count())
    sinks.write_results(result, cfg.output_dir)
    return result


def analyze_results(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """ML-11: read written results back (SRC-07) and summarise them: mean
    metrics per model (AGG-22), per-series model comparison (JOIN-08) and
    each target's forecast summary (AGG-27)."""
    from ..sources.vacancies import read_results
    from . import models as M

    res = read_results(spark, folder)
    out: dict[str, DataFrame] = {}
    if "metrics" in res:
        out["mean_metrics"] = M.mean_metrics(res["metrics"])
        out["comparison"] = M.model_compare(res["metrics"])
    if "forecasts" in res:
        out["forecast_summary"] = M.forecast_summary(res["forecasts"])
    return out
