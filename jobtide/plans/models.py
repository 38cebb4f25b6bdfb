"""Models, evaluation and recursive forecasting (ML-01..ML-12, AGG-21..23, AGG-28).

* Split, metrics and naive baselines are windows/aggregations over all
  series at once.
* Each regressor is a Spark ML ``Pipeline`` (assembler → scaler → trees), fitted
  on one table of all series and configurations: targets and the features
  made of values are divided by the series' scale, and configuration and series are
  features. The number of fits does not depend on how many there are.
* The recursive forecast loops over the *horizon*, never over rows: the
  state is one row per series with the history as an array column; every
  step derives the features with array functions, applies the predictor
  (a column expression or a fitted model) and appends the rounded
  prediction. The plan of the final step is the only one executed.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import calendar_features, round_forecast
from ..operators.features import FEATURES, LAGS, MA_WINDOWS
from ..session import cut_lineage

RF = "random_forest"
GBT = "boosted_trees"
LAST = "last_value"
SEASONAL = "seasonal_naive"


#: Features made of the series' values, in its scale.
VALUE_FEATURES = tuple(f for f in FEATURES if f.startswith(("lag_", "ma_", "diff_")))
#: Input of the pooled models.
POOLED_FEATURES = (*FEATURES, "config_idx", "series_idx")
#: Training rows for which one task is enough.
ROWS_PER_TASK = 20_000


# --- split and metrics ---------------------------------------------------------------

def chrono_split(features: DataFrame, fraction: float = 0.8, periods: int | None = None,
                 origin: int = 0) -> DataFrame:
    """WIN-11: first floor(fraction·n) rows of each series are training rows.

    With ``periods`` the last that many rows are the test rows instead; ``origin`` k moves the end of both back by
    k·``periods`` rows and leaves the later ones out (rolling origin).
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("series"))
    pos = F.row_number().over(Window.partitionBy("series").orderBy("period"))
    if periods is None:
        return features.withColumn("is_train", pos <= F.floor(n * fraction))
    split = features.withColumns({"_n": n - origin * periods, "_pos": pos})
    return split.filter("_pos <= _n").withColumn("is_train", F.col("_pos") <= F.col("_n") - periods).drop("_n", "_pos")


def scaled(split: DataFrame) -> DataFrame:
    """``split`` with ``scale``, the mean absolute target of the series' training rows (1 if that is 0), and
    target and value features divided by it. Test rows do not enter the scale."""
    mean = F.avg(F.when(F.col("is_train"), F.abs("y"))).over(Window.partitionBy("series"))
    split = split.withColumn("scale", F.when(mean > 0, mean).otherwise(F.lit(1.0)))
    return split.withColumns({c: F.col(c) / F.col("scale") for c in ("y", *VALUE_FEATURES)})


def split_ok(split: DataFrame, min_train: int = 10, min_test: int = 3) -> DataFrame:
    """FLT-11: series with enough training and test rows."""
    return (split.groupBy("series")
            .agg(F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test"))
            .filter((F.col("n_train") >= min_train) & (F.col("n_test") >= min_test))
            .select("series"))


def metrics(pred: DataFrame, y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    """AGG-21: MAE, RMSE, R² per (series, model); constant target → R² null (Q19)."""
    w = Window.partitionBy("series", "model")
    e = F.col(y) - F.col(y_hat)
    df = pred.select("series", "model", e.alias("e"),
                     (F.col(y) - F.avg(y).over(w)).alias("dev"))
    return df.groupBy("series", "model").agg(
        F.avg(F.abs("e")).alias("mae"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        (F.lit(1.0) - F.sum(F.col("e") * F.col("e"))
         / F.nullif(F.sum(F.col("dev") * F.col("dev")), F.lit(0.0))).alias("r2"))


def naive_predictions(split: DataFrame) -> DataFrame:
    """ML-12: last value and seasonal (12 periods back) forecasts of the test rows."""
    test = split.filter(~F.col("is_train"))
    return test.select("series", "period", "y", F.inline(F.array(
        F.struct(F.lit(LAST).alias("model"), F.col("lag_1").alias("y_hat")),
        F.struct(F.lit(SEASONAL).alias("model"), F.col("lag_12").alias("y_hat")))))


def best_model(metric_table: DataFrame, first: str = RF, second: str = GBT) -> DataFrame:
    """ML-07: ``first`` if its RMSE is strictly lower, else ``second`` (ties → second)."""
    p = (metric_table.groupBy("series")
         .agg(F.max(F.when(F.col("model") == first, F.col("rmse"))).alias("a"),
              F.max(F.when(F.col("model") == second, F.col("rmse"))).alias("b")))
    return p.select("series", F.when(F.col("a") < F.col("b"), F.lit(first))
                    .otherwise(F.lit(second)).alias("best_model"))


def mean_metrics(metric_table: DataFrame) -> DataFrame:
    """AGG-22: mean of each metric per model across series, nulls skipped."""
    return metric_table.groupBy("model").agg(F.avg("mae").alias("mean_mae"),
                                             F.avg("rmse").alias("mean_rmse"),
                                             F.avg("r2").alias("mean_r2"))


def model_compare(metric_table: DataFrame, first: str = RF, second: str = GBT,
                  names: tuple[str, str] = ("rf", "gbt")) -> DataFrame:
    """JOIN-08: both models' metrics side by side per series, and by how much the first one's RMSE is higher."""
    wide = metric_table.groupBy("series").pivot("model", [first, second]).agg(
        F.first("rmse").alias("rmse"), F.first("mae").alias("mae"), F.first("r2").alias("r2"))
    cols = [F.col(f"{m}_{k}").alias(f"{k}_{n}") for k in ("rmse", "mae", "r2") for m, n in zip((first, second), names)]
    return wide.select("series", *cols, (F.col(f"{first}_rmse") - F.col(f"{second}_rmse")).alias("rmse_diff"))


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """AGG-27: per target the forecast's span, first, last, mean, least and greatest value, and how many targets there are."""
    per = forecasts.groupBy("series").agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
        F.min_by("forecast", "step").alias("first_forecast"), F.max_by("forecast", "step").alias("last_forecast"),
        F.avg("forecast").alias("mean_forecast"), F.min("forecast").alias("min_forecast"),
        F.max("forecast").alias("max_forecast"), F.count(F.lit(1)).alias("horizon"))
    # one row per target, of which there are at most top_k + 1
    return per.withColumn("n_targets", F.count(F.lit(1)).over(Window.partitionBy()))


def search_table(metric_table: DataFrame, configs: DataFrame, models: tuple[str, str] = (RF, GBT),
                 names: tuple[str, str] = ("rf", "gbt")) -> DataFrame:
    """AGG-28: test R² of both models per configuration, the better one, and the best configuration (the first on ties).

    ``metric_table`` has a configuration's id as its series; ``configs`` has ``config_id`` and what describes it.
    """
    r2 = metric_table.groupBy(F.col("series").cast("int").alias("config_id")).agg(
        *[F.max(F.when(F.col("model") == m, F.col("r2"))).alias(f"r2_{n}") for m, n in zip(models, names)])
    t = configs.join(r2, "config_id", "left").withColumn("best_r2", F.greatest(*[F.col(f"r2_{n}") for n in names]))
    w = Window.orderBy(F.desc_nulls_last("best_r2"), "config_id")  # one row per configuration of the grid
    return t.withColumn("is_best", (F.row_number().over(w) == 1) & F.col("best_r2").isNotNull())


def win_counts(best: DataFrame) -> DataFrame:
    """AGG-23: how often each model wins, with its share in %."""
    c = best.groupBy("best_model").agg(F.count(F.lit(1)).alias("wins"))
    # One row per model name: the unpartitioned window sees a handful of rows.
    return c.withColumn("share_pct", F.col("wins") * 100.0 / F.sum("wins").over(Window.partitionBy()))


# --- model fitting (ML-01..ML-06) -----------------------------------------------------------

@dataclass
class TreeParams:
    """Sizes of the source system's two regressors."""
    rf_trees: int = 100
    rf_depth: int = 8
    rf_min_leaf: int = 2
    rf_features: str = "sqrt"
    gbt_rounds: int = 100
    gbt_depth: int = 4
    gbt_rate: float = 0.1
    gbt_subsample: float = 0.8
    gbt_features: str = "0.8"
    seed: int = 42


def _pipeline(reg, features=FEATURES) -> Pipeline:
    asm = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="keep")
    sc = StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True)
    return Pipeline(stages=[asm, sc, reg])


def forest(p: TreeParams, features=FEATURES) -> Pipeline:
    """ML-02."""
    return _pipeline(RandomForestRegressor(
        featuresCol="_x", labelCol="y", predictionCol="prediction", numTrees=p.rf_trees,
        maxDepth=p.rf_depth, minInstancesPerNode=p.rf_min_leaf,
        featureSubsetStrategy=p.rf_features, seed=p.seed, checkpointInterval=-1), features)


def boosted(p: TreeParams, features=FEATURES) -> Pipeline:
    """ML-03."""
    return _pipeline(GBTRegressor(
        featuresCol="_x", labelCol="y", predictionCol="prediction", maxIter=p.gbt_rounds,
        maxDepth=p.gbt_depth, stepSize=p.gbt_rate, subsamplingRate=p.gbt_subsample,
        featureSubsetStrategy=p.gbt_features, lossType="squared", seed=p.seed,
        checkpointInterval=-1), features)


def _clean_xy(df: DataFrame, features=FEATURES) -> DataFrame:
    """ML-04 + PRJ-07: the model's features in their order, null → 0; target null → its mean."""
    feats = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    y = F.coalesce(F.col("y"), F.avg("y").over(Window.partitionBy("series")))
    rest = [c for c in df.columns if c not in features and c != "y"]
    return df.select(*rest, *feats, y.alias("y"))


def sized(train: DataFrame, rows: int) -> DataFrame:
    """Training rows on as many tasks as they need; the fits run hundreds of short jobs over them."""
    return train.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def fit_both(train: DataFrame, params: TreeParams | None = None, features=POOLED_FEATURES) -> dict[str, PipelineModel]:
    """Forest and boosted trees on the same rows, at the same time."""
    with ThreadPoolExecutor(max_workers=2) as pool:
        jobs = {name: pool.submit(fit, make, train, params, features) for name, make in ((RF, forest), (GBT, boosted))}
        return {name: job.result() for name, job in jobs.items()}


def predict_both(models: dict[str, PipelineModel], rows: DataFrame, features=POOLED_FEATURES) -> DataFrame:
    """``series, period, y, model, y_hat`` of rows from :func:`scaled`, in the series' own units."""
    out = None
    for name, model in models.items():
        p = predict(model, rows, features).select(
            "series", "period", (F.col("y") * F.col("scale")).alias("y"), F.lit(name).alias("model"),
            (F.col("prediction") * F.col("scale")).alias("y_hat"))
        out = p if out is None else out.unionByName(p)
    return out


def fit(pipe_factory: Callable[..., Pipeline], train: DataFrame,
        params: TreeParams | None = None, features=FEATURES) -> PipelineModel:
    """Fit; parameters that Spark ML refuses fall back to a 50-tree default, with a warning (ML-05).

    Other failures, such as lost executors, are raised.
    """
    params = params or TreeParams()
    data = _clean_xy(train, features)
    if data.isEmpty():
        raise ValueError("empty training data")
    try:
        return pipe_factory(params, features).fit(data)
    except IllegalArgumentException as e:
        warnings.warn(f"fit refused ({e}); using 50 trees instead", stacklevel=2)
        small = TreeParams(rf_trees=50, gbt_rounds=50, seed=params.seed)
        return pipe_factory(small, features).fit(data)


def predict(model: PipelineModel, df: DataFrame, features=FEATURES) -> DataFrame:
    """ML-06."""
    out = model.transform(_clean_xy(df, features))
    return out.drop("_raw", "_x")


# --- recursive forecast (ML-09) -------------------------------------------------------------

def history(series: DataFrame, length: int = 24) -> DataFrame:
    """WIN-10: last ``length`` values per series as an ordered array, and the last period."""
    w = Window.partitionBy("series").orderBy(F.desc("period"))
    last = series.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= length)
    return last.groupBy("series").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("period", "value"))),
                    lambda s: s["value"]).alias("h"),
        F.max("period").alias("last_period"))


def _next_period(last: Column, i: int, freq: str, step: str) -> Column:
    if step == "month" or freq == "M":
        return F.add_months(last, i)
    return F.date_add(last, (14 if freq == "2W" else 7) * i)


def _step_features(h: Column, period: Column, exact_ma: bool) -> list[Column]:
    """FN-21: features of the next period from the history array."""
    n = F.size(h)
    cols = calendar_features(period)
    cols += [F.when(n >= k, F.element_at(h, -k)).otherwise(F.lit(0.0)).alias(f"lag_{k}")
             for k in LAGS]
    for k in MA_WINDOWS:
        # Q7: the source system averages the last k−1 values.
        m = F.least(F.lit(k if exact_ma else k - 1), n)
        tail = F.slice(h, -m, m)
        cols.append((F.aggregate(tail, F.lit(0.0), lambda a, v: a + v) / m).alias(f"ma_{k}"))
    cols.append(F.when(n >= 2, F.element_at(h, -1) - F.element_at(h, -2))
                .otherwise(F.lit(0.0)).alias("diff_1"))
    cols.append(F.when(n >= 5, F.element_at(h, -1) - F.element_at(h, -5))
                .otherwise(F.lit(0.0)).alias("diff_4"))
    return cols


def recursive_forecast(hist: DataFrame, predictor: Callable[[DataFrame], DataFrame],
                       horizon: int = 6, freq: str = "M", step: str = "freq",
                       exact_ma: bool = False, checkpoint_every: int = 1,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """``(series, step, period, forecast)`` for ``horizon`` steps.

    ``predictor`` maps a frame with the FEATURES columns to one with a
    ``prediction`` column (a fitted pipeline's ``transform`` or a column
    expression). Predictions are rounded half-to-even and floored at 0 (FN-19).

    Each step's history is an expression of the previous one; without a cut
    the optimizer inlines them into a tree that grows exponentially with
    the horizon. The state (one row per series) is therefore checkpointed
    every ``checkpoint_every`` steps into the shared checkpoint folder.
    ``keep`` names extra per-series columns carried along (model inputs).
    """
    state = hist.select("series", *keep, "h", "last_period",
                        F.array().cast("array<struct<step:int,period:date,forecast:double>>")
                        .alias("fc"))
    for i in range(1, horizon + 1):
        period = _next_period(F.col("last_period"), i, freq, step)
        feat = state.select("*", period.alias("_period"),
                            *_step_features(F.col("h"), period, exact_ma))
        pred = predictor(feat)
        value = round_forecast(F.col("prediction"))
        state = pred.select(
            "series", *keep, F.concat("h", F.array(value)).alias("h"), "last_period",
            F.concat("fc", F.array(F.struct(F.lit(i).alias("step"), F.col("_period").alias("period"),
                                            value.alias("forecast")))).alias("fc"))
        if checkpoint_every and i % checkpoint_every == 0 and i < horizon:
            state = cut_lineage(state)
    return state.select("series", F.inline("fc"))


def column_predictor(expr: Column) -> Callable[[DataFrame], DataFrame]:
    """A closed-form model, e.g. ``F.col('ma_3')`` (ML-09 check)."""
    return lambda df: df.withColumn("prediction", expr)


def model_predictor(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """A model fitted on :func:`scaled` rows; the state carries the series' ``scale``."""
    def run(df: DataFrame) -> DataFrame:
        inputs = df.withColumns({f: F.col(f) / F.col("scale") for f in VALUE_FEATURES}).withColumn("y", F.lit(0.0))
        out = model.transform(inputs).drop("_raw", "_x", "y")
        return out.withColumn("prediction", F.col("prediction") * F.col("scale"))
    return run
