"""Component-wise forecasting: decompose, predict every component, average, select, fuse, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.functions.calendar import add_time_features
from gridtide.functions.columns import numeric_exogenous_columns
from gridtide.operators.decompose import component_frame, component_names
from gridtide.operators.models import MODELS, SERIES_MODELS, ForecastConfig, find_model, model_windows, series_runs
from gridtide.operators.position import index_series, tail_rows
from gridtide.operators.score import METRICS, metrics
from gridtide.operators.sequence import average_overlaps, impute_means, standardise, with_split
from gridtide.operators.skew import attach, lookup
from gridtide.session import materialise, stored

# Fixed value: rows of the last-week forecast view, seven days of 15-minute steps.
LAST_WEEK_ROWS = 7 * 24 * 4
ORDERING = ("RMSE", "MAE", "MAPE")
# Significant digits in which two scores must differ: sums over rows in another order differ beyond that.
SCORE_DIGITS = 10


@dataclass(frozen=True)
class ComponentSeries:
    """Indexed rows with components and split position, computed once and read by every model."""

    rows: DataFrame
    components: list[str]
    exogenous: list[str]
    config: ForecastConfig
    keys: tuple[str, ...]
    rejected: DataFrame | None = None  # `keys…, n` of the series without room for both windows

    @cached_property
    def scaled(self) -> DataFrame:
        return scaled_components(self)

    @cached_property
    def runs(self) -> DataFrame:
        """What all windows are cut from, written once: a few numbers for each row of the series."""
        return stored(series_runs(scaled_rows(self), self.components, self.exogenous, self.config, self.keys), "runs")


@dataclass(frozen=True)
class ForecastResult:
    method: str
    forecast: DataFrame
    metrics: DataFrame
    component_metrics: DataFrame | None = None
    selection: DataFrame | None = None
    best_method: DataFrame | None = None
    series: ComponentSeries | None = None
    candidates: tuple[ForecastResult, ...] = ()


def prepare(df: DataFrame, cfg: ForecastConfig, keys: Sequence[str] = ()) -> ComponentSeries:
    """Index, decompose and split every series.

    Series without room for both windows are left out and listed in `rejected`; if none is left, that is an error.
    """
    cfg.check()
    keys = tuple(keys)
    exogenous = numeric_exogenous_columns(df, keys) if cfg.exogenous else []
    rows = component_frame(index_series(df, keys), cfg.imf_components, keys, causal=cfg.causal, block_rows=cfg.block_rows, method=cfg.decomposition)
    names = [*component_names(rows), "residual"]
    rows = with_split(rows, cfg.train_ratio, cfg.lookback, cfg.horizon)
    rows = stored(rows.select(*keys, "timestamp", "load", "idx", "n", "split_idx", *names, *exogenous), "prepared")
    short = F.col("n") - F.col("split_idx") < cfg.horizon
    fits = rows.filter(~short)
    if fits.isEmpty():
        longest = rows.agg(F.max("n")).first()[0] or 0
        raise ValueError(f"A series of {longest} rows is too short: lower lookback or horizon, or give a longer range.")
    rejected = rows.filter(short & (F.col("idx") == 0)).select(*keys, "n")
    return ComponentSeries(fits, names, exogenous, cfg, keys, rejected)


def scaled_rows(series: ComponentSeries) -> DataFrame:
    """The rows with scaled components and exogenous values, and their `mean_*` and `scale_*`."""
    rows, exogenous = series.rows, series.exogenous
    if exogenous:
        rows = impute_means(rows, exogenous, series.keys)
    return standardise(rows, [*series.components, *exogenous], series.keys, series.config.strict_scaling)


def scaled_components(series: ComponentSeries) -> DataFrame:
    """Long scaled components with the scaled exogenous values of their row in one array."""
    keys, names, exogenous = series.keys, series.components, series.exogenous
    rows = scaled_rows(series)
    exog = F.array(*[F.col(c) for c in exogenous]) if exogenous else F.array().cast("array<double>")
    parts = F.inline(F.array(*[
        F.struct(F.lit(c).alias("component"), F.col(c).alias("z"), F.col(f"mean_{c}").alias("center"), F.col(f"scale_{c}").alias("scale"))
        for c in names
    ]))
    long = rows.withColumn("exog", exog).select(*keys, "idx", "n", "split_idx", "exog", parts)
    return long.filter(F.col("z").isNotNull())


def training_windows(series: ComponentSeries) -> DataFrame:
    return model_windows(series.runs, series.components, series.config, series.keys, test=False)


def testing_windows(series: ComponentSeries) -> DataFrame:
    """Windows whose targets are all test rows; the first origin is the last training row."""
    return model_windows(series.runs, series.components, series.config, series.keys, test=True)


def component_forecasts(series: ComponentSeries, models: Sequence[str]) -> DataFrame:
    """`keys…, component, model, idx, actual, predicted`, overlapping predictions averaged.

    The rows that windows are cut from are written once. A window repeats a horizon of rows twice, so windows themselves are
    cut anew by every model that reads them.
    """
    groups = [*series.keys, "component"]
    train, test = training_windows(series), testing_windows(series)

    def predictions(name: str) -> DataFrame:
        model = find_model(name)
        if name.lower() in SERIES_MODELS:
            return model(series.scaled, series.config, series.keys)
        return model(train, test, series.config, series.keys)

    parts = [average_overlaps(predictions(m), groups).withColumn("model", F.lit(m.lower())) for m in models]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*groups, "model", "idx", "actual", "predicted")


def component_metrics(forecasts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return metrics(forecasts, [*keys, "component", "model"], "actual", "predicted")


def fuse_components(forecasts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sum true and predicted components at every position."""
    return forecasts.groupBy(*groups, "idx").agg(F.sum("actual").alias("actual_load"), F.sum("predicted").alias("predicted_load"))


def forecast_frame(fused: DataFrame, rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Put timestamps on fused predictions; `error` is actual minus predicted."""
    times = rows.filter("idx >= split_idx").select(*keys, "idx", "n", "timestamp")
    return lookup(fused, times, [*keys, "idx"]).withColumn("error", F.col("actual_load") - F.col("predicted_load"))


def rank_order(names: Sequence[str]) -> Column:
    """Position of a model in the registry order, for ties."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model"))


def score_key(metric: str) -> Column:
    """A metric cut to its significant digits, so that equal forecasts tie whatever the order of addition."""
    size = F.pow(F.lit(10.0), F.floor(F.log10(F.col(metric))))
    return F.when(F.col(metric) > 0, F.round(F.col(metric) / size, SCORE_DIGITS - 1) * size).otherwise(F.col(metric))


def _first_by(table: DataFrame, groups: Sequence[str], order: Sequence) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*[score_key(m).asc_nulls_last() for m in ORDERING], *order))
    return table.withColumn("_place", place).filter("_place = 1").drop("_place")


def select_models(scores: DataFrame, keys: Sequence[str] = (), models: Sequence[str] | None = None) -> DataFrame:
    """Best model per component by (RMSE, MAE, MAPE), then registry order."""
    best = _first_by(scores, [*keys, "component"], [rank_order(list(models or MODELS))])
    return best.select(*keys, "component", F.col("model").alias("selected_model"), *METRICS)


def hybrid_forecasts(forecasts: DataFrame, selection: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The chosen model's predictions of every component."""
    chosen = selection.select(*keys, "component", F.col("selected_model").alias("_chosen"))
    return attach(forecasts, chosen, [*keys, "component"]).filter(F.col("model") == F.col("_chosen")).drop("_chosen")


def compare_models(results: DataFrame, groups: Sequence[str] = (), model: str = "model") -> DataFrame:
    """`model, RMSE, MAE, MAPE` ordered by RMSE; model names in upper case."""
    named = results.withColumn("model", F.upper(F.col(model)))
    return metrics(named, [*groups, "model"], names=ORDERING).orderBy(*groups, F.col("RMSE").asc_nulls_last())


def best_of(comparison: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(score_key("RMSE").asc_nulls_last(), "model"))
    return comparison.withColumn("_place", place).filter("_place = 1").select(*groups, F.col("model").alias("best_model"))


def comparison_long(comparison: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return comparison.unpivot([*groups, "model"], list(ORDERING), "metric", "value")


def add_fusion_result(results: DataFrame, fused: DataFrame) -> DataFrame:
    """Add an outside forecast to a model comparison under the name FREQ_FUSION."""
    return results.unionByName(fused.withColumn("model", F.lit("FREQ_FUSION")).select(*results.columns))


def last_week(forecast: DataFrame, rows: int = LAST_WEEK_ROWS) -> DataFrame:
    """The last rows of each forecast, by position."""
    return tail_rows(forecast, rows)


def _result(method: str, forecasts: DataFrame, series: ComponentSeries, scores: DataFrame, selection: DataFrame | None) -> ForecastResult:
    keys = list(series.keys)
    frame = materialise(forecast_frame(fuse_components(forecasts, keys), series.rows, keys))
    return ForecastResult(method, frame, metrics(frame, keys), scores, selection, series=series)


def run_single(series: ComponentSeries, model: str, forecasts: DataFrame | None = None) -> ForecastResult:
    """Every component with one model."""
    find_model(model)
    if forecasts is None:
        forecasts = stored(component_forecasts(series, [model]), "forecasts")
    mine = forecasts.filter(F.col("model") == model.lower())
    return _result(model.lower(), mine, series, component_metrics(mine, series.keys), None)


def run_hybrid(series: ComponentSeries, forecasts: DataFrame | None = None, models: Sequence[str] | None = None) -> ForecastResult:
    """Every component with its best model."""
    models = list(models or MODELS)
    if forecasts is None:
        forecasts = stored(component_forecasts(series, models), "forecasts")
    selection = materialise(select_models(component_metrics(forecasts, series.keys), series.keys, models))
    return _result("hybrid", hybrid_forecasts(forecasts, selection, series.keys), series, selection, selection)


def method_scores(results: Sequence[ForecastResult], keys: Sequence[str] = ()) -> DataFrame:
    """One metrics row per method and series, with the method's place in the candidate list."""
    out = None
    for place, result in enumerate(results):
        part = result.metrics.select(*keys, F.lit(result.method).alias("method"), F.lit(place).alias("place"), *METRICS)
        out = part if out is None else out.unionByName(part)
    return out


def run_best(series: ComponentSeries, models: Sequence[str] | None = None) -> ForecastResult:
    """The best of all single models and the hybrid, per series; every model is fitted once."""
    models, keys = list(models or MODELS), list(series.keys)
    forecasts = stored(component_forecasts(series, models), "forecasts")
    results = [run_single(series, m, forecasts) for m in models] + [run_hybrid(series, forecasts, models)]
    best = materialise(_first_by(method_scores(results, keys), keys, [F.col("place")]).select(*keys, F.col("method").alias("best_method"), *METRICS))
    frame = None
    for result in results:
        part = result.forecast.withColumn("_method", F.lit(result.method))
        frame = part if frame is None else frame.unionByName(part)
    chosen = attach(frame, best.select(*keys, "best_method"), keys).filter(F.col("_method") == F.col("best_method"))
    forecast = materialise(chosen.drop("_method", "best_method"))
    return ForecastResult("best", forecast, metrics(forecast, keys), None, results[-1].selection, best, series, tuple(results))


def run_forecast(df: DataFrame, cfg: ForecastConfig, method: str, keys: Sequence[str] = ()) -> ForecastResult:
    """Forecast with one model, `hybrid` or `best`; the method name ignores case."""
    name = method.lower()
    if name not in MODELS and name not in SERIES_MODELS and name not in ("hybrid", "best"):
        raise ValueError(f"Unsupported forecast method: {method}")
    if cfg.exogenous and "hour_sin" not in df.columns:
        df = add_time_features(df)
    series = prepare(df, cfg, keys)
    if name == "hybrid":
        return run_hybrid(series)
    return run_best(series) if name == "best" else run_single(series, name)


def run_model_comparison(
    df: DataFrame, cfg: ForecastConfig, keys: Sequence[str] = (), models: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Strategies `EMD+<model>`: their metrics, the upper-case comparison and the best forecast, per series."""
    keys, models = list(keys), list(models or MODELS)
    if cfg.exogenous and "hour_sin" not in df.columns:
        df = add_time_features(df)
    series = prepare(df, cfg, keys)
    forecasts = stored(component_forecasts(series, models), "forecasts")
    fused = fuse_components(forecasts, [*keys, "model"]).withColumn("strategy", F.concat(F.lit("EMD+"), F.col("model")))
    frame = materialise(forecast_frame(fused.drop("model"), series.rows, keys))
    table = materialise(metrics(frame, [*keys, "strategy"]).withColumn("imf_components", F.lit(cfg.imf_components)))
    place = F.array_position(F.array(*[F.lit(f"EMD+{m}") for m in models]), F.col("strategy"))
    best = _first_by(table, keys, [place]).select(*keys, F.col("strategy").alias("_best"))
    comparison = compare_models(frame, keys, "strategy")
    by_rmse = best_of(comparison, keys)
    clash = lookup(best, by_rmse, keys).filter(F.upper("_best") != F.col("best_model"))
    # Equal RMSE is the only honest way to differ; then both are best.
    rmse = table.select(*keys, F.upper("strategy").alias("best_model"), F.col("RMSE").alias("_r"))
    clash = lookup(clash, rmse, [*keys, "best_model"])
    clash = lookup(clash, table.select(*keys, F.col("strategy").alias("_best"), F.col("RMSE").alias("_s")), [*keys, "_best"])
    if not clash.filter(F.abs(F.col("_r") - F.col("_s")) > 1e-9 * F.abs(F.col("_r"))).isEmpty():
        raise RuntimeError("The two selections of the best model disagree.")
    final = attach(frame, best, keys).filter(F.col("strategy") == F.col("_best")).drop("_best")
    return table, comparison, final
