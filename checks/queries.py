"""One query per operator, over whole driver tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import series as S
from gridtide.functions.calendar import add_time_features, range_label, year_week
from gridtide.functions.columns import infer_key_columns, normalised, numeric_exogenous_columns, parse_ratios
from gridtide.operators import clean, decompose, describe, distribution, forecast, models, relate, score, select, sequence, sifting
from gridtide.operators.position import index_series
from gridtide.operators.spectrum import classify_components, spectrum
from gridtide.plans.analysis import analysis_tables
from gridtide.session import scratch_folder, stored
from gridtide.sources import csv
from gridtide.sources.store import index_store, replace_months, write_store
from gridtide.sources.tables import analysis_scope, component_export, run_metadata, write_clean_series, write_forecast, write_table
from gridtide.streaming.cleaning import clean_stream

KEYS = S.KEYS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Digits kept per query; values are of the order of 1 to 1e4 unless a query says otherwise.
DIGITS: dict[str, int] = {}

# The 30-day hourly series hold 720 rows, so windows are shorter than the defaults.
# Trees are few and low there, because SQL grows them too.
SHORT = models.ForecastConfig(lookback=48, horizon=24, imf_components=3, exogenous=False, tree_rounds=5, tree_depth=4)
# The published settings: lookback 672, horizon 96, six components, calendar inputs.
DEFAULTS = models.ForecastConfig()


def tidy(df: DataFrame, digits: int) -> DataFrame:
    """Cut doubles to a grid whose steps are not at round numbers, so that tiny differences do not show."""
    scale = F.lit(float(10**digits))
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.floor(F.col(f"`{c}`") * scale + 0.47) / scale for c in doubles})


def query(name: str, digits: int = 5):
    def add(make):
        QUERIES[name] = lambda spark, folder: tidy(make(spark, folder), digits)
        DIGITS[name] = digits
        return make

    return add


# --- cleaning -----------------------------------------------------------------------------------


@query("c3_parse_ratios", 8)
def _(spark, folder):
    raw = S.dirty_events(spark, folder).select(F.col("时间").alias("when"), F.col("负荷").alias("what"), F.col("event_type").alias("kind"))
    wide = parse_ratios(raw)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__time").alias("time_ratio"), F.col(f"{c}__number").alias("number_ratio"))
        for c in raw.columns
    ])))


def typed(spark, folder):
    return clean.coerce_columns(S.dirty_events(spark, folder), "时间", "负荷", KEYS)


def unique(spark, folder):
    return clean.average_duplicates(clean.drop_invalid_times(typed(spark, folder)), KEYS)




@query("c3_integer_load")
def _(spark, folder):
    """Roles by content alone: whole numbers as text, left of dates with short years."""
    raw = S.table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("first"), F.date_format("o_orderdate", "yy-M-d").alias("second"))
    roles = infer_key_columns(raw)
    return clean.coerce_columns(raw, roles.timestamp, roles.load).select("timestamp", "load")


@query("c4_short_years")
def _(spark, folder):
    n = F.col("event_id") % 4
    text = F.when(n == 0, F.date_format("ts", "M/d/yy H:mm")).when(n == 1, F.date_format("ts", "yy-M-d")).when(n == 2, F.date_format("ts", "yyyyMMdd")).otherwise(F.col("event_id").cast("string"))
    raw = S.table(spark, folder, "events").select(text.alias("when"), F.col("event_id").cast("string").alias("what"))
    return clean.coerce_columns(raw, "when", "what").select("timestamp", "load")


query("c4_coerce_columns")(typed)
query("c5_drop_invalid_times")(lambda s, f: clean.drop_invalid_times(typed(s, f)).orderBy("timestamp"))
query("c6_average_duplicates")(unique)
query("c7_quality_report")(lambda s, f: clean.quality_report(typed(s, f), KEYS))
query("c8_interpolate_in_time")(lambda s, f: clean.interpolate_in_time(unique(s, f), KEYS))
query("c8_hourly_spine_filled")(S.hourly)


@query("clean_load_data")
def _(spark, folder):
    return clean.clean_load_data(S.dirty_events(spark, folder), "时间", "负荷", KEYS).frame


# --- calendar and selection ---------------------------------------------------------------------

query("p_calendar_features", 9)(lambda s, f: add_time_features(S.raw_events(s, f)))


@query("p10_year_week")
def _(spark, folder):
    orders = S.table(spark, folder, "orders")
    return orders.select("o_orderkey", year_week("o_orderdate").alias("year_week"))


@query("p11_range_label")
def _(spark, folder):
    return S.raw_events(spark, folder).groupBy("event_type").agg(range_label(F.min("timestamp"), F.max("timestamp")).alias("label"))


def _selection_row(df: DataFrame, selection: select.TimeRange) -> DataFrame:
    return df.filter(select.in_range(selection)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(selection.start).cast("timestamp_ntz").alias("start"),
        F.lit(selection.end).cast("timestamp_ntz").alias("end"),
        F.lit(selection.label).alias("label"),
        F.lit(selection.clipped).alias("clipped"),
    )


@query("t1_recent_range")
def _(spark, folder):
    df = S.raw_events(spark, folder)
    return _selection_row(df, select.resolve_time_range(df, mode="recent", recent_value=2, recent_unit="weeks"))


@query("t1_all_range")
def _(spark, folder):
    df = S.raw_events(spark, folder)
    return _selection_row(df, select.resolve_time_range(df, mode="all"))


@query("t2_clipped_range")
def _(spark, folder):
    df = S.raw_events(spark, folder)
    return _selection_row(df, select.resolve_time_range(df, mode="range", start="2023-12-01", end="2024-01-20 12:00"))


@query("t3_filter_by_time")
def _(spark, folder):
    df = S.raw_events(spark, folder)
    return select.filter_by_time(df, select.resolve_time_range(df, mode="range", start="2024-01-05", end="2024-01-14 23:45"))


@query("t4_peak_valley_hours")
def _(spark, folder):
    flags = {"is_peak": select.is_peak_hour(), "is_valley": select.is_valley_hour()}
    return S.raw_events(spark, folder).withColumns(flags)


@query("t1_series_ranges")
def _(spark, folder):
    """The last five weeks of each order priority, whose first and last days differ, and how many orders they hold."""
    # Some priorities are made to end early, so that ranges differ and one is too short.
    orders = S.priced_orders(spark, folder)
    cut = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1996-03-01")).when(F.col("o_orderpriority") == "5-LOW", F.lit("1995-01-05")).otherwise(F.lit("2100-01-01"))
    orders = orders.filter(F.col("timestamp") < cut.cast("timestamp_ntz"))
    ranges = select.resolve_time_ranges(orders, S.PRIORITY, mode="recent", recent_value=5, recent_unit="weeks")
    rows = select.filter_by_times(orders, ranges, S.PRIORITY).groupBy(*S.PRIORITY).agg(F.count(F.lit(1)).alias("rows"))
    return ranges.join(rows, S.PRIORITY, "left").na.fill(0, ["rows"])


@query("t5_china_holidays")
def _(spark, folder):
    """Order days with the public holidays of their years, by the calendar's rules."""
    return select.flag_holidays(S.daily_orders(spark, folder)).filter("is_holiday").groupBy("timestamp").agg(F.count(F.lit(1)).alias("series"))


@query("c1_normalised_names")
def _(spark, folder):
    """Part names with blanks put around them, as normalised."""
    parts = S.table(spark, folder, "part")
    return parts.select("p_partkey", normalised(F.concat(F.lit(" \t"), F.initcap("p_name"), F.lit("  "))).alias("name"))


query("t5_holiday_flag")(lambda s, f: select.flag_holidays(S.raw_events(s, f), S.holidays(s)))


@query("t8_one_day")
def _(spark, folder):
    from datetime import date

    return select.on_day(S.raw_events(spark, folder), date(2024, 1, 17))


# --- aggregates ---------------------------------------------------------------------------------

query("a1_basic_statistics")(lambda s, f: describe.basic_statistics(S.raw_events(s, f), KEYS))
query("a2_peak_valley")(lambda s, f: describe.peak_valley_metrics(S.raw_events(s, f), KEYS))
query("a3_monthly_volatility", 4)(lambda s, f: describe.monthly_volatility(S.priced_orders(s, f), S.PRIORITY))


def _scale(name: str):
    return lambda s, f: describe.describe_scale(add_time_features(S.priced_orders(s, f)), name, S.PRIORITY)


query("a4_yearly_statistics")(_scale("yearly"))
query("a5_monthly_statistics")(_scale("monthly"))
query("a6_weekly_statistics")(_scale("weekly"))
query("a7_daily_statistics")(lambda s, f: describe.describe_scale(add_time_features(S.raw_events(s, f)), "daily", KEYS))
query("a8_hourly_statistics")(lambda s, f: describe.describe_scale(add_time_features(S.raw_events(s, f)), "hourly", KEYS))
query("a9_month_profile")(lambda s, f: describe.month_profile(S.priced_orders(s, f), S.PRIORITY))


def _months(spark, folder):
    return S.priced_orders(spark, folder).withColumn("month", F.month("timestamp"))


query("a10_box_statistics")(lambda s, f: describe.box_statistics(_months(s, f), ["o_orderpriority", "month"]))
query("a10_event_box_statistics")(lambda s, f: describe.box_statistics(S.raw_events(s, f), KEYS))
query("a10_box_outliers")(lambda s, f: describe.box_outliers(S.raw_events(s, f), KEYS))
query("a11_weekpart_profile")(lambda s, f: describe.weekpart_profile(S.raw_events(s, f), KEYS))
query("a12_season_profile")(lambda s, f: describe.season_profile(add_time_features(S.priced_orders(s, f)), S.PRIORITY))


def indexed(spark, folder):
    return index_series(S.raw_events(spark, folder), KEYS)


def ramps(spark, folder):
    return relate.differences(indexed(spark, folder), KEYS)


query("a13_load_histogram")(lambda s, f: distribution.histogram(S.raw_events(s, f), "load", distribution.LOAD_BINS, KEYS))
query("a13_ramp_histogram")(lambda s, f: distribution.histogram(ramps(s, f), "ramp", distribution.DIFFERENCE_BINS, KEYS))
query("a13_diff2_histogram")(lambda s, f: distribution.histogram(ramps(s, f), "diff2", distribution.DIFFERENCE_BINS, KEYS))
query("a14_load_density")(lambda s, f: distribution.density(S.raw_events(s, f), "load", distribution.LOAD_BINS, KEYS))
query("a15_empirical_cdf", 7)(lambda s, f: distribution.empirical_cdf(S.raw_events(s, f), "load", KEYS))
query("a16_correlation_matrix", 8)(lambda s, f: relate.load_correlations(S.raw_events(s, f), KEYS))
query("a17_weather_correlation", 8)(lambda s, f: relate.weather_correlation(S.weather_hours(s, f), KEYS))
query("a18_sampling_hours", 8)(lambda s, f: relate.sampling_hours(S.raw_events(s, f), KEYS))

# --- sequences ----------------------------------------------------------------------------------

query("position_index")(lambda s, f: indexed(s, f))
query("w1_w2_differences")(lambda s, f: ramps(s, f).select("event_type", "timestamp", "ramp", "diff2"))
query("w3_lag_pairs")(lambda s, f: relate.lag_pairs(indexed(s, f), KEYS))
query("w4_autocorrelation", 8)(lambda s, f: relate.autocorrelation(S.raw_events(s, f), KEYS).drop("n"))
query("w5_partial_autocorrelation", 8)(
    lambda s, f: relate.partial_autocorrelation(relate.autocorrelation(S.raw_events(s, f), KEYS), KEYS)
)
query("w6_rolling_mean")(lambda s, f: sequence.rolling_mean(indexed(s, f), 48, KEYS).select("event_type", "timestamp", "smooth"))


@query("w7_spectrum")
def _(spark, folder):
    df = S.hourly(spark, folder)
    return spectrum(df, KEYS, hours=1.0)


@query("w7_event_spectrum")
def _(spark, folder):
    df = S.raw_events(spark, folder)
    return spectrum(df, KEYS, hours=None)


@query("w8_sliding_windows")
def _(spark, folder):
    rows = sequence.sliding_windows(indexed(spark, folder), 24, 6, KEYS)
    text = lambda c: F.array_join(F.transform(c, lambda v: F.floor(v * 1000 + 0.47).cast("string")), " ")
    return rows.select("event_type", "origin_idx", text("x").alias("x"), text("y").alias("y"))


def split(spark, folder):
    return sequence.with_split(indexed(spark, folder), 0.8, 48, 24)


@query("w9_split")
def _(spark, folder):
    rows = split(spark, folder)
    return rows.groupBy("event_type", "n", "split_idx").agg(
        F.count_if(F.col("idx") < F.col("split_idx")).alias("train_rows"),
        F.count_if(F.col("idx") >= F.col("split_idx") - 48).alias("context_rows"),
    )


query("a27_scaling_table")(lambda s, f: sequence.scaling_table(split(s, f), ["load"], KEYS))
query("w10_standardise", 7)(
    lambda s, f: sequence.standardise(split(s, f), ["load"], KEYS).select("event_type", "timestamp", F.col("load").alias("z"))
)


@query("a28_impute_means")
def _(spark, folder):
    gaps = S.hourly_gaps(spark, folder)
    return sequence.impute_means(gaps, ["load"], KEYS)


# --- decomposition ------------------------------------------------------------------------------


def _parts(spark, folder):
    return decompose.decompose(indexed(spark, folder), KEYS)


query("d1_decompose")(lambda s, f: _parts(s, f).drop("n", "idx"))


@query("d1_sifting")
def _(spark, folder):
    """Components by sifting; envelopes through all extrema are beyond SQL, so this has none."""
    return sifting.sift_components(indexed(spark, folder), KEYS, max_components=4, sifts=4).drop("n", "idx")


@query("d1_sifting_extrema")
def _(spark, folder):
    """The minima and maxima that the first envelopes go through, by series."""
    rounded = indexed(spark, folder).withColumn("load", F.floor("load"))
    return sifting.extrema(rounded, KEYS)


@query("d1_decompose_with_gaps")
def _(spark, folder):
    gaps = S.table(spark, folder, "events").select("event_type", F.col("ts").alias("timestamp"), F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("load"))
    return decompose.decompose(index_series(gaps, KEYS), KEYS).drop("n", "idx")


query("d2_component_frame")(lambda s, f: decompose.component_frame(indexed(s, f), 6, KEYS).drop("n", "idx"))
query("d3_bounded_component_frame")(lambda s, f: decompose.bounded_component_frame(indexed(s, f), 3, KEYS).drop("n", "idx"))


@query("d4_component_classes", 4)
def _(spark, folder):
    parts = decompose.decompose(index_series(S.hourly(spark, folder), KEYS), KEYS)
    names = decompose.component_names(parts)
    return classify_components(stored(decompose.components_long(parts, names, ["event_type", "idx", "n"])), KEYS)


@query("d5_reconstruct_bands")
def _(spark, folder):
    parts = decompose.component_frame(indexed(spark, folder), 6, KEYS)
    bands = decompose.reconstruct_bands(parts, decompose.component_names(parts))
    return bands.select("event_type", "timestamp", "load", "high", "mid", "low", "trend")


@query("d6_components_long")
def _(spark, folder):
    parts = decompose.component_frame(indexed(spark, folder), 6, KEYS)
    return decompose.components_long(parts, decompose.component_names(parts), ["event_type", "timestamp"])


@query("a25_a26_component_energy", 4)
def _(spark, folder):
    parts = _parts(spark, folder)
    return decompose.component_energy(parts, decompose.component_names(parts), KEYS)


# --- forecasting --------------------------------------------------------------------------------


def prepared(spark, folder, cfg=SHORT):
    df = S.hourly(spark, folder)
    return forecast.prepare(add_time_features(df) if cfg.exogenous else df, cfg, KEYS)


def _component_forecasts(spark, folder):
    return forecast.component_forecasts(prepared(spark, folder), list(models.MODELS))


def event_series(spark, folder):
    """The raw events, prepared at the published settings."""
    return forecast.prepare(add_time_features(S.raw_events(spark, folder)), DEFAULTS, KEYS)


@query("f1_scaled_features", 6)
def _(spark, folder):
    """Scaled components with all thirteen scaled calendar inputs."""
    series = event_series(spark, folder)
    long = forecast.scaled_components(series)
    return long.select("event_type", "idx", "component", "z", *[F.element_at("exog", i + 1).alias(c) for i, c in enumerate(series.exogenous)])


query("w11_f2ab_component_forecasts")(_component_forecasts)
query("f4_component_metrics", 4)(lambda s, f: forecast.component_metrics(_component_forecasts(s, f), KEYS))


def single(spark, folder, model="seasonal_naive"):
    return forecast.run_single(prepared(spark, folder), model)


query("f4_f8_single_forecast")(lambda s, f: single(s, f).forecast.drop("n"))
query("a19_forecast_metrics", 4)(lambda s, f: score.metrics_long(single(s, f).metrics, KEYS))
query("a20_error_metrics", 4)(
    lambda s, f: score.metrics(single(s, f, "moving_average").forecast, KEYS, names=("RMSE", "MAE", "MAPE"))
)


def hybrid(spark, folder):
    return forecast.run_hybrid(prepared(spark, folder))


query("f5_model_selection", 4)(lambda s, f: hybrid(s, f).selection)
query("f5_hybrid_forecast")(lambda s, f: hybrid(s, f).forecast.drop("n"))


@query("f6_best_method", 4)
def _(spark, folder):
    return forecast.run_best(prepared(spark, folder)).best_method


def fused(spark, folder):
    series = prepared(spark, folder)
    return forecast.fuse_components(forecast.component_forecasts(series, list(models.MODELS)), [*KEYS, "model"])


query("f9_model_comparison", 4)(lambda s, f: forecast.compare_models(fused(s, f), KEYS))
query("f9_comparison_long", 4)(lambda s, f: forecast.comparison_long(forecast.compare_models(fused(s, f), KEYS), KEYS))
query("f9_best_model")(lambda s, f: forecast.best_of(forecast.compare_models(fused(s, f), KEYS), KEYS))


@query("f10_strategy_metrics", 4)
def _(spark, folder):
    return forecast.run_model_comparison(S.hourly(spark, folder), SHORT, KEYS)[0]


@query("f10_strategy_comparison", 4)
def _(spark, folder):
    return forecast.run_model_comparison(S.hourly(spark, folder), SHORT, KEYS)[1]


@query("f10_best_forecast")
def _(spark, folder):
    return forecast.run_model_comparison(S.hourly(spark, folder), SHORT, KEYS)[2].drop("n")


@query("f11_fusion_comparison", 4)
def _(spark, folder):
    results = fused(spark, folder)
    mean = results.groupBy(*KEYS, "idx").agg(F.avg("actual_load").alias("actual_load"), F.avg("predicted_load").alias("predicted_load"))
    return forecast.compare_models(forecast.add_fusion_result(results, mean), KEYS)


# SQL follows these at the published settings; trees of that size take it too long.
BUT_TREES = ("seasonal_naive", "moving_average", "linear")


@query("f4_event_forecast")
def _(spark, folder):
    return forecast.run_single(event_series(spark, folder), "moving_average").forecast.drop("n")


@query("f5_event_selection", 4)
def _(spark, folder):
    return forecast.run_hybrid(event_series(spark, folder), models=BUT_TREES).selection


@query("f6_event_best", 4)
def _(spark, folder):
    return forecast.run_best(event_series(spark, folder), BUT_TREES).best_method


@query("f6_event_best_of_all", 4)
def _(spark, folder):
    """All four models at the published settings, trees too: the scores of every method and the one chosen."""
    best = forecast.run_best(event_series(spark, folder))
    every = forecast.method_scores(best.candidates, KEYS).drop("place")
    return every.join(best.best_method.select(*KEYS, F.col("best_method").alias("method"), F.lit(True).alias("chosen")), [*KEYS, "method"], "left").na.fill(False, ["chosen"])


@query("f7_dispatch")
def _(spark, folder):
    """The method name ignores case and leads to the single model."""
    cfg = dataclasses.replace(SHORT, exogenous=False)
    return forecast.run_forecast(S.hourly(spark, folder), cfg, "Seasonal_Naive", KEYS).forecast.drop("n")


@query("f2c_normal_matrix", 4)
def _(spark, folder):
    """The sums that the linear model is solved from, by component and place in the matrix."""
    series = prepared(spark, folder)
    sums = models.normal_equations(forecast.training_windows(series), series.config, KEYS)
    return sums.select("event_type", "component", F.posexplode("gram").alias("pos", "v"))


@query("t7_exogenous_columns")
def _(spark, folder):
    """The model inputs found in a table, each with its sum."""
    df = add_time_features(S.raw_events(spark, folder)).withColumn("note", F.lit("text"))
    names = numeric_exogenous_columns(df, KEYS)
    sums = df.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in names])
    return sums.unpivot([], names, "column", "total")


def _network(name):
    # Twenty steps for each network: enough to move, few enough for a check of every query.
    make = lambda s, f: forecast.run_single(prepared(s, f, dataclasses.replace(SHORT, net_steps=20)), name).forecast.drop("n")
    query(f"f2_{name}_forecast")(make)


for _name in models.SERIES_MODELS:
    _network(_name)


@query("f3_registry")
def _(spark, folder):
    """Every registered model, found by its name in capitals, and the rows it predicts of each series and component."""
    series = prepared(spark, folder)
    found = forecast.component_forecasts(series, [m.upper() for m in models.MODELS])
    return found.groupBy(*KEYS, "component", "model").agg(F.count("predicted").alias("rows"), F.min("idx").alias("first_row"))


query("f12_error_analysis_rows")(lambda s, f: score.for_error_analysis(single(s, f).forecast).drop("n", "idx"))
query("f13_last_rows")(lambda s, f: forecast.last_week(single(s, f).forecast, 7 * 24).drop("n", "idx"))
query("f13_last_event_rows")(lambda s, f: forecast.last_week(indexed(s, f)).drop("n"))
query("f2c_linear_forecast", 4)(lambda s, f: forecast.run_single(event_series(s, f), "linear").forecast.drop("n"))


@query("f2cd_learned_coverage")
def _(spark, folder):
    """Every test row of every series has one prediction of each learned model, next to the true value."""
    series = prepared(spark, folder)
    found = forecast.component_forecasts(series, ("linear", "gbt"))
    fused = forecast.fuse_components(found, [*KEYS, "model"])
    return fused.select(*KEYS, "model", "idx", "actual_load", (F.col("predicted_load").isNotNull() & ~F.isnan("predicted_load")).alias("predicted"))


query("f2d_gbt_forecast")(lambda s, f: forecast.run_single(prepared(s, f), "gbt").forecast.drop("n"))
query("f2d_event_forecast")(lambda s, f: forecast.run_single(event_series(s, f), "gbt").forecast.drop("n"))

# --- error analysis -----------------------------------------------------------------------------


def errors(spark, folder):
    return score.for_error_analysis(single(spark, folder).forecast)


query("a21_period_error_stats", 4)(lambda s, f: score.period_error_stats(errors(s, f), KEYS))
query("a22_holiday_error_stats", 4)(lambda s, f: score.holiday_error_stats(errors(s, f), S.holidays(s), KEYS))
query("a23_period_error_box")(lambda s, f: describe.box_statistics(score.period_rows(errors(s, f)), [*KEYS, "period"], "error"))
query("a23_day_type_error_box")(
    lambda s, f: describe.box_statistics(score.with_day_type(errors(s, f), S.holidays(s)), [*KEYS, "day_type"], "error")
)
query("a13_error_histogram")(lambda s, f: distribution.histogram(errors(s, f), "error", distribution.ERROR_BINS, KEYS))
query("a24_error_qq")(lambda s, f: distribution.normal_qq(errors(s, f), "error", KEYS))
query("a24_event_qq_fit", 4)(
    lambda s, f: distribution.normal_qq_fit(distribution.normal_qq(S.raw_events(s, f), "load", KEYS), KEYS)
)

# --- tables -------------------------------------------------------------------------------------

query("io8_analysis_scope")(lambda s, f: analysis_scope(S.raw_events(s, f), "all data"))


@query("io9_filtered_data")
def _(spark, folder):
    """The filtered table of an analysis run, read back."""
    df = S.raw_events(spark, folder)
    chosen = df.filter(select.in_range(select.resolve_time_range(df, mode="recent", recent_value=2, recent_unit="weeks")))
    made = analysis_tables(add_time_features(chosen), "recent", KEYS)["filtered_load_data"]()
    raw = spark.read.option("header", "true").csv(write_table(made, scratch_folder(spark, "filtered"), "csv"))
    return raw.select("event_type", F.col("timestamp").cast("timestamp_ntz"), F.col("load").cast("double"))


@query("io10_without_residual")
def _(spark, folder):
    parts = decompose.component_frame(indexed(spark, folder), 3, KEYS)
    path = write_table(component_export(parts, decompose.component_names(parts), KEYS, None), scratch_folder(spark, "imfs"), "csv")
    raw = spark.read.option("header", "true").csv(path)
    return raw.select("event_type", F.col("timestamp").cast("timestamp_ntz"), *[F.col(c).cast("double") for c in raw.columns if c.startswith("IMF")])


@query("io10_component_export")
def _(spark, folder):
    parts = decompose.component_frame(indexed(spark, folder), 3, KEYS)
    return component_export(parts, decompose.component_names(parts), KEYS)


def _written(spark, folder, encoding="UTF-8"):
    path = scratch_folder(spark, "events")
    S.dirty_events(spark, folder).write.option("header", "true").option("encoding", encoding).csv(path)
    return path


@query("io1_io3_csv_encodings")
def _(spark, folder):
    """Every row that was written, counted by the encoding found for its file."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    root = scratch_folder(spark, "files")
    for name in ("UTF-8", "GB18030"):
        S.dirty_events(spark, folder).write.option("header", "true").option("encoding", name).csv(f"{root}/{name}")
    listed = csv.find_csv_files(spark, root).select(F.element_at(F.split("path", "/"), -2).alias("written_as"), F.element_at(F.split("path", "/"), -1).alias("name"))
    # Paths of the two listings differ in their scheme prefix, so files are matched by name and folder.
    kinds = csv.detect_encodings(spark, f"{root}/*").select(F.element_at(F.split("path", "/"), -2).alias("written_as"), F.element_at(F.split("path", "/"), -1).alias("name"), "encoding", "multiline")
    lines = spark.read.text(f"{root}/*").select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg((F.count(F.lit(1)) - 1).alias("rows"))
    lines = lines.select(F.element_at(F.split("path", "/"), -2).alias("written_as"), F.element_at(F.split("path", "/"), -1).alias("name"), "rows")
    return kinds.join(listed, ["written_as", "name"]).join(lines, ["written_as", "name"]).groupBy("written_as", "encoding", "multiline").agg(F.sum("rows").alias("rows"))


@query("io2_choose_primary")
def _(spark, folder):
    """The rows of the file chosen among three folders: `data` wins over size."""
    root = scratch_folder(spark, "tree")
    S.raw_events(spark, folder).coalesce(1).write.option("header", "true").csv(f"{root}/big")
    S.raw_events(spark, folder).filter("event_type = 'click'").coalesce(1).write.option("header", "true").csv(f"{root}/data/small")
    S.raw_events(spark, folder).coalesce(1).write.option("header", "true").csv(f"{root}/outputs/data")
    raw, encoding = csv.load_csv(spark, csv.choose_primary_dataset(spark, root))
    return raw.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).withColumn("encoding", F.lit(encoding))


@query("io4_quoted_breaks")
def _(spark, folder):
    path = scratch_folder(spark, "quoted")
    note = F.concat(F.lit("a \"note\"\nof "), F.col("event_id").cast("string"))
    S.table(spark, folder, "events").select("event_type", F.col("ts").cast("string").alias("time"), note.alias("note"), F.col("value").alias("load")).write.option("header", "true").option("escape", '"').csv(path)
    raw, _ = csv.load_csv(spark, path)
    return raw.select("event_type", F.col("note"), F.col("load").cast("double").alias("load"))


@query("io4_doubled_quotes")
def _(spark, folder):
    """Commas, inner quotes and empty quotes, in files of one folder with and without breaks in quotes."""
    root = scratch_folder(spark, "doubled")
    events = S.table(spark, folder, "events")
    plain = F.when(F.col("event_id") % 6 == 0, "").otherwise(F.concat(F.lit('a "b", c "'), F.col("event_id").cast("string"), F.lit('"')))
    broken = F.concat(F.lit('"x", '), F.col("event_id").cast("string"), F.lit(',\n"",\n'))
    for name, rest, note in (("plain", 0, plain), ("broken", 1, broken)):
        rows = events.filter(F.col("event_id") % 2 == rest).select(F.col("ts").cast("string").alias("time"), note.alias("note"), F.col("value").alias("load"), "event_type")
        rows.write.option("header", "true").option("escape", '"').options(emptyValue='""', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(f"{root}/{name}")
    raw, _ = csv.load_csv(spark, f"{root}/*")
    return raw.select("event_type", "note", F.col("time").cast("timestamp_ntz").alias("timestamp"), F.col("load").cast("double").alias("load"))


@query("io2_io4_load_csv")
def _(spark, folder):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    raw, _ = csv.load_csv(spark, _written(spark, folder, "GB18030"))
    roles = infer_key_columns(raw, ("event_type",))
    return clean.coerce_columns(raw, roles.timestamp, roles.load, KEYS)


@query("io5_clean_table")
def _(spark, folder):
    path = write_clean_series(add_time_features(S.raw_events(spark, folder)), scratch_folder(spark, "clean"), KEYS)
    return spark.read.parquet(path)


@query("io5_csv_with_mark")
def _(spark, folder):
    path = write_table(S.raw_events(spark, folder), scratch_folder(spark, "marked"), "csv", bom=True)
    raw, _ = csv.load_csv(spark, path)
    return clean.coerce_columns(raw, "timestamp", "load", KEYS)


@query("io6_run_metadata")
def _(spark, folder):
    df = S.raw_events(spark, folder)
    selection = select.resolve_time_range(df, mode="recent", recent_value=2, recent_unit="weeks")
    rows = df.filter(select.in_range(selection))
    return run_metadata(rows, "events", "utf-8", "ts", "value", selection)


@query("io11_forecast_artifacts", 4)
def _(spark, folder):
    target = scratch_folder(spark, "forecast")
    write_forecast(single(spark, folder), target, KEYS)
    return spark.read.schema("event_type string, metric string, value double").option("header", "true").csv(f"{target}/seasonal_naive_metrics")


@query("io11_artifact_tables", 4)
def _(spark, folder):
    """The numbers of every table that a hybrid run writes, added up by table, series and column."""
    target = scratch_folder(spark, "forecast")
    write_forecast(hybrid(spark, folder), target, KEYS)
    read = spark.read.option("header", "true")
    tables = {"forecast": read.csv(f"{target}/hybrid_forecast"), "metrics_json": spark.read.json(f"{target}/hybrid_metrics_json"), "component_metrics": read.csv(f"{target}/hybrid_component_metrics"), "selection": read.csv(f"{target}/imf_model_selection")}
    out = None
    for name, df in tables.items():
        numbers = [c for c in df.columns if c in ("actual_load", "predicted_load", "MAE", "RMSE", "MAPE", "R2")]
        sums = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(c).cast("double")).alias(c) for c in numbers])
        long = sums.unpivot(["event_type", "rows"], numbers, "column", "total").withColumn("table", F.lit(name))
        out = long if out is None else out.unionByName(long)
    return out


@query("io11_best_forecasts", 4)
def _(spark, folder):
    """Every row of the forecast tables that a best run writes: its own, one for each model, and the hybrid's."""
    target = scratch_folder(spark, "forecast")
    write_forecast(forecast.run_best(prepared(spark, folder)), target, KEYS)
    out = None
    for name in ("best", "hybrid", *models.MODELS):
        df = spark.read.option("header", "true").csv(f"{target}/{name}_forecast").select(
            F.lit(name).alias("table"), "event_type", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), *[F.col(c).cast("double").alias(c) for c in ("actual_load", "predicted_load", "error")]
        )
        out = df if out is None else out.unionByName(df)
    return out


@query("io11_best_scores", 4)
def _(spark, folder):
    """Every row of its score tables: of the methods, of their components, of the selection, and of the best."""
    target = scratch_folder(spark, "forecast")
    write_forecast(forecast.run_best(prepared(spark, folder)), target, KEYS)
    csv_, json_ = (lambda n: spark.read.option("header", "true").csv(f"{target}/{n}")), (lambda n: spark.read.json(f"{target}/{n}"))
    tables = {f"{m}_metrics_json": json_(f"{m}_metrics_json") for m in ("best", "hybrid", *models.MODELS)}
    tables |= {f"{m}_component_metrics": csv_(f"{m}_component_metrics").drop("model", "selected_model") for m in ("hybrid", *models.MODELS)}
    tables |= {"imf_model_selection": csv_("imf_model_selection"), "best_method_metrics": json_("best_method_metrics")}
    out = None
    for name, df in tables.items():
        chosen = next((F.col(c) for c in ("selected_model", "best_method") if c in df.columns), F.lit(None).cast("string"))
        part = F.col("component") if "component" in df.columns else F.lit(None).cast("string")
        rows = df.select(F.lit(name).alias("table"), "event_type", part.alias("component"), chosen.alias("chosen"), *[F.col(m).cast("double").alias(m) for m in ("MAE", "RMSE", "MAPE", "R2")])
        out = rows if out is None else out.unionByName(rows)
    return out


@query("c6_c8_stream_cleaning")
def _(spark, folder):
    """The dirty events as a stream: what is final when the stream has been read, an hour before its latest time."""
    typed = clean.coerce_columns(S.dirty_events(spark, folder), "时间", "负荷", KEYS).select("event_type", "timestamp", "load")
    source, target = scratch_folder(spark, "stream"), scratch_folder(spark, "cleaned")
    typed.write.parquet(source)
    stream = spark.readStream.schema(typed.schema).parquet(source)
    writer = clean_stream(stream, KEYS, "1 hour", 24.0 * 365).writeStream.format("parquet").outputMode("append")
    writer.option("checkpointLocation", scratch_folder(spark, "state")).trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.schema("event_type string, timestamp timestamp_ntz, load double, filled boolean").parquet(target)


@query("io5_store_positions")
def _(spark, folder):
    """Order days from a bucketed store, one of whose months came late and was put in its place."""
    path = scratch_folder(spark, "store")
    name, days = f"orders_{path[-32:]}", S.daily_orders(spark, folder)
    late = (F.year("timestamp") == 1995) & (F.month("timestamp") == 3)
    write_store(days.withColumn("load", F.when(late, -F.col("load")).otherwise(F.col("load"))), name, path, S.PRIORITY, buckets=8)
    replace_months(days.filter(late), name, S.PRIORITY)
    spark.catalog.refreshTable(name)
    return index_store(spark.table(name), S.PRIORITY)
