import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import decompose, forecast as fc, models, score
from tests.helpers import frame, pandas_of, times, walk
from tests.test_series_operators import _cascade

CFG = models.ForecastConfig(lookback=30, horizon=6, imf_components=2, exogenous=False, tree_rounds=2, tree_depth=2, block_rows=64)


@pytest.fixture(scope="module")
def two(spark):
    return frame(spark, {"a": walk(260, 1), "b": walk(200, 2)}, {"a": times(260), "b": times(200)})


@pytest.fixture(scope="module")
def series(two):
    return fc.prepare(two, CFG, ["k"])


@pytest.fixture(scope="module")
def plain(series):
    return fc.materialise(fc.component_forecasts(series, ["seasonal_naive", "moving_average"]))


def _brute(component, predict):
    """Every window of the test rows in turn, overlapping steps averaged."""
    n, look, ahead = len(component), CFG.lookback, CFG.horizon
    split = max(int(n * CFG.train_ratio), look + ahead)
    total, hits = np.zeros(n - split), np.zeros(n - split)
    for i in range(n - split - ahead + 1):
        past = component[split - look + i : split + i]
        total[i : i + ahead] += predict(past)
        hits[i : i + ahead] += 1
    assert (hits > 0).all()
    return split, total / hits


@pytest.mark.parametrize("model, predict", [
    ("seasonal_naive", lambda past: past[-CFG.horizon:]),
    ("moving_average", lambda past: np.full(CFG.horizon, past[-CFG.horizon:].mean())),
])
def test_plain_models_match_brute_force(plain, model, predict):
    got = pandas_of(plain.filter(F.col("model") == model), "k", "component", "idx")
    for key, n, seed in (("a", 260, 1), ("b", 200, 2)):
        load = walk(n, seed)
        parts = _cascade(load, 10)[:2]
        for name, part in (("imf_1", parts[0]), ("imf_2", parts[1]), ("residual", load - sum(parts))):
            mine = got[(got["k"] == key) & (got["component"] == name)]
            split, want = _brute(part, predict)
            assert mine["idx"].tolist() == list(range(split, n))
            assert np.allclose(mine["predicted"], want) and np.allclose(mine["actual"], part[split:])


def test_fused_forecast_and_metrics(two, series, plain):
    result = fc.run_single(series, "moving_average", plain)
    table = pandas_of(result.forecast, "k", "timestamp")
    load = np.concatenate([walk(260, 1)[208:], walk(200, 2)[160:]])
    assert np.allclose(table["actual_load"], load)
    assert np.allclose(table["error"], table["actual_load"] - table["predicted_load"])
    row = result.metrics.filter("k = 'b'").first()
    mine = table[table["k"] == "b"]
    y, e = mine["actual_load"], mine["error"]
    assert np.isclose(row["MAE"], e.abs().mean()) and np.isclose(row["RMSE"], np.sqrt((e**2).mean()))
    assert np.isclose(row["MAPE"], 100 * (e / y).abs().mean()) and np.isclose(row["R2"], 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    last = fc.last_week(result.forecast, 5)
    assert last.count() == 10


def test_hybrid_is_never_worse_by_component(series, plain):
    result = fc.run_hybrid(series, plain, ["seasonal_naive", "moving_average"])
    best = {(r["k"], r["component"]): r["RMSE"] for r in result.selection.collect()}
    for r in fc.component_metrics(plain, ["k"]).collect():
        assert best[r["k"], r["component"]] <= r["RMSE"] * (1 + 1e-12)


def test_ties_follow_the_registry_order(spark):
    rows = [("c", m, 1.0, 2.0, 3.0, 0.0) for m in ("moving_average", "seasonal_naive")]
    scores = spark.createDataFrame(rows, "component string, model string, MAE double, RMSE double, MAPE double, R2 double")
    assert fc.select_models(scores).first()["selected_model"] == "seasonal_naive"
    near = scores.withColumn("RMSE", F.when(F.col("model") == "moving_average", F.col("RMSE") - 4e-16).otherwise(F.col("RMSE")))
    assert fc.select_models(near).first()["selected_model"] == "seasonal_naive"


def test_linear_matches_dense_solution(two):
    cfg = models.ForecastConfig(lookback=30, horizon=4, imf_components=1, exogenous=False, ridge=1e-9, block_rows=50)
    series = fc.prepare(two, cfg, ["k"])
    got = pandas_of(fc.component_forecasts(series, ["linear"]).filter("k = 'b' AND component = 'imf_1'"), "idx")
    part = _cascade(walk(200, 2), 10)[0]
    split, center, scale = 160, part[:160].mean(), part[:160].std() + 1e-8
    z = (part - center) / scale

    def design(o):
        base = [1.0, z[o], z[o - 1], z[o - 3 : o + 1].mean()]
        return [[*base, z[o + h - 4], h / 4] for h in range(1, 5)]

    x = np.array([row for o in range(29, 160 - 4) for row in design(o)])
    y = np.array([z[o + h] for o in range(29, 160 - 4) for h in range(1, 5)])
    beta = np.linalg.solve(x.T @ x + 1e-9 * len(x) * np.eye(6), x.T @ y)
    total, hits = np.zeros(40), np.zeros(40)
    for o in range(159, 200 - 4):
        total[o - 159 : o - 155] += np.array(design(o)) @ beta
        hits[o - 159 : o - 155] += 1
    assert np.allclose(got["predicted"], total / hits * scale + center, atol=1e-6)


def test_every_method_runs(two):
    cfg = models.ForecastConfig(lookback=24, horizon=6, imf_components=1, tree_rounds=1, tree_depth=2)
    best = fc.run_forecast(two, cfg, "BEST", ["k"])
    assert best.method == "best" and best.forecast.count() == 92
    scores = {r["k"]: r for r in best.best_method.collect()}
    assert set(scores) == {"a", "b"} and all(r["best_method"] in [*models.MODELS, "hybrid"] for r in scores.values())
    assert {r["k"]: round(r["RMSE"], 9) for r in best.metrics.collect()} == {k: round(r["RMSE"], 9) for k, r in scores.items()}


def test_comparison_run(two):
    table, comparison, final = fc.run_model_comparison(two, CFG, ["k"], ["seasonal_naive", "moving_average"])
    assert table.count() == 4 and {r["model"] for r in comparison.collect()} == {"EMD+SEASONAL_NAIVE", "EMD+MOVING_AVERAGE"}
    best = {r["k"]: r["best_model"] for r in fc.best_of(comparison, ["k"]).collect()}
    assert {r["k"]: r["strategy"].upper() for r in final.select("k", "strategy").distinct().collect()} == best


def test_bad_requests(two):
    with pytest.raises(ValueError):
        fc.run_forecast(two, CFG, "prophet", ["k"])
    with pytest.raises(ValueError):
        models.find_model("none")
    with pytest.raises(ValueError):  # no series is long enough
        fc.prepare(two, models.ForecastConfig(lookback=250, horizon=20, exogenous=False), ["k"])
    with pytest.raises(ValueError):
        fc.prepare(two, models.ForecastConfig(lookback=10, horizon=20), ["k"])


def test_short_series_are_listed_and_the_others_go_on(two, tmp_path):
    from gridtide.sources.tables import write_forecast

    cfg = models.ForecastConfig(lookback=190, horizon=20, imf_components=1, exogenous=False)
    series = fc.prepare(two, cfg, ["k"])
    assert [tuple(r) for r in series.rejected.collect()] == [("b", 200)]
    best = fc.run_best(series, ["seasonal_naive", "moving_average"])
    assert {r["k"] for r in best.forecast.select("k").distinct().collect()} == {"a"}
    written = {p.rsplit("/", 1)[1] for p in write_forecast(best, str(tmp_path), ["k"])}
    assert {"rejected_series", "best_forecast", "seasonal_naive_forecast", "moving_average_forecast", "hybrid_forecast", "hybrid_component_metrics"} <= written


def test_user_model(two):
    @models.register_model("zero")
    def zero(train, test, cfg, keys):
        return models.per_step(test, F.array_repeat(F.lit(0.0), cfg.horizon), keys)

    try:
        got = fc.run_single(fc.prepare(two, CFG, ["k"]), "ZERO")
        assert got.forecast.count() == 92
    finally:
        models.MODELS.pop("zero")


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(0.0, 1.0), (5e-9, 1.0), (2.0, 1.0)], "actual_load double, predicted_load double")
    assert np.isclose(score.metrics(df).first()["MAPE"], 50.0)
    flat = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "actual_load double, predicted_load double")
    assert score.metrics(flat).first()["R2"] is None


def test_windows_are_cut_from_runs_and_never_written(two, monkeypatch):
    """Runs of any length give the same forecasts; no stored table has windows, and models give a row per target, not per step."""
    written, keep = [], fc.stored

    def recording(df, *args):
        written.append(df.columns)
        return keep(df, *args)

    monkeypatch.setattr(fc, "stored", recording)
    found = []
    for rows in (models.RUN_ROWS, 17):
        monkeypatch.setattr(models, "RUN_ROWS", rows)
        series = fc.prepare(two, CFG, ["k"])
        table = pandas_of(fc.component_forecasts(series, ["seasonal_naive", "moving_average", "linear"]), "k", "component", "model", "idx")
        found.append(table)
    assert not any("truth" in c or "season" in c for c in written)
    assert found[0].drop(columns=["actual", "predicted"]).equals(found[1].drop(columns=["actual", "predicted"]))
    assert np.allclose(found[0][["actual", "predicted"]], found[1][["actual", "predicted"]])
    steps = models.MODELS["linear"](fc.training_windows(series), fc.testing_windows(series), CFG, ["k"])
    hits = steps.agg(F.sum("hits")).first()[0]
    assert hits == 3 * CFG.horizon * ((260 - 208 - 5) + (200 - 160 - 5)) and steps.count() < hits / 3


def test_unknown_values_are_passed_over(spark):
    """A window near a gap reaches further back; its last steps are missing where the values end."""
    load = walk(120, 5).tolist()
    rows = [("a", t, None if i in (40, 41, 119) else v) for i, (t, v) in enumerate(zip(times(120), load))]
    cfg = models.ForecastConfig(lookback=10, horizon=4, imf_components=1, exogenous=False, period=6, block_rows=32)
    series = fc.prepare(spark.createDataFrame(rows, "k string, timestamp timestamp_ntz, load double"), cfg, ["k"])
    z = {r["idx"]: r["z"] for r in series.scaled.filter("component = 'imf_1'").collect()}
    known = sorted(z)
    windows = {r["origin_idx"]: r for r in fc.training_windows(series).filter("component = 'imf_1'").collect()}
    assert sorted(windows) == [i for i in known if 9 <= i <= 95 - 4]
    for o in (39, 42, 44, 91):
        p = known.index(o)
        assert windows[o]["season"] == [z[i] for i in known[p - 5 : p - 1]]
        assert windows[o]["truth"] == [z[i] for i in known[p + 1 : p + 5] if i < 96]
        assert windows[o]["features"][:3] == [1.0, z[o], z[known[p - 1]]]
        assert np.isclose(windows[o]["mean_recent"], np.mean([z[i] for i in known[p - 3 : p + 1]]))
    last = max(r["idx"] for r in fc.component_forecasts(series, ["seasonal_naive"]).filter("component = 'imf_1'").collect())
    assert last in (118, 119)
