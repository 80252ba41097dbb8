import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import forecast as fc, models, neural, tape
from tests.helpers import frame, pandas_of, times, walk

CFG = models.ForecastConfig(lookback=16, horizon=3, imf_components=1, exogenous=False, net_steps=3, net_rows=40)


def numeric(f, p, name, at):
    out = []
    for e in (1e-6, -1e-6):
        q = {k: v.copy() for k, v in p.items()}
        q[name][at] += e
        out.append(f(q))
    return (out[0] - out[1]) / 2e-6


@pytest.mark.parametrize("name", list(neural.NETWORKS))
def test_gradients(name):
    """Against small changes of single parameters."""
    network, rng = neural.NETWORKS[name], np.random.default_rng(1)
    x = rng.normal(size=(2, 30, 3))
    z, origin = x[:, :, 0], np.zeros((2, 30), bool)
    origin[0, 15:27], origin[1, 18:20] = True, True
    p = neural.random_params(network.shapes(16, 3, 3), 5)
    p = {k: v + rng.normal(0, 0.1, v.shape) for k, v in p.items()}
    value = lambda q: float(neural.loss(network, {k: tape.Var(v) for k, v in q.items()}, x, z, origin, CFG)[0].value)
    held = {k: tape.Var(v) for k, v in p.items()}
    total, n = neural.loss(network, held, x, z, origin, CFG)
    total.gradient()
    assert n == 14 * 3
    for k, v in p.items():
        for at in [tuple(rng.integers(s) for s in v.shape) for _ in range(4)]:
            assert np.isclose(held[k].grad[at], numeric(value, p, k, at), rtol=1e-4, atol=1e-5), (k, at)


def test_no_network_looks_ahead():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1, 50, 2))
    later = x.copy()
    later[:, 31:] += 5
    for name, network in neural.NETWORKS.items():
        p = {k: tape.Var(v) for k, v in neural.random_params(network.shapes(16, 3, 2), 1).items()}
        a, b = (network.forward(p, v, 16, 3).value for v in (x, later))
        assert a.shape == (1, 50, 3) and np.allclose(a[:, :31], b[:, :31]) and not np.allclose(a[:, 31:], b[:, 31:]), name


def test_lags_and_delayed_averages():
    """Against autocorrelations added up one by one."""
    rng = np.random.default_rng(3)
    t = np.arange(80)
    z = np.sin(2 * np.pi * t / 7) + 0.1 * rng.normal(size=80)
    window = neural.windows_of(z, 30)[40:45]
    lags, share = neural.best_lags(window, 9)
    for w, found, parts in zip(window, lags, share):
        c = w - w.mean()
        plain = {k: (c[k:] * c[: len(c) - k]).sum() / (c * c).sum() * 30 / (30 - k) for k in range(2, 16)}
        want = sorted(plain, key=lambda k: -plain[k])[: neural.LAGS]
        assert found.tolist() == want and found[0] in (7, 14)
        e = np.exp([4 * plain[k] for k in want])
        assert np.allclose(parts, e / e.sum())
    averages = neural.delayed_averages(window, 9)
    for w, found, parts, got in zip(window, lags, share, averages):
        for h in range(1, 10):
            want = sum(s * w[29 + h - int(np.ceil(h / k)) * k] for k, s in zip(found, parts))
            assert np.isclose(got[h - 1], want)


@pytest.fixture(scope="module")
def series(spark):
    return fc.prepare(frame(spark, {"a": walk(150, 1), "b": walk(110, 2)}, {"a": times(150), "b": times(110)}), CFG, ["k"])


def test_segments_hold_every_window_once(series):
    past = series.scaled.filter("idx < split_idx")
    made = neural.segments(past, str(CFG.lookback - 1), f"split_idx - 1 - {CFG.horizon}", CFG, ["k"]).collect()
    for k, split in (("a", 120), ("b", 88)):
        origins = sorted(o for r in made if r["k"] == k and r["component"] == "imf_1" for o in range(r["low"], r["high"]))
        assert origins == list(range(15, split - 3))
    for r in made:
        assert r["begin"] <= r["low"] - (CFG.lookback - 1) and r["begin"] + len(r["rows"]) >= r["high"] + CFG.horizon


def test_summed_gradients_do_not_depend_on_partitions(spark, series):
    past = series.scaled.filter("idx < split_idx")
    results = []
    for rows, parts in ((40, 1), (40, 5), (1000, 2)):
        cfg = models.ForecastConfig(lookback=16, horizon=3, net_rows=rows, net_steps=2)
        train = neural.segments(past, "15", "split_idx - 4", cfg, ["k"]).repartition(parts)
        results.append(neural.train_networks(train, neural.Tcn, cfg)[0])
    for other in results[1:]:
        for name, p in results[0].items():
            assert all(np.allclose(p[k], other[name][k], atol=1e-6) for k in p)


@pytest.mark.parametrize("name", list(neural.NETWORKS))
def test_named_models_run(series, name):
    result = fc.run_single(series, name.upper())
    rows = pandas_of(result.forecast, "k", "timestamp")
    assert len(rows) == 30 + 22 and np.isfinite(rows["predicted_load"]).all()
    assert name not in models.MODELS


def compared(spark, z, cfg, name):
    """RMSE of the network and of a least-squares rule of the lookback, on the last fifth of one series."""
    df = frame(spark, {"a": np.array(z)}, {"a": times(len(z))})
    split = len(z) * 4 // 5
    rows = df.selectExpr("k", "load AS z", "(unix_timestamp(timestamp) - unix_timestamp(timestamp'2024-01-01')) div 3600 AS idx", "CAST(array() AS array<double>) AS exog")
    one = rows.selectExpr("*", f"{len(z)}L AS n", f"{split}L AS split_idx", "'load' AS component", "0.0D AS center", "1.0D AS scale").cache()
    got = models.SERIES_MODELS[name](one, cfg, ["k"]).toPandas()
    look, ahead, every = cfg.lookback, cfg.horizon, np.array(z)
    past = lambda o: np.r_[every[o - look + 1 : o + 1], 1.0]
    x = np.stack([past(o) for o in range(look - 1, split - ahead)])
    beta = np.linalg.lstsq(x, np.stack([every[o + 1 : o + 1 + ahead] for o in range(look - 1, split - ahead)]), rcond=None)[0]
    errors = [every[o + 1 : o + 1 + ahead] - past(o) @ beta for o in range(split - 1, len(z) - ahead)]
    assert len(got) == len(errors) * ahead
    return float(np.sqrt(((got["truth"] - got["pred"]) ** 2).mean())), float(np.sqrt(np.mean(np.square(errors))))


@pytest.mark.parametrize("name", ["tcn", "lstm", "scinet"])
def test_networks_learn_what_a_linear_model_cannot(spark, name):
    """The next value is the product of the signs of the two before it: no linear rule of the past knows it."""
    rng = np.random.default_rng(4)
    z = [1.0, -1.0, 1.0]
    for _ in range(897):
        z.append(float(np.sign(z[-1] * z[-2])) if rng.random() > 0.1 else float(rng.choice([-1, 1])))
    cfg = models.ForecastConfig(lookback=8, horizon=1, net_steps=110, net_rate=0.03, net_rows=512)
    network, linear = compared(spark, z, cfg, name)
    assert network < 0.85 * linear


def test_autoformer_finds_the_season_of_each_window(spark):
    """The period changes every 120 rows, the pattern too: one rule for all windows cannot follow."""
    rng, z = np.random.default_rng(5), []
    while len(z) < 1200:
        pattern = rng.normal(size=int(rng.choice([5, 7, 9, 11])))
        z += np.tile(pattern, 30)[:120].tolist()
    cfg = models.ForecastConfig(lookback=36, horizon=6, net_steps=60, net_rate=0.02, net_rows=512)
    network, linear = compared(spark, z, cfg, "autoformer")
    assert network < 0.97 * linear
