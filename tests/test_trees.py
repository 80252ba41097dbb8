import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import forecast as fc, models, trees
from tests.helpers import frame, pandas_of, times, walk

CFG = models.ForecastConfig(lookback=30, horizon=6, imf_components=1, exogenous=False, tree_rounds=7, tree_depth=3, tree_bins=8, block_rows=64)


@pytest.fixture(scope="module")
def series(spark):
    return fc.prepare(frame(spark, {"a": walk(260, 1), "b": walk(200, 2)}, {"a": times(260), "b": times(200)}), CFG, ["k"])


def steps_of(windows, cfg):
    """Inputs and true value of every step, one after the other."""
    rows = windows.orderBy("component", "k", "origin_idx").collect()
    x = np.array([[*r["features"], s, (h + 1) / cfg.horizon] for r in rows for h, s in enumerate(r["season"])])
    return x, np.array([y for r in rows for y in r["truth"]]), np.array([r["component"] for r in rows for _ in r["season"]])


def plain_trees(x, y, x_test, cfg):
    """Each tree by trying every cut of every input on the rows of every leaf."""
    low, high = x.min(axis=0), x.max(axis=0)
    wide = np.where(high > low, high - low, 1)
    binned = lambda v: np.where(high > low, np.clip(np.floor((v - low) / wide * (cfg.tree_bins - 1) + 0.47), 0, cfg.tree_bins - 1), 0)
    b, b_test, done, out = binned(x), binned(x_test), np.zeros(len(y)), np.zeros(len(x_test))
    for r in range(cfg.tree_rounds):
        g = np.floor((y - done) * 2**20 + 0.5)

        def grow(rows, rows_test, depth, weight):
            value = g[rows].mean() / 2**20 * weight
            best = (trees.LEAST_GAIN * 2.0**40, None)
            for f in range(x.shape[1]) if depth else ():
                for cut in range(cfg.tree_bins - 1):
                    left = rows[b[rows, f] <= cut]
                    right = rows[b[rows, f] > cut]
                    if min(len(left), len(right)) >= cfg.tree_rows:
                        gain = g[left].sum() ** 2 / len(left) + g[right].sum() ** 2 / len(right) - g[rows].sum() ** 2 / len(rows)
                        if gain > best[0]:
                            best = (gain, (f, cut))
            if best[1] is None:
                done[rows] += value
                out[rows_test] += value
                return
            f, cut = best[1]
            for side in (lambda v: v[:, f] <= cut, lambda v: v[:, f] > cut):
                grow(rows[side(b[rows])], rows_test[side(b_test[rows_test])], depth - 1, weight)

        grow(np.arange(len(y)), np.arange(len(x_test)), cfg.tree_depth, cfg.tree_rate if r else 1.0)
    return out


@pytest.mark.parametrize("kept", [trees.KEPT_ROUNDS, 2])
def test_trees_against_plain_ones(series, monkeypatch, kept):
    monkeypatch.setattr(trees, "KEPT_ROUNDS", kept)
    train, test = (w.cache() for w in (fc.training_windows(series), fc.testing_windows(series)))
    got = trees.boost(train, test, CFG, ["k"]).orderBy("component", "k", "origin_idx").collect()
    found = np.array([v for r in got for v in r["predicted"]])
    x, y, name = steps_of(train, CFG)
    x_test, _, name_test = steps_of(test, CFG)
    want = np.zeros(len(x_test))
    for c in np.unique(name):
        want[name_test == c] = plain_trees(x[name == c], y[name == c], x_test[name_test == c], CFG)
    assert len(np.unique(found)) > 50 and np.allclose(found, want, atol=1e-9)


def test_trees_do_not_depend_on_partitions(spark, series):
    train = fc.training_windows(series).cache()
    tables = []
    for n in (1, 7):
        fitted = trees.fit(train.repartition(n), CFG.horizon, 2, 3, 16, 0.1, 5)
        tables.append(sorted(map(tuple, trees.split_table(spark, fitted).collect())))
    assert tables[0] == tables[1] and {r[0] for r in tables[0]} == {"imf_1", "residual"}
    live = {(r[0], r[1], r[2]) for r in tables[0]}
    assert all((c, r, k // 2) in live for c, r, k in live if k > 1)


def test_learns_what_the_plain_models_cannot(spark):
    """The next value depends on the present one by a fold; a season or a mean knows nothing of it."""
    rng, load = np.random.default_rng(3), [0.3]
    for _ in range(899):
        load.append(abs(1 - 2 * load[-1]) * 0.97 + 0.01 * rng.random())
    cfg = models.ForecastConfig(lookback=20, horizon=1, imf_components=1, exogenous=False, period=7, tree_rounds=20, tree_depth=4)
    series = fc.prepare(frame(spark, {"a": np.array(load)}, {"a": times(900)}), cfg, ["k"])
    scores = pandas_of(fc.component_metrics(fc.component_forecasts(series, list(models.MODELS)), ["k"]))
    rmse = scores.groupby("model")["RMSE"].sum()
    assert rmse["gbt"] < 0.7 * rmse["seasonal_naive"] and rmse["gbt"] < 0.9 * rmse["linear"]


def test_edge_cases(spark, series):
    flat = fc.training_windows(series).withColumn("truth", F.transform("truth", lambda _: F.lit(2.0)))
    fitted = trees.fit(flat, CFG.horizon, 3, 3, 8, 0.1, 5)
    assert all((t.feature < 0).all() for m in fitted.values() for t in m.trees)
    out = trees.predict(fc.testing_windows(series), fitted, CFG.horizon, 8).select(F.explode("predicted").alias("p")).distinct().collect()
    assert [round(r.p, 9) for r in out] == [2.0]
    assert trees.fit(flat.limit(0), CFG.horizon, 3, 3, 8, 0.1, 5) == {}
    with pytest.raises(ValueError):
        trees.boost(flat, flat, models.ForecastConfig(tree_bins=1), ["k"])


def test_stored_rows_hold_many_windows_without_what_they_share(series):
    train = fc.training_windows(series).cache()
    fitted = trees._edges(train, CFG.horizon)
    rows = trees._prepare(train, fitted, CFG.horizon, CFG.tree_bins).collect()
    windows = train.count()
    assert len(rows) < windows / 20 and sum(len(r["at"]) for r in rows) == 4 * windows
    assert sum(len(r["truth"]) for r in rows) < 8 * windows * 1.3
    # In any other order they are as many, and none is lost.
    mixed = trees._prepare(train.orderBy(F.xxhash64("k", "component", "origin_idx")), fitted, CFG.horizon, CFG.tree_bins).collect()
    assert sum(len(r["at"]) for r in mixed) == 4 * windows
