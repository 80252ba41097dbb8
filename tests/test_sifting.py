import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import decompose, forecast as fc, models, sifting
from gridtide.operators.position import index_series
from tests.helpers import frame, pandas_of, times, walk


def plain_extrema(x):
    """By runs of equal values, one after the other."""
    runs, out = [], ([], [])
    for i, v in enumerate(x):
        if runs and runs[-1][2] == v:
            runs[-1][1] = i
        else:
            runs.append([i, i, v])
    for a, b, c in zip(runs, runs[1:], runs[2:]):
        if b[2] > a[2] and b[2] > c[2]:
            out[1].append((b[0] + b[1]) // 2)
        if b[2] < a[2] and b[2] < c[2]:
            out[0].append((b[0] + b[1]) // 2)
    return out


def plain_envelope(x, at):
    n = len(x)
    knots = [-p for p in at[1::-1]] + at + [2 * (n - 1) - p for p in at[:-3:-1]]
    y = [x[p] for p in at[1::-1]] + [x[p] for p in at] + [x[p] for p in at[:-3:-1]]
    k, y, size = np.array(knots, float), np.array(y), len(knots)
    a, r = np.eye(size), np.zeros(size)
    h = np.diff(k)
    for i in range(1, size - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        r[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    m = np.linalg.solve(a, r)
    i = np.searchsorted(k, np.arange(n), "right") - 1
    t, d = np.arange(n) - k[i], h[i]
    b = (y[i + 1] - y[i]) / d - d * (2 * m[i] + m[i + 1]) / 6
    return y[i] + t * (b + t * (m[i] / 2 + t * (m[i + 1] - m[i]) / (6 * d)))


def plain_sifting(x, count, sifts):
    out, rest = [], x.astype(float)
    while len(out) < count - 1:
        h = rest.copy()
        for i in range(sifts):
            low, high = plain_extrema(h)
            if min(len(low), len(high)) < 2:
                break
            h = h - (plain_envelope(h, low) + plain_envelope(h, high)) / 2
        else:
            i = sifts
        if i == 0:
            break
        out.append(h)
        rest = rest - h
    return [*out, rest]


def wavy(n, seed):
    t = np.arange(n)
    return np.round(20 * np.sin(t / 3) + 30 * np.sin(t / 17) + 0.05 * t + np.random.default_rng(seed).normal(0, 3, n))


def test_extrema_and_spline():
    x = np.array([0, 1, 1, 1, 2, 2, 1, 1, 0, 0, 3.0])
    assert plain_extrema(x) == ([8], [4])
    k = np.array([0, 1, 3, 4, 8, 9.5])
    y = np.array([0, 2, -1, 4, 4, 0.0])
    m = sifting.second_derivatives(k, y)
    fine = np.linspace(0, 9.5, 400)
    i = np.clip(np.searchsorted(k, fine, "right") - 1, 0, 4)
    s = sifting.spline_at(fine, k[i], y[i], m[i], k[i + 1], y[i + 1], m[i + 1])
    assert np.allclose(np.interp(k, fine, s), y, atol=0.05) and m[0] == m[-1] == 0
    assert np.abs(np.diff(s, 2)).max() < 0.02


@pytest.mark.parametrize("block_rows", [64, 1 << 16])
def test_sifting_over_blocks_is_plain_sifting(spark, block_rows):
    """Rounded values, so that many extrema are flat and some lie over the ends of blocks."""
    loads = {"a": wavy(700, 1), "b": wavy(333, 2), "c": np.arange(50.0), "d": np.full(70, 3.0), "e": np.repeat([1.0, 5.0, 2.0, 6.0, 1.0, 4.0], 100)}
    df = frame(spark, loads, {k: times(len(v)) for k, v in loads.items()})
    got = pandas_of(sifting.sift_components(index_series(df, ["k"]), ["k"], max_components=4, sifts=3, block_rows=block_rows), "k", "idx")
    for k, load in loads.items():
        mine, want = got[got["k"] == k], plain_sifting(load, 4, 3)
        assert len(mine) == len(load)
        for j in range(1, 5):
            found = mine[f"imf_{j}"].to_numpy(float)
            assert np.isnan(found).all() if j > len(want) else np.allclose(found, want[j - 1], rtol=0, atol=1e-9)
        assert np.allclose(mine[[f"imf_{j}" for j in range(1, 5)]].sum(axis=1), load, atol=1e-9)
    assert len(plain_sifting(loads["c"], 4, 3)) == 1 and len(plain_sifting(loads["a"], 4, 3)) == 4


def test_gaps_and_frames(spark):
    load = wavy(200, 3)
    df = frame(spark, {"a": load}, {"a": times(200)}).withColumn("load", F.when(F.col("load") % 7 != 0, F.col("load")))
    parts = sifting.sift_components(index_series(df), sifts=2, max_components=3)
    rows = parts.orderBy("idx").collect()
    assert all((r["imf_1"] is None) == (r["load"] is None) for r in rows)
    assert all(abs(r["imf_1"] + r["imf_2"] + r["imf_3"] - r["load"]) < 1e-9 for r in rows if r["load"] is not None)
    some = decompose.component_frame(index_series(df.na.drop()), 2, method="sifting")
    assert some.filter("abs(imf_1 + imf_2 + residual - load) > 1e-9").count() == 0 and "imf_3" not in some.columns
    with pytest.raises(ValueError):
        sifting.sift_components(index_series(df), sifts=0)
    with pytest.raises(ValueError):
        decompose.component_frame(index_series(df), 2, method="other")


def test_forecast_over_sifted_components(spark):
    cfg = models.ForecastConfig(lookback=30, horizon=6, imf_components=1, exogenous=False, decomposition="sifting")
    df = frame(spark, {"a": walk(200, 1)}, {"a": times(200)})
    result = fc.run_single(fc.prepare(df, cfg, ["k"]), "seasonal_naive")
    assert result.forecast.count() == 40 and result.component_metrics.count() == 2
