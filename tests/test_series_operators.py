import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridtide.operators import decompose, relate, sequence, spectrum
from gridtide.operators.position import index_series
from tests.helpers import frame, pandas_of, times, uneven_times, walk


@pytest.fixture(scope="module")
def pair(spark):
    return frame(spark, {"a": walk(1500, 1), "b": walk(300, 2)}, {"a": times(1500, 15), "b": times(300, 60)})


@pytest.fixture(scope="module")
def indexed(pair):
    return index_series(pair, ["k"], totals=["load"])


def _acf(x, lags):
    d = x - x.mean()
    return np.array([d[k:] @ d[: len(d) - k] for k in range(1, lags + 1)]) / (d @ d)


@pytest.mark.parametrize("block_rows", [30, 128, 65_536])
def test_autocorrelation(pair, block_rows):
    got = pandas_of(relate.autocorrelation(pair, ["k"], block_rows=block_rows), "k", "lag")
    for key, n, seed in (("a", 1500, 1), ("b", 300, 2)):
        mine, want = got[got["k"] == key], _acf(walk(n, seed), 100)
        assert np.allclose(mine["acf"], want)
        band = 1.959963984540054 * np.sqrt((1 + 2 * np.concatenate([[0], np.cumsum(want**2)[:-1]])) / n)
        assert np.allclose(mine["band"], band)


def test_autocorrelation_lag_limits(spark):
    short = frame(spark, {"a": [1, 2], "b": [1, 4, 2, 8, 5, 7]}, {"a": times(2), "b": times(6)})
    got = relate.autocorrelation(short, ["k"]).groupBy("k").count().collect()
    assert dict(map(tuple, got)) == {"a": 1, "b": 2}


def test_partial_autocorrelation_solves_yule_walker(pair):
    got = pandas_of(relate.partial_autocorrelation(relate.autocorrelation(pair, ["k"]), ["k"]), "k", "lag")
    r = np.concatenate([[1], _acf(walk(300, 2), 100)])
    want = []
    for k in range(1, 101):
        matrix = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        want.append(np.linalg.solve(matrix, r[1 : k + 1])[-1])
    assert np.allclose(got[got["k"] == "b"]["pacf"], want, atol=1e-8)


def test_sampling_hours(spark, pair):
    got = dict(map(tuple, relate.sampling_hours(pair, ["k"]).collect()))
    assert got == {"a": 0.25, "b": 1.0}
    single = frame(spark, {"a": [1]}, {"a": times(1)})
    assert relate.sampling_hours(single, ["k"]).collect()[0]["sampling_hours"] == 1.0
    stamps = uneven_times(200, 3)
    odd = frame(spark, {"a": walk(200)}, {"a": stamps})
    want = pd.Series(stamps).diff().dt.total_seconds().median() / 3600
    for cell_rows in (1, 1_000_000):
        assert np.isclose(relate.sampling_hours(odd, ["k"], cell_rows=cell_rows).first()["sampling_hours"], want)


def test_weather_needs_three_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "load double, temp double")
    assert relate.weather_correlation(df) is None


def _cascade(values, max_components):
    """Independent pandas form of the smoothing cascade."""
    level, parts = pd.Series(values), []
    for window in decompose.CASCADE[: max(1, max_components - 1)]:
        if len(level) <= window:
            break
        smooth = level.rolling(window, center=True, min_periods=1).mean()
        parts.append((level - smooth).to_numpy())
        level = smooth
    return [*parts, level.to_numpy()][:max_components]


@pytest.mark.parametrize("block_rows", [50, 400, 65_536])
def test_decomposition(indexed, block_rows):
    got = decompose.decompose(indexed, ["k"], block_rows=block_rows)
    names = decompose.component_names(got)
    table = pandas_of(got, "k", "idx")
    for key, n, seed in (("a", 1500, 1), ("b", 300, 2)):
        mine, want = table[table["k"] == key], _cascade(walk(n, seed), 10)
        for name, part in zip(names, want):
            assert np.allclose(mine[name], part, atol=1e-9)
        assert mine[names[len(want):]].isna().all().all()
        assert np.allclose(mine[names].sum(axis=1), walk(n, seed))


@pytest.mark.parametrize("most", [1, 2, 4])
def test_fewer_components(indexed, most):
    got = decompose.decompose(indexed, ["k"], max_components=most)
    table = pandas_of(got.filter("k = 'a'"), "idx")
    want = _cascade(walk(1500, 1), most)
    assert decompose.component_names(got) == [f"imf_{i + 1}" for i in range(len(want))]
    assert all(np.allclose(table[f"imf_{i + 1}"], part) for i, part in enumerate(want))


def test_component_frame_keeps_the_sum(indexed):
    table = pandas_of(decompose.component_frame(indexed, 3, ["k"]), "k", "idx")
    assert np.allclose(table[["imf_1", "imf_2", "imf_3", "residual"]].sum(axis=1), table["load"])
    with pytest.raises(ValueError):
        decompose.bounded_component_frame(indexed, 11, ["k"])
    with pytest.raises(ValueError):
        decompose.bounded_component_frame(indexed, 7, ["k"])
    assert "remainder_component" in decompose.bounded_component_frame(indexed, 6, ["k"]).columns


def test_causal_cascade_ignores_the_future(indexed):
    full = pandas_of(decompose.decompose(indexed, ["k"], causal=True, block_rows=200).filter("k = 'a'"), "idx")
    part = pandas_of(decompose.decompose(indexed.filter("idx < 1000"), ["k"], causal=True).filter("k = 'a'"), "idx")
    assert np.allclose(full["imf_3"][:1000], part["imf_3"])


@pytest.mark.parametrize("window", [3, 4, 48])
def test_rolling_mean(indexed, window):
    got = pandas_of(sequence.rolling_mean(indexed, window, ["k"], block_rows=64).filter("k = 'b'"), "idx")
    assert np.allclose(got["smooth"], pd.Series(walk(300, 2)).rolling(window, center=True, min_periods=1).mean())


def test_bands_below_six_components(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0)], "imf_1 double, imf_2 double, imf_3 double")
    row = decompose.reconstruct_bands(df, ["imf_1", "imf_2", "imf_3"]).first()
    assert (row["high"], row["mid"], row["low"], row["trend"]) == (3, 4, 0, 4)


@pytest.mark.parametrize("group_points", [1 << 20, 16])
def test_spectrum(spark, group_points):
    data = {"a": walk(211, 1), "b": walk(96, 2), "c": walk(17, 3)}
    df = frame(spark, data, {k: times(len(v)) for k, v in data.items()})
    got = pandas_of(spectrum.spectrum(df, ["k"], hours=0.5, group_points=group_points), "k", "harmonic")
    for key, values in data.items():
        mine, top = got[got["k"] == key], (len(values) - 1) // 2
        want = np.abs(np.fft.fft(values - values.mean()))[1 : top + 1]
        assert np.allclose(mine["amplitude"], want, atol=1e-7)
        assert np.allclose(mine["frequency"], np.fft.fftfreq(len(values), 0.5)[1 : top + 1])


def test_component_classes(spark):
    n = 240
    t = np.arange(n)
    parts = {"imf_1": np.sin(2 * np.pi * t / 4), "imf_2": np.sin(2 * np.pi * t / 24), "imf_3": np.sin(2 * np.pi * t / 120), "imf_4": np.ones(n)}
    rows = [(c, int(i), n, float(v)) for c, values in parts.items() for i, v in enumerate(values)]
    long = spark.createDataFrame(rows, "component string, idx long, n long, value double")
    got = {r["component"]: (r["index"], r["category"]) for r in spectrum.classify_components(long).collect()}
    assert got["imf_1"] == (1, "high") and got["imf_2"] == (2, "mid") and got["imf_3"] == (3, "low") and got["imf_4"][0] == 4


def test_classes_by_series_step(spark):
    """The same wave is slower in cycles per hour when its samples are further apart."""
    wave = np.sin(2 * np.pi * np.arange(96) / 6)
    rows = [(k, "imf_1", int(i), 96, float(v)) for k in ("fast", "slow") for i, v in enumerate(wave)]
    long = spark.createDataFrame(rows, "k string, component string, idx long, n long, value double")
    hours = spark.createDataFrame([("fast", 1.0), ("slow", 24.0)], "k string, sampling_hours double")
    got = {r["k"]: r["category"] for r in spectrum.classify_components(long, ["k"], hours).collect()}
    assert got == {"fast": "high", "slow": "low"}


def test_windows_and_scaling(indexed):
    windows = pandas_of(sequence.sliding_windows(indexed, 5, 3, ["k"], block_rows=32).filter("k = 'b'"), "origin_idx")
    load = walk(300, 2)
    assert len(windows) == 300 - 5 - 3 + 1
    assert np.allclose(np.stack(windows["x"]), np.stack([load[i : i + 5] for i in range(293)]))
    assert np.allclose(np.stack(windows["y"]), np.stack([load[i + 5 : i + 8] for i in range(293)]))
    split = sequence.with_split(indexed.withColumn("flat", F.lit(7.0)), 0.8, 48, 24)
    table = {r["k"]: r for r in sequence.scaling_table(split, ["load", "flat"], ["k"]).collect()}
    assert np.isclose(table["b"]["mean_load"], load[:240].mean()) and np.isclose(table["b"]["scale_load"], load[:240].std() + 1e-8)
    assert table["b"]["scale_flat"] == 1.0
    strict = sequence.scaling_table(split, ["flat"], ["k"], strict=True).first()
    assert strict["scale_flat"] == 1e-8
    assert sequence.too_short(sequence.with_split(indexed, 0.8, 290, 20), ["k"]).count() == 1


def test_imputation(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, None), ("a", 4.0, None)], "k string, x double, y double")
    got = sorted(map(tuple, sequence.impute_means(df, ["x", "y"], ["k"]).collect()))
    assert got == [("a", 1.0, 0.0), ("a", 2.5, 0.0), ("a", 4.0, 0.0)]


def test_decomposition_passes_over_gaps(spark):
    import pandas as pd

    from gridtide.operators.decompose import CASCADE, decompose
    from gridtide.operators.position import index_series

    values = walk(900, 4)
    values[[100, 101, 500]] = np.nan
    df = spark.createDataFrame([(t, None if np.isnan(v) else float(v)) for t, v in zip(times(900), values)], "timestamp timestamp_ntz, load double")
    got = pandas_of(decompose(index_series(df), block_rows=256), "timestamp")
    level = pd.Series(values)
    for j, window in enumerate(CASCADE, start=1):
        smooth = level.rolling(window, center=True, min_periods=1).mean()
        assert np.allclose(got[f"imf_{j}"], level - smooth, equal_nan=True)
        assert got[f"imf_{j}"].isna().sum() == (3 if j == 1 else 0)
        level = smooth
    assert np.allclose(got["imf_8"], level)


def test_long_spectrum_shuffles_tiles(spark, monkeypatch):
    """Series of several lengths, one keyed by NULL: amplitudes of the direct transform, from tiles of many values."""
    sizes = {"a": 3000, "b": 2049, None: 777}
    loads = {k: walk(n, n) for k, n in sizes.items()}
    df = frame(spark, loads, {k: times(n) for k, n in sizes.items()})
    monkeypatch.setattr(spectrum, "TILE", 16)
    plain = spectrum.spectrum(df, ["k"], hours=1.0, group_points=16)
    assert "tile" in plain._jdf.queryExecution().toString()
    got = pandas_of(plain, "harmonic")
    for k, load in loads.items():
        mine = got[got["k"].isna()] if k is None else got[got["k"] == k]
        want = np.abs(np.fft.rfft(load - load.mean()))[1 : (len(load) - 1) // 2 + 1]
        assert mine["harmonic"].tolist() == list(range(1, len(want) + 1)) and np.allclose(mine["amplitude"], want, atol=1e-6)
