import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import describe, distribution, quantile, skew
from tests.helpers import pandas_of


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    rows = [("big", float(v)) for v in np.concatenate([rng.normal(size=900), [0.0] * 500, 10.0 ** rng.uniform(-3, 9, size=200)])]
    rows += [("one", 4.0), ("same", 2.0), ("same", 2.0)] + [(None, float(v)) for v in range(11)] + [("big", None)]
    return spark.createDataFrame(rows, "g string, v double")


def test_quantiles_are_exact(mixed):
    ps, names = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0], [f"p{i}" for i in range(7)]
    plain = mixed.filter("v IS NOT NULL").groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for p, n in zip(ps, names)])
    plain, own = pandas_of(plain, "p0", "p6"), pandas_of(quantile.quantiles(mixed, ["g"], "v", ps, names), "p0", "p6")
    assert len(plain) == len(own) == 4
    assert np.allclose(plain[names], own[names], rtol=1e-14)


def test_quantiles_without_groups(mixed):
    assert quantile.quantiles(mixed, [], "v", [0.5], ["m"]).first()[0] == mixed.agg(F.percentile("v", F.lit(0.5))).first()[0]


def test_quantiles_of_odd_values(spark):
    """Infinities, tiny and huge values and a hot group take the same passes as any others."""
    rng = np.random.default_rng(3)
    data = {
        "inf": [*map(float, range(2000)), float("inf")], "both": [float("-inf")] * 3 + [float("inf")] * 3, "nan": [1.0, 2.0, float("nan")],
        "tails": [float(v) for v in 10.0 ** rng.uniform(-200, 30, 201)], "hot": [7.0] * 5000 + [1.0, 9.0], "one": [3.5],
    }
    df = spark.createDataFrame([(g, v) for g in data for v in data[g]] + [("none", None)], "g string, v double")
    tracker = spark.sparkContext.statusTracker()
    jobs = lambda: len(tracker.getJobIdsForGroup("quantiles"))
    spark.sparkContext.setJobGroup("quantiles", "passes")
    got = {r["g"]: r for r in quantile.quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["a", "b", "c"]).collect()}
    used = jobs()
    spark.sparkContext.setJobGroup("other", "")
    assert used <= 14 and set(got) == set(data)
    assert (got["inf"]["a"], got["inf"]["b"], got["inf"]["c"]) == (500.0, 1000.0, 1500.0)
    assert got["both"]["a"] == float("-inf") and np.isnan(got["both"]["b"]) and got["both"]["c"] == float("inf")
    assert got["nan"]["b"] == 2.0 and np.isnan(got["nan"]["c"])
    assert np.allclose([got["tails"][c] for c in "abc"], np.quantile(data["tails"], [0.25, 0.5, 0.75]), rtol=1e-12)
    assert all(got["hot"][c] == 7.0 for c in "abc") and all(got["one"][c] == 3.5 for c in "abc")


def test_attach_keeps_null_groups_and_copies_nothing(spark, mixed):
    table = mixed.groupBy("g").agg(F.max("v").alias("top"))
    joined = skew.attach(mixed, table, ["g"])
    assert joined.count() == mixed.count() and joined.filter("g IS NULL").first()["top"] == 10.0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        rows = spark.range(300_000).selectExpr("if(id % 3 = 0, 0, id % 150000) AS g", "id")
        groups = spark.range(150_000).selectExpr("id AS g", "id * 2 AS w")
        big = skew.attach(rows, groups, ["g"])
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Generate" not in plan and "Broadcast" not in plan
        assert big.filter("w = g * 2").count() == 300_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_basic_statistics_small_series(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "load double")
    got = dict(describe.basic_statistics(df).collect())
    assert got["mean"] == 2 and got["median"] == 2 and got["skewness"] is None and got["kurtosis"] is None


def test_histogram_matches_numpy(mixed):
    got = pandas_of(distribution.histogram(mixed.filter("g = 'big'"), "v", 50), "bin")
    values = np.array([r["v"] for r in mixed.filter("g = 'big' AND v IS NOT NULL").collect()])
    counts, edges = np.histogram(values, bins=50)
    assert got["count"].tolist() == counts.tolist() and np.allclose(got["left"], edges[:-1])
    flat = pandas_of(distribution.histogram(mixed.filter("g = 'same'"), "v", 10), "bin")
    assert flat["count"].tolist() == np.histogram([2.0, 2.0], bins=10)[0].tolist()


def test_density_matches_direct_sum(mixed):
    values = np.array([r["v"] for r in mixed.filter("g = 'big' AND abs(v) < 5").collect()])
    got = pandas_of(distribution.density(mixed.filter("g = 'big' AND abs(v) < 5"), "v", 50, ["g"]), "point")
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    kernel = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (h * np.sqrt(2 * np.pi))
    assert np.allclose(got["x"], grid) and np.allclose(got["density"], kernel * (np.ptp(values) / 50))


def test_frequent_values_keep_every_step(mixed):
    want = np.sort([r["v"] for r in mixed.filter("g = 'big' AND v IS NOT NULL").collect()])
    for run_rows in (7, 1 << 16):
        got = pandas_of(distribution.sample_ranks(mixed.filter("g = 'big'"), "v", ["g"], run_rows), "rank")
        assert got["rank"].tolist() == list(range(1, len(want) + 1)) and np.array_equal(got["value"], want)


def test_qq_points(spark):
    from statistics import NormalDist

    values = np.random.default_rng(1).normal(3, 2, size=50)
    got = pandas_of(distribution.normal_qq(spark.createDataFrame([(float(v),) for v in values], "e double"), "e"), "rank")
    n = len(values)
    medians = [(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)]
    medians[-1] = 0.5 ** (1 / n)
    medians[0] = 1 - medians[-1]
    assert np.allclose(got["theoretical"], [NormalDist().inv_cdf(p) for p in medians]) and np.allclose(got["sample"], np.sort(values))
