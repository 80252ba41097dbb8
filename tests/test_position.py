from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from gridtide.operators import position
from gridtide.operators.relate import differences, with_lags
from tests.helpers import START, frame, pandas_of, uneven_times, walk

SCHEMA = "k string, timestamp timestamp_ntz, load double"


@pytest.fixture(scope="module")
def two(spark):
    data = {"a": walk(400, 1), None: walk(150, 2)}
    return frame(spark, data, {"a": uneven_times(400, 3), None: uneven_times(150, 4)})


@pytest.mark.parametrize("cell_rows", [1_000_000, 40, 1])
def test_index_matches_plain_row_number(two, cell_rows):
    plain = Window.partitionBy("k").orderBy("timestamp")
    want = two.withColumns({
        "idx": F.row_number().over(plain).cast("long") - 1,
        "n": F.count(F.lit(1)).over(Window.partitionBy("k")),
        "total_load": F.sum("load").over(Window.partitionBy("k")),
    })
    got = pandas_of(position.index_series(two, ["k"], totals=["load"], cell_rows=cell_rows), "timestamp", "load")
    want = pandas_of(want, "timestamp", "load")
    assert (got["idx"] == want["idx"]).all() and (got["n"] == want["n"]).all()
    assert np.allclose(got["total_load"], want["total_load"])


def test_index_without_keys(two):
    one = two.filter("k = 'a'").drop("k")
    got = pandas_of(position.index_series(one, cell_rows=5), "timestamp")
    assert got["idx"].tolist() == list(range(400))


@pytest.mark.parametrize("block_rows", [7, 64, 65_536])
def test_halo_lag_matches_plain_lag(two, block_rows):
    indexed = position.index_series(two, ["k"])
    got = pandas_of(with_lags(indexed, ["k"], {"l1": 1, "l24": 24}, block_rows=block_rows), "timestamp", "load")
    plain = Window.partitionBy("k").orderBy("timestamp")
    want = pandas_of(two.withColumns({"l1": F.lag("load", 1).over(plain), "l24": F.lag("load", 24).over(plain)}), "timestamp", "load")
    assert len(got) == len(want)
    for c in ("l1", "l24"):
        assert np.array_equal(got[c].to_numpy(), want[c].to_numpy(), equal_nan=True)


def test_differences_and_tail(two):
    indexed = position.index_series(two, ["k"])
    got = pandas_of(differences(indexed, ["k"], block_rows=16).filter("k = 'a'"), "idx")
    load = walk(400, 1)
    assert np.allclose(got["ramp"][1:], np.diff(load)) and np.allclose(got["diff2"][2:], np.diff(load, 2))
    assert np.isnan(got["ramp"][0]) and got["diff2"][:2].isna().all()
    assert position.tail_rows(indexed, 10).count() == 20


def test_raw_rows_never_meet_in_one_partition(two):
    plan = position.index_series(two, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "Window [row_number" in plan and "_at" in plan


def test_a_dense_series_leaves_the_cells_of_others(spark):
    slow = [("slow", START + timedelta(hours=i), float(i)) for i in range(4000)]
    dense = [("dense", START + timedelta(microseconds=700 * i), float(i)) for i in range(3000)]
    alone = position.time_cells(spark.createDataFrame(slow, SCHEMA), ["k"], "timestamp", cell_rows=400)
    both = spark.createDataFrame(slow + dense, SCHEMA)
    cells = position.time_cells(both, ["k"], "timestamp", cell_rows=400)
    assert alone.widths == (40,) and cells.widths == (40, 30, 20)
    assert cells.table.filter("k = 'slow'").count() == alone.table.count() < 20
    assert cells.table.agg(F.sum("_rows")).first()[0] == 7000
    got = pandas_of(position.index_series(both, ["k"], totals=["load"], cell_rows=400), "k", "timestamp")
    assert got["idx"].tolist() == [*range(3000), *range(4000)]
    assert set(got["total_load"]) == {sum(range(3000)), sum(range(4000))}


def test_steps_come_with_the_positions(spark):
    """Seconds since the row before, over cells of any width; the median step of each series follows from them."""
    from gridtide.operators import relate
    from gridtide.operators.position import index_series
    from gridtide.operators.spectrum import spectrum

    rows = spark.range(900).selectExpr("IF(id % 3 = 0, 'a', 'b') AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id div 100 AS INT), 0, CAST(id * id % 977 AS INT), id) AS timestamp", "double(id % 7) AS load")
    rows = rows.dropDuplicates(["k", "timestamp"]).unionByName(spark.sql("SELECT 'one' AS k, timestamp_ntz'2024-05-05 00:00:00' AS timestamp, 1.0D AS load")).cache()
    for cell_rows in (1_000_000, 20):
        found = index_series(rows, ["k"], totals=["load"], step="seconds", cell_rows=cell_rows).cache()
        want = {(r["k"], r["timestamp"]): r["s"] for r in rows.selectExpr("*", "(unix_micros(CAST(timestamp AS timestamp)) - lag(unix_micros(CAST(timestamp AS timestamp))) OVER (PARTITION BY k ORDER BY timestamp)) / 1e6 AS s").collect()}
        assert {(r["k"], r["timestamp"]): r["seconds"] for r in found.collect()} == want
        hours = sorted(map(tuple, relate.hours_of_steps(found, ["k"]).collect()))
        assert hours == sorted(map(tuple, relate.sampling_hours(rows, ["k"]).collect())) and dict(hours)["one"] == 1.0
    both = [sorted(map(tuple, spectrum(rows, ["k"], hours=h).collect())) for h in (None, relate.sampling_hours(rows, ["k"]))]
    assert len(both[0]) > 100 and all(a[:2] == b[:2] and abs(a[3] - b[3]) < 1e-6 for a, b in zip(*both))
