import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from gridtide.operators.position import index_series
from gridtide.sources import store


@pytest.fixture(scope="module")
def rows(spark):
    """Forty series over five months, one of them with a third of all rows."""
    made = spark.range(12_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('s', id % 41)) AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id * 17 AS INT), id % 7) AS timestamp", "double(id) AS load"
    )
    return made.cache()


@pytest.fixture(scope="module")
def made(spark, rows, tmp_path_factory):
    name, path = f"series_{uuid.uuid4().hex[:8]}", str(tmp_path_factory.mktemp("store") / "s")
    return name, path, store.write_store(rows, name, path, ["k"], buckets=8)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_positions_without_a_shuffle_of_rows(spark, rows, made):
    _, path, table = made
    indexed = store.index_store(table, ["k"])
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    # Nothing is exchanged between the scan of the buckets and the window over them.
    lines = initial.splitlines()
    scan = next(i for i, x in enumerate(lines) if "Scan parquet" in x and "Bucketed: true" in x)
    depth = lambda x: len(re.match(r"[\s:+\-*()\d]*", x)[0])
    above, level = [], depth(lines[scan])
    for x in reversed(lines[:scan]):
        if depth(x) < level:
            above.append(x)
            level = depth(x)
    assert any("Window" in x for x in above) and not any("Exchange" in x for x in above), initial
    want = {(r.k, r.timestamp): (r.idx, r.n, r.load) for r in index_series(rows, ["k"]).collect()}
    got = {(r.k, r.timestamp): (r.idx, r.n, r.load) for r in indexed.collect()}
    assert got == want and len(got) == 12_000
    few = store.index_store(table, ["k"], cell_rows=50)  # cells too full: cut further
    assert {(r.k, r.timestamp): (r.idx, r.n, r.load) for r in few.collect()} == want
    assert len(files(path)) <= 8 * 6


def test_one_month_is_replaced_alone(spark, rows, made):
    name, path, table = made
    before = files(path)
    march = rows.filter("month(timestamp) = 3 AND k <> 's5'").withColumn("load", F.col("load") + 0.5)
    store.replace_months(march, name, ["k"])
    spark.catalog.refreshTable(name)
    after = files(path)
    assert {f: t for f, t in before.items() if "/month=3/" not in f} == {f: t for f, t in after.items() if "/month=3/" not in f}
    want = rows.filter("month(timestamp) <> 3").unionByName(march)
    seen = spark.table(name).select("k", "timestamp", "load")
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, want.select("k", "timestamp", "load").collect()))
    again = store.open_store(spark, f"{name}_again", path, ["k"], 8)
    assert {(r.k, r.timestamp, r.idx, r.n) for r in store.index_store(again, ["k"]).collect()} == {(r.k, r.timestamp, r.idx, r.n) for r in index_series(want, ["k"]).collect()}


def test_empty_and_bad_rows(spark, rows, tmp_path):
    name = f"empty_{uuid.uuid4().hex[:8]}"
    table = store.write_store(rows.limit(0), name, str(tmp_path / "e"), ["k"], buckets=2)
    assert store.index_store(table, ["k"]).count() == 0
    with pytest.raises(Exception, match="needs a time"):
        store.write_store(rows.withColumn("k", F.lit(None).cast("string")), f"{name}_bad", str(tmp_path / "b"), ["k"], buckets=2)
