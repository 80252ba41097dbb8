import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import _rows

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")

# Cheap queries that cover aggregation, positions, blocks, ranks and cleaning.
SAMPLE = ("a2_peak_valley", "a10_event_box_statistics", "a15_empirical_cdf", "c6_average_duplicates", "d1_decompose", "p10_year_week", "w3_lag_pairs")
WITHOUT_SQL = {"d1_sifting", "f2_tcn_forecast", "f2_lstm_forecast", "f2_autoformer_forecast", "f2_scinet_forecast", "f2d_event_forecast", "f6_event_best_of_all"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "peak_valley_ratio" in df.columns


def test_every_query_has_sql():
    assert set(entry.QUERIES) - set(entry.oracle_sql()) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, FOLDER)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())


@pytest.mark.parametrize("name", ["w1_w2_differences", "w6_rolling_mean", "d1_decompose", "c8_interpolate_in_time", "a13_load_histogram"])
def test_no_query_gathers_raw_rows(spark, name):
    """Without keys only tables of cells may meet in one partition; with keys nothing may."""
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
