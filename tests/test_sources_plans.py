import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import describe
from gridtide.operators.models import ForecastConfig
from gridtide.plans import run as runs
from gridtide.plans.analysis import analysis_tables
from gridtide.sources import csv, tables
from tests.helpers import frame, times, walk

HEADER = "时间,负荷,最高温度℃,平均温度℃,相对湿度(平均),降雨量（mm）"


def _text(rows: int) -> str:
    rng = np.random.default_rng(3)
    start, lines = datetime(2018, 1, 1), [HEADER]
    for i in range(rows):
        t = start + timedelta(hours=i)
        a, b, c, d = rng.normal(size=4).round(3)
        lines.append(f"{t.year}/{t.month}/{t.day} {t.hour}:00,{100 + 10 * np.sin(i / 4) + a:.3f},{20 + a},{15 + b},{40 + c},{abs(d)}")
    return "\n".join(lines) + "\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("input")
    (root / "data").mkdir()
    (root / "outputs").mkdir()
    text = _text(400)
    (root / "data" / "main.csv").write_bytes(text.encode("utf-8"))
    (root / "data" / "small.csv").write_text("a,b\n1,2\n")
    (root / "bom.csv").write_bytes(text.encode("utf-8-sig"))
    (root / "gb.csv").write_bytes((text * 3).encode("gb18030"))
    (root / "latin.csv").write_bytes(b"a,b\nna\xefve,\xff\xff\xff\n")
    (root / "outputs" / "big.csv").write_text(text * 9)
    return root


def test_discovery(spark, folder):
    names = {r["name"] for r in csv.find_csv_files(spark, str(folder)).collect()}
    assert names == {"main.csv", "small.csv", "bom.csv", "gb.csv", "latin.csv"}
    assert csv.choose_primary_dataset(spark, str(folder)).endswith("data/main.csv")
    with pytest.raises(FileNotFoundError):
        csv.choose_primary_dataset(spark, str(folder / "outputs"))


def test_encodings(spark, folder):
    paths = [str(folder / p) for p in ("data/main.csv", "bom.csv", "gb.csv", "latin.csv")]
    found = {r["path"].rsplit("/", 1)[1]: r["encoding"] for r in csv.detect_encodings(spark, paths).collect()}
    assert found == {"main.csv": "utf-8", "bom.csv": "utf-8", "gb.csv": "gb18030", "latin.csv": "latin1"}


@pytest.mark.parametrize("name, rows", [("data/main.csv", 400), ("bom.csv", 400), ("gb.csv", 1202)])
def test_loading(spark, folder, name, rows):
    df, encoding = csv.load_csv(spark, str(folder / name))
    assert df.columns == HEADER.split(",") and df.count() == rows
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}


def test_sinks(spark, tmp_path):
    df = frame(spark, {"a": walk(10), "b": walk(10)}, {"a": times(10), "b": times(10)})
    path = tables.write_table(df, str(tmp_path / "t"), "csv", bom=True)
    part = next((tmp_path / "t").glob("*.csv")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbfk,timestamp,load")
    assert csv.load_csv(spark, path)[0].columns == ["k", "timestamp", "load"]
    tables.write_table(df, str(tmp_path / "p"), partition_by=["k"])
    assert spark.read.parquet(str(tmp_path / "p")).filter("k = 'a'").count() == 10


def test_whole_run(spark, folder, tmp_path):
    cfg = ForecastConfig(lookback=24, horizon=6, imf_components=1, tree_rounds=1, tree_depth=2)
    out = str(tmp_path / "out")
    result = runs.run(spark, out, root=str(folder), mode="forecast", method="hybrid", config=cfg)
    assert result.forecast.count() == 80
    meta = {r["field"]: r["value"] for r in spark.read.csv(f"{out}/dataset_metadata", header=True).collect()}
    assert meta["timestamp_column"] == "时间" and meta["load_column"] == "负荷" and meta["rows_after_filter"] == "400"
    target = f"{out}/forecast/hybrid_all_data"
    read = lambda name: spark.read.csv(f"{target}/{name}", header=True)
    assert read("emd_components").columns == ["timestamp", "IMF1", "residual"]
    assert read("emd_decomposition_results").columns == ["timestamp", "IMF1"]
    assert read("imf_frequency_classes").first()["component"] == "imf_1" and read("imf_energy").count() == 1
    assert read("imf_spectrum").count() == 199 and read("imf_reconstruction").count() == 400
    assert read("forecast_last_week").count() == 80 and read("prediction_error_histogram").count() == 50
    lines = [r["value"] for r in spark.read.text(f"{target}/hybrid_metrics_text").collect()]
    assert sorted(line.split(":")[0] for line in lines) == ["MAE", "MAPE", "R2", "RMSE"]
    stored = json.loads(spark.read.text(f"{target}/hybrid_metrics_json").first()["value"])
    assert np.isclose(stored["RMSE"], result.metrics.first()["RMSE"])
    assert spark.read.csv(f"{target}/imf_model_selection", header=True).count() == 2
    with pytest.raises(ValueError):
        runs.run(spark, out, root=str(folder), mode="dance")


def test_comparison_run(spark, tmp_path):
    from gridtide.plans.forecast import run_comparison

    df = frame(spark, {"a": walk(240), "b": walk(240, 5)}, {"a": times(240), "b": times(240)})
    cfg = ForecastConfig(lookback=24, horizon=6, imf_components=1, exogenous=False)
    days = spark.createDataFrame([("2024-01-10",)], "date string")
    out = str(tmp_path / "cmp")
    final = run_comparison(df, cfg, out, days, ["k"], ["seasonal_naive", "moving_average"])
    read = lambda name: spark.read.csv(f"{out}/{name}", header=True)
    assert final.count() == 96 and read("emd_model_metrics").count() == 4 and read("best_model").count() == 2
    assert {r["category"] for r in read("holiday_error_stats").collect()} == {"Holiday", "Non-Holiday"}
    assert {r["period"] for r in read("period_error_stats").collect()} == {"Peak Period", "Valley Period"}
    assert read("error_qq").count() == 96 and read("forecast_metrics").count() == 8 and read("error_density").count() == 400


def test_analysis_tables(spark, folder, tmp_path):
    df, selection = runs.load_clean(
        spark, str(folder / "data" / "main.csv"), str(tmp_path / "a"), mode="range", start="2018-01-02", end="2018-01-12"
    )
    made = {name: make() for name, make in analysis_tables(df, selection.description).items()}
    assert made["filtered_load_data"].count() == 241 and made["weather_correlation"].count() == 3
    assert made["daily_statistics"].count() == 11 and made["hourly_statistics"].count() == 24
    assert made["load_ecdf"].agg(F.max("ecdf")).first()[0] == 1.0
    assert made["spectrum"].count() == 120 and made["acf"].count() == 100 and made["diff2_histogram"].agg(F.sum("count")).first()[0] == 239
    assert made["correlation_matrix"].count() == 36 and made["monthly_average_load"].filter("mean_load IS NULL").count() == 11
    assert made["weekly_statistics"].select("year_week").orderBy("year_week").collect()[0][0] == "2018-01"


def test_daily_metrics_on_a_stream(spark, tmp_path):
    from gridtide.streaming.daily import daily_peak_valley

    df = frame(spark, {"a": walk(100)}, {"a": times(100)})
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        daily_peak_valley(stream, ["k"], "1 hour").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    got = {r["date"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["date"]: r for r in describe.peak_valley_metrics(df, ["k"]).collect()}
    assert len(got) >= 4 and all(np.isclose(got[d]["peak_valley_ratio"], want[d]["peak_valley_ratio"]) for d in got)


def test_quoted_line_breaks(spark, tmp_path):
    from gridtide.sources.csv import detect_encodings, load_csv

    (tmp_path / "a.csv").write_bytes('time,note,load\n2018/1/1 0:00,"two\nlines, ""quoted""",1\n2018/1/1 1:00,plain,2\n'.encode())
    df, encoding = load_csv(spark, str(tmp_path / "a.csv"))
    assert encoding == "utf-8" and [tuple(r) for r in df.collect()] == [("2018/1/1 0:00", 'two\nlines, "quoted"', "1"), ("2018/1/1 1:00", "plain", "2")]
    (tmp_path / "b.csv").write_bytes("时间,负荷\n2018/1/1 0:00,\"1\"\n".encode("gb18030"))
    found = {r.path.rsplit("/", 1)[1]: (r.encoding, r.multiline) for r in detect_encodings(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": ("utf-8", True), "b.csv": ("gb18030", False)}


def test_store_of_many_series_has_few_files(spark, tmp_path):
    from gridtide.sources.tables import write_clean_series

    rows = spark.range(60_000).selectExpr("concat('s', id % 10000) AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id div 1000) AS timestamp", "double(id) AS load")
    df = rows.selectExpr("*", "year(timestamp) AS year", "month(timestamp) AS month")
    path = write_clean_series(df, str(tmp_path / "store"), ["k"])
    files = list((tmp_path / "store").rglob("*.parquet"))
    assert len(files) <= 4 + 2 + 2 and spark.read.parquet(path).count() == 60_000


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "200")
    spark.conf.set(names[1], "1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_files_with_quoted_breaks_are_split(spark, tmp_path, small_ranges):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    (tmp_path / "a.csv").write_text('t,note,load\n' + "".join(f'{i},"one ""{i}""\ntwo",5\n' for i in range(3000)))
    (tmp_path / "b.csv").write_text("t,note,load\n" + "".join(f'{i},"say, {i}",{i}\n' if i % 2 == 0 else f"{i},plain,{i}\n" for i in range(10_000, 13_000)))
    df, encoding = csv.load_csv(spark, str(tmp_path))
    alone, _ = csv.load_csv(spark, str(tmp_path / "b.csv"))
    rows = df.selectExpr("*", "spark_partition_id() AS task").collect()
    assert encoding == "utf-8" and df.columns == ["t", "note", "load"]
    assert sorted((int(r["t"]), r["note"]) for r in rows if int(r["t"]) < 10_000) == [(i, f'one "{i}"\ntwo') for i in range(3000)]
    assert sorted(tuple(r)[:3] for r in rows if int(r["t"]) >= 10_000) == sorted(tuple(r) for r in alone.collect()) and len(rows) == 6000
    assert len({r["task"] for r in rows if int(r["t"]) < 10_000}) > 3


def test_doubled_quotes(spark, tmp_path):
    """The same record reads alike whether or not some file of the folder has a break in quotes."""
    line = '2024-01-01 00:00,"a ""b"", c",1\n2024-01-01 01:00,"a ""b"" c",2\n2024-01-01 02:00,"",3\n2024-01-01 03:00,back\\slash \\" 5" wide,4\n2024-01-01 04:00,"back\\",5\n'
    want = [("2024-01-01 00:00", 'a "b", c', "1"), ("2024-01-01 01:00", 'a "b" c', "2"), ("2024-01-01 02:00", None, "3"), ("2024-01-01 03:00", 'back\\slash \\" 5" wide', "4"), ("2024-01-01 04:00", "back\\", "5")]
    (tmp_path / "a.csv").write_text("time,note,load\n" + line)
    assert sorted(map(tuple, csv.load_csv(spark, str(tmp_path))[0].collect())) == want
    (tmp_path / "b.csv").write_text("time,note,load\n" + line.replace("2024", "2025") + '2026,"x\ny",9\n')
    got = sorted(map(tuple, csv.load_csv(spark, str(tmp_path))[0].collect()))
    assert got == want + [(t.replace("2024", "2025"), *r) for t, *r in want] + [("2026", "x\ny", "9")]


@pytest.mark.parametrize("sent, encoding", [(csv.SENT_BLOCKS, "utf-8"), (0, "utf-8-sig"), (csv.SENT_BLOCKS, "gb18030")])
def test_records_over_many_ranges(spark, tmp_path, small_ranges, monkeypatch, sent, encoding):
    """Random cells, some longer than several byte ranges, against Python's own reader."""
    import csv as plain
    import random

    monkeypatch.setattr(csv, "SENT_BLOCKS", sent)
    rng = random.Random(8)
    parts = ["a", "负荷", ",", '"', "\n", " ", "\\", "x" * 30, '",', "\n\n", '"\n"']
    want = []
    for k in range(6):
        with open(tmp_path / f"f{k}.csv", "w", encoding=encoding, newline="") as f:
            out = plain.writer(f, lineterminator="\r\n" if k % 2 else "\n")
            out.writerow(["t\nime" if k % 2 else "time", 'a "note", ' + "long " * 30, "load"])
            if k == 3:
                f.write("\n   \n")
            for i in range(60):
                row = [f"{k}-{i}", "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 3, 20]))), rng.choice(["1", "", "5\" wide"])]
                out.writerow(row) if rng.random() < 0.9 else f.write(f'{row[0]},5" by 7" or \\",{i}\n')
    for k in range(6):
        with open(tmp_path / f"f{k}.csv", encoding=encoding, newline="") as f:
            want += [tuple(c or None for c in row) for row in list(plain.reader(f))[1:] if any(c.strip() for c in row)]
    df, found = csv.load_csv(spark, str(tmp_path))
    assert df.columns == ["time", 'a "note", ' + "long " * 30, "load"] and found == ("utf-8" if encoding == "utf-8-sig" else encoding)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    kinds = {r.path.rsplit("/", 1)[1]: r.multiline for r in csv.detect_encodings(spark, str(tmp_path)).collect()}
    assert len(kinds) == 6 and all(kinds.values())


def test_other_ranges_than_before_are_refused(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('t,note\n' + "".join(f'{i},"one\n{i}"\n' for i in range(100)))
    df, _ = csv.load_csv(spark, str(tmp_path))
    assert df.count() == 100
    df, _ = csv.load_csv(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    with pytest.raises(Exception, match="cut otherwise"):
        df.select("note").collect()
