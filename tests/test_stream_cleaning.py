import os
import random
from datetime import datetime, timedelta

import pytest

from gridtide.operators.clean import average_duplicates, interpolate_in_time
from gridtide.streaming.cleaning import clean_stream

START = datetime(2024, 1, 1)


def run(spark, rows, folder, batches, keys, **options):
    """The rows in files of their own, one micro-batch each, in the order given."""
    os.makedirs(folder / "in")
    for i, part in enumerate(batches):
        df = spark.createDataFrame(part, "k string, timestamp timestamp_ntz, load double").coalesce(1)
        df.write.parquet(str(folder / f"b{i}"))
        name = next(f for f in os.listdir(folder / f"b{i}") if f.endswith(".parquet"))
        target = folder / "in" / f"{i:03d}.parquet"
        os.link(folder / f"b{i}" / name, target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema("k string, timestamp timestamp_ntz, load double").option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    query = (
        clean_stream(stream, keys, **options).writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(folder / "ck"))
        .trigger(availableNow=True).start(str(folder / "out"))
    )
    assert query.awaitTermination(300)
    return spark.read.parquet(str(folder / "out")).collect()


@pytest.fixture(scope="module")
def readings():
    """Two series of irregular times, some twice, with unknown readings at the start, alone and in a row."""
    rng, rows = random.Random(11), []
    for k in "ab":
        t = START
        for i in range(120):
            t += timedelta(minutes=rng.randint(1, 20))
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                unknown = i < 3 or 50 <= i < 58 or rng.random() < 0.15
                rows.append((k, t, None if unknown else round(rng.uniform(1, 9), 3)))
    return sorted(rows, key=lambda r: r[1])


def test_stream_in_shuffled_batches_is_the_batch_result(spark, tmp_path, readings):
    rng = random.Random(12)
    # Every reading may come up to two hours late.
    late = sorted(readings, key=lambda r: r[1] + timedelta(minutes=rng.uniform(0, 110)))
    batches = [late[i : i + 60] for i in range(0, len(late), 60)]
    end = [("z", START + timedelta(days=9), 1.0)]
    got = run(spark, readings, tmp_path, [*batches, end], ["k"], lateness="2 hours", wait_hours=48)
    df = spark.createDataFrame(readings, "k string, timestamp timestamp_ntz, load double")
    want = {(r.k, r.timestamp): r.load for r in interpolate_in_time(average_duplicates(df, ["k"]), ["k"]).collect()}
    found = {(r.k, r.timestamp): r.load for r in got if r.k != "z"}
    assert len(got) - sum(r.k == "z" for r in got) == len(found) == len(want) and found.keys() == want.keys()
    assert all(abs(found[x] - want[x]) < 1e-9 for x in want)
    known = {(k, t) for k, t, v in readings if v is not None}
    assert all(r.filled == ((r.k, r.timestamp) not in known) for r in got if r.k != "z")


def test_long_gaps_keep_the_last_value_and_late_readings_go(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    batches = [
        [("a", at(0), 2.0), ("a", at(1), None), ("b", at(0), None), (None, at(0), 5.0), ("a", None, 7.0)],
        [("a", at(10), None)], [("a", at(30), 4.0)], [("a", at(0), 100.0)], [("z", at(100), 1.0)],
    ]
    got = run(spark, None, tmp_path, batches, ["k"], lateness="1 hour", wait_hours=5)
    found = {(r.k, r.timestamp): (r.load, r.filled) for r in got}
    assert found[("a", at(0))] == (2.0, False) and found[("a", at(1))] == (2.0, True) and found[("a", at(10))] == (2.0, True)
    assert found[("a", at(30))] == (4.0, False) and found[("b", at(0))] == (None, True) and found[(None, at(0))] == (5.0, False)
    assert len(found) == len(got) == 6


def test_without_keys(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    got = run(spark, None, tmp_path, [[("a", at(0), 1.0), ("b", at(0), 3.0), ("a", at(1), None), ("a", at(2), 4.0)], [("a", at(50), 0.0)]], [], lateness="1 hour")
    assert [(r.timestamp, r.load) for r in sorted(got, key=lambda r: r.timestamp)] == [(at(0), 2.0), (at(1), 3.0), (at(2), 4.0)]
