"""Streams of micro-batches: statistics from mergeable counts, windows, ties."""

import datetime
import random
import shutil

from terrane.operators.stats import trimmed_stats
from terrane.streaming import incremental

KEYS = ["g", "month"]
SCHEMA = "g string, month string, v double"


def write(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def made(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "a", "b", None]), f"2024-0{rng.randint(1, 3)}", rng.choice([None, float(rng.randint(1, 40)), 7.0])) for _ in range(n)]


def as_set(df):
    return {tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*KEYS, "avg", "median", "min", "max", "stddev", "total_rows", "trimmed_rows").collect()}


def test_statistics_follow_a_stream(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / x) for x in ("in", "t", "cp"))
    rows = made(1, 300)
    write(spark, source, [rows[:100], rows[100:200]])
    run = lambda: incremental.keeping_stats(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), table, checkpoint, KEYS, "v").awaitTermination()
    whole = lambda n: as_set(trimmed_stats(spark.createDataFrame(rows[:n], SCHEMA), KEYS, "v"))
    run()
    assert as_set(incremental.latest_stats(spark, table, KEYS)) == whole(200)
    # A batch that was done but not committed runs again.
    for name in ("1", ".1.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    run()
    assert as_set(incremental.latest_stats(spark, table, KEYS)) == whole(200)
    incremental.merge_counts(spark, table, KEYS, "v")
    shutil.rmtree(tmp_path / "t" / "counts" / "batch=0")
    write(spark, source, [rows[200:]])
    run()
    assert as_set(incremental.latest_stats(spark, table, KEYS)) == whole(300)
    touched = {tuple(r) for r in spark.createDataFrame(rows[200:], SCHEMA).where("v IS NOT NULL").select(*KEYS).distinct().collect()}
    assert {tuple(r) for r in spark.read.parquet(f"{table}/stats/batch=2").select(*KEYS).collect()} == touched


def test_windowed_counts(spark, tmp_path):
    at = datetime.datetime(2024, 5, 1)
    minutes = [0, 3, 4, 11, 40, 2]
    for part in (minutes[:5], minutes[5:]):
        spark.createDataFrame([(at + datetime.timedelta(minutes=m), "k") for m in part], "at timestamp, k string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("at timestamp, k string").parquet(str(tmp_path / "in"))
        out = incremental.windowed_counts(stream, "at", ["k"], "10 minutes", "5 minutes")
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = {(r["start"] - at).total_seconds() / 60: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # The last row is too late for its window, which had gone out.
    assert got == {0.0: 3, 10.0: 1}


def test_equal_versions_have_one_winner(spark, tmp_path):
    rows = [(1, 5, "b", 2), (1, 5, "a", 9), (1, 5, "b", 1)]
    for order in (rows, rows[::-1]):
        folder = tmp_path / str(order[0][3])
        spark.createDataFrame(order, "k int, at int, v string, w int").repartition(3).write.parquet(str(folder / "in"))
        incremental.upserting(incremental.arriving(spark, str(folder / "in"), "k int, at int, v string, w int"), str(folder / "t"), str(folder / "cp"), ["k"], "at").awaitTermination()
        assert [tuple(r) for r in incremental.latest(spark, str(folder / "t"), ["k"], "at").select("k", "at", "v", "w").collect()] == [(1, 5, "b", 2)]
