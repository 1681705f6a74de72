"""Listings as they arrive: statistics follow in micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from terrane.operators.state import first_rows
from terrane.operators.stats import trimmed_stats


def arriving(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def upserting(stream: DataFrame, table: str, checkpoint: str, keys: list[str], version: str) -> StreamingQuery:
    """Append each micro-batch, of each key its last row, to a Parquet log; `latest` reads the table that it makes. Of equal
    versions in a batch the greatest row in the order of its columns counts, of those of two batches the later one's.

    A batch that runs again after a failure overwrites its own folder, so no row is there twice.
    """

    def put(batch: DataFrame, number: int) -> None:
        others = [F.desc(f.name) for f in batch.schema.fields if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]
        first_rows(batch, keys, [F.desc(version), *others]).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, table: str, keys: list[str], version: str) -> DataFrame:
    """Of each key the last row of the log."""
    return first_rows(spark.read.parquet(table), keys, [F.desc(version), F.desc("batch")]).drop("batch")


def windowed_counts(stream: DataFrame, at: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Counts in tumbling windows; rows later than `late` are dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *keys).count().select(F.col("window.start").alias("start"), *keys, "count")


def affected(facts: DataFrame, fresh: DataFrame, keys: list[str], build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Statistics of just those groups that have fresh rows, each from all of its rows."""
    touched = fresh.select(*keys).distinct()
    return build(facts.unionByName(fresh).join(touched, keys, "left_semi"))


def keeping_stats(stream: DataFrame, table: str, checkpoint: str, keys: list[str], value: str) -> StreamingQuery:
    """Trimmed statistics of groups as their rows arrive. The state is what can be merged: how often each value is in each
    group. A micro-batch adds its own counts, and the groups that it touches get statistics of all counts so far; no
    old row is read again. `latest_stats` reads them.

    Counts and statistics of a batch lie in folders of its number, which a batch that runs again overwrites, so none counts twice."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = batch.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("copies"))
        own.write.mode("overwrite").parquet(f"{table}/counts/batch={number}")
        every = counts_so_far(spark, table, number)
        touched = every.where(F.col("batch") == number).select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        stats = trimmed_stats(every.join(touched, same, "left_semi"), keys, value, "copies")
        stats.write.mode("overwrite").parquet(f"{table}/stats/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _folders(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches that have a folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def counts_so_far(spark: SparkSession, table: str, number: int) -> DataFrame:
    """The counts of all batches up to a number: those merged last, and the ones of each batch after these."""
    merged = [n for n in _folders(spark, f"{table}/merged") if n < number]
    base = merged[-1] if merged else -1
    rows = spark.read.parquet(f"{table}/counts").where((F.col("batch") > base) & (F.col("batch") <= number))
    return rows.unionByName(spark.read.option("basePath", f"{table}/merged").parquet(f"{table}/merged/batch={base}")) if merged else rows


def merge_counts(spark: SparkSession, table: str, keys: list[str], value: str) -> None:
    """Add up the counts of all batches that have statistics, so that later batches read one table instead of many."""
    done = _folders(spark, f"{table}/stats")
    if done:
        rows = counts_so_far(spark, table, done[-1]).groupBy(*keys, value).agg(F.sum("copies").alias("copies"))
        rows.write.mode("overwrite").parquet(f"{table}/merged/batch={done[-1]}")


def latest_stats(spark: SparkSession, table: str, keys: list[str]) -> DataFrame:
    """Of each group the statistics of the last batch that touched it."""
    return first_rows(spark.read.parquet(f"{table}/stats"), keys, [F.desc("batch")]).drop("batch")
