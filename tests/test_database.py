"""Databases: Derby, which comes with Spark, in memory."""

import uuid

import pytest
from pyspark.sql import functions as F

from terrane.sources import database, listings

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture
def url(spark):
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def test_ranges(spark, url):
    df = spark.range(100).select(F.col("id").alias("n"), (F.col("id") % 7).alias("v")).union(spark.sql("SELECT NULL, 1L"))
    df.write.jdbc(url, "facts", properties=DERBY)
    got = database.read_ranges(spark, url, "facts", "n", 4, **DERBY)
    assert got.rdd.getNumPartitions() == 4
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in df.collect()}
    assert got.count() == 101
    assert listings.jdbc_table(spark, url, "facts", "n", 0, 100, 3, **DERBY).where("n BETWEEN 10 AND 19").count() == 10
    df.limit(0).write.jdbc(url, "nothing", properties=DERBY)
    assert database.read_ranges(spark, url, "nothing", "n", 4, **DERBY).count() == 0


def test_merge(spark, url):
    schema = "k int, h int, v string, at int"
    spark.createDataFrame([(1, 1, "old", 1), (2, None, "old", 1), (None, None, "old", 1), (9, 9, "kept", 1)], schema).write.jdbc(url, "medians", properties=DERBY)
    new = spark.createDataFrame([(1, 1, "new", 3), (1, 1, "stale", 2), (2, None, "new", 3), (None, None, "new", 3), (None, 4, "added", 3), (5, 5, "added", 3)], schema)
    table = lambda: sorted(tuple(map(str, r)) for r in spark.read.jdbc(url, "medians", properties=DERBY).collect())
    before, counts = table(), {"inserted": 2, "updated": 3, "repeated": 1}
    assert database.merge_into(new, url, "medians", ["k", "h"], [F.desc("at")], dry_run=True, **DERBY) == counts
    assert table() == before
    assert database.merge_into(new, url, "medians", ["k", "h"], [F.desc("at")], **DERBY) == counts
    want = sorted([("1", "1", "new", "3"), ("2", "None", "new", "3"), ("None", "None", "new", "3"), ("9", "9", "kept", "1"), ("None", "4", "added", "3"), ("5", "5", "added", "3")])
    assert table() == want
    assert database.merge_into(new, url, "medians", ["k", "h"], [F.desc("at")], **DERBY) == {"inserted": 0, "updated": 5, "repeated": 1}
    assert table() == want
    # What cannot be merged changes nothing, and no staging table stays.
    with pytest.raises(Exception):
        database.merge_into(new.withColumnRenamed("v", "other"), url, "medians", ["k", "h"], [F.desc("at")], **DERBY)
    assert table() == want
    names = spark.read.jdbc(url, "(SELECT TABLENAME AS t FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') x", properties=DERBY).collect()
    assert [r[0] for r in names] == ["MEDIANS"]
