"""Tables of databases: read by ranges of a key, and merged into in one transaction."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.state import first_rows


def read_ranges(spark: SparkSession, url: str, name: str, key: str, parts: int, quote: str = '"', **options: str) -> DataFrame:
    """A table read in `parts` ranges of a whole-number key, from its least to its greatest value; rows without a key are in
    the first range. Only the two bounds are asked for before. `quote`: the database's mark around names of columns."""
    column = f"{quote}{key}{quote}"
    bounds = spark.read.jdbc(url, f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {name}) bounds", properties=options).first()
    low, high = bounds[0], bounds[1]
    if low is None or low == high:
        return spark.read.jdbc(url, name, properties=options)
    return spark.read.jdbc(url, name, column=key, lowerBound=int(low), upperBound=int(high) + 1, numPartitions=parts, properties=options)


@contextmanager
def _transaction(spark: SparkSession, url: str, options: dict[str, str]) -> Iterator:
    """A statement of one transaction on the driver; whatever fails inside undoes it."""
    jvm = spark.sparkContext._jvm
    given = jvm.java.util.Properties()
    for k, v in options.items():
        given.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        yield statement
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _one(statement, sql: str) -> int:
    rows = statement.executeQuery(sql)
    rows.next()
    out = rows.getLong(1)
    rows.close()
    return int(out)


def merge_into(df: DataFrame, url: str, name: str, keys: list[str], order: list[Column], dry_run: bool = False, quote: str = '"', **options: str) -> dict[str, int]:
    """Upsert the rows of `df` into the table `name`, which has their columns: of each key the first row in order replaces
    the table's rows of that key, or is added. Null keys are equal to each other, so a repeated run adds nothing.

    The executors write a staging table of this attempt's own name; then one transaction deletes and inserts, so a failed
    run leaves the table as it was, and the staging table goes in any case. Returns the rows `inserted`, `updated` and `repeated`
    (left out for an earlier one of their key); with `dry_run` these are counted and nothing changes. `quote` as in `read_ranges`."""
    spark = df.sparkSession
    stage, columns = f"stage_{uuid.uuid4().hex[:16]}", ", ".join(f"{quote}{c}{quote}" for c in df.columns)
    same = " AND ".join(f"(t.{k} = s.{k} OR (t.{k} IS NULL AND s.{k} IS NULL))" for k in [f"{quote}{k}{quote}" for k in keys])
    first_rows(df, keys, order).write.jdbc(url, stage, mode="errorifexists", properties=options)
    try:
        with _transaction(spark, url, options) as statement:
            staged = _one(statement, f"SELECT COUNT(*) FROM {stage}")
            known = _one(statement, f"SELECT COUNT(*) FROM {stage} s WHERE EXISTS (SELECT 1 FROM {name} t WHERE {same})")
            if not dry_run:
                statement.executeUpdate(f"DELETE FROM {name} t WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {same})")
                statement.executeUpdate(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {stage}")
    finally:
        with _transaction(spark, url, options) as statement:
            statement.executeUpdate(f"DROP TABLE {stage}")
    total = df.agg(F.count("*")).first()[0]
    return {"inserted": staged - known, "updated": known, "repeated": int(total) - staged}
