"""Nulls, repeats and empty tables in the operators that fill rows from other tables."""

from pyspark.sql import functions as F

from terrane.operators import backfill, extract, reports, state
from terrane.sources.listings import append, landed_by_alias, rebuild


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_numbers_match_whole(spark):
    src = spark.createDataFrame([(1, "1"), (1, "10"), (1, None), (None, "1"), (1, "")], "parent int, name string")
    dim = spark.createDataFrame([(5, 1, "10"), (6, 1, "1"), (7, 1, "11"), (8, 2, "1"), (4, 1, "")], "id int, parent int, name string")
    assert rows(backfill.in_parent(src, dim)) == [(1, "", 4, 1), (1, "1", 6, 1), (1, "10", 5, 1)]
    assert rows(backfill.in_parent(src, dim.limit(0))) == []


def test_alias_is_last(spark):
    src = spark.createDataFrame([(1, "thu duc"), (2, "thu duc")], "parent int, name string")
    dim = spark.createDataFrame([(5, 1, "quan thu duc cu"), (6, 1, "thu duc"), (7, 2, "duc")], "id int, parent int, name string")
    aliases = spark.createDataFrame([("thu duc", "duc")], "name string, alias string")
    assert rows(backfill.in_parent(src, dim, 30, aliases)) == [(1, "thu duc", 6, 1), (2, "thu duc", 7, 3)]


def test_first_source_that_has_the_key(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, None, None), (4, "a", 9)], "id int, k string, t int")
    one = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "key string, value int")
    two = spark.createDataFrame([("a", 7), ("b", 8)], "key string, value int")
    out = backfill.looked_up(target, "t", [(F.lit(True), F.col("k"), one), (F.col("id") > 1, F.col("k"), two)])
    assert rows(out) == [(1, "a", 2), (2, "b", 8), (3, None, None), (4, "a", 9)]


def test_history(spark):
    df = spark.createDataFrame([(1, 1, " 7,7,x,2", "NEW"), (2, 1, None, "NEW"), (11, 1, "q", "NEW"), (3, 3, "7,x", "NEW"), (4, 4, "5", "NEW"), (5, 4, "", None)], "id long, origin long, history string, status string")
    want = [(1, 1, "7,2,11", "NEW"), (11, 1, "q", "POSTAGAIN"), (2, 1, None, "POSTAGAIN"), (3, 3, "7,x", "NEW"), (4, 4, "5", "NEW"), (5, 4, "", "POSTAGAIN")]
    assert rows(backfill.history_appended(df)) == want


def test_staged_rows(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "id int, v string")
    stage = spark.createDataFrame([(1, "b"), (1, "a"), (3, "c"), (None, "n"), (None, "n")], "id int, v string")
    assert rows(backfill.staged(target, stage, ["id"], [F.col("v")])) == sorted([(1, "a"), (2, "old"), (3, "c"), (None, "n"), (None, "n"), (None, "old")], key=str)
    assert rows(backfill.staged_counts(target, stage, ["id"])) == [(3, 1, 1)]
    assert rows(backfill.staged_counts(target, stage.limit(0), ["id"])) == [(0, 0, 0)]


def test_merge_into_an_unknown_place(spark):
    src = spark.createDataFrame([(1, 10, "d", "w"), (2, 10, "x", "w"), (3, None, "d", "w")], "id long, region long, district string, ward string")
    dim = spark.createDataFrame([(10, 0, "r"), (20, 10, "d"), (30, 20, "w")], "id long, parent long, name string")
    split = spark.createDataFrame([], "region long, district string, target long")
    merged = spark.createDataFrame([(30, "w", 99, 20)], "old long, old_name string, new long, new_parent long")
    assert rows(backfill.wards_resolved(src, dim, split, merged)) == [(1, 30, 30, "w", 10)]


def test_counts_and_gates(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (9, "b")], "k int, g string")
    right = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(reports.matched_counts(left, right, "k", ["g"])) == [("a", 3, 2, 5)]
    steps = spark.createDataFrame([(True, None), (False, True), (True, True)], "a boolean, b boolean")
    assert rows(steps.select(state.signed_gate([F.col("a"), F.col("b")]))) == [(-1,), (-2,), (2,)]


def test_table_rows_without_tables(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<table><tr><td>a</td></tr></table>"), (4, "<table><tr><td> </td><td>b</table>")], "id int, html string")
    out = extract.table_rows(pages, "table tr", [extract.Cell("x", 0), extract.Cell("y", 1), extract.Cell("z", 1, "b", 2)], 2)
    assert rows(out) == [(4, 0, None, "b", None)]


def test_landing_of_odd_json(spark):
    from pyspark.sql import types as T

    schema = T.StructType().add("is_new", "integer").add("at", "timestamp").add("x", "string")
    df = spark.createDataFrame([(1, '{"isNew":true,"x":[1,{"a":2}],"at":"Tue, 2 Jan 2024 03:04:05 GMT"}'), (2, "no json"), (3, None), (4, '{"is_new":null,"isNew":5,"at":"never"}')], "id int, j string")
    got = [(r[0], r[1], str(r[2]) if r[2] else None, r[3]) for r in landed_by_alias(df, "j", schema).orderBy("id").collect()]
    assert got == [(1, 1, "2024-01-02 03:04:05", '[1,{"a":2}]'), (2, None, None, None), (3, None, None, None), (4, None, None, None)]


def test_append_and_rebuild(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    append(df, path)
    append(df, path)
    assert spark.read.parquet(path).count() == 6
    rebuild(df, path)
    assert spark.read.parquet(path).count() == 3
