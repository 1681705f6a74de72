"""Queries whose steps are tables: what is read several times is made once, and rows are sent no wider than needed."""

import random
import time
from pathlib import Path

import pytest
from conftest import SMALL
from oracle import connection, same
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terrane.operators import liquidity, stats
from terrane.plans.facts import facts
from terrane.sources import stored

FACTS = "province int, ward int, street int, project int, grp int, month string, street_source boolean, price long, land_price long"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _facts(spark, n=1500):
    rng = random.Random(11)
    pick = lambda *x: rng.choice(x)
    months = ["2023-12", "2024-01", "2024-02", "2024-11", None]
    rows = [
        (pick(1, 2, None), pick(1, 2, 3, None), pick(0, 1, 2, None), pick(0, 1, 2, None), pick(1, 2, 5, None), pick(*months), pick(True, True, False, None), pick(None, 0, *range(1, 60)), pick(None, 0, *range(1, 60)))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, FACTS)


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


@pytest.mark.parametrize("name", ["liquidity_index", "liquidity_index_stored_medians", "median_all_scopes"])
def test_lines_are_read_once(spark, name):
    df = entry.queries()[name](spark, SMALL)
    assert "l_orderkey" not in _plan(df)
    same(df, entry.oracle_sql()[name], connection(SMALL))


def test_lines_are_shuffled_narrow(spark):
    """Months, groups and flags are made below the joins, so that texts and times are not sent."""
    top, below = _plan(facts(spark, SMALL)).split("Join", 1)
    for made in ("date_format", "l_returnflag", "p_type"):
        assert made not in top and made in below


def test_a_street_row_carries_both_prices(spark):
    rows = spark.createDataFrame([(1, 2, 3, 4, 1, "2024-01", True, 50, 40), (1, 2, 3, 4, None, "2024-01", True, 70, None), (1, 2, 3, 4, None, "2024-01", True, 70, 30)], FACTS)
    streets = liquidity.spread_out(rows).where("scope = 2")
    assert sorted((r["price"], r["land_price"]) for r in streets.collect()) == [(50, 40), (70, 30)]
    got = sorted((r["grp"], r["value"], r["copies"]) for r in liquidity.priced(streets).collect())
    assert got == [(1, 50, 1), (5, 30, 1), (5, 40, 1)]


def test_too_few_rows_are_not_sent_to_cohorts(spark, tmp_path):
    df = _facts(spark)
    given = spark.createDataFrame([("ward", "2024-01", 1, 2, None, 1, 4.0), ("ward", "2030-01", 1, 2, None, 1, 4.0), ("ward", None, 1, 3, None, 5, 9.0)], "scope string, period_value string, province int, ward int, street int, grp int, stored double")
    liquidity.measures(df, given, liquidity.counts(df)).write.parquet(str(tmp_path / "m"))
    table = spark.read.parquet(str(tmp_path / "m"))
    out = liquidity.ranked(table, table=True)
    # Both sides are read by whether they have enough rows.
    assert sum("Filter" in line and ">= 10" in line for line in _plan(out).splitlines()) == 2
    got, want = _rows(out), _rows(liquidity.index(df, given))
    assert got == want and len({r["level"] for r in out.select("level").distinct().collect()}) == 4
    assert {r["median_source"] for r in out.select("median_source").distinct().collect()} == {"stored", "computed"}


def test_scope_of_counts(spark):
    df = _facts(spark)
    counted = liquidity.counts(df)
    for scope in stats.SCOPES[:2]:
        assert _rows(stats.scope_stats(counted, scope, copies="copies")) == _rows(stats.scope_stats(df, scope))


def test_values_are_counted_together(spark):
    rows = [(1, 2, 0, 0, 1, "2024-01", True, 5, 4)] * 3 + [(1, 2, 0, 0, 1, "2024-01", True, 5, 0), (1, 2, 0, 0, 1, "2024-01", True, -5, None), (1, 2, 0, 0, 1, "2024-01", True, None, 4)]
    counted = stats.value_counts(spark.createDataFrame(rows, FACTS), ["province", "ward"])
    got = sorted((r["price"] or 0, r["land_price"] or 0, r["copies"]) for r in counted.collect())
    assert got == [(0, 4, 1), (5, 0, 1), (5, 4, 3)]


def test_all_scopes_are_the_scopes(spark):
    df = _facts(spark)
    out = stats.all_scopes(df)
    # Rows become two, and hashes of places are made, where a place's rows are together.
    above, below = _plan(out).split("RepartitionByExpression")
    assert "xxhash64" in above and "xxhash64" not in below and "explode" in above
    want = [r for land in (False, True) for scope in stats.SCOPES for r in _rows(stats.scope_stats(df, scope, land))]
    assert _rows(out) == sorted(want) and len(want) > 300


def test_a_stored_step_leaves_no_shuffle_files(spark):
    """The files go at once, though the driver collects no garbage; the setting is as it was."""
    folder = Path(spark.conf.get("spark.local.dir"))
    files = lambda: {p for p in folder.rglob("shuffle_*.data")}
    before, was = files(), spark.conf.get(stored._REMOVE)
    df = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    assert sorted(r["k"] for r in stored.saved(df, "sums").collect()) == list(range(7))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(stored._REMOVE) == was
    # The frame itself can still be run, before and after.
    assert df.count() == 7 and stored.saved(df, "sums").count() == 7
