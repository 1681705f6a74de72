"""Statistics, state, matching, extraction, sources and streams on small tables."""

import json
import math
import random
import statistics
import tempfile

import duckdb
import pytest
from oracle import same
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions import parse
from terrane.operators import extract, liquidity, resolve, state, stats
from terrane.plans import registry
from terrane.sources import listings
from terrane.streaming import incremental


def test_trimmed_statistics(spark):
    rng = random.Random(3)
    groups = {f"g{n}": [float(rng.randrange(1, 30)) for _ in range(n)] for n in (1, 2, 9, 10, 11, 20, 57)}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in [*vs, None]], "g string, v double")
    got = {r["g"]: r for r in stats.trimmed_stats(df, ["g"], "v").collect()}
    for g, vs in groups.items():
        vs = sorted(vs)
        cut = len(vs) // 10
        kept = vs[cut : len(vs) - cut]
        r = got[g]
        assert (r["total_rows"], r["trimmed_rows"], r["min"], r["max"]) == (len(vs), len(kept), kept[0], kept[-1])
        assert r["median"] == statistics.median(vs) == statistics.median(kept)
        assert math.isclose(r["avg"], statistics.mean(kept)) and math.isclose(r["avg_all"], statistics.mean(vs))
        assert math.isclose(r["stddev"], statistics.pstdev(kept), abs_tol=1e-9)
    assert stats.trimmed_stats(df.limit(0), ["g"], "v").count() == 0


#: Known scores: rows, coefficient of variation, rows / coefficient.
GOLDEN = [(345, 0.375042, 919.90), (20, 0.277844, 71.98), (7, 0.266668, 26.25), (427, 1.781987, 239.62), (411, 0.373825, 1099.44), (36, 0.358207, 100.50), (5, 0.155074, 32.24), (416, 0.604908, 687.71), (51, 0.404037, 126.23), (47, 0.386584, 121.58)]


def test_vitality_numbers():
    assert all(abs(n / cv - score) < 0.011 for n, cv, score in GOLDEN)


@pytest.mark.parametrize("n, high, low", [(1, 1, 0), (2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 2, 2), (8, 2, 2)])
def test_levels(spark, n, high, low):
    rows = [("ward", "month", "2024-01", 1, i, None, 1, 10, float(i)) for i in range(n)] + [("ward", "month", "2024-01", 1, 99, None, 1, 9, 1e9), ("ward", "month", "2024-01", 1, 98, None, 1, 50, None)]
    df = spark.createDataFrame(rows, "scope string, period_type string, period_value string, province int, ward long, street long, grp int, trimmed_rows long, vitality double")
    got = [r["level"] for r in liquidity.levels(df).collect()]
    assert (got.count(liquidity.HIGH), got.count(liquidity.LOW), got.count(liquidity.TOO_FEW)) == (high, low, 2)


def test_upserts(spark):
    schema = "k int, v string, at int"
    old = spark.createDataFrame([(1, "a", 1), (None, "n", 1), (2, None, 1), (3, "0", 1)], schema)
    new = spark.createDataFrame([(1, "b", 2), (None, "m", 2), (2, "c", 2), (3, " ", 2), (4, "d", 2)], schema)
    last = {r["k"]: r["v"] for r in state.upsert_last(old, new, ["k"], "at").collect()}
    assert last == {1: "b", None: "m", 2: "c", 3: " ", 4: "d"}
    again = state.upsert_last(state.upsert_last(old, new, ["k"], "at"), new, ["k"], "at")
    assert again.count() == 5
    keep = {r["k"]: r["v"] for r in state.upsert_by(old, new, ["k"], {"v": state.keep_existing("v")}).collect()}
    assert keep == {1: "a", None: "n", 2: "c", 3: "0", 4: "d"}
    better = {r["k"]: r["v"] for r in state.upsert_by(old, new, ["k"], {"v": state.improve_only("v")}).collect()}
    assert better == {1: "a", None: "n", 2: "c", 3: "0", 4: "d"}
    assert [r["k"] for r in state.insert_ignore(old, new.union(new), ["k"], [F.col("at")]).collect()] == [4]


def test_reposts_do_not_chain(spark):
    rows = [(1, "p", "u", 1), (2, "p", "w", 2), (3, "q", "w", 3), (4, None, None, 4), (5, None, "z", 5)]
    got = {r["id"]: r["origin"] for r in state.reposts(spark.createDataFrame(rows, "id int, a string, b string, at int"), "a", "b", ["at", "id"]).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 4, 5: 5}


def test_split_is_null_safe(spark):
    a, b = state.split_by(spark.createDataFrame([(1,), (None,), (-1,)], "x int"), F.col("x") > 0)
    assert (a.count(), b.count()) == (1, 2)


def test_matching_cascade(spark):
    src = spark.createDataFrame([(1, "Sao Mai", "A"), (2, "sao  mai", "A"), (3, "Chung cư Sao Mai", "B"), (4, "Sao Mai Riverside Towers", "A"), (5, "Khác hẳn", "A"), (6, "", "A")], "id int, name string, region string")
    dst = spark.createDataFrame([(10, "Sao Mai", "A"), (11, "Sao Mai", "B"), (12, "Sao Mai Riverside Tower", "A")], "id int, name string, region string")
    got = {r["id"]: (r["target"], r["kind"]) for r in resolve.matched(src, dst).collect()}
    assert got == {1: (10, "exact"), 2: (10, "norm_region"), 3: (11, "core_region"), 4: (12, "fuzzy")}
    assert resolve.matched(src.limit(0), dst).count() == 0


def test_other_numbers_cost(spark):
    name = "khu nha o sao mai xanh gan song hong "
    side = lambda *rows: resolve.named(spark.createDataFrame([(i, name + n, None) for i, n in enumerate(rows)], "id long, name string, region string"))
    score = lambda penalty: {r["d_norm"][-1]: r["score"] for r in resolve.scored(side("1"), side("1", "2"), 0.76, penalty).collect()}
    assert score(0.0)["1"] == 1.0 and abs(score(0.0)["2"] - score(0.1)["2"] - 0.1) < 1e-9 and set(score(0.18)) == {"1"}


def test_extraction(spark):
    html = '<div id="m"><h1 class="t x">A &amp; <b>B</b></h1><img src="1.png"><a href="/x" data-phone="09">call</a><p>one<p>two<script>no</script></div>'
    fields = [extract.Field("title", "div#m h1.t"), extract.Field("img", "img", "src"), extract.Field("phone", "//a[@data-phone]", "data-phone"), extract.Field("raw", "h1.x", "html"), extract.Field("all", "p", many=True), extract.Field("none", "h2"), extract.Field("cut", "a", exclude=("ca",))]
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>unclosed")], "id int, html string")
    one, two, three = [tuple(r)[1:] for r in extract.extracted(df, fields).orderBy("id").collect()]
    assert one == ("A & B", "1.png", "09", "A &amp; <b>B</b>", "one||two", None, "ll")
    assert two == (None,) * 7 and three[4] == "unclosed"


def test_page_fields_with_references_without_semicolon(spark, tmp_path):
    titles = ["a &amp; b&amp", "x&lt y", "&amp;lt;&amplt;", "&AMP;&quot", "&am"]
    page = lambda h: f'<html lang="en"><body><nav><li><a href="/x">x</a></li></nav><div class="ad">{h}</div><article><h1>{h}</h1></article></body></html>'
    spark.createDataFrame([(i, page(h)) for i, h in enumerate(titles)], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    same(registry.queries()["page_fields"](spark, str(tmp_path)), registry.oracle_sql()["page_fields"], con)



def test_sources(spark, tmp_path):
    (tmp_path / "feed.json").write_text(json.dumps({"data": {"ads": [{"id": 1, "t": "a"}, {"id": 2, "t": None}]}}))
    feed = listings.json_feed(spark, str(tmp_path / "feed.json"), T.StructType.fromDDL("id long, t string"))
    assert [tuple(r) for r in feed.orderBy("id").collect()] == [(1, "a"), (2, None)]
    (tmp_path / "ids.txt").write_text("id\nward 12 x\n7\n12\n")
    assert [r["id"] for r in listings.id_list(spark, str(tmp_path / "ids.txt")).orderBy("place").collect()] == [12, 7]
    df = spark.createDataFrame([(2, None, "2024-01"), (1, "x", "2024-02")], "a int, b string, month string")
    listings.write_tsv(df, str(tmp_path / "out"), [F.col("a")])
    back = listings.ordered_tsv(spark, str(tmp_path / "out"), T.StructType.fromDDL("a int, b string, month string"))
    assert [r["a"] for r in back.orderBy("place").collect()] == [1, 2]
    listings.write_bulk_csv(df, str(tmp_path / "bulk"))
    assert "\\N" in "".join(r[0] for r in spark.read.text(str(tmp_path / "bulk")).collect())
    listings.write_stats(df, str(tmp_path / "stats"))
    listings.write_stats(df.where("a = 1").withColumn("b", F.lit("new")), str(tmp_path / "stats"))
    assert {(r["a"], r["b"]) for r in spark.read.parquet(str(tmp_path / "stats")).collect()} == {(2, None), (1, "new")}


def test_stream_upserts(spark):
    root = tempfile.mkdtemp(prefix="spark-")
    schema = T.StructType.fromDDL("k int, v string, at int")
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema).write.parquet(f"{root}/in/1")
    source = f"{root}/in/*"
    for _ in range(2):
        incremental.upserting(incremental.arriving(spark, source, schema), f"{root}/log", f"{root}/cp", ["k"], "at").awaitTermination()
        got = {(r["k"], r["v"]) for r in incremental.latest(spark, f"{root}/log", ["k"], "at").collect()}
        spark.createDataFrame([(2, "d", 5)], schema).write.mode("overwrite").parquet(f"{root}/in/2")
    assert got == {(1, "b"), (2, "d")}


@pytest.mark.parametrize("ranged", [False, True])
def test_hot_group_of_trimmed_stats(spark, ranged):
    """One group of half of all rows, with ties, negative values, fractions and a second key that is null."""
    rng = random.Random(3)
    rows = [("hot", None, rng.choice([rng.random() * 1e6, float(rng.randint(-50, 50)), 7.5, -rng.random()])) for _ in range(4000)]
    rows += [(f"g{i % 400}", i % 2, float(rng.randint(1, 9))) for i in range(4000)] + [("one", 1, 3.0), ("none", 1, None)]
    got = stats.trimmed_stats(spark.createDataFrame(rows, "g string, h int, v double"), ["g", "h"], "v", ranged=ranged)
    want = {}
    for key in {r[:2] for r in rows}:
        v = sorted(r[2] for r in rows if r[:2] == key and r[2] is not None)
        if v:
            t = v[len(v) // 10 : len(v) - len(v) // 10]
            want[key] = (statistics.fmean(t), statistics.median(v), t[0], t[-1], statistics.pstdev(t), len(v), len(t), statistics.fmean(v))
    out = {(r["g"], r["h"]): tuple(r[c] for c in ("avg", "median", "min", "max", "stddev", "total_rows", "trimmed_rows", "avg_all")) for r in got.collect()}
    assert out.keys() == want.keys()
    assert all(out[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9) for k in want)


def test_ranged_stats_order_no_whole_group(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, v double")
    plan = stats.trimmed_stats(df, ["g"], "v", ranged=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    # The one window over a group reads the counts of its ranges; that over values has the range in its key.
    windows = [line for line in plan.splitlines() if "Window [" in line and "copies" in line]
    assert windows and all("range" in line for line in windows)


def test_ranges_rise_with_values(spark):
    values = sorted([0.0, -0.5, 1e-9, 3.0, 3.000001, -7e9, 1e18, -1e18, 12.0, 12.01, 5e5])
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(stats.value_range(F.col("v"))).collect()]
    assert got == sorted(got) and max(map(abs, got)) < 20_000


def test_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(-0.125,), (0.125,), (-2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(stats.round2(F.col("x"))).collect()] == [-0.13, 0.13, -2.5, None]


def test_walk_of_any_depth(spark):
    """A chain of 1000, a wide root, circles with and without a tail, a missing parent, repeated and null nodes."""
    rows = [(i, i - 1 if i else None) for i in range(1001)] + [(i, 2000) for i in range(2001, 2300)] + [(2000, 0)]
    rows += [(3000, 3001), (3001, 3002), (3002, 3000), (3003, 3000), (4000, 9999), (4001, 4000), (5000, 5000), (5001, 5000), (6000, 7), (6000, 4000), (None, 5)]
    got = {r["id"]: r["root"] for r in state.ancestors(spark.createDataFrame(rows, "id long, parent long"), "id", "parent").collect()}
    assert got == {
        **dict.fromkeys(range(1001), 0), **dict.fromkeys(range(2000, 2300), 0), **dict.fromkeys(range(3000, 3004)), 4000: 4000, 4001: 4000, 5000: 5000, 5001: 5000, 6000: 0,
    }
    assert state.ancestors(spark.createDataFrame([], "id long, parent long"), "id", "parent").count() == 0


def test_reposts_of_rows_without_keys(spark):
    rows = [(1, "a", "u", 5), (2, "a", None, 4), (3, None, "u", 3), (4, None, None, 1), (5, "b", "u", 9), (6, None, None, 0)]
    df = spark.createDataFrame(rows, "id long, prj string, url string, at int")
    got = state.reposts(df, "prj", "url", ["at", "id"])
    assert {r["id"]: r["origin"] for r in got.collect()} == {1: 3, 2: 2, 3: 3, 4: 4, 5: 3, 6: 6}
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 2 and all("__spread" in line for line in joins)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _exchanges(df):
    """Shuffles of the plan as it is before it runs."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("copies", [None, "n"])
def test_small_groups_in_one_shuffle(spark, copies):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), rng.choice([None, *range(1, 9)]), rng.randrange(1, 4)) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, h int, v long, n long")
    small = stats.small_stats(df.repartition("g", "h"), ["g", "h"], "v", copies)
    assert _exchanges(small) == 1
    other = stats.trimmed_stats(df, ["g", "h"], "v", copies)
    key = lambda r: (str(r["g"]), r["h"])
    got, want = [sorted(x.select(*sorted(other.columns)).collect(), key=key) for x in (small, other)]
    assert len(got) == len(want) > 60 and all(a == b or math.isclose(a, b, abs_tol=1e-12) for x, y in zip(got, want) for a, b in zip(x, y))


def test_growth_reads_the_statistics_once(spark):
    rows = [(1, "2023-12", 50.0, 9), (1, "2024-01", 100.0, 9), (1, "2024-02", 110.0, 9), (1, "2024-04", 90.0, 9), (1, "2024-05", 99.0, 2), (1, "2025-01", 150.0, 9), (1, None, 7.0, 9), (None, "2024-01", 1.0, 9), (None, "2024-02", 2.0, 9)]
    out = stats.growth(spark.createDataFrame(rows, "k int, month string, median double, total_rows long"), ["k"], least=5)
    got = {(r["k"], r["month"]): (r["mom"], r["yoy"]) for r in out.collect()}
    assert got == {(1, "2023-12"): (None, None), (1, "2024-01"): (100.0, None), (1, "2024-02"): (10.0, None), (1, "2024-04"): (None, None), (1, "2024-05"): (None, None), (1, "2025-01"): (None, 50.0), (1, None): (None, None), (None, "2024-01"): (None, None), (None, "2024-02"): (None, None)}
    assert "Join" not in _plan(out)


def test_index_deals_periods_after_the_shuffle(spark):
    rows = [(1, 2, 3, True, m, g, p, None) for m in ("2024-01", "2024-02") for g in (1, None) for p in (5, 7, 9)]
    df = spark.createDataFrame(rows, "province int, ward int, street int, street_source boolean, month string, grp int, price long, land_price long")
    stored = spark.createDataFrame([("ward", "2024-01", 1, 2, None, 1, 4.0), ("ward", "2030-01", 1, 2, None, 1, 4.0)], "scope string, period_value string, province int, ward int, street int, grp int, stored double")
    out = liquidity.index(df, stored)
    # The counts of wards and regions, the rows of each place, and the cohorts.
    assert _exchanges(out) == 3
    got = {(r["scope"], r["period_value"]): (r["raw_rows"], r["median"], r["median_source"]) for r in out.collect()}
    want = {(s, v): (n, 7.0, "computed") for s in ("ward", "region", "street") for v, n in (("2024-01", 3), ("2024-02", 3), ("2024-Q1", 6), ("2024", 6))}
    assert got == want | {("ward", "2024-01"): (3, 4.0, "stored")}
    assert "Join" not in _plan(out)


def test_all_scopes_deal_small_groups_once(spark):
    rows = [(1, 2, 3, 4, 1, "2024-01", True, 5, 4), (1, 2, 3, 4, None, "2024-01", False, 7, None)]
    out = stats.all_scopes(spark.createDataFrame(rows, "province int, ward int, street int, project int, grp int, month string, street_source boolean, price long, land_price long"))
    # The counts of the large groups, and the rows of each group to its task.
    assert _exchanges(out) == 2
    got = {(r["scope"], r["grp"]): (r["median"], r["total_rows"]) for r in out.collect()}
    assert got == {(s, g): v for s in ("ward", "region", "project", "street") for g, v in ((1, (5.0, 1)), (5, (4.0, 1)))} | {("region_total", 0): (6.0, 2), ("region_total", 5): (4.0, 1)}


def test_filters_do_not_parse_twice(spark):
    for name in ("clean_backlog", "clean_rejected"):
        plan = _plan(registry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract" in line]


def test_any_date_by_its_signs(spark):
    texts = ["2024-01-31 10:11:12", "2024-01-31", "31/01/2024", "31-01-2024", "2024-01-31T10:11:12.5", " 2024-01-31 ", "31-1-2024", "1706659200", "2024/01/31", "-", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").select("i", F.date_format(parse.any_date(F.col("x")), "yyyy-MM-dd HH:mm:ss").alias("y"))
    got = [r["y"] for r in df.orderBy("i").collect()]
    day, clock = "2024-01-31 00:00:00", "2024-01-31 10:11:12"
    assert got == [clock, day, day, day, clock, day, *[None] * 6]
    assert "CASE" in _plan(df)
