"""Queries of scans, joins, aggregations, windows, sorts, upserts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.operators import reports, state
from terrane.plans.facts import FACTS_SQL, facts
from terrane.plans.registry_type import Query
from terrane.sources.listings import table

QUERIES: list[Query] = []


def _add(name: str, sql: str | None):
    def register(run):
        QUERIES.append(Query(name, run, sql))
        return run

    return register


_EVENT_KEYS = ["user_id", "event_type"]
#: The older and the newer half of the events, by time.
_OLD_SQL = "old AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'), new AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16')"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _events(spark, d)
    cut = F.lit("2024-01-16").cast("timestamp")
    return e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)


# Scans, filters, projections


@_add("scan_filtered", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def _(spark, d):
    return table(spark, d, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000)).select("o_orderkey", "o_totalprice")


@_add("page_of_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").offset(100).limit(50)


@_add("renamed_with_constants", "SELECT c_custkey AS id, upper(c_name) AS name, 'customer' AS domain, CAST(0 AS INTEGER) AS process_status FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.upper("c_name").alias("name"), F.lit("customer").alias("domain"), F.lit(0).alias("process_status"))


@_add("complete_flag", "SELECT c_custkey, CASE WHEN trim(c_name) <> '' AND c_nationkey IS NOT NULL AND (c_acctbal > 0 OR c_mktsegment = 'BUILDING') THEN 1 ELSE 0 END AS complete FROM customer")
def _(spark, d):
    from terrane.functions.text import filled

    ok = filled(F.col("c_name")) & F.col("c_nationkey").isNotNull() & ((F.col("c_acctbal") > 0) | (F.col("c_mktsegment") == "BUILDING"))
    return table(spark, d, "customer").select("c_custkey", F.when(ok, 1).otherwise(0).alias("complete"))


@_add("in_between_like", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag NOT IN ('N') AND l_quantity BETWEEN 5 AND 20 AND p_name LIKE '%bolt%' AND NOT regexp_matches(p_name, '^(red|blue)')")
def _(spark, d):
    part = table(spark, d, "part").where(F.col("p_name").like("%bolt%") & ~F.col("p_name").rlike("^(red|blue)")).select("p_partkey")
    line = table(spark, d, "lineitem").where(~F.col("l_returnflag").isin("N") & F.col("l_quantity").between(5, 20))
    return line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_orderkey", "l_linenumber", "l_suppkey")


@_add("optional_filters", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1997")
def _(spark, d):
    def wanted(status=None, priority=None, year=None):
        return reports.all_of(
            None if status is None else F.col("o_orderstatus") == status,
            None if priority is None else F.col("o_orderpriority") == priority,
            None if year is None else F.year("o_orderdate") == year,
        )

    return table(spark, d, "orders").where(wanted(priority="1-URGENT", year=1997)).select("o_orderkey")


@_add("recent_rows", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 15 DAY")
def _(spark, d):
    return _events(spark, d).where(F.col("ts") >= F.lit("2024-01-31").cast("timestamp") - F.expr("INTERVAL 15 DAYS")).select("event_id")


@_add("mapped_by_dimension", "SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 10 WHEN 'PROMO' THEN 20 WHEN 'LARGE' THEN 30 END AS stratum FROM part")
def _(spark, d):
    mapping = F.create_map(*[F.lit(x) for x in ("ECONOMY", 10, "PROMO", 20, "LARGE", 30)])
    return table(spark, d, "part").select("p_partkey", F.try_element_at(mapping, F.col("p_type")).alias("stratum"))


@_add("range_guards", "SELECT c_custkey, CASE WHEN c_acctbal BETWEEN -90 AND 5000 THEN c_acctbal END AS lat, least(9, greatest(0, CAST(floor(c_acctbal / 1000) AS BIGINT))) AS band FROM customer")
def _(spark, d):
    band = F.least(F.lit(9), F.greatest(F.lit(0), F.floor(F.col("c_acctbal") / 1000)))
    return table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal").between(-90, 5000), F.col("c_acctbal")).alias("lat"), band.alias("band"))


@_add("deleted_by_condition", "SELECT p_partkey FROM part WHERE NOT (p_type IN ('SMALL', 'PROMO') AND p_retailprice < 1000)")
def _(spark, d):
    gone = F.col("p_type").isin("SMALL", "PROMO") & (F.col("p_retailprice") < 1000)
    return state.split_by(table(spark, d, "part"), gone)[1].select("p_partkey")


@_add("gated_steps", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN NOT coalesce(l_quantity > 5, FALSE) THEN 0 WHEN NOT coalesce(l_discount < 0.08, FALSE) THEN 1 WHEN NOT coalesce(l_returnflag <> 'N', FALSE) THEN 2
    WHEN NOT coalesce(l_tax > 0.01, FALSE) THEN 3 ELSE 4 END AS process_status FROM lineitem""")  # fmt: skip
def _(spark, d):
    steps = [F.col("l_quantity") > 5, F.col("l_discount") < 0.08, F.col("l_returnflag") != "N", F.col("l_tax") > 0.01]
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", state.gate(steps).alias("process_status"))


@_add("backlog_by_source", """SELECT o_orderstatus, count(*) AS waiting FROM orders WHERE o_totalprice < 200000 GROUP BY 1""")
def _(spark, d):
    return table(spark, d, "orders").where(F.col("o_totalprice") < 200000).groupBy("o_orderstatus").agg(F.count("*").alias("waiting"))


# Joins


@_add("hierarchy_joined", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")


@_add("old_ids_to_new", """SELECT c_custkey, coalesce(m.new_id, c.c_nationkey) AS nation FROM customer c LEFT JOIN (SELECT n_nationkey AS old_id, n_nationkey + 100 AS new_id FROM nation WHERE n_nationkey % 3 = 0) m ON c.c_nationkey = m.old_id""")
def _(spark, d):
    rows = table(spark, d, "nation").where("n_nationkey % 3 = 0")
    twice = rows.union(rows).select(F.col("n_nationkey").alias("old_id"), (F.col("n_nationkey") + 100).alias("new_id"))
    merge = state.one_row_a_key(twice, "old_id", [F.col("new_id")])
    return table(spark, d, "customer").join(merge, F.col("c_nationkey") == F.col("old_id"), "left").select("c_custkey", F.coalesce("new_id", "c_nationkey").alias("nation"))


@_add("left_join_filtered_dimension", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 1")
def _(spark, d):
    dim = table(spark, d, "nation").where("n_regionkey = 1")
    return table(spark, d, "customer").join(dim, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@_add("either_key_joined", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') OR EXISTS (SELECT 1 FROM supplier WHERE 'Customer#' || substr(s_name, 10) = c_name)")
def _(spark, d):
    o = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"), F.lit(None).cast("string").alias("n"))
    s = table(spark, d, "supplier").select(F.lit(None).cast("long").alias("k"), F.concat(F.lit("Customer#"), F.expr("substr(s_name, 10)")).alias("n"))
    both = o.unionByName(s)
    return reports.either_key(table(spark, d, "customer"), both, F.col("c_custkey") == F.col("k"), F.col("c_name") == F.col("n")).select("c_custkey")


@_add("computed_key_joined", "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON CAST(list_last(string_split(s_name, '#')) AS BIGINT) = CAST(list_last(string_split(c_name, '#')) AS BIGINT)")
def _(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.substring_index("s_name", "#", -1).try_cast("long").alias("k"))
    c = table(spark, d, "customer").select("c_custkey", F.substring_index("c_name", "#", -1).try_cast("long").alias("k"))
    return s.join(c, "k").select("s_suppkey", "c_custkey")


@_add("semi_joined", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, d):
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(returned, "o_orderkey", "left_semi").select("o_orderkey", "o_totalprice")


@_add("anti_joined", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def _(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@_add("greatest_of_group_joined", "SELECT o_custkey, max(o_orderkey) AS last_order, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1")
def _(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_order"), F.max_by("o_totalprice", "o_orderkey").alias("price"))


@_add("first_image", "SELECT user_id, arg_min(props, (ts, event_id)) AS first_props FROM events GROUP BY 1")
def _(spark, d):
    return _events(spark, d).groupBy("user_id").agg(reports.first_text(["ts", "event_id"], "props").alias("first_props"))


@_add("joined_in_order", "SELECT user_id, string_agg(event_type, '||' ORDER BY ts, event_id) AS types FROM events WHERE event_type <> 'view' GROUP BY 1")
def _(spark, d):
    return _events(spark, d).where("event_type <> 'view'").groupBy("user_id").agg(reports.joined_text(["ts", "event_id"], "event_type").alias("types"))


@_add("roots_of_tree", """WITH RECURSIVE tree AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 0 WHEN c_custkey % 5 = 0 THEN c_custkey - 5 ELSE c_custkey - c_custkey % 5 END AS parent FROM customer),
    up AS (SELECT id, id AS root FROM tree UNION ALL SELECT up.id, tree.parent FROM up JOIN tree ON up.root = tree.id WHERE tree.parent IN (SELECT id FROM tree) AND tree.parent <> tree.id AND up.root % 10 <> 0)
    SELECT id, arg_min(root, CASE WHEN root % 10 = 0 THEN 0 WHEN root % 5 = 0 THEN 1 ELSE 2 END) AS root FROM up GROUP BY id""")  # fmt: skip
def _(spark, d):
    tree = table(spark, d, "customer").selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN c_custkey - 5 ELSE c_custkey - c_custkey % 5 END AS parent")
    return state.ancestors(tree, "id", "parent")


@_add("roots_of_deep_tree", """WITH RECURSIVE tree AS (SELECT o_orderkey AS id, o_orderkey // 2 AS parent FROM orders), ids AS (SELECT id FROM tree),
    up AS (SELECT id, id AS root FROM tree UNION ALL SELECT up.id, up.root // 2 FROM up WHERE up.root // 2 IN (SELECT id FROM ids) AND up.root // 2 <> up.root)
    SELECT id, min(root) AS root FROM up GROUP BY id""")  # fmt: skip
def _(spark, d):
    return state.ancestors(table(spark, d, "orders").selectExpr("o_orderkey AS id", "o_orderkey div 2 AS parent"), "id", "parent")


# Aggregations


@_add("counts_by_condition", "SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_quantity > 25) AS large, count(*) FILTER (l_discount = 0) AS full_price FROM lineitem GROUP BY 1")
def _(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 25).alias("large"), F.count_if(F.col("l_discount") == 0).alias("full_price"))


@_add("quality_profile", "SELECT count(*) AS rows, count(*) FILTER (c_acctbal < 0) AS negative, count(*) FILTER (c_name IS NULL) AS nameless, count(*) FILTER (c_mktsegment = 'BUILDING') AS building FROM customer")
def _(spark, d):
    return reports.profile(table(spark, d, "customer"), {"negative": F.col("c_acctbal") < 0, "nameless": F.col("c_name").isNull(), "building": F.col("c_mktsegment") == "BUILDING"})


@_add("distinct_counts", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1")
def _(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderdate").alias("days"))


@_add("many_keys", "SELECT l_returnflag, l_linestatus, l_linenumber, year(l_shipdate) AS y, month(l_shipdate) AS m, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber", F.year("l_shipdate").cast("long").alias("y"), F.month("l_shipdate").cast("long").alias("m")).agg(F.count("*").alias("n"))


@_add("by_day_and_band", "SELECT CAST(ts AS DATE) AS day, CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'middle' ELSE 'high' END AS band, count(*) AS n FROM events GROUP BY ALL")
def _(spark, d):
    band = F.when(F.col("value") < 10, "low").when(F.col("value") < 50, "middle").otherwise("high")
    return _events(spark, d).groupBy(F.to_date("ts").alias("day"), band.alias("band")).agg(F.count("*").alias("n"))


@_add("min_max_names", "SELECT n_regionkey, min(n_name) AS name, min(n_nationkey) AS low, max(n_nationkey) AS high FROM nation GROUP BY 1")
def _(spark, d):
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.min("n_name").alias("name"), F.min("n_nationkey").alias("low"), F.max("n_nationkey").alias("high"))


@_add("summed_sources", "SELECT k, CAST(sum(n) AS BIGINT) AS n FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, count(*) FROM supplier GROUP BY 1) GROUP BY 1")
def _(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n"))
    return reports.summed(c, s, keys=["k"], column="n")


@_add("top_groups", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 30")
def _(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_suppkey").limit(30)


@_add("distinct_choices", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@_add("rollup_of_periods", """SELECT coalesce(year(o_orderdate), 0) AS y, coalesce(o_orderstatus, '*') AS s, count(*) AS n FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus)""")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("y", F.year("o_orderdate").cast("long"))
    return o.rollup("y", "o_orderstatus").agg(F.count("*").alias("n")).select(F.coalesce("y", F.lit(0)).alias("y"), F.coalesce("o_orderstatus", F.lit("*")).alias("s"), "n")


# Windows and order


@_add("window_numbers", "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, row_number() OVER w AS place, count(*) OVER (PARTITION BY l_suppkey) AS size FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey)")
def _(spark, d):
    by = Window.partitionBy("l_suppkey")
    order = by.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.row_number().over(order).alias("place"), F.count("*").over(by).alias("size"))


@_add("pinned_order", "SELECT n_nationkey, n_name, row_number() OVER (ORDER BY CASE WHEN n_nationkey = 13 THEN 0 ELSE 1 END, n_regionkey DESC, n_nationkey) AS place FROM nation")
def _(spark, d):
    order = reports.pinned(F.col("n_nationkey") == 13, F.desc("n_regionkey"), F.asc("n_nationkey"))
    return table(spark, d, "nation").select("n_nationkey", "n_name", F.row_number().over(Window.orderBy(*order)).alias("place"))  # one row a nation


@_add("sampled_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('5:' || o_orderkey) LIMIT 20")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy(F.md5(F.concat(F.lit("5:"), F.col("o_orderkey")))).limit(20)


# Upserts, duplicates, queues


@_add("duplicates_removed", "SELECT * EXCLUDE (rn) FROM (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1")
def _(spark, d):
    return state.first_rows(_events(spark, d).select("event_id", "user_id", "event_type"), _EVENT_KEYS, [F.col("event_id")])


@_add("insert_ignored", f"WITH {_OLD_SQL} SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM new) WHERE rn = 1 AND user_id NOT IN (SELECT user_id FROM old WHERE event_type = 'purchase' AND value > 50)")
def _(spark, d):
    old, new = _halves(spark, d)
    return state.insert_ignore(old.where("event_type = 'purchase' AND value > 50"), new, ["user_id"], [F.col("event_id")]).select("event_id", "user_id")


@_add("upserted_last_wins", f"WITH {_OLD_SQL} SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def _(spark, d):
    old, new = _halves(spark, d)
    return state.upsert_last(old, new, _EVENT_KEYS, "ts").select("event_id", "user_id", "event_type", "value")


_ONE = "(SELECT user_id, CASE WHEN e % 3 = 0 THEN NULL ELSE e * 2 END AS value, CASE e % 4 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE CAST(e AS VARCHAR) END AS price FROM (SELECT user_id, min(event_id) AS e FROM {} GROUP BY 1))"


@_add("upserted_by_rules", f"""WITH {_OLD_SQL} SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.value, n.value) AS value,
    CASE WHEN (o.price IS NULL OR trim(o.price) IN ('', '0')) AND trim(n.price) <> '' THEN n.price ELSE o.price END AS price FROM {_ONE.format('old')} o FULL JOIN {_ONE.format('new')} n ON o.user_id = n.user_id""")  # fmt: skip
def _(spark, d):
    def one(half: DataFrame) -> DataFrame:
        e = half.groupBy("user_id").agg(F.min("event_id").alias("e"))
        return e.selectExpr("user_id", "CASE WHEN e % 3 = 0 THEN NULL ELSE e * 2 END AS value", "CASE e % 4 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE CAST(e AS STRING) END AS price")

    old, new = _halves(spark, d)
    return state.upsert_by(one(old), one(new), ["user_id"], {"value": state.keep_existing("value"), "price": state.improve_only("price")})


@_add("columns_filled", "SELECT c_custkey, CASE WHEN c_acctbal < 0 AND s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS c_acctbal FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def _(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return state.filled_where(table(spark, d, "customer").select("c_custkey", "c_acctbal"), s, ["c_custkey"], ["c_acctbal"], F.col("t.c_acctbal") < 0)


@_add("queue_claimed", "SELECT event_id AS id FROM events WHERE event_type = 'view' OR (event_type = 'click' AND ts < TIMESTAMP '2024-01-20' - INTERVAL 30 MINUTE) ORDER BY event_id DESC LIMIT 100")
def _(spark, d):
    status = F.when(F.col("event_type") == "view", "PENDING").when(F.col("event_type") == "click", "IN_PROGRESS").otherwise("done")
    queue = _events(spark, d).select(F.col("event_id").alias("id"), status.alias("status"), F.col("ts").alias("since"))
    return state.claimed(queue, 100, F.lit("2024-01-20").cast("timestamp")).select("id")


@_add("reposts_linked", """WITH k AS (SELECT event_id, ts, CASE WHEN user_id % 3 > 0 THEN user_id END AS k1, CASE WHEN event_id % 5 = 0 THEN props END AS k2 FROM events),
    f AS (SELECT *, first_value(struct_pack(ts := ts, id := event_id)) OVER (PARTITION BY k1 ORDER BY ts, event_id) AS a, first_value(struct_pack(ts := ts, id := event_id)) OVER (PARTITION BY k2 ORDER BY ts, event_id) AS b FROM k)
    SELECT event_id, CASE WHEN k1 IS NULL AND k2 IS NULL THEN event_id WHEN k1 IS NULL THEN b.id WHEN k2 IS NULL THEN a.id WHEN a <= b THEN a.id ELSE b.id END AS origin FROM f""")  # fmt: skip
def _(spark, d):
    k = _events(spark, d).selectExpr("event_id", "ts", "CASE WHEN user_id % 3 > 0 THEN user_id END AS k1", "CASE WHEN event_id % 5 = 0 THEN props END AS k2")
    return state.reposts(k, "k1", "k2", ["ts", "event_id"], "event_id").select("event_id", "origin")


@_add("parents_ready", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_linestatus <> 'F') = 0)")
def _(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    return state.ready_parents(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey", F.col("l_linestatus") == "F")


@_add("pairs_unique_on_both_sides", "SELECT p_partkey, s_suppkey FROM (SELECT p_partkey, p_partkey - p_partkey % 5 % 2 AS k, count(*) OVER (PARTITION BY p_partkey - p_partkey % 5 % 2) AS n FROM part) a JOIN (SELECT s_suppkey, s_suppkey - s_suppkey % 3 % 2 AS k, count(*) OVER (PARTITION BY s_suppkey - s_suppkey % 3 % 2) AS n FROM supplier) b USING (k) WHERE a.n = 1 AND b.n = 1")
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.expr("p_partkey - p_partkey % 5 % 2 AS k"))
    s = table(spark, d, "supplier").select("s_suppkey", F.expr("s_suppkey - s_suppkey % 3 % 2 AS k"))
    return state.unique_pairs(p, s, "k").select("p_partkey", "s_suppkey")


@_add("rows_moved", "SELECT 'kept' AS part, count(*) AS n FROM orders WHERE NOT coalesce(o_totalprice > 250000, FALSE) UNION ALL SELECT 'moved', count(*) FROM orders WHERE o_totalprice > 250000")
def _(spark, d):
    moved, kept = state.split_by(table(spark, d, "orders"), F.col("o_totalprice") > 250000)
    return kept.agg(F.lit("kept").alias("part"), F.count("*").alias("n")).unionByName(moved.agg(F.lit("moved").alias("part"), F.count("*").alias("n")))


@_add("uploaded_twice", "SELECT event_id FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id, props) AS n FROM events) WHERE n > 1")
def _(spark, d):
    return _events(spark, d).withColumn("n", F.count("*").over(Window.partitionBy("user_id", "props"))).where("n > 1").select("event_id")


# Reports


@_add("report_zero_filled", "SELECT n_nationkey, n_name, count(s_suppkey) AS suppliers FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 5000 GROUP BY ALL")
def _(spark, d):
    counts = table(spark, d, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    return reports.zero_filled(table(spark, d, "nation").select("n_nationkey", "n_name"), counts, "n_nationkey", ["suppliers"])


@_add("report_in_given_order", "SELECT place, id, coalesce(name, 'N/A') AS name, coalesce(n, 0) AS n FROM (SELECT CAST(s_suppkey AS INTEGER) AS place, (s_suppkey * 7) % 40 AS id FROM supplier) l LEFT JOIN (SELECT c_nationkey, min(n_name) AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) r ON l.id = r.c_nationkey")
def _(spark, d):
    listed = table(spark, d, "supplier").selectExpr("CAST(s_suppkey AS INT) AS place", "(s_suppkey * 7) % 40 AS id")
    counts = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    counts = counts.groupBy(F.col("c_nationkey").cast("long").alias("id")).agg(F.min("n_name").alias("name"), F.count("*").alias("n"))
    return reports.in_order(listed, counts, "id", "place", {"name": "N/A", "n": 0})


@_add("scarce_areas", f"WITH {FACTS_SQL} SELECT province, ward, count(*) AS n FROM facts WHERE grp = 3 GROUP BY ALL HAVING count(*) < 400")
def _(spark, d):
    return facts(spark, d).where("grp = 3").groupBy("province", "ward").agg(F.count("*").alias("n")).where("n < 400")


@_add("wards_by_region_pivot", "SELECT n_regionkey, count(*) FILTER (c_mktsegment = 'BUILDING') AS building, count(*) FILTER (c_mktsegment = 'MACHINERY') AS machinery FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    out = rows.groupBy("n_regionkey").pivot("c_mktsegment", ["BUILDING", "MACHINERY"]).count()
    return out.select("n_regionkey", *[F.coalesce(F.col(c), F.lit(0)).alias(c.lower()) for c in ("BUILDING", "MACHINERY")])


@_add("children_with_places", "SELECT event_id, CAST(i - 1 AS INTEGER) AS idx, w AS url FROM (SELECT event_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT event_id, list_filter(string_split(event_type || ',,' || props, ','), lambda x: trim(x) <> '') AS w FROM events))")
def _(spark, d):
    urls = F.filter(F.split(F.concat("event_type", F.lit(",,"), "props"), ","), lambda x: F.trim(x) != "")
    return _events(spark, d).select("event_id", F.posexplode(urls).alias("idx", "url"))
