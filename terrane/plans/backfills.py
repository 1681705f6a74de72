"""Queries of rows that are filled, merged or mapped from other tables, and of the small rules beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions import collated
from terrane.functions.rules import direction_code, listing_type
from terrane.functions.text import coordinates, one_line
from terrane.operators import backfill, extract, reports, state
from terrane.plans.registry_type import Query
from terrane.sources.listings import landed_by_alias, links_of_xml, table

#: Districts of another source: the same, cut short, a bare number, an old name, or unknown.
_DISTRICT = """CASE c_custkey % 5 WHEN 0 THEN 'nation_' || c_nationkey WHEN 1 THEN 'tion_' || c_nationkey WHEN 2 THEN CAST(c_nationkey AS {text})
  WHEN 3 THEN 'old town' ELSE 'town of nowhere' END"""
#: Own districts, some of which are numbers.
_OWN = "CASE WHEN n_nationkey % 4 = 0 THEN CAST(n_nationkey AS {text}) ELSE lower(n_name) END"


def _numeric_districts(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey % 5 AS parent", f"{_DISTRICT.format(text='STRING')} AS name")
    dim = table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_regionkey AS parent", f"{_OWN.format(text='STRING')} AS name")
    aliases = spark.createDataFrame([("old town", "nation_1")], "name string, alias string")
    return src.join(backfill.in_parent(src, dim, 4, aliases), ["parent", "name"]).select("id", "target", "stage")


def _wards(spark: SparkSession, d: str) -> DataFrame:
    nation, supplier = table(spark, d, "nation"), table(spark, d, "supplier")
    dim = table(spark, d, "region").selectExpr("CAST(1000 + r_regionkey AS BIGINT) AS id", "CAST(0 AS BIGINT) AS parent", "lower(r_name) AS name")
    dim = dim.union(nation.selectExpr("CAST(100 + n_nationkey AS BIGINT)", "CAST(1000 + n_regionkey AS BIGINT)", "lower(n_name)"))
    dim = dim.union(supplier.selectExpr("10000 + s_suppkey", "CAST(100 + s_nationkey AS BIGINT)", "'ward ' || s_suppkey % 20 || ' x'"))
    src = table(spark, d, "customer").selectExpr(
        "c_custkey AS id", "CAST(1000 + c_nationkey % 5 AS BIGINT) AS region", "CASE c_custkey % 3 WHEN 0 THEN 'nation_' || c_nationkey WHEN 1 THEN 'ward nation_' || c_nationkey ELSE 'old town' END AS district",
        "CASE WHEN c_custkey % 2 = 0 THEN 'ward ' || c_custkey % 25 || ' x' ELSE 'former ' || c_custkey % 25 END AS ward")
    split = nation.where("n_nationkey < 15").selectExpr("CAST(1000 + n_regionkey AS BIGINT) AS region", "'old town' AS district", "CAST(100 + n_nationkey AS BIGINT) AS target")
    merged = supplier.where("s_suppkey % 3 = 0").selectExpr("10000 + s_suppkey AS old", "'former ' || s_suppkey % 20 AS old_name", "10001 + s_suppkey AS new", "CAST(100 + s_nationkey AS BIGINT) AS new_parent")
    return backfill.wards_resolved(src, dim, split, merged)


_NEAR = "({a} = {b} OR length({b}) >= {n} AND (contains({a}, {b}) OR contains({b}, {a})))"
_WARDS_SQL = f"""WITH tree AS (SELECT CAST(1000 + r_regionkey AS BIGINT) AS id, CAST(0 AS BIGINT) AS parent, lower(r_name) AS name FROM region
    UNION ALL SELECT 100 + n_nationkey, 1000 + n_regionkey, lower(n_name) FROM nation UNION ALL SELECT 10000 + s_suppkey, 100 + s_nationkey, 'ward ' || s_suppkey % 20 || ' x' FROM supplier),
  s AS (SELECT c_custkey AS id, 1000 + c_nationkey % 5 AS region, CASE c_custkey % 3 WHEN 0 THEN 'nation_' || c_nationkey WHEN 1 THEN 'ward nation_' || c_nationkey ELSE 'old town' END AS district,
    CASE WHEN c_custkey % 2 = 0 THEN 'ward ' || c_custkey % 25 || ' x' ELSE 'former ' || c_custkey % 25 END AS ward FROM customer),
  merged AS (SELECT 10000 + s_suppkey AS old, 'former ' || s_suppkey % 20 AS old_name, 10001 + s_suppkey AS new, 100 + s_nationkey AS new_parent FROM supplier WHERE s_suppkey % 3 = 0),
  dt AS (SELECT region, district, target FROM (SELECT region, district, t.id AS target, row_number() OVER (PARTITION BY region, district ORDER BY t.name <> district, t.id) AS rn
      FROM (SELECT DISTINCT region, district FROM s) JOIN tree t ON t.parent = region AND {_NEAR.format(a='t.name', b='district', n=3)}) WHERE rn = 1
    UNION SELECT 1000 + n_regionkey, 'old town', 100 + n_nationkey FROM nation WHERE n_nationkey < 15),
  w AS (SELECT DISTINCT region, district, ward, target FROM s JOIN dt USING (region, district)),
  c AS (SELECT region, district, ward, 0 AS way, target, t.name <> ward AS other, t.id AS old FROM w JOIN tree t ON t.parent = target AND {_NEAR.format(a='t.name', b='ward', n=3)}
    UNION ALL SELECT region, district, ward, 1, target, false, new FROM w JOIN merged ON new_parent = target AND old_name = ward),
  o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region, district, ward ORDER BY way, target, other, old) AS rn FROM c) WHERE rn = 1)
  SELECT s.id, o.old, n.id AS new, n.name AS new_name, coalesce(p3.id, p2.id, p1.id) AS top FROM s JOIN o USING (region, district, ward)
    LEFT JOIN (SELECT * FROM merged WHERE new IN (SELECT id FROM tree)) m ON m.old = o.old JOIN tree n ON n.id = coalesce(m.new, o.old)
    LEFT JOIN tree p1 ON p1.id = coalesce(m.new_parent, n.parent) LEFT JOIN tree p2 ON p2.id = p1.parent LEFT JOIN tree p3 ON p3.id = p2.parent"""


def _times(spark: SparkSession, d: str) -> DataFrame:
    target = table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_orderstatus = 'F' AS own", "'ad_' || o_custkey AS ad", "'u/' || o_custkey AS url", "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS seen")
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    own = e.select(F.col("user_id").cast("string").alias("key"), F.col("ts").alias("value"))
    other = e.select(F.concat(F.lit("u/"), 2 * F.col("event_id")).alias("key"), F.col("ts").alias("value"))
    return backfill.looked_up(target, "seen", [(F.col("own"), F.replace("ad", F.lit("ad_"), F.lit("")), own), (~F.col("own"), F.col("url"), other)]).select("o_orderkey", "seen")


def _geography(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    df = table(spark, d, "customer").selectExpr(
        "c_custkey", "c_nationkey AS ward", "CASE WHEN c_custkey % 2 = 0 THEN 100 + c_nationkey END AS old_id", "CASE c_custkey % 3 WHEN 0 THEN 200 + c_nationkey WHEN 1 THEN 7 END AS new_id",
        "'as it was' AS new_name", "CAST(NULL AS INT) AS new_parent")
    wards = nation.where("n_nationkey % 4 > 0").selectExpr("n_nationkey AS ward", "100 + n_nationkey AS old_id")
    merged = nation.where("n_nationkey % 5 > 0").selectExpr("100 + n_nationkey AS old", "200 + n_nationkey AS new", "n_name AS name")
    return backfill.geography_filled(df, wards, merged, nation.where("n_nationkey % 6 > 0").selectExpr("200 + n_nationkey AS id", "n_regionkey AS parent"))


def _history(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "events").selectExpr(
        "event_id AS id", "event_id - event_id % 4 AS origin", "'DONE' AS status", "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ' 5, x,5,' || (event_id + 1) ELSE '' END AS history")
    return backfill.history_appended(links)


_ITEMS = "event_type || ', , ' || event_type || ',' || props"


def _children(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    known = e.where("event_id % 2 = 0").select("event_id", F.col("event_type").alias("text"))
    return backfill.children_absent(e, known, "event_id", F.split(F.expr(_ITEMS), ","))


def _staging(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    target = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance").where("id % 5 > 0")
    return target, table(spark, d, "supplier").selectExpr("CASE WHEN s_suppkey % 7 > 0 THEN s_suppkey - s_suppkey % 2 END AS id", "s_name AS name", "s_acctbal AS balance")


_STAGING_SQL = """t AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE c_custkey % 5 > 0),
  g AS (SELECT CASE WHEN s_suppkey % 7 > 0 THEN s_suppkey - s_suppkey % 2 END AS id, s_name AS name, s_acctbal AS balance FROM supplier)"""


def _collated(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").selectExpr("c_custkey", "CASE c_custkey % 3 WHEN 0 THEN 'Nátion_' WHEN 1 THEN 'naTIÒN_' ELSE 'nacion_' END || c_nationkey AS place")
    return reports.joined_collated(c, table(spark, d, "nation"), "place", "n_name").select("c_custkey", "n_nationkey")


_LANDED = T.StructType().add("event_id", "long").add("is_new", "integer").add("user_info", "string").add("created_at", "timestamp").add("k", "integer")


def _landed(spark: SparkSession, d: str) -> DataFrame:
    json = """'{"eventId":' || event_id || ',"isNew":' || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END || ',"userInfo":' || props
      || CASE WHEN event_id % 3 = 0 THEN ',"k":null,"K":1' ELSE ',"k":"' || user_id || '"' END || ',"created_at":"' || CASE WHEN event_id % 5 = 0 THEN 'soon' ELSE 'Mon, 0' || (1 + event_id % 9) || ' Jan 2024 10:20:30 GMT' END || '"}'"""
    return landed_by_alias(table(spark, d, "events").selectExpr(f"{json} AS j"), "j", _LANDED)


_CELLS = [
    extract.Cell("city", 0, "div", 0, "a"), extract.Cell("ward", 0, "div", 1, "a"), extract.Cell("street", 1, selector=".area-detail a b"), extract.Cell("segment", 1, selector=".area-detail .sub-text"),
    extract.Cell("land_type", 2, selector=".area-type .main-text"), extract.Cell("price_1", 3), extract.Cell("price_2", 4), extract.Cell("price_4", 6),
]
_HTML = """'<table class="table table-bordered table-striped"><thead><tr><td>h</td></tr></thead><tbody><tr><td><div><a>City ' || s_nationkey || '</a></div><div>' || CASE WHEN s_suppkey % 3 = 0 THEN 'none' ELSE '<a>Ward <i>' || s_suppkey || '</i></a>' END
  || '</div></td><td><div class="area-detail"><a><b>' || s_name || '</b></a><p class="sub-text"> from A\n to B </p></div></td><td><div class="area-type"><span class="main-text">Land</span></div></td><td> ' || s_acctbal || ' <td></td><td>3</td><td>4 &amp; up</td></tr>'
  || CASE WHEN s_suppkey % 2 = 0 THEN '<tr><td>a</td><td>b</td><td>c</td><td>d</td><td>e</td><td>f</td><td>g</td><td>h</td></tr>' ELSE '' END || '<tr><td>short</td></tr></tbody></table><table><tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td><td>6</td><td>7</td></tr></table>'"""


def _price_table(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "supplier").selectExpr("s_suppkey", f"{_HTML} AS html")
    return extract.table_rows(pages, "table.table.table-bordered.table-striped tbody tr", _CELLS, 7)


_LINK = "CASE p_partkey % 4 WHEN 0 THEN 'https://maps.example/?Q=' || p_size || '.' || p_partkey % 100 || ', -1' || p_size WHEN 1 THEN 'https://m.example/s?center=10.50,106&z=' || p_size WHEN 2 THEN 'https://m.example/?q=here' END"

QUERIES: list[Query] = [
    Query("districts_in_parent", _numeric_districts, f"""WITH s AS (SELECT DISTINCT c_nationkey % 5 AS parent, {_DISTRICT.format(text='VARCHAR')} AS name FROM customer),
      t AS (SELECT n_nationkey AS id, n_regionkey AS parent, {_OWN.format(text='VARCHAR')} AS name FROM nation),
      p AS (SELECT s.parent, s.name, t.id AS target, CASE WHEN s.name = t.name THEN 1 WHEN length(s.name) >= 4 AND (contains(t.name, s.name) OR contains(s.name, t.name)) THEN 2 WHEN s.name = 'old town' AND contains(t.name, 'nation_1') THEN 3 END AS stage FROM s JOIN t USING (parent)),
      b AS (SELECT parent, name, arg_min(target, (stage, target)) AS target, min(stage) AS stage FROM p WHERE stage IS NOT NULL GROUP BY ALL)
      SELECT c_custkey AS id, target, stage FROM customer JOIN b ON b.parent = c_nationkey % 5 AND b.name = {_DISTRICT.format(text='VARCHAR')}"""),
    Query("wards_resolved", _wards, _WARDS_SQL),
    Query("times_looked_up", _times, """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END, CASE WHEN o_orderstatus = 'F' THEN a.ts ELSE b.ts END) AS seen FROM orders
      LEFT JOIN (SELECT user_id, max(ts) AS ts FROM events GROUP BY 1) a ON a.user_id = o_custkey LEFT JOIN events b ON 2 * b.event_id = o_custkey"""),
    Query("geography_filled", _geography, """WITH f AS (SELECT c_custkey, c_nationkey AS ward, CASE WHEN c_custkey % 2 = 0 OR c_nationkey % 4 > 0 THEN 100 + c_nationkey END AS old_id, CASE c_custkey % 3 WHEN 0 THEN 200 + c_nationkey WHEN 1 THEN 7 END AS new_id FROM customer),
      m AS (SELECT 100 + n_nationkey AS old, 200 + n_nationkey AS new, n_name, n_regionkey FROM nation WHERE n_nationkey % 5 > 0 AND n_nationkey % 6 > 0)
      SELECT c_custkey, ward, old_id, CASE WHEN new IS NOT NULL THEN new ELSE new_id END AS new_id, CASE WHEN new IS NOT NULL AND new_id IS DISTINCT FROM new THEN n_name ELSE 'as it was' END AS new_name,
        CASE WHEN new IS NOT NULL AND new_id IS DISTINCT FROM new THEN n_regionkey END AS new_parent FROM f LEFT JOIN m ON old = old_id"""),
    Query("history_appended", _history, """WITH e AS (SELECT event_id AS id, event_id - event_id % 4 AS origin FROM events),
      h AS (SELECT id, CASE WHEN id % 3 = 1 THEN ' 5, x,5,' || (id + 1) WHEN id % 3 = 2 THEN '' END AS history FROM e),
      a AS (SELECT origin, string_agg(id, ',' ORDER BY id) AS ids, string_agg(id, ',' ORDER BY id) FILTER (id > origin + 1) AS later FROM e WHERE id <> origin GROUP BY 1)
      SELECT e.id, e.origin, CASE WHEN e.id = e.origin THEN 'DONE' ELSE 'POSTAGAIN' END AS status,
        CASE WHEN e.id <> e.origin OR ids IS NULL THEN history WHEN e.id % 3 <> 1 THEN ids WHEN later IS NULL THEN history ELSE '5,' || CASE WHEN e.id = 4 THEN '' ELSE (e.id + 1) || ',' END || later END AS history
      FROM e JOIN h USING (id) LEFT JOIN a ON a.origin = e.id"""),
    Query("children_absent", _children, f"""WITH l AS (SELECT event_id, event_type, list_filter(list_transform(string_split({_ITEMS}, ','), lambda x: trim(x)), lambda x: x <> '') AS w FROM events),
      u AS (SELECT event_id, event_type, unnest(w) AS text, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS idx FROM l)
      SELECT event_id, text, min(idx) AS idx FROM u WHERE event_id % 2 = 1 OR text <> event_type GROUP BY event_id, text"""),
    Query("staged_merged", lambda spark, d: backfill.staged(*_staging(spark, d), ["id"], [F.desc("name")]), f"""WITH {_STAGING_SQL} SELECT * FROM t WHERE id NOT IN (SELECT id FROM g WHERE id IS NOT NULL)
      UNION ALL SELECT id, max(name), arg_max(balance, name) FROM g WHERE id IS NOT NULL GROUP BY id UNION ALL SELECT * FROM g WHERE id IS NULL"""),
    Query("staged_counted", lambda spark, d: backfill.staged_counts(*_staging(spark, d), ["id"]), f"""WITH {_STAGING_SQL} SELECT count(DISTINCT id) FILTER (id NOT IN (SELECT id FROM t)) + count(*) FILTER (id IS NULL) AS inserted,
      count(DISTINCT id) FILTER (id IN (SELECT id FROM t)) AS updated, count(id) - count(DISTINCT id) AS repeated FROM g"""),
    Query("counts_on_duplicates", lambda spark, d: reports.matched_counts(
        table(spark, d, "customer").select("c_mktsegment", F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).where("k % 4 > 0"), "k", ["c_mktsegment"]),
      """WITH p AS (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer JOIN supplier ON c_nationkey = s_nationkey WHERE s_nationkey % 4 > 0)
      SELECT c_mktsegment, count(DISTINCT c_custkey) AS rows, count(DISTINCT c_nationkey) AS ids, count(*) AS pairs FROM p GROUP BY 1"""),
    Query("joined_by_collation", _collated, "SELECT c_custkey, n_nationkey FROM customer JOIN nation ON strip_accents(lower(CASE c_custkey % 3 WHEN 0 THEN 'Nátion_' WHEN 1 THEN 'naTIÒN_' ELSE 'nacion_' END || c_nationkey)) = lower(n_name)"),
    Query("signed_steps", lambda spark, d: table(spark, d, "customer").select("c_custkey", state.signed_gate([F.col("c_acctbal") > 0, F.expr("CASE WHEN c_nationkey % 5 > 0 THEN c_nationkey % 3 > 0 END"), F.col("c_mktsegment") != "BUILDING"]).alias("process_status")),
      "SELECT c_custkey, CASE WHEN NOT c_acctbal > 0 THEN -1 WHEN c_nationkey % 5 = 0 OR c_nationkey % 3 = 0 THEN -2 WHEN c_mktsegment = 'BUILDING' THEN -3 ELSE 3 END AS process_status FROM customer"),
    Query("texts_on_one_line", lambda spark, d: table(spark, d, "documents").select("doc_id", one_line(F.col("text")).alias("line")),
      "SELECT doc_id, left(replace(replace(text, chr(10), ''), chr(13), ''), 50) AS line FROM documents"),
    Query("directions", lambda spark, d: table(spark, d, "events").select("event_id", direction_code(F.expr("CASE WHEN event_id % 7 = 0 THEN event_type ELSE ' ' || value END")).alias("direction")),
      "SELECT event_id, CASE WHEN event_id % 7 > 0 AND trunc(value) BETWEEN 1 AND 8 THEN CAST(trunc(value) AS INTEGER) END AS direction FROM events"),
    Query("coordinates_of_urls", lambda spark, d: table(spark, d, "part").select("p_partkey", coordinates(F.expr(_LINK)).alias("at")),
      "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(CAST(p_size || '.' || p_partkey % 100 AS DOUBLE) AS VARCHAR) || ',-1' || p_size || '.0' WHEN 1 THEN '10.5,106.0' END AS at FROM part"),
    Query("json_landed_by_alias", _landed, """SELECT event_id, CAST(user_id % 2 = 0 AS INTEGER) AS is_new, replace(props, ' ', '') AS user_info,
      CASE WHEN event_id % 5 > 0 THEN TIMESTAMP '2024-01-01 10:20:30' + to_days(CAST(event_id % 9 AS INTEGER)) END AS created_at, CASE WHEN event_id % 3 > 0 THEN CAST(user_id AS INTEGER) END AS k FROM events"""),
    Query("price_table_rows", _price_table, """SELECT s_suppkey, 0 AS place, 'City ' || s_nationkey AS city, CASE WHEN s_suppkey % 3 > 0 THEN 'Ward ' || s_suppkey END AS ward, s_name AS street, 'from A to B' AS segment, 'Land' AS land_type,
      CAST(s_acctbal AS VARCHAR) AS price_1, NULL AS price_2, '4 & up' AS price_4 FROM supplier UNION ALL SELECT s_suppkey, 1, NULL, NULL, NULL, NULL, NULL, 'd', 'e', 'g' FROM supplier WHERE s_suppkey % 2 = 0"""),
]


def _sitemaps(spark: SparkSession, d: str) -> DataFrame:
    """The addresses of the pages as sitemaps of fifty links each, then read back from these."""
    pages = table(spark, d, "pages").select("page_id", F.replace("url", F.lit("&"), F.lit("&amp;")).alias("url"))
    link = F.format_string("<url><loc> %s </loc><lastmod>2024-01-%02dT08:00:00+07:00</lastmod></url>", "url", F.col("page_id") % 28 + 1)
    texts = pages.groupBy(F.expr("page_id div 50").alias("sitemap")).agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("links"))
    head = F.lit('<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">')
    xml = texts.select("sitemap", F.concat(head, "links", F.lit("</urlset>")).alias("xml"))
    return links_of_xml(xml, "xml", since="2024-01-15")


#: Spellings of four kinds of listings, with and without case and accents, and one that is none of them.
_SPELT = """CASE {key} % 7 WHEN 0 THEN 'Bán Nhà Phố' WHEN 1 THEN 'BAN NHA PHO' WHEN 2 THEN 'bán nhà phố' WHEN 3 THEN 'Đất nền' WHEN 4 THEN 'DAT NEN' WHEN 5 THEN 'Nhà Đẹp' ELSE 'ban nha pho 2' END"""
_PLAIN = "replace(lower(strip_accents(x)), 'đ', 'd')"


def _collated(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").selectExpr("c_custkey AS id", f"{_SPELT.format(key='c_custkey')} AS x")
    return rows.select(
        "id", collated.equals("x", "dat nen").alias("land"), collated.among("x", ["ban nha pho", "nha dep"]).alias("house"),
        collated.like("x", "%NHÀ_P%").alias("like_house"), collated.like("x", "đ%").alias("like_d"),
        collated.case_of("x", {"bán nhà phố": 1, "dat nen": 2}, 0).alias("kind"))


def _collated_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").selectExpr("o_orderkey AS id", f"{_SPELT.format(key='o_orderkey')} AS x")
    return collated.counted_by(rows, "x")


QUERIES += [
    Query(
        "links_of_sitemaps",
        _sitemaps,
        """SELECT page_id // 50 AS sitemap, url AS loc, '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || 'T08:00:00+07:00' AS lastmod FROM pages WHERE page_id % 28 + 1 >= 15""",
    ),
    Query(
        "collated_predicates",
        _collated,
        f"""WITH r AS (SELECT c_custkey AS id, {_SPELT.format(key="c_custkey")} AS x FROM customer), p AS (SELECT id, {_PLAIN} AS y FROM r)
        SELECT id, y = 'dat nen' AS land, y IN ('ban nha pho', 'nha dep') AS house, y LIKE '%nha_p%' AS like_house, y LIKE 'd%' AS like_d, CASE y WHEN 'ban nha pho' THEN 1 WHEN 'dat nen' THEN 2 ELSE 0 END AS kind FROM p""",
    ),
    Query(
        "collated_groups",
        _collated_groups,
        f"""WITH r AS (SELECT {_SPELT.format(key="o_orderkey")} AS x FROM orders) SELECT min(x) AS x, count(*) AS n FROM r GROUP BY {_PLAIN}""",
    ),
    Query(
        "listing_types",
        lambda spark, d: table(spark, d, "customer").selectExpr(
            "c_custkey AS id", "CASE c_custkey % 6 WHEN 0 THEN ' Bán ' WHEN 1 THEN 'cần bán' WHEN 2 THEN 'Cho Thuê' WHEN 3 THEN 'u' ELSE NULL END AS raw",
            "CASE WHEN c_custkey % 4 = 0 THEN 'Tháng ' WHEN c_custkey % 4 = 1 THEN 'm2' END AS unit", "c_nationkey % 5 AS cat",
        ).select("id", listing_type(F.col("raw"), F.col("unit"), F.col("cat")).alias("type")),
        # "bán" with an accent is none of the words, as in the fixed list.
        """SELECT c_custkey AS id, CASE WHEN c_custkey % 6 = 1 THEN 's' WHEN c_custkey % 6 IN (2, 3) THEN 'u' WHEN c_custkey % 4 = 0 THEN 'u' WHEN c_nationkey % 5 = 3 THEN 'u' ELSE 's' END AS type FROM customer""",
    ),
]
