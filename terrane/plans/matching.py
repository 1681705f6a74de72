"""Queries of entity resolution and incremental statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.text import slug
from terrane.operators import grams, resolve, stats
from terrane.plans.facts import FACTS_SQL, facts
from terrane.plans.registry_type import Query
from terrane.plans.statistics import _scope_sql
from terrane.sources.listings import table
from terrane.streaming.incremental import affected

QUERIES: list[Query] = []


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Project names as two sources would write them, from the parts."""
    part = table(spark, d, "part")
    a = part.selectExpr("p_partkey AS id", "initcap(p_name) || ' ' || p_size || CASE WHEN p_partkey % 3 = 0 THEN ' Tower' ELSE '' END AS name", "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS region")
    b = part.selectExpr("p_partkey AS id", "CASE WHEN p_partkey % 4 = 0 THEN 'Khu đô thị ' ELSE '' END || p_name || ' ' || p_size || CASE WHEN p_partkey % 7 = 0 THEN ' towers' ELSE '' END AS name", "p_brand AS region")
    return a, b


_SIDES_SQL = """a AS (SELECT p_partkey AS id, p_name || ' ' || p_size || CASE WHEN p_partkey % 3 = 0 THEN ' tower' ELSE '' END AS norm, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS region FROM part),
b AS (SELECT p_partkey AS id, p_name || ' ' || p_size || CASE WHEN p_partkey % 7 = 0 THEN ' towers' ELSE '' END AS norm, p_brand AS region FROM part)"""

#: Names of places as another source writes them: right, with a kind before it, misspelt, cut short, or unknown.
_PLACE = """CASE c_custkey % 5 WHEN 0 THEN 'ward nation_' || c_nationkey WHEN 1 THEN 'natiom_' || c_nationkey WHEN 2 THEN 'nation_' || (c_nationkey % 7)
  WHEN 3 THEN 'nation_' || c_nationkey ELSE 'town_' || c_nationkey END"""

#: An alias of nine words, and addresses that have it, or a short one inside a word, or several.
_LONG = "rat lau va dai trong khu cho nation "
_INSIDE = f"""CASE c_custkey % 4 WHEN 0 THEN 'o {_LONG}' || CAST(c_nationkey AS {{text}}) || ' cu' WHEN 1 THEN 'xomnation ' || CAST(c_nationkey AS {{text}})
  WHEN 2 THEN 'tu nation ' || CAST(c_nationkey % 5 AS {{text}}) || ' den nation ' || CAST(c_nationkey AS {{text}}) ELSE 'khong dau' END"""


def _categories(spark: SparkSession, d: str) -> DataFrame:
    """Pages by the longest rule that their address begins with; some rules are made of addresses, so they grow with these."""
    pages = table(spark, d, "pages").select("page_id", slug(F.col("url")).alias("path"))
    fixed = spark.createDataFrame([("http", "plain"), ("https", "secure"), ("http-m", "mobile"), ("https-blog", "blog")], "prefix string, label string")
    sites = pages.where("page_id % 3 = 0").select(F.substring_index("path", "-", 4).alias("prefix"), F.concat(F.lit("site "), "page_id").alias("label"))
    return grams.by_longest_prefix(pages, "path", fixed.unionByName(sites)).select("page_id", "label")


QUERIES += [
    Query(
        "names_blocked",
        lambda spark, d: resolve.candidates(*[resolve.named(x) for x in _sides(spark, d)]).groupBy("s_norm").agg(F.count("*").alias("n")),
        f"""WITH {_SIDES_SQL}, s AS (SELECT DISTINCT norm, region FROM a), t AS (SELECT DISTINCT norm, region FROM b)
        SELECT s.norm AS s_norm, count(*) AS n FROM s JOIN t ON (s.region IS NULL OR t.region IS NULL OR s.region = t.region)
          AND len(list_intersect(list_distinct(string_split(s.norm, ' ')), list_distinct(string_split(t.norm, ' ')))) >= CASE WHEN len(list_distinct(string_split(s.norm, ' '))) <= 2 THEN 1 ELSE 2 END GROUP BY 1""",
    ),
    Query("names_matched", lambda spark, d: resolve.matched(*_sides(spark, d)).select("id", "target", "kind", stats.round2(F.col("score"), 4).alias("score"))),
    Query(
        "names_matched_exactly",
        lambda spark, d: resolve.matched(*_sides(spark, d)).where("kind <> 'fuzzy'").select("id", "target", "kind"),
        f"""WITH {_SIDES_SQL}, r AS (SELECT norm, region, max(id) AS id FROM b GROUP BY ALL), g AS (SELECT norm, max(id) AS id FROM b GROUP BY ALL)
        SELECT a.id, coalesce(r.id, g.id) AS target, CASE WHEN r.id IS NOT NULL THEN 'norm_region' ELSE 'norm' END AS kind FROM a LEFT JOIN r ON a.norm = r.norm AND a.region = r.region JOIN g ON a.norm = g.norm""",
    ),
    Query("names_for_review", lambda spark, d: resolve.review(*[resolve.named(x) for x in _sides(spark, d)]).select("s_norm", "s_region", "d_norm", "d_region", "place", stats.round2(F.col("score"), 4).alias("score"))),
    Query(
        "word_set_ratios",
        lambda spark, d: table(spark, d, "part").select("p_partkey", F.col("p_name").alias("x"), F.concat(F.substring_index("p_name", " ", 1), F.lit(" "), F.col("p_partkey")).alias("y")).select("p_partkey", resolve.token_set_ratio("x", "y").alias("r")),
        # The first word is shared, and the number has no letter of the second one.
        """WITH n AS (SELECT p_partkey, length(split_part(p_name, ' ', 1)) AS a, length(p_name) AS x, length(split_part(p_name, ' ', 1) || ' ' || p_partkey) AS y FROM part)
        SELECT p_partkey, CAST(round_even(100 * greatest(2.0 * a / (a + x), 2.0 * a / (a + y), 2.0 * (a + 1) / (x + y)), 0) AS DOUBLE) AS r FROM n""",
    ),
    Query(
        "places_matched",
        lambda spark, d: resolve.places(
            table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey % 5 AS parent", f"{_PLACE} AS name"),
            table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_regionkey AS parent", "lower(n_name) AS name"), 0.8, 8, {"natiom": "nation"}),
        f"""WITH s AS (SELECT c_custkey AS id, c_nationkey % 5 AS parent, {_PLACE} AS name FROM customer),
        t AS (SELECT n_nationkey AS id, n_regionkey AS parent, lower(n_name) AS name FROM nation),
        p AS (SELECT s.id, t.id AS target, greatest(CASE WHEN s.name = t.name THEN CASE WHEN s.parent = t.parent THEN 1.0 ELSE 0.95 END
            WHEN s.parent = t.parent AND (contains(t.name, s.name) OR contains(s.name, t.name)) AND length(s.name) > 8 THEN 0.9 ELSE 0 END,
            CASE WHEN contains(s.name, 'natiom') AND replace(s.name, 'natiom', 'nation') = t.name THEN CASE WHEN s.parent = t.parent THEN 0.95 ELSE 0.9 END ELSE 0 END) AS score FROM s, t)
        SELECT id, target, CAST(score AS DOUBLE) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, target) AS rn FROM p WHERE score >= 0.8) WHERE rn = 1""",
    ),
    Query(
        "regions_of_addresses",
        lambda spark, d: resolve.region_of_address(
            table(spark, d, "supplier").selectExpr("s_suppkey AS id", "CASE s_suppkey % 3 WHEN 0 THEN 'gần Nation ' || s_nationkey || ' và xa, xx' WHEN 1 THEN 'nowhere' ELSE '12 Main, Tỉnh Nation ' || s_nationkey || ', TP Nation ' || (s_nationkey + 1) || ', Việt Nam' END AS address"),
            table(spark, d, "nation").selectExpr("'nation ' || n_nationkey AS alias", "n_regionkey AS region")),
        """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN a.n_regionkey ELSE coalesce(b.n_regionkey, a.n_regionkey) END AS region FROM supplier JOIN nation a ON s_nationkey = a.n_nationkey LEFT JOIN nation b ON s_nationkey + 1 = b.n_nationkey WHERE s_suppkey % 3 <> 1""",
    ),
    Query(
        "regions_by_contained_alias",
        lambda spark, d: resolve.region_of_address(
            table(spark, d, "customer").selectExpr("c_custkey AS id", f"{_INSIDE.format(text='STRING')} AS address"),
            table(spark, d, "nation").selectExpr("n_regionkey AS region", f"explode(array('nation ' || n_nationkey, '{_LONG}' || n_nationkey)) AS alias")),
        f"""WITH a AS (SELECT c_custkey AS id, {_INSIDE.format(text='VARCHAR')} AS address FROM customer),
        n AS (SELECT n_regionkey AS region, unnest(['nation ' || n_nationkey, '{_LONG}' || n_nationkey]) AS alias FROM nation)
        SELECT id, region FROM (SELECT id, region, row_number() OVER (PARTITION BY id ORDER BY length(alias) DESC, alias DESC) AS rn FROM a JOIN n ON contains(address, alias)) WHERE rn = 1""",
    ),
    Query(
        "wards_proposed",
        lambda spark, d: resolve.proposals_of_wards(
            table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
                "c_custkey AS id", "n_regionkey AS parent",
                "CASE c_custkey % 3 WHEN 0 THEN 'districtofnation_' || c_nationkey WHEN 1 THEN '#istrict of nation_' || c_nationkey ELSE 'zzz' END AS district", "'#ard number ' || (c_custkey % 10) AS name"),
            table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
                "s_suppkey AS id", "n_regionkey AS parent", "s_nationkey AS district_id", "'district of nation_' || s_nationkey AS district", "'ward number ' || (s_suppkey % 10) AS name").union(
                table(spark, d, "nation").selectExpr("-1 - n_nationkey", "n_regionkey", "n_nationkey", "'district of nation_' || n_nationkey", "'town hall'")),
        ).select("id", "target", stats.round2(F.col("score"), 4).alias("score")),
        # Of 13 characters 12 match; any other ward of the district matches in 11, which is too few.
        """SELECT c_custkey AS id, min(s_suppkey) AS target, floor(24.0 / 26 * 10000 + 0.5) / 10000.0 AS score FROM customer JOIN supplier ON s_nationkey = c_nationkey AND s_suppkey % 10 = c_custkey % 10
        WHERE c_custkey % 3 <> 2 GROUP BY 1""",
    ),
    Query(
        "categories_of_urls",
        _categories,
        """WITH p AS (SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS path FROM pages),
        r AS (SELECT prefix, min(label) AS label FROM (SELECT unnest(['http', 'https', 'http-m', 'https-blog']) AS prefix, unnest(['plain', 'secure', 'mobile', 'blog']) AS label
          UNION ALL SELECT array_to_string(string_split(path, '-')[1:4], '-'), 'site ' || page_id FROM p WHERE page_id % 3 = 0) GROUP BY 1)
        SELECT page_id, label FROM (SELECT page_id, label, row_number() OVER (PARTITION BY page_id ORDER BY length(prefix) DESC) AS rn FROM p LEFT JOIN r ON path = prefix OR starts_with(path, prefix || '-')) WHERE rn = 1""",
    ),
    Query(
        "places_proposed",
        lambda spark, d: resolve.proposals(
            table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey % 5 AS parent", "'natiom_' || c_nationkey AS name"),
            table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_regionkey AS parent", "lower(n_name) AS name"), 0.8).select("id", "target", stats.round2(F.col("score"), 4).alias("score")),
        """WITH p AS (SELECT c_custkey AS id, n_nationkey AS target, CASE WHEN c_nationkey = n_nationkey THEN 2.0 ELSE 0 END AS same, c_nationkey, n_nationkey FROM customer JOIN nation ON c_nationkey % 5 = n_regionkey)
        SELECT id, target, floor(2.0 * (length('nation_' || n_nationkey) - 1) / (2 * length('nation_' || n_nationkey)) * 10000 + 0.5) / 10000.0 AS score FROM p WHERE same = 2.0""",
    ),
    Query(
        "places_contained",
        lambda spark, d: resolve.contained(
            table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey % 5 AS parent", "'ward nation_' || c_nationkey AS name"),
            table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_regionkey AS parent", "lower(n_name) AS name")),
        "SELECT c_custkey AS id, n_nationkey AS target FROM customer JOIN nation ON c_nationkey % 5 = n_regionkey WHERE contains('ward nation_' || c_nationkey, lower(n_name))",
    ),
    Query(
        "places_by_alias",
        lambda spark, d: resolve.with_aliases(
            table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey % 5 AS parent", "CASE c_custkey % 3 WHEN 0 THEN 'n' || c_nationkey ELSE 'NATION_' || c_nationkey END AS name"),
            table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_regionkey AS parent", "n_name AS name"),
            table(spark, d, "nation").selectExpr("'n' || n_nationkey AS name", "n_name AS alias"),
            table(spark, d, "nation").where("n_nationkey % 4 = 0").selectExpr("n_nationkey AS old", "n_nationkey + 100 AS new")),
        """SELECT c_custkey AS id, t + CASE WHEN t % 4 = 0 THEN 100 ELSE 0 END AS target FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND n_regionkey <> c_nationkey % 5 THEN NULL ELSE c_nationkey END AS t FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    ),
    Query(
        "neighbours_mapped",
        lambda spark, d: resolve.neighbours_mapped(
            table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).selectExpr("c_nationkey AS a", "(c_nationkey + o_orderkey % 3 + 1) % 30 AS b"),
            table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_nationkey div 2 AS target"))[0].select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")),
        """SELECT DISTINCT CAST(c_nationkey // 2 AS BIGINT) AS a, CAST(((c_nationkey + o_orderkey % 3 + 1) % 30) // 2 AS BIGINT) AS b FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE (c_nationkey + o_orderkey % 3 + 1) % 30 < 25 AND c_nationkey // 2 <> ((c_nationkey + o_orderkey % 3 + 1) % 30) // 2""",
    ),
    Query(
        "neighbours_unmapped",
        lambda spark, d: resolve.neighbours_mapped(
            table(spark, d, "customer").selectExpr("c_nationkey AS a", "(c_nationkey + c_custkey % 9) AS b"), table(spark, d, "nation").selectExpr("n_nationkey AS id", "n_regionkey AS target"))[1].select(F.col("id").cast("long").alias("id")),
        "SELECT DISTINCT CAST(c_nationkey + c_custkey % 9 AS BIGINT) AS id FROM customer WHERE c_nationkey + c_custkey % 9 >= 25",
    ),
    Query(
        "stats_of_touched_groups",
        lambda spark, d: affected(facts(spark, d).where("month <> '1997-05'"), facts(spark, d).where("month = '1997-05'"), ["province", "grp", "month"], lambda f: stats.scope_stats(f, stats.SCOPES[1])),
        f"WITH {FACTS_SQL}, s AS ({_scope_sql(stats.SCOPES[1], False)}) SELECT * FROM s WHERE month = '1997-05'",
    ),
]
