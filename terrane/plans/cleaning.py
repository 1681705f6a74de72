"""Queries of the clean-up, over listings derived from the sale lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions import parse, rules
from terrane.plans import clean
from terrane.plans.facts import round_sql
from terrane.plans.registry_type import Query
from terrane.plans.texts import _AREA_FORMS, _AREA_SQL, _PRICE_FORMS, _PRICE_SQL, _categories, _formed, _in, _pick
from terrane.sources.listings import table

QUERIES: list[Query] = []

_STYLE = "CASE l_orderkey % 4 WHEN 0 THEN 'names' WHEN 1 THEN 'ids' WHEN 2 THEN 'folded' ELSE 'other' END"
_CATEGORY = f"CASE l_orderkey % 4 WHEN 0 THEN {_pick(_categories(rules.GROUPS['names']), 'l_partkey')} WHEN 1 THEN {_pick(_categories(rules.GROUPS['ids']), 'l_partkey')} ELSE {_pick(['Nhà riêng', 'Đất', 'Căn hộ chung cư', 'Shophouse', 'khác'], 'l_partkey')} END"
#: In both engines' SQL; STRING is VARCHAR there. Dates are thirty years on, as numbers of milliseconds or texts.
_RAW = {
    "id": "l_orderkey * 1000000 + l_partkey * 10 + l_linenumber",
    "style": _STYLE,
    "src_place": "CAST(l_suppkey % 30 AS STRING)",
    "src_price": _formed(_PRICE_FORMS),
    "src_size": _formed(_AREA_FORMS).replace("k % ", "l_partkey % "),
    "unit": "'m2'",
    "src_category": _CATEGORY,
    "src_type": "CASE l_returnflag WHEN 'A' THEN 's' WHEN 'R' THEN 'Cho thuê' ELSE 'bán' END",
    "url": "CASE l_returnflag WHEN 'A' THEN '/ban-nha' WHEN 'R' THEN '/cho-thue-nha' ELSE '/x' END",
}


def _line(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").selectExpr("*", "CAST(l_quantity AS INT) AS q", "CAST(l_partkey % 1000 AS INT) AS m", "l_orderkey + l_linenumber AS k")
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + 946080000
    date = F.when(F.expr(_STYLE) == "ids", F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise((seconds * 1000).cast("string"))
    return line.select(*[F.expr(sql).alias(n) for n, sql in _RAW.items()], parse.bound(F.when(F.col("l_tax") > 0.01, date), lambda x: x).alias("src_date"))


def _places(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").selectExpr("CAST(n_nationkey AS STRING) AS place", "n_nationkey AS ward", "n_regionkey AS province")


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean.standardised(_line(spark, d), _places(spark, d))


def _group(name: str) -> str:
    g = rules.GROUPS[name]
    c = "trim(regexp_replace(lower(replace(replace(strip_accents(src_category), 'đ', 'd'), 'Đ', 'D')), '[^a-z0-9]+', ' ', 'g'))" if g.fold else "src_category"
    inner = f"CASE WHEN {c} IN {_in(g.houses)} THEN 1 WHEN {c} IN {_in(g.flats)} THEN 2 WHEN {c} IN {_in(g.land)} THEN 3 END"
    return f"CASE WHEN trade IN {_in(g.rent)} THEN 4 ELSE {inner if g.any_trade else f'''CASE WHEN trade = 's' THEN {inner} END'''} END"


def _land(name: str) -> str:
    shares = rules.LAND_PRICES[name].shares
    cases = " ".join(f"WHEN src_category = '{c}' THEN {'price_vnd' if s == 1 else f'CAST(round_even(CAST(price_vnd AS DOUBLE) * CAST({s} AS DOUBLE), 0) AS BIGINT)'}" for c, s in shares.items())
    return f"CASE WHEN trade = 's' AND price_vnd > 0 THEN CASE {cases} END END"


def _by(style_sql: dict[str, str]) -> str:
    return "CASE style " + " ".join(f"WHEN '{s}' THEN {sql}" for s, sql in style_sql.items()) + " END"


def _x(sql: str, column: str) -> str:
    import re

    return re.sub(r"\bx\b", column, sql)


_SQL = f"""WITH line AS (SELECT *, CAST(l_quantity AS INTEGER) AS q, CAST(l_partkey % 1000 AS INTEGER) AS m, l_orderkey + l_linenumber AS k FROM lineitem),
raw AS (SELECT {", ".join(f"{sql.replace('STRING', 'VARCHAR')} AS {n}" for n, sql in _RAW.items())}, l_shipdate, l_tax FROM line),
parsed AS (SELECT raw.*, n_nationkey AS ward, n_regionkey AS province,
  CAST(trunc({_by({s: f"CAST({_x(_PRICE_SQL[p], 'src_price')} AS DOUBLE)" for s, p in (("names", "unit_needed"), ("ids", "plain_or_unit"), ("folded", "unit_optional"))})}) AS BIGINT) AS price_vnd,
  {_by({s: f"CAST({_x(_AREA_SQL[a], 'src_size')} AS DOUBLE)" for s, a in (("names", "first_number"), ("ids", "strict"), ("folded", "last_sign"))})} AS std_area,
  {_by({"names": "CASE WHEN src_type = 'Cho thuê' THEN 'u' ELSE 's' END", "ids": "CASE WHEN src_type = 'Cho thuê' THEN 'u' ELSE 's' END", "folded": "CASE url WHEN '/ban-nha' THEN 's' WHEN '/cho-thue-nha' THEN 'u' END"})} AS trade,
  CASE WHEN l_tax > 0.01 THEN {_by({"names": "CAST(l_shipdate + to_seconds(946080000) AS DATE)", "ids": "CAST(l_shipdate AS DATE)", "folded": "CAST(l_shipdate + to_seconds(946080000) AS DATE)"})} END AS std_date
  FROM raw LEFT JOIN nation ON src_place = CAST(n_nationkey AS VARCHAR)),
ruled AS (SELECT *, CASE WHEN price_vnd > 0 AND std_area > 0 THEN CASE WHEN style = 'folded' THEN trunc(price_vnd / std_area) ELSE price_vnd / std_area END END AS m2,
  {_by({s: _group(s) for s in ("names", "ids", "folded")})} AS grp, {_by({s: _land(s) for s in ("names", "ids", "folded")})} AS price_land FROM parsed),
cleaned AS (SELECT id, style, province, ward, price_vnd, std_area, {round_sql("m2")} AS price_m2, trade, grp, std_date, strftime(std_date, '%Y-%m') AS std_month, price_land,
  CASE WHEN style = 'other' THEN NULL WHEN price_land IS NULL THEN 'SKIP' ELSE 'DONE' END AS land_price_status,
  CASE WHEN ward IS NULL THEN 0 WHEN NOT coalesce(price_vnd > 0, FALSE) THEN 1 WHEN NOT coalesce(std_area > 0, FALSE) THEN 2 WHEN trade IS NULL THEN 3 WHEN grp IS NULL THEN 4 WHEN std_date IS NULL THEN 5 ELSE 6 END AS process_status FROM ruled)"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("price_m2", F.floor(F.col("price_m2") * 100 + 0.5) / 100.0)


QUERIES += [
    Query("clean_listings", lambda spark, d: _rounded(_cleaned(spark, d)), f"{_SQL} SELECT * FROM cleaned"),
    Query(
        "clean_rejected",
        lambda spark, d: clean.accepted_and_rejected(_cleaned(spark, d))[1].groupBy("style", "reason").agg(F.count("*").alias("n")),
        f"{_SQL} SELECT style, CASE process_status WHEN 0 THEN 'place' WHEN 1 THEN 'price' WHEN 2 THEN 'area' WHEN 3 THEN 'trade' WHEN 4 THEN 'group' ELSE 'date' END AS reason, count(*) AS n FROM cleaned WHERE process_status < 6 GROUP BY ALL",
    ),
    Query("clean_backlog", lambda spark, d: clean.backlog(_cleaned(spark, d)), f"{_SQL} SELECT style, process_status, count(*) AS n FROM cleaned WHERE process_status < 6 GROUP BY ALL"),
    Query(
        "clean_medians",
        lambda spark, d: clean.accepted_and_rejected(_cleaned(spark, d))[0].groupBy("province", "grp").agg(F.median("price_vnd").alias("median"), F.count("*").alias("n")),
        f"{_SQL} SELECT province, grp, median(price_vnd) AS median, count(*) AS n FROM cleaned WHERE process_status = 6 GROUP BY ALL",
    ),
]
