"""Queries of the price statistics and the liquidity index."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane.operators import liquidity, stats
from terrane.plans.facts import FACTS_SQL, facts, round_sql, stored_facts, trimmed_sql
from terrane.plans.registry_type import Query
from terrane.sources.stored import saved

QUERIES: list[Query] = []


def _scope_sql(scope: stats.Scope, land: bool) -> str:
    value = "land_price" if land else "price"
    keys = [k for k in scope.keys if not (land and k == "grp")]
    where = scope.where.replace(" AND grp IS NOT NULL", "").replace("grp IS NOT NULL AND ", "") if land else scope.where
    group = "5" if land else ("0" if scope.group == 0 else "grp")
    place = ", ".join(f"CAST({k if k in keys else 0} AS BIGINT) AS {k}" for k in ("province", "ward", "street", "project"))
    rounded = ", ".join(f"{round_sql(c)} AS {c}" for c in ("avg", "median", "min", "max"))
    return f"""SELECT '{scope.name}' AS scope, {place}, CAST({group} AS INTEGER) AS grp, month, {rounded}, CAST(total_rows AS BIGINT) AS total_rows, trimmed_rows
  FROM ({trimmed_sql(keys, f"(SELECT *, {value} AS v FROM facts WHERE {where} AND {value} > 0)")})"""


for _land in (False, True):
    for _scope in stats.SCOPES:
        QUERIES.append(Query(
            f"{'land_' if _land else 'median_'}{_scope.name}",
            lambda spark, d, s=_scope, land=_land: stats.scope_stats(facts(spark, d), s, land),
            f"WITH {FACTS_SQL} {_scope_sql(_scope, _land)}",
        ))

QUERIES.append(Query(
    "median_all_scopes",
    lambda spark, d: stats.all_scopes(stored_facts(spark, d)),
    f"WITH {FACTS_SQL} " + " UNION ALL ".join(_scope_sql(s, land) for land in (False, True) for s in stats.SCOPES),
))

for _name, _keys in (("ward", ["province", "ward", "grp", "month"]), ("region", ["province", "grp", "month"]), ("region_total", ["province", "month"])):
    _by = ", ".join(f"g.{k}" for k in _keys)
    _on = " AND ".join(f"g.{k} IS NOT DISTINCT FROM s.{k}" for k in _keys)
    QUERIES.append(Query(
        f"stats_v1_{_name}",
        lambda spark, d, keys=_keys: stats.first_generation(facts(spark, d).withColumn("price", F.when(F.col("price") % 7 > 0, F.col("price"))), keys).withColumns(
            {c: stats.round2(F.col(c)) for c in ("avg", "median", "min", "max")}
        ),
        f"""WITH {FACTS_SQL}, g AS (SELECT DISTINCT {", ".join(_keys)} FROM facts),
        s AS ({trimmed_sql(_keys, "(SELECT *, price AS v FROM facts WHERE price > 0 AND price % 7 > 0)")})
        SELECT {_by}, {round_sql("s.avg_all")} AS avg, {round_sql("s.median")} AS median, {round_sql("s.min")} AS min, {round_sql("s.max")} AS max,
          CAST(coalesce(s.total_rows, 0) AS BIGINT) AS total_rows, coalesce(s.trimmed_rows, 0) AS trimmed_rows FROM g LEFT JOIN s ON {_on}""",
    ))

QUERIES.append(Query(
    "price_histogram",
    lambda spark, d: stats.histogram(facts(spark, d), "price"),
    f"""WITH {FACTS_SQL}, b AS (SELECT min(price) AS low, greatest(1, ceil((max(price) - min(price)) / 10.0)) AS width FROM facts)
    SELECT CAST(least(9, floor((price - low) / width)) AS INTEGER) AS bin, CAST(low + least(9, floor((price - low) / width)) * width AS BIGINT) AS low, count(*) AS count
    FROM facts, b GROUP BY 1, 2""",
))

_REGION = f"""WITH {FACTS_SQL}, s AS ({_scope_sql(stats.SCOPES[1], False)})"""
QUERIES.append(Query(
    "growth_region",
    lambda spark, d: stats.growth(stats.scope_stats(facts(spark, d), stats.SCOPES[1]), ["province", "grp"], least=5).withColumns(
        {"mom": stats.round2(F.col("mom")), "yoy": stats.round2(F.col("yoy"))}
    ),
    _REGION + f""" SELECT a.province, a.grp, a.month, a.median, a.total_rows,
      CASE WHEN a.total_rows >= 5 AND b.total_rows >= 5 AND b.median > 0 THEN {round_sql("(a.median - b.median) / b.median * 100")} END AS mom,
      CASE WHEN a.total_rows >= 5 AND c.total_rows >= 5 AND c.median > 0 THEN {round_sql("(a.median - c.median) / c.median * 100")} END AS yoy
    FROM s a LEFT JOIN s b ON a.province = b.province AND a.grp = b.grp AND b.month = strftime(CAST(a.month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')
      LEFT JOIN s c ON a.province = c.province AND a.grp = c.grp AND c.month = strftime(CAST(a.month || '-01' AS DATE) - INTERVAL 12 MONTH, '%Y-%m')""",
))
QUERIES.append(Query(
    "growth_text",
    lambda spark, d: stats.growth(stats.scope_stats(facts(spark, d), stats.SCOPES[2]), ["province"], least=5).select("province", "month", stats.percent_text(stats.round2(F.col("mom"))).alias("mom")),
    f"""WITH {FACTS_SQL}, s AS ({_scope_sql(stats.SCOPES[2], False)}), g AS (
      SELECT a.province, a.month, CASE WHEN a.total_rows >= 5 AND b.total_rows >= 5 AND b.median > 0 THEN {round_sql("(a.median - b.median) / b.median * 100")} END AS m
      FROM s a LEFT JOIN s b ON a.province = b.province AND b.month = strftime(CAST(a.month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m'))
    SELECT province, month, CASE WHEN m IS NULL THEN NULL ELSE CASE WHEN m > 0 THEN '+' ELSE '' END || printf('%.2f', m) END AS mom FROM g""",
))
QUERIES.append(Query(
    "median_series",
    lambda spark, d: stats.series(stats.scope_stats(facts(spark, d).withColumn("province", F.lit(1)), stats.SCOPES[1])),
    f"""WITH {FACTS_SQL.replace("n_regionkey AS province", "1 AS province")}, s AS ({_scope_sql(stats.SCOPES[1], False)})
    SELECT month, {", ".join(f"max(median) FILTER (grp = {g}) AS g{g}" for g in (1, 2, 3, 4, 5))} FROM s GROUP BY month""",
))

_SPREAD = """prices AS (
  SELECT province, ward, street, street_source, month, grp, price AS v FROM facts WHERE price > 0 AND grp IS NOT NULL
  UNION ALL SELECT province, ward, street, street_source, month, 5, land_price FROM facts WHERE land_price > 0),
periods AS (
  SELECT *, 'month' AS period_type, month AS period_value FROM prices
  UNION ALL SELECT *, 'quarter', substr(month, 1, 4) || '-Q' || ((CAST(substr(month, 6, 2) AS INTEGER) + 2) // 3) FROM prices
  UNION ALL SELECT *, 'year', substr(month, 1, 4) FROM prices),
spread AS (
  SELECT 'ward' AS scope, period_type, period_value, province, CAST(ward AS BIGINT) AS ward, CAST(NULL AS BIGINT) AS street, grp, v FROM periods WHERE ward IS NOT NULL
  UNION ALL SELECT 'region', period_type, period_value, province, NULL, NULL, grp, v FROM periods
  UNION ALL SELECT 'street', period_type, period_value, province, NULL, street, grp, v FROM periods WHERE street > 0 AND street_source)"""


def _index_sql(stored: str = "") -> str:
    keys = liquidity.KEYS
    median = "coalesce(CASE WHEN stored > 0 THEN stored END, median)" if stored else "median"
    source = "CASE WHEN stored > 0 THEN 'stored' ELSE 'computed' END" if stored else "'computed'"
    return f"""WITH {FACTS_SQL}, {_SPREAD}, base AS ({trimmed_sql(keys, "spread")}), st AS (
      SELECT {", ".join("base." + k for k in keys)}, total_rows, trimmed_rows, {median} AS median, CASE WHEN trimmed_rows > 1 THEN stddev ELSE 0 END AS stddev, {source} AS median_source FROM base {stored}),
    cvs AS (SELECT *, CASE WHEN median > 0 THEN stddev / median END AS cv FROM st),
    vs AS (SELECT *, CASE WHEN cv > 0 THEN trimmed_rows / cv END AS vitality FROM cvs),
    ranked AS (SELECT *, trimmed_rows >= 10 AND vitality IS NOT NULL AS enough, CASE WHEN scope <> 'region' THEN province END AS inside FROM vs),
    placed AS (SELECT *, row_number() OVER (PARTITION BY enough, scope, period_type, period_value, grp, inside
        ORDER BY floor(vitality * 10000 + 0.5) DESC NULLS LAST, province, ward NULLS FIRST, street NULLS FIRST) - 1 AS i,
      count(*) OVER (PARTITION BY enough, scope, period_type, period_value, grp, inside) AS size FROM ranked)
    SELECT {", ".join(keys)}, CAST(total_rows AS BIGINT) AS raw_rows, trimmed_rows, {round_sql("median")} AS median, median_source, {round_sql("cv", 6)} AS cv, {round_sql("vitality", 4)} AS vitality,
      CASE WHEN NOT enough THEN '{liquidity.TOO_FEW}' WHEN i < greatest(1, ceil(size * 0.25)) THEN '{liquidity.HIGH}'
           WHEN i >= size - greatest(1, ceil(size * 0.25)) THEN '{liquidity.LOW}' ELSE '{liquidity.MIDDLE}' END AS level FROM placed"""


def _index(spark, d, with_stored=False):
    """Each step that several others read is a table: the facts, the counts of wards, and the measures, most of which are of
    streets with too few rows for a cohort."""
    rows = stored_facts(spark, d, "project")
    counted = liquidity.counts(rows)
    if with_stored:
        counted = saved(counted, "counts")
    out = liquidity.ranked(saved(liquidity.measures(rows, _stored(counted) if with_stored else None, counted), "measures"), table=True)
    return out.select(*liquidity.KEYS, "raw_rows", "trimmed_rows", stats.round2(F.col("median")).alias("median"), "median_source", stats.round2(F.col("cv"), 6).alias("cv"), stats.round2(F.col("vitality"), 4).alias("vitality"), "level")


def _stored(counted):
    """The monthly medians of wards as they would be stored, of the counts of their prices."""
    rows = stats.scope_stats(counted, stats.SCOPES[0], copies="copies")
    return rows.select("scope", F.col("month").alias("period_value"), "province", "ward", F.lit(None).cast("long").alias("street"), "grp", F.col("median").alias("stored"))


QUERIES.append(Query("liquidity_index", _index, _index_sql()))
QUERIES.append(Query(
    "liquidity_index_stored_medians",
    lambda spark, d: _index(spark, d, True),
    _index_sql(f"""LEFT JOIN (SELECT 'month' AS t, month AS pv, province AS pr, ward AS wa, grp AS gr, median AS stored FROM ({_scope_sql(stats.SCOPES[0], False)})) q
      ON base.scope = 'ward' AND period_type = t AND period_value = pv AND base.province = pr AND base.ward = wa AND base.grp = gr"""),
))
