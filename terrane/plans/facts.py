"""The listing facts that the statistics are taken of, derived from the sales tables.

A sale line is a listing: the customer's nation its ward, that nation's region its province, the supplier its street, the
part its project, the part's type its group; the price a square metre is price by quantity, in whole hundredths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.sources.listings import table
from terrane.sources.stored import saved


def facts(spark: SparkSession, folder: str) -> DataFrame:
    price = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity") + 0.5)
    # The lines are shuffled with what the statistics need of them and no more: flags instead of texts, months instead of times.
    whole = F.when(F.col("l_returnflag").isin("A", "R"), F.col("l_returnflag") == "A")
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", whole.alias("whole"), price.alias("price"))
    group = F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), 1).when(F.col("p_type") == "PROMO", 2).when(F.col("p_type") == "LARGE", 3).when(F.col("p_type") == "MEDIUM", 4)
    part = table(spark, folder, "part").select("p_partkey", group.alias("grp"))
    month, source = F.date_format("o_orderdate", "yyyy-MM"), F.col("o_orderstatus") == "F"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", month.alias("month"), source.alias("street_source"))
    place = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_regionkey")
    # Orders meet their places before the lines, which are many more and so are shuffled once less. The lines meet
    # their parts first, which add one small number, and then their orders, which add the most.
    orders = orders.join(place, F.col("o_custkey") == F.col("c_custkey"))
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    land = F.when(F.col("whole"), F.col("price")).when(~F.col("whole"), F.expr("price * 85 div 100"))
    return rows.select(
        F.col("n_regionkey").alias("province"), F.col("c_nationkey").alias("ward"), F.col("l_suppkey").alias("street"), F.col("l_partkey").alias("project"),
        "grp", "month", "street_source", "price", land.alias("land_price"),
    )


def stored_facts(spark: SparkSession, folder: str, *unused: str) -> DataFrame:
    """The facts without the columns `unused`, made once and written as a table, for queries that read them several times: each
    reading would shuffle all lines twice, as different columns keep Spark from using a shuffle again."""
    return saved(facts(spark, folder).drop(*unused), "facts")


FACTS_SQL = """facts AS (
  SELECT n_regionkey AS province, c_nationkey AS ward, l_suppkey AS street, l_partkey AS project,
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 1 WHEN p_type = 'PROMO' THEN 2 WHEN p_type = 'LARGE' THEN 3 WHEN p_type = 'MEDIUM' THEN 4 END AS grp,
    strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus = 'F' AS street_source,
    CAST(floor(l_extendedprice * 100 / l_quantity + 0.5) AS BIGINT) AS price,
    CASE WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice * 100 / l_quantity + 0.5) AS BIGINT)
         WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice * 100 / l_quantity + 0.5) AS BIGINT) * 85 // 100 END AS land_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def trimmed_sql(keys: list[str], source: str, value: str = "v") -> str:
    """A DuckDB query: the statistics of `terrane.operators.stats.trimmed_stats` over a table."""
    by = ", ".join(keys)
    return f"""SELECT {by}, avg({value}) FILTER (rn > n // 10 AND rn <= n - n // 10) AS avg, median({value}) AS median,
    min({value}) FILTER (rn > n // 10 AND rn <= n - n // 10) AS min, max({value}) FILTER (rn > n // 10 AND rn <= n - n // 10) AS max,
    stddev_pop({value}) FILTER (rn > n // 10 AND rn <= n - n // 10) AS stddev, max(n) AS total_rows,
    count(*) FILTER (rn > n // 10 AND rn <= n - n // 10) AS trimmed_rows, avg({value}) AS avg_all
  FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {value}) AS rn, count(*) OVER (PARTITION BY {by}) AS n FROM {source})
  GROUP BY {by}"""


def round_sql(x: str, digits: int = 2) -> str:
    return f"sign({x}) * floor(abs({x}) * {10**digits} + 0.5) / {float(10**digits)}"
