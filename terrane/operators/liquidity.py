"""The liquidity index: how many listings there are against how far their prices spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.parse import quarter_key
from terrane.operators.stats import small_stats, value_counts

#: Labels of the levels.
HIGH, MIDDLE, LOW, TOO_FEW = "THANH_KHOAN_CAO", "THANH_KHOAN_TRUNG_BINH", "THANH_KHOAN_THAP", "KHONG_DU_DU_LIEU"
KEYS = ["scope", "period_type", "period_value", "province", "ward", "street", "grp"]


#: Places of a scope's name in the list.
_SCOPES, _PERIODS = ("ward", "region", "street"), ("month", "quarter", "year")
_PLACE = ["scope", "province", "ward", "street", "grp"]


def counts(facts: DataFrame) -> DataFrame:
    """How many rows of each month, ward and group have a price and a land price."""
    rows = facts.where("province IS NOT NULL").withColumns({"ward": F.col("ward").cast("long"), "grp": F.col("grp").cast("int")})
    return value_counts(rows, ["province", "ward", "month", "grp"])


def spread_out(facts: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """The prices by month and scope (0 ward, 1 region, 2 street), with the number of rows (`copies`) that have them. Wards and
    regions, which are large, are counted (`counts`), and each value stands in `price`, land prices as group 5. The rows of
    streets are given one by one, each with its price and land price, so that `priced` makes two of them where they are needed."""
    none, one = F.lit(None).cast("long"), F.lit(1).cast("long").alias("copies")
    at = lambda i, ward, street: F.struct(F.lit(i).alias("scope"), ward.alias("ward"), street.alias("street"))
    large = F.array_compact(F.array(F.when(F.col("ward").isNotNull(), at(0, F.col("ward"), none)), at(1, none, none)))
    no_land = F.lit(None).cast(facts.schema["land_price"].dataType).alias("land_price")
    counted = priced(counts(facts) if counted is None else counted).withColumn("at", F.explode(large))
    counted = counted.select("at.*", "province", "grp", F.col("value").alias("price"), no_land, "month", "copies")
    rows = facts.where("province IS NOT NULL").withColumns({"street": F.col("street").cast("long"), "grp": F.col("grp").cast("int")})
    streets = rows.where("street_source AND street > 0 AND (price > 0 AND grp IS NOT NULL OR land_price > 0)")
    streets = streets.select(F.lit(2).alias("scope"), none.alias("ward"), "street", "province", "grp", "price", "land_price", "month", one)
    return counted.unionByName(streets)


def priced(rows: DataFrame) -> DataFrame:
    """The rows with one `value` each, land prices as group 5. Rows that stand for none, which bring a stored median, stay as they are."""
    some = F.array_compact(F.array(
        F.when(F.expr("price > 0 AND grp IS NOT NULL"), F.struct("grp", F.col("price").alias("value"))),
        F.when(F.col("land_price") > 0, F.struct(F.lit(5).alias("grp"), F.col("land_price").alias("value"))),
    ))
    none = F.array(F.struct("grp", F.col("price").alias("value")))
    rows = rows.withColumn("p", F.explode(F.when(F.col("copies") > 0, some).otherwise(none)))
    return rows.select(*[c for c in rows.columns if c not in ("grp", "price", "land_price", "p")], "p.*")


def measures(facts: DataFrame, medians: DataFrame | None = None, counted: DataFrame | None = None) -> DataFrame:
    """raw_rows, trimmed_rows, median, whether that was `given`, and stddev of each scope, period (by their places in
    the lists of names) and group. `medians` as in `index`; `counted`: the `counts` of the facts, if they are at hand.

    The prices of a place, group and year go to one task, in one shuffle; land prices, quarters and years are made of them
    there. Stored medians go with them as rows without a price.
    """
    rows = spread_out(facts, counted).withColumn("stored", F.lit(None).cast("double"))
    if medians is not None:
        scope = (F.array_position(F.array(*map(F.lit, _SCOPES)), F.col("scope")) - 1).cast("int")
        best = medians.where(F.col("stored") > 0).select(
            scope.alias("scope"), *[F.col(k).cast(rows.schema[k].dataType) for k in _PLACE[1:]], F.col("period_value").alias("month"), F.col("stored").cast("double"),
            *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("price", "land_price")], F.lit(0).cast("long").alias("copies"),
        )
        rows = rows.unionByName(best)
    year = F.substring("month", 1, 4)
    # A row of a street may belong to two groups, so both are in its task.
    apart = F.when(F.col("scope") != _SCOPES.index("street"), F.col("grp"))
    rows = priced(rows.withColumn("place", F.hash(*[k for k in _PLACE if k != "grp"], apart, year)).repartition("place"))
    each = [F.col("month"), quarter_key(F.col("month")), year]
    periods = F.array(*[F.struct(F.lit(i).alias("period"), v.alias("period_value")) for i, v in enumerate(each)])
    # A stored median is that of its month alone.
    periods = F.when(F.col("value").isNull(), F.slice(periods, 1, 1)).otherwise(periods)
    rows = rows.select("place", *_PLACE, "value", "copies", "stored", F.explode(periods).alias("p")).select("place", *_PLACE, "p.*", "value", "copies", "stored")
    stats = small_stats(rows, ["place", *_PLACE, "period", "period_value"], "value", "copies", "stored")
    given = F.coalesce(F.col("stored") > 0, F.lit(False))
    return stats.select(
        *_PLACE, "period", "period_value", F.col("total_rows").alias("raw_rows"), "trimmed_rows",
        F.when(given, F.col("stored")).otherwise(F.col("median")).alias("median"), given.alias("given"), "stddev",
    )


def ranked(measured: DataFrame, table: bool = False) -> DataFrame:
    """cv, vitality and level of `measures`, with the names of scopes and periods. What can be told from other columns is
    not sent to the cohorts. With `table`, for measures that are a table and cheap to read twice, only groups with enough rows are sent."""
    cohort = ["scope", "period", "period_value", "grp", "inner"]
    cv = F.when(F.col("median") > 0, F.when(F.col("trimmed_rows") > 1, F.col("stddev")).otherwise(0.0) / F.col("median"))
    vitality = F.when(F.col("cv") > 0, F.col("trimmed_rows") / F.col("cv"))
    rows = measured.withColumn("inner", F.when(F.col("scope") != _SCOPES.index("region"), F.col("province")))
    rows = (rows if table else rows.repartition(*cohort)).withColumn("cv", cv).withColumn("vitality", vitality)
    if table:
        enough = F.coalesce(_enough(), F.lit(False))
        out = _dealt(rows.where(enough), cohort).unionByName(rows.where(~enough).withColumn("level", F.lit(TOO_FEW)))
    else:
        out = _dealt(rows, cohort)
    name = lambda names, c: F.get(F.array(*map(F.lit, names)), F.col(c))
    return out.select(
        name(_SCOPES, "scope").alias("scope"), name(_PERIODS, "period").alias("period_type"), *KEYS[2:], "raw_rows", "trimmed_rows", "median", "stddev",
        F.when(F.col("given"), "stored").otherwise("computed").alias("median_source"), "cv", "vitality", "level",
    )


def index(facts: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """raw_rows, trimmed_rows, median, stddev, cv, vitality and level of each scope, period and group, in one plan. `facts` is read twice.

    `medians`: stored medians of months (the same keys without period_type, `period_value` the month, and `stored`); a
    positive one replaces the computed median.
    """
    return ranked(measures(facts, medians))


def _enough() -> Column:
    return (F.col("trimmed_rows") >= 10) & F.col("vitality").isNotNull()


def _dealt(stats: DataFrame, cohort: list[str]) -> DataFrame:
    same = Window.partitionBy("enough", *cohort)
    place = F.row_number().over(same.orderBy(F.desc("vitality"), "province", "ward", "street")) - 1
    size = F.count("*").over(same)
    quarter = F.greatest(F.lit(1), F.ceil(size * 0.25))
    level = F.when(~F.col("enough"), TOO_FEW).when(place < quarter, HIGH).when(place >= size - quarter, LOW).otherwise(MIDDLE)
    return stats.withColumn("enough", _enough()).withColumn("level", level).drop("enough")


def levels(stats: DataFrame) -> DataFrame:
    """The quarter of a cohort with the most vitality is high, the last quarter low. Wards and streets are ranked within
    their province, regions against each other; the high end is dealt first. Ties stand in the order of the keys."""
    rows = stats.withColumn("inner", F.when(F.col("scope") != "region", F.col("province")))
    return _dealt(rows, ["scope", "period_type", "period_value", "grp", "inner"]).drop("inner")
