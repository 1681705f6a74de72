"""Trimmed statistics, histograms and growth over groups.

`trim`: of n sorted values the n // 10 least and the n // 10 largest are left out. Values are counted before they are
ordered, so Spark combines a hot group's equal values before the shuffle, and a group's window runs over its distinct values.
Where groups are many and small, which counts would not make smaller, rows go to the task of their group in one shuffle (`small`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round2(x: Column, digits: int = 2) -> Column:
    """Half away from zero on the double itself, which every engine computes alike."""
    return F.signum(x) * F.floor(F.abs(x) * 10**digits + 0.5) / float(10**digits)


#: Ranges of values for each factor of e: a range holds values of half a percent.
RANGES = 200


def value_range(x: Column) -> Column:
    """A whole number that never falls as x rises, of some ten thousand at most for either sign."""
    return F.floor(F.signum(x) * F.log1p(F.abs(x.cast("double"))) * RANGES)


def weighted(df: DataFrame, keys: list[str], value: str, copies: str | None = None, ranged: bool = False) -> DataFrame:
    """Distinct values of each group: `value`, `copies`, `upto` (the copies of it and of all smaller ones), `kept` copies
    after the trim, and the group's `total` of copies and `least` value. `copies`: a column that says for how many rows a row stands.

    With `ranged`, for groups of very many distinct values, copies are counted by ranges of values first. A group's
    window then runs over its ranges, and the values of each range are ordered apart, so that no task orders a whole group."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg((F.sum(copies) if copies else F.count("*")).alias("copies"))
    group = Window.partitionBy(*keys)
    if ranged:
        counted = counted.withColumn("range", value_range(F.col(value)))
        ranges = counted.groupBy(*keys, "range").agg(F.sum("copies").alias("here"), F.min(value).alias("low"))
        before = F.sum("here").over(group.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")
        ranges = ranges.withColumns({"before": before, "total": F.sum("here").over(group), "least": F.min("low").over(group)}).drop("here", "low")
        both = [F.col(f"v.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys] + [F.col("v.range") == F.col("r.range")]
        rows = counted.alias("v").join(ranges.alias("r"), both).select(*[f"v.{c}" for c in counted.columns], "before", "total", "least")
        upto = F.sum("copies").over(Window.partitionBy(*keys, "range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("upto", F.col("before") + upto).drop("before", "range")
    else:
        upto = F.sum("copies").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        rows = counted.withColumns({"upto": upto, "total": F.sum("copies").over(group), "least": F.min(value).over(group)})
    return rows.withColumn("kept", _kept())


def _kept() -> Column:
    cut = F.expr("total div 10")
    return F.greatest(F.lit(0), F.least(F.col("upto"), F.col("total") - cut) - F.greatest(F.col("upto") - F.col("copies"), cut))


def _parts(v: Column) -> dict[str, Column]:
    """The sums and bounds that the statistics of a group are made of."""
    kept = F.col("kept")
    # The value of a rank (from 0) is the least one that has more copies up to it.
    at = lambda rank: F.min(F.when(F.col("upto") > F.expr(rank), v))
    return {
        "kept_sum": F.sum(v * kept),
        "lower": at("(total - 1) div 2"),
        "upper": at("total div 2"),
        "min": F.min(F.when(kept > 0, v)),
        "max": F.max(F.when(kept > 0, v)),
        "trimmed_rows": F.sum("kept"),
        "whole_sum": F.sum(v * F.col("copies")),
        # Squares are taken from the least value on, which keeps their digits.
        "squares": F.sum((v - F.col("least")) * (v - F.col("least")) * kept),
    }


def _finished(rows: DataFrame, keys: list[str], *more: str) -> DataFrame:
    mean = F.col("kept_sum") / F.col("trimmed_rows")
    off = mean - F.col("least").cast("double")
    spread = F.greatest(F.lit(0.0), F.col("squares") / F.col("trimmed_rows") - off * off)
    return rows.select(
        *keys, mean.alias("avg"), ((F.col("lower") + F.col("upper")) / 2).alias("median"), "min", "max", F.col("total").alias("total_rows"), "trimmed_rows",
        (F.col("whole_sum") / F.col("total")).alias("avg_all"), F.sqrt(spread).alias("stddev"), *more,
    )


def trimmed_stats(df: DataFrame, keys: list[str], value: str, copies: str | None = None, ranged: bool = False) -> DataFrame:
    """avg, median, min, max of the trimmed values, stddev of their population, total_rows, trimmed_rows, and avg_all,
    the mean before the trim. Groups without values are absent. `ranged` as in `weighted`."""
    rows = weighted(df, keys, value, copies, ranged)
    sums = rows.groupBy(*keys).agg(*[x.alias(n) for n, x in _parts(F.col(value).cast("double")).items()], F.max("total").alias("total"), F.max("least").alias("least"))
    return _finished(sums, keys)


def small_stats(df: DataFrame, keys: list[str], value: str, copies: str | None = None, stored: str | None = None) -> DataFrame:
    """`trimmed_stats` for many small groups. The caller has brought the rows of a group together by some of the keys
    (`repartition`), so nothing is shuffled here: each task sorts its rows once, and windows pass over one group after another,
    equal values side by side. No task holds more than a sort, which spills.

    `stored`: a column whose greatest value in the group is returned too; rows without a value may bring it."""
    rows = df.select(*keys, value, (F.when(F.col(value).isNotNull(), F.col(copies) if copies else F.lit(1)).otherwise(0)).cast("long").alias("copies"), *([stored] if stored else []))
    rows = rows if stored else rows.where(F.col(value).isNotNull())
    # One order for all, so that there is one sort.
    group = Window.partitionBy(*keys).orderBy(value)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = F.sum("copies").over(group.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"upto": upto, "total": F.sum("copies").over(whole), "least": F.min(value).over(whole), "nth": F.row_number().over(group)})
    parts = _parts(F.col(value).cast("double")) | ({stored: F.max(stored)} if stored else {})
    rows = rows.withColumn("kept", _kept()).withColumns({n: x.over(whole) for n, x in parts.items()})
    return _finished(rows.where("nth = 1 AND total > 0"), keys, *([stored] if stored else []))


@dataclass(frozen=True)
class Scope:
    """A level of statistics: its name, its keys, the rows it takes, and the group it is stored under if not its own."""

    name: str
    keys: tuple[str, ...]
    where: str
    group: int | None = None
    #: Groups are few and large, so their values are ordered by ranges.
    ranged: bool = False
    #: Groups are many and small, so rows are not counted before they are ordered.
    small: bool = False


#: The levels of the price statistics; those of land prices have the same labels and group 5.
SCOPES = (
    Scope("ward", ("province", "ward", "grp", "month"), "grp IS NOT NULL AND ward IS NOT NULL AND province IS NOT NULL"),
    Scope("region", ("province", "grp", "month"), "grp IS NOT NULL AND province IS NOT NULL"),
    Scope("region_total", ("province", "month"), "province IS NOT NULL", 0, True),
    Scope("project", ("project", "grp", "month"), "project > 0 AND grp IS NOT NULL", small=True),
    Scope("street", ("province", "street", "grp", "month"), "street > 0 AND street_source AND grp IS NOT NULL", small=True),
)


def _where(scope: Scope, land: bool) -> str:
    """The rows that a level takes; land prices have one group, so theirs may be unknown."""
    return scope.where.replace(" AND grp IS NOT NULL", "").replace("grp IS NOT NULL AND ", "") if land else scope.where


def scope_stats(facts: DataFrame, scope: Scope, land: bool = False, copies: str | None = None) -> DataFrame:
    """One level as rows (scope, province, ward, street, project, grp, month, statistics); absent keys are 0.

    `facts`: province, ward, street, project, grp, month, street_source, and price or land_price a square metre. `copies`: a
    column that says for how many rows a row stands.
    """
    value = "land_price" if land else "price"
    keys = [k for k in scope.keys if not (land and k == "grp")]
    rows = facts.where(_where(scope, land)).where(F.col(value) > 0)
    if scope.small:
        rows = small_stats(rows.select(*keys, value, *([copies] if copies else [])).repartition(*keys), keys, value, copies)
    else:
        rows = trimmed_stats(rows, keys, value, copies, scope.ranged)
    group = F.lit(5) if land else (F.lit(scope.group) if scope.group is not None else F.col("grp"))
    place = [(F.col(k) if k in keys else F.lit(0)).cast("long").alias(k) for k in ("province", "ward", "street", "project")]
    return rows.select(
        F.lit(scope.name).alias("scope"), *place, group.cast("int").alias("grp"), "month",
        *[round2(F.col(c)).alias(c) for c in ("avg", "median", "min", "max")], "total_rows", "trimmed_rows",
    )


#: The columns of values, and whether they are land prices.
VALUES = {"price": False, "land_price": True}


def value_counts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows (`copies`) of the keys have a price and a land price; what is not above zero counts as none. A row is
    counted once for both, as land prices mostly follow from prices."""
    values = [F.when(F.col(v) > 0, F.col(v)).alias(v) for v in VALUES]
    return facts.select(*keys, *values).where(F.coalesce(*VALUES).isNotNull()).groupBy(*keys, *VALUES).agg(F.count("*").alias("copies"))


def all_scopes(facts: DataFrame) -> DataFrame:
    """Every level of prices and land prices. `facts` is read twice, so it should be a table. For the levels of large groups
    rows are counted at the finest of their keys first, and only the counts are dealt to the levels. Rows of the others are
    dealt as they are, each with its price and its land price, and become two where their place and month is together."""
    keys = ("province", "ward", "street", "project", "grp", "month")
    at = ["level", "province", "ward", "street", "project", "month"]

    def dealt(rows: DataFrame, small: bool) -> DataFrame:
        levels = []
        for i, scope in enumerate(SCOPES):
            if scope.small == small:
                place = [(F.col(k) if k in scope.keys else F.lit(0)).cast("long").alias(k) for k in ("province", "ward", "street", "project")]
                group = F.lit(scope.group) if scope.group is not None else F.col("grp")
                values = {v: F.when(F.expr(f"{v} > 0 AND {_where(scope, land)}"), F.col(v)) for v, land in VALUES.items()}
                row = F.struct(F.lit(i).alias("level"), *place, group.cast("int").alias("grp"), *[x.alias(v) for v, x in values.items()])
                levels.append(F.when(F.coalesce(*values.values()).isNotNull(), row))
        return rows.select("month", "copies", F.explode(F.array_compact(F.array(*levels))).alias("l")).select("l.*", "month", "copies")

    counted = value_counts(facts, ["province", "ward", "grp", "month"])
    rows = dealt(counted, False).unionByName(dealt(facts.select(*keys, "street_source", *VALUES, F.lit(1).cast("long").alias("copies")), True))
    some = F.array_compact(F.array(*[
        F.when(F.col(v).isNotNull(), F.struct(F.lit(land).alias("land"), (F.lit(5) if land else F.col("grp")).alias("grp"), F.col(v).alias("value"))) for v, land in VALUES.items()
    ]))
    rows = rows.repartition(*at).select(*at, "copies", F.explode(some).alias("p")).select(*at, "p.*", "copies")
    by = [*at, "land", "grp"]
    # The sort compares one number most of the time.
    stats = small_stats(rows.withColumn("place", F.xxhash64(*by)), ["place", *by], "value", "copies")
    stats = stats.withColumn("scope", F.get(F.array(*[F.lit(s.name) for s in SCOPES]), F.col("level")))
    return stats.select("scope", *at[1:-1], "grp", "month", *[round2(F.col(c)).alias(c) for c in ("avg", "median", "min", "max")], "total_rows", "trimmed_rows")


def first_generation(facts: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    """The older statistics: the mean is that of all values, and groups without a positive value are there with zeros."""
    groups = facts.select(*keys).distinct()
    stats = trimmed_stats(facts.where(F.col(value) > 0), keys, value)
    joined = groups.alias("g").join(stats.alias("s"), [F.col(f"g.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "left")
    zero = lambda c: F.coalesce(F.col(f"s.{c}"), F.lit(0)).cast("long").alias(c)
    return joined.select(
        *[F.col(f"g.{k}").alias(k) for k in keys], F.col("s.avg_all").alias("avg"),
        *[F.col(f"s.{c}").alias(c) for c in ("median", "min", "max")], zero("total_rows"), zero("trimmed_rows"),
    )


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Rows (bin, low, count) of bins of equal whole width; the last bin takes what is above it. One row of bounds is
    broadcast."""
    bounds = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    width = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low")) / bins))
    rows = df.where(F.col(value).isNotNull()).select(value).join(F.broadcast(bounds.withColumn("width", width)))
    place = F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("low")) / F.col("width"))).cast("int")
    return rows.groupBy(place.alias("bin"), (F.col("low") + place * F.col("width")).alias("low")).agg(F.count("*").alias("count"))


def growth(stats: DataFrame, keys: list[str], least: int = 10) -> DataFrame:
    """Percent by which the median moved since the month and the year before, null if a side is missing or has fewer than
    `least` rows. `stats` has one row for each of the keys and month, and is read once: months are numbered, as series have
    gaps, and looked up in a window. Rows with a null key or month have no row before them."""
    first = F.to_date(F.concat("month", F.lit("-01")))
    number = F.year(first) * 12 + F.month(first)
    whole = number.isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    out = stats.select(*keys, "month", "median", "total_rows", number.alias("number"), whole.alias("whole"))
    series = Window.partitionBy("whole", *keys).orderBy("number")
    for ago, label in ((1, "mom"), (12, "yoy")):
        at = series.rangeBetween(-ago, -ago)
        old = F.max("median").over(at)
        ok = F.col("whole") & (F.col("total_rows") >= least) & (F.max("total_rows").over(at) >= least) & (old > 0)
        out = out.withColumn(label, F.when(ok, (F.col("median") - old) / old * 100))
    return out.drop("number", "whole")


def percent_text(x: Column) -> Column:
    return F.when(x.isNotNull(), F.concat(F.when(x > 0, "+").otherwise(""), F.format_string("%.2f", x)))


def series(stats: DataFrame, groups: tuple[int, ...] = (1, 2, 3, 4, 5)) -> DataFrame:
    """One row a month with the median of each group as a column."""
    return stats.groupBy("month").pivot("grp", list(groups)).agg(F.max("median")).withColumnsRenamed({str(g): f"g{g}" for g in groups})
