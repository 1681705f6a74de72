"""Reports: counts with zeros filled in, given orders, top rows, sums over sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(*predicates: Column | None) -> Column:
    """The predicates that are given, joined by AND; true if none is."""
    return reduce(lambda a, b: a & b, [p for p in predicates if p is not None], F.lit(True))


def zero_filled(dim: DataFrame, counts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Every row of the dimension with its counts, 0 where there are none."""
    return dim.join(counts, key, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def summed(*sources: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One sum a key over the counts of several sources."""
    return reduce(DataFrame.unionByName, sources).groupBy(*keys).agg(F.sum(column).alias(column))


def in_order(listed: DataFrame, report: DataFrame, key: str, place: str, unknown: dict[str, object]) -> DataFrame:
    """The report in the order of an outside list; listed keys without a row get the given values."""
    out = listed.join(report, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in unknown.items()}).orderBy(place)


def pinned(first: Column, *order: Column) -> list[Column]:
    """An order in which the rows where `first` holds come first."""
    return [F.when(first, 0).otherwise(1), *order]


def profile(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: the number of rows, and of those where each check holds."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])


def matched_counts(left: DataFrame, right: DataFrame, key: str, by: list[str]) -> DataFrame:
    """By groups of `left`: its `rows` that `right` has the key of, each counted once; the `ids`, each key once; and the
    `pairs` of an inner join. Rows of `right` are counted before the join, so no pairs are made."""
    sizes = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    return left.join(sizes, key).groupBy(*by).agg(F.count("*").alias("rows"), F.count_distinct(key).alias("ids"), F.sum("__n").alias("pairs"))


def joined_collated(left: DataFrame, right: DataFrame, left_text: str, right_text: str, collation: str = "UNICODE_CI_AI") -> DataFrame:
    """Inner join of texts that are the same in a collation, by default without regard to case and accents."""
    return left.join(right, F.collate(left_text, collation) == F.collate(right_text, collation))


def either_key(left: DataFrame, right: DataFrame, first: Column, second: Column) -> DataFrame:
    """Rows of `left` that match `right` by either condition. Two equi-joins instead of one join by OR, so both hash."""
    return left.join(right, first, "left_semi").union(left.join(right, first, "left_anti").join(right, second, "left_semi"))


def first_text(order: list[str], text: str) -> Column:
    """The text of the first row in order, nulls passed over; an aggregate."""
    return F.min_by(F.col(text), F.when(F.col(text).isNotNull(), F.struct(*order)))


def joined_text(order: list[str], text: str, separator: str = "||") -> Column:
    """All texts in order, nulls passed over; an aggregate."""
    items = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(*order, F.col(text).alias("__text")))))
    return F.array_join(F.transform(items, lambda s: s["__text"]), separator)
