"""Joins of texts by what they share, as equi-joins on short pieces: longest prefixes, containment, and string ratios.

No function pairs all rows of a key. Pieces are exploded, the rarest ones joined, and each pair that meets is verified, so
nothing is lost: a text that contains a pattern has all of its pieces, and texts of a high ratio share many characters.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.sources.stored import saved


def by_longest_prefix(df: DataFrame, path: str, rules: DataFrame, prefix: str = "prefix", mark: str = "-") -> DataFrame:
    """All rows and columns of `df` with the other columns of the rule whose prefix is the longest of those that the path is
    or begins with, up to a `mark`; nulls where no rule fits. Of rules of one prefix the least in all columns wins.

    An index of prefixes: each distinct path is cut at its marks, as far as the longest rule goes, and joined by equality."""
    columns = [c for c in rules.columns if c != prefix]
    one = rules.where(F.col(prefix).isNotNull()).groupBy(F.col(prefix).alias("__prefix")).agg(F.min(F.struct(*columns)).alias("__rule"))
    words = lambda x: F.split(x, f"\\Q{mark}\\E", -1)
    most = one.agg(F.max(F.size(words(F.col("__prefix"))))).first()[0] or 0
    paths = df.where(F.col(path).isNotNull()).select(F.col(path).alias("__path")).distinct()
    parts = words(F.col("__path"))
    cuts = F.transform(F.sequence(F.lit(1), F.least(F.lit(max(1, most)), F.size(parts))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), mark))
    met = paths.select("__path", F.explode(cuts).alias("__prefix")).join(one, "__prefix")
    best = met.groupBy("__path").agg(F.max_by("__rule", F.char_length("__prefix")).alias("__rule"))
    return df.join(best, F.col(path) == F.col("__path"), "left").select(*df.columns, *[F.col(f"__rule.{c}").alias(c) for c in columns])


#: Characters of a piece by which patterns are found in texts.
GRAM = 3


def _grams(x: Column, size: int | Column) -> Column:
    n = F.char_length(x)
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(n >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(x, i, size))))


def occurring(texts: DataFrame, patterns: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, text, pattern): the distinct texts that contain a pattern, inside words too, however long either is. Both
    tables have `keys`, which must be equal, and `text` or `pattern`; blank and null ones occur nowhere.

    Each pattern is looked for by one piece of three characters, itself if it is shorter: the one that the fewest patterns have."""
    keys = keys or []
    texts = texts.where("text <> ''").select(*keys, "text").distinct()
    patterns = patterns.where("pattern <> ''").select(*keys, "pattern").distinct()
    size = F.least(F.lit(GRAM), F.char_length("pattern"))
    # GRAM rows at most.
    sizes = [r[0] for r in patterns.select(size).distinct().collect()]
    own = patterns.select(*keys, "pattern", F.explode(_grams(F.col("pattern"), size)).alias("gram"))
    often = own.groupBy("gram").agg(F.count("*").alias("n"))
    rare = own.join(often, "gram").groupBy(*keys, "pattern").agg(F.min(F.struct("n", "gram")).alias("least")).select(*keys, "pattern", F.col("least.gram").alias("gram"))
    every = [_grams(F.col("text"), n) for n in sorted(sizes)]
    every = F.flatten(F.array_compact(F.array(*every))) if every else F.array().cast("array<string>")
    pieces = texts.select(*keys, "text", F.explode(every).alias("gram"))
    return pieces.join(rare, [*keys, "gram"]).where(F.contains("text", "pattern")).select(*keys, "text", "pattern")


def string_ratio(least: float):
    """The ratio of two texts, the first as the source, where it is `least` or more, else null. Two upper bounds go before
    it: the lengths, and the characters that both have."""

    @F.pandas_udf(T.DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str, y: str) -> float | None:
            match = SequenceMatcher(None, x, y)
            if match.real_quick_ratio() >= least and match.quick_ratio() >= least and (r := match.ratio()) >= least:
                return r
            return None

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")

    return ratio


def _needed(n: Column, least: float) -> Column:
    """Characters that two texts of n characters in all must match for the ratio."""
    return F.ceil(n * (least / 2) - 1e-9)


def similar(left: DataFrame, right: DataFrame, keys: list[str], least: float) -> DataFrame:
    """(keys, a, b, score): the distinct names of two tables (keys, name) whose ratio is `least` or more, which must be
    positive; null and blank names are similar to none.

    Names match in blocks. Of n characters in all, m at least match on each side; the others, n - 2m, keep the blocks apart,
    so these hold 3m - n - 1 whole bigrams at least. Where that is positive for every length that the other name may
    have, names are joined on bigrams, else on characters, of which m must be shared. A piece is one with its
    number among equal ones of the name. With all pieces in one order, rare ones first, two names that must share c of
    them share one among the first (pieces - c + 1) of each."""
    rest = least / (2 - least)

    def pieces(side: DataFrame, number: int) -> DataFrame:
        names = side.where("name <> ''").select(*keys, "name").distinct().withColumn("size", F.char_length("name"))
        low, high = F.ceil(F.col("size") * rest - 1e-9), F.floor(F.col("size") / rest + 1e-9)
        totals = F.transform(F.sequence(low, high), lambda other: other + F.col("size"))
        bigrams = F.array_min(F.transform(totals, lambda n: 3 * _needed(n, least) - n - 1))
        names = names.withColumn("long", bigrams > 0).withColumn("shared", F.struct(bigrams.alias("two"), _needed(F.col("size") + low, least).alias("one")))
        cut = lambda gram: F.transform(F.sequence(F.lit(1), F.col("size") - gram + 1), lambda i: F.struct(F.lit(gram).alias("gram"), F.substring(F.col("name"), i, F.lit(gram)).alias("piece")))
        both = F.concat(cut(1), F.when(F.col("long"), cut(2)).otherwise(F.array().cast("array<struct<gram:int,piece:string>>")))
        each = names.select(F.lit(number).alias("side"), "*", F.explode(both).alias("p"))
        each = each.groupBy("side", *keys, "name", "size", "long", "shared", "p.gram", "p.piece").agg(F.count("*").alias("copies"))
        return each.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")

    every = pieces(left, 0).unionByName(pieces(right, 1))
    counts = every.groupBy("piece", "nth").agg(F.count("*").alias("n"))
    order = every.join(counts, ["piece", "nth"]).groupBy("side", *keys, "name", "size", "long", "shared", "gram").agg(F.array_sort(F.collect_list(F.struct("n", "piece", "nth"))).alias("order"))
    shared = F.when(F.col("gram") == 2, F.col("shared.two")).otherwise(F.col("shared.one"))
    want = F.greatest(F.lit(1), F.size("order") - shared + 1).cast("int")
    leading = saved(order.select("side", *keys, "name", "size", "long", "gram", F.explode(F.slice("order", F.lit(1), want)).alias("p")).select("side", *keys, "name", "size", "long", "gram", "p.piece", "p.nth"), "leading")
    sides = [leading.where(f"side = {i}").drop("side").withColumnsRenamed({"name": c, "size": f"{c}_size", "long": f"{c}_long"}) for i, c in enumerate("ab")]
    met = sides[0].join(sides[1], [*keys, "gram", "piece", "nth"])
    near = 2 * F.least("a_size", "b_size") >= least * (F.col("a_size") + F.col("b_size")) - 1e-9
    # Two long names meet on bigrams, all others on characters.
    pairs = met.where(near & ((F.col("gram") == 2) == (F.col("a_long") & F.col("b_long")))).select(*keys, "a", "b").distinct()
    return pairs.withColumn("score", string_ratio(least)("a", "b")).where("score IS NOT NULL")
