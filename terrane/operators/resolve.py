"""Entity resolution: names matched exactly, normalised, by their core, then by blocked fuzzy scores.

Names are compared once each: equal names of a side are one row until the end. A score that is high enough needs a certain
overlap of words, so candidates are found by prefix filtering: with all words in order of rarity, names that overlap that
much share one among the first few words of each. Only the string ratio, which Spark lacks, runs in Python, over Arrow
batches, for the candidates whose words and lengths still allow the score.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions.text import project_core, project_name, trailing_number
from terrane.operators.grams import occurring, similar
from terrane.sources.stored import saved


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two texts, the first as the source; 0 if either is empty."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("ratio", T.DoubleType()), T.StructField("place", T.IntegerType())]))
def best_ratio(name: pd.Series, core: pd.Series, variants: pd.Series, cores: pd.Series) -> pd.DataFrame:
    """The best ratio of a name to the variants and of its core to theirs, and the place of the variant that has it
    (-1: a core, or none). The first of several wins."""

    def one(s: str, c: str, names, bare) -> tuple[float, int]:
        best, place = 0.0, -1
        for at, source, target in [*((i, s, v) for i, v in enumerate(names)), *((-1, c, v) for v in bare)]:
            if source and target:
                match = SequenceMatcher(None, source, target)
                if match.quick_ratio() > best and (r := match.ratio()) > best:
                    best, place = r, at
        return best, place

    return pd.DataFrame([one(*x) for x in zip(name, core, variants, cores)], columns=["ratio", "place"]).astype({"ratio": "float64", "place": "int32"})


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The best ratio, in percent, between the shared words of two texts and either text's words in order."""

    def one(x: str, y: str) -> float:
        s, t = set((x or "").split()), set((y or "").split())
        if not s or not t:
            return 0.0
        both = " ".join(sorted(s & t))
        left, right = f"{both} {' '.join(sorted(s - t))}".strip(), f"{both} {' '.join(sorted(t - s))}".strip()
        pairs = [(left, right)] if not both else [(both, left), (both, right), (left, right)]
        return round(100 * max(SequenceMatcher(None, p, q).ratio() for p, q in pairs))

    return pd.Series([float(one(x, y)) for x, y in zip(a, b)], dtype="float64")


def _words(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(name, " "), lambda t: t != ""))


def named(df: DataFrame, name: str = "name", variants: tuple[str, ...] = ()) -> DataFrame:
    """Add norm, core and tokens of the name; `variants`, the norms of the name and of the columns so called, and `cores`,
    what is left of these without leading generic words. Blank ones are left out."""
    own = df.withColumns({"norm": project_name(F.col(name)), "core": project_core(F.col(name))}).withColumn("tokens", _words(F.col("norm")))
    every = F.filter(F.array("norm", *[project_name(F.col(v)) for v in variants]), lambda v: v != "")
    own = own.withColumn("variants", F.array_distinct(every))
    return own.withColumn("cores", F.array_distinct(F.filter(F.transform("variants", project_core), lambda v: v != "")))


def _near(s_region: str = "s_region", d_region: str = "d_region") -> Column:
    """Two known regions must be equal."""
    return F.col(s_region).isNull() | F.col(d_region).isNull() | (F.col(s_region) == F.col(d_region))


def _with_regions(pairs: DataFrame, src: DataFrame, dst: DataFrame) -> DataFrame:
    """Pairs of names with the regions in which their sides have them."""
    s = src.select(F.col("norm").alias("s_norm"), F.col("region").alias("s_region")).distinct()
    d = dst.select(F.col("norm").alias("d_norm"), F.col("variants").alias("d_variants"), F.col("region").alias("d_region")).distinct()
    return pairs.join(s, "s_norm").join(d, ["d_norm", "d_variants"]).where(_near())


def _enough(hits: Column, size: Column, least_hits: int) -> Column:
    """Shared words that a pair needs: one if the source has two or fewer, else `least_hits`."""
    return hits >= F.when(size <= 2, 1).otherwise(least_hits)


def candidates(src: DataFrame, dst: DataFrame, least_hits: int = 2) -> DataFrame:
    """Pairs of distinct names (s_norm, d_norm, d_variants and their regions) that share enough words."""
    left = src.select(F.col("norm").alias("s_norm"), F.size("tokens").alias("size"), F.explode("tokens").alias("word")).distinct()
    every = F.array_distinct(F.flatten(F.transform("variants", _words)))
    right = dst.select(F.col("norm").alias("d_norm"), F.col("variants").alias("d_variants"), F.explode(every).alias("word")).distinct()
    hits = left.join(right, "word").groupBy("s_norm", "d_norm", "d_variants", "size").agg(F.count("*").alias("hits"))
    return _with_regions(hits.where(_enough(F.col("hits"), F.col("size"), least_hits)).select("s_norm", "d_norm", "d_variants"), src, dst)


def overlapping(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b) of the names of two tables (`name`, distinct, and `words`) whose sets of words have a Jaccard similarity of
    `least` or more, which must be positive."""
    counts = left.select(F.explode("words").alias("word")).unionAll(right.select(F.explode("words").alias("word"))).groupBy("word").agg(F.count("*").alias("n"))

    def leading(side: DataFrame, name: str, words: str) -> DataFrame:
        rows = side.select("name", "words", F.explode("words").alias("word")).join(counts, "word")
        rows = rows.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("order"), F.first("words").alias(words))
        want = F.size(words) - F.ceil(F.size(words) * least - 1e-9) + 1
        return rows.select(F.col("name").alias(name), words, F.explode(F.slice("order", F.lit(1), want.cast("int")))).select(name, words, F.col("col.word").alias("word"))

    met = leading(left, "a", "x").join(leading(right, "b", "y"), "word")
    size_x, size_y = F.size("x"), F.size("y")
    met = met.where(F.least(size_x, size_y) >= F.greatest(size_x, size_y) * least - 1e-9)
    shared = F.size(F.array_intersect("x", "y"))
    return met.where(shared >= (size_x + size_y - shared) * least - 1e-9).select("a", "b").distinct()


def scored(src: DataFrame, dst: DataFrame, least: float, number_penalty: float = 0.18, least_hits: int = 2) -> DataFrame:
    """Pairs of names (s_norm, d_norm, d_variants and their regions) with a `score` of `least` or more: 0.65 of the best
    ratio, 0.3 of the Jaccard similarity with the words of what has it, 0.05 for the region, 0.05 for containment, less the
    penalty for a number that no variant has. `least` must be above 0.75, below which words need not overlap."""
    bonus = 0.1
    least_jaccard, least_ratio = (least - bonus - 0.65) / 0.3 - 1e-9, (least - bonus - 0.3) / 0.65 - 1e-9
    if least_jaccard <= 0:
        raise ValueError("a least score of 0.75 or below allows names without a common word")
    s = src.where(F.size("tokens") > 0).select(F.col("norm").alias("s_norm"), F.col("core").alias("s_core"), F.col("tokens").alias("s_words")).dropDuplicates(["s_norm"])
    d = dst.select(F.col("norm").alias("d_norm"), F.col("variants").alias("d_variants"), F.col("cores").alias("d_cores")).dropDuplicates(["d_norm", "d_variants"])
    parts = d.select("*", F.explode("d_variants").alias("b"))
    sides = s.select(F.col("s_norm").alias("name"), F.col("s_words").alias("words")), parts.select(F.col("b").alias("name"), _words(F.col("b")).alias("words")).dropDuplicates(["name"])
    pairs = overlapping(*sides, least_jaccard).withColumnRenamed("a", "s_norm").join(parts, "b").drop("b").dropDuplicates(["s_norm", "d_norm", "d_variants"]).join(s, "s_norm")
    hits = F.size(F.array_intersect("s_words", F.flatten(F.transform("d_variants", _words))))
    near = lambda name: lambda v: 2 * F.least(F.char_length(name), F.char_length(v)) >= least_ratio * (F.char_length(name) + F.char_length(v))
    pairs = pairs.where(_enough(hits, F.size("s_words"), least_hits) & (F.exists("d_variants", near("s_norm")) | F.exists("d_cores", near("s_core"))))
    pairs = pairs.withColumn("best", best_ratio("s_norm", "s_core", "d_variants", "d_cores")).where(F.col("best.ratio") >= least_ratio)
    words = _words(F.when(F.col("best.place") >= 0, F.get("d_variants", F.col("best.place"))).otherwise(F.col("d_norm")))
    jaccard = F.coalesce(F.try_divide(F.size(F.array_intersect("s_words", words)), F.size(F.array_union("s_words", words))), F.lit(0.0))
    contained = (F.char_length("s_norm") >= 8) & F.exists("d_variants", lambda v: v.contains(F.col("s_norm")) | F.col("s_norm").contains(v))
    number = trailing_number(F.when(F.col("s_core") != "", F.col("s_core")).otherwise(F.col("s_norm")))
    numbers = F.filter(F.transform(F.concat("d_variants", "d_cores"), trailing_number), lambda n: n.isNotNull())
    other = number.isNotNull() & (F.size(numbers) > 0) & ~F.array_contains(numbers, F.coalesce(number, F.lit("")))
    score = F.lit(0.65) * F.col("best.ratio") + F.lit(0.3) * jaccard
    pairs = pairs.select("s_norm", "d_norm", "d_variants", score.alias("base"), F.when(contained, 0.05).otherwise(0.0).alias("inside"), F.when(other, number_penalty).otherwise(0.0).alias("penalty"))
    rows = _with_regions(pairs, src, dst)
    same = F.when(F.coalesce(F.col("s_region") == F.col("d_region"), F.lit(False)), 0.05).otherwise(0.0)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("base") + same + F.col("inside") - F.col("penalty")))
    return rows.withColumn("score", score).where(F.col("score") >= least).drop("base", "inside", "penalty")


def review(src: DataFrame, dst: DataFrame, low: float = 0.85, high: float = 0.91, k: int = 5) -> DataFrame:
    """For each source name the k best candidates whose scores lie in [low, high), with their places."""
    order = Window.partitionBy("s_norm", "s_region").orderBy(F.desc("score"), "d_norm", "d_region", "d_variants")
    return scored(src, dst, low).where(F.col("score") < high).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def matched(src: DataFrame, dst: DataFrame, accept: float = 0.91, variants: tuple[str, ...] = ()) -> DataFrame:
    """(id, target, kind, score) of the sources that match: by name and region, by normalised name, by core, by score.

    Columns of both: id, name, region; `variants`: columns of `dst` with other names of the same. Of several targets of one
    key the greatest id wins; the source's own region goes before any region.
    """
    s, d = named(src), saved(named(dst, variants=variants), "targets")
    steps = [("exact", ["name", "region"])]
    for kind in ("norm", "core"):
        steps += [(f"{kind}_region", [kind, "region"]), (kind, [kind])]
    # The targets of every step stand beside each row, and the first step that has one counts.
    rows = s
    for i, (_, keys) in enumerate(steps):
        targets = d.where(f"{keys[0]} <> ''").groupBy(*[F.col(k).alias(f"{k}{i}") for k in keys]).agg(F.max("id").alias(f"target{i}"))
        same = F.col(keys[0]) == F.col(f"{keys[0]}{i}")
        same = same & F.col("region").eqNullSafe(F.col(f"region{i}")) if len(keys) > 1 else same
        rows = rows.join(targets, same, "left").drop(*[f"{k}{i}" for k in keys])
    hit = [F.when(F.col(f"target{i}").isNotNull(), F.struct(F.col(f"target{i}").alias("target"), F.lit(kind).alias("kind"))) for i, (kind, _) in enumerate(steps)]
    rows = saved(rows.select(*s.columns, F.coalesce(*hit).alias("hit")), "names")
    out = rows.where("hit IS NOT NULL").select("id", "hit.target", "hit.kind", F.lit(1.0).alias("score"))
    rest = rows.where("hit IS NULL").drop("hit")
    best = scored(rest, d, accept)
    top = best.groupBy("s_norm", "s_region").agg(F.max_by(F.struct("d_norm", "d_variants", "d_region", "score"), F.struct("score", "d_norm", "d_variants")).alias("b"))
    ids = d.groupBy("norm", "variants", "region").agg(F.max("id").alias("target"))
    fuzzy = rest.alias("r").join(top.alias("t"), F.col("r.norm").eqNullSafe(F.col("t.s_norm")) & F.col("r.region").eqNullSafe(F.col("t.s_region")))
    fuzzy = fuzzy.join(ids.alias("i"), (F.col("t.b.d_norm") == F.col("i.norm")) & (F.col("t.b.d_variants") == F.col("i.variants")) & F.col("t.b.d_region").eqNullSafe(F.col("i.region")))
    return out.unionByName(fuzzy.select(F.col("r.id").alias("id"), F.col("i.target").alias("target"), F.lit("fuzzy").alias("kind"), F.col("t.b.score").alias("score")))


def containing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(parent, a, b): distinct names of two tables (`parent`, `name`) of one parent of which one contains the other."""
    a, b = (d.select("parent", "name") for d in (left, right))
    above = occurring(a.withColumnRenamed("name", "text"), b.withColumnRenamed("name", "pattern"), ["parent"]).select("parent", F.col("text").alias("a"), F.col("pattern").alias("b"))
    below = occurring(b.withColumnRenamed("name", "text"), a.withColumnRenamed("name", "pattern"), ["parent"]).select("parent", F.col("pattern").alias("a"), F.col("text").alias("b"))
    return above.union(below).distinct()


def respelt(name: Column, spellings: dict[str, str]) -> Column:
    for old, new in spellings.items():
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def places(src: DataFrame, dim: DataFrame, accept: float = 0.8, length: int = 3, spellings: dict[str, str] | None = None, within: str | None = None) -> DataFrame:
    """(id, target, score): the best place for each name. Columns of both: id, parent, name.

    Under the same parent: 1.0 for the same name, 0.95 for the name with `spellings` changed, 0.9 where one contains the
    other and the source's has more than `length` characters. Under other parents: 0.95 for the same name, 0.9 for the
    changed one; with `within`, a column of both, only where that is equal. Scores below `accept`, which must be above 0.7,
    count for nothing; of equal ones the least id wins.
    """
    if accept <= 0.7:
        raise ValueError("containment under other parents is not looked for")
    keys = ["name", *([within] if within else [])]
    names = src.select("parent", *keys).distinct()
    targets = dim.groupBy("parent", *keys).agg(F.min("id").alias("target")).withColumnRenamed("parent", "d_parent")
    own = F.col("parent").eqNullSafe(F.col("d_parent"))
    near = names.join(targets, keys).withColumn("score", F.when(own, 1.0).otherwise(0.95))
    if spellings:
        changed = names.withColumn("old", F.col("name")).withColumn("name", respelt(F.col("name"), spellings)).where("name <> old")
        changed = changed.join(targets, keys).withColumn("score", F.when(own, 0.95).otherwise(0.9))
        near = near.unionByName(changed.withColumn("name", F.col("old")).drop("old"))
    inside = containing(names.where(F.char_length("name") > length), dim).where("a <> b")
    inside = inside.join(dim.groupBy("parent", F.col("name").alias("b")).agg(F.min("id").alias("target")), ["parent", "b"])
    inside = names.join(inside.withColumnRenamed("a", "name"), ["parent", "name"]).withColumn("score", F.lit(0.9))
    cols = ["parent", *keys, "target", "score"]
    best = near.select(cols).unionByName(inside.select(cols)).where(F.col("score") >= accept)
    best = best.groupBy("parent", *keys).agg(F.max_by(F.struct("target", "score"), F.struct("score", -F.col("target"))).alias("b"))
    rows = src.alias("s").join(best.alias("t"), F.col("s.parent").eqNullSafe(F.col("t.parent")) & F.expr(" AND ".join(f"s.{k} = t.{k}" for k in keys)))
    return rows.select(F.col("s.id").alias("id"), F.col("t.b.target").alias("target"), F.col("t.b.score").alias("score"))


def region_of_address(addresses: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, region): the last part of the address that is an alias of a region, with or without the kind of place before
    it; else the longest alias that the address contains, of any length and inside words too, the last in order at a
    tie. Columns: id, address; alias, region; aliases are one row each."""
    parts = addresses.select("id", F.posexplode(F.split("address", ",")).alias("at", "part")).withColumn("part", project_name(F.col("part"))).where("part NOT IN ('', 'viet nam')")
    bare = F.trim(F.regexp_replace("part", r"^(thanh pho|tp|tinh)\b\s*", ""))
    hit = aliases.select("alias", "region")
    full = parts.join(hit.withColumnsRenamed({"alias": "part", "region": "full"}), "part", "left").withColumn("bare", bare)
    found = full.join(hit.withColumnsRenamed({"alias": "bare", "region": "cut"}), "bare", "left").withColumn("region", F.coalesce("full", "cut")).where("region IS NOT NULL")
    last = found.groupBy("id").agg(F.max_by("region", "at").alias("region"))
    rest = addresses.join(last.select("id"), "id", "left_anti").select("id", project_name(F.col("address")).alias("whole"))
    met = occurring(rest.select(F.col("whole").alias("text")), hit.select(F.col("alias").alias("pattern")))
    loose = rest.join(met.withColumnsRenamed({"text": "whole", "pattern": "alias"}), "whole").join(hit, "alias")
    longest = loose.groupBy("id").agg(F.max_by("region", F.struct(F.char_length("alias"), "alias")).alias("region"))
    return last.unionByName(longest)


def _best(pairs: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, target, score) of the names a of the pairs: the best of the names b, the least target at a tie."""
    rows = pairs.join(targets.withColumnRenamed("name", "b"), [*keys, "b"])
    best = rows.groupBy(*keys, F.col("a").alias("name")).agg(F.max_by(F.struct("target", "score"), F.struct("score", -F.col("target"))).alias("b"))
    return best.select(*keys, "name", "b.target", "b.score")


def proposals(src: DataFrame, dim: DataFrame, least: float = 0.88, length: int = 5) -> DataFrame:
    """For names that are spelt otherwise: of the same parent's names of about the same length the most similar one, if
    its ratio is above `least`. Columns of both: id, parent, name."""
    targets = dim.groupBy("parent", "name").agg(F.min("id").alias("target"))
    pairs = similar(src, dim, ["parent"], least).where((F.abs(F.char_length("a") - F.char_length("b")) <= length) & (F.col("score") > least))
    return src.join(_best(pairs, targets, ["parent"]), ["parent", "name"]).select("id", "target", "score")


def districts_of(src: DataFrame, dim: DataFrame, least: float = 0.6, first: float = 0.85) -> DataFrame:
    """(parent, name, target, score): for each name the district of its province (`parent`) that is meant: one that is equal
    without blanks, with a score of 1; else the one of the best ratio, if that is `least` or more. Of several the
    least id wins. Columns: parent, name; id, parent, name. Names that have one of ratio `first` or more are done with
    first, so that only few are compared under the weaker bound."""
    tight = F.replace("name", F.lit(" "), F.lit(""))
    targets = dim.groupBy("parent", "name").agg(F.min("id").alias("target"))
    rest = src.where("name <> ''").select("parent", "name").distinct()
    equal = targets.groupBy("parent", tight.alias("tight")).agg(F.min("target").alias("target"))
    out = rest.withColumn("tight", tight).join(equal, ["parent", "tight"]).select("parent", "name", "target", F.lit(1.0).alias("score"))
    for bound in sorted({least, max(least, first)}, reverse=True):
        rest = rest.join(out, ["parent", "name"], "left_anti")
        out = saved(out.unionByName(_best(similar(rest, targets, ["parent"], bound), targets, ["parent"])), "districts")
    return out


def proposals_of_wards(src: DataFrame, dim: DataFrame, least: float = 0.88, district: float = 0.6, length: int = 5) -> DataFrame:
    """(id, target, score): for wards that are spelt otherwise, first the district that is meant (`districts_of`), then of its
    wards the one of the best ratio, the least id at a tie. It is proposed if the ratio is above `least` and the lengths
    differ by `length` at most. Columns: id, parent, district, name; id, parent, district_id, district, name."""
    tree = dim.select(F.col("district_id").alias("id"), "parent", F.col("district").alias("name"))
    meant = districts_of(src.select("parent", F.col("district").alias("name")), tree, district).select("parent", F.col("name").alias("district"), F.col("target").alias("district_id"))
    rows = saved(src.join(meant, ["parent", "district"]), "wards")
    targets = dim.groupBy("district_id", "name").agg(F.min("id").alias("target"))
    # As the length counts after the pick, a longer name of a better ratio leaves the ward without a proposal.
    best = _best(similar(rows, dim, ["district_id"], least).where(F.col("score") > least), targets, ["district_id"])
    sizes = targets.select("district_id", "target", F.char_length("name").alias("size"))
    best = best.join(sizes, ["district_id", "target"]).where(F.abs(F.char_length("name") - F.col("size")) <= length)
    return rows.join(best.drop("size"), ["district_id", "name"]).select("id", "target", "score")


def contained(src: DataFrame, dim: DataFrame, least: int = 4) -> DataFrame:
    """Pairs under the same parent of which one name, of at least `least` characters, contains the other."""
    long = lambda d: d.where(F.char_length("name") >= least)
    pairs = containing(long(src), long(dim))
    rows = src.select("parent", F.col("name").alias("a"), "id").join(pairs, ["parent", "a"])
    return rows.join(dim.select("parent", F.col("name").alias("b"), F.col("id").alias("target")), ["parent", "b"]).select("id", "target")


def with_aliases(src: DataFrame, dim: DataFrame, aliases: DataFrame, newer: DataFrame) -> DataFrame:
    """`target` of each name: the dimension's of the same name under the same parent, else that of its alias there, else
    that of the same name anywhere; then the newer id that replaced it. Columns: id, parent, name; name, alias; old, new."""
    local = dim.groupBy("parent", "name").agg(F.min("id").alias("local"))
    other = dim.groupBy("parent", F.col("name").alias("alias")).agg(F.min("id").alias("by_alias"))
    anywhere = dim.groupBy("name").agg(F.min("id").alias("anywhere"))
    rows = src.join(local, ["parent", "name"], "left").join(aliases, "name", "left").join(other, ["parent", "alias"], "left").join(anywhere, "name", "left")
    rows = rows.withColumn("old", F.coalesce("local", "by_alias", "anywhere")).join(newer, "old", "left")
    return rows.select("id", F.coalesce("new", "old").alias("target"))


def neighbours_mapped(edges: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) of a neighbour graph by the ids that they map to, and the ids that map to none. Columns: id, target."""
    to = lambda name: mapping.select(F.col("id").alias(name), F.col("target").alias(f"{name}_target"))
    mapped = edges.join(to("a"), "a").join(to("b"), "b").select(F.col("a_target").alias("a"), F.col("b_target").alias("b")).where("a <> b").distinct()
    ids = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    return mapped, ids.join(mapping, "id", "left_anti")
