"""Rows filled or changed from other tables, as joins: places found in stages, times, geography, histories, staged rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.operators.resolve import containing
from terrane.operators.state import ancestors, first_rows, insert_ignore, one_row_a_key
from terrane.sources.stored import saved


def in_parent(src: DataFrame, dim: DataFrame, length: int = 3, aliases: DataFrame | None = None) -> DataFrame:
    """(parent, name, target, stage): for each name the best place under the same parent. Stage 1 is the same name; 2 a
    name that contains this one or is contained in it, for names of at least `length` characters, so that a numeric
    district is found by its whole number only; 3 a name that contains the alias of this one. Of equal stages the least id
    wins. Columns: parent, name; id, parent, name; name, alias."""
    names = saved(src.select("parent", "name").distinct(), "names")
    own = dim.groupBy("parent", "name").agg(F.min("id").alias("target"))
    found = names.join(own, ["parent", "name"]).withColumn("stage", F.lit(1))
    inside = containing(names.where(F.char_length("name") >= length), dim).where("a <> b")
    found = found.unionByName(inside.join(own.withColumnRenamed("name", "b"), ["parent", "b"]).select("parent", F.col("a").alias("name"), "target", F.lit(2).alias("stage")))
    if aliases is not None:
        meant = names.join(aliases, "name").select("parent", "name", "alias")
        above = containing(meant.select("parent", F.col("alias").alias("name")), dim).where(F.contains("b", "a"))
        above = meant.join(above.withColumnRenamed("a", "alias"), ["parent", "alias"]).join(own.withColumnRenamed("name", "b"), ["parent", "b"])
        found = found.unionByName(above.select("parent", "name", "target", F.lit(3).alias("stage")))
    best = found.groupBy("parent", "name").agg(F.min(F.struct("stage", "target")).alias("b"))
    return saved(best.select("parent", "name", "b.target", "b.stage"), "places")


def wards_resolved(src: DataFrame, dim: DataFrame, split: DataFrame, merged: DataFrame) -> DataFrame:
    """(id, old, new, new_name, top): where a ward of another source is in the own tree of places.

    The district is found in its region (`in_parent`), beside the places that it was `split` into; then the ward in these
    districts, the least id of a district first; else by the old name of a merged place under one of them. `new` is the
    place that the found one was merged into, or itself, and `top` the root above its parent, null without one.
    Columns: id, region, district, ward; id, parent, name; region, district, target; old, old_name, new, new_parent.
    """
    districts = src.select(F.col("region").alias("parent"), F.col("district").alias("name"))
    targets = in_parent(districts, dim).select(F.col("parent").alias("region"), F.col("name").alias("district"), "target")
    targets = targets.unionByName(split.select("region", "district", "target")).distinct()
    wards = saved(src.select("region", "district", "ward").distinct().join(targets, ["region", "district"]), "wards")
    asked = wards.select(F.col("target").alias("parent"), F.col("ward").alias("name"))
    direct = in_parent(asked, dim).select(F.col("parent").alias("target"), F.col("name").alias("ward"), F.col("target").alias("old"), F.lit(0).alias("way"))
    renamed = merged.groupBy(F.col("new_parent").alias("target"), F.col("old_name").alias("ward")).agg(F.min("new").alias("old")).withColumn("way", F.lit(1))
    hits = wards.join(direct.unionByName(renamed), ["target", "ward"])
    old = hits.groupBy("region", "district", "ward").agg(F.min(F.struct("way", "target", "old")).alias("b")).select("region", "district", "ward", "b.old")

    # A merge into a place that is not in the tree counts for nothing.
    known = merged.select("old", "new", "new_parent").join(dim.select(F.col("id").alias("new")), "new", "left_semi")
    newer = one_row_a_key(known, "old", [F.col("new"), F.col("new_parent")])
    here = dim.select(F.col("id").alias("new"), F.col("name").alias("new_name"), "parent")
    rows = src.join(old, ["region", "district", "ward"]).join(newer, "old", "left").withColumn("new", F.coalesce("new", "old")).join(here, "new")
    above = ancestors(dim, "id", "parent").select(F.col("id").alias("above"), F.col("root").alias("top"))
    rows = rows.withColumn("above", F.coalesce("new_parent", "parent"))
    return rows.join(above, "above", "left").select("id", "old", "new", "new_name", "top")


def looked_up(target: DataFrame, column: str, sources: list[tuple[Column, Column, DataFrame]]) -> DataFrame:
    """`target` with `column`, where null, taken from the first source whose condition holds and that has the row's key.
    A source is a condition and a key over the target, and a table (key, value); of repeated keys the greatest value."""
    out = target
    for i, (when, key, source) in enumerate(sources):
        one = source.where("key IS NOT NULL").groupBy(F.col("key").alias(f"__key{i}")).agg(F.max("value").alias(f"__value{i}"))
        out = out.join(one, when & F.col(column).isNull() & (key == F.col(f"__key{i}")), "left")
    filled = F.coalesce(column, *[f"__value{i}" for i in range(len(sources))])
    return out.select(*[filled.alias(c) if c == column else F.col(c) for c in target.columns])


def geography_filled(df: DataFrame, wards: DataFrame, merged: DataFrame, dim: DataFrame) -> DataFrame:
    """The old id of the ward where there is none, then the new id, name and parent where these are missing or stale.
    Columns: ward, old_id, new_id, new_name, new_parent; ward, old_id; old, new, name; id, parent."""
    rows = looked_up(df, "old_id", [(F.lit(True), F.col("ward"), wards.select(F.col("ward").alias("key"), F.col("old_id").alias("value")))])
    to = merged.join(dim.select(F.col("id").alias("new"), F.col("parent").alias("__parent")), "new")
    to = one_row_a_key(to, "old", [F.col("new"), F.col("name")]).select(F.col("old").alias("__old"), F.col("new").alias("__new"), F.col("name").alias("__name"), "__parent")
    rows = rows.join(to, F.col("old_id") == F.col("__old"), "left")
    stale = F.col("__old").isNotNull() & (F.col("new_id").isNull() | (F.col("new_id") != F.col("__new")))
    take = {"new_id": "__new", "new_name": "__name", "new_parent": "__parent"}
    return rows.select(*[F.when(stale, F.col(take[c])).otherwise(F.col(c)).alias(c) if c in take else F.col(c) for c in df.columns])


def history_appended(df: DataFrame, history: str = "history", status: str = "status") -> DataFrame:
    """Links with their `origin` (`state.reposts`): a repost's status becomes POSTAGAIN, and its id goes to the end of the
    origin's history, a text of ids, unless it is in it. A changed history keeps its whole numbers, each once; others stay
    as they are. Columns: id, origin, the history and the status."""
    again = df.where(F.col("id") != F.col("origin")).groupBy(F.col("origin").alias("__origin"))
    again = again.agg(F.transform(F.array_sort(F.collect_set("id")), lambda i: i.cast("string")).alias("__again"))
    known = F.filter(F.transform(F.split(F.coalesce(history, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x.rlike("^[0-9]+$"))
    rows = df.join(again, F.col("id") == F.col("__origin"), "left").withColumn("__added", F.array_except("__again", known))
    changed = F.when(F.size("__added") > 0, F.array_join(F.array_distinct(F.concat(known, F.col("__added"))), ",")).otherwise(F.col(history))
    marked = F.when(F.col("id") != F.col("origin"), "POSTAGAIN").otherwise(F.col(status))
    return rows.select(*[changed.alias(c) if c == history else marked.alias(c) if c == status else F.col(c) for c in df.columns])


def children_absent(parents: DataFrame, children: DataFrame, key: str, texts: Column) -> DataFrame:
    """(key, text, idx): the texts of each parent that `children` (key, text) lacks, with their place among those that are
    not blank; of a repeated text the first."""
    kept = F.transform(F.filter(texts, lambda x: F.trim(x) != ""), lambda x: F.trim(x))
    new = parents.where(F.col(key).isNotNull()).select(key, F.posexplode(kept).alias("idx", "text")).select(key, "text", "idx")
    return insert_ignore(children, new, [key, "text"], [F.col("idx")])


def staged(target: DataFrame, stage: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """`target` after a merge of staged rows: of each key the first staged row in order replaces the target's or is added.
    A key with a null is equal to none, as in a unique index: such rows are all added, and none is replaced."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    new = first_rows(stage.where(whole), keys, order)
    return target.join(new, keys, "left_anti").select(target.columns).unionByName(new).unionByName(stage.where(~whole))


def staged_counts(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """One row, what `staged` would do without doing it: `inserted`, `updated`, and `repeated` rows that are left out."""
    known = target.select(*keys).distinct().withColumn("__known", F.lit(1))
    sizes = stage.groupBy(*keys).agg(F.count("*").alias("__n")).join(known, keys, "left")
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    inserted = F.when(~whole, F.col("__n")).when(F.col("__known").isNull(), 1).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return sizes.agg(
        total(inserted).alias("inserted"), total(F.when(whole & F.col("__known").isNotNull(), 1).otherwise(0)).alias("updated"),
        total(F.when(whole, F.col("__n") - 1).otherwise(0)).alias("repeated"))
