"""Writes as functions of tables: inserts, upserts, queues and links between rows, without mutation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.sources.stored import saved


def _same(left: str, right: str, keys: list[str]) -> Column:
    """Null keys are equal to each other, which keeps repeated runs from adding rows."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def first_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in order. Spark limits each task's rows of a key before the shuffle."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows of `new` that an insert that ignores known keys would add: of each new key the first in order."""
    return first_rows(new, keys, order).alias("n").join(old.select(*keys).distinct().alias("o"), _same("n", "o", keys), "left_anti")


def upsert_last(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Both tables, of each key the row with the greatest version; at a tie the new row."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return first_rows(both, keys, [F.desc(version), F.desc("__new")]).drop("__new")


def upsert_by(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """Full outer join of tables with one row a key; `rules`: SQL for each other column over aliases o and n."""
    joined = old.withColumn("__o", F.lit(True)).alias("o").join(new.withColumn("__n", F.lit(True)).alias("n"), _same("o", "n", keys), "full_outer")
    first = [F.when(F.col("n.__n"), F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in keys]
    return joined.select(*first, *[F.expr(sql).alias(c) for c, sql in rules.items()])


def keep_existing(column: str) -> str:
    return f"coalesce(o.{column}, n.{column})"


def improve_only(column: str) -> str:
    """The new value only where the old one is null, blank or '0' and the new one is neither null nor blank."""
    return f"CASE WHEN (o.{column} IS NULL OR trim(o.{column}) IN ('', '0')) AND trim(n.{column}) <> '' THEN n.{column} ELSE o.{column} END"


def filled_where(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], stale: Column) -> DataFrame:
    """`target` with the columns taken from `source` in the rows where `stale` (over alias t) holds and a source row is."""
    one = first_rows(source, keys, [F.col(c) for c in columns]).withColumn("__hit", F.lit(True))
    joined = target.alias("t").join(one.alias("s"), _same("t", "s", keys), "left")
    take = F.coalesce(stale & F.col("s.__hit"), F.lit(False))
    return joined.select(*[F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in columns else F.col(f"t.{c}") for c in target.columns])


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """The rows where the predicate is true, and all others, nulls among these."""
    true = F.coalesce(predicate, F.lit(False))
    return df.where(true), df.where(~true)


def gate(steps: list[Column]) -> Column:
    """How many steps in a row succeeded: 0 if the first failed, len(steps) if none did. A null is a failure."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(i)) for i, ok in enumerate(steps)]
    return F.coalesce(*failed, F.lit(len(steps)))


def signed_gate(steps: list[Column]) -> Column:
    """As `gate`, but a failure is the negative number of the step that failed, counted from 1."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(-i)) for i, ok in enumerate(steps, 1)]
    return F.coalesce(*failed, F.lit(len(steps)))


def claimed(queue: DataFrame, limit: int, now: Column, stale_minutes: int = 30) -> DataFrame:
    """What a worker would take next: pending rows and those in progress since over `stale_minutes`, newest id first."""
    stale = (F.col("status") == "IN_PROGRESS") & (F.col("since") < now - F.expr(f"INTERVAL {stale_minutes} MINUTES"))
    return queue.where((F.col("status") == "PENDING") | stale).orderBy(F.desc("id")).limit(limit)


def reposts(df: DataFrame, first_key: str, second_key: str, order: list[str], id_column: str = "id") -> DataFrame:
    """`origin`: the earliest row with the same first or second key (one step, not a chain); null keys link nothing. The
    earliest row of each key is found by a minimum, and only rows with a key are joined with it."""
    rows, found = df, []
    for i, key in enumerate((first_key, second_key)):
        fields = F.struct(*[F.col(c) for c in dict.fromkeys([*order, id_column])])
        own = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"__key{i}"))
        best = own.agg(F.min(fields).alias(f"__best{i}"), (F.count("*") * 0).alias(f"__none{i}"))
        # A second key, 0 for all that can match, deals the rows without a key out to all tasks.
        spread = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c) for c in dict.fromkeys([*order, id_column])])).otherwise(0)
        same = (F.col(key) == F.col(f"__key{i}")) & (F.col("__spread") == F.col(f"__none{i}"))
        rows = rows.withColumn("__spread", spread).join(best, same, "left").drop("__spread", f"__none{i}", f"__key{i}")
        found.append(F.col(f"__best{i}"))
    return rows.withColumn("origin", F.coalesce(F.least(*found)[id_column], F.col(id_column))).drop("__best0", "__best1")


def ready_parents(parents: DataFrame, children: DataFrame, key: str, done: Column) -> DataFrame:
    """Parents that have a child and none unfinished."""
    counts = children.groupBy(key).agg(F.count("*").alias("n"), F.count_if(~F.coalesce(done, F.lit(False))).alias("open"))
    return parents.join(counts.where("n > 0 AND open = 0"), key, "left_semi")


def unique_pairs(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join of the rows whose key is unique on its own side."""
    alone = lambda d: d.withColumn("__n", F.count("*").over(Window.partitionBy(on))).where("__n = 1").drop("__n")
    return alone(left).join(alone(right), on)


def one_row_a_key(dim: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """A dimension without fan-out."""
    return first_rows(dim.where(F.col(key).isNotNull()), [key], order)


def ancestors(tree: DataFrame, node: str, parent: str) -> DataFrame:
    """`root` of each node of a tree of any depth. A node whose parent is null, absent or itself is a root; one whose walk runs
    into a circle has a null root. Of repeated nodes the least parent counts; null nodes are left out.

    Pointers double: each step, a node takes the root of the node that it points at, if that is known, else its pointer. Finished
    nodes take no further part, so a root of very many nodes is met once by each; a chain of n nodes takes log2(n) steps."""
    one = tree.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("at")).agg(F.min(parent).alias("above"))
    known = one.select(F.col("at").alias("above"))
    rest = saved(one.where("at <> above").join(known, "above", "left_semi").select("at", "above"), "pointers")
    done = saved(one.join(rest, "at", "left_anti").select("at", F.col("at").alias("root")), "roots")
    before = None
    while (left := rest.count()) and left != before:
        before = left
        found = saved(rest.join(done.select(F.col("at").alias("above"), "root"), "above", "left"), "pointers")
        done = done.unionByName(found.where("root IS NOT NULL").select("at", "root"))
        on = found.where("root IS NULL").select("at", "above")
        rest = saved(on.join(rest.select(F.col("at").alias("above"), F.col("above").alias("next")), "above").select("at", F.col("next").alias("above")), "pointers")
    return done.unionByName(rest.select("at", F.lit(None).cast(done.schema["root"].dataType).alias("root"))).withColumnRenamed("at", node)
