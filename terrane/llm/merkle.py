"""A Merkle manifest of a table: a leaf a row, a tree a group, a tree over the groups, and an inclusion proof for every row.

The leaf of a row is the digest of its fields. Leaves of a group stand in order; while there are several nodes, each two in
a row become their digest, and a last one without a partner the digest of itself. The subroots, in the order of groups,
make the root in the same way.

Ranks come from a range partitioning: a partition's rows are counted, and the counts before it are added. The low bits of a
rank are its digit columns. Blocks of 2^BITS leaves are shuffled once; there the digits are grouped away one after another,
each grouping nesting two child structs in one, so a block ends as one row with its whole subtree, in
the same tasks. The roots of the blocks are the leaves of the next round, until a group is one row. On the way back a block's
row meets the steps above it in one more grouping, transforms walk down its nested structs and collect the steps, and explode
emits its rows: no row is joined with its siblings or its path.

Results: every row has a leaf, nulls in any column included. A null group is a group, the first one; a null order value comes
first; rows of equal order stand in the order of their leaves, so equal rows are neighbours. A table of one row has an empty
proof, and its leaf is the root. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.storage import saved

#: Digits of a block: it holds 2^BITS nodes at most.
BITS = 7
STEPS = "array<struct<left:string,right:string>>"


def digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another: a minus for a null, else the byte count, a colon and the value."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def _ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with `rank`, from 0 in each group, and `n`, the rows of the group."""
    # Equal rows are told apart by where they were read, so that no range is without bound.
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "salt")]
    placed = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("salt")
    placed = saved(placed.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ranked")
    # One row a group and partition.
    counts = placed.groupBy(group, "part").agg(F.count("*").alias("rows"), F.min("at").alias("from"))
    before = F.sum("rows").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col(group).alias("of"), F.col("part").alias("in"), (F.coalesce(before, F.lit(0)) - F.col("from")).alias("shift"), F.sum("rows").over(Window.partitionBy(group)).alias("n"))
    joined = placed.join(counts, F.col(group).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return joined.withColumn("rank", F.col("at") + F.col("shift")).drop("of", "in", "shift", "at", "part")


def _rolled(nodes: DataFrame, bits: int) -> DataFrame:
    """(g, n, block, node) of nodes (g, n, rank, hash, item): one row a block, its tree nested in `node`."""
    digits = [F.shiftright("rank", i).bitwiseAND(1).alias(f"d{i}") for i in range(bits)]
    tree = nodes.select("g", "n", F.shiftright("rank", bits).alias("block"), *digits, F.struct("hash", "item").alias("node")).repartition("g", "block")
    for i in range(bits):
        keys = ["g", "n", "block", *[f"d{j}" for j in range(bits - 1, i, -1)]]
        child = [F.first(F.when(F.col(f"d{i}") == d, F.col("node")), ignorenulls=True) for d in (0, 1)]
        tree = tree.groupBy(*keys).agg(F.array_compact(F.array(*child)).alias("kids"))
        # A group that is one node by now keeps it.
        both = F.sha2(F.array_join(F.transform("kids", lambda x: x["hash"]), ""), 256)
        whole = F.when(F.col("n") > 1 << i, both).otherwise(F.element_at("kids", 1)["hash"])
        tree = tree.select(*keys, F.struct(whole.alias("hash"), "kids").alias("node"))
    return tree


def _below(i: int):
    """The children of a node of digit i, each with the steps from it up."""

    def down(x: Column) -> Column:
        kids = x["node"]["kids"]
        other = lambda at, here: F.when((F.size(kids) == 2) & here, kids[at]["hash"]).otherwise("")
        step = lambda at: F.struct(other(0, at == 1).alias("left"), other(1, at == 0).alias("right"))
        own = lambda at: F.when(F.col("n") > 1 << i, F.concat(F.array(step(at)), x["steps"])).otherwise(x["steps"])
        return F.transform(kids, lambda kid, at: F.struct(kid.alias("node"), own(at).alias("steps")))

    return down


def _unrolled(blocks: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """(g, item, hash, steps, subroot, root) of every leaf of the blocks; `above` has the last three by (g, block)."""
    up = above.select("g", "block", F.lit(None).cast("long").alias("n"), F.lit(None).cast(blocks.schema["node"].dataType).alias("node"), F.struct("steps", "subroot", "root").alias("up"))
    both = blocks.select("g", "block", "n", "node", F.lit(None).cast(up.schema["up"].dataType).alias("up")).unionByName(up)
    rows = both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "up")])
    rows = rows.withColumn("open", F.array(F.struct(F.col("node").alias("node"), F.col("up.steps").alias("steps"))))
    for i in reversed(range(bits)):
        rows = rows.withColumn("open", F.flatten(F.transform("open", _below(i))))
    rows = rows.select("g", "up", F.explode("open").alias("leaf"))
    return rows.select("g", "leaf.node.item", "leaf.node.hash", "leaf.steps", "up.subroot", "up.root")


def _tree(nodes: DataFrame, most: int, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks over nodes (g, n, rank, hash, item), of which no group has over `most`; and the last nodes."""
    rounds = []
    for _ in range(max(1, math.ceil(math.log2(max(1, most)) / bits))):
        blocks = saved(_rolled(nodes, bits), "blocks")
        rounds.append(blocks)
        nodes = blocks.select("g", F.ceil(F.col("n") / (1 << bits)).alias("n"), F.col("block").alias("rank"), F.col("node.hash").alias("hash"), F.struct("block").alias("item"))
    return rounds, nodes


def _walked(rounds: list[DataFrame], above: DataFrame, bits: int) -> DataFrame:
    for blocks in reversed(rounds[1:]):
        above = _unrolled(blocks, above, bits).select("g", "item.block", "steps", "subroot", "root")
    return _unrolled(rounds[0], above, bits)


def manifest(df: DataFrame, fields: Sequence[str], group: str, order: str, claimed: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """(order, group, leaf, subroot, root, steps, folded_root, verified) of every row of `df`.

    `steps`: from the leaf up, what stands left and right of the node in its run, blank if nothing does. `folded_root` is
    what the steps make of the leaf of the row as it is claimed to be (`claimed`: other values of fields), and `verified` says whether
    that is the root."""
    said = {**{f: F.col(f) for f in fields}, **(claimed or {})}
    rows = df.select(F.col(group).alias("g"), F.col(order).alias("id"), digest([F.col(f) for f in fields]).alias("hash"), digest([said[f] for f in fields]).alias("claim"))
    rows = rows.withColumn("claim", F.when(F.col("claim") != F.col("hash"), F.col("claim")))
    leaves = _ranked(rows, "g", ["id", "hash"])
    nodes = leaves.select("g", "n", "rank", "hash", F.struct("id", "claim").alias("item"))
    rounds, last = _tree(nodes, nodes.agg(F.max("n")).first()[0] or 0, bits)

    # The groups as leaves of one more tree.
    tops = _ranked(last.select(F.lit(0).alias("g"), F.col("g").alias("of"), "hash").withColumnRenamed("of", "name"), "g", ["name", "hash"])
    tops = tops.select("g", "n", "rank", "hash", F.struct("name").alias("item"))
    upper, root = _tree(tops, tops.agg(F.max("n")).first()[0] or 0, bits)
    above = root.select("g", F.lit(0).cast("long").alias("block"), F.array().cast(STEPS).alias("steps"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
    above = _walked(upper, above, bits).select(F.col("item.name").alias("g"), F.lit(0).cast("long").alias("block"), "steps", F.col("hash").alias("subroot"), "root")
    out = _walked(rounds, above, bits)
    folded = F.aggregate("steps", F.coalesce("item.claim", "hash"), lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    out = out.withColumn("folded_root", folded)
    return out.select(F.col("item.id").alias(order), F.col("g").alias(group), F.col("hash").alias("leaf"), "subroot", "root", "steps", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def proof_text(steps: str = "steps") -> Column:
    """The siblings of all steps, from the leaf up, each from left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def _leaf_sql(n_chars: str) -> str:
    part = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"
    return f"sha256({' || '.join(part(x) for x in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


#: The query's result in DuckDB's SQL: the trees level by level, and the checksum of an id bit by bit.
ORACLE_SQL = f"""WITH RECURSIVE ids AS (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents),
sums AS (SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))) AS crc FROM ids),
leaf AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN crc % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS claim FROM sums)),
up AS (SELECT lang, 0 AS level, pos, n, leaf AS h FROM leaf
  UNION ALL SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY lang, level, pos // 2, n),
sub AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, pos, n, subroot AS h FROM sub
  UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT leaf.lang, leaf.pos, u.level, CASE WHEN s.pos < u.pos THEN s.h ELSE '' END AS l, CASE WHEN s.pos > u.pos THEN s.h ELSE '' END AS r
  FROM leaf JOIN up u ON u.lang IS NOT DISTINCT FROM leaf.lang AND u.n > 1 AND u.pos = leaf.pos // CAST(2 ** u.level AS BIGINT)
    LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM u.lang AND s.level = u.level AND s.pos = xor(u.pos, 1)
  UNION ALL
  SELECT leaf.lang, leaf.pos, 100 + u.level, CASE WHEN s.pos < u.pos THEN s.h ELSE '' END, CASE WHEN s.pos > u.pos THEN s.h ELSE '' END
  FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang JOIN top u ON u.n > 1 AND u.pos = sub.pos // CAST(2 ** u.level AS BIGINT)
    LEFT JOIN top s ON s.level = u.level AND s.pos = xor(u.pos, 1)),
paths AS (SELECT lang, pos, list(l || '|' || r ORDER BY level) AS path FROM steps GROUP BY lang, pos),
folded AS (SELECT leaf.*, sub.subroot, top.h AS root, coalesce(path, []) AS path,
    list_reduce(list_prepend(claim, coalesce(path, [])), lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2))) AS folded_root
  FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang JOIN top ON top.n = 1
    LEFT JOIN paths ON paths.lang IS NOT DISTINCT FROM leaf.lang AND paths.pos = leaf.pos)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"""
