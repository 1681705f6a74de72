"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame functions only.

Words are handed out in blocks of equal size. Each source's target follows its weight, and stops at `most` times the
source's words; the excess goes to the others by weight. The blocks of the mix go to sources by the highest quotients
target / (2k - 1), which gives every source an integer quota; the same rule splits a source's quota over its shards.
A source is cut into shards of about `SHARD_WORDS` words by a seeded hash of doc_id, so no source, however hot, is
ordered in one piece. In a shard, documents stand in seeded order and are cut to blocks; a quota of q out of m blocks
takes every block q div m times, and q mod m of them once more: a systematic sample with a seeded start.

Quotas need no list of all quotients. With S parties, weights t and H seats, a party's seats lie between
t(H - S/2)/T - 1/2 and t(H + S/2)/T + 1/2: the seats below are sure, and only the few quotients between are ranked.

Results: a null or blank text has size 0 and nothing is taken of it; null is a source like any other and stands last.
No document gives more than `most` times its words. Rows equal in doc_id and size may change places, nothing else can.
An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.arrow import shielding
from terrane.llm.storage import saved

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARD_WORDS = 1 << 20
#: A block has this many words at most, and so few that the mix of a small table has `LEAST_BLOCKS` blocks.
BLOCK_WORDS, LEAST_BLOCKS = 1024, 40_000
#: Fractions of a document are counted in this many parts.
PARTS = 1 << 20


def _hash(*parts: Column | str) -> Column:
    """The first 32 bits of an MD5, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, source: str, share: float, most: int, weights: tuple[int, ...]) -> DataFrame:
    """One row a source (`__size` words) with `__index` in code point order, null last, and `__target`."""
    order = Window.orderBy(F.col(source).asc_nulls_last())
    place = F.row_number().over(order)
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumns({"__index": place, "__weight": cycle.cast("long")})
    # Sources reach their limits in the order of limit / weight. The level to which the others are filled is the
    # highest of the levels that result when the first j of that order are at their limits.
    all_of = Window.partitionBy()
    before = Window.orderBy((F.col("__size") * most / F.col("__weight")).asc(), "__index").rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum(F.col("__size") * most).over(before), F.lit(0))
    gone = F.coalesce(F.sum("__weight").over(before), F.lit(0))
    rows = rows.withColumn("__level", (F.sum("__size").over(all_of) * share - spent) / (F.sum("__weight").over(all_of) - gone))
    filled = F.max("__level").over(all_of) * F.col("__weight")
    return rows.withColumn("__target", F.least((F.col("__size") * most).cast("double"), filled)).drop("__level", "__weight")


def apportion(parties: DataFrame, groups: list[str], weight: str, seats: str, limit: str, tie: str) -> DataFrame:
    """`__seats` of each party: Sainte-Laguë within each group, whose number of seats stands in each row."""
    group = Window.partitionBy(*groups)
    # The sums of each group stand in its rows, so rounding is the same wherever a row is.
    rows = parties.withColumns({"__all": F.sum(weight).over(group), "__half": F.count(F.when(F.col(weight) > 0, 1)).over(group) / 2})
    even = lambda n: F.when(F.col("__all") > 0, F.col(weight) * n / F.col("__all")).otherwise(0.0)
    low = F.least(F.col(limit), F.greatest(F.lit(0), F.floor(even(F.col(seats) - F.col("__half")) - 0.5) - 1)).cast("long")
    high = F.least(F.col(limit), F.when(F.col(weight) > 0, F.ceil(even(F.col(seats) + F.col("__half")) + 0.5) + 1).otherwise(0)).cast("long")
    rows = rows.withColumns({"__low": low, "__high": high})
    rows = rows.withColumn("__open", F.col(seats) - F.sum("__low").over(group))
    ranks = F.when(F.col("__high") > F.col("__low"), F.sequence(F.col("__low") + 1, F.col("__high")))
    ranked = Window.partitionBy(*groups).orderBy(F.desc("__quotient"), tie, "__k")
    won = (
        rows.select(*groups, tie, "__open", weight, F.explode(ranks).alias("__k"))
        .withColumn("__quotient", F.col(weight) / (2 * F.col("__k") - 1))
        .withColumn("__rank", F.row_number().over(ranked))
        .where(F.col("__rank") <= F.col("__open"))
        .groupBy(*{*groups, tie})
        .agg(F.count("*").alias("__won"))
    )
    return rows.join(won, [*{*groups, tie}], "left").withColumn("__seats", F.col("__low") + F.coalesce("__won", F.lit(0))).drop("__all", "__half", "__low", "__high", "__open", "__won")


@shielding
def mixed(df: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 29, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep_text: bool = True, copies: str | None = None) -> DataFrame:
    """All rows of `df` with `size`, `source_size`, `target` (its source's) and `taken` words.

    Columns of `df` with those names are replaced. `keep_text=False` drops the texts once they are measured.
    `copies` names a column for whole documents in place of words: taken / size, rounded down or up. In each shard, in
    order of size, the fractions are summed, and whoever brings the sum over a whole number is rounded up.
    """
    df = df.drop("size", "source_size", "target", "taken")
    sized = df.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))
    sized = saved(sized if keep_text else sized.drop(text), "sized")
    # One row a source.
    per_source = sized.groupBy(source).agg(F.sum("size").alias("__size"), F.count("*").alias("__rows"))
    sources = targets(per_source, source, share, most, weights)
    total = F.sum("__size").over(Window.partitionBy())
    sources = saved(
        sources.withColumns(
            {
                "__block": F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(total / LEAST_BLOCKS))).cast("long"),
                "__shards": F.ceil((F.col("__size") + F.col("__rows")) / SHARD_WORDS).cast("long"),
                "__mix": total * share,
            }
        ).drop("__rows"),
        "sources",
    )
    dealt = sized.join(sources.withColumnRenamed(source, "__source"), F.col(source).eqNullSafe(F.col("__source"))).drop("__source", "__mix")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(doc_id)))
    dealt = dealt.withColumn("__order", order).withColumn("__shard", F.pmod(F.conv(F.substring("__order", 1, 8), 16, 10).cast("long"), F.col("__shards")))
    # One row a shard: quotas of the sources, then of their shards.
    shards = dealt.groupBy("__index", "__shard").agg(F.sum("size").alias("__words"), F.first("__block").alias("__block"))
    shards = saved(shards.withColumn("__held", F.ceil(F.col("__words") / F.col("__block")).cast("long")).where("__words > 0"), "shards")
    limits = shards.groupBy("__index").agg(F.sum(F.col("__held") * most).alias("__limit"))
    parties = sources.join(limits, "__index").withColumn("__want", F.floor(F.col("__mix") / F.col("__block") + 0.5).cast("long"))
    quotas = apportion(parties, [], "__target", "__want", "__limit", "__index").select("__index", F.col("__seats").alias("__quota"))
    quotas = apportion(
        shards.join(quotas, "__index").withColumn("__limit", F.col("__held") * most),
        ["__index"], "__words", "__quota", "__limit", "__shard",
    )
    start = F.pmod(_hash(F.lit(str(seed)), F.lit("start"), F.col("__index").cast("string"), F.col("__shard").cast("string")), F.col("__held"))
    quotas = quotas.select(
        "__index", "__shard", "__held", start.alias("__from"),
        F.expr("__seats div __held").alias("__full"), F.expr("__seats % __held").alias("__more"),
    )
    place = Window.partitionBy("__index", "__shard").orderBy("__order", doc_id, "size").rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumn("__end", F.sum("size").over(place)).join(quotas, ["__index", "__shard"], "left")
    # Of the first x blocks of a shard, chosen(x) - chosen(0) are taken once more.
    chosen = lambda x: f"(({x}) + __from) * __more div __held"
    words = lambda x: f"(({chosen(f'({x}) div __block')}) * __block + (({x}) % __block) * (({chosen(f'({x}) div __block + 1')}) - ({chosen(f'({x}) div __block')})))"
    taken = F.coalesce(F.expr(f"__full * size + {words('__end')} - {words('__end - size')}"), F.lit(0)).cast("long")
    dealt = dealt.withColumn("__taken", taken)
    if copies:
        part = F.expr(f"coalesce((__taken % nullif(size, 0)) * {PARTS} div size, 0L)")
        by_size = Window.partitionBy("__index", "__shard").orderBy("size", "__order", doc_id).rowsBetween(Window.unboundedPreceding, 0)
        first = F.pmod(_hash(F.lit(str(seed)), F.lit("copies"), F.col("__index").cast("string"), F.col("__shard").cast("string")), F.lit(PARTS))
        dealt = dealt.withColumn("__part", part).withColumn("__sum", F.sum("__part").over(by_size) + first)
        dealt = dealt.withColumn(copies, F.expr(f"coalesce(__taken div nullif(size, 0), 0L) + __sum div {PARTS} - (__sum - __part) div {PARTS}").cast("int")).drop("__part", "__sum")
    return dealt.withColumns({"source_size": F.col("__size"), "target": F.col("__target"), "taken": F.col("__taken")}).drop(
        "__index", "__taken", "__shard", "__size", "__target", "__block", "__shards", "__order", "__end", "__held", "__from", "__full", "__more"
    )


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS ssize, count(*) AS n,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS idx
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (idx - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, CAST(sum(ssize) OVER () AS BIGINT) AS total FROM per_source
), levels AS (
  SELECT *, CAST(total * 1.5 - coalesce(sum(ssize * 2) OVER b, 0) AS DOUBLE)
            / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS lev
  FROM weighed
  WINDOW b AS (ORDER BY CAST(ssize * 2 AS DOUBLE) / w, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), sources AS (
  SELECT source, ssize, idx, least(CAST(ssize * 2 AS DOUBLE), max(lev) OVER () * w) AS target,
         CAST(greatest(1, least(1024, total // 40000)) AS BIGINT) AS block,
         CAST(ceil((ssize + n) / 1048576.0) AS BIGINT) AS shards, CAST(total * 1.5 AS DOUBLE) AS mix
  FROM levels
), hashed AS (
  SELECT z.doc_id, z.size, s.idx, s.ssize, s.target, s.block, md5('29:' || CAST(z.doc_id AS VARCHAR)) AS h, s.shards
  FROM sized z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source
), dealt AS (
  SELECT *, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % shards AS shard FROM hashed
), shard_sums AS (
  SELECT idx, shard, CAST(sum(size) AS BIGINT) AS words, min(block) AS block, CAST(ceil(sum(size) / CAST(min(block) AS DOUBLE)) AS BIGINT) AS held
  FROM dealt GROUP BY idx, shard HAVING sum(size) > 0
), parties AS (
  SELECT s.idx, s.target, CAST(floor(s.mix / s.block + 0.5) AS BIGINT) AS want, l.lim,
         sum(s.target) OVER () AS tot, count(*) FILTER (s.target > 0) OVER () / 2.0 AS half
  FROM sources s JOIN (SELECT idx, CAST(sum(held * 2) AS BIGINT) AS lim FROM shard_sums GROUP BY idx) l USING (idx)
), bounds AS (
  SELECT *, CAST(least(lim, greatest(0, floor(target * (want - half) / tot - 0.5) - 1)) AS BIGINT) AS low,
            CAST(least(lim, ceil(target * (want + half) / tot + 0.5) + 1) AS BIGINT) AS high
  FROM parties
), ranked AS (
  SELECT idx, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, idx, k) AS r, free FROM (
    SELECT idx, target, free, unnest(range(low + 1, high + 1)) AS k
    FROM (SELECT *, want - sum(low) OVER () AS free FROM bounds))
), quota AS (
  SELECT b.idx, b.low + coalesce(w.n, 0) AS seats
  FROM bounds b LEFT JOIN (SELECT idx, count(*) AS n FROM ranked WHERE r <= free GROUP BY idx) w USING (idx)
), sbounds AS (
  SELECT *, CAST(least(lim, greatest(0, floor(CAST(words AS DOUBLE) * (seats - half) / tot - 0.5) - 1)) AS BIGINT) AS low,
            CAST(least(lim, ceil(CAST(words AS DOUBLE) * (seats + half) / tot + 0.5) + 1) AS BIGINT) AS high
  FROM (SELECT t.*, q.seats, t.held * 2 AS lim, sum(t.words) OVER (PARTITION BY t.idx) AS tot,
               count(*) OVER (PARTITION BY t.idx) / 2.0 AS half
        FROM shard_sums t JOIN quota q USING (idx))
), sranked AS (
  SELECT idx, shard, row_number() OVER (PARTITION BY idx ORDER BY CAST(words AS DOUBLE) / (2 * k - 1) DESC, shard, k) AS r, free FROM (
    SELECT idx, shard, words, free, unnest(range(low + 1, high + 1)) AS k
    FROM (SELECT *, seats - sum(low) OVER (PARTITION BY idx) AS free FROM sbounds))
), squota AS (
  SELECT b.idx, b.shard, b.held, CAST(('0x' || substr(md5('29:start:' || b.idx || ':' || b.shard), 1, 8)) AS BIGINT) % b.held AS o,
         (b.low + coalesce(w.n, 0)) // b.held AS fulls, (b.low + coalesce(w.n, 0)) % b.held AS more
  FROM sbounds b LEFT JOIN (SELECT idx, shard, count(*) AS n FROM sranked WHERE r <= free GROUP BY idx, shard) w USING (idx, shard)
), placed AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY idx, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM dealt
), cut AS (
  SELECT p.*, q.fulls, q.more, q.held, q.o, e // block AS eb, (e - size) // block AS sb, e % block AS er, (e - size) % block AS sr
  FROM placed p LEFT JOIN squota q USING (idx, shard)
)
SELECT doc_id, size, ssize AS source_size, target,
  CAST(coalesce(fulls * size
    + ((eb + o) * more // held) * block + er * (((eb + 1 + o) * more // held) - ((eb + o) * more // held))
    - ((sb + o) * more // held) * block - sr * (((sb + 1 + o) * more // held) - ((sb + o) * more // held)), 0) AS BIGINT) AS taken
FROM cut
"""
