"""Global shuffle of a table into shards, in two passes over external buckets.

Pass 1 scatters the records by a seeded hash of their id and text into as many buckets as it takes for one to fit in
a task's memory. Pass 2 brings each bucket's records to an order that does not depend on how they came, gives it a
Fisher-Yates shuffle seeded by the bucket, and writes it. The buckets one after another are the shuffled table; its
row g goes to shard g mod n, so that the shards' row counts are at most one apart.

A bucket is never larger than some rows beyond its share: rows that are equal in all columns of plain types, which any hash
keeps together, are numbered without gaps when they hold over half a bucket, and dealt over the buckets by their numbers.
As such rows are alike, it does not matter which of them has which number, and the order depends on the rows alone.

Results: null texts and ids take part as such; an empty table gives an empty one. Rows that are equal in all columns but
those of nested types may change places with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.arrow import shielding
from terrane.llm.storage import saved

#: Types by which rows of one bucket are ordered before they are shuffled.
SORTED = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
#: Bytes of text that one bucket should hold.
BUCKET_BYTES = 24 << 20
#: Tasks of the second pass at most; beyond it each takes several buckets, one after another.
MOST_TASKS = 50_000


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of 0 to n - 1: for i from n - 1 down to 1, places i and j change, j drawn from 0 to i."""
    order = np.arange(n)
    draws = np.random.Generator(np.random.PCG64(seed)).integers(0, np.arange(n, 1, -1)) if n > 1 else ()
    out = order.tolist()
    for i, j in zip(range(n - 1, 0, -1), draws):
        out[i], out[j] = out[j], out[i]
    return np.array(out, dtype=np.int64)


def _numbered(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """The rows with `__number`: from 0 without gaps for those of each heavy digest, null for all others. Rows are numbered in the
    partition in which they are read, and the counts of the partitions before it are added."""
    read = rows.withColumn("__id", F.monotonically_increasing_id()).join(heavy.withColumn("__heavy", F.lit(True)), "__digest", "left")
    part = F.shiftright("__id", 33)
    # A window holds rows of one digest and one partition of the input.
    within = F.row_number().over(Window.partitionBy("__digest", "__part").orderBy("__id")) - 1
    hot = read.where("__heavy").withColumn("__part", part)
    counts = hot.groupBy("__digest", "__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__digest").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    counts = counts.select("__digest", "__part", before.alias("__before"))
    hot = hot.withColumn("__within", within).join(counts, ["__digest", "__part"]).withColumn("__number", F.col("__within") + F.col("__before"))
    rest = read.where("__heavy IS NULL").withColumn("__number", F.lit(None).cast("long"))
    return rest.select(*rows.columns, "__number").unionByName(hot.select(*rows.columns, "__number"))


@shielding
def shuffled(df: DataFrame, shards: int, seed: int = 17, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of `df` with `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    Columns of `df` with those names are replaced.
    """
    df = df.drop("shard", "slot")
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, SORTED) and f.name != text]
    digest = F.xxhash64(F.col(key), F.col(text), *[F.col(c) for c in plain if c != key])
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    total = df.agg(F.sum(size).alias("n")).first()["n"] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    # Equal rows beyond what a bucket holds are dealt on by their numbers; a bucket of others needs none of it.
    tagged = df.withColumn("__digest", digest)
    heavy = df.groupBy(digest.alias("__digest")).agg(F.sum(size).alias("__bytes")).where(F.col("__bytes") > bucket_bytes // 2)
    home = F.pmod(F.xxhash64(F.lit(seed), F.col("__digest")), F.lit(buckets))
    if heavy.take(1):
        tagged = _numbered(tagged, heavy.select("__digest"))
        home = F.when(F.col("__number").isNull(), home).otherwise(F.pmod(F.xxhash64(F.lit(seed), F.col("__digest"), F.col("__number")), F.lit(buckets)))
    tagged = tagged.withColumn("__bucket", home).drop("__number")

    def shuffled_bucket(table: pa.Table) -> pa.Table:
        bucket = table.column("__bucket")[0].as_py()
        keys = [(n, "ascending") for n in ("__digest", *plain) if n in table.column_names]
        table = table.sort_by(keys).take(pa.array(fisher_yates(table.num_rows, [seed, bucket])))
        return table.append_column("__place", pa.array(range(table.num_rows), pa.int64()))

    def shuffle(batches):
        """Buckets one after another; a task holds one at a time."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            own = batch.column("__bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:]):
                if held and b > a and held[0].column("__bucket")[0].as_py() != own[a]:
                    yield from shuffled_bucket(pa.Table.from_batches(held)).to_batches()
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from shuffled_bucket(pa.Table.from_batches(held)).to_batches()

    schema = T.StructType([*tagged.schema.fields, T.StructField("__place", T.LongType())])
    # A task a bucket, or, of very many, several buckets a task; either way a task's memory is that of one bucket.
    tasks = min(buckets, MOST_TASKS)
    dealt = tagged.repartitionById(tasks, F.pmod("__bucket", F.lit(tasks)).cast("int")).sortWithinPartitions("__bucket")
    kept = saved(dealt.mapInArrow(shuffle, schema), "shuffled")
    # One row a bucket.
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("__bucket").agg(F.count("*").alias("__n")).select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    at = F.col("__start") + F.col("__place")
    return kept.join(starts, "__bucket").withColumns({"shard": F.pmod(at, F.lit(shards)).cast("int"), "slot": ((at - F.pmod(at, F.lit(shards))) / shards).cast("long")}).drop("__bucket", "__digest", "__start", "__place")


def write_shards(df: DataFrame, folder: str, shards: int, **options) -> None:
    """The shuffled table as Parquet folders shard=0, shard=1, ...; the files of a shard are in the order of slot."""
    done = saved(shuffled(df, shards, **options), "sharded")
    done.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
