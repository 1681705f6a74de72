"""Readers and writers of the formats that listings come and go in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_feed(spark: SparkSession, path: str, schema: T.StructType, root: str | None = "data.ads") -> DataFrame:
    """One row for each item of the array at `root`, or of the array that the file is if there is no root; each file is one
    JSON value."""
    if root is None:
        return spark.read.schema(schema).json(path, multiLine=True)
    inner: T.DataType = T.ArrayType(schema)
    for name in reversed(root.split(".")):
        inner = T.StructType([T.StructField(name, inner)])
    return spark.read.schema(inner).json(path, multiLine=True).select(F.explode(root).alias("ad")).select("ad.*")


def in_file_order(rows: DataFrame) -> DataFrame:
    """The rows of a file source with `place`, their number from 0 in the files one after another, in the order of paths.

    Tasks read the files in splits. The rows of each split are counted, the counts of the splits before it are added, and the number of a
    row in its split, which a task reads in order, does the rest."""
    lines = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__from"), F.monotonically_increasing_id().alias("__id"))
    splits = lines.groupBy("__file", "__from").agg(F.count("*").alias("n"), F.min("__id").alias("first"))
    # One row a split.
    before = F.sum("n").over(Window.orderBy("__file", "__from").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    splits = splits.select(F.col("__file").alias("__f"), F.col("__from").alias("__b"), (before - F.col("first")).alias("__shift"))
    joined = lines.join(splits, (F.col("__file") == F.col("__f")) & (F.col("__from") == F.col("__b")))
    return joined.select(*rows.columns, (F.col("__id") + F.col("__shift")).alias("place"))


def ordered_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A TSV with a header in each file, and `place`, the number of its row in all files. A byte order mark is no part of a name."""
    return in_file_order(spark.read.csv(path, sep="\t", header=True, schema=schema, encoding="UTF-8"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """The first integer of each line of free texts, each once with the `place` of its first line; lines without one are
    passed over."""
    lines = in_file_order(spark.read.text(path))
    ids = lines.select(F.regexp_extract("value", r"\d+", 0).try_cast("long").alias("id"), "place").where("id IS NOT NULL")
    return ids.groupBy("id").agg(F.min("place").alias("place"))


_LINK = "loc string, lastmod string"


def sitemap_index(spark: SparkSession, path: str) -> DataFrame:
    """(loc, lastmod) of the child sitemaps that an index lists, each once."""
    return spark.read.schema(_LINK).xml(path, rowTag="sitemap").where("trim(loc) <> ''").select(F.trim("loc").alias("loc"), F.trim("lastmod").alias("lastmod")).distinct()


def sitemap_links(spark: SparkSession, index: str, children: str, named: str | None = None, since: str | None = None) -> DataFrame:
    """(sitemap, loc, lastmod) of the links in the child sitemaps of an index. `children`: where the files lie, each under the
    name that ends its address; `named`: a pattern that this name must match, such as a date of a batch; `since`: the
    least day of change, links without one left out."""
    known = sitemap_index(spark, index).select(F.substring_index("loc", "/", -1).alias("sitemap")).distinct()
    known = known.where(F.col("sitemap").rlike(named)) if named else known
    links = spark.read.schema(_LINK).xml(children, rowTag="url").select("loc", "lastmod", F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("sitemap"))
    return _changed(links.join(known, "sitemap", "left_semi").select("sitemap", "loc", "lastmod"), since)


def links_of_xml(df: DataFrame, xml: str, since: str | None = None) -> DataFrame:
    """The other columns of `df` with loc and lastmod of each link of the sitemap in the text `xml`; a text that is no sitemap has none."""
    parsed = df.withColumn("__set", F.from_xml(xml, f"struct<url:array<struct<{_LINK.replace(' ', ':')}>>>".replace(",:", ",")))
    rows = parsed.select(*[c for c in df.columns if c != xml], F.explode("__set.url").alias("__link"))
    return _changed(rows.select(*[c for c in df.columns if c != xml], "__link.loc", "__link.lastmod"), since)


def _changed(links: DataFrame, since: str | None) -> DataFrame:
    links = links.where("trim(loc) <> ''").withColumns({"loc": F.trim("loc"), "lastmod": F.trim("lastmod")})
    return links.where(F.substring("lastmod", 1, 10).try_cast("date") >= F.lit(since).cast("date")) if since else links


def jdbc_table(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A table of a database, read in `parts` ranges of a numeric key."""
    return spark.read.jdbc(url, name, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=options)


def snake_case(name: Column | str) -> Column:
    x = F.col(name) if isinstance(name, str) else name
    return F.lower(F.regexp_replace(F.regexp_replace(x, r"([A-Z]+)([A-Z][a-z])", "$1_$2"), r"([a-z0-9])([A-Z])", "$1_$2"))


def landed(df: DataFrame, json: str, schema: T.StructType) -> DataFrame:
    """Columns of a JSON text by a declared schema; the text "default" counts as null in string fields."""
    parsed = df.withColumn("__v", F.from_json(json, schema))
    text = lambda f: F.when(F.lower(F.trim(f"__v.{f.name}")) != "default", F.col(f"__v.{f.name}"))
    made = [(text(f) if isinstance(f.dataType, T.StringType) else F.col(f"__v.{f.name}")).alias(f.name) for f in schema.fields]
    return parsed.select(*[c for c in df.columns if c != json], *made)


def landed_by_alias(df: DataFrame, json: str, schema: T.StructType) -> DataFrame:
    """Columns of a JSON object whose keys are those of the schema or the same in camel case; the plain key goes first.
    Truth values count as 1 and 0, objects and lists stay JSON, times are those of mail headers, without their zone."""
    parsed = df.withColumn("__v", F.from_json(json, T.MapType(T.StringType(), T.StringType())))

    def value(f: T.StructField) -> Column:
        first, *rest = f.name.split("_")
        camel = first + "".join(w.capitalize() for w in rest)
        # A key with a null is there all the same.
        raw = F.when(F.map_contains_key("__v", f.name), F.col("__v")[f.name]).otherwise(F.col("__v")[camel])
        if isinstance(f.dataType, T.TimestampType):
            return F.try_to_timestamp(F.nullif(F.regexp_extract(raw, r"\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2}", 0), F.lit("")), F.lit("d MMM yyyy HH:mm:ss"))
        if isinstance(f.dataType, T.NumericType):
            return F.when(raw == "true", F.lit(1)).when(raw == "false", F.lit(0)).otherwise(raw.try_cast(f.dataType)).cast(f.dataType)
        return raw.try_cast(f.dataType)

    return parsed.select(*[c for c in df.columns if c != json], *[value(f).alias(f.name) for f in schema.fields])


def append(df: DataFrame, path: str) -> None:
    """The rows added to a table that may not exist yet, its columns by name."""
    df.write.mode("append").parquet(path)


def rebuild(df: DataFrame, path: str) -> None:
    """The table emptied and written anew; `df` must not read it."""
    df.write.mode("overwrite").parquet(path)


def write_tsv(df: DataFrame, path: str, order: list[Column]) -> None:
    """One ordered TSV file; for reports, which are small."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_bulk_csv(df: DataFrame, path: str) -> None:
    """CSV parts with nulls as backslash N, as bulk loaders of databases read them."""
    df.write.mode("overwrite").csv(path, header=False, nullValue="\\N", emptyValue="")


def write_day(df: DataFrame, path: str, at: str, day: str) -> None:
    """The rows of one day, from its midnight to before the next."""
    start = F.to_timestamp(F.lit(day))
    df.where((F.col(at) >= start) & (F.col(at) < start + F.expr("INTERVAL 1 DAY"))).write.mode("overwrite").csv(path, header=True)


def write_stats(df: DataFrame, path: str) -> None:
    """Statistics by month; a later run replaces the months that it has and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
