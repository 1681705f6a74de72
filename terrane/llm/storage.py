"""Reliable intermediate tables.

Executors can be lost at any time, so lineage is cut by Parquet tables in the folder that the cluster
names in ``spark.checkpoint.dir``, which the driver and all executors share. Only a session of one machine (master
``local``) without that setting, as in tests, gets a temporary folder; elsewhere that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Temporary folders of local applications.
_temporary: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, as a URI or a path that Spark understands."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _temporary:
        _temporary[app] = tempfile.mkdtemp(prefix="spark-shared-")
    return _temporary[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet and give the table read back, so later passes never recompute it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def open_store(uri: str):
    """pyarrow's file system for a folder of any scheme it knows (plain paths are local), and the path in it."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return fs.LocalFileSystem(), uri
