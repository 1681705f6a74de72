"""Tables written between the steps of an operator.

Executors can be lost at any time, and a plan that names a step several times would run it as often. So steps are cut by Parquet
tables in the folder that the cluster names in ``spark.checkpoint.dir``, which the driver and all executors share. Only a
session of one machine (master ``local``) without that setting, as in tests, gets a temporary folder; elsewhere that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

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


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries go when they end, not when the driver next collects its garbage, which may be hours later."""
    before = spark.conf.get(_REMOVE, "false")
    spark.conf.set(_REMOVE, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet and give the table read back, so later passes never recompute it. What was shuffled for it
    is removed, so that the disk holds one step at a time."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
