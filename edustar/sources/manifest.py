"""Publishing in two phases: a version is written whole into a folder of its own, then one row makes it current.

The manifest is a small Parquet table under the root; publishing appends one row (one file, committed by Spark's own
job commit). A reader takes the row with the highest number, so it sees the old version or the new one, never half
of either, and a version that was never published is never read. Old versions stay readable for who holds them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_SCHEMA = "number long, version string"


def new_version() -> str:
    return uuid.uuid4().hex


def _last(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_SCHEMA).parquet(f"{root}/manifest").orderBy(F.desc("number"), F.desc("version")).first()


def current(spark: SparkSession, root: str) -> str | None:
    """The published version, or None before the first one."""
    row = _last(spark, root)
    return row["version"] if row else None


def publish(spark: SparkSession, root: str, version: str) -> None:
    row = _last(spark, root)
    spark.range(1).select(F.lit((row["number"] if row else 0) + 1).cast("long").alias("number"), F.lit(version).alias("version")).coalesce(
        1).write.mode("append").parquet(f"{root}/manifest")
