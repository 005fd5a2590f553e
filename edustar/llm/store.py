"""Written tables in the folder the session names (``spark.checkpoint.dir``): they cut lineage, so a
lost executor re-runs one stage and two readers of a table see the same rows."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from edustar.session import storage_root


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (one folder for each value of ``by``) and read it back."""
    spark = df.sparkSession
    path = f"{storage_root(spark)}/llm/{uuid.uuid4().hex}/{name}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def importable_by_workers(spark) -> None:
    """Let Python workers that start from now on find this package where the driver found it (a local
    session, or a cluster that mounts the code); with --py-files or an installed package it changes nothing."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
