"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_session(cpus: int | None = None, master: str | None = None, app: str = "edustar") -> SparkSession:
    """A session tuned for the local tests and the benchmark.

    Without ``master``, the one that spark-submit (or PYSPARK_SUBMIT_ARGS) names is kept, and a local one with
    ``cpus`` threads is set only where none is named; shuffle partitions are set for such a local master only. The other
    settings matter at any size: AQE (coalescing, skew-join split, runtime broadcast by
    measured size), UTC, and no UI server.
    """
    preset = "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if master is None and not preset:
        master = f"local[{int(cpus or os.environ.get('BENCH_CPUS', 8))}]"
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if master and re.match(r"local(\[|$)", master):
        cores = re.search(r"\[(\d+)", master)
        b = b.config("spark.sql.shuffle.partitions", cores[1] if cores else str(os.cpu_count()))
        # One machine: aim AQE's coalesced partitions at 8 MB, so a stage of a few
        # tens of MB still spreads over the cores. On a cluster keep Spark's 64 MB.
        b = b.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(8 << 20))
    return (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Coalesce small shuffle partitions up to the advisory size instead of keeping
        # one per core: fewer, fuller tasks (Spark's advice for busy clusters too).
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast by *measured* size: the static planner only broadcasts inputs whose
        # estimated (compressed-file) size is under 1 MB; AQE broadcasts a join side
        # after its shuffle stage has run and measured under 32 MB; otherwise the join
        # stays sort-merge. So no broadcast ever rests on a guess about big data.
        .config("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 << 20))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("EDUSTAR_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )


def storage_root(spark: SparkSession) -> str:
    """The shared folder for landed and materialised tables.

    Read from the session (``spark.checkpoint.dir``, or the context's checkpoint
    dir). Only when neither is set *and* the master is local is a private folder
    made (tests); on a cluster a machine-local folder would be wrong, so raise.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="edustar-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
