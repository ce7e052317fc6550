"""Session helpers: local test sessions, checkpoint directory, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cartwheel") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    and the master is local (a test) create a private one: executors of a
    cluster don't see the driver's disk."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def bounded_broadcast(df: DataFrame, bound: int, what: str = "side") -> DataFrame:
    """Broadcast ``df`` whose row count is bounded by a parameter (a top-k list,
    a week calendar, a kernel).  The bound is verified by a cheap count on the
    already small relation; a violation means the caller's premise is wrong, so
    the plain DataFrame is returned and Spark/AQE picks a shuffle join instead."""
    n = df.count()
    if n <= bound:
        return F.broadcast(df)
    return df


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Used for an intermediate that several branches of a plan read (e.g. the
    weekly activity aggregate): the fact scan, join and de-duplication then
    run once instead of once per branch, and a lost executor re-reads the
    checkpoint instead of recomputing from the facts."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shipped(spark: SparkSession, value):
    """A broadcast of ``value`` that brings the classes of its objects along, so
    that executors need no copy of this package; ``pickle.loads`` restores it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))
