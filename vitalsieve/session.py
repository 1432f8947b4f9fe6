"""Session settings and the few runtime helpers every module shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest small side that may be held on the driver and broadcast. Anything larger is joined by shuffle.
SMALL_ROWS = 20_000


def build_session(app: str = "vitalsieve", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC time. On a cluster, leave ``master`` unset."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a scratch folder only for local sessions without one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can read")
        named = tempfile.mkdtemp(prefix="vitalsieve-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder, so that lost executors cost a re-read and no recompute."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Make ``df`` safe to join with a large table.

    Reads at most ``limit + 1`` rows. If they all fit, the materialised rows come back marked for broadcast, so
    the plan behind them runs once. If there are more, ``df`` itself comes back without a hint and Spark joins it by
    shuffle. Results are the same either way.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan dealt over all cores, where its files give fewer parts than that: for work that costs much more than moving its rows."""
    parts = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts)
