"""Session construction shared by tests, the bench and the entry module."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally:
#  * AQE re-plans joins with runtime sizes: a shuffle join whose measured side
#    is under spark.sql.adaptive.autoBroadcastJoinThreshold becomes a
#    broadcast join, larger sides stay sort-merge. This is the size check
#    behind every join of two data-dependent tables in this package.
#  * skewJoin splits hot partitions (a postcode or region holding a third of
#    the rows) instead of leaving them to one task.
#  * ANSI mode stays on; every division is guarded explicitly.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "uptake",
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally the
    tests use ``local[8]`` with 8 shuffle partitions. For ~100 TB of raw
    drops, start with about one shuffle partition per 128 MB of the largest
    shuffled input after map-side aggregation (thousands of partitions) and
    let AQE coalesce them; ``spark.sql.files.maxPartitionBytes`` keeps its
    128 MB default, so scan tasks stay a fixed size whatever the input.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("UPTAKE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a local session without it (tests) gets a fresh
    scratch folder; a cluster without it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="uptake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Materialise ``df`` in the reliable checkpoint directory and return the checkpointed frame.

    Used for small tables that iterative solvers and several later jobs read
    (model inputs, matched units): they are computed once, and a lost
    executor re-reads the checkpoint instead of recomputing the lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Partitions of a table that a solver iterates over. Fixed, so that seeded
#: starts, which depend on the partitions, are the same at any size and on any cluster.
MODEL_PARTITIONS = 4


def solver_input(df, key: str, partitions: int = MODEL_PARTITIONS):
    """Deal ``df`` by the hash of ``key`` to a given number of partitions, sorted, so a rerun sees the same rows in the same order."""
    return df.repartition(partitions, key).sortWithinPartitions(key)
