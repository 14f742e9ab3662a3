"""Session settings shared by the jobs, the bench and the tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "cohortline", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    Shuffle partitions are left to the cluster (AQE coalesces them); pass them
    in ``conf`` for small local runs. Stages whose generated method is too big
    for the JVM to compile (8000 bytes) run operator by operator instead of
    interpreted: wide encodings are several times faster that way.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master without the setting gets a temporary folder; on a
    cluster a missing setting is an error, since executors would not see it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="cohortline-")
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df):
    """Materialise ``df`` in the checkpoint folder and forget how it was made.

    Later stages then survive lost executors without redoing the shuffles
    behind it, and several readers share one computation.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.fspath(folder))
    return df.checkpoint(eager=True)
