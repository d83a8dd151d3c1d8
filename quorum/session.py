"""Spark session helpers.

The library never creates a session on its own inside operators; these
helpers are for tests, the bench and command-line runs.  Settings are the
ones a cluster job would carry: AQE on (runtime coalescing, skew-join
splitting, broadcast conversion), UTC, UI off.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "quorum",
                  shuffle_partitions: int | None = None) -> SparkSession:
    master = master or os.environ.get("QUORUM_MASTER", "local[8]")
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUORUM_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def limit_methods(spark: SparkSession) -> None:
    """Keep Spark from fusing a stage into a method that the JVM never compiles (over 8000 bytes of bytecode).

    The rule folds make such methods; interpreted they take half as long again.  See Spark's notes on
    ``spark.sql.codegen.hugeMethodLimit``.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` points at shared storage and is used as is.  Where
    it is unset, a scratch folder is made in plain local mode alone (tests, the
    bench), where driver and executors are one process; elsewhere that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="quorum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
