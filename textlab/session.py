"""Spark session helpers.

Library code never creates a session: every operator takes DataFrames and
returns DataFrames.  These helpers are for tests, ``bench.py`` and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "textlab",
              shuffle_partitions: int | None = None,
              event_log_dir: str | None = None) -> SparkSession:
    """Session tuned for the engine: AQE on (runtime broadcast of small
    sides, skew-join splitting, partition coalescing), UI off, UTC."""
    # Python workers import this package: they find it wherever the driver did
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    master = master or os.environ.get("TEXTLAB_MASTER", "local[8]")
    cores = 8
    if master.startswith("local[") and master[6:-1].isdigit():
        cores = int(master[6:-1])
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.shuffle.partitions",
                 str(shuffle_partitions or max(8, 2 * cores)))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("TEXTLAB_DRIVER_MEM", "16g")))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the deployment and we only read it; if it is
    unset there, that is an error, since executors can't share a folder of
    the driver.  Only a local session (tests) gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="textlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a result is re-read by several later stages (so a lost
    executor does not force recomputation from the sources) or where a
    non-repeatable step must be evaluated exactly once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
