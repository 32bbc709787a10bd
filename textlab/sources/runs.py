"""Run records on shared storage.

The reference keeps one pickled record per run in a directory tree
``root/model/task/lr_X num_epochs_Y/seed_Z``.  Here a run table is one
Parquet dataset partitioned Hive-style by the run keys, so discovering and
filtering runs is partition discovery plus partition pruning.  Trees in the
documented layout are written and found too (``*_run_tree``): keys are parsed
from the files' paths, and filters become part of the path pattern, so that
other runs' folders are not listed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_KEYS = ("task", "model", "lr", "num_epochs", "seed")


def write_runs(df: DataFrame, root: str, keys: Sequence[str] = RUN_KEYS,
               cluster: bool = True) -> None:
    """Write (or replace) the runs present in ``df``; other runs under
    ``root`` are kept (dynamic partition overwrite).

    ``cluster`` first hash-partitions by the run keys so each run directory
    gets one file instead of one per task -- right for metric vectors
    (bounded per run).  Pass ``False`` for data-sized prediction tables,
    where one run's rows must stay spread over many tasks."""
    if cluster:
        df = df.repartition(*keys)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(root))


def read_runs(spark: SparkSession, root: str, **filters) -> DataFrame:
    """A6 + A7: all runs under ``root``; keyword filters on run keys become
    partition predicates (a list value means ``isin``), so only matching
    directories are listed and read."""
    df = spark.read.option("basePath", root).parquet(root)
    for k, v in filters.items():
        df = df.where(F.col(k).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(k) == v)
    return df


def write_summary(df: DataFrame, path: str) -> None:
    """Store a final summary table (replaces it)."""
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A10: a side-by-side report as CSV with a header (one file per task;
    the report is small, but nothing is forced through one task)."""
    df.write.mode("overwrite").option("header", True).csv(path)


#: The documented layout: folder names under the root.
TREE = ("{model}", "{task}", "lr_{lr} num_epochs_{num_epochs}", "seed_{seed}")


def write_run_tree(df: DataFrame, root: str) -> None:
    """A8 in the documented layout, one folder per run (a bounded table of
    runs; each is written by itself and replaces what was there)."""
    values = [c for c in df.columns if c not in RUN_KEYS]
    for r in df.select(*RUN_KEYS).distinct().collect():
        run = r.asDict()
        one = df
        for k, v in run.items():
            one = one.where(F.col(k).eqNullSafe(F.lit(v)))
        folder = "/".join(TREE).format(**run)
        one.select(*values).coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{folder}")


def discover_runs(spark: SparkSession, root: str, **filters) -> DataFrame:
    """A6 + A7 in the documented layout: the records of all runs under
    ``root`` with their keys ``model, task, lr, num_epochs, seed``, parsed
    from the path.  Keyword filters (a value or a list) narrow the pattern by
    which folders are listed.  Folders of other names are passed over; no
    matching run raises."""
    def choice(key: str) -> str:
        v = filters.get(key)
        options = ["*"] if v is None else [str(x) for x in (v if isinstance(v, (list, tuple, set)) else [v])]
        return options[0] if len(options) == 1 else "{" + ",".join(options) + "}"

    unknown = set(filters) - set(RUN_KEYS)
    if unknown:
        raise ValueError(f"not run keys: {sorted(unknown)}")
    pattern = "/".join(TREE).format(**{k: choice(k) for k in RUN_KEYS})
    df = spark.read.parquet(f"{root.rstrip('/')}/{pattern}")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    found = r"/([^/]+)/([^/]+)/lr_([^/ ]+) num_epochs_([^/]+)/seed_([^/]+)/[^/]+$"
    part = lambda i: F.regexp_extract(path, found, i)
    return df.select(part(2).alias("task"), part(1).alias("model"), part(3).cast("double").alias("lr"),
                     part(4).cast("int").alias("num_epochs"), part(5).cast("int").alias("seed"), "*")
