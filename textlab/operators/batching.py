"""Reproducible epoch shuffles and fixed-size batches.

A data loader's ``shuffle=True`` draws a fresh permutation every epoch.
Here the permutation is a sort by ``md5(seed:epoch:id)`` (60-bit prefix,
then the id), so any engine reproduces it and the seed really drives it.
Positions come from the distributed positional index (P1); a batch is
``position div batch_size`` and the short last batch is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlab.operators.positions import positional_index


def shuffle_key(id_col: str, seed, epoch) -> Column:
    """60-bit hash of ``seed:epoch:id`` (first 15 hex digits of md5)."""
    s = F.concat_ws(":", F.col(seed).cast("string") if isinstance(seed, str) else F.lit(str(seed)),
                    F.col(epoch).cast("string") if isinstance(epoch, str) else F.lit(str(epoch)),
                    F.col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def shuffled_batches(df: DataFrame, id_col: str, seeds: Sequence[int],
                     epochs: Sequence[int], batch_size: int = 8) -> DataFrame:
    """E1 + E2: for every (seed, epoch) a permutation of all rows, cut into
    batches -> ``(rows..., seed, epoch, position, batch_id)``.

    The (seed, epoch) plan is a literal array exploded onto each row, so all
    epochs of all seeds are ordered in one job.
    """
    plan = F.array(*[F.struct(F.lit(s).alias("seed"), F.lit(e).alias("epoch"))
                     for s in seeds for e in epochs])
    x = df.withColumn("_se", F.explode(plan)).select("*", "_se.seed", "_se.epoch").drop("_se")
    x = x.withColumn("_h", shuffle_key(id_col, "seed", "epoch"))
    x = positional_index(x, ["_h", id_col], ["seed", "epoch"], out="position")
    return x.withColumn("batch_id", (F.col("position") / batch_size).cast("long")).drop("_h")


def eval_batches(df: DataFrame, id_col: str, batch_size: int = 8) -> DataFrame:
    """Order-preserving batches (by ``id_col``) for evaluation."""
    x = positional_index(df, [id_col], out="position")
    return x.withColumn("batch_id", (F.col("position") / batch_size).cast("long"))


def write_batches(batches: DataFrame, path: str, n_shards: int = 8) -> DataFrame:
    """E2 export: every (seed, epoch) as at most ``n_shards`` Parquet shards
    of consecutive positions, one sorted file each, so that a loader streams
    an epoch in batch order file by file.  A row's shard follows from its
    position alone; nothing is sorted as a whole.

    Then the shards are read back: returns the manifest ``(seed, epoch, shard,
    file, n_rows, first_position, last_position)``, also stored at
    ``path`` + ``_manifest``.
    """
    spark = batches.sparkSession
    rows = batches.agg(F.ceil((F.max("position") + 1) / n_shards)).scalar()
    b = batches.withColumn("shard", F.floor(F.col("position") / F.coalesce(rows, F.lit(1))).cast("int"))
    (b.repartition("seed", "epoch", "shard").sortWithinPartitions("seed", "epoch", "shard", "position")
     .write.mode("overwrite").partitionBy("seed", "epoch", "shard").parquet(path))
    back = read_batches(spark, path, b).select("seed", "epoch", "shard", "position", F.col("_metadata.file_path").alias("file"))
    back.groupBy("seed", "epoch", "shard", "file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("position").alias("first_position"),
        F.max("position").alias("last_position")).write.mode("overwrite").parquet(f"{path.rstrip('/')}_manifest")
    return spark.read.parquet(f"{path.rstrip('/')}_manifest")


def read_batches(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of a written epoch table, with the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(path)


def manifest_gaps(manifest: DataFrame) -> DataFrame:
    """Shards of a manifest that don't hold just the positions behind the
    shard before (a repeated, missing or extra row, or several files)."""
    w = Window.partitionBy("seed", "epoch").orderBy("shard", "first_position")
    m = manifest.withColumn("_next", F.coalesce(F.lag("last_position").over(w) + 1, F.lit(0)))
    whole = (F.col("first_position") == F.col("_next")) & (
        F.col("last_position") - F.col("first_position") + 1 == F.col("n_rows"))
    return m.where(~whole).drop("_next")
