"""Last-wins upserts of arriving records (G9, streaming).

Records arrive in files; a record sent again under the same key replaces the
earlier one, whichever batch it comes in.  The table is partitioned by a hash
bucket of the key, and a micro-batch rewrites only the buckets it touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from textlab.session import cut_lineage, ensure_checkpoint_dir


def _latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last record of each key (a grouped maximum with partial sums: a
    key sent very often costs a row per task)."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def merge_into(table: str, schema: StructType, keys: Sequence[str], order: Sequence[str], buckets: int):
    """The function of one micro-batch.  It is idempotent: a batch that is
    run again after a failure changes nothing."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = cut_lineage(_latest(batch.select(*schema.names).withColumn(
            "bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), ["bucket", *keys], order))
        touched = [r["bucket"] for r in b.select("bucket").distinct().collect()]  # at most `buckets`
        if not touched:
            return
        stored = spark.read.schema(b.schema).parquet(table).where(F.col("bucket").isin(touched))
        merged = _latest(stored.unionByName(b), ["bucket", *keys], order)
        cut_lineage(merged).repartition("bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(table)
    return merge


def upsert_stream(spark: SparkSession, source: str, schema: StructType, table: str, keys: Sequence[str],
                  order: Sequence[str], buckets: int = 16, files_per_batch: int = 1) -> DataFrame:
    """Merges all records in the Parquet files under ``source`` into
    ``table`` and returns it: one record per key, the last by ``order``.  The
    stream's checkpoint lies in the cluster's shared folder."""
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/upsert-{uuid.uuid4().hex[:12]}"
    stored = StructType([*schema.fields]).add("bucket", IntegerType())
    spark.createDataFrame([], stored).write.mode("ignore").partitionBy("bucket").parquet(table)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    q = (src.writeStream.foreachBatch(merge_into(table, schema, keys, order, buckets))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stored).parquet(table).drop("bucket")
