"""Incremental evaluation with Structured Streaming.

Scoring jobs drop prediction files as they finish.  The evaluator keeps the
confusion counts per run as streaming state (at most runs x K^2 rows) and
recomputes the labelled metric vector from that small table: the I1 pass
becomes a running aggregate, I2-I10 stay batch operators on its output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from textlab.operators import clf_metrics as cm
from textlab.session import ensure_checkpoint_dir


def start_confusion_stream(spark: SparkSession, path: str, schema: StructType,
                           score: Callable[[DataFrame], DataFrame],
                           keys: Sequence[str] = (), name: str | None = None,
                           file_glob: str | None = None):
    """Start a streaming query over the files at ``path`` (``score`` turns a
    batch of rows into ``keys..., target, prediction``) that keeps the
    running confusion table in a memory table ``name``.  Its checkpoint
    lives in the cluster's shared checkpoint folder.  Returns
    ``(query, name)``."""
    name = name or f"confusion_{uuid.uuid4().hex[:8]}"
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    src = reader.parquet(path)
    conf = cm.confusion(score(src), keys)
    q = (conf.writeStream.outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    return q, name


def stream_report(spark: SparkSession, path: str, schema: StructType,
                  score: Callable[[DataFrame], DataFrame],
                  keys: Sequence[str] = (), file_glob: str | None = None) -> DataFrame:
    """Run the confusion stream over everything available, then return
    the classification report (I2-I10) of the accumulated counts."""
    q, name = start_confusion_stream(spark, path, schema, score, keys, file_glob=file_glob)
    q.awaitTermination()
    return cm.classification_report(spark.table(name), keys)
