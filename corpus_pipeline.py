"""The corpus pipeline: quality rules, near-dedup, PII, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import neardup, packing, pii, quality
from textlab.llm.common import written
from textlab.llm.queries import pii_key, vocabulary_path

#: The stages fit a robust model, find components and permute with a keyed
#: hash: SQL can't express them (see tests/llm/test_pipeline.py).
ORACLE_SQL = None


def _keyed(docs: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, as ids may repeat or be null; and the
    key column's name.  Rows read from files have one already: the file's
    number (a broadcast table with a row per file) and the place in the file.
    Other rows are numbered and written, as a number made on the fly may
    change."""
    key = "_row" + "_" * max(map(len, docs.columns), default=0)
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation" or "_metadata" in docs.columns:
        return written(docs.withColumn(key, F.monotonically_increasing_id()), f"rows-{tag}"), key
    place, number = f"{key}p", f"{key}n"
    names = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())  # one per file
    files = docs.sparkSession.createDataFrame(list(zip(names, range(len(names)))), f"{place} string, {number} long")
    rows = docs.select("*", F.col("_metadata.file_path").alias(place), F.col("_metadata.row_index").alias(key))
    rows = rows.join(F.broadcast(files), place)
    # 2^33 rows a file, 2^30 files
    return rows.withColumn(key, F.shiftleft(number, 33).bitwiseOR(F.col(key))).drop(place, number), key


def _only(keyed: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key is in ``kept``, without the key."""
    return keyed.join(kept, key, "left_semi").drop(key)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: rejected documents go, row by row."""
    keyed, key = _keyed(docs, "quality")
    return _only(keyed, key, quality.quality_verdicts(keyed, id_col=key).where("kept").select(key))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5 on five-word shingles at 0.8: one row of each group stays,
    one with the smallest id (null ids come last)."""
    keyed, key = _keyed(docs, "near_dedup")
    found = neardup.near_duplicates(keyed, id_col=key, width=5, pct=80).select(
        F.col("doc_id").alias(key), "component_id")
    first = found.join(keyed.select(key, "doc_id"), key).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("_first"))
    return _only(keyed, key, first.select(F.col("_first")[key].alias(key)))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: personal numbers and dates become pseudonyms."""
    return pii.pseudonymize(docs, pii_key(spark)).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: sequences of at most 1024 tokens."""
    return packing.pack(docs, vocabulary_path())


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("pii", pii_stage),
          ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
