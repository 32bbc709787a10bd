"""A streamed table is one file or a folder of files."""
import pytest
from pyspark.sql import functions as F

from textlab.plans import queries as q


@pytest.mark.parametrize("files", [None, 1, 3])  # None: a plain file
def test_streamed_report_reads_a_file_or_a_folder(spark, tmp_path, files):
    e = spark.range(60).select(F.col("id").alias("vec_id"), F.transform(
        F.sequence(F.lit(0), F.lit(9)), lambda j: F.pmod(F.hash(F.col("id") % 7, j), F.lit(101)).cast("float")).alias("embedding"),
        (F.col("id") % 10).cast("int").alias("label"))
    if files:
        e.repartition(files).write.parquet(f"{tmp_path}/embeddings.parquet")
    else:
        e.toPandas().to_parquet(f"{tmp_path}/embeddings.parquet")
    spark.range(3).write.parquet(f"{tmp_path}/other.parquet")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(q.streamed_clf_report(spark, str(tmp_path))) == rows(q.clf_report(spark, str(tmp_path)))
