"""Scans of the named tables and splits (A1, A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, root: str, name: str,
          columns: Sequence[str] | None = None) -> DataFrame:
    """One Parquet table; ``columns`` is the projection (it reaches the scan
    as ``ReadSchema``)."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def load_split(spark: SparkSession, path: str, split: str,
               schema: StructType | None = None,
               split_col: str = "split") -> DataFrame:
    """A1: one named split of a dataset stored Hive-style
    (``path/split=train/...``); the predicate prunes partitions at planning
    time, so only that split's files are listed and read."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path).where(F.col(split_col) == F.lit(split)).drop(split_col)


def literal_table(spark: SparkSession, rows: Sequence[tuple | dict],
                  schema: StructType | str) -> DataFrame:
    """A5: an inline literal table (fixtures, declared class lists)."""
    return spark.createDataFrame(list(rows), schema)
