"""Label encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def fit_labels(df: DataFrame, col: str = "label") -> DataFrame:
    """The sorted distinct labels numbered 0..K-1 -> ``(class_id,
    class_name)``.  The distinct aggregation runs distributed (partial
    aggregation per task); the numbering window only sees the K classes."""
    d = df.select(F.col(col).cast("string").alias("class_name")).where(
        F.col("class_name").isNotNull()).distinct()
    w = Window.orderBy("class_name")
    return d.select((F.row_number().over(w) - 1).cast("int").alias("class_id"),
                    "class_name")


def declared_classes(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """A declared class list in fixed order (ids are positions)."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)],
                                 "class_id int, class_name string")


def n_classes(classes: DataFrame) -> DataFrame:
    """C4: number of classes, as a one-row table."""
    return classes.agg(F.count(F.lit(1)).alias("n_classes"))


def apply_labels(df: DataFrame, classes: DataFrame, col: str = "label",
                 out: str = "label_id", on_unseen: str = "error"):
    """Encode ``col`` with a fitted class table (K rows: AQE broadcasts
    it after measuring it).

    ``on_unseen``: ``'error'`` fails the job on a label that is not in the
    table, ``'null'`` leaves the id null, ``'quarantine'`` returns
    ``(encoded, quarantine)`` where quarantine holds the unseen rows with a
    reason column.
    """
    c = classes.select(F.col("class_name").alias("_cn"), F.col("class_id").alias(out))
    j = df.join(c, F.col(col).cast("string") == F.col("_cn"), "left").drop("_cn")
    if on_unseen == "null":
        return j
    if on_unseen == "error":
        chk = F.when(F.col(out).isNull() & F.col(col).isNotNull(),
                     F.raise_error(F.concat(F.lit("unseen label: "),
                                            F.col(col).cast("string"))))
        return j.withColumn(out, F.coalesce(chk.cast("int"), F.col(out)))
    if on_unseen == "quarantine":
        bad = F.col(out).isNull()
        return (j.where(~bad),
                j.where(bad).withColumn("reason", F.lit("unseen label")))
    raise ValueError("on_unseen must be 'error', 'null' or 'quarantine'")
