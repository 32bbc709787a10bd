"""Corpus statistics (K1-K3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators.textprep import native_tokens


def assemble_corpus(parts: Sequence[tuple[DataFrame, str, object]]) -> DataFrame:
    """K2: ``(source, text)`` from several tables; each part is
    ``(df, text_col, source)`` where ``source`` is a column name or a
    literal label.  A plain ``unionByName`` (no shuffle)."""
    out = None
    for df, text_col, source in parts:
        src = F.col(source) if isinstance(source, str) and source in df.columns else F.lit(source)
        p = df.select(src.cast("string").alias("source"), F.col(text_col).alias("text"))
        out = p if out is None else out.unionByName(p)
    return out


def corpus_stats(df: DataFrame, text_col: str = "text", by: str = "source") -> DataFrame:
    """K1: documents, tokens and UTF-8 bytes per ``by`` value plus a total
    row (``by`` null), via ``rollup`` -- one aggregation with partial
    aggregation, so a dominant source costs one row per task."""
    x = df.select(by, F.size(native_tokens(text_col)).alias("_nt"),
                  F.octet_length(text_col).alias("_nb"))
    return (x.rollup(by).agg(F.count(F.lit(1)).alias("n_docs"),
                             F.sum("_nt").alias("n_tokens"),
                             F.sum("_nb").alias("n_bytes")))


def labelset_stats(df: DataFrame, labels_col: str = "labels") -> DataFrame:
    """K3: ``(stat, value)`` rows -- ``n_rows``, ``n_labels`` (distinct),
    ``max_labels`` and ``mean_labels`` per row.  Two small aggregations,
    stacked (no join)."""
    per_row = df.select(F.size(F.array_distinct(labels_col)).alias("_k"), labels_col)
    rows = per_row.agg(F.count(F.lit(1)).cast("double").alias("n_rows"),
                       F.max("_k").cast("double").alias("max_labels"),
                       F.avg("_k").alias("mean_labels"))
    rows = rows.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("stat"), F.col(c).alias("value"))
        for c in ("n_rows", "max_labels", "mean_labels")])).alias("s")).select("s.*")
    distinct = (per_row.select(F.explode(labels_col).alias("l")).distinct()
                .agg(F.count(F.lit(1)).cast("double").alias("value"))
                .select(F.lit("n_labels").alias("stat"), "value"))
    return rows.unionByName(distinct)
