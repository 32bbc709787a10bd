"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.session import ensure_checkpoint_dir

#: Java character class of the word separators 0x20 and 0x09-0x0D.
SEPARATORS = "[ \\t-\\r]"
SEPARATOR_CHARS = " \t\n\x0b\f\r"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared checkpoint folder,
    read back.  Used where a result feeds several later steps: a lost
    executor then re-reads files instead of recomputing the chain."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none), JVM-side."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SEPARATORS}+"), "")


def lower_az(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ spread-out ranks
def spread(key: Column, n: int) -> Column:
    """A bucket 0..n-1 from a key's hash (nulls hash too)."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def ranked(df: DataFrame, by: list[str], order: list[str], out: str, cells: int | None = None,
           total: str | None = None, weight: str | None = None) -> DataFrame:
    """Gapless 0-based rank ``out`` inside each group of ``by``, and the
    group's row count ``total`` if named, without one task per group.  With
    ``weight``, the sums of that column over the rows before and over all.

    Rows are spread over ``cells`` hash cells per group (twice the session's
    shuffle partitions, 64 at least); cell counts (at most ``cells`` rows per
    group) give every cell its offset, and the rank
    inside a cell is a window over that cell alone.  A group with a third of
    all rows is thus ranked by ``cells`` tasks.  The order is: cell, then
    ``order``.
    """
    from pyspark.sql import Window as W

    cells = cells or max(64, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = df.withColumn("_cell", spread(F.struct(*order), cells))
    one = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    counts = keyed.groupBy(*by, "_cell").agg(F.sum(one).alias("_n"))
    run = W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], F.col("_cell").alias("_oc"),
        F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_off"),
        F.sum("_n").over(W.partitionBy(*by)).alias("_total"))
    inner = W.partitionBy(*by, "_cell").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    r = keyed.withColumn("_rn", F.sum(one).over(inner) - one)
    on = F.col("_cell") == F.col("_oc")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    r = r.join(offsets, on)
    r = r.withColumn(out, (F.col("_rn") + F.col("_off")).cast("long"))
    if total:
        r = r.withColumn(total, F.col("_total"))
    return r.drop("_cell", "_rn", "_oc", "_off", "_total", *[f"_b{i}" for i in range(len(by))])


# --------------------------------------------------- word hashes with numpy
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_IS_SEP = np.zeros(256, bool)
_IS_SEP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POW:
        _POW.clear()
        with np.errstate(over="ignore"):
            a = np.full(size, _P, np.uint64)
            b = np.full(size, _PINV, np.uint64)
            a[0] = b[0] = 1
            _POW[size] = np.multiply.accumulate(a), np.multiply.accumulate(b)
    return _POW[size]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every text, in order, and the number of
    words of each text.  Words are byte runs without 0x20, 0x09-0x0D of the
    UTF-8 text; with ``lower``, A-Z count as a-z.  One vectorised pass: a
    prefix sum of byte codes times powers gives each word's polynomial hash.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(b) + 1 for b in raw], dtype=np.int64)
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8)
    sep = _IS_SEP[buf]
    edge = np.diff(sep.astype(np.int8), prepend=1)
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # the last byte separates
    counts = np.diff(np.searchsorted(start, ends), prepend=0)
    if not start.size:
        return np.zeros(0, np.uint64), counts
    if lower:
        buf = _LOWER[buf]
    p, q = _powers(buf.size + 1)
    with np.errstate(over="ignore"):
        c = np.zeros(buf.size + 1, np.uint64)
        np.cumsum(_BYTE[buf] * p[:buf.size], out=c[1:])
        h = (c[stop] - c[start]) * q[start]
        return mix(h + (stop - start).astype(np.uint64)), counts


def text_chunks(texts: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold about ``limit`` characters (at least
    one text each), to bound the arrays of a vectorised pass."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)
