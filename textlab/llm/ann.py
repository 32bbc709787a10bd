"""Operator 4, nearest neighbours by a hash-prefix forest (inner product).

Vectors are put on a sphere (one more coordinate makes all norms equal, so
the largest inner product is the smallest angle), and each tree gives a
vector a long string of random-hyperplane bits.  A tree is the sorted array
of its strings.  A query descends every tree to its longest common prefix;
then all trees ascend together, one bit at a time, until enough different
vectors share the prefix somewhere.  These candidates are scored exactly.

The index is split into blocks of bounded size, each with its own forest;
every block answers the stated query set, and a query's block answers are
merged.  Equal vectors are one index entry with its smallest ids, as no more
of them can be among the nearest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TREES, BITS = 128, 32
#: Share of a block's entries to gather before the ascent stops: the price of
#: recall on vectors without clusters (see README for measured recall).
SHARE = 0.5
BLOCK_ROWS, QUERY_ROWS = 8192, 4096
#: Rows hashed and queries walked at a time, to bound the arrays in between.
STEP = 512


def _planes(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim + 1, TREES * BITS))


def bit_strings(x: np.ndarray) -> np.ndarray:
    """(TREES, rows) bit strings as 32-bit numbers, first bit highest."""
    planes, out = _planes(x.shape[1] - 1), np.empty((TREES, len(x)), np.uint64)
    for at in range(0, len(x), STEP):
        bits = np.packbits(x[at:at + STEP] @ planes > 0, axis=1)
        out[:, at:at + STEP] = bits.view(">u4").T
    return out


class Forest:
    """Sorted bit strings of one block's vectors, one array per tree."""

    def __init__(self, vectors: np.ndarray):
        norm2 = (vectors * vectors).sum(axis=1)
        self.top = float(np.sqrt(norm2.max()))
        lift = np.sqrt(np.maximum(0, 1 - norm2 / self.top ** 2))
        strings = bit_strings(np.column_stack([vectors / self.top, lift]))
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)
        self.size = len(vectors)

    def _levels(self, q: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges (level, tree, query) of each prefix length, from 0 down to
        where no query has ``enough`` entries in all trees together, and those
        sums.  Longer prefixes can't hold more."""
        lo, hi = [], []
        for x in range(BITS + 1):
            shift = np.uint64(BITS - x)
            first = (q >> shift) << shift
            lo.append(np.stack([np.searchsorted(s, f, side="left") for s, f in zip(self.sorted, first)]))
            hi.append(np.stack([np.searchsorted(s, f, side="left")
                                for s, f in zip(self.sorted, first + (np.uint64(1) << shift))]))
            if ((hi[-1] - lo[-1]).sum(axis=0) < enough).all():
                break
        lo, hi = np.stack(lo), np.stack(hi)
        return lo, hi, (hi - lo).sum(axis=1)

    def candidates(self, queries: np.ndarray, enough: int):
        """For each query the entries that share its prefix of the common
        length, in any tree, as soon as there are ``enough``."""
        enough = min(enough, self.size)
        strings = bit_strings(np.column_stack([queries / np.linalg.norm(queries, axis=1, keepdims=True),
                                               np.zeros(len(queries))]))
        for at in range(0, len(queries), STEP):
            lo, hi, reach = self._levels(strings[:, at:at + STEP], enough)
            for i in range(reach.shape[1]):
                x = int(np.flatnonzero(reach[:, i] >= enough).max(initial=0))
                while True:
                    seen = np.zeros(self.size, bool)
                    seen[np.concatenate([o[a:b] for o, a, b in zip(self.order, lo[x, :, i], hi[x, :, i])])] = True
                    found = np.flatnonzero(seen)
                    if found.size >= enough or x == 0:
                        break
                    x -= 1  # all trees ascend together
                yield found


def _search(k: int, share: float):
    def run(key, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        cols = {"query_id": [], "vec_id": [], "score": []}
        if len(index) and len(queries):
            x = np.stack(index["_v"].to_numpy()).astype(np.float64)
            q = np.stack(queries["_v"].to_numpy()).astype(np.float64)
            ids = index["_ids"].to_list()
            enough = max(int(np.ceil(share * len(x))), min(len(x), 4 * k))
            for qid, v, found in zip(queries["_id"], q, Forest(x).candidates(q, enough)):
                score = (x[found] * v).sum(axis=1)
                if found.size > k + 1:  # all entries at least as near as the (k + 1)th
                    cut = np.partition(score, found.size - k - 1)[found.size - k - 1]
                    found, score = found[score >= cut], score[score >= cut]
                best = sorted((-s, int(i)) for s, f in zip(score, found) for i in ids[f] if i != qid)[:k]
                cols["query_id"] += [qid] * len(best)
                cols["vec_id"] += [b[1] for b in best]
                cols["score"] += [-b[0] for b in best]
        return pd.DataFrame(cols).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector: str = "embedding",
            share: float = SHARE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (inner
    product in double precision): for each row where ``is_query`` is true, its
    ``k`` nearest other rows that the forest finds, all if there are fewer.

    Nearest first, ties to the smaller id.  Rows with a null id, and vectors
    that are null, empty, zero or hold null or non-finite components, take no
    part as query or candidate.  Vectors of different lengths are not
    compared.  Repeated rows count once; one id with two vectors is two
    candidates and, as a query, searched with each (a neighbour counts at its
    best score).  An empty table gives an empty result;
    texts, however long, are not read.
    """
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), v.alias("_v"),
                          F.coalesce(is_query, F.lit(False)).alias("_q"))
    good = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("_id").isNotNull() & F.coalesce(good, F.lit(False))
                      & F.coalesce(F.exists("_v", lambda c: c != 0), F.lit(False)))
    by_id = W.partitionBy("_v").orderBy("_id")
    entries = rows.select("_v", "_id").distinct().withColumn("_k", F.row_number().over(by_id)).where(
        F.col("_k") <= k + 1).groupBy("_v").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    queries = rows.where("_q").select("_id", "_v").distinct()

    n_blocks = max(1, -(-entries.count() // block_rows))
    n_query = max(1, -(-queries.count() // QUERY_ROWS))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    index = entries.withColumn("_b", dealt("_v", n_blocks)).withColumn("_qb", each(n_query))
    asked = queries.withColumn("_qb", dealt("_id", n_query)).withColumn("_b", each(n_blocks))
    dim = F.size("_v").alias("_dim")
    found = index.select("*", dim).groupBy("_dim", "_b", "_qb").cogroup(
        asked.select("*", dim).groupBy("_dim", "_b", "_qb")).applyInPandas(
        _search(k, share), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
