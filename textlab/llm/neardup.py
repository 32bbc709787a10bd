"""Operator 5, near-duplicates by HyperMinHash.

Each text becomes the set of its word shingles.  The set's sketch has one
register per bucket: the bucket's smallest hash, stored as its count of
leading zeros plus the mantissa bits behind the leading one.  Bands of
registers are compared by equi-joins; candidate pairs pass a
collision-corrected Jaccard estimate and are then verified on full sets.

Equal sets are one class, and only classes are compared, so a group of exact
copies costs one row.  No step emits all pairs of a band bucket:

1. every bucket member is tested against a bucket centre (several hash orders
   choose different centres in different bands), a linear number of pairs;
2. true links are merged into components;
3. only in buckets whose members are still in different components, the
   remaining pairs *between* components are estimated and verified inside
   blocks of rows, which emit only links that merge components.

Pairs inside a component need no test, as only components are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import mix, text_chunks, word_hashes, written
from textlab.llm.graph import connected_components

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
_ATTEMPTS = 64
_rng = np.random.default_rng(77)
#: For an empty register: the registers to borrow from, in order.
_BORROW = _rng.integers(0, REGISTERS, (REGISTERS, _ATTEMPTS))
_BAND_MUL = _rng.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ADD = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)
_POSITION = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text: ``width`` words,
    or the whole word sequence if shorter, or nothing without words."""
    for lo, hi in text_chunks(texts):
        h, counts = word_hashes(texts[lo:hi])
        stop = np.cumsum(counts)
        with np.errstate(over="ignore"):
            if h.size >= width:
                s = np.zeros(h.size - width + 1, np.uint64)
                for k in range(width):
                    s += h[k:h.size - width + 1 + k] * _POSITION[k % 64]
                s = mix(s)
            for n, end in zip(counts, stop):
                if n >= width:
                    yield np.unique(s[end - n:end - width + 1])
                elif n:
                    part = h[end - n:end] * _POSITION[np.arange(n) % 64]
                    yield mix(part.sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
                else:
                    yield np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16) of a non-empty sorted set: leading
    zeros of the bucket's smallest value, then ``MANTISSA`` bits.  An empty
    register borrows from another by a fixed order, so small sets also get a
    full sketch and equal sets get equal ones."""
    scaled = (shingles >> np.uint64(32)) * np.uint64(REGISTERS)
    bucket = (scaled >> np.uint64(32)).astype(np.int64)  # ascending, as the set is sorted
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    value = (scaled[first] & np.uint64(0xFFFFFFFF)).astype(np.float64) + 1
    fraction, exponent = np.frexp(value)  # value = fraction * 2**exponent, fraction in [0.5, 1)
    zeros = 33 - exponent
    regs = np.full(REGISTERS, -1, np.int64)
    regs[bucket[first]] = (zeros << MANTISSA) | ((fraction - 0.5) * (2 << MANTISSA)).astype(np.int64)
    empty = np.flatnonzero(regs < 0)
    full = regs >= 0
    for a in range(_ATTEMPTS):
        if not empty.size:
            break
        src = _BORROW[empty, a]
        ok = full[src]
        regs[empty[ok]] = regs[src[ok]]
        empty = empty[~ok]
    if empty.size:
        own = np.flatnonzero(full)
        regs[empty] = regs[own[np.searchsorted(own, empty) % own.size]]
    return regs.astype(np.uint16)


def bands(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of registers."""
    with np.errstate(over="ignore"):
        return mix((regs.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_MUL).sum(axis=1, dtype=np.uint64)
                   + _BAND_ADD)


def class_key(shingles: np.ndarray) -> int:
    """64-bit key of a set; equal sets have equal keys."""
    with np.errstate(over="ignore"):
        k = mix(shingles.sum(keepdims=True, dtype=np.uint64)
                ^ mix(mix(shingles).sum(keepdims=True, dtype=np.uint64) + np.uint64(shingles.size)))
    return int(k.astype(np.int64)[0])


def jaccard_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketches (rows): the share of equal
    registers, corrected for registers that are equal by chance.  Two
    different smallest values in a bucket of the same size agree in their
    leading zeros with probability 1/3 and then in the mantissa with
    2**-MANTISSA."""
    chance = 2.0 ** -MANTISSA / 3
    return ((a == b).mean(axis=-1) - chance) / (1 - chance)


def estimate_floor(threshold: float) -> float:
    """The estimate below which a pair can't reach ``threshold``: seven
    standard deviations of the register matches."""
    return threshold - 7 * (threshold * (1 - threshold) / REGISTERS) ** 0.5


def _sketches(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cid, size, regs, keys = [], [], [], []
            for s in shingle_sets(b["_text"].tolist(), width):
                size.append(s.size)
                if s.size:
                    r = sketch(s)
                    cid.append(class_key(s)), regs.append(r.tobytes()), keys.append(bands(r).astype(np.int64))
                else:
                    cid.append(None), regs.append(None), keys.append(None)
            yield pd.DataFrame({"_id": b["_id"], "_cid": pd.array(cid, "Int64"), "_size": size,
                                "_regs": regs, "_bands": keys})
    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cid, sets = [], []
            for s in shingle_sets(b["_text"].tolist(), width):
                if s.size:
                    cid.append(class_key(s)), sets.append(s.tobytes())
            yield pd.DataFrame({"_cid": np.array(cid, np.int64), "_set": sets})
    return run


def _verified(pct: int):
    """Keeps pairs with 100 * intersection >= pct * union on their full sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = np.zeros(len(b), bool)
            for i, (x, y) in enumerate(zip(b["_sa"], b["_sb"])):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.intersect1d(u, v, assume_unique=True).size
                keep[i] = 100 * both >= pct * (u.size + v.size - both)
            yield b.loc[keep, ["a", "b"]]
    return run


def _similar(floor: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x, y = (np.frombuffer(b"".join(b[c]), np.uint16).reshape(len(b), -1) for c in ("_ra", "_rb"))
                yield b.loc[jaccard_estimate(x, y) >= floor, ["a", "b"]]
    return run


def _between_components(pct: int, floor: float):
    """The links of one bucket block between components, on full sets.

    Only members outside the block's largest component are compared: with
    all members of other components that pass the estimate, by an inverted
    index of the block's shingles.  A link merges two components at once, so
    at most one link less than there are members comes out."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, comp = pdf["_cid"].to_numpy(), np.unique(pdf["_comp"].to_numpy(), return_inverse=True)[1]
        regs = np.frombuffer(b"".join(pdf["_regs"]), np.uint16).reshape(len(pdf), -1)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["_set"]]
        size = np.array([x.size for x in sets])
        lo, hi = pdf["_lo"].iloc[0], pdf["_hi"].iloc[0]
        own, main = pdf["_own"].to_numpy(), np.bincount(comp).argmax()
        every = np.concatenate(sets)
        by = np.argsort(every, kind="stable")
        holder, every = np.repeat(np.arange(len(sets)), size)[by], every[by]
        a, b = [], []
        for i in np.flatnonzero(comp != main):
            other = (comp != comp[i]) & (own == (hi if own[i] == lo else lo))
            other = np.flatnonzero(other)
            other = other[jaccard_estimate(regs[i], regs[other]) >= floor]
            if not other.size:
                continue
            first, last = np.searchsorted(every, sets[i], "left"), np.searchsorted(every, sets[i], "right")
            span = last - first
            places = np.repeat(first - np.concatenate([[0], np.cumsum(span)[:-1]]), span) + np.arange(span.sum())
            both = np.bincount(holder[places], minlength=len(sets))[other]
            for j in other[100 * both >= pct * (size[i] + size[other] - both)]:
                if comp[j] != comp[i]:
                    a.append(min(ids[i], ids[j])), b.append(max(ids[i], ids[j]))
                    gone, kept = (comp[i], comp[j]) if comp[j] == main else (comp[j], comp[i])
                    comp[comp == gone] = kept
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5,
                    pct: int = 80, orders: int = 4, block: int = 512) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` (the id column's value),
    ``n_shingles``, ``component_id`` and ``kept``.

    Rows are linked if 100 * |intersection| >= ``pct`` * |union| of their
    distinct ``width``-word shingles (A-Z lower-cased; a shorter text is one
    shingle).  ``component_id`` is the smallest id reachable over links, and
    ``kept`` is true for that id's row.

    Null and empty texts, and texts without words, have an empty set: no
    links, their own id as component, kept.  A row with a null id can link
    others; its component is the smallest non-null id reachable (null if
    none), and it is kept only where that is null.  Repeated rows are judged
    alike, so copies under one id are all kept or all dropped.  Equal sets
    with different texts are one class.  A very long text gives all its
    shingles (one text's set must fit in a task).  An empty table gives an empty
    result.  Other columns are not carried.

    The chance that bands miss a true link is at most (1 - 0.85**5)**32 <
    1e-8 at 0.85, and 4e-6 at 0.8; a group of copies shares many links.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    id_type = dict(src.dtypes)["_id"]
    rows = written(src.mapInPandas(
        _sketches(width), f"_id {id_type}, _cid long, _size long, _regs binary, _bands array<long>"), "sketches")
    members = rows.where(F.col("_cid").isNotNull())
    classes = members.groupBy("_cid").agg(F.min("_id").alias("_rep"), F.min_by("_regs", "_id").alias("_r1"),
                                          F.min("_regs").alias("_r2"), F.min("_bands").alias("_bands"))
    classes = written(classes.select("_cid", "_rep", F.coalesce("_r1", "_r2").alias("_regs"), "_bands"), "classes")

    keys = classes.select("_cid", F.posexplode("_bands").alias("_j", "_key"))
    order = F.xxhash64("_cid", F.col("_j") % orders)
    shared = keys.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(order.alias("o"), "_cid"))["_cid"].alias("_center")
    ).where(F.col("_n") > 1)
    shared = written(keys.join(shared, "_key").select("_key", "_n", "_center", "_cid"), "buckets")

    floor = estimate_floor(pct / 100)
    star = shared.where(F.col("_center") != F.col("_cid")).select(
        F.least("_center", "_cid").alias("a"), F.greatest("_center", "_cid").alias("b")).distinct()
    regs = classes.select("_cid", "_regs")
    star = (star.join(regs.toDF("a", "_ra"), "a").join(regs.toDF("b", "_rb"), "b")
            .mapInPandas(_similar(floor), "a long, b long"))

    # full sets of the classes that share a bucket with another
    reps = shared.select("_cid").distinct().join(classes, "_cid").select(F.col("_rep").alias("_id")).distinct()
    texts = src.join(reps, src["_id"].eqNullSafe(reps["_id"]), "left_semi")  # null: any row without an id
    sets = texts.mapInPandas(_sets(width), "_cid long, _set binary").dropDuplicates(["_cid"])
    sets = written(sets, "sets")

    links = written(star.join(sets.toDF("a", "_sa"), "a").join(sets.toDF("b", "_sb"), "b")
                    .mapInPandas(_verified(pct), "a long, b long"), "links")
    comp = connected_components(links)

    labelled = shared.where(F.col("_n") > 2).join(comp, F.col("_cid") == F.col("id"), "left").select(
        "_key", "_n", "_cid", F.coalesce("root", "_cid").alias("_comp"))
    mixed = labelled.groupBy("_key").agg(F.min("_comp").alias("_x"), F.max("_comp").alias("_y")).where(
        F.col("_x") != F.col("_y")).select("_key")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64("_cid"), blocks).cast("int")
    rest = (labelled.join(mixed, "_key").join(regs, "_cid").join(sets, "_cid").withColumn("_own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("_lo", F.least("_own", "_other")).withColumn("_hi", F.greatest("_own", "_other")))
    more = rest.groupBy("_key", "_lo", "_hi").applyInPandas(
        _between_components(pct, floor), "a long, b long").distinct()
    root = connected_components(comp.select(F.col("id").alias("a"), F.col("root").alias("b")).union(more))

    full = rows.select("_id", "_cid", "_size").join(
        classes.select("_cid", "_rep"), "_cid", "left").join(root, F.col("_cid") == F.col("id"), "left").select(
        "_id", "_size", "_cid", "_rep", F.coalesce("root", "_cid").alias("_root"))
    smallest = full.where(F.col("_cid").isNotNull()).groupBy("_root").agg(F.min("_rep").alias("_least"))
    out = full.join(smallest, "_root", "left")
    component = F.when(F.col("_cid").isNull(), F.col("_id")).otherwise(F.col("_least"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_size").alias("n_shingles"),
                      component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))
