"""Array column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(logits) -> Column:
    """0-based index of the largest element; the first index wins ties.

    Null for an empty or null array.  NaN counts as the largest value, the
    same convention as a tensor arg-max.
    """
    l = _c(logits)
    return (F.array_position(l, F.array_max(l)) - F.lit(1)).cast("int")


def as_double_array(c) -> Column:
    """float32 array -> double array, so arithmetic matches other engines."""
    return F.transform(_c(c), lambda x: x.cast("double"))


def top_k_indices(values, k: int) -> Column:
    """Indices of the k largest elements, largest first, lower index first
    on ties.  NaN counts as the largest value (as in an ascending argsort
    read from the end), nulls rank last.  One sort per row: no shuffle, no
    explode."""
    v = _c(values)
    keyed = F.transform(v, lambda x, i: F.struct(
        x.isNull().alias("n"), (~F.isnan(x.cast("double"))).alias("nn"),
        (-x.cast("double")).alias("k"), i.alias("i")))
    # sort_array uses a direct type ordering; array_sort without a comparator
    # would call an interpreted lambda for every comparison
    return F.transform(F.slice(F.sort_array(keyed), 1, k), lambda s: s["i"])


def evaluate_once(df):
    """Plan barrier: columns computed above this point are referenced, not
    re-inlined, by later projections.

    Catalyst collapses adjacent projections and would copy an expensive
    column (e.g. a per-row word set) into a higher-order function's lambda,
    evaluating it once per array element.  A one-element ``explode`` is a
    Generate node, which projections are not collapsed through; it costs
    one row copy.
    """
    return df.withColumn("_once", F.explode(F.array(F.lit(0)))).drop("_once")


def with_top_k(df, specs: dict, k: int):
    """Add, for each ``out -> values`` in ``specs``, the column ``out`` with
    the same indices as :func:`top_k_indices` (largest first, lower index on
    ties, NaN largest, nulls last), computed without sorting structs:

    1. the k-th largest value ``t`` from a primitive ascending sort,
    2. the indices with a value of at least ``t``, the one pass over all
       values (all indices, if fewer than k values are not null),
    3. of these, the indices above ``t`` (fewer than k; only these get a
       small struct sort),
    4. then the indices equal to ``t`` in index order, cut at k.

    ``t``, the index range and the candidates sit behind plan barriers so the
    filter lambdas reference them instead of re-sorting per element.
    """
    pre, few = [], []
    for out, col in specs.items():
        v = _c(col)
        n = F.size(v)
        # nulls first: the place of the k-th largest, before the array if it is shorter
        pre += [F.get(F.sort_array(v), n - k).alias(f"_t_{out}"),
                F.when(n > 0, F.sequence(F.lit(0), n - 1))
                .otherwise(F.array().cast("array<int>")).alias(f"_i_{out}")]
        t, idx = F.col(f"_t_{out}"), F.col(f"_i_{out}")
        few.append(F.when(t.isNull(), idx).otherwise(F.filter(idx, lambda i: F.get(v, i) >= t)).alias(f"_c_{out}"))
    df = evaluate_once(df.select("*", *pre))
    df = evaluate_once(df.select("*", *few))
    outs = []
    for out, col in specs.items():
        v, t, idx = _c(col), F.col(f"_t_{out}"), F.col(f"_c_{out}")
        above = F.when(t.isNull(), F.filter(idx, lambda i: F.get(v, i).isNotNull())).otherwise(
            F.filter(idx, lambda i: F.get(v, i) > t))
        ties = F.when(t.isNull(), F.filter(idx, lambda i: F.get(v, i).isNull())).otherwise(
            F.filter(idx, lambda i: F.get(v, i) == t))
        ordered = F.transform(F.sort_array(F.transform(above, lambda i: F.struct(
            (~F.isnan(F.get(v, i).cast("double"))).alias("nn"),
            (-F.get(v, i).cast("double")).alias("k"), i.alias("i")))), lambda s: s["i"])
        outs.append(F.slice(F.concat(ordered, ties), 1, k).alias(out))
    drop = [c for out in specs for c in (f"_t_{out}", f"_i_{out}", f"_c_{out}")]
    return df.select("*", *outs).drop(*drop)
