"""Operator 9, quality rules: hard rules on text statistics, then robust
multivariate outliers.  DataFrame functions only.

1. :func:`text_statistics` computes word, symbol, duplicate-line and
   repeated-window counts of each whole text, inside the row.
2. Rows that fail the base rules are rejected.
3. The rest are judged per language and source: their transformed statistic
   vector is compared with a minimum-covariance-determinant (MCD) estimate
   of the group's centre and scatter, and rows beyond a chi-square quantile
   of the Mahalanobis distance are rejected.  A group too small for an
   estimate is judged by that of its language, else of the whole table.

The MCD estimate is reached by concentration steps from several starts; the
one of least determinant is followed until that stops falling.  Each step is
two grouped aggregations over the narrow statistics table (a distance
quantile, then moments of the rows below it), so a source with a third of all
rows costs each task one row per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.arrays import evaluate_once
from textlab.llm.common import SEPARATORS, words_of
from textlab.session import cut_lineage

SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5
FEATURES = 4
SALTS = 32
POOL_SALTS = 512


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_lines`` (lines with a word), ``n_dup_lines`` (of those, equal to an
    earlier one) and ``n_repeat_words`` (words covered by 5-word windows that
    occur twice or more in the text), all long.  Null and empty texts count 0
    everywhere.  The text column is kept.

    Everything is array work on one row: no explode, no shuffle, no Python.
    Windows are compared by a 64-bit hash.  Only a row that has a repeated
    window sorts its windows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SEPARATORS[1:]}"))
    d = evaluate_once(df.select("*", words_of(t).alias("_w"), lines.alias("_l")))
    n = F.size("_w")
    w = F.col("_w")
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))).otherwise(
            F.array().cast("array<bigint>"))
    joined = F.array_join("_w", "")
    d = evaluate_once(d.select(
        *[c for c in d.columns if c not in ("_w", "_l")],
        n.cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(joined, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        hashes.alias("_h")))
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    d = evaluate_once(d.withColumn("_s", F.when(repeated, F.sort_array(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(empty)).drop("_h"))
    s = F.col("_s")
    same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
    hit = F.filter(s, lambda x, j: F.coalesce((j > 0) & same(j - 1, j), F.lit(False))
                   | F.coalesce(same(j, j + 1), F.lit(False)))
    d = evaluate_once(d.withColumn("_p", F.sort_array(F.transform(hit, lambda x: x["i"]))).drop("_s"))
    covered = F.aggregate(
        F.col("_p"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"),
                                (p + WINDOW).alias("end")), lambda acc: acc["n"])
    return d.withColumn("n_repeat_words", covered.cast("long")).drop("_p")


def base_failed(min_words: int = 10, repeat_pct: int = 20) -> Column:
    """The hard rules: too few words, or too many words in repeated windows."""
    return ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > repeat_pct * F.col("n_words")))


def features() -> list[Column]:
    """The transformed statistic vector: log of the mean word length, and
    square roots of the symbol, duplicate-line and repeated-word shares.  Text
    length itself is left out: long documents are not suspect."""
    n, c = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return [F.log(c / n), F.sqrt(F.col("n_symbols") / c),
            F.sqrt(F.col("n_dup_lines") / lines), F.sqrt(F.col("n_repeat_words") / n)]


def chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution function for an even number of dimensions."""
    term, total = 1.0, 1.0
    for k in range(1, p // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(q: float, p: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, p) < q else (lo, mid)
    return (lo + hi) / 2


def _dist2(center: str = "_m", chol: str = "_c") -> Column:
    """Squared Mahalanobis distance by forward substitution with the lower
    Cholesky factor ``_c`` (row-major array of the triangle)."""
    z: list[Column] = []
    for i in range(FEATURES):
        v = F.col(f"_x{i}") - F.get(F.col(center), F.lit(i))
        for j in range(i):
            v = v - F.get(F.col(chol), F.lit(i * (i + 1) // 2 + j)) * z[j]
        z.append(v / F.get(F.col(chol), F.lit(i * (i + 1) // 2 + i)))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _cholesky(df: DataFrame, floor: tuple[float, ...]) -> DataFrame:
    """Moments (``_n``, ``_s{i}``, ``_q{i}{j}`` about ``_o``) to ``_m``,
    ``_c`` and ``_det``, the root of the scatter's determinant.  Each
    feature's variance gets ``floor`` squared added, so a constant feature
    leaves the scatter regular."""
    mean = [F.col(f"_s{i}") / F.col("_n") for i in range(FEATURES)]
    df = df.select("_g", "_start", F.array(*[F.get(F.col("_o"), F.lit(i)) + mean[i]
                                             for i in range(FEATURES)]).alias("_m"),
                   *[(F.col(f"_q{i}{j}") / F.col("_n") - mean[i] * mean[j]
                      + (floor[i] ** 2 if i == j else 0.0)).alias(f"_v{i}{j}")
                     for i in range(FEATURES) for j in range(i + 1)])
    for i in range(FEATURES):
        for j in range(i + 1):
            v = F.col(f"_v{i}{j}")
            for k in range(j):
                v = v - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            v = F.sqrt(F.greatest(v, F.lit(floor[i] ** 2))) if i == j else v / F.col(f"_l{j}{j}")
            df = df.withColumn(f"_l{i}{j}", v)
    det = F.lit(1.0)
    for i in range(FEATURES):
        det = det * F.col(f"_l{i}{i}")
    return df.select("_g", "_start", "_m", F.array(*[F.col(f"_l{i}{j}") for i in range(FEATURES)
                                                     for j in range(i + 1)]).alias("_c"), det.alias("_det"))


def _starts(rows: DataFrame, scale: DataFrame, on: list[str], salted, floor: tuple[float, ...]) -> DataFrame:
    """Three starts for each group from its medians ``_m`` and scales ``_s``,
    in one pass over its rows: no correlation, that of the tanh of the scaled
    features, and that of their spatial signs.  Both damp far rows."""
    z = [(F.col(f"_x{i}") - F.get("_m", F.lit(i))) / F.get("_s", F.lit(i)) for i in range(FEATURES)]
    norm = F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0]))
    r = rows.join(salted(scale), on).select(
        "_g", "_m", "_s", *[F.tanh(v).alias(f"_t{i}") for i, v in enumerate(z)],
        *[F.when(norm > 0, v / norm).otherwise(0.0).alias(f"_u{i}") for i, v in enumerate(z)])
    pairs = [(i, j) for i in range(FEATURES) for j in range(i + 1)]
    shape = r.groupBy("_g").agg(
        F.first("_m").alias("_o"), F.first("_s").alias("_s"), *[F.avg(f"_t{i}").alias(f"_a{i}") for i in range(FEATURES)],
        *[F.avg(F.col(f"_{c}{i}") * F.col(f"_{c}{j}")).alias(f"_{c}{i}{j}") for c in "tu" for i, j in pairs])
    cov = {"t": lambda i, j: F.col(f"_t{i}{j}") - F.col(f"_a{i}") * F.col(f"_a{j}"),
           "u": lambda i, j: F.col(f"_u{i}{j}")}
    tiny = 1e-6  # a constant feature is correlated with none

    def correlation(c: str | None, i: int, j: int) -> Column:
        if i == j or c is None:
            return F.lit(float(i == j))
        return cov[c](i, j) / F.sqrt((cov[c](i, i) + tiny) * (cov[c](j, j) + tiny))

    start = F.explode(F.array(*[F.struct(F.lit(n).alias("_start"), *[
        (F.get("_s", F.lit(i)) * F.get("_s", F.lit(j)) * correlation(c, i, j)).alias(f"_q{i}{j}")
        for i, j in pairs]) for n, c in enumerate((None, "t", "u"))]))
    return _cholesky(shape.select("_g", "_o", start.alias("_e")).select(
        "_g", "_o", "_e.*", F.lit(1.0).alias("_n"), *[F.lit(0.0).alias(f"_s{i}") for i in range(FEATURES)]),
        floor)


def _concentrate(rows: DataFrame, est: DataFrame, on: list[str], salted, coverage: float,
                 floor: tuple[float, ...]) -> DataFrame:
    """One concentration step: mean and scatter of the ``coverage`` share of
    rows nearest to each estimate."""
    by = ["_g", "_start"]
    x = [F.col(f"_x{i}") for i in range(FEATURES)]
    near = rows.join(salted(est), on).select(*by, "_salt", "_m", *x, _dist2().alias("_d2"))
    cut = near.groupBy(*by).agg(F.percentile_approx("_d2", coverage).alias("_cut"))
    inside = near.join(salted(cut), [*on, "_start"]).where(F.col("_d2") <= F.col("_cut"))
    y = [c - F.get("_m", F.lit(i)) for i, c in enumerate(x)]
    return _cholesky(inside.groupBy(*by).agg(
        F.first("_m").alias("_o"), F.count(F.lit(1)).alias("_n"),
        *[F.sum(y[i]).alias(f"_s{i}") for i in range(FEATURES)],
        *[F.sum(y[i] * y[j]).alias(f"_q{i}{j}") for i in range(FEATURES) for j in range(i + 1)]), floor)


def _keys(df: DataFrame, group: list[str]) -> list[Column]:
    """A group key and a salt of the whole row for each pool.  Group tables
    are joined by both, so a large group, also one of copies, spreads over
    tasks; pools are few and large, and get more salts."""
    pools = _pools(group)
    return [F.struct(g.alias("_g"), F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int").alias("_salt"))
            for g, n in zip(pools, [SALTS] + [POOL_SALTS] * (len(pools) - 1))]


def _pools(group: list[str]) -> list[Column]:
    """Group keys from the finest to the whole table: all group columns, then
    all but the last, ..., then none.  Null values form a group of their own."""
    safe = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in group]
    return [F.concat_ws("\x01", F.lit(str(n)), *safe[:n]) for n in range(len(group), -1, -1)]


def robust_distance(df: DataFrame, group: list[str], coverage: float = 0.75, fall: float = 0.01,
                    floor: tuple[float, ...] = (0.05, 0.05, 0.1, 0.1),
                    min_rows: int = 50) -> DataFrame:
    """Adds two squared Mahalanobis distances of ``_x0.._x3`` from an MCD
    centre and scatter.  ``mcd_d2`` is that from the row's own group, or null
    in groups of fewer than ``min_rows`` rows (too few to estimate a scatter
    from).  There ``pooled_d2`` is the distance from the estimate of all rows
    of the smallest pool with ``min_rows`` rows (the group columns without
    the last, and so on) or else of the whole table, however small; it is
    null where ``mcd_d2`` is not.

    Three deterministic starts (:func:`_starts`) about the medians, two
    concentration steps from each, then steps from the one of least
    determinant.  A step keeps the ``coverage`` share of rows nearest to the
    present estimate and re-estimates mean and covariance from those.  A group
    takes further steps while they lower its determinant's root by more than
    the share ``fall``; as the floors bound it from below, all groups end.
    The scatter is scaled to be consistent for normal data.  Null group
    values form a group of their own.  ``df`` must give the same rows each
    time it is read.
    """
    x = [F.col(f"_x{i}") for i in range(FEATURES)]
    keys = _keys(df, group)
    on = ["_g", "_salt"]
    own = F.col("_g").startswith(str(len(group)) + "\x01" if group else "0")
    salted = lambda d: d.withColumn("_salt", F.explode(F.sequence(
        F.lit(0), F.when(own, SALTS - 1).otherwise(POOL_SALTS - 1))))
    rows = df.select(*x, F.explode(F.array(*keys)).alias("_k")).select("_k.*", *x)
    mid = rows.groupBy("_g").agg(
        F.count(F.lit(1)).alias("_size"),
        F.array(*[F.percentile_approx(c, 0.5) for c in x]).alias("_m")).where(
            (F.col("_size") >= min_rows) | (F.col("_g") == "0"))
    dev = rows.join(salted(mid), on).groupBy("_g").agg(
        F.first("_m").alias("_m"),
        *[F.percentile_approx(F.abs(c - F.get("_m", F.lit(i))), 0.5).alias(f"_d{i}")
          for i, c in enumerate(x)])
    scale = cut_lineage(dev.select("_g", "_m", F.array(*[
        F.sqrt(F.pow(1.4826 * F.col(f"_d{i}"), 2) + floor[i] ** 2) for i in range(FEATURES)]).alias("_s")))
    est = cut_lineage(_starts(rows, scale, on, salted, floor))
    for _ in range(2):
        est = cut_lineage(_concentrate(rows, est, on, salted, coverage, floor))
    columns = F.struct("_start", "_m", "_c", "_det")
    est = cut_lineage(est.groupBy("_g").agg(F.min_by(columns, F.struct("_det", "_start")).alias("_e")).select(
        "_g", "_e.*", F.lit(True).alias("_moved")))
    while not est.where("_moved").isEmpty():
        moving = est.where("_moved")
        nearer = _concentrate(rows, moving.drop("_moved"), on, salted, coverage, floor)
        both = est.withColumn("_new", F.lit(False)).unionByName(
            nearer.withColumns({"_moved": F.lit(False), "_new": F.lit(True)}))
        old, new = F.max(F.when(~F.col("_new"), F.col("_det"))), F.max(F.when(F.col("_new"), F.col("_det")))
        est = cut_lineage(both.groupBy("_g").agg(
            F.min_by(columns, F.struct("_det", "_new")).alias("_e"),
            F.coalesce(new < (1 - fall) * old, F.lit(False)).alias("_moved")).select("_g", "_e.*", "_moved"))
    est = est.select("_g", "_m", "_c")
    q = chi2_quantile(coverage, FEATURES)
    consistency = coverage / chi2_cdf(q, FEATURES + 2)
    near_by = salted(est)
    for n, key in enumerate(keys):
        df = df.withColumn("_k", key).select("*", "_k.*").drop("_k").join(near_by, on, "left").withColumn(
            f"_d2_{n}", _dist2() / F.lit(consistency)).drop("_g", "_salt", "_m", "_c")
    pooled = [F.col(f"_d2_{n}") for n in range(1, len(keys))]
    fallback = F.coalesce(*pooled) if pooled else F.lit(None).cast("double")
    return df.withColumn("mcd_d2", F.col("_d2_0")).withColumn(
        "pooled_d2", F.when(F.col("mcd_d2").isNull(), fallback)).drop(
        *[f"_d2_{n}" for n in range(len(keys))], *[f"_x{i}" for i in range(FEATURES)])


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                     group: tuple[str, ...] = ("lang", "source"),
                     quantile: float = 1 - 1e-12, **mcd) -> DataFrame:
    """One row per row of ``docs``: the id, the group columns, the statistics,
    ``base_failed``, ``mcd_d2``, ``pooled_d2`` and ``kept``.

    ``kept`` is false if the base rules fail; else it is false only where the
    robust distance exceeds the ``quantile`` of the chi-square distribution
    (a distance of about 8; shares of clean text have heavier tails than a
    normal distribution, and clean text is to stay).
    Distances of short texts are damped by n / (n + 50) words, because their
    shares vary more.  Null or empty texts fail the base rules (no words);
    very long texts are counted whole, JVM-side.
    Null ids, repeated rows and null group values are judged like any other
    row.  Rows of a group too small for an estimate have no ``mcd_d2`` and are
    judged by ``pooled_d2`` (see :func:`robust_distance`).  An empty table
    gives an empty result.  Other columns of ``docs`` are not carried.
    """
    stats = text_statistics(docs.select(id_col, *group, text), text).drop(text)
    # a number for each row, so that copies under one id get different salts
    stats = cut_lineage(stats.withColumn("base_failed", base_failed()).withColumn(
        "_at", F.monotonically_increasing_id()))
    good = stats.where(~F.col("base_failed")).select(
        "*", *[f.alias(f"_x{i}") for i, f in enumerate(features())])
    damping = F.col("n_words") / (F.col("n_words") + 50)
    judged = robust_distance(good, list(group), **mcd).withColumns(
        {c: F.col(c) * damping for c in ("mcd_d2", "pooled_d2")})
    limit = chi2_quantile(quantile, FEATURES)
    judged = judged.withColumn("kept", F.coalesce("mcd_d2", "pooled_d2") <= limit)
    null = F.lit(None).cast("double")
    failed = stats.where("base_failed").withColumns({"mcd_d2": null, "pooled_d2": null, "kept": F.lit(False)})
    return judged.unionByName(failed).drop("_at")
