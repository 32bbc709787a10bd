"""Training and scoring re-aimed at Spark.

F1(a) is a multinomial naive Bayes classifier written as joins and grouped
counts, so every grid point (smoothing alpha) trains and predicts in one
job and the result is checkable with plain SQL.  F1(b) is logistic regression
on hashed features, all grid points in the same gradient sums.  F2 / F6 score a table with
user-supplied models in Arrow batches (``mapInPandas``): the model is
loaded once per Python worker, never per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.arrays import evaluate_once
from textlab.functions.text import WORD_CLASS
from textlab.session import cut_lineage


def doc_words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, word, cnt)``: lower-cased word counts per document, counted
    per document before any join (pre-aggregation)."""
    w = df.select(id_col, F.explode(F.regexp_extract_all(
        F.lower(F.col(text_col)), F.lit(f"[{WORD_CLASS}]+"), 0)).alias("word"))
    return w.groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("cnt"))


def train_nb(train: DataFrame, id_col: str, text_col: str, label_col: str,
             classes: Sequence[int], alphas: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """F1(a): multinomial naive Bayes for every smoothing value in
    ``alphas``.  Returns ``(log_likelihood, log_prior)``:

    * ``log_likelihood(alpha, word, class_id, lp)`` with
      ``lp = ln((n_wc + alpha) / (n_c + alpha * V))`` for every training
      word and declared class (word x class x alpha is a narrow explode of
      literal lists);
    * ``log_prior(alpha, class_id, prior)`` = ln(docs_c / docs).

    The vocabulary size V and the document count are scalar subqueries:
    nothing reaches the driver.
    """
    labelled = train.select(id_col, text_col, F.col(label_col).cast("int").alias("class_id"))
    wc = doc_words(labelled, id_col, text_col).join(labelled.select(id_col, "class_id"), id_col)
    # the fitted sufficient statistics are materialised once (reliable
    # checkpoint): the scalars below and the likelihood table all read them
    n_wc = cut_lineage(wc.groupBy("word", "class_id").agg(F.sum("cnt").alias("n_wc")))
    n_c = n_wc.groupBy("class_id").agg(F.sum("n_wc").alias("n_c"))
    vocab = n_wc.select("word").distinct()
    v_size = vocab.agg(F.count(F.lit(1)).cast("double")).scalar()
    n_docs = labelled.agg(F.count(F.lit(1)).cast("double")).scalar()
    cls = F.array(*[F.lit(int(c)) for c in classes])
    al = F.array(*[F.lit(float(x)) for x in alphas])
    dense = (vocab.select("word", F.explode(cls).alias("class_id"))
             .join(n_wc, ["word", "class_id"], "left")
             .join(n_c, "class_id", "left")
             .select("word", "class_id", F.coalesce("n_wc", F.lit(0)).alias("n_wc"),
                     F.coalesce("n_c", F.lit(0)).alias("n_c"),
                     F.explode(al).alias("alpha")))
    ll = dense.select("alpha", "word", "class_id", F.ln(
        (F.col("n_wc") + F.col("alpha"))
        / (F.col("n_c") + F.col("alpha") * v_size)).alias("lp"))
    per_c = labelled.groupBy("class_id").agg(F.count(F.lit(1)).alias("d_c"))
    prior = (per_c.select(F.explode(al).alias("alpha"), "class_id",
                          F.ln(F.col("d_c") / n_docs).alias("prior")))
    return ll, prior


def predict_nb(test: DataFrame, id_col: str, text_col: str, ll: DataFrame,
               prior: DataFrame, classes: Sequence[int],
               alphas: Sequence[float]) -> DataFrame:
    """F1(a) scoring: ``(alpha, id, prediction, score)`` with score =
    prior + sum(cnt * lp) over known words; ties go to the lower class id;
    unknown words are ignored.  The pre-aggregated (doc, word) counts join
    the likelihood table on ``word`` (AQE splits a skewed hot word)."""
    dw = doc_words(test, id_col, text_col)
    s = (dw.join(ll, "word")
         .groupBy("alpha", id_col, "class_id").agg(F.sum(F.col("cnt") * F.col("lp")).alias("ll")))
    # every (alpha, doc, class) gets a score, also documents without a
    # known word (literal lists: narrow explodes, no join)
    base = test.select(id_col, F.explode(F.array(*[F.lit(float(x)) for x in alphas])).alias("alpha"))
    base = base.select("alpha", id_col, F.explode(F.array(*[F.lit(int(c)) for c in classes]))
                       .alias("class_id"))
    sc = (base.join(prior, ["alpha", "class_id"], "left")
          .join(s, ["alpha", id_col, "class_id"], "left")
          .select("alpha", id_col, "class_id",
                  (F.coalesce("prior", F.lit(0.0)) + F.coalesce("ll", F.lit(0.0))).alias("score")))
    best = F.max_by(F.struct("class_id", "score"), F.struct("score", -F.col("class_id")))
    return (sc.groupBy("alpha", id_col).agg(best.alias("b"))
            .select("alpha", id_col, F.col("b.class_id").alias("prediction"),
                    F.col("b.score").alias("score")))


def hash_number(*parts) -> Column:
    """A non-negative number from an MD5 of the parts joined by ':' (the same
    in every engine): folds and bootstrap weights that need no state."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def nb_grid(data: DataFrame, id_col: str, text_col: str, label_col: str, fold_col: str, classes: Sequence[int],
            alphas: Sequence[float], min_dfs: Sequence[int], seeds: Sequence[int]) -> DataFrame:
    """F1(a) over a whole grid: naive Bayes for every smoothing value, minimum
    document frequency and seed, trained on the rows of fold ``train`` and
    applied to all others.  Returns ``(fold, alpha, min_df, seed, id, target,
    prediction)``.

    A seed draws a bootstrap: it counts each training row 0, 1 or 2 times, by
    a hash of seed and id, drawn once a row.  Texts are read once and become
    (id, word, count) rows that carry class, fold and draws.  Training
    statistics are one row per word with columns for the seeds, so the words
    are counted, joined and added up once for all grid points, never once a
    seed.  Ties go to the smaller class.
    """
    each = range(len(seeds))
    # two bits a seed, 31 seeds a column: plain numbers are cheap to group by
    packed = [f"_draws{j}" for j in range(-(-len(seeds) // 31))]
    draw = lambda s: F.shiftleft(hash_number(F.lit(int(seeds[s])), F.col(id_col)) % 3, 2 * (s % 31))
    draws = [F.when(F.col(fold_col) == "train", reduce(Column.__add__, [draw(s) for s in each if s // 31 == j])).alias(x)
             for j, x in enumerate(packed)]
    drawn = lambda s: F.shiftright(packed[s // 31], 2 * (s % 31)).bitwiseAND(F.lit(3))
    rows = data.select(id_col, F.col(label_col).cast("int").alias("_y"), F.col(fold_col).alias("_f"), *draws)
    # the barrier keeps the hashes below the explode: once a text, not once a word
    w = evaluate_once(data.select(id_col, F.col(label_col).cast("int").alias("_y"), F.col(fold_col).alias("_f"), *draws, text_col))
    w = w.select(id_col, "_y", "_f", *packed, F.explode(
        F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(f"[{WORD_CLASS}]+"), 0)).alias("word"))
    w = cut_lineage(w.groupBy(id_col, "_y", "_f", *packed, "word").agg(F.count(F.lit(1)).alias("cnt")))
    stats = cut_lineage(w.where(F.col("_f") == "train").groupBy("word").agg(
        *[F.sum(F.when(F.col("_y") == c, F.col("cnt") * drawn(s)).otherwise(0)).alias(f"n{s}_{c}") for s in each for c in classes],
        *[F.count(F.when(drawn(s) > 0, 1)).alias(f"df{s}") for s in each]))
    points = [(a, m) for a in alphas for m in min_dfs]
    known = lambda s, m: F.col(f"df{s}") >= max(m, 1)
    sums = stats.agg(F.struct(
        *[F.sum(F.when(known(s, m), F.col(f"n{s}_{c}")).otherwise(0)).alias(f"N{s}_{c}_{m}") for s in each for c in classes for m in min_dfs],
        *[F.count(F.when(known(s, m), 1)).alias(f"V{s}_{m}") for s in each for m in min_dfs])).scalar()
    total = lambda x: F.col(f"_sums.{x}")
    table = evaluate_once(stats.select("*", sums.alias("_sums"))).select("word", *[F.coalesce(F.when(known(s, m), F.ln(
        (F.col(f"n{s}_{c}") + a) / (total(f"N{s}_{c}_{m}") + a * total(f"V{s}_{m}")))), F.lit(0.0)).alias(f"p{s}_{k}_{c}")
        for s in each for k, (a, m) in enumerate(points) for c in classes])
    texts = w.where(F.col("_f") != "train").select(id_col, "word", "cnt")
    score = texts.join(table, "word").groupBy(id_col).agg(*[
        F.sum(F.col("cnt") * F.col(x)).alias(x) for x in table.columns if x != "word"])
    prior = rows.where(F.col("_f") == "train").agg(F.struct(*[F.ln(F.try_divide(
        F.sum(F.when(F.col("_y") == c, drawn(s)).otherwise(0)), F.sum(drawn(s)))).alias(f"prior{s}_{c}")
        for s in each for c in classes])).scalar()
    others = rows.where(F.col("_f") != "train").select(id_col, F.col("_y").alias("target"), F.col("_f").alias("fold"))

    def best(s: int, k: int) -> Column:
        options = F.array(*[F.struct(
            (F.coalesce(F.col(f"_prior.prior{s}_{c}"), F.lit(0.0)) + F.coalesce(F.col(f"p{s}_{k}_{c}"), F.lit(0.0))).alias("s"),
            F.lit(-c).alias("c")) for c in classes])
        return (-F.array_max(options)["c"]).cast("int")

    grid = F.explode(F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.lit(int(m)).alias("min_df"), F.lit(int(seed)).alias("seed"),
                                        best(s, k).alias("prediction")) for s, seed in enumerate(seeds) for k, (a, m) in enumerate(points)]))
    scored = evaluate_once(others.join(score, id_col, "left").select("*", prior.alias("_prior")))
    return scored.select("fold", id_col, "target", grid.alias("g")).select(
        "fold", "g.alpha", "g.min_df", "g.seed", id_col, "target", "g.prediction")


def hashed_tfidf(df: DataFrame, id_col: str, text_col: str, fitted_on: Column, num_features: int = 1 << 16) -> DataFrame:
    """Adds ``idx`` and ``val``: each text's hashed word features (ascending)
    and their unit-length TF-IDF values, with the intercept as feature
    ``num_features`` of value 1 behind them.  Document frequencies, ln((n + 1)
    / (df + 1)), come from the rows where ``fitted_on`` holds.  Features are
    hashed, so no vocabulary reaches the driver and the frequency table has at
    most ``num_features`` rows.  Ids must be unique; a text without words has
    the intercept alone."""
    words = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(f"[{WORD_CLASS}]+"), 0)).alias("_word")
    tf = df.select(id_col, fitted_on.alias("_fit"), words).withColumn(
        "_f", (hash_number(F.col("_word")) % num_features).cast("int"))
    tf = cut_lineage(tf.groupBy(id_col, "_fit", "_f").agg(F.count(F.lit(1)).alias("_tf")))
    n = df.where(fitted_on).agg(F.count(F.lit(1))).scalar()
    seen = tf.groupBy("_f").agg(F.count_if("_fit").alias("_df"))
    x = tf.join(seen.select("_f", F.ln((n + 1) / (F.col("_df") + 1)).alias("_idf")), "_f")
    x = x.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(  # one text's distinct features
        "_f", (F.col("_tf") * F.col("_idf")).alias("x")))).alias("_x"))
    x = x.withColumn("_norm", F.sqrt(F.aggregate("_x", F.lit(0.0), lambda a, e: a + e["x"] * e["x"])))
    unit = F.transform("_x", lambda e: F.when(F.col("_norm") > 0, e["x"] / F.col("_norm")).otherwise(0.0))
    x = x.select(id_col, F.transform("_x", lambda e: e["_f"]).alias("_i"), unit.alias("_v"))
    none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>"))
    return df.join(x, id_col, "left").withColumns({
        "idx": F.concat(none("_i", "int"), F.array(F.lit(num_features))),
        "val": F.concat(none("_v", "double"), F.array(F.lit(1.0)))}).drop("_i", "_v")


def _margins(pdf: pd.DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat (row, feature, value) of a batch and its margins, rows by grid."""
    sizes = pdf["idx"].map(len).to_numpy()
    row, idx, val = np.repeat(np.arange(len(pdf)), sizes), np.concatenate(pdf["idx"].to_list()), np.concatenate(pdf["val"].to_list())
    starts = np.cumsum(sizes) - sizes  # every row has the intercept
    return row, idx, val, np.add.reduceat(weights[idx] * val[:, None], starts, axis=0)


def _gradient(weights):
    """Batches of (idx, val, label) to one row per feature seen by the task:
    its gradient sums of all grid points."""
    def run(batches):
        w, total = weights.value, None
        for pdf in batches:
            if len(pdf):
                row, idx, val, m = _margins(pdf, w)
                r = 1.0 / (1.0 + np.exp(-m)) - pdf["label"].to_numpy(np.float64)[:, None]
                total = np.zeros_like(w) if total is None else total
                for k in range(w.shape[1]):
                    total[:, k] += np.bincount(idx, val * r[row, k], w.shape[0])
        if total is not None:
            seen = np.flatnonzero(total.any(axis=1))
            yield pd.DataFrame({"feature": seen.astype(np.int32), **{f"g{k}": total[seen, k] for k in range(total.shape[1])}})
    return run


def train_logreg(train: DataFrame, label_col: str, reg_params: Sequence[float] = (0.0, 0.01),
                 max_iters: Sequence[int] = (20,), num_features: int = 1 << 16) -> dict[tuple[float, int], np.ndarray]:
    """F1(b): logistic regression for every ``reg_param`` (L2, intercept
    free) and ``max_iter``, all grid points in the same jobs: weights by
    (reg_param, max_iter).

    A step is one job: each task adds up the gradients of all grid points
    over its rows, Spark adds up the tasks' sums by feature, and the weights
    (``num_features`` x reg_params numbers, however many rows there are) go
    out again.  Accelerated gradient steps of fixed size 1 / (0.5 + reg_param):
    rows have unit length besides the intercept, so 0.5 bounds the curvature.
    ``max_iters`` are snapshots of one path.
    """
    x = cut_lineage(train.select("idx", "val", F.col(label_col).cast("int").alias("label")))
    n, sc = x.count(), train.sparkSession.sparkContext
    reg = np.array(reg_params, np.float64)
    decay = np.repeat(reg[None, :], num_features + 1, axis=0)
    decay[num_features] = 0.0
    w = v = np.zeros((num_features + 1, reg.size))
    sums, out = [F.sum(f"g{k}").alias(f"g{k}") for k in range(reg.size)], {}
    schema = "feature int, " + ", ".join(f"g{k} double" for k in range(reg.size))
    for t in range(max(max_iters) if n else 0):
        shipped = sc.broadcast(v)
        rows = x.mapInPandas(_gradient(shipped), schema).groupBy("feature").agg(*sums).toPandas()
        g = np.zeros_like(v)
        g[rows["feature"].to_numpy()] = rows[[f"g{k}" for k in range(reg.size)]].to_numpy()
        new = v - (g / n + decay * v) / (0.5 + reg)
        v, w = new + t / (t + 3.0) * (new - w), new
        shipped.unpersist()
        if t + 1 in max_iters:
            out.update({(float(r), t + 1): w[:, k] for k, r in enumerate(reg_params)})
    return out or {(float(r), m): w[:, k] for k, r in enumerate(reg_params) for m in max_iters}


def predict_logreg(models: dict[tuple[float, int], np.ndarray], test: DataFrame, id_col: str) -> DataFrame:
    """F1(b) scoring: ``(reg_param, max_iter, id, prediction)`` of every grid
    point, in one pass (1 where the margin is positive)."""
    grid = list(models)
    shipped = test.sparkSession.sparkContext.broadcast(np.stack([models[g] for g in grid], axis=1))

    def run(batches):
        for pdf in batches:
            if len(pdf):
                m = _margins(pdf, shipped.value)[3]
                yield pd.DataFrame({
                    "reg_param": np.tile([g[0] for g in grid], len(pdf)), "max_iter": np.tile([g[1] for g in grid], len(pdf)),
                    id_col: pdf[id_col].repeat(len(grid)).to_numpy(), "prediction": (m > 0).astype(np.int32).ravel()})

    kind = dict(test.dtypes)[id_col]
    return test.select(id_col, "idx", "val").mapInPandas(
        run, f"reg_param double, max_iter int, {id_col} {kind}, prediction int")


def score_with(df: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame],
               schema: str, columns: Sequence[str] | None = None) -> DataFrame:
    """F2 / L1: batch scoring with a user function over pandas batches
    (``mapInPandas``).  This is the only pandas interchange (A11): Arrow
    batches inside tasks, never ``toPandas`` on the driver.  Project the needed ``columns`` first: a Python step
    is an optimizer barrier, so pruning must happen before it."""
    src = df.select(*columns) if columns else df

    def run(it):
        for pdf in it:
            yield scorer(pdf)

    return src.mapInPandas(run, schema)


def score_models(df: DataFrame, scorers: dict[str, Callable[[pd.DataFrame], pd.DataFrame]],
                 schema: str, columns: Sequence[str] | None = None) -> DataFrame:
    """several named models over one table -> ``unionByName`` of
    ``(model, ...)``."""
    out = None
    for name, fn in scorers.items():
        part = score_with(df, fn, schema, columns).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def batched_map(df: DataFrame, fn: Callable[..., dict], schema: str, fn_kwargs: dict | None = None,
                columns: Sequence[str] | None = None, remove_columns: Sequence[str] | None = None) -> DataFrame:
    """L1 / L2: ``fn(batch, **fn_kwargs)`` over Arrow batches.  A batch is a
    dict of column lists, and so is what comes back; it may have any number of
    rows.  ``schema`` are the new columns.  With ``remove_columns`` None all
    source columns go (the number of rows may change); otherwise those named
    go, the others stay beside the new ones, and the number must not change.
    ``columns`` are the source columns that ``fn`` reads (all by default)."""
    import pyarrow as pa
    from pyspark.sql.types import StructType

    kwargs, src = dict(fn_kwargs or {}), df.select(*columns) if columns and remove_columns is None else df
    keep = [] if remove_columns is None else [c for c in df.columns if c not in set(remove_columns)]
    new = StructType.fromDDL(schema)
    out = StructType([*[df.schema[c] for c in keep if c not in new.names], *new.fields])
    keep, names = [c for c in keep if c not in new.names], new.names

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for b in batches:
            got = fn(b.to_pydict(), **kwargs)
            arrays = [b.column(b.schema.get_field_index(c)) for c in keep]
            arrays += [pa.array(got[c], target.field(c).type) for c in names]
            if len({len(a) for a in arrays}) > 1:
                raise ValueError("the columns of a mapped batch differ in length")
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return src.mapInArrow(run, out)
