"""Classification metrics (I1-I11): confusion matrix and the labelled metric
vector (K classes + ``macro`` + ``micro``) for accuracy, precision, recall
and F1.

Scale: the only pass over data-sized input is :func:`confusion`, a
``groupBy(run keys, target, prediction).count()`` whose partial (map-side)
aggregation ships at most ``runs x K^2`` rows per task through the shuffle.
Everything after it works on the tiny confusion table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.arrays import argmax

METRICS = ("accuracy", "precision", "recall", "f1")


def confusion(df: DataFrame, keys: Sequence[str] = (), target: str = "target",
              prediction: str = "prediction") -> DataFrame:
    """Long confusion table ``(keys..., target, prediction, n)``; only
    observed cells are present (densify with :func:`dense_confusion`)."""
    return (df.groupBy(*keys, F.col(target).alias("target"),
                       F.col(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def _only_declared(class_id: str, ids: list[int]) -> Column:
    """The class id, or a runtime error if it is not in the declared list:
    leaving such rows out would change every count."""
    c = F.col(class_id)
    return F.when(c.isin(*ids), c).otherwise(F.raise_error(F.concat(
        F.lit("class id not declared: "), F.coalesce(c.cast("string"), F.lit("null"))))).cast("int")


def dense_confusion(conf: DataFrame, class_ids: Sequence[int],
                    keys: Sequence[str] = ()) -> DataFrame:
    """I1 densified to K x K per run for a declared class list (a literal,
    so the expansion is ``runs x K^2`` rows from a narrow explode).  A class
    id outside the list is an error."""
    known = [int(c) for c in class_ids]
    conf = conf.select(*keys, _only_declared("target", known).alias("target"),
                       _only_declared("prediction", known).alias("prediction"), "n")
    ids = F.array(*[F.lit(int(c)) for c in class_ids])
    runs = conf.groupBy(*keys).count().select(*keys)
    grid = (runs.withColumn("target", F.explode(ids))
            .withColumn("prediction", F.explode(ids)))
    return (grid.join(conf, [*keys, "target", "prediction"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0)).cast("long")))


def _per_class(conf: DataFrame, keys: list[str],
               declared: Sequence[int] | None) -> DataFrame:
    """``(keys..., class_id, true_n, pred_n, tp)``: each confusion cell adds
    to its target class (true_n, tp) and to its predicted class (pred_n);
    one aggregation instead of two plus a full outer join."""
    is_tp = F.col("target") == F.col("prediction")
    z = F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col("target").alias("class_id"), F.col("n").alias("true_n"),
                 z.alias("pred_n"), F.when(is_tp, F.col("n")).otherwise(z).alias("tp")),
        F.struct(F.col("prediction").alias("class_id"), z.alias("true_n"),
                 F.col("n").alias("pred_n"), z.alias("tp")))
    rows = conf.select(*keys, F.explode(roles).alias("r")).select(*keys, "r.*")
    if declared is not None:
        # Declared classes (Q8): every declared class gets a zero row per
        # run (a literal list, so a narrow explode); a class outside the list
        # is an error.
        ids = [int(c) for c in declared]
        zero = conf.select(*keys, F.explode(F.array(*[F.lit(c) for c in ids])).alias("class_id"),
                           z.alias("true_n"), z.alias("pred_n"), z.alias("tp"))
        rows = rows.withColumn("class_id", _only_declared("class_id", ids)).unionByName(zero)
    return rows.groupBy(*keys, "class_id").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("true_n", "pred_n", "tp")])


def _ratio(num: Column, den: Column) -> Column:
    # zero division -> 0 (I9); try_divide keeps ANSI mode happy
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")),
                      F.lit(0.0))


def classification_report(conf: DataFrame, keys: Sequence[str] = (),
                          classes: DataFrame | None = None,
                          labels: str = "observed",
                          declared: Sequence[int] | None = None) -> DataFrame:
    """``(keys..., metric, class_name, value)``.

    * per class c: accuracy = (TP+TN)/N (one-vs-rest), precision = TP/pred_n,
      recall = TP/true_n, F1 = 2TP/(pred_n+true_n); zero division gives 0.
    * ``macro`` = unweighted mean of the class values (macro accuracy is the
      mean of the one-vs-rest accuracies, not balanced accuracy).
    * ``micro`` = pooled counts (share correct for accuracy).

    ``labels='observed'``: class set = union of true and predicted labels;
    ``labels='declared'``: the ``declared`` class-id list, absent classes
    included with zero counts; an id outside the list is an error.  ``classes`` (class_id, class_name) names the
    rows; unnamed ids are shown as their number.

    Plan: the per-class table is gathered per run (K entries, the class
    vocabulary -- not data rows) and all metrics are array arithmetic on
    that one row, so after the confusion count there are two small
    shuffles in total.
    """
    keys = list(keys)
    if labels not in ("observed", "declared"):
        raise ValueError("labels must be 'observed' or 'declared'")
    if labels == "declared" and declared is None:
        raise ValueError("labels='declared' needs the declared class ids")
    pc = _per_class(conf, keys, declared if labels == "declared" else None)
    if classes is not None:
        pc = pc.join(classes.select("class_id", "class_name"), "class_id", "left")
        name = F.coalesce(F.col("class_name"), F.col("class_id").cast("string"))
    else:
        name = F.col("class_id").cast("string")
    pc = pc.select(*keys, F.struct(name.alias("name"), "true_n", "pred_n", "tp").alias("c"))
    run = pc.groupBy(*keys).agg(F.collect_list("c").alias("cs"),
                                F.sum("c.true_n").alias("N"), F.sum("c.pred_n").alias("PN"),
                                F.sum("c.tp").alias("TP"))
    # The per-run metric math is written as SQL expressions: each is one
    # call into the JVM instead of hundreds of column-builder round trips.
    def ratio(num: str, den: str) -> str:
        # zero division -> 0 (I9); try_divide keeps ANSI mode happy
        return f"coalesce(try_divide(cast({num} AS double), cast({den} AS double)), 0D)"

    per = {"accuracy": ratio("N - c.true_n - c.pred_n + 2 * c.tp", "N"),
           "precision": ratio("c.tp", "c.pred_n"),
           "recall": ratio("c.tp", "c.true_n"),
           "f1": ratio("2 * c.tp", "c.pred_n + c.true_n")}
    m_expr = ("transform(cs, c -> named_struct('name', c.name, "
              + ", ".join(f"'{m}', {e}" for m, e in per.items()) + ")) AS m")
    run = run.selectExpr(*keys, "N", "PN", "TP", m_expr)

    def row(metric: str, name: str, value: str) -> str:
        return f"named_struct('metric', '{metric}', 'class_name', {name}, 'value', {value})"

    per_class = ("flatten(transform(m, x -> array("
                 + ", ".join(row(m, "x.name", f"x.{m}") for m in METRICS) + ")))")
    macro = [row(m, "'macro'", f"aggregate(m, 0D, (acc, x) -> acc + x.{m}) / cast(size(m) AS double)")
             for m in METRICS]
    micro = [row("accuracy", "'micro'", ratio("TP", "N")),
             row("precision", "'micro'", ratio("TP", "PN")),
             row("recall", "'micro'", ratio("TP", "N")),
             row("f1", "'micro'", ratio("2 * TP", "PN + N"))]
    out = run.selectExpr(*keys, f"explode(concat({per_class}, array({', '.join(macro + micro)}))) AS r")
    return out.select(*keys, "r.metric", "r.class_name", "r.value")


def multilabel_report(df: DataFrame, id_col: str, true_col: str, pred_col: str,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Multi-label precision / recall / F1 per label, ``macro`` (mean of
    label F1s) and ``micro`` (pooled counts).

    True and predicted label sets are exploded to ``(id, label)`` pairs and
    full-outer-joined on ``(keys, id, label)`` -- a single co-partitioned
    shuffle; each row then adds to TP, FP or FN of its label.
    """
    keys = list(keys)
    t = (df.select(*keys, id_col, F.explode(F.array_distinct(true_col)).alias("label"))
         .withColumn("is_true", F.lit(1)))
    p = (df.select(*keys, id_col, F.explode(F.array_distinct(pred_col)).alias("label"))
         .withColumn("is_pred", F.lit(1)))
    j = t.join(p, [*keys, id_col, "label"], "full_outer")
    it = F.coalesce("is_true", F.lit(0))
    ip = F.coalesce("is_pred", F.lit(0))
    per = j.groupBy(*keys, "label").agg(
        F.sum(it * ip).cast("long").alias("tp"),
        F.sum((1 - it) * ip).cast("long").alias("fp"),
        F.sum(it * (1 - ip)).cast("long").alias("fn"))
    # per run: the label rows (one per distinct label) as one array, metrics
    # as array arithmetic -- per-label, macro and micro rows come from the
    # same row, so the per-label table is computed once
    run = per.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col("label").cast("string").alias("name"), "tp", "fp", "fn"))
        .alias("ls"),
        F.sum("tp").alias("s_tp"), F.sum("fp").alias("s_fp"), F.sum("fn").alias("s_fn"))
    ms = ("precision", "recall", "f1")

    def metrics(x):
        tp, fp, fn = x["tp"], x["fp"], x["fn"]
        return F.struct(x["name"].alias("name"), _ratio(tp, tp + fp).alias("precision"),
                        _ratio(tp, tp + fn).alias("recall"),
                        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))

    run = run.select(*keys, "s_tp", "s_fp", "s_fn", F.transform("ls", metrics).alias("m"))
    k = F.size("m").cast("double")
    stp, sfp, sfn = F.col("s_tp"), F.col("s_fp"), F.col("s_fn")
    def mean_of(field):
        return F.aggregate("m", F.lit(0.0), lambda acc, x: acc + x[field]) / k

    summary = {
        "macro": {m: mean_of(m) for m in ms},
        "micro": {"precision": _ratio(stp, stp + sfp), "recall": _ratio(stp, stp + sfn),
                  "f1": _ratio(2 * stp, 2 * stp + sfp + sfn)}}
    per_label = F.flatten(F.transform("m", lambda x: F.array(*[
        F.struct(F.lit(m).alias("metric"), x["name"].alias("class_name"), x[m].alias("value"))
        for m in ms])))
    extra = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(cn).alias("class_name"),
                               v.alias("value"))
                      for cn, d in summary.items() for m, v in d.items()])
    out = run.select(*keys, F.explode(F.concat(per_label, extra)).alias("r"))
    return out.select(*keys, "r.metric", "r.class_name", "r.value")
