"""Experiment grid, aggregation over seeds and reporting.

All inputs are long metric tables ``(run keys..., metric, class_name,
value)``; run keys are ``task, model, lr, num_epochs, seed``.  The grid is a
literal (a few dozen points), so expanding data over it is a narrow
``explode`` and never a join.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlab.functions.text import capitalize

CFG = ["task", "model", "lr", "num_epochs"]
RUN = CFG + ["seed"]


def grid_points(**params: Sequence) -> list[dict]:
    """The Cartesian product of parameter lists, in declaration order,
    numbered by ``config_no`` (seed excluded from the numbering)."""
    names = list(params)
    out, cfg_no, seen = [], {}, {}
    for combo in itertools.product(*params.values()):
        d = dict(zip(names, combo))
        ck = tuple(v for k, v in d.items() if k != "seed")
        if ck not in seen:
            seen[ck] = len(seen)
        d["config_no"] = seen[ck]
        out.append(d)
    return out


def grid(spark: SparkSession, **params: Sequence) -> DataFrame:
    """E4 as a (tiny, literal) DataFrame."""
    return spark.createDataFrame(grid_points(**params))


def _sql_literal(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def grid_column(points: list[dict]) -> Column:
    """The grid as an array-of-struct literal, for ``explode`` onto data.

    Written as one SQL expression: building it from ``F.lit``/``F.struct``
    would cost one driver-to-JVM round trip per field (seconds for a
    150-point grid); the array is constant-folded either way."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{k}', {_sql_literal(v)}" for k, v in p.items()) + ")"
        for p in points)
    return F.expr(f"array({structs})")


def config_summary(metrics: DataFrame, cfg: Sequence[str] = CFG,
                   class_name: str = "macro",
                   metric_names: Sequence[str] = ("accuracy", "f1")) -> DataFrame:
    """Per configuration, mean and *population* std over seeds of the
    macro metrics (``mean_<m>``, ``std_<m>``, ``n_seeds``)."""
    m = metrics.where((F.col("class_name") == class_name)
                      & F.col("metric").isin(*metric_names))
    aggs = []
    for name in metric_names:
        v = F.when(F.col("metric") == name, F.col("value"))
        aggs += [F.avg(v).alias(f"mean_{name}"), F.stddev_pop(v).alias(f"std_{name}")]
    return m.groupBy(*cfg).agg(*aggs, F.countDistinct("seed").alias("n_seeds"))


def best_config(summary: DataFrame, by: Sequence[str] = ("task", "model"),
                metric: str = "f1", digits: int = 9) -> DataFrame:
    """Per (task, model) the configuration with the highest mean metric.

    Ties (equal after rounding to ``digits``, so the choice does not depend
    on summation order) go to the smaller learning rate, then fewer epochs.
    """
    key = F.struct(F.round(F.col(f"mean_{metric}"), digits), -F.col("lr"),
                   -F.col("num_epochs"))
    best = F.max_by(F.struct("lr", "num_epochs", f"mean_{metric}"), key)
    return (summary.groupBy(*by).agg(best.alias("b"))
            .select(*by, "b.lr", "b.num_epochs", f"b.mean_{metric}"))


def restrict_to(df: DataFrame, best: DataFrame, cfg: Sequence[str] = CFG) -> DataFrame:
    """Keep only rows of the chosen configurations (left-semi join;
    the chosen table has one row per task x model, AQE broadcasts it)."""
    return df.join(best.select(*cfg), list(cfg), "left_semi")


def seed_summary(metrics: DataFrame, cfg: Sequence[str] = CFG,
                 keep: Sequence[str] | None = ("accuracy", "f1")) -> DataFrame:
    """Test-set mean and *sample* std over seeds per metric and
    class, class and metric names capitalised, only ``keep`` metrics (J9),
    configuration and seed count attached (J10)."""
    m = metrics if keep is None else metrics.where(F.col("metric").isin(*keep))
    metric_label = F.when(F.col("metric") == "f1", F.lit("F1")).otherwise(
        capitalize("metric"))
    return (m.groupBy(*cfg, "metric", "class_name")
            .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                 F.countDistinct("seed").alias("n_seeds"))
            .select(*cfg, "n_seeds", metric_label.alias("metric"),
                    capitalize("class_name").alias("class_name"), "mean", "std"))


def seed_table(metrics: DataFrame, seeds: Sequence[int], cfg: Sequence[str] = CFG) -> DataFrame:
    """Per-seed metric vectors aligned by (metric, class) into one wide
    row per configuration x metric x class, one column per seed (for
    display; the long table stays the working format).  The seed values
    are given, so the pivot needs no extra pass to find them."""
    return (metrics.groupBy(*cfg, "metric", "class_name")
            .pivot("seed", list(seeds)).agg(F.first("value")))


def qa_summary(scores: DataFrame, by: Sequence[str] = ("task", "model"),
               compat_contaminated: bool = False) -> DataFrame:
    """QA scores ``(by..., seed, metric, value)`` -> mean, median and
    sample std over seeds.

    ``compat_contaminated`` reproduces the reference's order of operations:
    the median is taken over the seed values plus the mean, and the std over
    the seed values plus mean and median.
    """
    g = scores.groupBy(*by, "metric")
    if not compat_contaminated:
        return g.agg(F.avg("value").alias("mean"), F.median("value").alias("median"),
                     F.stddev_samp("value").alias("std"),
                     F.count("value").alias("n_seeds"))
    vals = g.agg(F.collect_list("value").alias("v"), F.avg("value").alias("mean"),
                 F.count("value").alias("n_seeds"))
    # per-group arrays hold one value per seed (a handful), not data rows
    with_mean = F.concat("v", F.array("mean"))

    def med(a: Column) -> Column:
        s = F.sort_array(a)
        n = F.size(s)
        lo = F.element_at(s, ((n + 1) / 2).cast("int"))
        hi = F.element_at(s, (n / 2 + 1).cast("int"))
        return F.when(n % 2 == 1, lo).otherwise((lo + hi) / 2)

    def sstd(a: Column) -> Column:
        n = F.size(a)
        mean = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / n
        ss = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
        return F.sqrt(ss / (n - 1))

    out = vals.withColumn("median", med(with_mean))
    out = out.withColumn("std", sstd(F.concat("v", F.array("mean", "median"))))
    return out.select(*by, "metric", "mean", "median", "std", "n_seeds")


def compare_models(pred: DataFrame, truth: DataFrame, id_col: str,
                   names: Sequence[str], value: str = "prediction",
                   model_col: str = "model") -> DataFrame:
    """Side-by-side table -- the truth columns plus one column per
    model.  Pivot values are given, so Spark does not scan for them."""
    wide = (pred.groupBy(id_col).pivot(model_col, list(names))
            .agg(F.first(value)))
    return truth.join(wide, id_col, "left")


def leaderboard(summary: DataFrame, metric: str = "F1", class_name: str = "Macro",
                by: str = "task") -> DataFrame:
    """One row per task x model with the chosen summary metric and its
    rank within the task (1 = best; ties share a rank).  The window is
    partitioned by task over the already-aggregated summary rows."""
    s = summary.where((F.col("metric") == metric) & (F.col("class_name") == class_name))
    w = Window.partitionBy(by).orderBy(F.col("mean").desc())
    return s.select(by, "model", "lr", "num_epochs", "mean", "std",
                    F.rank().over(w).alias("rank"))
