"""SQuAD v1.1 metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.text import multiset_overlap, normalize_answer, split_ws


def _f1(p_toks: Column, g_toks: Column) -> Column:
    common = multiset_overlap(p_toks, g_toks)
    prec = common / F.size(p_toks)
    rec = common / F.size(g_toks)
    return F.when(common == 0, F.lit(0.0)).otherwise((2 * prec * rec) / (prec + rec))


def example_scores(pred: DataFrame, examples: DataFrame, lowercase: bool = False,
                   first_gold_only: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """H1-H4 per example: ``(keys..., id, exact_match, f1)`` as 0/1 and
    0..1, the best over the gold texts.

    ``pred``: ``keys..., example_id, prediction_text``; ``examples``: ``id,
    answers``.  ``lowercase`` lower-cases prediction and gold first (D12);
    ``first_gold_only`` keeps only the first gold text (H4).  One row per
    prediction of an example; predictions of unknown ids are not scored.
    """
    gold = F.col("answers.text")
    if first_gold_only:
        gold = F.slice(gold, 1, 1)
    ex = examples.select(F.col("id").alias("example_id"), gold.alias("_gold"))
    j = pred.join(ex, "example_id")
    p = F.col("prediction_text")
    if lowercase:
        p = F.lower(p)
        j = j.withColumn("_gold", F.transform("_gold", lambda g: F.lower(g)))
    pn = normalize_answer(p)
    j = j.withColumn("_pn", pn).withColumn("_pt", split_ws("_pn"))
    em = F.array_max(F.transform("_gold", lambda g: F.when(
        normalize_answer(g) == F.col("_pn"), F.lit(1.0)).otherwise(F.lit(0.0))))
    f1 = F.array_max(F.transform("_gold", lambda g: _f1(F.col("_pt"),
                                                         split_ws(normalize_answer(g)))))
    return j.select(*keys, F.col("example_id").alias("id"),
                    F.coalesce(em, F.lit(0.0)).alias("exact_match"),
                    F.coalesce(f1, F.lit(0.0)).alias("f1"))


def squad_scores(pred: DataFrame, examples: DataFrame, lowercase: bool = False,
                 first_gold_only: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """H5: ``(keys..., exact_match, f1, n)`` -- means over *all* examples x
    100 for every run in ``pred``; ``n`` is the number of examples.  An
    example that has no prediction (or no gold text) scores 0, so the sums
    over the predictions are divided by the number of examples."""
    s = example_scores(pred, examples, lowercase, first_gold_only, keys)
    n = examples.agg(F.count(F.lit(1))).scalar()
    g = s.groupBy(*keys).agg(F.sum("exact_match").alias("_em"), F.sum("f1").alias("_f1"))
    return g.withColumn("n", n).select(
        *keys, F.try_divide(F.col("_em") * 100, F.col("n")).alias("exact_match"),
        F.try_divide(F.col("_f1") * 100, F.col("n")).alias("f1"), "n")
