"""A fitted span model, stored as a table and loaded once a worker.

Each position of a window's sequence has a feature number (is the token, its
left or right neighbour a question word; word or symbol; length); the model
gives each feature a start and an end logit, counted from labelled windows.
Scoring runs in Arrow batches of padded windows (``predict_batch_udf``): one
call gives the start and the end logits of a batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.functions.arrays import evaluate_once
from textlab.functions.text import WORD_CLASS
from textlab.session import cut_lineage

#: Features of context tokens are below CLS_FEATURE; other positions have none.
LONGEST, CLS_FEATURE, NO_FEATURE = 15, 256, 257
#: Smoothing of the counts, and the logit of positions without a feature.
SMOOTH, NEVER = 0.01, -100.0


def token_features(w: DataFrame, max_length: int = 384, out: str = "features") -> DataFrame:
    """Adds ``out``: the feature number of every position of the padded
    sequence (``max_length`` ints) of windows that carry ``q_tok``,
    ``ctx_tok``, ``ctx_lo`` and ``w_len``."""
    word = f"^[{WORD_CLASS}]+$"
    w = evaluate_once(w.withColumn("_qw", F.array_distinct(F.transform(
        F.filter("q_tok.tok", lambda t: t.rlike(word)), lambda t: F.lower(t)))))
    w = evaluate_once(w.withColumn("_m", F.transform(
        "ctx_tok", lambda t: F.array_contains("_qw", F.lower(t)).cast("int"))))
    m = lambda i: F.coalesce(F.get("_m", i), F.lit(0))
    each = F.transform("ctx_tok", lambda t, i: (
        (((m(i) * 2 + m(i - 1)) * 2 + m(i + 1)) * 2 + t.rlike(word).cast("int")) * (LONGEST + 1)
        + F.least(F.length(t), F.lit(LONGEST))))
    none = lambda n: F.array_repeat(F.lit(NO_FEATURE), n)
    lo = F.col("ctx_lo")
    return evaluate_once(w.withColumn(out, F.concat(F.array(F.lit(CLS_FEATURE)), none(lo - 1), each, none(
        F.lit(max_length) - lo - F.col("w_len"))))).drop("_qw", "_m")


def fit_span_model(w: DataFrame) -> DataFrame:
    """``(feature, start_logit, end_logit)`` from windows with ``features``,
    ``start_position`` and ``end_position``: the smoothed log share of a
    feature's positions that start (end) an answer, to six digits.  Counts are
    added up before they are shuffled; the table has at most a row per feature."""
    w = cut_lineage(w.select("start_position", "end_position", "features"))  # else computed once per position
    p = w.select("start_position", "end_position", F.posexplode("features").alias("i", "feature")).where(
        F.col("feature") != NO_FEATURE)
    share = lambda c: F.round(F.ln((F.count_if(F.col("i") == F.col(c)) + SMOOTH) / (F.count(F.lit(1)) + 1)), 6)
    return p.groupBy("feature").agg(share("start_position").alias("start_logit"), share("end_position").alias("end_logit"))


def load_span_model(spark: SparkSession, path: str):
    """The stored model as a broadcast of two arrays by feature number (of a
    fixed size; features that it lacks count as seen once, never as an answer)."""
    table = np.full((2, NO_FEATURE + 1), np.round(np.log(SMOOTH), 6))
    for r in spark.read.parquet(path).where(F.col("feature") < NO_FEATURE).limit(NO_FEATURE).collect():
        table[:, r["feature"]] = r["start_logit"], r["end_logit"]
    table[:, NO_FEATURE] = NEVER
    return spark.sparkContext.broadcast(table)


def model_logits(w: DataFrame, path: str, max_length: int = 384, batch_size: int = 256) -> DataFrame:
    """adds ``start_logits`` and ``end_logits`` of each window's sequence
    by the model stored at ``path``."""
    shipped = load_span_model(w.sparkSession, path)

    def make_predict():
        table = shipped.value  # once a worker

        def predict(features: np.ndarray):
            return {"start": table[0][features], "end": table[1][features]}
        return predict

    score = predict_batch_udf(make_predict, return_type=T.StructType.fromDDL("start array<double>, end array<double>"),
                              batch_size=batch_size, input_tensor_shapes=[[max_length]])
    w = evaluate_once(w.withColumn("_s", score(F.col("features"))))
    part = lambda f: F.slice(F.col("_s")[f], 1, F.col("seq_len"))
    return evaluate_once(w.withColumns({"start_logits": part("start"), "end_logits": part("end")})).drop("_s", "features")
