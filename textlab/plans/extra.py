"""Registered queries: stored span model, epoch export, repeated and re-sent
records, discovered runs, batched map; with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.operators import batching as bt
from textlab.operators import experiments as ex
from textlab.operators import models as md
from textlab.operators import qa
from textlab.operators import span_model as sm
from textlab.operators import textprep as tp
from textlab.plans import oracle as o
from textlab.plans import queries as q
from textlab.session import cut_lineage, ensure_checkpoint_dir
from textlab.sources import runs
from textlab.sources.tables import table
from textlab.streaming.upserts import upsert_stream


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _windows(spark: SparkSession, sf: str, examples: DataFrame) -> DataFrame:
    return tp.label_spans(q._qa_windows(spark, sf, examples), q.QA_MAX_LENGTH)


# ------------------------------------------------------------------ F2, F3
def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A span model fitted on four fifths of the conversation
    examples (by a hash of the id), stored, loaded by the scoring workers and
    applied to the windows of the others."""
    e = q.qa_examples_df(spark, sf)
    held = md.hash_number(F.col("id")) % 5 == 0
    path = _folder(spark, "span-model")
    sm.fit_span_model(sm.token_features(_windows(spark, sf, e.where(~held)), q.QA_MAX_LENGTH)).write.parquet(path)
    test = e.where(held)
    w = sm.token_features(q._qa_windows(spark, sf, test), q.QA_MAX_LENGTH).select(
        "example_id", "window_idx", "features", "seq_len", "offsets", "ctx_text", "ctx_at")
    p = qa.best_answers(sm.model_logits(w, path, q.QA_MAX_LENGTH), test, q.QA_N_BEST, q.QA_MAX_ANSWER)
    return p.select("example_id", "prediction_text", q._r("score"), q._r("null_score"))


def _model_sql() -> str:
    W, _, _ = o._qa_consts()
    base = o._qa_pred_ctes((0,))
    cut, rest = base.index("\npos AS ("), base.index("\nst AS (")
    logit = lambda c: f"ROUND(ln((COUNT(*) FILTER (WHERE i = {c}) + {sm.SMOOTH}) / (COUNT(*) + 1)), 6)"
    return f"""WITH {base[:cut]}
al AS (SELECT wf.example_id, wf.window_idx, wf.ctx_lo, wf.seq_len,
              ('0x' || substr(md5(wf.example_id), 1, 15))::BIGINT % 5 = 0 AS held,
              CASE WHEN COALESCE(a_text IS NOT NULL AND first_st <= a_start AND last_en >= a_start + length(a_text), FALSE)
                   THEN ctx_lo + n_le - 1 ELSE 0 END AS s,
              CASE WHEN COALESCE(a_text IS NOT NULL AND first_st <= a_start AND last_en >= a_start + length(a_text), FALSE)
                   THEN ctx_lo + n_lt ELSE 0 END AS e
       FROM wf JOIN wagg USING (example_id, window_idx)),
ft AS (SELECT example_id, window_idx, al.ctx_lo + j AS i, st, en, held, s, e,
              (((m * 2 + m_prev) * 2 + m_next) * 2 + wd) * {sm.LONGEST + 1} + least(length(t), {sm.LONGEST}) AS f
       FROM wm2 JOIN al USING (example_id, window_idx)
       UNION ALL SELECT example_id, window_idx, 0, NULL, NULL, held, s, e, {sm.CLS_FEATURE} FROM al),
fitted AS (SELECT f, {logit("s")} AS sl, {logit("e")} AS el FROM ft WHERE NOT held GROUP BY f),
lg AS (SELECT p.example_id, p.window_idx, 0 AS seed, p.i, ft.st, ft.en,
              CASE WHEN ft.f IS NULL THEN {sm.NEVER} ELSE COALESCE(fitted.sl, ROUND(ln({sm.SMOOTH}), 6)) END AS sl,
              CASE WHEN ft.f IS NULL THEN {sm.NEVER} ELSE COALESCE(fitted.el, ROUND(ln({sm.SMOOTH}), 6)) END AS el
       FROM (SELECT example_id, window_idx, CAST(unnest(range(0, seq_len)) AS INTEGER) AS i FROM al WHERE held) p
       LEFT JOIN ft USING (example_id, window_idx, i) LEFT JOIN fitted ON fitted.f = ft.f),{base[rest:]}
SELECT example_id, prediction_text, ROUND(score, {o.R}) AS score, ROUND(null_score, {o.R}) AS null_score
FROM pred WHERE ('0x' || substr(md5(example_id), 1, 15))::BIGINT % 5 = 0
"""


# ------------------------------------------------------------------ E2
#: Fixed value: shards of an exported epoch.
SHARDS = 4


def exported_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """The shuffled epochs as sorted shards, read back through their
    manifest: each shard's rows, positions, batches and ids in order, and how
    many shards of its epoch break the sequence."""
    b = bt.shuffled_batches(table(spark, sf, "documents", ["doc_id"]), "doc_id", q.BATCH_SEEDS, q.BATCH_EPOCHS, q.BATCH_SIZE)
    path = _folder(spark, "epochs")
    manifest = bt.write_batches(b, path, SHARDS)
    rows = spark.read.parquet(path)
    held = rows.groupBy("seed", "epoch", "shard").agg(
        F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"),
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "doc_id"))),  # one shard's rows
                                       lambda x: x["doc_id"].cast("string")), ",")).alias("ids_md5"))
    gaps = bt.manifest_gaps(manifest).groupBy("seed", "epoch").agg(F.count(F.lit(1)).alias("n_gaps"))
    d = manifest.drop("file").join(held, ["seed", "epoch", "shard"]).join(gaps, ["seed", "epoch"], "left")
    return d.withColumn("n_gaps", F.coalesce("n_gaps", F.lit(0).cast("long")))


def _epoch_sql() -> str:
    base = o._shuffled()
    cut = base.rindex("\nSELECT doc_id")
    return f"""{base[:cut]},
z AS (SELECT *, position // (SELECT CAST(ceil((MAX(position) + 1) / {SHARDS}) AS BIGINT) FROM y) AS shard FROM y)
SELECT seed, epoch, CAST(shard AS INTEGER) AS shard, COUNT(*) AS n_rows, CAST(MIN(position) AS BIGINT) AS first_position,
       CAST(MAX(position) AS BIGINT) AS last_position, CAST(MIN(position) // {q.BATCH_SIZE} AS BIGINT) AS first_batch,
       CAST(MAX(position) // {q.BATCH_SIZE} AS BIGINT) AS last_batch,
       md5(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY position)) AS ids_md5, CAST(0 AS BIGINT) AS n_gaps
FROM z GROUP BY seed, epoch, shard
"""


# ------------------------------------------------------------------ G9
def repeated_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Several examples under one id (the turns of a conversation): all
    their windows compete, the last one's context gives the text."""
    e = q.qa_examples_df(spark, sf).withColumns({
        "id": F.split("id", "-")[0], "nth": F.split("id", "-")[1].cast("int")})
    w = q._qa_windows(spark, sf, e).select(
        "example_id", "nth", "window_idx", "q_tok", "ctx_tok", "ctx_lo", "ctx_hi", "seq_len", "offsets", "ctx_text", "ctx_at")
    p = qa.best_answers(qa.overlap_logits(w), e, q.QA_N_BEST, q.QA_MAX_ANSWER, order_col="nth")
    return p.select("example_id", "prediction_text", q._r("score"), q._r("null_score"))


def _repeated_sql() -> str:
    return f"""WITH {o._qa_pred_ctes((0,))},
nth AS (SELECT *, split_part(id, '-', 1) AS c, CAST(split_part(id, '-', 2) AS INTEGER) AS t FROM ex),
last AS (SELECT c, context FROM nth QUALIFY ROW_NUMBER() OVER (PARTITION BY c ORDER BY t DESC) = 1),
top AS (SELECT split_part(example_id, '-', 1) AS c, cand.* FROM cand QUALIFY ROW_NUMBER() OVER (
          PARTITION BY split_part(example_id, '-', 1)
          ORDER BY score DESC, CAST(split_part(example_id, '-', 2) AS INTEGER), window_idx, si, ei) = 1),
nl AS (SELECT split_part(example_id, '-', 1) AS c, MAX(null_score) AS null_score FROM nulls GROUP BY 1)
SELECT last.c AS example_id, COALESCE(substring(last.context, top.cst + 1, top.cen - top.cst), '') AS prediction_text,
       ROUND(COALESCE(top.score, 0.0), {o.R}) AS score, ROUND(nl.null_score, {o.R}) AS null_score
FROM last LEFT JOIN top USING (c) LEFT JOIN nl USING (c)
"""


def resent_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """G9, streaming: window predictions arrive in two deliveries, of which
    the second sends a third of the examples again (by another seed); the
    merged table has the later one of each window, and answers come from it."""
    e = q.qa_examples_df(spark, sf)
    w = q._qa_windows(spark, sf, e).select(
        "example_id", "window_idx", "q_tok", "ctx_tok", "ctx_lo", "ctx_hi", "seq_len", "offsets", "ctx_text", "ctx_at")
    best = qa.window_best(qa.overlap_logits(w, (0, 1)), q.QA_N_BEST, q.QA_MAX_ANSWER, keys=["seed"])
    sent = cut_lineage(best.select("example_id", "window_idx", F.col("seed").alias("sent"), "cand", "null_score"))
    source, again = _folder(spark, "sent"), md.hash_number(F.col("example_id")) % 3 == 0
    for delivery in (F.col("sent") == 0, (F.col("sent") == 1) & again):
        sent.where(delivery).coalesce(1).write.mode("append").parquet(source)
    merged = upsert_stream(spark, source, spark.read.parquet(source).schema, _folder(spark, "merged"),
                           ["example_id", "window_idx"], ["sent"])
    p = qa.collect_answers(merged, e)
    return p.select("example_id", "prediction_text", q._r("score"), q._r("null_score"))


def _resent_sql() -> str:
    return f"""WITH {o._qa_pred_ctes((0, 1))}
SELECT example_id, prediction_text, ROUND(score, {o.R}) AS score, ROUND(null_score, {o.R}) AS null_score
FROM pred WHERE seed = CASE WHEN ('0x' || substr(md5(example_id), 1, 15))::BIGINT % 3 = 0 THEN 1 ELSE 0 END
"""


# ------------------------------------------------------------------ A6
def discovered_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A6-A8 in the documented folder layout: the runs of one epoch setting
    are written as a tree and two seeds of the two smallest learning rates
    are found again by their paths."""
    root = _folder(spark, "run-tree")
    m = q._run_metrics(spark, sf, "validation")
    few = (F.col("num_epochs") == q.EPOCHS[0]) & F.col("lr").isin(*q.LRS[:3]) & F.col("seed").isin(0, 1, 2)
    runs.write_run_tree(cut_lineage(m.where(few & (F.col("model") == q.GRID[0]["model"]))), root)
    back = runs.discover_runs(spark, root, lr=list(q.LRS[:2]), seed=[0, 1])
    return back.select(*ex.RUN, "metric", "class_name", q._r())


def _discovered_sql() -> str:
    lrs = ", ".join(f"CAST({x!r} AS DOUBLE)" for x in q.LRS[:2])
    return o.RUN_METRICS.replace("FROM rep\n", (
        f"FROM rep WHERE lr IN ({lrs}) AND seed IN (0, 1) AND num_epochs = {q.EPOCHS[0]} "
        f"AND model = '{q.GRID[0]['model']}'\n"))


# ------------------------------------------------------------------ L1
def cut_batch(batch: dict, max_length: int, doc_stride: int, n_special: int = 3) -> dict:
    """Windows of a batch of examples: more rows out than in."""
    out: dict[str, list] = {"example_id": [], "window_idx": [], "w_start": [], "w_len": []}
    for i, n_q, n_ctx in zip(batch["id"], batch["n_q"], batch["n_ctx"]):
        room = max_length - (n_q or 0) - n_special
        start, k = 0, 0
        while n_q is not None and n_ctx and room > doc_stride:
            for name, v in zip(out, (i, k, start, min(room, n_ctx - start))):
                out[name].append(v)
            if start + room >= n_ctx:
                break
            start, k = start + room - doc_stride, k + 1
    return out


def mapped_windows(spark: SparkSession, sf: str) -> DataFrame:
    """L1, L2: the window expansion as a batched map with keyword arguments
    that drops the source columns."""
    counted = tp.count_qa(q.qa_examples_df(spark, sf), q.QA_MAX_LENGTH).select("id", "n_q", "n_ctx")
    return md.batched_map(counted, cut_batch, "example_id string, window_idx int, w_start int, w_len int",
                          {"max_length": q.QA_MAX_LENGTH, "doc_stride": q.QA_STRIDE})


REGISTRY = {f.__name__: f for f in (
    model_predictions, exported_epoch, repeated_ids, resent_predictions, discovered_runs, mapped_windows)}


def all_sql() -> dict[str, str]:
    return {
        "model_predictions": _model_sql(), "exported_epoch": _epoch_sql(), "repeated_ids": _repeated_sql(),
        "resent_predictions": _resent_sql(), "discovered_runs": _discovered_sql(),
        "mapped_windows": f"WITH {o._qa_base()} SELECT example_id, window_idx, w_start, w_len FROM wf",
    }
