"""Registered queries: the reference's operators bound to the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching SQL in :mod:`textlab.plans.oracle`.
Floating results are rounded to 6 decimals in both, so engine-specific
summation order cannot flip a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.functions.arrays import argmax, as_double_array, evaluate_once
from textlab.operators import clf_metrics as cm
from textlab.operators import batching as bt
from textlab.operators import experiments as ex
from textlab.operators import labels as lb
from textlab.operators import positions as pos
from textlab.operators import corpus as cp
from textlab.operators import models as md
from textlab.operators import project as pj
from textlab.operators import qa
from textlab.operators import qa_metrics as qm
from textlab.operators import textprep as tp
from textlab.functions.text import words
from textlab.session import cut_lineage
from textlab.sources.tables import table

ROUND = 6


def _r(c: str = "value"):
    return F.round(F.col(c), ROUND).alias(c)


# --------------------------------------------------------------------- I / F4
def scored_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """F4 on ``embeddings``: the first 10 components are the logits of a
    10-class model, ``label`` is the target."""
    emb = table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    return emb.select("vec_id", F.col("label").alias("target"),
                      argmax(as_double_array(F.slice("embedding", 1, 10)))
                      .alias("prediction"))


def clf_report(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: F4 -> I1 -> I2-I10 (observed labels)."""
    conf = cm.confusion(scored_embeddings(spark, sf))
    rep = cm.classification_report(conf)
    return rep.select("metric", "class_name", _r())


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """I1, densified over the declared classes 0-9."""
    conf = cm.confusion(scored_embeddings(spark, sf))
    return cm.dense_confusion(conf, range(10)).select("target", "prediction", "n")



# ------------------------------------------------------------------- E4 / J
# The experiment grid (learning rates x epochs x seeds as in
# the reference's classification scripts) and two embedding "models".
TASK = "topics"
MODELS = ("emb-head", "emb-tail")
LRS = (1e-5, 2e-5, 3e-5, 4e-5, 5e-5)
EPOCHS = (3, 4, 5)
SEEDS = (0, 1, 2, 3, 4)
GRID = ex.grid_points(model=MODELS, lr=LRS, num_epochs=EPOCHS, seed=SEEDS)


def run_predictions(spark: SparkSession, sf: str, split: str) -> DataFrame:
    """Every grid point's predictions on ``embeddings`` in one job: run
    (config c, seed s) reads the 10 logits at offset (5c+s) mod 54
    (validation) or that offset + 27 mod 54 (test).  The grid is a literal
    array, exploded onto each row (narrow)."""
    emb = table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    g = F.explode(ex.grid_column(GRID)).alias("g")
    runs = emb.select("vec_id", "embedding", "label", g)
    off = (F.col("g.config_no") * 5 + F.col("g.seed")) % 54
    if split == "test":
        off = (off + 27) % 54
    return runs.select(
        F.lit(TASK).alias("task"), "g.model", "g.lr", "g.num_epochs", "g.seed",
        "vec_id", F.col("label").alias("target"),
        argmax(F.slice("embedding", off + 1, 10)).alias("prediction"))


def _run_metrics(spark: SparkSession, sf: str, split: str) -> DataFrame:
    preds = run_predictions(spark, sf, split)
    return cm.classification_report(cm.confusion(preds, ex.RUN), ex.RUN)


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """E4 + F4 + I: validation metric vector of every run."""
    return _run_metrics(spark, sf, "validation").select(
        *ex.RUN, "metric", "class_name", _r())


def _config_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ex.config_summary(_run_metrics(spark, sf, "validation"))


def config_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Mean / population std over seeds per configuration."""
    s = _config_summary(spark, sf)
    return s.select(*ex.CFG, "n_seeds", _r("mean_accuracy"), _r("std_accuracy"),
                    _r("mean_f1"), _r("std_f1"))


def best_config(spark: SparkSession, sf: str) -> DataFrame:
    """Best configuration per task and model."""
    b = ex.best_config(_config_summary(spark, sf))
    return b.select("task", "model", "lr", "num_epochs", _r("mean_f1"))


def _seed_summary(spark: SparkSession, sf: str) -> DataFrame:
    best = ex.best_config(_config_summary(spark, sf))
    test = ex.restrict_to(run_predictions(spark, sf, "test"), best)   # J3 / F5
    metrics = cm.classification_report(cm.confusion(test, ex.RUN), ex.RUN)
    return ex.seed_summary(metrics)


def seed_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Test summary of the best configuration."""
    return _seed_summary(spark, sf).select(
        *ex.CFG, "n_seeds", "metric", "class_name", _r("mean"), _r("std"))


def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Macro F1 per task x model, ranked."""
    return ex.leaderboard(_seed_summary(spark, sf)).select(
        "task", "model", "lr", "num_epochs", _r("mean"), _r("std"), "rank")



# ------------------------------------------------------- P1, A2-A4, C, E1-E3
def split_fraction(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + A3 (P1): first 90 % / last 10 % of ``documents`` by doc_id."""
    docs = table(spark, sf, "documents", ["doc_id"])
    return pos.split_fraction(docs, "doc_id", 90.0).select("doc_id", "position", "split")


def split_tail(spark: SparkSession, sf: str) -> DataFrame:
    """A4: the last 500 documents by doc_id are validation, the rest train."""
    docs = table(spark, sf, "documents", ["doc_id"])
    head, tail = pos.split_tail(docs, "doc_id", 500)
    return (head.withColumn("split", F.lit("train"))
            .unionByName(tail.withColumn("split", F.lit("validation"))))


def label_classes(spark: SparkSession, sf: str) -> DataFrame:
    """C1 + C4: class table fitted on ``documents.source``."""
    docs = table(spark, sf, "documents", ["source"])
    return lb.fit_labels(docs, "source")


def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    """C1 fitted on all rows *before* the last-500 cut (as the reference
    does), then C2 on both parts (A4)."""
    docs = table(spark, sf, "documents", ["doc_id", "source"])
    classes = lb.fit_labels(docs, "source")
    head, tail = pos.split_tail(docs, "doc_id", 500)
    parts = (head.withColumn("split", F.lit("train"))
             .unionByName(tail.withColumn("split", F.lit("validation"))))
    return lb.apply_labels(parts, classes, "source", "label_id").select(
        "doc_id", "source", "label_id", "split")


# Seeds and epochs of the batching query, batch size 8 as in
# the reference's classification scripts.
BATCH_SEEDS = (0, 1)
BATCH_EPOCHS = (0, 1)
BATCH_SIZE = 8


def shuffled_batches(spark: SparkSession, sf: str) -> DataFrame:
    """E1 + E2: per seed and epoch a reproducible permutation of the
    documents, cut into batches of 8."""
    docs = table(spark, sf, "documents", ["doc_id"])
    return bt.shuffled_batches(docs, "doc_id", BATCH_SEEDS, BATCH_EPOCHS,
                               BATCH_SIZE).select("doc_id", "seed", "epoch",
                                                  "position", "batch_id")


def eval_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Order-preserving evaluation batches."""
    docs = table(spark, sf, "documents", ["doc_id"])
    return bt.eval_batches(docs, "doc_id", BATCH_SIZE).select(
        "doc_id", "position", "batch_id")



# ------------------------------------------------------------ D, F3, G, H, J6
# QA window length, overlap, n-best and answer length as in the
# reference's QA scripts; seeds of the QA runs.
QA_MAX_LENGTH = 384
QA_STRIDE = 128
QA_N_BEST = 20
QA_MAX_ANSWER = 30
QA_SEEDS = (0, 1, 2, 3, 4)


def qa_examples_df(spark: SparkSession, sf: str) -> DataFrame:
    """QA examples from ``conversations``: a user turn is the question, the
    next assistant turn of the same conversation the context; the gold
    answer is the context's longest word (first one on ties) at its first
    occurrence.  A context without words has no answer.  The pairing is an
    equi-join on (conv_id, turn), so a very long conversation is spread
    over partitions by turn."""
    conv = table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"])
    u = conv.where(F.col("role") == "user").select("conv_id", "turn",
                                                    F.col("text").alias("question"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("context"))
    ex = u.join(a, ["conv_id", "turn"])
    ex = ex.withColumn("_lw", F.array_max(F.transform(words("context"), lambda w, i: F.struct(
        F.length(w).alias("l"), (-i).alias("ni"), w.alias("w"))))["w"])
    ex = evaluate_once(ex)
    longest = F.col("_lw")
    answers = F.when(longest.isNull(), F.struct(
        F.array().cast("array<int>").alias("answer_start"),
        F.array().cast("array<string>").alias("text"))).otherwise(F.struct(
            F.array((F.position(longest, F.col("context")) - 1).cast("int")).alias("answer_start"),
            F.array(longest).alias("text")))
    return ex.select(F.concat_ws("-", F.col("conv_id").cast("string"),
                                 F.col("turn").cast("string")).alias("id"),
                     "question", "context", answers.alias("answers"))


def _qa_windows(spark: SparkSession, sf: str, examples: DataFrame | None = None) -> DataFrame:
    ex_df = qa_examples_df(spark, sf) if examples is None else examples
    prep = tp.prepare_qa(ex_df, QA_MAX_LENGTH, QA_STRIDE)
    return tp.window_offsets(tp.windows(prep, QA_STRIDE))


def qa_examples(spark: SparkSession, sf: str) -> DataFrame:
    """D1 + B4: examples with the left-stripped question and first answer."""
    ex = qa_examples_df(spark, sf)
    from textlab.functions.text import strip_left
    return ex.select("id", strip_left("question").alias("question"),
                     F.get(F.col("answers.answer_start"), 0).alias("answer_start"),
                     F.get(F.col("answers.text"), 0).alias("answer_text"))


def qa_features(spark: SparkSession, sf: str) -> DataFrame:
    """One row per window with its token ranges."""
    w = _qa_windows(spark, sf)
    return w.select("example_id", "window_idx", "n_q", "n_ctx", "w_start", "w_len",
                    "ctx_lo", "ctx_hi", "seq_len",
                    F.get(F.col("ctx_st"), 0).alias("first_st"),
                    F.get(F.col("ctx_en"), F.col("w_len") - 1).alias("last_en"),
                    F.size(F.filter("offsets", lambda o: o.isNotNull())).alias("n_offsets"))


def qa_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Start / end token labels of the training features."""
    w = tp.label_spans(_qa_windows(spark, sf), QA_MAX_LENGTH)
    return w.select("example_id", "window_idx", "start_position", "end_position")


def qa_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Q2 / Q3: examples that cannot be featurised."""
    return tp.quarantine_qa(tp.count_qa(qa_examples_df(spark, sf), QA_MAX_LENGTH), QA_STRIDE)


def span_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Stored answer offsets checked against the context."""
    return tp.validate_spans(qa_examples_df(spark, sf))


def _qa_predictions(spark: SparkSession, sf: str, seeds=QA_SEEDS,
                    examples: DataFrame | None = None) -> DataFrame:
    ex_df = qa_examples_df(spark, sf) if examples is None else examples
    # interpreted array functions materialise their input row: keep only
    # what scoring and span selection read (not the example's full token
    # arrays, question or answers)
    w = _qa_windows(spark, sf, ex_df).select(
        "example_id", "window_idx", "q_tok", "ctx_tok", "ctx_lo", "ctx_hi", "seq_len",
        "offsets", "ctx_text", "ctx_at")
    scored = qa.overlap_logits(w, seeds)
    return qa.best_answers(scored, ex_df, QA_N_BEST, QA_MAX_ANSWER,
                           key_values={"seed": list(seeds)})


def qa_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """F3 + G1-G10 for every seed."""
    p = _qa_predictions(spark, sf)
    return p.select("seed", "example_id", "prediction_text", _r("score"), _r("null_score"))


def _qa_scores(spark: SparkSession, sf: str, lowercase=False, first_gold_only=False):
    ex_df = qa_examples_df(spark, sf)
    p = _qa_predictions(spark, sf, QA_SEEDS, ex_df)
    return qm.squad_scores(p, ex_df, lowercase, first_gold_only, keys=["seed"])


def qa_scores(spark: SparkSession, sf: str) -> DataFrame:
    """H1-H5 per seed (exact match and F1 x 100)."""
    return _qa_scores(spark, sf).select("seed", _r("exact_match"), _r("f1"), "n")


def qa_scores_partial(spark: SparkSession, sf: str) -> DataFrame:
    """H5 where some examples have no prediction (those whose id ends in 2):
    they count as examples with score 0."""
    ex_df = qa_examples_df(spark, sf)
    p = _qa_predictions(spark, sf, QA_SEEDS, ex_df).where(~F.col("example_id").endswith("2"))
    return qm.squad_scores(p, ex_df, keys=["seed"]).select("seed", _r("exact_match"), _r("f1"), "n")


def qa_scores_lower(spark: SparkSession, sf: str) -> DataFrame:
    """H with D12 lower-casing and only the first gold text."""
    return _qa_scores(spark, sf, True, True).select("seed", _r("exact_match"), _r("f1"), "n")


def qa_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Mean / median / sample std over seeds of EM and F1."""
    s = _qa_scores(spark, sf)
    long = s.select("seed", F.explode(F.array(
        F.struct(F.lit("exact_match").alias("metric"), F.col("exact_match").alias("value")),
        F.struct(F.lit("f1").alias("metric"), F.col("f1").alias("value")))).alias("m")
    ).select(F.lit("conversations").alias("task"), F.lit("overlap").alias("model"),
             "seed", "m.metric", "m.value")
    out = ex.qa_summary(long)
    return out.select("task", "model", "metric", _r("mean"), _r("median"), _r("std"),
                      "n_seeds")



# ------------------------------------------------------- D15, D4, D3, K, B
# Vocabulary size (D15's parameter, of the size of common
# encoders' vocabularies) and single-sequence length of the encoder.
VOCAB_SIZE = 30_000
ENCODE_MAX_LENGTH = 512


def _vocab(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", ["text"])
    return tp.vocabulary(tp.token_frequencies(docs, "text", VOCAB_SIZE))


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Special tokens + the ``VOCAB_SIZE`` most frequent tokens of ``documents``."""
    return _vocab(spark, sf).select("token_id", "token")


def encode_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Single-sequence encoding of every document (512 ids, mask);
    reported as the ids in order and summaries of the mask array."""
    docs = table(spark, sf, "documents", ["doc_id", "text"])
    toks = docs.select("doc_id", tp.native_tokens("text").alias("toks"))
    enc = tp.encode_single(toks, "toks", _vocab(spark, sf), "doc_id", ENCODE_MAX_LENGTH)
    return enc.select(
        "doc_id", "n_tokens", "truncated",
        F.size(F.filter("input_ids", lambda x: x == 1)).alias("n_unk"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attention"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("ids"),
        F.size("input_ids").alias("length"))


def subword_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """D3: WordPiece split of every distinct word of ``documents`` against
    a vocabulary of the ``VOCAB_SIZE`` most frequent tokens plus the corpus alphabet."""
    docs = table(spark, sf, "documents", ["text"])
    freq = tp.token_frequencies(docs, "text", VOCAB_SIZE)
    vocab = tp.wordpiece_vocabulary(freq, tp.corpus_alphabet(docs, "text"))
    return tp.subword(docs, "text", vocab).select(
        "word", F.size("pieces").alias("n_pieces"), F.array_join("pieces", " ").alias("pieces"))


# Fixed value: size of the small sub-word vocabulary of the pair encodings.
QA_PIECES = 1000


def qa_pair_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """The conversation examples as padded pairs of 384 sub-word
    ids with mask, part ids, offsets and labels, padded on the right (question
    first) and on the left (context first).  The vocabulary is drawn from the
    conversations: the most frequent tokens and the alphabet."""
    text = table(spark, sf, "conversations", ["text"])
    ids = tp.piece_ids(tp.wordpiece_vocabulary(tp.token_frequencies(text, "text", QA_PIECES), tp.corpus_alphabet(text, "text")))
    prep = tp.prepare_qa(qa_examples_df(spark, sf), QA_MAX_LENGTH, QA_STRIDE, ids=ids)
    sides = prep.withColumn("pad_on_right", F.explode(F.array(F.lit(True), F.lit(False))))
    w = tp.pair_encoding(tp.label_spans(tp.windows(sides, QA_STRIDE), QA_MAX_LENGTH), QA_MAX_LENGTH)
    joined = lambda c, null="-": F.array_join(F.col(c).cast("array<string>"), " ", null)
    spans = F.transform(F.filter("offsets", lambda o: o.isNotNull()), lambda o: F.concat_ws(":", o["st"], o["en"]))
    first = F.array_position(F.transform("offsets", lambda o: o.isNotNull()), True) - 1
    return w.select("example_id", "pad_on_right", "window_idx", "w_start", "w_len", joined("input_ids").alias("input_ids"),
                    joined("attention_mask").alias("attention_mask"), joined("sequence_ids").alias("sequence_ids"),
                    F.array_join(spans, " ").alias("offsets"), first.cast("int").alias("first_offset"),
                    F.size("offsets").alias("length"), "cls_index", "start_position", "end_position")


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    """K1: documents, tokens and bytes per source and in total."""
    docs = table(spark, sf, "documents", ["source", "text"])
    return cp.corpus_stats(docs).select("source", "n_docs", "n_tokens", "n_bytes")


def corpus_sources(spark: SparkSession, sf: str) -> DataFrame:
    """K2 + K1: documents, conversation turns and benchmark passages as one
    corpus, counted per source."""
    c = cp.assemble_corpus([
        (table(spark, sf, "documents", ["source", "text"]), "text", "source"),
        (table(spark, sf, "conversations", ["text"]), "text", "conversations"),
        (table(spark, sf, "benchmark", ["text"]), "text", "benchmark")])
    return cp.corpus_stats(c).select("source", "n_docs", "n_tokens", "n_bytes")


def _label_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-label sets of the labelled documents: true = {lang, quality?,
    toxic?}; predicted by a length / punctuation rule."""
    d = table(spark, sf, "documents", ["doc_id", "text", "lang", "n_chars"])
    l = table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    j = d.join(l, "doc_id")
    true = F.array_compact(F.array("lang", F.when(F.col("quality") == 1, F.lit("quality")),
                                   F.when(F.col("toxic") == 1, F.lit("toxic"))))
    pred = F.array_compact(F.array(
        F.when(F.col("n_chars") >= 1000, F.col("lang")).otherwise(F.lit("en")),
        F.when(F.col("n_chars") > 3000, F.lit("quality")),
        F.when(F.col("text").contains("!"), F.lit("toxic"))))
    return j.select("doc_id", true.alias("labels"), pred.alias("predicted"))


def multilabel_report(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-label precision / recall / F1 per label, macro, micro."""
    r = cm.multilabel_report(_label_sets(spark, sf), "doc_id", "labels", "predicted")
    return r.select("metric", "class_name", _r())


def labelset_stats(spark: SparkSession, sf: str) -> DataFrame:
    """K3: size statistics of the true label sets."""
    return cp.labelset_stats(_label_sets(spark, sf)).select("stat", _r())


MODEL_RULES = pj.PathRules(family_token="//m.", family_tokenizer="family-base", local_tokenizer="local-base",
                           converted_suffix=".html", own_token="example.org", own_root="own", other_root="others")


def resolve_models(spark: SparkSession, sf: str) -> DataFrame:
    """Model name, tokenizer and output root derived from a path: the
    page URLs, each also written with backslashes."""
    url = F.col("url")
    styles = F.explode(F.array(
        F.struct(F.lit("slash").alias("style"), url.alias("path")),
        F.struct(F.lit("backslash").alias("style"), F.replace(url, F.lit("/"), F.lit("\\")).alias("path"))))
    paths = table(spark, sf, "pages", ["page_id", "url"]).select("page_id", styles.alias("p")).select("page_id", "p.*")
    return pj.resolve_models(paths, MODEL_RULES).select("page_id", "style", "model_name", "tokenizer", "output_root")


# Naive Bayes grid (smoothing) and classes of the quality flag.
NB_ALPHAS = (0.5, 1.0)
NB_CLASSES = (0, 1)


def nb_report(spark: SparkSession, sf: str) -> DataFrame:
    """F1(a): naive Bayes on the labelled documents' text, trained on the
    first 90 % by doc_id (A2), validated on the last 10 % (A3), for every
    smoothing value; then I1-I10 per alpha."""
    d = table(spark, sf, "documents", ["doc_id", "text"])
    l = table(spark, sf, "labels", ["doc_id", "quality"])
    lab = d.join(l, "doc_id")
    # the split is read by training, scoring and the truth join: materialise
    # it once instead of re-running the positional index per branch
    parts = cut_lineage(pos.split_fraction(lab, "doc_id", 90.0))
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "validation")
    ll, prior = md.train_nb(train, "doc_id", "text", "quality", NB_CLASSES, NB_ALPHAS)
    pred = md.predict_nb(test, "doc_id", "text", ll, prior, NB_CLASSES, NB_ALPHAS)
    pred = pred.join(test.select("doc_id", F.col("quality").alias("target")), "doc_id")
    rep = cm.classification_report(cm.confusion(pred, ["alpha"]), ["alpha"])
    return rep.select("alpha", "metric", "class_name", _r())


def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    """J11 (+ F6): QA predictions of two scorer variants side by side with
    the gold answer."""
    ex_df = qa_examples_df(spark, sf)
    p = _qa_predictions(spark, sf, (0, 1), ex_df).select(
        "example_id", F.concat(F.lit("overlap_s"), F.col("seed").cast("string")).alias("model"),
        F.col("prediction_text").alias("prediction"))
    truth = ex_df.select(
        F.col("id").alias("example_id"), F.get(F.col("answers.text"), 0).alias("answer_text"))
    return ex.compare_models(p, truth, "example_id", ["overlap_s0", "overlap_s1"])



# ------------------------------------------------------------- A6-A9, stream
def stored_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A8 then A6/A7: the validation metric vectors of all runs are written
    as a run table partitioned by run keys (in the shared checkpoint
    folder), then read back for two seeds of the smallest learning rate --
    only those partitions are listed and scanned."""
    import uuid
    from textlab.session import ensure_checkpoint_dir
    from textlab.sources import runs
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/runs/{uuid.uuid4().hex}"
    runs.write_runs(_run_metrics(spark, sf, "validation"), root)
    back = runs.read_runs(spark, root, lr=LRS[0], seed=[0, 1])
    return back.select(*ex.RUN, "metric", "class_name", _r())


def streamed_clf_report(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship report computed by a Structured Streaming query that
    treats ``embeddings`` as arriving prediction files (running confusion
    counts as state, metrics from the memory table)."""
    from textlab.streaming.evaluator import stream_report
    schema = table(spark, sf, "embeddings").schema

    def score(df):
        return df.select(F.col("label").alias("target"),
                         argmax(as_double_array(F.slice("embedding", 1, 10))).alias("prediction"))

    # a pattern of the one name: a stream takes a single file only by a pattern
    rep = stream_report(spark, f"{sf.rstrip('/')}/embeddings[.]parquet", schema, score)
    return rep.select("metric", "class_name", _r())



# Logistic-regression grid and number of hashed features.
LOGREG_REGS = (0.0, 0.1)
LOGREG_ITERS = (10, 20)
LOGREG_FEATURES = 1 << 16


def logreg_report(spark: SparkSession, sf: str) -> DataFrame:
    """F1(b): hashed TF-IDF + logistic regression over a grid of penalties
    and step counts on the labelled documents (train first 90 %, validate
    last 10 %), then I1-I10 per grid point."""
    d = table(spark, sf, "documents", ["doc_id", "text"])
    l = table(spark, sf, "labels", ["doc_id", "quality"])
    parts = cut_lineage(pos.split_fraction(d.join(l, "doc_id"), "doc_id", 90.0, mode="complement"))
    x = cut_lineage(md.hashed_tfidf(parts, "doc_id", "text", F.col("split") == "train", LOGREG_FEATURES).drop("text"))
    models = md.train_logreg(x.where(F.col("split") == "train"), "quality", LOGREG_REGS, LOGREG_ITERS, LOGREG_FEATURES)
    test = x.where(F.col("split") == "validation")
    pred = md.predict_logreg(models, test, "doc_id").join(test.select("doc_id", F.col("quality").alias("target")), "doc_id")
    keys = ["reg_param", "max_iter"]
    rep = cm.classification_report(cm.confusion(pred, keys), keys)
    return rep.select(*keys, "metric", "class_name", _r())


# ------------------------------------------- long contexts: benchmark in documents
def long_qa_examples_df(spark: SparkSession, sf: str) -> DataFrame:
    """Long-context QA examples: a ``benchmark`` passage found verbatim in a
    ``documents`` text is the answer, the document the context, all words of
    the passage the question."""
    b = table(spark, sf, "benchmark", ["item_id", "text"])
    d = table(spark, sf, "documents", ["doc_id", "text"])
    hit = tp.locate_passages(d, "doc_id", "text", b, "item_id", "text")
    return hit.select(
        F.concat_ws("-", F.col("item_id").cast("string"), F.col("doc_id").cast("string")).alias("id"),
        F.array_join("passage_words", " ").alias("question"),
        "context",
        F.struct(F.array("pos").alias("answer_start"),
                 F.array("passage").alias("text")).alias("answers"))


def long_qa_examples(spark: SparkSession, sf: str) -> DataFrame:
    """The long-context examples found (id, question, answer offset)."""
    return long_qa_examples_df(spark, sf).select(
        "id", "question", F.get(F.col("answers.answer_start"), 0).alias("answer_start"),
        F.length("context").alias("context_chars"))


def long_qa_labels(spark: SparkSession, sf: str) -> DataFrame:
    """D6-D11 on long documents: many windows per example."""
    w = tp.label_spans(_qa_windows(spark, sf, long_qa_examples_df(spark, sf)), QA_MAX_LENGTH)
    return w.select("example_id", "window_idx", "w_start", "w_len", "start_position",
                    "end_position")


def long_qa_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """F3 + G1-G10 over all windows of each long document (the best-answer
    aggregate sees one example with dozens of windows)."""
    p = _qa_predictions(spark, sf, QA_SEEDS, long_qa_examples_df(spark, sf))
    return p.select("seed", "example_id", "prediction_text", _r("score"), _r("null_score"))


def long_qa_scores(spark: SparkSession, sf: str) -> DataFrame:
    """H1-H5 of the long-context predictions."""
    ex_df = long_qa_examples_df(spark, sf)
    p = _qa_predictions(spark, sf, QA_SEEDS, ex_df)
    return qm.squad_scores(p, ex_df, keys=["seed"]).select("seed", _r("exact_match"), _r("f1"), "n")


REGISTRY = {
    "clf_report": clf_report,
    "confusion_matrix": confusion_matrix,
    "run_metrics": run_metrics,
    "config_summary": config_summary,
    "best_config": best_config,
    "seed_summary": seed_summary,
    "leaderboard": leaderboard,
    "split_fraction": split_fraction,
    "split_tail": split_tail,
    "label_classes": label_classes,
    "label_encode": label_encode,
    "shuffled_batches": shuffled_batches,
    "eval_batches": eval_batches,
    "qa_examples": qa_examples,
    "qa_features": qa_features,
    "qa_labels": qa_labels,
    "qa_quarantine": qa_quarantine,
    "span_validation": span_validation,
    "qa_predictions": qa_predictions,
    "qa_scores": qa_scores,
    "qa_scores_lower": qa_scores_lower,
    "qa_scores_partial": qa_scores_partial,
    "qa_summary": qa_summary,
    "vocabulary": vocabulary,
    "encode_docs": encode_docs,
    "subword_pieces": subword_pieces,
    "qa_pair_encoding": qa_pair_encoding,
    "corpus_stats": corpus_stats,
    "corpus_sources": corpus_sources,
    "multilabel_report": multilabel_report,
    "labelset_stats": labelset_stats,
    "resolve_models": resolve_models,
    "nb_report": nb_report,
    "compare_models": compare_models,
    "stored_runs": stored_runs,
    "logreg_report": logreg_report,
    "long_qa_examples": long_qa_examples,
    "long_qa_labels": long_qa_labels,
    "long_qa_predictions": long_qa_predictions,
    "long_qa_scores": long_qa_scores,
    "streamed_clf_report": streamed_clf_report,
}
