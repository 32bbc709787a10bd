"""Further registered queries: operators and branches that the plain tables
do not reach, with their DuckDB SQL.

The QA variants change the conversation examples by conversation number, so
every branch of featurisation, labelling and scoring has rows.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.functions.text import words
from textlab.operators import clf_metrics as cm
from textlab.operators import experiments as ex
from textlab.operators import labels as lb
from textlab.operators import models as md
from textlab.operators import project as pj
from textlab.operators import qa
from textlab.operators import qa_metrics as qm
from textlab.operators import textprep as tp
from textlab.plans import oracle as o
from textlab.plans import queries as q
from textlab.session import ensure_checkpoint_dir
from textlab.sources import runs
from textlab.sources.tables import literal_table, load_split, table

#: Leading blanks of the D1 variant: no-break space, em space, tab, space.
BLANKS = "  \t "


# ------------------------------------------------------------------ QA variants
def qa_variants_df(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation examples by conversation number mod 8: 0 blanks before a
    question that is the answer, 1 shifted offset, 2 no answer, 3 two golds
    (the question is the second), 4 overlong question, 5 null question, 6 null
    context, 7 answer text that is not in the context."""
    e = q.qa_examples_df(spark, sf)
    v = F.split("id", "-")[0].cast("long") % 8
    text, start = F.get(F.col("answers.text"), 0), F.get(F.col("answers.answer_start"), 0)
    first = F.get(words("context"), 0)
    e = e.select("id", "question", "context", "answers", v.alias("v"), text.alias("t"), start.alias("s"), first.alias("w1"))
    question = (F.when(F.col("v") == 0, F.concat(F.lit(BLANKS), F.col("t"))).when(F.col("v") == 3, F.col("w1"))
                .when(F.col("v") == 4, F.repeat(F.concat("question", F.lit(" ")), 80))
                .when(F.col("v") == 5, F.lit(None)).otherwise(F.col("question")))
    two = F.array_compact(F.array("t", F.when(F.col("v") == 3, F.col("w1"))))
    golds = F.when(F.col("v") == 7, F.transform(two, lambda t: F.concat(t, F.lit("!x")))).otherwise(two)
    at = F.when(F.col("v") == 1, F.col("s") + 3).otherwise(F.col("s"))
    none = F.col("v").isin(2, 6) | F.col("t").isNull()
    answers = F.struct(
        F.when(none, F.array().cast("array<int>")).otherwise(F.array(at)).alias("answer_start"),
        F.when(none, F.array().cast("array<string>")).otherwise(golds).alias("text"))
    return e.select("id", question.alias("question"), F.when(F.col("v") != 6, F.col("context")).alias("context"),
                    answers.alias("answers"))


def variant_labels(spark: SparkSession, sf: str) -> DataFrame:
    """D1, D5-D11 with shifted, absent and doubled answers."""
    w = tp.label_spans(q._qa_windows(spark, sf, qa_variants_df(spark, sf)), q.QA_MAX_LENGTH)
    return w.select("example_id", "window_idx", "start_position", "end_position")


def variant_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Q2 / Q3: null and overlong questions, null contexts."""
    return tp.quarantine_qa(tp.count_qa(qa_variants_df(spark, sf), q.QA_MAX_LENGTH), q.QA_STRIDE)


def variant_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Every status occurs."""
    return tp.validate_spans(qa_variants_df(spark, sf))


def _variant_scores(spark: SparkSession, sf: str, first_gold_only: bool) -> DataFrame:
    e = qa_variants_df(spark, sf)
    s = qm.squad_scores(q._qa_predictions(spark, sf, q.QA_SEEDS, e), e, first_gold_only=first_gold_only, keys=["seed"])
    return s.select("seed", q._r("exact_match"), q._r("f1"), "n")


def variant_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The best over two golds, empty predictions."""
    return _variant_scores(spark, sf, False)


def variant_scores_first(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the first gold only (H4)."""
    return _variant_scores(spark, sf, True)


# ------------------------------------------------------------------ B, C, I, J
DECLARED = tuple(f"class {i:02d}" for i in range(12))  # 10 and 11 do not occur


def declared_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report over a declared class list, with names and
    two absent classes, and the class count."""
    classes = lb.declared_classes(spark, DECLARED)
    rep = cm.classification_report(cm.confusion(q.scored_embeddings(spark, sf)), classes=classes, labels="declared",
                                   declared=range(len(DECLARED)))
    n = lb.n_classes(classes).scalar()
    return rep.select("metric", "class_name", q._r(), n.alias("n_classes"))


def label_granularity(spark: SparkSession, sf: str) -> DataFrame:
    """Documents labelled coarsely (language) or finely
    (source), encoded with classes fitted on the first half of the ids; labels
    not seen there stay null."""
    docs = table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])
    out = None
    for g in ("coarse", "fine"):
        rows = pj.choose_label(docs, g, "lang", "source")
        half = F.col("doc_id") % 2 == 0
        classes = lb.fit_labels(pj.choose_label(docs.where(half), g, "lang", "source"))
        named = lb.apply_labels(rows, classes, on_unseen="null").join(
            classes.withColumnRenamed("class_id", "label_id"), "label_id", "left")
        part = named.groupBy("label_id", "class_name").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.length("sentence")).alias("chars"))
        part = part.select(F.lit(g).alias("granularity"), "label_id", "class_name", "n", "chars")
        out = part if out is None else out.unionByName(part)
    return out


def attached_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Language and length attached to the labelled ids by key."""
    docs = table(spark, sf, "documents", ["doc_id", "lang", "n_chars"])
    return pj.attach_by_key(table(spark, sf, "labels", ["doc_id", "quality"]), docs, "doc_id", ["lang", "n_chars"])


def seed_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """One column per seed."""
    wide = ex.seed_table(q._run_metrics(spark, sf, "validation"), q.SEEDS)
    return wide.select(*ex.CFG, "metric", "class_name",
                       *[F.round(F.col(str(s)), q.ROUND).alias(f"seed_{s}") for s in q.SEEDS])


def last_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Of several entries under one id the last stays."""
    return qa.keep_last_per_id(table(spark, sf, "conversations"), "conv_id", "turn").select(
        "conv_id", "turn", "role", "text")


# ------------------------------------------------------------------ A, F
def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def exported_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The configuration summary stored, exported as CSV and read
    back from the export."""
    path = _folder(spark, "summary")
    runs.write_summary(q.config_summary(spark, sf), path)
    back = spark.read.parquet(path)
    runs.export_csv(back, f"{path}-csv")
    return spark.read.option("header", True).schema(back.schema).csv(f"{path}-csv")


def split_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A1: one named split of a partitioned dataset."""
    path = _folder(spark, "splits")
    docs = table(spark, sf, "documents", ["doc_id", "lang", "n_chars"])
    docs.withColumn("split", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train")).write.partitionBy(
        "split").parquet(path)
    return load_split(spark, path, "test")


LANGUAGES = (("en", "English"), ("de", "German"), ("fr", "French"), ("es", "Spanish"))


def language_names(spark: SparkSession, sf: str) -> DataFrame:
    """A5: an inline table joined to a count."""
    n = table(spark, sf, "documents", ["lang"]).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return literal_table(spark, LANGUAGES, "lang string, name string").join(n, "lang", "left").select(
        "lang", "name", F.coalesce("n", F.lit(0)).alias("n"))


def _by_length(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pdf["doc_id"], "prediction": (pdf["n_chars"] >= 2000).map({True: "long", False: "short"})})


def _by_source(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pdf["doc_id"], "prediction": ["short" if s.endswith("1") else "long" for s in pdf["source"]]})


def score_models(spark: SparkSession, sf: str) -> DataFrame:
    """Two named scorers over one table, side by side."""
    docs = table(spark, sf, "documents", ["doc_id", "source", "n_chars"])
    p = md.score_models(docs, {"by_length": _by_length, "by_source": _by_source}, "doc_id long, prediction string",
                        ["doc_id", "source", "n_chars"])
    return ex.compare_models(p, docs.select("doc_id", "source"), "doc_id", ["by_length", "by_source"])


# ------------------------------------------------------------------ F1 to J
#: The grid of the experiment.
NB_ALPHAS, NB_MIN_DF, NB_SEEDS, NB_CLASSES = (0.1, 1.0), (1, 2), (0, 1, 2, 3, 4), (0, 1)


def nb_experiment(spark: SparkSession, sf: str) -> DataFrame:
    """F1 -> J1-J4 end to end on real predictions: naive Bayes over smoothing,
    minimum document frequency and seed (bootstrap), three folds by a hash of
    the id; the configuration is chosen on validation and summarised on test."""
    d = table(spark, sf, "documents", ["doc_id", "text"]).join(
        table(spark, sf, "labels", ["doc_id", "quality"]), "doc_id")
    h = md.hash_number(F.col("doc_id")) % 10
    d = d.withColumn("fold", F.when(h == 8, "validation").when(h == 9, "test").otherwise("train"))
    p = md.nb_grid(d, "doc_id", "text", "quality", "fold", NB_CLASSES, NB_ALPHAS, NB_MIN_DF, NB_SEEDS)
    p = p.select("fold", F.lit("quality").alias("task"), F.lit("bayes").alias("model"), F.col("alpha").alias("lr"),
                 F.col("min_df").alias("num_epochs"), "seed", "target", "prediction")
    rep = cm.classification_report(cm.confusion(p, ["fold", *ex.RUN]), ["fold", *ex.RUN])
    best = ex.best_config(ex.config_summary(rep.where(F.col("fold") == "validation")))
    s = ex.seed_summary(ex.restrict_to(rep.where(F.col("fold") == "test").drop("fold"), best))
    return s.select("task", "model", F.col("lr").alias("alpha"), F.col("num_epochs").alias("min_df"), "n_seeds", "metric",
                    "class_name", q._r("mean"), q._r("std"))


def _nb_experiment_sql() -> str:
    from textlab.functions.text import WORD_CLASS as W
    r, run = o.R, ["fold", *o.RUN.split(", ")]
    number = lambda x: f"('0x' || substr(md5({x}), 1, 15))::BIGINT"
    values = lambda xs: ", ".join(f"({x})" for x in xs)
    return f"""
WITH d AS (SELECT doc_id, text, quality AS y,
                  CASE {number("CAST(doc_id AS VARCHAR)")} % 10 WHEN 8 THEN 'validation' WHEN 9 THEN 'test'
                       ELSE 'train' END AS fold FROM documents JOIN labels USING (doc_id)),
seeds(seed) AS (VALUES {values(NB_SEEDS)}), cls(c) AS (VALUES {values(NB_CLASSES)}),
grid AS (SELECT CAST(a AS DOUBLE) AS lr, m AS num_epochs FROM (VALUES {values(NB_ALPHAS)}) x(a), (VALUES {values(NB_MIN_DF)}) z(m)),
w AS (SELECT doc_id, y, fold, word, COUNT(*) AS cnt
      FROM (SELECT doc_id, y, fold, unnest(regexp_extract_all(lower(text), '[{W}]+')) AS word FROM d) GROUP BY ALL),
b AS (SELECT seed, doc_id, y, {number("CAST(seed AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)")} % 3 AS k
      FROM d, seeds WHERE fold = 'train'),
st AS (SELECT b.seed, w.word, b.y AS c, SUM(w.cnt * b.k) AS n FROM w JOIN b USING (doc_id) WHERE b.k > 0 GROUP BY ALL),
df AS (SELECT b.seed, w.word, COUNT(*) AS df FROM w JOIN b USING (doc_id) WHERE b.k > 0 GROUP BY ALL),
voc AS (SELECT g.*, df.seed, df.word FROM df JOIN grid g ON df.df >= g.num_epochs),
vs AS (SELECT lr, num_epochs, seed, COUNT(*) AS v FROM voc GROUP BY ALL),
nc AS (SELECT voc.lr, voc.num_epochs, voc.seed, st.c, SUM(st.n) AS n FROM voc JOIN st USING (seed, word) GROUP BY ALL),
ll AS (SELECT voc.lr, voc.num_epochs, voc.seed, voc.word, cls.c,
              ln((COALESCE(st.n, 0) + voc.lr) / (COALESCE(nc.n, 0) + voc.lr * vs.v)) AS lp
       FROM voc CROSS JOIN cls JOIN vs USING (lr, num_epochs, seed)
       LEFT JOIN st ON st.seed = voc.seed AND st.word = voc.word AND st.c = cls.c
       LEFT JOIN nc ON nc.lr = voc.lr AND nc.num_epochs = voc.num_epochs AND nc.seed = voc.seed AND nc.c = cls.c),
pr AS (SELECT seed, c, ln(SUM(CASE WHEN y = c THEN k ELSE 0 END) / SUM(k)) AS prior FROM b CROSS JOIN cls GROUP BY seed, c),
s AS (SELECT ll.lr, ll.num_epochs, ll.seed, w.doc_id, ll.c, SUM(w.cnt * ll.lp) AS s
      FROM w JOIN ll USING (word) WHERE w.fold <> 'train' GROUP BY ALL),
sc AS (SELECT d.doc_id, d.fold, d.y AS target, g.lr, g.num_epochs, seeds.seed, cls.c,
              COALESCE(pr.prior, 0) + COALESCE(s.s, 0) AS s
       FROM d CROSS JOIN grid g CROSS JOIN seeds CROSS JOIN cls LEFT JOIN pr ON pr.seed = seeds.seed AND pr.c = cls.c
       LEFT JOIN s ON s.lr = g.lr AND s.num_epochs = g.num_epochs AND s.seed = seeds.seed AND s.doc_id = d.doc_id
                  AND s.c = cls.c WHERE d.fold <> 'train'),
pred AS (SELECT fold, 'quality' AS task, 'bayes' AS model, lr, num_epochs, seed, target, c AS prediction
         FROM sc QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id, lr, num_epochs, seed ORDER BY s DESC, c) = 1),
conf AS (SELECT {', '.join(run)}, target, prediction, COUNT(*) AS n FROM pred GROUP BY ALL),
{o.report_ctes('conf', run).replace('rep AS (', 'every AS (')},
rep AS (SELECT * FROM every WHERE fold = 'validation'),
{o._CFG_SUMMARY},
chosen AS (SELECT e.* FROM every e SEMI JOIN best b USING ({o.CFG}) WHERE e.fold = 'test' AND e.metric IN ('accuracy', 'f1'))
SELECT task, model, lr AS alpha, num_epochs AS min_df, CAST(COUNT(DISTINCT seed) AS BIGINT) AS n_seeds,
       CASE WHEN metric = 'f1' THEN 'F1' ELSE 'Accuracy' END AS metric,
       upper(substr(class_name, 1, 1)) || lower(substr(class_name, 2)) AS class_name,
       ROUND(AVG(value), {r}) AS mean, ROUND(STDDEV_SAMP(value), {r}) AS std
FROM chosen GROUP BY task, model, lr, num_epochs, chosen.metric, chosen.class_name
"""


REGISTRY = {f.__name__: f for f in (
    variant_labels, variant_quarantine, variant_spans, variant_scores, variant_scores_first, declared_report,
    label_granularity, attached_labels, seed_metrics, last_turns, exported_summary, split_scan, language_names,
    score_models, nb_experiment)}


def all_sql() -> dict[str, str]:
    r = o.R
    scores = lambda second: (f"WITH {o._qa_score_ctes(False, 'variants', second_gold=second)} "  # noqa: E731
                             f"SELECT seed, ROUND(exact_match, {r}) AS exact_match, ROUND(f1, {r}) AS f1, n FROM scores")
    declared = ", ".join(f"({i}, '{n}')" for i, n in enumerate(DECLARED))
    half = "".join(f"""
UNION ALL SELECT '{g}' AS granularity, CAST(c.class_id AS INTEGER) AS label_id, c.class_name, COUNT(*) AS n,
                 CAST(SUM(length(d.text)) AS BIGINT) AS chars
FROM documents d LEFT JOIN (
  SELECT {col} AS class_name, ROW_NUMBER() OVER (ORDER BY {col}) - 1 AS class_id
  FROM (SELECT DISTINCT {col} FROM documents WHERE doc_id % 2 = 0 AND {col} IS NOT NULL)) c ON c.class_name = d.{col}
GROUP BY c.class_id, c.class_name""" for g, col in (("coarse", "lang"), ("fine", "source")))
    seeds = ", ".join(f"ROUND(MAX(CASE WHEN seed = {s} THEN value END), {r}) AS seed_{s}" for s in q.SEEDS)
    names = ", ".join(f"('{a}', '{b}')" for a, b in LANGUAGES)
    return {
        "variant_labels": o._qa_labels("variants"),
        "variant_quarantine": o._qa_quarantine("variants"),
        "variant_spans": o._span_validation("variants"),
        "variant_scores": scores(True),
        "variant_scores_first": scores(False),
        "declared_report": f"""
WITH {o.SCORED_EMB}, cl(class_id, class_name) AS (VALUES {declared}),
c AS (SELECT cl.class_name AS name, (SELECT COUNT(*) FROM scored) AS n,
             COUNT(*) FILTER (WHERE s.target = cl.class_id) AS t, COUNT(*) FILTER (WHERE s.prediction = cl.class_id) AS p,
             COUNT(*) FILTER (WHERE s.target = cl.class_id AND s.prediction = cl.class_id) AS tp
      FROM cl LEFT JOIN scored s ON s.target = cl.class_id OR s.prediction = cl.class_id GROUP BY cl.class_name),
m AS (SELECT name, (n - t - p + 2 * tp) / n AS accuracy, COALESCE(tp / NULLIF(p, 0), 0) AS precision,
             COALESCE(tp / NULLIF(t, 0), 0) AS recall, COALESCE(2 * tp / NULLIF(p + t, 0), 0) AS f1 FROM c),
a AS (SELECT name AS class_name, accuracy, precision, recall, f1 FROM m
      UNION ALL SELECT 'macro', AVG(accuracy), AVG(precision), AVG(recall), AVG(f1) FROM m
      UNION ALL SELECT 'micro', SUM(tp) / MAX(n), SUM(tp) / MAX(n), SUM(tp) / MAX(n), SUM(tp) / MAX(n) FROM c)
SELECT metric, class_name, ROUND(value, {r}) AS value, {len(DECLARED)} AS n_classes
FROM (UNPIVOT a ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)
""",
        "label_granularity": half.strip().removeprefix("UNION ALL"),
        "attached_labels": "SELECT l.doc_id, l.quality, d.lang, d.n_chars FROM labels l LEFT JOIN documents d USING (doc_id)",
        "seed_metrics": f"{o._val_rep()} SELECT {o.CFG}, metric, class_name, {seeds} FROM rep "
                        f"GROUP BY {o.CFG}, metric, class_name",
        "nb_experiment": _nb_experiment_sql(),
        "last_turns": "SELECT conv_id, turn, role, text FROM conversations "
                      "QUALIFY ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1",
        "exported_summary": o.CONFIG_SUMMARY,
        "split_scan": "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 5 = 0",
        "language_names": f"SELECT l.lang, l.name, COUNT(d.lang) AS n FROM (VALUES {names}) l(lang, name) "
                          "LEFT JOIN documents d ON d.lang = l.lang GROUP BY l.lang, l.name",
        "score_models": "SELECT doc_id, source, CASE WHEN n_chars >= 2000 THEN 'long' ELSE 'short' END AS by_length, "
                        "CASE WHEN source LIKE '%1' THEN 'short' ELSE 'long' END AS by_source FROM documents",
    }
