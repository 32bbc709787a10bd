import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textlab.operators import experiments as ex, labels as lb, models as md, project as pj
from textlab.sources import runs, tables


def test_load_split_prunes(spark):
    d = tempfile.mkdtemp(prefix="textlab-split-", dir="/tmp")
    df = spark.createDataFrame([(i, f"s{i}", "train" if i < 7 else "test") for i in range(10)],
                               "id int, sentence string, split string")
    df.write.mode("overwrite").partitionBy("split").parquet(d)
    got = tables.load_split(spark, d, "test")
    assert sorted(r.id for r in got.collect()) == [7, 8, 9]
    assert "split" not in got.columns
    assert "PartitionFilters: [isnotnull(split" in got._jdf.queryExecution().executedPlan().toString() \
        or "split" in got._jdf.queryExecution().executedPlan().toString()


def test_run_table_roundtrip_and_dynamic_overwrite(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="textlab-runs-", dir="/tmp"), "runs")
    mk = lambda seed, v: spark.createDataFrame(
        [("t", "m", 1e-5, 3, seed, "f1", "macro", v)],
        "task string, model string, lr double, num_epochs int, seed int, metric string, "
        "class_name string, value double")
    runs.write_runs(mk(0, 0.5).unionByName(mk(1, 0.6)), root)
    runs.write_runs(mk(1, 0.9), root)               # replaces seed 1 only
    back = {r.seed: r.value for r in runs.read_runs(spark, root).collect()}
    assert back == {0: 0.5, 1: 0.9}
    assert runs.read_runs(spark, root, seed=[1]).count() == 1
    out = os.path.join(os.path.dirname(root), "csv")
    runs.export_csv(runs.read_runs(spark, root), out)
    assert any(f.endswith(".csv") for f in os.listdir(out))


def test_labels_fit_apply_unseen(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    classes = lb.fit_labels(tr, "label")
    assert [(r.class_id, r.class_name) for r in classes.orderBy("class_id").collect()] == [(0, "a"), (1, "b")]
    te = spark.createDataFrame([("a",), ("c",)], "label string")
    ok, bad = lb.apply_labels(te, classes, on_unseen="quarantine")
    assert ok.count() == 1 and bad.first().label == "c"
    with pytest.raises(Exception):
        lb.apply_labels(te, classes, on_unseen="error").collect()


def test_resolve_models_rules(spark):
    rules = pj.PathRules("fam", "fam-base", "local-base", "-converted", "own", "mine", "theirs")
    paths = [("..\\models\\own-fam-x-converted",), ("org/fam-base",), ("org/other-base",), ("plain-base",),
             ("..\\models\\own-y",)]
    df = pj.resolve_models(spark.createDataFrame(paths, "path string"), rules)
    r = {x.path: x for x in df.collect()}
    a = r[paths[0][0]]
    assert a.model_name == "own-fam-x" and a.tokenizer == "fam-base" and a.output_root == "mine"
    assert r["org/fam-base"].model_name == "org/fam-base"   # family: split on '\\' only
    assert r["org/other-base"].model_name == "other-base"
    assert r["org/other-base"].tokenizer == "org/other-base"
    assert r["plain-base"].output_root == "theirs"
    assert r[paths[4][0]].tokenizer == "local-base"


def test_score_models_and_compare(spark):
    df = spark.createDataFrame([(1, "gut"), (2, "schlecht")], "id int, sentence string")

    def pos(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": pdf["id"], "prediction": ["positive"] * len(pdf)})

    def length(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": pdf["id"],
                             "prediction": ["negative" if len(s) > 5 else "neutral"
                                            for s in pdf["sentence"]]})

    p = md.score_models(df, {"m1": pos, "m2": length}, "id int, prediction string",
                        ["id", "sentence"])
    wide = ex.compare_models(p, df, "id", ["m1", "m2"])
    r = {x.id: x for x in wide.collect()}
    assert r[1].m1 == "positive" and r[1].m2 == "neutral" and r[2].m2 == "negative"


def test_naive_bayes_hand_example(spark):
    tr = spark.createDataFrame([(1, "good good fun", 1), (2, "bad boring", 0), (3, "fun good", 1)],
                               "id int, text string, y int")
    te = spark.createDataFrame([(10, "good"), (11, "boring bad"), (12, "zzz")], "id int, text string")
    ll, prior = md.train_nb(tr, "id", "text", "y", [0, 1], [1.0])
    p = {r.id: r.prediction for r in md.predict_nb(te, "id", "text", ll, prior, [0, 1], [1.0]).collect()}
    assert p == {10: 1, 11: 0, 12: 1}          # unknown words -> prior (2 of 3 docs are 1)


def test_seed_table_pivot(spark):
    m = spark.createDataFrame([("t", "m", 1e-5, 3, s, "f1", "macro", float(s)) for s in range(3)],
                              "task string, model string, lr double, num_epochs int, seed int, "
                              "metric string, class_name string, value double")
    row = ex.seed_table(m, [0, 1, 2]).first()
    assert (row["0"], row["1"], row["2"]) == (0.0, 1.0, 2.0)


def test_choose_label_attach_and_class_names(spark):
    from textlab.operators import clf_metrics as cm
    raw = spark.createDataFrame([("t1", "OFFENSE", "INSULT"), ("t2", "OTHER", "OTHER")],
                                "text string, `coarse-grained` string, `fine-grained` string")
    assert [r.label for r in pj.choose_label(raw, "coarse").collect()] == ["OFFENSE", "OTHER"]
    assert [r.label for r in pj.choose_label(raw, "fine").collect()] == ["INSULT", "OTHER"]
    classes = lb.declared_classes(spark, ["negative", "neutral", "positive"])
    assert lb.n_classes(classes).first().n_classes == 3
    preds = spark.createDataFrame([(1, 0, 0), (2, 2, 1)], "id int, target int, prediction int")
    rep = cm.classification_report(cm.confusion(preds), classes=classes, labels="declared",
                                   declared=[0, 1, 2])
    names = {r.class_name for r in rep.collect()}
    assert {"negative", "neutral", "positive", "macro", "micro"} == names
    extra = spark.createDataFrame([(1, "a"), (2, "b")], "id int, note string")
    got = {r.id: r.note for r in pj.attach_by_key(preds, extra, "id", ["note"]).collect()}
    assert got == {1: "a", 2: "b"}


def test_a_session_started_elsewhere_finds_the_package(tmp_path):
    """Python workers import the package although the working folder is not
    the repository and PYTHONPATH is unset."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from textlab.session import get_spark\nfrom textlab.operators import textprep as tp\n"
            "s = get_spark('local[1]')\n"
            "d = tp.tokenize(s.createDataFrame([('a b',)], 't string'), 't', 'k')\n"
            "print('TOKENS', d.first().k.tok)")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT")}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "TOKENS ['a', 'b']" in out.stdout, out.stderr[-2000:]


def test_checkpoint_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace
    from textlab.session import ensure_checkpoint_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(cluster)


def test_logreg_grid_against_numpy(spark):
    import numpy as np
    import random
    from textlab.operators import models as md
    rnd, words = random.Random(4), ["good", "bad", "the", "a", "plot", "fine", "poor"]
    rows = []
    for i in range(120):
        y = i % 2
        w = [rnd.choice(words) for _ in range(rnd.randrange(0, 12))] + (["good", "fine"] if y else ["bad"]) * rnd.randrange(3)
        rows.append((i, " ".join(w), y, i < 90))
    df = spark.createDataFrame(rows, "id long, text string, y int, fit boolean")
    x = md.hashed_tfidf(df, "id", "text", F.col("fit"), 256).cache()
    feats = {r.id: r for r in x.collect()}
    assert all(r.idx[-1] == 256 and r.val[-1] == 1.0 and len(r.idx) == len(r.val) for r in feats.values())
    assert all(abs(sum(v * v for v in r.val[:-1]) - 1) < 1e-9 for r in feats.values() if any(r.val[:-1]))
    models = md.train_logreg(x.where("fit"), "y", (0.0, 0.1), (5, 15), 256)
    dense, y = np.zeros((90, 257)), np.array([i % 2 for i in range(90)])
    for i in range(90):
        dense[i, feats[i].idx] = feats[i].val
    for reg in (0.0, 0.1):
        decay = np.r_[np.full(256, reg), 0.0]
        w = v = np.zeros(257)
        for t in range(15):
            g = dense.T @ (1 / (1 + np.exp(-dense @ v)) - y) / 90 + decay * v
            new = v - g / (0.5 + reg)
            v, w = new + t / (t + 3) * (new - w), new
            if t + 1 in (5, 15):
                assert np.abs(models[reg, t + 1] - w).max() < 1e-9
    pred = md.predict_logreg(models, x.where("not fit"), "id").collect()
    assert len(pred) == 4 * 30
    for r in pred:
        margin = sum(models[r.reg_param, r.max_iter][i] * v for i, v in zip(feats[r.id].idx, feats[r.id].val))
        assert r.prediction == (margin > 0)
    assert sum(r.prediction == r.id % 2 for r in pred if (r.reg_param, r.max_iter) == (0.0, 15)) > 20
    assert all((w == 0).all() for w in md.train_logreg(x.limit(0), "y", (0.0,), (3,), 256).values())
