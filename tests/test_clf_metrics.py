import pytest
from pyspark.sql import functions as F

from textlab.functions.arrays import argmax
from textlab.operators import clf_metrics as cm


def _report(spark, pairs, **kw):
    df = spark.createDataFrame(pairs, "target int, prediction int")
    rep = cm.classification_report(cm.confusion(df), **kw)
    return {(r.metric, r.class_name): r.value for r in rep.collect()}


def test_argmax_ties_and_empty(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([],), ([2.0],)], "l array<double>")
    got = [r[0] for r in df.select(argmax("l")).collect()]
    assert got == [1, None, 0]


def test_report_hand_computed(spark):
    # targets 0,0,1,1,2 ; predictions 0,1,1,1,0
    r = _report(spark, [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)])
    assert r[("precision", "0")] == pytest.approx(0.5)
    assert r[("recall", "0")] == pytest.approx(0.5)
    assert r[("precision", "1")] == pytest.approx(2 / 3)
    assert r[("recall", "1")] == pytest.approx(1.0)
    assert r[("f1", "2")] == 0.0
    # one-vs-rest accuracy of class 0: TP 1 + TN 2 (rows 1,1 / 1,1 / ... ) over 5
    assert r[("accuracy", "0")] == pytest.approx(3 / 5)
    assert r[("accuracy", "macro")] == pytest.approx((3 / 5 + 4 / 5 + 4 / 5) / 3)
    assert r[("f1", "macro")] == pytest.approx((0.5 + 0.8 + 0.0) / 3)
    for m in ("accuracy", "precision", "recall", "f1"):
        assert r[(m, "micro")] == pytest.approx(3 / 5)


def test_absent_class_declared_vs_observed(spark):
    pairs = [(0, 0), (1, 1), (1, 0)]
    obs = _report(spark, pairs)
    assert ("f1", "2") not in obs
    dec = _report(spark, pairs, labels="declared", declared=[0, 1, 2])
    assert dec[("f1", "2")] == 0.0
    assert dec[("accuracy", "2")] == 1.0   # no TP/FP/FN: every row is a TN
    assert dec[("f1", "macro")] == pytest.approx((obs[("f1", "0")] + obs[("f1", "1")]) / 3)


def test_confusion_sums_to_n(spark):
    import random
    rnd = random.Random(3)
    pairs = [(rnd.randrange(4), rnd.randrange(4)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "target int, prediction int")
    dense = cm.dense_confusion(cm.confusion(df), range(4))
    assert dense.count() == 16
    assert dense.agg(F.sum("n")).first()[0] == 300


def test_multilabel(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["a"]), (2, ["b"], ["b", "c"])],
                               "id int, t array<string>, p array<string>")
    r = {(x.metric, x.class_name): x.value
         for x in cm.multilabel_report(df, "id", "t", "p").collect()}
    # a: tp1 ; b: tp1 fn1 ; c: fp1 -> micro tp2 fp1 fn1
    assert r[("f1", "micro")] == pytest.approx(4 / 6)
    assert r[("recall", "b")] == pytest.approx(0.5)
    assert r[("precision", "c")] == 0.0


def test_top_k_nan_first_null_last(spark):
    from textlab.functions.arrays import top_k_indices
    df = spark.createDataFrame([([1.0, float("nan"), None, 3.0, 3.0],)], "l array<double>")
    assert df.select(top_k_indices("l", 5)).first()[0] == [1, 3, 4, 0, 2]
    assert df.select(top_k_indices("l", 2)).first()[0] == [1, 3]


def test_with_top_k_equals_top_k_indices(spark):
    import random
    from textlab.functions.arrays import top_k_indices, with_top_k
    rnd = random.Random(11)
    rows = [([rnd.choice([float(rnd.randrange(4)), float("nan"), None, rnd.random()])
              for _ in range(rnd.randrange(0, 40))],) for _ in range(500)]
    df = spark.createDataFrame(rows, "l array<double>")
    for k in (1, 5, 20):
        a = [r[0] for r in df.select(top_k_indices("l", k).alias("a")).collect()]
        b = [r.o for r in with_top_k(df, {"o": "l"}, k).select("o").collect()]
        assert a == b


def test_undeclared_class_is_an_error(spark):
    import pytest
    conf = cm.confusion(spark.createDataFrame([(0, 0), (1, 0), (1, 1), (7, 1)], "target int, prediction int"))
    with pytest.raises(Exception, match="not declared"):
        cm.classification_report(conf, labels="declared", declared=[0, 1]).collect()
    with pytest.raises(Exception, match="not declared"):
        cm.dense_confusion(conf, [0, 1]).collect()
