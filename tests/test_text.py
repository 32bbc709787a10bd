import pytest
from pyspark.sql import functions as F

from textlab.functions.text import capitalize, multiset_overlap, normalize_answer, split_ws, strip_left
from textlab.operators.qa_metrics import example_scores


def _one(spark, col_fn, value):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(col_fn(F.col("x"))).first()[0]


def test_strip_left_unicode_whitespace(spark):
    s = "\t \u001c\u0085  Wer?"
    assert _one(spark, strip_left, s) == "Wer?"
    assert _one(spark, strip_left, s) == s.lstrip()


def test_normalize_keeps_umlaut_like_word(spark):
    assert _one(spark, normalize_answer, "er aß") == "er aß"
    assert _one(spark, normalize_answer, "The  Cat, a dog!") == "cat dog"
    assert _one(spark, normalize_answer, "a a a x") == "x"


def test_capitalize(spark):
    assert _one(spark, capitalize, "real_invest X") == "Real_invest x"
    assert _one(spark, capitalize, "macro") == "Macro"


def test_multiset_overlap(spark):
    df = spark.createDataFrame([("ja ja nein", "ja nein nein")], "p string, g string")
    assert df.select(multiset_overlap(split_ws("p"), split_ws("g"))).first()[0] == 2


def _scores(spark, pred, gold):
    p = spark.createDataFrame([("1", pred)], "example_id string, prediction_text string")
    e = spark.createDataFrame([("1", ([0], [gold]))],
                              "id string, answers struct<answer_start: array<int>, text: array<string>>")
    r = example_scores(p, e).first()
    return r.exact_match, r.f1


def test_squad_f1_and_em(spark):
    em, f1 = _scores(spark, "ja ja nein", "ja nein nein")
    assert em == 0.0 and f1 == pytest.approx(2 / 3)
    em, _ = _scores(spark, "der Vorstand", "Vorstand")
    assert em == 0.0          # only English articles are removed
    em, f1 = _scores(spark, "The Vorstand.", "vorstand")
    assert em == 1.0 and f1 == 1.0
