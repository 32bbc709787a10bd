import pytest
from pyspark.sql import functions as F

from textlab.operators import experiments as ex


def test_qa_summary_clean_and_contaminated(spark):
    rows = [("t", "m", s, "exact_match", float(v)) for s, v in enumerate([1, 2, 3, 4, 9])]
    df = spark.createDataFrame(rows, "task string, model string, seed int, metric string, value double")
    clean = ex.qa_summary(df).first()
    assert clean["mean"] == pytest.approx(3.8)
    assert clean["median"] == pytest.approx(3.0)
    assert clean["std"] == pytest.approx(3.114482, abs=1e-6)
    comp = ex.qa_summary(df, compat_contaminated=True).first()
    assert comp["median"] == pytest.approx(3.4)
    import statistics
    assert comp["std"] == pytest.approx(statistics.stdev([1, 2, 3, 4, 9, 3.8, 3.4]))


def _metrics(spark, rows):
    return spark.createDataFrame(
        [("t", "m", lr, ep, seed, "f1", "macro", v) for lr, ep, seed, v in rows] +
        [("t", "m", lr, ep, seed, "accuracy", "macro", v) for lr, ep, seed, v in rows],
        "task string, model string, lr double, num_epochs int, seed int, metric string, "
        "class_name string, value double")


def test_config_summary_population_std_and_best_tie(spark):
    m = _metrics(spark, [(1e-5, 3, 0, 0.5), (1e-5, 3, 1, 0.7),
                         (2e-5, 3, 0, 0.6), (2e-5, 3, 1, 0.6)])
    s = ex.config_summary(m)
    r = {x.lr: x for x in s.collect()}
    assert r[1e-5].std_f1 == pytest.approx(0.1)      # population std
    best = ex.best_config(s).first()
    assert best.lr == 1e-5                           # tie on mean -> smaller lr


def test_seed_summary_sample_std_and_names(spark):
    m = _metrics(spark, [(1e-5, 3, 0, 0.5), (1e-5, 3, 1, 0.7)])
    r = ex.seed_summary(m).where(F.col("metric") == "F1").first()
    assert r.class_name == "Macro" and r["std"] == pytest.approx(0.141421356, abs=1e-8)


def test_grid_points_numbering():
    pts = ex.grid_points(lr=[1, 2], num_epochs=[3], seed=[0, 1])
    assert len(pts) == 4 and [p["config_no"] for p in pts] == [0, 0, 1, 1]
