"""Naive Bayes over a grid: words are counted once for all seeds."""
from pyspark.sql import functions as F

from textlab.operators import models as md


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nb_grid_counts_words_once_for_all_seeds(spark):
    rows = [(i, f"w{i % 5} w{i % 3} x", i % 2, "train" if i % 4 else "test") for i in range(40)]
    d = spark.createDataFrame(rows, "i int, t string, y int, f string")
    seeds = list(range(33))  # more than one column of draws
    g = md.nb_grid(d, "i", "t", "y", "f", (0, 1), (0.5,), (2,), seeds)
    assert "collect_list" not in _plan(g)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert g.count() == 10 * 33
    for s in (0, 32):
        assert rows(g.where(F.col("seed") == s)) == rows(md.nb_grid(d, "i", "t", "y", "f", (0, 1), (0.5,), (2,), (s,)))
