"""Sub-word pieces with offsets from flat arrays."""
from textlab.operators import textprep as tp


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_piece_tokens_one_worker_a_task(spark):
    ids = spark.createDataFrame([("ab", 4), ("c", 5), ("##c", 6), ("##d", 7), ("d", 8)], "token string, token_id int")
    rows = [(1, "abcd ab", "x abc"), (2, None, ""), (3, "", None), (4, "d🙂 zz", "c")]
    d = spark.createDataFrame(rows, "i int, a string, b string")
    d = tp.piece_tokens(tp.tokenize(tp.tokenize(d, "a", "ta"), "b", "tb"), ["ta", "tb"], ids)
    assert _plan(d).count("ArrowEvalPython") == 1
    as_lists = lambda t: t and (t.tok, t.st, t.en)
    got = {r.i: (as_lists(r.ta), as_lists(r.tb)) for r in d.collect()}
    assert got == {1: (([4, 6, 7, 4], [0, 2, 3, 5], [2, 3, 4, 7]), ([1, 4, 6], [0, 2, 4], [1, 4, 5])),
                   2: (None, ([], [], [])), 3: (([], [], []), None),
                   4: (([8, 1, 1], [0, 1, 3], [1, 2, 5]), ([5], [0], [1]))}
