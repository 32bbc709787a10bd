"""Single-sequence encoding against a broadcast vocabulary."""
from textlab.operators import textprep as tp


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encode_single_broadcasts_the_vocabulary(spark):
    rows = [(1, ["a", "b", "c"]), (2, None), (3, ["b"]), (3, ["z", "a"]), (None, ["a"]), (4, [])]
    d = spark.createDataFrame(rows, "id int, toks array<string>")
    v = spark.createDataFrame([("a", 4), ("b", 5)], "token string, token_id int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = tp.encode_single(d, "toks", v, "id", max_length=4)
        assert "SortMergeJoin" not in _plan(e)
        got = sorted((r.id or 0, r.n_tokens is None, r.n_tokens or 0, r.truncated, r.input_ids, r.attention_mask) for r in e.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    none, both = [2, 3, 0, 0], [2, 1, 5, 4, 3]  # a repeated id: the tokens of both rows, unknown ones first
    assert got == [(0, False, 1, False, none, [1, 1, 0, 0]), (1, False, 3, True, [2, 4, 5, 3], [1] * 4),
                   (2, True, 0, None, none, [1, 1, 0, 0]), (3, False, 1, False, both, [1] * 5),
                   (3, False, 2, False, both, [1] * 5), (4, False, 0, False, none, [1, 1, 0, 0])]
