"""Overlong questions and the logits of every seed."""
import pytest

from textlab.operators import qa, textprep as tp

EX = "id string, question string, context string, answers struct<answer_start: array<int>, text: array<string>>"


def test_overlong_question_is_counted_not_tokenised(spark):
    rows = [("long", "w " * 400, "a b", ([0], ["a"])), ("ok", " who is", "a b c", ([0], ["a"])), ("none", None, "a b", ([], []))]
    p = tp.prepare_qa(spark.createDataFrame(rows, EX), 384, 128)
    got = {r.id: r for r in p.collect()}
    assert got["long"].q_tok is None and got["long"].c_tok is None
    assert [(got[i].n_q, got[i].n_ctx, got[i].budget) for i in ("long", "ok", "none")] == [(400, 2, -19), (2, 3, 379), (None, 2, None)]
    assert got["ok"].q_tok.tok == ["who", "is"]
    assert {(r.example_id, r.reason) for r in tp.quarantine_qa(p).collect()} == {("long", "question too long"), ("none", "null question")}


@pytest.mark.parametrize("seeds", [(0, 1, 5), (-2, 1)])
def test_logits_of_every_seed(spark, seeds):
    p = tp.prepare_qa(spark.createDataFrame([("1", "b", "a b, c d", ([0], ["a"]))], EX), 384, 128)
    w = tp.window_offsets(tp.windows(p, 128))
    for r in qa.overlap_logits(w, seeds).collect():
        m, wd, lo = [0, 1, 0, 0, 0], [1, 1, 0, 1, 1], r.ctx_lo
        jit = lambda j, k: 0.5 * (abs(j + k * r.seed) % 3) * (1 if j + k * r.seed >= 0 else -1)
        assert r.start_logits[lo:lo + 5] == [4 * m[j] + 2 * (m[j + 1] if j < 4 else 0) + wd[j] + jit(j, 1) for j in range(5)]
        assert r.end_logits[lo:lo + 5] == [4 * m[j] + 2 * (m[j - 1] if j else 0) + wd[j] + jit(j, 2) for j in range(5)]
        assert r.start_logits[:lo] == [0.0, -1.0, -1.0] and r.end_logits[lo + 5:] == [-1.0]
