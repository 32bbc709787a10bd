import pytest
from pyspark.sql import functions as F

from textlab.operators import qa, textprep as tp

EX_SCHEMA = ("id string, question string, context string, "
             "answers struct<answer_start: array<int>, text: array<string>>")


def _windows(spark, rows, max_length=384, stride=128):
    ex = spark.createDataFrame(rows, EX_SCHEMA)
    prep = tp.prepare_qa(ex, max_length, stride)
    return prep, tp.window_offsets(tp.windows(prep, stride))


def test_tokenize_offsets_roundtrip(spark):
    text = "Die  Brutto-Marge (2022: 49,1 %) stieg. 🙂 Ünd ß!"
    df = tp.tokenize(spark.createDataFrame([(text,)], "t string"), "t", "k")
    k = df.first().k
    assert all(text[s:e] == t for t, s, e in zip(k.tok, k.st, k.en))
    assert "".join(k.tok) == "".join(text.split())


def _ref_starts(n_ctx, budget, stride):
    out, s = [], 0
    while True:
        out.append(s)
        if s + budget >= n_ctx:
            return out
        s += budget - stride


@pytest.mark.parametrize("n_words", [1, 10, 15, 16, 26, 27, 60, 101])
def test_window_starts_match_loop(spark, n_words):
    ctx = " ".join(f"w{i}" for i in range(n_words))
    _, w = _windows(spark, [("1", "Wer ist", ctx, ([], []))], max_length=20, stride=4)
    got = [r.w_start for r in w.orderBy("window_idx").collect()]
    assert got == _ref_starts(n_words, 20 - 2 - 3, 4)


def test_answer_in_last_context_token(spark):
    rows = [("1", "Wer?", "a b c", ([4], ["c"]))]
    _, w = _windows(spark, rows)
    r = tp.label_spans(w).first()
    assert (r.start_position, r.end_position) == (6, 6)      # ctx_lo = 4
    r = tp.label_spans(w, 384, compat_last_token=True).first()
    assert r.start_position == 383


def test_answer_outside_window_and_no_answer(spark):
    ctx = " ".join(f"w{i}" for i in range(30))
    start = ctx.index("w25")
    rows = [("1", "Wer ist", ctx, ([start], ["w25"])), ("2", "Wer ist", ctx, ([], []))]
    _, w = _windows(spark, rows, max_length=20, stride=4)
    lab = {(r.example_id, r.window_idx): (r.start_position, r.end_position)
           for r in tp.label_spans(w, 20).collect()}
    assert lab[("1", 0)] == (0, 0)
    s, e = lab[("1", 1)]
    assert s == e and s > 0
    assert all(v == (0, 0) for k, v in lab.items() if k[0] == "2")


def test_question_too_long_is_quarantined(spark):
    rows = [("1", "a b c d e f", "x y z", ([0], ["x"]))]
    prep, w = _windows(spark, rows, max_length=10, stride=4)
    assert w.count() == 0
    q = tp.quarantine_qa(prep, 4).collect()
    assert [(r.example_id, r.reason) for r in q] == [("1", "question too long")]


def test_validate_spans(spark):
    ctx = "Das Datum ist heute. Das Datum."
    rows = [("ok", "q", ctx, ([4], ["Datum"])), ("bad", "q", ctx, ([23], ["Datum."])),
            ("miss", "q", ctx, ([0], ["Morgen"])), ("none", "q", ctx, ([], []))]
    ex = spark.createDataFrame(rows, EX_SCHEMA)
    st = {r.id: (r.status, r.found_start) for r in tp.validate_spans(ex).collect()}
    assert st["ok"][0] == "ok"
    assert st["bad"] == ("repairable", ctx.index("Datum."))
    assert st["miss"][0] == "missing" and st["none"][0] == "no_answer"
    # a correct stored offset is kept even if the text occurs earlier
    ex2 = spark.createDataFrame([("x", "q", ctx, ([21], ["Das"]))], EX_SCHEMA)
    assert tp.validate_spans(ex2).first().status == "ok"


def _scored(spark, rows, context="a b c"):
    return spark.createDataFrame([r + (context,) for r in rows],
                                 "example_id string, window_idx int, "
                                 "offsets array<struct<st:int,en:int>>, "
                                 "start_logits array<double>, end_logits array<double>, "
                                 "context string")


def test_best_answer_no_valid_span(spark):
    offs = [None, (0, 1), (2, 3), (4, 5)]
    sw = _scored(spark, [("1", 0, offs, [0.0, 0.0, 0.0, 9.0], [0.0, 9.0, 0.0, 0.0])])
    ex = spark.createDataFrame([("1", "a b c")], "id string, context string")
    r = qa.best_answers(sw, ex, n_best=1).first()
    assert r.prediction_text == "" and r.score == 0.0


def test_best_answer_ties_first_window_then_rank(spark):
    offs = [None, (0, 1), (2, 3), (4, 5)]
    rows = [("1", 0, offs, [0.0, 1.0, 1.0, 0.0], [0.0, 1.0, 1.0, 0.0]),
            ("1", 1, offs, [0.0, 1.0, 1.0, 0.0], [0.0, 1.0, 1.0, 0.0])]
    ex = spark.createDataFrame([("1", "a b c"), ("2", "x")], "id string, context string")
    res = {r.example_id: r for r in qa.best_answers(_scored(spark, rows), ex).collect()}
    # best score 2.0: first pair in (window 0, start rank 0 -> index 1, end rank 0 -> index 1)
    assert res["1"].prediction_text == "a" and res["1"].score == 2.0
    assert res["2"].prediction_text == "" and res["2"].score == 0.0


def test_wordpiece_against_bruteforce(spark):
    vocab = {"spiel", "##en", "##e", "s", "##p", "##i", "##l", "##n", "e", "n"}
    assert tp.wordpiece_split("spielen", vocab) == ["spiel", "##en"]
    assert tp.wordpiece_split("xyz", vocab) == ["[UNK]"]
    df = spark.createDataFrame([("spielen spiele",)], "text string")
    v = spark.createDataFrame([(t,) for t in vocab], "token string")
    got = {r.word: r.pieces for r in tp.subword(df, "text", v).collect()}
    assert got == {w: tp.wordpiece_split(w, vocab) for w in ("spielen", "spiele")}


def test_encode_single(spark):
    toks = spark.createDataFrame([(1, ["a", "b", "zz"]), (2, [])], "id int, toks array<string>")
    vocab = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3),
                                   ("a", 4), ("b", 5)], "token string, token_id int")
    r = {x.id: x for x in tp.encode_single(toks, "toks", vocab, "id", max_length=4).collect()}
    assert r[1].input_ids == [2, 4, 5, 3] and r[1].truncated
    assert r[2].input_ids == [2, 3, 0, 0] and r[2].attention_mask == [1, 1, 0, 0]


def test_locate_passages_complete_without_leading_token(spark):
    docs = spark.createDataFrame([(1, "xxDie Marge stieg deutlich an."), (2, "Die Marge sank."),
                                  (3, "Die Marge stieg deutlich an. Die Marge stieg deutlich an.")],
                                 "doc_id int, text string")
    pas = spark.createDataFrame([(7, "Die Marge stieg deutlich"), (8, "zu kurz")],
                                "item_id int, text string")
    got = {(r.item_id, r.doc_id): r.pos for r in
           tp.locate_passages(docs, "doc_id", "text", pas, "item_id", "text").collect()}
    # doc 1: the passage's first word is glued to "xx" and still found; doc 3:
    # first occurrence; doc 2: no match; item 8 has no inner word
    assert got == {(7, 1): 2, (7, 3): 0}


def test_keep_last_per_id(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("b", 1, "y"), ("a", 2, "z")],
                               "id string, pos int, text string")
    got = {r.id: r.text for r in qa.keep_last_per_id(df, "id", "pos").collect()}
    assert got == {"a": "z", "b": "y"}


def test_locate_passages_of_every_kind(spark):
    """Single words, glued ends, short and long passages without inner words,
    against a plain substring search."""
    texts = ["xxDie Marge stieg deutlich an.", "Die Marge sank.", "Die Marge stieg deutlich an. Die Marge stieg deutlich an.",
             "Unternehmensergebnis", "ab", "a", "", None, "x Marge", "Margen stiegen 🙂 sehr"]
    pas = ["Die Marge stieg deutlich", "Marge sank.", "Marge", "a", "Unternehmensergebnis", "ergebnis", "Die Marge", "🙂",
           ". Die", "", None, "nicht da", "fehlt", "Marge s"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    p = spark.createDataFrame(list(enumerate(pas)), "item_id int, text string")
    got = {(r.item_id, r.doc_id): r.pos for r in tp.locate_passages(d, "doc_id", "text", p, "item_id", "text").collect()}
    assert got == {(i, j): t.index(x) for i, x in enumerate(pas) if x for j, t in enumerate(texts) if t and x in t}


def test_windows_and_quarantine_cover_every_id(spark):
    rows = [("ok", "Wer ist", "a b c", ([], [])), ("nq", None, "a b", ([], [])), ("nc", "Wer", None, ([], [])),
            ("ec", "Wer", "", ([], [])), ("wc", "Wer", " \n ", ([], [])), ("et", "Wer", "a b", ([0], [""])),
            ("lq", "a b c d e f", "x", ([], [])), ("eq", "", "a", ([], []))]
    prep, w = _windows(spark, rows, max_length=12, stride=4)
    bad = {r.example_id: r.reason for r in tp.quarantine_qa(prep, 4).collect()}
    assert bad == {"nq": "null question", "nc": "null context", "ec": "no context tokens", "wc": "no context tokens",
                   "et": "empty answer text", "lq": "question too long"}
    assert {r.example_id for r in w.collect()} == {"ok", "eq"}


def test_four_special_tokens(spark):
    ex = spark.createDataFrame([("1", "Wer ist", "a b c d", ([0], ["a"]))], EX_SCHEMA)
    w = tp.window_offsets(tp.windows(tp.prepare_qa(ex, 384, 128, n_special=4)))
    r = tp.label_spans(w).first()
    assert (r.ctx_lo, r.seq_len, r.start_position) == (5, 10, 5)


def test_tokens_are_the_same_with_and_without_offsets(spark):
    texts = ["a\U0001DF00b", "x\u1c8ay", None, "", "a b  c\x1c", "Ä-1_2 ½ 🙂🙂"]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = tp.tokenize(d, "t", "k").select("i", "k", tp.native_tokens("t").alias("n")).collect()
    for r in got:
        assert (r.k.tok if r.k else None) == r.n
        if r.k:
            assert [texts[r.i][s:e] for s, e in zip(r.k.st, r.k.en)] == r.k.tok


def test_long_words_are_split(spark):
    assert tp.wordpiece_split("ab" * 500, {"a", "b", "##a", "##b"}) == ["a"] + ["##b", "##a"] * 499 + ["##b"]


def test_examples_without_prediction_count(spark):
    from textlab.operators import qa_metrics as qm
    ex = spark.createDataFrame([("1", "q", "c", ([0], ["x y"])), ("2", "q", "c", ([0], ["z"])), ("3", "q", "c", ([], []))],
                               EX_SCHEMA)
    pred = spark.createDataFrame([(0, "1", "x y"), (1, "1", "x"), (0, "9", "unknown"), (1, "2", "z")],
                                 "seed int, example_id string, prediction_text string")
    got = {r.seed: (round(r.exact_match, 6), round(r.f1, 6), r.n) for r in qm.squad_scores(pred, ex, keys=["seed"]).collect()}
    assert got == {0: (round(100 / 3, 6), round(100 / 3, 6), 3), 1: (round(100 / 3, 6), round((2 / 3 + 1) * 100 / 3, 6), 3)}


def test_trie_equals_the_greedy_split():
    import random
    rnd = random.Random(11)
    for _ in range(300):
        letters = "abc"[:rnd.randrange(1, 4)]
        word = lambda n: "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, n)))
        vocab = {rnd.choice(["", "##"]) + word(6) for _ in range(rnd.randrange(1, 12))}
        trie = tp.PieceTrie(vocab)
        for _ in range(30):
            w = word(14)
            assert trie.split(w) == tp.wordpiece_split(w, vocab), (w, vocab)
    assert tp.PieceTrie({"a", "##a", "##aa"}).split("a" * 20_001) == ["a"] + ["##aa"] * 10_000


def test_vocabulary_that_is_too_large_is_not_shipped(spark):
    v = spark.range(11).select(F.col("id").cast("string").alias("token"))
    with pytest.raises(ValueError):
        tp.subword(spark.createDataFrame([("a",)], "text string"), "text", v, most=10)


def test_pair_encoding_on_both_sides(spark):
    ids = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3), ("wer", 4), ("ab", 5), ("##c", 6),
                                 ("d", 7), ("?", 8)], "token string, token_id int")
    rows = [("1", "  wer?", "abc xy d abc", ([9], ["abc"])), ("2", "wer", "d", ([], [])), ("3", None, "d", ([], []))]
    ex = spark.createDataFrame(rows, EX_SCHEMA)
    out = {}
    for right in (True, False):
        w = tp.windows(tp.prepare_qa(ex, 11, 2, pad_on_right=right, ids=ids), 2)
        for r in tp.pair_encoding(tp.label_spans(w, 11), 11).collect():
            out[r.example_id, right, r.window_idx] = r
    spans = [(0, 2), (2, 3), (4, 6), (7, 8), (9, 11), (11, 12)]  # ab ##c [UNK] d ab ##c
    n = None
    r = out["1", True, 0]
    assert r.input_ids == [2, 4, 8, 3, 5, 6, 1, 7, 5, 6, 3] and r.attention_mask == [1] * 11
    assert r.sequence_ids == [n, 0, 0, n, 1, 1, 1, 1, 1, 1, n]
    assert [tuple(o) if o else None for o in r.offsets] == [n] * 4 + spans + [n]
    assert (r.cls_index, r.start_position, r.end_position) == (0, 8, 9)
    r = out["2", True, 0]
    assert r.input_ids == [2, 4, 3, 7, 3] + [0] * 6 and r.attention_mask == [1] * 5 + [0] * 6
    assert (r.cls_index, r.start_position, r.end_position) == (0, 0, 0)
    r = out["1", False, 0]
    assert r.input_ids == [2, 5, 6, 1, 7, 5, 6, 3, 4, 8, 3]
    assert r.sequence_ids == [n, 0, 0, 0, 0, 0, 0, n, 1, 1, n]
    assert (r.cls_index, r.start_position, r.end_position) == (0, 5, 6)
    r = out["2", False, 0]
    assert r.input_ids == [0] * 6 + [2, 7, 3, 4, 3] and r.sequence_ids == [n] * 7 + [0, n, 1, n]
    assert [tuple(o) if o else None for o in r.offsets] == [n] * 7 + [(0, 1)] + [n] * 3
    assert (r.cls_index, r.start_position, r.end_position) == (6, 6, 6)
    assert {k[0] for k in out} == {"1", "2"}


def test_windows_carry_their_own_slice_only(spark):
    rows = [("1", "Wer ist", "\U0001F642 " + " ".join(f"w{i}" for i in range(40)), ([], []))]
    _, w = _windows(spark, rows, max_length=20, stride=4)
    assert "context" not in w.columns and "c_tok" not in w.columns
    for r in w.collect():
        assert len(r.ctx_tok) == r.w_len <= 15 and r.ctx_at == r.ctx_st[0]
        assert r.ctx_text == rows[0][2][r.ctx_st[0]:r.ctx_en[-1]]


def test_qa_plans_have_no_python(spark):
    from textlab.plans import queries as q
    for name in ("qa_features", "qa_labels", "qa_quarantine", "qa_predictions", "long_qa_labels"):
        plan = q.REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name
