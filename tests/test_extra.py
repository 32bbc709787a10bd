"""Stored span model, epoch export, repeated and re-sent records, run trees,
batched map."""
import math
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textlab.operators import batching as bt, models as md, qa, span_model as sm, textprep as tp
from textlab.plans import extra
from textlab.sources import runs
from textlab.streaming import upserts

EX_SCHEMA = ("id string, question string, context string, "
             "answers struct<answer_start: array<int>, text: array<string>>")


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="textlab-extra-", dir="/tmp"), name)


def test_span_model_counts_and_scores(spark):
    rows = [("1", "Wer kam an?", "Anna kam spät , sehr spät", ([9], ["spät"])), ("2", "Wann", "gestern abend", ([], []))]
    ex = spark.createDataFrame(rows, EX_SCHEMA)
    w = sm.token_features(tp.label_spans(tp.window_offsets(tp.windows(tp.prepare_qa(ex, 20, 4), 4)), 20), 20)
    got = {r.example_id: r for r in w.collect()}

    def feature(q, tokens, j):
        m = lambda i: int(0 <= i < len(tokens) and tokens[i].lower() in q)
        return (((m(j) * 2 + m(j - 1)) * 2 + m(j + 1)) * 2 + int(tokens[j][0].isalnum())) * 16 + min(len(tokens[j]), 15)

    tokens = rows[0][2].split()
    want = [256] + [257] * 5 + [feature({"wer", "kam", "an"}, tokens, j) for j in range(6)] + [257] * 8
    assert got["1"].features == want and len(got["2"].features) == 20
    model = {r.feature: r for r in sm.fit_span_model(w).collect()}
    n = Counter(f for r in got.values() for f in r.features if f != 257)
    at = Counter(r.features[r.start_position] for r in got.values())
    assert {f: r.start_logit for f, r in model.items()} == {
        f: round(math.log((at[f] + 0.01) / (n[f] + 1)), 6) for f in n}
    path = folder("model")
    sm.fit_span_model(w).write.parquet(path)
    for r in sm.model_logits(w, path, 20).collect():
        f = got[r.example_id].features[:r.seq_len]
        assert r.start_logits == [model[x].start_logit if x != 257 else -100.0 for x in f]
        assert r.end_logits == [model[x].end_logit if x != 257 else -100.0 for x in f]


def test_exported_shards_and_manifest_gaps(spark):
    b = bt.shuffled_batches(spark.range(53).withColumnRenamed("id", "doc_id"), "doc_id", [0], [0, 1], 8)
    path = folder("epochs")
    manifest = bt.write_batches(b, path, 4)
    m = sorted(map(tuple, manifest.select("epoch", "shard", "first_position", "last_position", "n_rows").collect()))
    assert m == [(e, s, 14 * s, min(14 * s + 13, 52), 14 if s < 3 else 11) for e in (0, 1) for s in range(4)]
    assert bt.manifest_gaps(manifest).count() == 0
    for r in manifest.collect():  # one sorted file a shard
        rows = spark.read.parquet(r.file).collect()
        assert [x.position for x in rows] == list(range(r.first_position, r.last_position + 1))
    broken = manifest.withColumn("n_rows", F.when(F.col("shard") == 2, F.col("n_rows") - 1).otherwise(F.col("n_rows")))
    assert {(r.epoch, r.shard) for r in bt.manifest_gaps(broken).collect()} == {(0, 2), (1, 2)}
    lost = manifest.where("not (epoch = 1 and shard = 1)")
    assert {(r.epoch, r.shard) for r in bt.manifest_gaps(lost).collect()} == {(1, 2)}
    assert bt.write_batches(b.limit(0), folder("none"), 4).count() == 0


def test_answers_of_repeated_ids_come_from_the_last_context(spark):
    schema = ("example_id string, nth int, window_idx int, offsets array<struct<st:int,en:int>>, "
              "start_logits array<double>, end_logits array<double>, ctx_text string, ctx_at int")
    off = [None, (0, 2), (3, 5)]
    w = spark.createDataFrame([("a", 1, 0, off, [0., 5., 1.], [0., 5., 1.], "ab cd", 0),
                               ("a", 2, 0, off, [0., 1., 5.], [0., 1., 5.], "ef gh", 0),
                               ("b", 1, 0, off, [0., 1., 9.], [0., 1., 9.], "ij kl", 0),
                               ("b", 2, 0, off, [0., 1., 2.], [0., 1., 2.], "mn op", 0)], schema)
    ex = spark.createDataFrame([("a", 1, "ab cd"), ("a", 2, "ef gh"), ("b", 1, "ij kl"), ("b", 2, "mn op"), ("c", 1, "x")],
                               "id string, nth int, context string")
    got = {r.example_id: (r.prediction_text, r.score) for r in qa.best_answers(w, ex, order_col="nth").collect()}
    # a: equal scores, the earlier example's span, read in the last context; b: the first one's better span
    assert got == {"a": ("ef", 10.0), "b": ("op", 18.0), "c": ("", 0.0)}


def test_upserts_keep_the_last_record_and_can_be_repeated(spark):
    source, table = folder("sent"), folder("table")
    rows = [[(i, 0, f"first {i}") for i in range(40)], [(i, 1, f"again {i}") for i in range(0, 40, 3)] + [(99, 1, "new")],
            [(3, 0, "late but old"), (6, 2, "x"), (6, 3, "y")]]
    for part in rows:
        spark.createDataFrame(part, "k int, n int, t string").coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    want = {}
    for k, n, t in sorted(x for part in rows for x in part):
        want[k] = (n, t)
    for _ in range(2):  # the second run sends everything again
        got = upserts.upsert_stream(spark, source, schema, table, ["k"], ["n"], buckets=4)
        assert {r.k: (r.n, r.t) for r in got.collect()} == want and got.count() == len(want)


def test_run_tree_is_found_by_path(spark):
    rows = [("t", "m", lr, ep, s, "f1", lr * s) for lr in (1e-05, 0.5) for ep in (3, 4) for s in (0, 1, 10)]
    root = folder("tree")
    runs.write_run_tree(spark.createDataFrame(
        rows, "task string, model string, lr double, num_epochs int, seed int, metric string, value double"), root)
    os.makedirs(f"{root}/m/t/notes")
    assert os.path.isdir(f"{root}/m/t/lr_1e-05 num_epochs_3/seed_10")
    assert sorted(map(tuple, runs.discover_runs(spark, root).collect())) == sorted(rows)
    got = runs.discover_runs(spark, root, lr=1e-05, seed=[0, 10])
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[2] == 1e-05 and r[4] in (0, 10))
    assert len(got.inputFiles()) == 4  # other folders are not listed
    with pytest.raises(ValueError):
        runs.discover_runs(spark, root, epochs=3)


def test_batched_map_changes_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (4, "c")], "i int, t string")

    def cut(batch, sep, upper=False):
        out = [(i, w.upper() if upper else w) for i, t in zip(batch["i"], batch["t"]) for w in (t or "").split(sep) if w]
        return {"word": [w for _, w in out], "n": [i for i, _ in out]}

    got = md.batched_map(df, cut, "n int, word string", {"sep": " ", "upper": True})
    assert got.columns == ["n", "word"] and sorted(map(tuple, got.collect())) == [(1, "A"), (1, "B"), (4, "C")]
    same = md.batched_map(df, lambda b: {"size": [len(t or "") for t in b["t"]]}, "size long", remove_columns=["t"])
    assert same.columns == ["i", "size"] and sorted(map(tuple, same.collect())) == [(1, 3), (2, 0), (3, 0), (4, 1)]
    assert md.batched_map(df.limit(0), cut, "n int, word string", {"sep": " "}).collect() == []


def test_batch_windows_match_the_native_expansion():
    b = {"id": ["a", "b", "c", "d", "e"], "n_q": [2, 2, None, 9, 0], "n_ctx": [31, 0, 5, 5, 3]}
    got = extra.cut_batch(b, 20, 8)
    assert list(zip(*got.values())) == [("a", 0, 0, 15), ("a", 1, 7, 15), ("a", 2, 14, 15), ("a", 3, 21, 10), ("e", 0, 0, 3)]
