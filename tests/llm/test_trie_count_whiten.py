"""Prefix trie, token counts and whitening against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.llm import prefix_trie, queries, token_count, whitening

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- prefix trie
def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[32:62]
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    rebuilt, members, kids = {}, {}, {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(rebuilt[c]) + 1):
            members.setdefault(rebuilt[c][:d], []).append(c)
    for q in members:
        kids.setdefault(q[:-1], []).append(q) if q else None
    leaves, saved, out = {}, {}, []
    for q in sorted(members, key=len, reverse=True):
        leaves[q] = sum(leaves[k] for k in kids.get(q, [])) or 1
        saved[q] = sum(saved[k] for k in kids.get(q, [])) + ((len(members[q]) - 1) * len(q[-1][1]) if q else 0)
        ends = ",".join(map(str, sorted(c for c in members[q] if len(rebuilt[c]) == len(q))))
        out.append((min(members[q]), len(q), min(members[q[:-1]]) if q else None, len(members[q]), len(kids.get(q, [])),
                    leaves[q], saved[q], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(df, **kw):
    return prefix_trie.prefix_trie(df, lambda c: c - c % 100, lambda c: F.crc32(c.cast("string")) % 6, 5, **kw)


def rows_of(df):
    return sorted([tuple(r)[:8] for r in df.collect()], key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_trie_on_random_conversations(spark):
    rnd = random.Random(1)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(-130, -90), 517, 10 ** 15 + 3]:
        for _ in range(rnd.randrange(1, 9)):
            rows.append((c, rnd.choice([None, rnd.randrange(12)]), rnd.choice(["user", "user", "", None]),
                         rnd.choice(["a", "b", "\u00e9\U0001F600", "", None])))
    rows += [(None, 0, "user", "no conversation")] * 3 + rows[:20]
    assert rows_of(trie(spark.createDataFrame(rows, SCHEMA))) == brute_trie(rows)


def test_trie_of_one_hot_conversation_and_prefix(spark):
    """A long conversation, and one opening shared by a third of all others."""
    long = [(100, i, "user", f"turn {i % 7}") for i in range(700)]
    hot = [(c, i, "system", "the same opening") for c in range(1000, 1120) for i in range(4)]
    rest = [(c, 0, "user", f"text {c}") for c in range(2000, 2200)]
    rows = long + hot + rest + [(c, i, "user", f"turn {i % 7}") for c in (101, 102) for i in range(40)]
    assert rows_of(trie(spark.createDataFrame(rows, SCHEMA))) == brute_trie(rows)


def test_trie_draws_again_on_equal_products(spark):
    """A small modulus makes different prefixes collide; verification sees it."""
    rows = [(c, i, "user", f"t{c}") for c in range(30, 80) for i in range(7)]
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(RuntimeError):
        trie(df, modulus=3, draws=1).collect()
    assert rows_of(trie(df, modulus=10007)) == brute_trie(rows)


def test_trie_empty_table_clashing_columns_and_long_text(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(7, 0, "user", "x" * 300_000), (8, 0, "user", "x" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("c", "h", "depth", "owner", "_cell", "points"):
        df = df.withColumn(c, F.lit(1))
    assert rows_of(trie(df)) == brute_trie(rows)


def test_trie_refers_to_the_stored_turn(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = df.collect()
    at = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        at.setdefault(r.conv_id, []).append(r)
    for n in trie(df).collect():
        if n.depth:
            h, base = zlib.crc32(str(n.conv_id).encode()) % 6, n.conv_id - n.conv_id % 100
            rebuilt = at.get(base, [])[:h] + at[n.conv_id][h:]
            turn = at[n.turn_conv][n.turn_pos]
            assert (turn.role, turn.text) == (rebuilt[n.depth - 1].role, rebuilt[n.depth - 1].text)


# --------------------------------------------------------------- token counts
def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary_path(name, "UNSET"))
    t.no_truncation(), t.no_padding()
    return lambda s: len(t.encode(s or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_equal_the_library_on_random_text(name):
    counter = token_count.TextCounter(open(queries.vocabulary_path(name, "UNSET")).read())
    want, rnd = library(name), random.Random(2)
    letters = "abcXYZ \u00e9\u00c9\u00df's\u0130\u03a3\u03c2\u0301 \t\n\r\x0b\x0c\x1c\x85\xa0\u3000..,!?01\u65e5\ufb01\u01c5\U0001F600"
    words = ["<|endoftext|>", "<|startoftext|>", "<|endof", " hello", " World's", "'LL", "  "]
    for _ in range(1500):
        s = "".join(rnd.choice(letters) if rnd.random() < 0.9 else rnd.choice(words) for _ in range(rnd.randrange(50)))
        assert counter.count(s) == want(s), s


def test_counter_merges_by_rank_and_skips_stale_pairs():
    counter = token_count.MergeCounter([("b", "c"), ("a", "bc"), ("a", "b"), ("ab", "c</w>")],
                                       ["a", "b", "c", "c</w>", "bc", "abc", "ab", "abc</w>"], "</w>")
    assert [counter.count(w) for w in ("", "c", "abc", "abcc", "bca", "axb")] == [0, 1, 1, 2, 1, 1]


def test_counts_of_a_table(spark):
    rows = [(1, None), (2, ""), (None, "Two words, <|endoftext|>!"), (None, "Two words, <|endoftext|>!"),
            (5, "word " * 30_000), (6, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    path, want = queries.vocabulary_path("word_bpe_49k.json", "UNSET"), library("word_bpe_49k.json")
    got = token_count.token_report(df, path)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expect = [(i, len((t or "").encode()), want(t), want(t) > 2048) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expect, key=str)
    assert token_count.token_report(df.limit(0), path).collect() == []


def test_counts_equal_the_library_on_the_documents(spark):
    want = library("word_bpe_49k.json")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op12_token_count(spark, SF).collect()}
    assert got == {i: want(t) for i, t in texts.items()}


# ------------------------------------------------------------------ whitening
def check_whitening(rows, got, k):
    """``rows`` (id, vector) with usable vectors; signs are free."""
    x = np.floor(64 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    value, vector = np.linalg.eigh(c.T @ c / n)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    want = (x - s / n) @ vector / np.sqrt(value)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(rows) * k
    out = np.array([[by[i][j + 1].whitened for j in range(k)] for i, _ in rows])
    sign = np.sign((out * want).sum(axis=0))
    assert np.abs(out * sign - want).max() < 1e-8
    for (i, _), dev in zip(rows, ((n * x - s) ** 2).sum(axis=1)):
        for j in range(k):
            r = by[i][j + 1]
            assert (r.n, r.deviation) == (n, dev) and r.identity_error < 1e-9
            assert abs(r.explained - value[j] / np.trace(c.T @ c / n)) < 1e-9


VECTORS = "vec_id long, embedding array<float>"


def test_whitening_of_the_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(rows, queries.op13_whitening(spark, SF).collect(), 16)


def test_whitening_leaves_unusable_vectors_out(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(x) for x in rng.normal(size=5) * [9, 5, 3, 2, 1]]) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(40)]  # one vector on many rows
    nan, inf = float("nan"), float("inf")
    bad = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [nan] * 5), (204, [inf] + [0.0] * 4),
           (205, [1e30] + [0.0] * 4), (206, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, VECTORS).withColumn("n", F.lit("clash")).withColumn("_x", F.lit(1))
    check_whitening(good, whitening.whiten(df, 3).collect(), 3)


def test_whitening_without_spread_or_rows(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [0.5])]):
        d = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert d.columns == columns and d.collect() == []
    flat = [(i, [float(i), 1.0, 2.0 * i]) for i in range(9)] + [(None, [3.0, 1.0, 6.0])]  # rank one
    got = whitening.whiten(spark.createDataFrame(flat, VECTORS)).collect()
    assert len(got) == 10 and {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9


def test_feast_finds_every_eigenvalue():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(48, 48)))[0]
    for value in (np.r_[np.full(20, 5.0), np.arange(1, 29)], 1e6 * 0.5 ** np.arange(48), rng.random(48), np.r_[np.ones(9), np.zeros(39)]):
        v = q * value @ q.T
        v = (v + v.T) / 2
        want = np.sort(value)[::-1]
        for shift in (0.3, 4.99, 17.5):
            assert whitening.inertia(v, shift) == (value > shift).sum()
        parts = whitening.slices(v, 16)
        found = [whitening.feast(v, *p) for p in parts]
        values, vectors = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found], axis=1)
        k = min(16, int((want > 1e-6).sum()))
        assert len(values) >= k and np.abs(values[:k] - want[:k]).max() < 1e-9 * want[0]
        assert np.abs(v @ vectors - vectors * values).max() < 1e-9 * want[0]
