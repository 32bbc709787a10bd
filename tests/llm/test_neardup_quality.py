"""Operators 5 and 9 against brute force."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.llm import neardup, quality
from textlab.llm.common import ranked, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute_components(rows, width, pct):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return {(d, len(sets[i])): (least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)}


def variants(seed=1, groups=12, copies=9, sizes=(4, 7, 20, 90, 300)):
    """Groups of near copies of every similarity, short texts, exact copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(1, 6)))
    out = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice(sizes))]
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = word()
            if c % 3 == 0 and len(w) > 8:
                w = w[:len(w) - rng.randrange(0, len(w) // 8 + 1)]
            out.append(" ".join(w) if c % 4 else "\n".join(w).upper())
        out.append(out[-1])
    return out


def test_near_duplicates_against_all_pairs(spark):
    texts = variants() + ["", None, "  \n", "one", "ONE", "one two", "two one", "one two", "é É", "x\x1cy"]
    rows = [(7 * i % 1009, t) for i, t in enumerate(texts)]
    for width, pct in ((3, 85), (5, 80)):
        d = spark.createDataFrame(rows, "doc_id long, text string")
        got = neardup.near_duplicates(d, width=width, pct=pct).collect()
        assert {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got} == brute_components(rows, width, pct)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_chain_across_a_crowded_bucket(spark):
    """Links in a bucket whose centre is linked to none of them."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = []
    for i in range(60):  # neighbours are similar, ends are not
        w = list(base)
        w[i * 5:i * 5 + 12] = [f"v{i}x{k}" for k in range(12)]
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, pct=90, block=16)
    assert {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got.collect()} == brute_components(rows, 3, 90)


def test_near_duplicates_null_ids_repeats_and_clashing_columns(spark):
    a = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(None, a, 1), (3, a, 2), (2, a + " ", 3), (2, a, 4), (None, "alone at last with nobody near", 5), (9, None, 6)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, _cid long")).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == sorted([
        ("None", "2", False), ("3", "2", False), ("2", "2", True), ("2", "2", True), ("None", "None", True),
        ("9", "9", True)])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).collect() == []


def test_estimate_is_close_and_corrected():
    rng = np.random.default_rng(0)
    pool = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
    for share in (0.5, 0.8, 0.95):
        n = int(2000 * share)
        a, b = pool[:2000], np.sort(np.concatenate([pool[:n], pool[2000:2000 + 2000 - n]]))
        true = n / (4000 - n)
        got = neardup.jaccard_estimate(neardup.sketch(a), neardup.sketch(b))
        assert abs(got - true) < 0.15
    other = neardup.sketch(np.unique(rng.integers(0, 2**64, 2000, dtype=np.uint64)))
    assert neardup.jaccard_estimate(neardup.sketch(pool[:2000]), other) < 0.03


def test_word_hashes_follow_words():
    texts = ["A b\tc", "", "a\x0bB\x0cc é\x1cx", " lead trail "]
    h, n = word_hashes(texts)
    words = [w for t in texts for w in WORD.findall(t)]
    assert n.tolist() == [len(WORD.findall(t)) for t in texts]
    low = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    assert len(set(h.tolist())) == len(set(low))
    assert h[0] == h[3] and h[1] == h[4]


def test_ranked_is_gapless_and_sums_weights(spark):
    d = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, 'hot') g", "id % 7 w")
    r = ranked(d, ["g"], ["id"], "k", total="n").collect()
    for g in (None, "hot"):
        ks = sorted(x["k"] for x in r if x["g"] == g)
        assert ks == list(range(len(ks))) and {x["n"] for x in r if x["g"] == g} == {len(ks)}
    at = 0
    for x in sorted(ranked(d, [], ["id"], "k", weight="w", total="n").collect(), key=lambda x: (x["k"], x["w"])):
        assert x["k"] == at
        at += x["w"]


# ------------------------------------------------------------------ quality
def brute_statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {p + k for ps in at.values() if len(ps) > 1 for p in ps for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(n - 1 for n in Counter(lines).values()), len(covered))


def test_statistics_against_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", "\n\n", "a", "a\n a\na\n\na", "# * $ % & | < > ~ ^", "x " * 40, "é\x1cb c\x0bd", "a b c d e " * 3 + "a b",
             "1 2 3 4 5 6 7 1 2 3 4 5 6 9 2 3 4 5 6", "\r\nA\r\nA\r\n", "long " + "y" * 50000]
    texts += [" ".join(rng.choices("ab c\n", k=rng.randrange(1, 60))) for _ in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.text_statistics(d).collect():
        assert tuple(r[c] for c in quality.STATS) == brute_statistics(texts[r["doc_id"]]), repr(texts[r["doc_id"]])


def test_robust_distance_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.multivariate_normal([1, 0.2, 0.3, 0.1], np.diag([.04, .01, .02, .01]) + 0.003, 400)
    x[:60] += [0, 2, 0, 0]  # contamination that would inflate a plain covariance
    d = spark.createDataFrame([(i, "en", "s", *map(float, r)) for i, r in enumerate(x)],
                              "i long, lang string, source string, _x0 double, _x1 double, _x2 double, _x3 double")
    got = {r["i"]: r["mcd_d2"] for r in quality.robust_distance(d, ["lang", "source"]).collect()}
    floor = np.array([0.05, 0.05, 0.1, 0.1])
    at = lambda v, q: np.sort(v)[int(np.ceil(q * len(v))) - 1]
    med = np.array([at(c, .5) for c in x.T])
    sd = np.sqrt((1.4826 * np.array([at(np.abs(c - k), .5) for c, k in zip(x.T, med)])) ** 2 + floor ** 2)
    z = (x - med) / sd
    t, u = np.tanh(z), z / np.linalg.norm(z, axis=1, keepdims=True)

    def step(m, s):
        d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
        near = x[d2 <= at(d2, .75)]
        return near.mean(axis=0), np.cov(near.T, bias=True) + np.diag(floor ** 2)

    found = []
    for c in (np.eye(4), np.cov(t.T, bias=True), u.T @ u / len(u)):
        v = np.sqrt(np.diag(c) + 1e-6)
        r = np.where(np.eye(4) == 1, 1, c / np.outer(v, v))
        found.append(step(*step(med, r * np.outer(sd, sd) + np.diag(floor ** 2))))
    root = lambda e: np.sqrt(np.linalg.det(e[1]))
    m, s = best = min(found, key=root)
    while True:
        new = step(*best)
        moved = root(new) < .99 * root(best)
        m, s = best = min(best, new, key=root)
        if not moved:
            break
    q = quality.chi2_quantile(.75, 4)
    d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m) * quality.chi2_cdf(q, 6) / .75
    assert np.allclose([got[i] for i in range(400)], d2, rtol=1e-6)
    assert min(got[i] for i in range(60)) > max(got[i] for i in range(60, 400))


def test_copies_spread_over_salts_and_keep_their_estimate(spark):
    """A third of all rows are copies, also with null ids."""
    rng = np.random.default_rng(4)
    x = rng.normal([1, .2, .3, .1], .1, (400, 4)).tolist() + [[1.0, .2, .3, .1]] * 200
    rows = [(None if i >= 500 else i, "en", "s", *r) for i, r in enumerate(x)]
    d = spark.createDataFrame(rows, "i long, lang string, source string, _x0 double, _x1 double, _x2 double, _x3 double"
                              ).withColumn("_at", F.monotonically_increasing_id())
    own = quality._keys(d, ["lang", "source"])[0]
    share = d.where("_x0 = 1.0").groupBy(own["_salt"]).count().agg({"count": "max"}).first()[0]
    assert share < 30
    got = quality.robust_distance(d, ["lang", "source"]).select("_at", "mcd_d2", "pooled_d2").collect()
    assert len(got) == 600 and all(r["mcd_d2"] is not None and r["pooled_d2"] is None for r in got)


def test_constant_features_and_tiny_tables(spark):
    schema = "i long, lang string, _x0 double, _x1 double, _x2 double, _x3 double"
    same = spark.createDataFrame([(i, "en", 1.0, 0.0, 0.0, 0.0) for i in range(60)], schema)
    assert {r["mcd_d2"] for r in quality.robust_distance(same, ["lang"]).collect()} == {0.0}
    one = quality.robust_distance(same.limit(1), ["lang"]).collect()
    assert [(r["mcd_d2"], r["pooled_d2"]) for r in one] == [(None, 0.0)]
    assert quality.robust_distance(same.limit(0), ["lang"]).collect() == []


def test_chi2():
    assert abs(quality.chi2_quantile(0.95, 4) - 9.4877) < 1e-3
    assert abs(quality.chi2_cdf(5.3853, 4) - 0.75) < 1e-4


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("etaoinshr", k=rng.randrange(2, 9)))
    clean = [" ".join(word() for _ in range(rng.choice([30, 200, 3000]))) for _ in range(150)]
    junk = [" ".join(word() + "#$%&***" for _ in range(100)) for _ in range(4)]
    rows = [(i, t, "en", "a", "x") for i, t in enumerate(clean + junk)]
    rows += [(1000, None, None, None, "x"), (1001, "", "en", "a", "x"), (1002, "a b c d e " * 9, "en", "a", "x"),
             (None, clean[0], None, "a", "x"), (0, clean[0], "en", "a", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _w string")


def test_quality_verdicts(mixed):
    got = quality.quality_verdicts(mixed).collect()
    assert len(got) == mixed.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(r["kept"] for i in range(150) for r in by[i])
    assert not any(r["kept"] or r["base_failed"] for i in range(150, 154) for r in by[i])
    for i in (1000, 1001, 1002):
        assert by[i][0]["base_failed"] and not by[i][0]["kept"]
    assert by[None][0]["kept"] and by[None][0]["mcd_d2"] is None  # a group too small to judge
    assert quality.quality_verdicts(mixed.limit(0)).collect() == []


def test_small_groups_are_judged_by_a_pool(spark):
    """Junk in a group of five goes: by the language's estimate, by the whole
    table's, and in a table of five rows."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("etaoinshr", k=rng.randrange(2, 9)))
    clean = lambda: " ".join(word() for _ in range(rng.choice([60, 200, 900])))
    junk = lambda: " ".join(word() + "#$%&***" for _ in range(100))
    five = lambda at, lang, source: [(at + i, clean() if i else junk(), lang, source) for i in range(5)]
    rows = [(i, clean(), "en", "a") for i in range(100)]
    rows += five(1000, "en", "b") + five(2000, "fr", "c") + five(3000, None, None)
    schema = "doc_id long, text string, lang string, source string"
    for some, bad in ((rows, {1000, 2000, 3000}), (five(1, "en", "x"), {1})):
        got = quality.quality_verdicts(spark.createDataFrame(some, schema)).collect()
        assert len(got) == len(some) and {r["doc_id"] for r in got if not r["kept"]} == bad
        for r in got:
            assert (r["mcd_d2"] is None) == (r["pooled_d2"] is not None) == (r["source"] != "a")


def test_quality_plan_is_native(mixed):
    plan = quality.quality_verdicts(mixed)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
