"""Operators 1, 4 and 6 against brute force."""
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.llm import ann, ngram_lm, queries, url_filter

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ 1 urls
def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fit = [(len(h + p), v == "block", h + p, v) for v, h, p in queries.URL_RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, None)


URLS = [None, "", "no scheme", "http://", "http://com/", "HTTP://A.COM/x", "http://xcom/", "http://net", "http://net/es/",
        "https://a.net/es/1?x=/fr/", "https://a.net?x=1", "https://a.net#/es/", "http://example.com/en/a",
        "http://www.example.com/en/", "http://m.www.example.com/en/q", "http://wwwexample.com/en/", "ftp://É.Example.com/en/",
        "a://b://c/d", "http://a.net/fr/9\nx", "https://thecasino.org/win/money", "https://goodbooks.org/read/text"]


def test_parts_and_rules(spark):
    d = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[5], "x"), (4, URLS[4], "x")],
                              "page_id long, url string, html string")
    got = url_filter.filter_urls(d, queries.URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[5 if r["page_id"] is None else r["page_id"]]
        assert (r["host"], r["path"]) == brute_parts(url), url
        rule, verdict = brute_rule(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] in ({verdict} if rule else {"allow", "block"})
    assert url_filter.filter_urls(d.limit(0), queries.URL_RULES).collect() == []


def test_viterbi_against_all_splits():
    rng = random.Random(3)
    counts = {w: rng.randrange(1, 500) for w in ("the", "then", "hen", "re", "here", "in", "a", "at", "tin")}
    total = sum(counts.values())

    def cost(words):
        return sum(math.log(counts[w]) if w in counts else math.log(10) * (1 - len(w)) for w in words) \
            - len(words) * math.log(total + 1)

    for name in ("therein", "thenat", "xathenz", "tintin", "q"):
        best = max((cost([name[a:b] for a, b in zip((0, *cut), (*cut, len(name)))])
                    for k in range(len(name)) for cut in itertools.combinations(range(1, len(name)), k)))
        got = url_filter.viterbi(name, counts, total)
        assert "".join(got) == name and abs(cost(got) - best) < 1e-9


def test_model_against_brute_force_naive_bayes(spark):
    html = "<p>the casino win money good books read text</p><script>var thecasino</script>"
    urls = ["http://thecasino.net/es/win", "http://moneywin.net/fr/casino", "http://goodbooks.com/read",
            "http://readtext.com/good", "http://thecasinomoney.org/", "http://goodtext.org/read/books", "http://zzz.org/"]
    d = spark.createDataFrame([(i, u, html) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(d, queries.URL_RULES).collect()}
    assert got[4]["verdict"] == "block" and got[5]["verdict"] == "allow"
    lexicon = "the casino win money good books read text".split()

    def words(u):
        host, path = brute_parts(u)
        out = []
        for kind, s in (("host", host), ("path", path)):
            for name in re.findall(r"[a-z]+", s):
                out += [(kind, w) for w in (url_filter.viterbi(name, Counter(lexicon * len(urls)), 8 * len(urls))
                                            if len(name) > 1 else [name])]
        return out

    seen = {"block": Counter(), "allow": Counter()}
    n = Counter()
    for u in urls:
        v = brute_rule(*brute_parts(u))[1]
        if v:
            seen[v].update(words(u))
            n[v] += 1
    vocab = set(seen["block"]) | set(seen["allow"])
    for i, u in enumerate(urls):
        s = math.log((n["block"] + 1) / (n["allow"] + 1))
        for w in words(u):
            if w in vocab:
                s += math.log((seen["block"][w] + 1) / (sum(seen["block"].values()) + len(vocab)))
                s -= math.log((seen["allow"][w] + 1) / (sum(seen["allow"].values()) + len(vocab)))
        assert abs(got[i]["score"] - s) < 1e-9, u


# ------------------------------------------------------------------ 6 scores
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lm(rows, order, kappa):
    """Dictionary n-grams, recursive interpolation."""
    toks = [[("w", "".join(c.lower() if "A" <= c <= "Z" else c for c in w)) for w in WORD.findall(t or "")] + ["END"]
            for _, t, _ in rows]
    c = Counter()
    hist = Counter()
    for (_, _, train), ts in zip(rows, toks):
        if train:
            full = ["BEGIN"] + ts
            for i in range(1, len(full)):
                for n in range(1, order + 1):
                    if i - n + 1 >= 0 and (n > 1 or True):
                        g = tuple(full[i - n + 1:i + 1])
                        if n == 1 or len(g) == n:
                            c[g] += 1
                            if n > 1:
                                hist[g[:-1]] += 1
    uni = {g[0]: k for g, k in c.items() if len(g) == 1}
    total, v = sum(uni.values()), len(uni)
    once, twice = sum(k == 1 for k in uni.values()), sum(k == 2 for k in uni.values())
    d = min(.9, max(.1, once / max(1, once + 2 * twice)))

    def p(h, w):
        if not h:
            return (uni[w] - d) / total if w in uni else (d * v / total if total else 1.0)
        low = p(h[1:], w)
        return (c[h + (w,)] + kappa * low) / (hist[h] + kappa) if hist[h] else low

    out = []
    for ts in toks:
        full = ["BEGIN"] + ts
        s = sum(math.log10(p(tuple(full[max(0, i - order + 1):i]), full[i])) for i in range(1, len(full)))
        base = sum(math.log10((uni.get(w, 0) + .1) / (total + .1 * (v + 1))) for w in ts)
        out.append((len(ts), sum(w in uni for w in ts), total, base, s))
    return out


@pytest.mark.parametrize("order,block_bytes,ranges", [(2, 1 << 20, None), (2, 200, 3), (3, 150, 5), (1, 300, 2)])
def test_scores_against_dictionary_model(spark, order, block_bytes, ranges):
    rng = random.Random(order)
    texts = [" ".join(rng.choices("a b c D d é f g".split(), k=rng.randrange(0, 30))) for _ in range(40)]
    texts += [None, "", "unseen words here", "a", "A\x0ba\tb", texts[0], "x" * 3000]
    rows = [(i, t, i % 4 != 0) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows + [(None, "a b", None)], "doc_id long, text string, _train boolean")
    got = {r["doc_id"]: r for r in ngram_lm.score_texts(
        d, F.col("_train"), order=order, block_bytes=block_bytes, ranges=ranges).collect()}
    want = brute_lm(rows + [(None, "a b", False)], order, ngram_lm.KAPPA)
    assert len(got) == len(rows) + 1
    for (i, _, train), (n, known, total, base, score) in zip(rows + [(None, "", False)], want):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not train, n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) < 1e-6


def test_probabilities_of_a_state_add_up():
    texts = ["a b a c", "b a", "c c b"]
    tokens, sizes = ngram_lm.token_stream(texts)
    gs = ngram_lm.grams(tokens, sizes, 2)
    counts = []
    for n, g in enumerate(gs):
        u, c = np.unique(g, return_counts=True)
        if n == 0:
            u, c = np.append(u, ngram_lm.BEGIN), np.append(c, 3)
            c = c[np.argsort(u, kind="stable")]
        counts.append(c.astype(np.uint64))
    w = counts[0][np.sort(np.append(np.unique(tokens), ngram_lm.BEGIN)) != ngram_lm.BEGIN]
    m = ngram_lm.Automaton(tokens, sizes, gs, counts,
                           [int(w.sum()), w.size, int((w == 1).sum()), int((w == 2).sum())])
    d = 10 ** m.root[int(np.searchsorted(np.unique(np.append(tokens, ngram_lm.BEGIN)), ngram_lm.BEGIN))]
    words = sorted(set(m.word.tolist()))
    unknown = 1 - sum(10 ** m.root[x] for x in words)
    assert unknown > 0 and d > 0
    for state in range(1, m.n_words + 1):
        mass = sum(10 ** (m.arcs[state * m.n_words + x][0] if state * m.n_words + x in m.arcs
                          else m.back[state] + m.root[x]) for x in words)
        assert abs(mass + 10 ** m.back[state] * unknown - 1) < 1e-9


def test_no_training_rows_and_empty_table(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = ngram_lm.score_texts(d, F.lit(False)).first()
    assert r["score"] == 0 and r["base_score"] == 0 and r["train_tokens"] == 0
    assert ngram_lm.score_texts(d.limit(0), F.lit(True)).collect() == []


def test_held_out_texts_score_above_the_base(spark):
    got = queries.op6_lm_score(spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
    one = queries.op6_lm_score(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in one)


# ------------------------------------------------------------------ 4 nearest
def brute_nearest(rows, k):
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows if i is not None and v and all(
        c is not None and math.isfinite(c) for c in v) and any(v)))
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            best = defaultdict(lambda: -math.inf)
            for i, v in rows:
                if i != q and len(v) == len(x):
                    best[i] = max(best[i], float((np.array(v) * np.array(x)).sum()))
            out[q] = sorted((-s, i) for i, s in best.items())[:k]
    return out


def test_small_index_is_exact_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-2, 3, (30, 4)).astype(float)
    rows = [(i, base[i % 30].tolist()) for i in range(200)]
    rows += [(None, [1.0, 0.0, 0.0, 0.0]), (400, None), (420, [0.0] * 4), (440, [1.0, None, 0.0, 0.0]),
             (460, [float("nan"), 1.0, 1.0, 1.0]), (480, [float("inf"), 1.0, 1.0, 1.0]), (500, [1.0, 2.0]), (501, [3.0, 1.0]),
             (7, base[7].tolist()), (520, [])]
    d = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, _id int")
    got = defaultdict(list)
    for r in ann.nearest(d, F.col("vec_id") % 20 == 0, k=20, share=1.0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
    want = brute_nearest(rows, 20)
    want = {q: [(n + 1, s, i) for n, (s, i) in enumerate(b)] for q, b in want.items() if b}
    assert dict(got) == want
    assert ann.nearest(d.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize("sf,block_rows", [("sf0.001", 8192), ("sf0.01", 8192), ("sf0.01", 150), ("sf0.1", 8192),
                                           ("sf0.1", 600)])
def test_recall(spark, sf, block_rows):
    """Recall against brute force on the given vectors, in one block and in several."""
    e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    x = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in e.collect()}
    ids, m = np.array(list(x)), np.stack(list(x.values()))
    got = defaultdict(set)
    for r in ann.nearest(e, F.col("vec_id") % 20 == 0, block_rows=block_rows).collect():
        got[r["query_id"]].add(r["vec_id"])
        assert abs(r["score"] - float(x[r["query_id"]] @ x[r["vec_id"]])) < 1e-12
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        s = m @ x[q]
        s[ids == q] = -np.inf
        best = set(ids[np.argsort(-s)[:20]].tolist())
        hit, total = hit + len(best & got[q]), total + 20
    assert hit / total >= 0.9


def test_strings_are_sign_bits_in_order():
    x = np.random.default_rng(3).standard_normal((700, 6))
    bits = (x @ ann._planes(5) > 0).reshape(700, ann.TREES, ann.BITS)
    want = [[int("".join("01"[int(b)] for b in bits[r, t]), 2) for r in range(0, 700, 50)] for t in range(ann.TREES)]
    assert ann.bit_strings(x)[:, ::50].tolist() == want


def test_partial_scan():
    """On clustered vectors far fewer candidates do."""
    rng = np.random.default_rng(1)
    c = rng.standard_normal((40, 32))
    y = c[rng.integers(0, 40, 3000)] + 0.2 * rng.standard_normal((3000, 32))
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    forest = ann.Forest(y)
    for q, found in zip(y[:50], forest.candidates(y[:50], 150)):
        assert len(found) < 1500
        assert len(set(np.argsort(-(y @ q))[:20]) & set(found)) >= 18
