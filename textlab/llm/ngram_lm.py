"""Operator 6, language-model scoring with a weighted backoff automaton.

The n-gram counts of all training texts are smoothed into an automaton: each
context is a state with a weighted arc for every word seen behind it, and a
failure arc (the backoff weight) to the state of its shorter suffix.  A text
is scored by one left-to-right traversal that carries the state and adds
log10 probabilities.

The model is never held whole.  Texts are dealt into blocks of bounded size.
Each block sends the distinct n-grams it contains, with their counts in its
training texts, to ranges of the hash space; a range adds up the counts of
all blocks and answers each block's n-grams with their corpus counts.  From
these a task builds the part of the automaton that its block can reach, which
scores exactly as the whole would.  A frequent word costs each block one
entry.

Words and n-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import mix, text_chunks, word_hashes

BEGIN, END = np.uint64(0x1234567), np.uint64(0x89ABCDE)
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A3564E27F8862B)
KAPPA = 8.0


def token_stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' tokens in a row (each text's word hashes, then END) and the
    number of tokens of each text."""
    tokens, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in text_chunks(texts):
        h, counts = word_hashes(texts[lo:hi])
        tokens.append(np.insert(h, np.cumsum(counts), END))
        sizes.append(counts + 1)
    return np.concatenate(tokens), np.concatenate(sizes)


def grams(tokens: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order, the hash of the n-gram that ends at each token; a
    text begins with the history BEGIN.  0 where the text has no such n-gram
    yet."""
    start = np.cumsum(sizes) - sizes
    out = [tokens]
    place = np.arange(tokens.size) - np.repeat(start, sizes)  # in its text
    with np.errstate(over="ignore"):
        for n in range(2, order + 1):
            history = np.concatenate([out[-1][:1], out[-1][:-1]])
            if n == 2:
                history[start] = BEGIN
            g = mix(history * _LEFT + tokens * _RIGHT + np.uint64(n))
            g[place < n - 2] = 0
            out.append(g)
    return out


def planes(a: np.ndarray) -> bytes:
    """Byte planes, high bytes first: sorted hashes and small counts then
    have long runs, which the shuffle's compression takes out."""
    return a.astype(a.dtype.newbyteorder(">")).view(np.uint8).reshape(a.size, a.itemsize).T.tobytes()


def unplanes(b: bytes, dtype) -> np.ndarray:
    t = np.dtype(dtype)
    a = np.frombuffer(b, np.uint8).reshape(t.itemsize, -1).T
    return np.ascontiguousarray(a).view(t.newbyteorder(">")).ravel().astype(t)


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _block_grams(pdf: pd.DataFrame, order: int):
    tokens, sizes = token_stream(pdf["_text"].tolist())
    return tokens, sizes, grams(tokens, sizes, order)


def _gather(order: int, ranges: int):
    """A block's distinct n-grams with their counts in its training texts:
    one row per hash range, also where it has none there."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, sizes, gs = _block_grams(pdf, order)
        train = np.repeat(pdf["_train"].to_numpy(bool), sizes)
        keys, counts = [[] for _ in range(ranges)], [[] for _ in range(ranges)]
        for n, g in enumerate(gs):
            u, inv = np.unique(g, return_inverse=True)
            c = np.bincount(inv[train], minlength=u.size).astype(np.uint32)
            if n == 0:  # the history BEGIN counts texts
                u = np.concatenate([[BEGIN], u])
                c = np.concatenate([[pdf["_train"].sum()], c]).astype(np.uint32)
                by = np.argsort(u, kind="stable")
                u, c = u[by], c[by]
            at = np.searchsorted(_range(u, ranges), np.arange(ranges + 1))
            for r in range(ranges):
                keys[r].append(planes(u[at[r]:at[r + 1]]))
                counts[r].append(planes(c[at[r]:at[r + 1]]))
        return pd.DataFrame({"_block": pdf["_block"].iloc[0], "_range": np.arange(ranges), "_keys": keys,
                             "_counts": counts})
    return run


def _add_up(order: int):
    """Corpus counts of one hash range, sent back to each block in the order
    of its keys, with the range's part of the corpus totals: training tokens,
    distinct ones, and those seen once and twice."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        answers, totals = [[] for _ in range(len(pdf))], None
        for n in range(order):
            own = [unplanes(k[n], np.uint64) for k in pdf["_keys"]]
            u, inv = np.unique(np.concatenate(own), return_inverse=True)
            c = np.bincount(inv, weights=np.concatenate([unplanes(x[n], np.uint32) for x in pdf["_counts"]]),
                            minlength=u.size).astype(np.uint64)
            if n == 0:
                w = c[u != BEGIN]
                totals = [int(w.sum()), int((w > 0).sum()), int((w == 1).sum()), int((w == 2).sum())]
            at = np.cumsum([0] + [k.size for k in own])
            for i in range(len(pdf)):
                answers[i].append(planes(c[inv[at[i]:at[i + 1]]]))
        return pd.DataFrame({"_block": pdf["_block"], "_range": pdf["_range"], "_answers": answers,
                             "_totals": [totals] * len(pdf)})
    return run


class Automaton:
    """The part of the backoff automaton that one block of texts can reach.

    ``gs`` are the block's n-gram hashes, ``counts`` the corpus counts of
    their sorted distinct values (BEGIN included among the words), ``totals``
    the corpus totals.  State 0 is the root (no history); the others are the
    contexts of 1 to order - 1 tokens that occur in training.

    p(w) = (c(w) - D) / N for known words, and D * V / N for the unknown word;
    p(w | h) = (c(h w) + kappa * p(w | shorter h)) / (c(h) + kappa): an arc
    holds log10 p, a state's failure arc log10(kappa / (c(h) + kappa)).
    """

    def __init__(self, tokens, sizes, gs, counts, totals, kappa: float = KAPPA):
        n_tokens, v, once, twice = totals
        d = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
        words, inv = np.unique(np.concatenate([[BEGIN], tokens]), return_inverse=True)
        begin, inv = int(inv[0]), inv[1:]
        self.word, self.n_words = inv, words.size
        self.known = counts[0][inv] > 0
        c1 = counts[0].astype(np.float64)
        self.count = c1[inv]
        p = np.where(c1 > 0, (c1 - d) / max(1, n_tokens), d * v / n_tokens if n_tokens else 1.0)
        self.root = np.log10(p).tolist()
        # states by n-gram: first position of every distinct n-gram of the block
        start = np.cumsum(sizes) - sizes
        order = len(gs)
        context = (c1 > 0) & (words != END) & (order > 1)  # nothing follows an end
        state_of = np.where(context, np.arange(1, words.size + 1), 0)
        self.begin = int(state_of[begin])
        self.root_next = state_of.tolist()
        back, fail, n_states = [0.0], [0], words.size + 1
        back += np.log10(np.where(context, kappa / (c1 + kappa), 1)).tolist()
        fail += [0] * words.size
        arcs: dict[int, tuple[float, int]] = {}
        p_here, c_here, s_here = p[inv], c1[inv], state_of[inv]
        c_start, s_start = c1[begin], self.begin
        for n in range(2, order + 1):
            u, first, inv_n = np.unique(gs[n - 1], return_index=True, return_inverse=True)
            c = counts[n - 1].astype(np.float64)
            before_c, before_s = np.concatenate([[0.0], c_here[:-1]]), np.concatenate([[0], s_here[:-1]])
            if n == 2:
                before_c[start], before_s[start] = c_start, s_start
            i = first[(c > 0) & (u != 0)]
            at = inv_n[i]
            p_n = (c[at] + kappa * p_here[i]) / (before_c[i] + kappa)
            if n < order:  # these n-grams are states too
                ids = np.zeros(u.size, np.int64)
                ids[at] = n_states + np.arange(at.size)
                nxt = ids[at]
                back += np.log10(kappa / (c[at] + kappa)).tolist()
                fail += s_here[i].tolist()
                n_states += at.size
            else:
                nxt = s_here[i]
            key = before_s[i].astype(np.int64) * self.n_words + inv[i]
            arcs.update(zip(key.tolist(), zip(np.log10(p_n).tolist(), nxt.tolist())))
            if n < order:
                full = np.zeros(u.size)
                full[at] = p_n
                p_here, c_here, s_here = full[inv_n], c[inv_n], ids[inv_n]
                c_here[gs[n - 1] == 0] = 0
        self.arcs, self.back, self.fail = arcs, back, fail

    def score(self, words: list[int]) -> float:
        """log10 probability of a text's tokens: left to right from BEGIN; an
        arc adds its weight, else the failure arc is followed."""
        arc, back, fail, root, root_next, width = (
            self.arcs.get, self.back, self.fail, self.root, self.root_next, self.n_words)
        state, total = self.begin, 0.0
        for w in words:
            while state:
                a = arc(state * width + w)
                if a is not None:
                    total += a[0]
                    state = a[1]
                    break
                total += back[state]
                state = fail[state]
            else:
                total += root[w]
                state = root_next[w]
        return total


def _score(order: int, kappa: float):
    def run(key, docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        tokens, sizes, gs = _block_grams(docs, order)
        replies = replies.sort_values("_range")
        counts = [np.concatenate([unplanes(a[n], np.uint64) for a in replies["_answers"]]) for n in range(order)]
        totals = [int(sum(t[i] for t in replies["_totals"])) for i in range(4)]
        m = Automaton(tokens, sizes, gs, counts, totals, kappa)
        base = np.log10((m.count + 0.1) / (totals[0] + 0.1 * (totals[1] + 1)))
        at = np.cumsum(sizes) - sizes
        score = [m.score(m.word[a:a + n].tolist()) for a, n in zip(at, sizes)]
        return pd.DataFrame({
            "doc_id": docs["_id"], "held_out": ~docs["_train"], "n_tokens": sizes,
            "n_known": np.add.reduceat(m.known.astype(np.int64), at), "train_tokens": totals[0],
            "base_score": np.add.reduceat(base, at), "score": score})
    return run


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text: str = "text", order: int = 2,
                kappa: float = KAPPA, block_bytes: int = 5 << 20, ranges: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows where ``train`` is true (null: held out).
    Tokens are the words (A-Z lower-cased) and one end per text; null and
    empty texts have the end alone; very long texts are scored whole, in one
    block of their own if need be.  Null ids and repeated rows are rows like
    any other.  Without training rows every token has probability 1.  An
    empty table gives an empty result.  Other columns are not carried.

    ``block_bytes`` of text (at least one document) and one of ``ranges``
    hash ranges (default: as many as blocks) are what a task holds at a time;
    larger corpora want larger blocks, as each block asks each range.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(train, F.lit(False)).alias("_train"),
                      F.coalesce(F.col(text), F.lit("")).alias("_text"))
    size = src.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]  # one number
    blocks = max(1, -(-size // block_bytes))
    ranges = ranges or blocks
    id_type = dict(src.dtypes)["_id"]
    src = src.withColumn("_block", F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)))
    grouped = src.groupBy("_block")
    asked = grouped.applyInPandas(
        _gather(order, ranges), "_block long, _range long, _keys array<binary>, _counts array<binary>")
    replies = asked.groupBy("_range").applyInPandas(
        _add_up(order), "_block long, _range long, _answers array<binary>, _totals array<long>")
    return src.groupBy("_block").cogroup(replies.groupBy("_block")).applyInPandas(
        _score(order, kappa), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")


def perplexity(score: float, n_tokens: int) -> float:
    """Of a log10 probability."""
    return math.pow(10, -score / n_tokens)
