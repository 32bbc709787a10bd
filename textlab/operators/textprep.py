"""Text preparation and QA featurisation.

Token model: a text is cut into word runs, whitespace runs and single other
characters (``TOKEN_PATTERN``); whitespace runs are then dropped.  Tokens keep
0-based, end-exclusive character offsets ``(st, en)`` into the text.

All of it is native.  Offsets need no running sum: a regex marks the first
and last character of every token in a string of character classes, and the
marks' positions are the offsets.  Windows are cut by one pass that gives
each window its own slice of tokens, offsets and text, so no window row
carries the whole text.  Sub-word pieces (D3) are looked up by a trie with
failure links, one scan a word, in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.arrays import evaluate_once
from textlab.functions.text import WORD_CLASS, WS_CLASS, strip_left

# Special tokens of a BERT-style encoder.
CLS, SEP, PAD, UNK = "[CLS]", "[SEP]", "[PAD]", "[UNK]"


def tokenize(df: DataFrame, col: str, out: str = "tokens") -> DataFrame:
    """``out`` = struct of parallel arrays ``tok``, ``st``, ``en``; null
    for a null text.  The same tokens as :func:`native_tokens`.

    The text becomes a string of the same length with ``w`` for word
    characters, ``s`` for symbols and a blank for whitespace; in it the first
    (last) character of every word run is marked, and the indices of marks and
    symbols are the starts (last characters).  Work grows with the length."""
    kinds = F.regexp_replace(F.col(col), f"[{WORD_CLASS}]", "w")
    kinds = F.regexp_replace(F.regexp_replace(kinds, f"[^w{WS_CLASS}]", "s"), f"[{WS_CLASS}]", " ")
    d = evaluate_once(df.withColumn("_kinds", kinds))
    d = evaluate_once(d.withColumns({
        "_first": F.split(F.regexp_replace("_kinds", "(?<!w)w", "A"), ""),
        "_last": F.split(F.regexp_replace("_kinds", "w(?!w)", "A"), "")}))

    def at(marks: str, shift: int) -> Column:
        place = F.transform(marks, lambda c, i: F.when(c.isin("A", "s"), i + shift))
        return F.filter(place, lambda i: i.isNotNull())

    value = F.when(F.col("_kinds").isNotNull(), F.struct(
        native_tokens(col).alias("tok"), at("_first", 0).alias("st"), at("_last", 1).alias("en")))
    return d.withColumn(out, value).drop("_kinds", "_first", "_last")


def native_tokens(col) -> Column:
    """D2 without offsets, fully native: the non-blank tokens of a text.

    Matching only the word-run and single-symbol alternatives gives the
    same list as tokenising fully and dropping the whitespace runs (a word
    run is maximal either way), without a per-token regex test."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit(f"[{WORD_CLASS}]+|[^{WORD_CLASS}{WS_CLASS}]"), 0)


# ------------------------------------------------------------------ D15 / D3
def token_frequencies(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """``(token, n)``, most frequent first (ties by token); ``top``
    keeps the V most frequent (a top-k: each task keeps at most V rows).
    The count uses partial aggregation, so a very frequent token costs one
    row per task in the shuffle."""
    t = df.select(F.explode(native_tokens(col)).alias("token"))
    c = t.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    if top is not None:
        c = c.orderBy(F.col("n").desc(), F.col("token")).limit(top)
    return c


def vocabulary(freq: DataFrame, specials=(PAD, UNK, CLS, SEP)) -> DataFrame:
    """Vocabulary table ``(token, token_id)``: the special tokens first,
    then ``freq`` in (count desc, token) order.  ``freq`` is a top-V result,
    so the numbering window sees at most V rows."""
    from pyspark.sql import Window
    w = Window.orderBy(F.col("n").desc(), F.col("token"))
    ns = len(specials)
    body = freq.select("token", (F.row_number().over(w) - 1 + ns).cast("int").alias("token_id"))
    sp = freq.sparkSession.createDataFrame([(t, i) for i, t in enumerate(specials)],
                                           "token string, token_id int")
    return sp.unionByName(body)


def wordpiece_vocabulary(freq: DataFrame, alphabet: DataFrame) -> DataFrame:
    """D3 vocabulary: whole words from ``freq`` plus every character of the
    ``alphabet`` table (column ``ch``) both as a word start and as a
    ``##`` continuation, so every word can be split."""
    chars = alphabet.select(F.col("ch").alias("token"))
    cont = alphabet.select(F.concat(F.lit("##"), F.col("ch")).alias("token"))
    return freq.select("token").unionByName(chars).unionByName(cont).distinct()


def wordpiece_split(word: str, vocab: set, longest: int | None = None) -> list[str]:
    """Greedy longest-match-first sub-word split of one word of any length
    (the published WordPiece algorithm); ``[UNK]`` when some rest cannot be
    matched.  ``longest`` is the length of the longest vocabulary entry (no
    longer match can exist), to keep very long words linear."""
    longest = longest or max(map(len, vocab), default=0)
    out, start = [], 0
    while start < len(word):
        end, piece = min(len(word), start + longest), None
        while start < end:
            sub = word[start:end] if start == 0 else "##" + word[start:end]
            if sub in vocab:
                piece = sub
                break
            end -= 1
        if piece is None:
            return [UNK]
        out.append(piece)
        start = end
    return out


class PieceTrie:
    """WordPiece in one scan of a word (linear, whatever the vocabulary).

    The trie holds the word starts from its root and the ``##`` entries from a
    second root.  Where no child fits, a node's failure link gives the node
    that the rest of the match continues from, and its pieces are those that
    the greedy longest match would have emitted by then."""

    def __init__(self, vocabulary):
        self.child: list[dict[str, int]] = [{}, {}]
        depth, token = [0, 0], [None, None]
        for t in vocabulary:
            node, rest = (1, t[2:]) if t.startswith("##") and len(t) > 2 else (0, t)
            for c in rest:
                nxt = self.child[node].get(c)
                if nxt is None:
                    nxt = self.child[node][c] = len(self.child)
                    self.child.append({}), depth.append(depth[node] + 1), token.append(None)
                node = nxt
            if rest:
                token[node] = t
        self.fail: list[int | None] = [None] * len(self.child)
        self.pops: list[tuple[str, ...]] = [()] * len(self.child)
        todo = [0, 1]
        for u in todo:  # breadth first
            for c, v in self.child[u].items():
                todo.append(v)
                if token[v] is not None:
                    self.fail[v], self.pops[v] = 1, (token[v],)
                    continue
                z, popped = self.fail[u], self.pops[u]
                while z is not None and c not in self.child[z]:
                    popped, z = popped + self.pops[z], self.fail[z]
                if z is not None:
                    self.fail[v], self.pops[v] = self.child[z][c], popped

    def split(self, word: str) -> list[str]:
        """The greedy longest-match pieces, or ``[UNK]``."""
        node, out, child, fail, pops = 0, [], self.child, self.fail, self.pops
        for c in word:
            while (nxt := child[node].get(c)) is None:
                if fail[node] is None:
                    return [UNK]
                out += pops[node]
                node = fail[node]
            node = nxt
        while node > 1:
            if fail[node] is None:
                return [UNK]
            out += pops[node]
            node = fail[node]
        return out


_TRIES: dict[int, PieceTrie] = {}


def _trie(shipped, key) -> PieceTrie:
    """One trie per worker process and vocabulary."""
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = PieceTrie(shipped.value)
    return _TRIES[key]


def _shipped(vocab: DataFrame, columns: list[str], most: int):
    """The vocabulary's rows as a broadcast, if they are at most ``most``."""
    rows = vocab.select(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a vocabulary of more than {most} entries is not shipped to tasks")
    data = frozenset(r[0] for r in rows) if len(columns) == 1 else dict(map(tuple, rows))
    return vocab.sparkSession.sparkContext.broadcast(data)


def subword(df: DataFrame, col: str, vocab: DataFrame, out: str = "pieces", most: int = 1_000_000) -> DataFrame:
    """D3: sub-word pieces for each distinct word of ``col``.

    Words are exploded and de-duplicated first (a corpus has far fewer
    distinct words than words), and the split runs on the distinct words in
    ``mapInPandas`` with the vocabulary shipped once per task (``most``
    entries at most, else an error).  Returns ``(word, pieces)``; join it to
    any word column.
    """
    words = (df.select(F.explode(F.regexp_extract_all(F.col(col), F.lit(f"[{WORD_CLASS}]+"), 0))
                       .alias("word")).distinct())
    shipped = _shipped(vocab, ["token"], most)
    key = shipped._jbroadcast.id()

    def split_batches(it):
        trie = _trie(shipped, key)
        for pdf in it:
            yield pd.DataFrame({"word": pdf["word"], out: [trie.split(w) for w in pdf["word"]]})

    return words.mapInPandas(split_batches, f"word string, {out} array<string>")


def corpus_alphabet(df: DataFrame, col: str) -> DataFrame:
    """The distinct word characters ``ch`` of a text column."""
    return df.select(F.explode(F.split(F.regexp_replace(col, f"[^{WORD_CLASS}]", ""), "")).alias("ch")).where(
        F.col("ch") != "").distinct()


def piece_ids(vocab: DataFrame, specials=(PAD, UNK, CLS, SEP)) -> DataFrame:
    """``(token, token_id)``: the special tokens, then a sub-word vocabulary
    in token order (a bounded table, numbered by one window)."""
    from pyspark.sql import Window
    n = len(specials)
    body = vocab.select("token", (F.row_number().over(Window.orderBy("token")) - 1 + n).cast("int").alias("token_id"))
    return vocab.sparkSession.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, token_id int").unionByName(body)


def piece_tokens(df: DataFrame, tokens: list[str], ids: DataFrame, most: int = 1_000_000, unk_id: int = 1) -> DataFrame:
    """D3 with offsets: replaces each token struct of ``tokens`` by one of
    sub-word pieces: ``tok`` (their ids), ``st`` and ``en`` (characters of the
    text).  A word that can't be split is one unknown piece.

    Row by row, with the vocabulary shipped once: no shuffle, so a very
    frequent word meets nowhere.  A batch stays in flat Arrow and numpy arrays
    (a few numbers a token, no Python object but for its distinct words), so a
    worker's memory is a small multiple of the batch's own."""
    shipped = _shipped(ids, ["token", "token_id"], most)
    key = shipped._jbroadcast.id()

    @F.arrow_udf("struct<tok:array<int>,st:array<int>,en:array<int>>")
    def pieces(tok: pa.Array, st: pa.Array, en: pa.Array) -> pa.Array:
        trie, number = _trie(shipped, key), shipped.value
        words = tok.flatten().dictionary_encode()
        cut = []  # each distinct word's (ids, lengths); the whole word if unknown
        for w in words.dictionary:
            w = w.as_py()
            parts = trie.split(w)
            cut.append(([unk_id], [len(w)]) if parts == [UNK] else (
                [number[p] for p in parts], [len(p) - 2 * (i > 0) for i, p in enumerate(parts)]))
        flat = lambda k: np.fromiter((x for c in cut for x in c[k]), np.int32)
        piece_id, length = flat(0), flat(1)
        count = np.fromiter((len(c[0]) for c in cut), np.int32, len(cut))
        first = np.cumsum(count, dtype=np.int64) - count  # a distinct word's first piece
        before = np.cumsum(length, dtype=np.int32) - length  # characters up to a piece, of all distinct words
        word = words.indices.to_numpy()
        n = count[word]
        ends = np.cumsum(n, dtype=np.int64)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[word] - (ends - n), n)
        start = np.repeat(st.flatten().to_numpy() - (before[first[word]] if len(cut) else 0), n) + before[at]
        sizes = np.asarray(pc.fill_null(pc.list_value_length(tok), 0))
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])].astype(np.int32)
        none = tok.is_null()
        lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32, copy=False)), mask=none)
                 for x in (piece_id[at], start, start + length[at])]
        return pa.StructArray.from_arrays(lists, ["tok", "st", "en"])

    # side by side: one Python worker a task for all columns
    p = evaluate_once(df.withColumns({f"_p_{t}": pieces(F.col(t)["tok"], F.col(t)["st"], F.col(t)["en"]) for t in tokens}))
    return p.withColumns({t: F.when(F.col(t).isNotNull(), F.col(f"_p_{t}")) for t in tokens}).drop(*[f"_p_{t}" for t in tokens])


# ----------------------------------------------------------------------- D4
def encode_single(df: DataFrame, tokens_col: str, vocab: DataFrame, id_col: str,
                  max_length: int = 512, pad_id: int = 0, unk_id: int = 1,
                  cls_id: int = 2, sep_id: int = 3) -> DataFrame:
    """``[CLS] tokens[:max_length-2] [SEP]`` padded to ``max_length``,
    with ``attention_mask``, ``n_tokens`` and ``truncated``.

    Only the kept tokens are exploded (at most ``max_length`` rows per text,
    one of them for the text itself), joined to the vocabulary, which is
    bounded and therefore broadcast, whatever size Spark measures, and put
    back in position order in one shuffle by id; unknown tokens become
    ``[UNK]``.  Rows of a repeated id have the tokens of all of them, in
    position order; a null id has none.  The special ids default to the first
    rows of :func:`vocabulary`.
    """
    keep = max_length - 2
    kept = F.when(F.col(id_col).isNotNull(), F.slice(tokens_col, 1, keep))
    entries = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(kept, F.array().cast("array<string>")))
    ex = df.select(id_col, F.size(tokens_col).alias("n_tokens"), F.posexplode(entries).alias("_pos", "token"))
    ids = ex.join(F.broadcast(vocab.select("token", "token_id")), "token", "left").groupBy(id_col).agg(
        F.collect_list(F.when(F.col("_pos") == 0, F.struct("n_tokens"))).alias("_rows"),
        F.sort_array(F.collect_list(F.when(F.col("_pos") > 0, F.struct("_pos", "token_id")))).alias("_s"))
    body = F.transform("_s", lambda x: F.coalesce(x["token_id"], F.lit(unk_id)))
    ids = evaluate_once(ids.select(id_col, "_rows", F.concat(F.array(F.lit(cls_id)), body, F.array(F.lit(sep_id))).alias("_seq")))
    n = F.size("_seq")
    pad = F.lit(max_length) - n
    return (ids.select(id_col, "_seq", F.explode("_rows.n_tokens").alias("n_tokens"))
            .select(id_col, "n_tokens", (F.col("n_tokens") > keep).alias("truncated"),
                    F.concat("_seq", F.array_repeat(F.lit(pad_id), pad)).alias("input_ids"),
                    F.concat(F.array_repeat(F.lit(1), n),
                             F.array_repeat(F.lit(0), pad)).alias("attention_mask")))


# ------------------------------------------------------------------ D5-D14
def count_qa(examples: DataFrame, max_length: int = 384, n_special: int = 3) -> DataFrame:
    """The example with its question's left blanks gone (D1), token counts
    ``n_q`` and ``n_ctx`` and the context budget of a window; no tokens."""
    x = evaluate_once(examples.withColumn("question", strip_left("question")))
    token = F.lit(f"[{WORD_CLASS}]+|[^{WORD_CLASS}{WS_CLASS}]")
    x = x.select("*", F.regexp_count("question", token).alias("n_q"), F.regexp_count("context", token).alias("n_ctx"))
    return x.withColumn("budget", F.lit(max_length) - F.col("n_q") - F.lit(n_special))


def prepare_qa(examples: DataFrame, max_length: int = 384, doc_stride: int = 128,
               n_special: int = 3, pad_on_right: bool = True, ids: DataFrame | None = None) -> DataFrame:
    """Strip the question's left whitespace, tokenise question
    and context, compute the context budget per window.

    ``examples``: ``id, question, context, answers`` (answers =
    ``struct<answer_start: array<int>, text: array<string>>``).
    With ``ids`` (see :func:`piece_ids`) the tokens are sub-word pieces.
    With ``pad_on_right=False`` the context comes first in the pair and the
    padding in front; the window arithmetic is the same.

    The question's tokens are counted first.  Where they leave no budget, no
    window can exist: the tokens are null and only the counts are there.
    Without ``ids`` a question's tokens have no offsets, which nothing reads.
    """
    token = F.lit(f"[{WORD_CLASS}]+|[^{WORD_CLASS}{WS_CLASS}]")
    x = evaluate_once(examples.withColumn("question", strip_left("question")))
    x = evaluate_once(x.withColumn("_nq", F.regexp_count("question", token)))
    fits = F.col("_nq") + F.lit(n_special) < F.lit(max_length)
    x = x.withColumns({"_q": F.when(fits, F.col("question")), "_c": F.when(fits, F.col("context"))})
    if ids is not None:
        x = piece_tokens(tokenize(tokenize(x, "_q", "q_tok"), "_c", "c_tok"), ["q_tok", "c_tok"], ids)
    else:
        x = tokenize(x.withColumn("q_tok", F.when(fits, F.struct(native_tokens("_q").alias("tok")))), "_c", "c_tok")
    x = evaluate_once(x)
    n_q = F.when(F.col("_q").isNotNull(), F.size("q_tok.tok")).otherwise(F.col("_nq"))
    n_c = F.when(F.col("_c").isNotNull(), F.size("c_tok.tok")).otherwise(F.regexp_count("context", token))
    budget = F.lit(max_length) - n_q - F.lit(n_special)
    return x.select("*", n_q.alias("n_q"), n_c.alias("n_ctx"),
                    budget.alias("budget"), F.lit(pad_on_right).alias("pad_on_right"),
                    F.lit(n_special).alias("n_special")).drop("_nq", "_q", "_c")


def _unusable(doc_stride: int) -> Column:
    """Why a prepared example has no windows; null if it has some."""
    return (F.when(F.col("question").isNull(), F.lit("null question"))
            .when(F.col("context").isNull(), F.lit("null context"))
            .when(F.col("budget") <= doc_stride, F.lit("question too long"))
            .when((F.size("answers.answer_start") > 0)
                  & (F.length(F.get(F.col("answers.text"), 0)) == 0), F.lit("empty answer text"))
            .when(F.col("n_ctx") <= 0, F.lit("no context tokens")))


def quarantine_qa(prepared: DataFrame, doc_stride: int = 128) -> DataFrame:
    """Q2 / Q3: examples that cannot be featurised, with the reason.  Every
    example is either here or has windows."""
    return prepared.select(F.col("id").alias("example_id"), _unusable(doc_stride).alias("reason")) \
        .where(F.col("reason").isNotNull())


def windows(prepared: DataFrame, doc_stride: int = 128) -> DataFrame:
    """One row per (example, window).  ``step = budget - stride``;
    window starts ``0, step, 2*step, ...`` until a window reaches the end of
    the context; each row carries its example id (``example_id``).

    The windows are cut inside the example's row and exploded as slices: a
    window row has its own tokens (``ctx_tok``, ``ctx_st``, ``ctx_en``) and
    text (``ctx_text``, from character ``ctx_at`` on), never the example's
    whole context or token arrays.  Also added: ``window_idx``, ``w_start``
    (first context token), ``w_len`` (context tokens in the window),
    ``ctx_lo`` / ``ctx_hi`` (sequence positions of the first / last context
    token) and ``seq_len``.
    """
    # rows that cannot be featurised (see quarantine_qa) get no windows; the
    # test sits inside the explode rather than in a Filter, so it is not
    # pushed below the tokenizer and evaluated twice
    ok = _unusable(doc_stride).isNull()
    step = F.col("budget") - F.lit(doc_stride)
    last = F.ceil(F.greatest(F.lit(0), F.col("n_ctx") - F.col("budget")) / step) * step
    starts = F.when(ok, F.sequence(F.lit(0), last.cast("int"), step)).otherwise(
        F.array().cast("array<int>"))
    p = evaluate_once(prepared.select("*", starts.alias("_starts"), F.split("context", "").alias("_chars")))

    def cut(s: Column) -> Column:
        n = F.least(F.col("budget"), F.col("n_ctx") - s)
        first, end = F.get("c_tok.st", s), F.get("c_tok.en", s + n - 1)
        part = lambda f: F.slice(F.col("c_tok")[f], s + 1, n).alias(f"ctx_{f}")
        return F.struct(s.alias("w_start"), n.alias("w_len"), part("tok"), part("st"), part("en"), first.alias("ctx_at"),
                        F.array_join(F.slice("_chars", first + 1, end - first), "").alias("ctx_text"))

    w = p.select(*[c for c in p.columns if c not in ("c_tok", "context", "_starts", "_chars")],
                 F.posexplode(F.transform("_starts", cut)).alias("window_idx", "_w"))
    w = evaluate_once(w).select("*", "_w.*").drop("_w")
    # pad_on_right: [CLS] q [SEP].. c [SEP]; otherwise [CLS] c [SEP].. q [SEP]
    ctx_lo = F.when(F.col("pad_on_right"), F.col("n_q") + F.col("n_special") - 1).otherwise(F.lit(1))
    w = w.withColumn("ctx_lo", ctx_lo)
    w = w.withColumn("ctx_hi", F.col("ctx_lo") + F.col("w_len") - 1)
    w = w.withColumn("seq_len", F.col("n_q") + F.col("w_len") + F.col("n_special"))
    return w.withColumnRenamed("id", "example_id")


def window_offsets(w: DataFrame) -> DataFrame:
    """The full sequence's masked offsets (null outside the
    context) as ``offsets``."""
    null_off = F.lit(None).cast("struct<st:int,en:int>")
    offs = F.transform(
        F.sequence(F.lit(0), F.col("seq_len") - 1),
        lambda i: F.when((i >= F.col("ctx_lo")) & (i <= F.col("ctx_hi")),
                         F.struct(F.element_at("ctx_st", i - F.col("ctx_lo") + 1).alias("st"),
                                  F.element_at("ctx_en", i - F.col("ctx_lo") + 1).alias("en")))
        .otherwise(null_off))
    return w.withColumn("offsets", offs)


def pair_encoding(w: DataFrame, max_length: int = 384, pad_id: int = 0, cls_id: int = 2,
                  sep_id: int = 3) -> DataFrame:
    """Windows of sub-word pieces as padded pairs of ``max_length``.

    Adds ``input_ids``, ``attention_mask``, ``sequence_ids`` (0 for the pair's
    first part, 1 for its second, null for special and padding tokens),
    ``offsets`` (null outside the context) and ``cls_index``.  With
    ``pad_on_right`` the pair is question and context with the padding
    behind; otherwise context and question with the padding in front, which
    moves all positions: ``start_position`` and ``end_position`` of
    :func:`label_spans`, if there, are moved along (no answer: the CLS token).
    """
    right, pad = F.col("pad_on_right"), F.lit(max_length) - F.col("seq_len")
    n_sep = F.col("n_special") - 2  # between the parts
    q, c = F.col("q_tok.tok"), F.col("ctx_tok")
    times = lambda x, n: F.array_repeat(F.lit(x).cast("int"), n)
    padded = lambda seq, x: F.when(right, F.concat(seq, times(x, pad))).otherwise(F.concat(times(x, pad), seq))
    first, second = F.when(right, q).otherwise(c), F.when(right, c).otherwise(q)
    w = evaluate_once(w.select("*", first.alias("_a"), second.alias("_b")))
    ids = F.concat(times(cls_id, 1), F.col("_a"), times(sep_id, n_sep), F.col("_b"), times(sep_id, 1))
    parts = F.concat(times(None, 1), times(0, F.size("_a")), times(None, n_sep), times(1, F.size("_b")), times(None, 1))
    cls = F.when(right, F.lit(0)).otherwise(pad)
    spans = F.arrays_zip(F.col("ctx_st").alias("st"), F.col("ctx_en").alias("en"))
    none = lambda n: F.array_repeat(F.lit(None).cast("struct<st:int,en:int>"), n)
    before = cls + F.col("ctx_lo")
    moved = [(F.col(p) + cls).cast("int").alias(p) for p in ("start_position", "end_position") if p in w.columns]
    keep = [x for x in w.columns if x not in ("_a", "_b", "offsets", "start_position", "end_position")]
    return w.select(
        *keep, padded(ids, pad_id).alias("input_ids"), padded(times(1, F.col("seq_len")), 0).alias("attention_mask"),
        padded(parts, None).alias("sequence_ids"),
        F.concat(none(before), spans, none(F.lit(max_length) - before - F.col("w_len"))).alias("offsets"),
        cls.cast("int").alias("cls_index"), *moved)


def label_spans(w: DataFrame, max_length: int = 384,
                compat_last_token: bool = False) -> DataFrame:
    """Start / end token labels per window (CLS index 0 when the
    example has no answer or the answer is not fully inside the window).

    start = last context token with ``st <= start_char``; end = first context
    token with ``en >= end_char`` (offsets are monotone, so both are counts
    of a filter).  ``compat_last_token`` reproduces the reference's off-by-
    window label when the answer starts in the window's last context token
    (start becomes ``max_length - 1``).
    """
    has = F.size("answers.answer_start") > 0
    start_char = F.get(F.col("answers.answer_start"), 0)
    end_char = start_char + F.length(F.get(F.col("answers.text"), 0))
    first_st = F.get(F.col("ctx_st"), 0)
    last_en = F.get(F.col("ctx_en"), F.size("ctx_en") - 1)
    inside = (first_st <= start_char) & (last_en >= end_char)
    n_le = F.size(F.filter("ctx_st", lambda x: x <= start_char))
    start = F.col("ctx_lo") + n_le - 1
    if compat_last_token:
        start = F.when(n_le == F.col("w_len"), F.lit(max_length - 1)).otherwise(start)
    end = F.col("ctx_lo") + F.size(F.filter("ctx_en", lambda x: x < end_char))
    ok = has & inside
    return w.select("*", F.when(ok, start).otherwise(0).cast("int").alias("start_position"),
                    F.when(ok, end).otherwise(0).cast("int").alias("end_position"))


GRAM = 8


def locate_passages(docs: DataFrame, doc_id: str, doc_text: str,
                    passages: DataFrame, item_id: str, passage_text: str) -> DataFrame:
    """Every (passage, document) pair where the passage occurs verbatim in
    the document, with the first occurrence ``pos`` (0-based).  Null and
    empty passages and null documents are in no pair.

    No nested loop: candidate pairs come from equi-joins on keys that every
    document with the passage must have, and ``position`` verifies them.

    * A passage with *inner* words (a non-word character on both sides inside
      the passage, so they are whole words of any text that contains it) is
      keyed by the inner word that the fewest documents have.
    * Other passages (single words, words running into both ends) are keyed
      by their first ``GRAM`` characters, or all if fewer; documents emit
      their distinct character grams of the lengths that occur, none if all
      passages have inner words.

    Only ids travel until a pair is a candidate; Spark chooses the join
    strategies by the sizes it measures.
    """
    wre = F.lit(f"[{WORD_CLASS}]+")
    inner = F.regexp_extract_all(F.col("_ptext"), F.lit(
        f"(?<=[^{WORD_CLASS}])[{WORD_CLASS}]+(?=[^{WORD_CLASS}])"), 0)
    p = passages.select(F.col(item_id).alias("_item"), F.col(passage_text).alias("_ptext")).where(
        F.length("_ptext") > 0)
    p = evaluate_once(p.select("*", F.regexp_extract_all(F.col("_ptext"), wre, 0).alias("_pw"),
                               F.array_distinct(inner).alias("_inner")))
    d = docs.select(F.col(doc_id).alias("_doc"), F.col(doc_text).alias("_dtext"))

    owned = p.select("_item", "_ptext", F.explode("_inner").alias("_key"))
    words = d.select("_doc", F.explode(F.array_distinct(
        F.regexp_extract_all(F.col("_dtext"), wre, 0))).alias("_key"))
    words = words.join(owned.select("_key").distinct(), "_key", "left_semi")
    held = words.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    rarest = owned.join(held, "_key", "left").groupBy("_item", "_ptext").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_key"))["_key"].alias("_key"))
    by_word = words.join(rarest, "_key").select("_item", "_ptext", "_doc")

    short = p.where(F.size("_inner") == 0).select(
        "_item", "_ptext", F.least(F.length("_ptext"), F.lit(GRAM)).alias("_k"))
    lengths = short.agg(F.collect_set("_k")).scalar()  # at most GRAM numbers
    grams = evaluate_once(d.select("_doc", lengths.alias("_ks"), F.when(
        F.size(lengths) > 0, F.split("_dtext", "")).alias("_chars")))
    upto = lambda k: F.sequence(F.lit(1), F.size("_chars") - k + 1)
    grams = grams.select("_doc", F.explode(F.array_distinct(F.flatten(F.transform(
        F.filter("_ks", lambda k: k <= F.size("_chars")),
        lambda k: F.transform(upto(k), lambda i: F.array_join(F.slice("_chars", i, k), "")))))).alias("_key"))
    by_gram = grams.join(short.select("_item", "_ptext", F.substring(F.col("_ptext"), F.lit(1), F.col("_k")).alias("_key")),
                         "_key").select("_item", "_ptext", "_doc")

    at = F.position(F.col("_ptext"), F.col("_dtext"))
    return by_word.unionByName(by_gram).join(d, "_doc").where(at > 0).select(
        F.col("_item").alias(item_id), F.col("_doc").alias(doc_id),
        (at - 1).cast("int").alias("pos"), F.col("_ptext").alias("passage"),
        F.regexp_extract_all(F.col("_ptext"), wre, 0).alias("passage_words"), F.col("_dtext").alias("context"))


def validate_spans(examples: DataFrame) -> DataFrame:
    """Does ``context[start : start+len(text)]`` equal the first answer
    text?  Returns ``(id, stored_start, found_start, status)`` where
    ``found_start`` is the first occurrence (``locate``); status is ``ok``,
    ``repairable`` (wrong offset, text found), ``missing`` (text not in the
    context) or ``no_answer``.  A correct stored offset is kept even when
    the text also occurs earlier."""
    s = F.get(F.col("answers.answer_start"), 0)
    t = F.get(F.col("answers.text"), 0)
    at = F.substring(F.col("context"), s + 1, F.length(t))
    found = F.position(t, F.col("context")) - 1
    status = (F.when(F.size("answers.answer_start") == 0, F.lit("no_answer"))
              .when(at == t, F.lit("ok"))
              .when(found >= 0, F.lit("repairable"))
              .otherwise(F.lit("missing")))
    return examples.select("id", s.alias("stored_start"),
                           F.when(found >= 0, found).alias("found_start"),
                           status.alias("status"))
