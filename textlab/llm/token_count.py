"""Operator 12, token counts by heap-and-linked-list byte-pair merging.

A word starts as a doubly linked list of symbols.  The lowest-rank adjacent
pair (leftmost on ties) is popped from a heap and merged until none is left;
pairs whose symbols have changed meanwhile are skipped.  The count is the
number of initial symbols minus the number of merges: no identifiers are
looked up, kept or emitted.

The vocabulary file (fixed size) is read once on the driver and shipped to
the tasks.  Texts are counted row by row inside tasks and never shuffled.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.bpe import byte_alphabet, tokenizer_file


class MergeCounter:
    """Counts by one merge table.  Symbols are the strings of the vocabulary;
    ``suffix`` is attached to a word's last symbol."""

    def __init__(self, merges, vocabulary, suffix: str = ""):
        self.suffix = suffix
        self.number = {s: i for i, s in enumerate(vocabulary)}
        self.left, self.right, self.made, self.rank = [], [], [], {}
        for r, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y = self.number[a], self.number[b]
            self.left.append(x), self.right.append(y), self.made.append(self.number[a + b])
            self.rank.setdefault(x << 32 | y, r << 40)

    def count(self, word: str) -> int:
        """Tokens of one pre-token of any length.  Symbols that the vocabulary
        lacks are no tokens, and their neighbours meet."""
        sym = list(map(self.number.get, word))
        if word:
            sym[-1] = self.number.get(word[-1] + self.suffix)
        if None in sym:
            sym = [s for s in sym if s is not None]
        n, rank, left, right, made = len(sym), self.rank.get, self.left, self.right, self.made
        heap = [r + i for i, (a, b) in enumerate(zip(sym, sym[1:]))  # rank above, position below
                if (r := rank(a << 32 | b)) is not None]
        heapify(heap)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            entry = heappop(heap)
            r, i = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[i]
            if j >= n or sym[i] != left[r] or sym[j] != right[r]:
                continue  # stale: a neighbour merged meanwhile
            merges += 1
            if merges == n - 1:
                break  # one symbol is left
            a = sym[i] = made[r]
            sym[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(a << 32 | sym[k])) is not None:
                    heappush(heap, r + i)
            h = before[i]
            if h >= 0 and (r := rank(sym[h] << 32 | a)) is not None:
                heappush(heap, r + h)
        return n - merges


class TextCounter:
    """Counts whole texts by a tokenizers file with a BPE model.

    Special-token strings are cut out of the raw text first and count one
    each.  Where the file's pre-tokenizer drops white space, a text is cut at
    ASCII white space, which no pre-token crosses, and the counts of pieces
    and words are kept in two caches of ``cache`` short strings (in two
    generations).  Normalising and cutting into pre-tokens is the file's own;
    pieces of plain Latin letters, with or without one mark behind them, need
    no pattern.
    """

    #: Letters below this code point are the same in every Unicode version
    #: and are composed already.
    LATIN = "ɐ"

    def __init__(self, spec_json: str, cache: int = 500_000):
        from tokenizers import Tokenizer
        import regex

        spec = json.loads(spec_json)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback") \
                or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a plain BPE model is needed")
        added = spec.get("added_tokens", ())
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("added tokens must be matched in the raw text as they stand")
        tokenizer = Tokenizer.from_str(spec_json)
        normalizer, cutter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.normal = normalizer.normalize_str if normalizer else str
        self.cut = cutter.pre_tokenize_str if cutter else lambda s: [(s, None)]
        self.merges = MergeCounter(model["merges"], model["vocab"], model.get("end_of_word_suffix") or "")
        named = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = frozenset(named)
        self.split = regex.compile("(" + "|".join(map(regex.escape, named)) + ")").split if named else None
        self.bare = not self.cut(" ") and not self.cut("\n")
        # the fast way for plain words holds for lower-cased byte-level words only
        probe = "AÉz"
        byte = byte_alphabet()
        self.bytes = str.maketrans({chr(b): byte[b] for b in range(256)})
        self.plain = self.bare and [t for t, _ in self.cut(self.normal(probe))] == [self._spelled(probe.lower())]
        self.size, self.young, self.old = cache, {"": 0}, {}
        self.words, self.old_words = {}, {}

    def _spelled(self, word: str) -> str:
        """A word in the byte-level alphabet."""
        return word.encode().decode("latin-1").translate(self.bytes)

    def _word(self, pretoken: str) -> int:
        n = self.words.get(pretoken) or self.old_words.get(pretoken)
        if n is None:
            n = self.merges.count(pretoken)
        if len(pretoken) <= 40:
            if len(self.words) >= self.size:
                self.old_words, self.words = self.words, {}
            self.words[pretoken] = n
        return n

    def _segment(self, s: str) -> int:
        """A piece without special tokens."""
        if self.plain and (s.isascii() or max(s) < self.LATIN):
            low = s.lower()
            if low.isalpha():
                return self._word(self._spelled(low))
            if low[-1] in ".," and low[:-1].isalpha():
                return self._word(self._spelled(low[:-1])) + self._word(low[-1])
        return sum([self._word(t) for t, _ in self.cut(self.normal(s))])

    def _piece(self, s: str) -> int:
        if self.split is None or not any(t in s for t in self.special):
            return self._segment(s) if s else 0
        return sum([1 if p in self.special else self._segment(p) for p in self.split(s) if p])

    def count(self, text: str) -> int:
        if not self.bare:
            return self._piece(text)
        pieces = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        counts, i = list(map(self.young.get, pieces)), 0  # most pieces are known
        while True:
            try:
                i = counts.index(None, i)
            except ValueError:
                return sum(counts)
            s = pieces[i]
            n = self.young.get(s)
            if n is None and (n := self.old.get(s)) is None:
                n = self._piece(s)
            if len(s) <= 40:
                if len(self.young) >= self.size:
                    self.old, self.young = self.young, {"": 0}
                self.young[s] = n
            counts[i] = n


_COUNTERS: dict[str, TextCounter] = {}


def _counter(spec_json: str) -> TextCounter:
    """One counter (with its caches) per worker process and file."""
    key = hashlib.md5(spec_json.encode()).hexdigest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TextCounter(spec_json)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Adds ``out`` (long): the tokens of the whole text, as many as the
    tokenizers library gives without added special tokens, truncation or
    padding.

    ``path`` is a tokenizers file with a BPE model.  Special-token strings
    inside a text are one token each.  Null and empty texts have none.  Very
    long texts are counted whole: the work grows with n log n of the longest
    word and linearly otherwise, memory with the length of one text.  Rows,
    ties, repeated rows and the other columns stay as they are; an existing
    column ``out`` is replaced.  An empty table gives an empty result.
    """
    spec = tokenizer_file(docs.sparkSession, path)

    @F.pandas_udf("long")
    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(spec.value)
        for batch in texts:
            yield pd.Series([counter.count(t) if t else 0 for t in batch], dtype="int64")

    return docs.withColumn(out, counts(F.col(text)))


def token_report(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (more than ``limit`` tokens), one row per row of ``docs``.

    Null texts count as empty, null ids and repeated rows are kept as they
    are, very long texts are counted whole, an empty table gives an empty
    result, and other columns are not carried.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    d = count_tokens(d, path, "_text")
    return d.select("doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit"))
