"""Operator 3, byte-level BPE encoding and decoding.

A text is cut into pre-tokens; each pre-token starts as a doubly linked list
of byte symbols.  A priority queue holds the merge ranks of neighbouring
pairs; the lowest rank (leftmost on ties) merges first, and entries whose
symbols have changed meanwhile are skipped when they come up.  Decoding
concatenates the vocabulary strings of the ids.

The vocabulary file (fixed size) is read once on the driver and shipped to
the tasks, so its path need only exist there.  Texts are encoded row by row
inside tasks and never shuffled.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary
    strings: printable Latin-1 bytes stand for themselves, the others take
    the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class Merger:
    """BPE over one vocabulary: ``spec`` is the parsed tokenizer file."""

    def __init__(self, spec: dict):
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.single = [vocab[c] for c in byte_alphabet()]
        self.left, self.right, self.merged, self.rank = [], [], [], {}
        for r, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.left.append(vocab[a]), self.right.append(vocab[b]), self.merged.append(vocab[a + b])
            self.rank.setdefault(vocab[a] << 32 | vocab[b], r << 40)
        self.to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.strings = {i: bytes(self.to_byte[c] for c in s) for s, i in vocab.items()}
        self.strings.update({i: s.encode() for s, i in self.special.items()})

    def merge(self, token: bytes) -> list[int]:
        """Ids of one pre-token."""
        single = self.single
        sym = [single[c] for c in token]
        n = len(sym)
        if n < 2:
            return sym
        rank, left, right, merged = self.rank.get, self.left, self.right, self.merged
        queue = []
        a = sym[0]
        for i in range(1, n):
            b = sym[i]
            r = rank(a << 32 | b)
            if r is not None:
                queue.append(r + i - 1)  # rank above, position below
            a = b
        if not queue:
            return sym
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(queue)
        while queue:
            entry = heappop(queue)
            r, i = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[i]
            if sym[i] != left[r] or j >= n or sym[j] != right[r]:
                continue  # stale: a neighbour merged meanwhile
            a = sym[i] = merged[r]
            sym[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(a << 32 | sym[k])
                if r is not None:
                    heappush(queue, r + i)
            h = before[i]
            if h >= 0:
                r = rank(sym[h] << 32 | a)
                if r is not None:
                    heappush(queue, r + h)
        return [s for s in sym if s >= 0]

    def decode(self, ids) -> bytes:
        """The vocabulary strings of ``ids``, concatenated."""
        return b"".join(map(self.strings.__getitem__, ids))


class Encoder:
    """Encodes whole texts.  ``entry(ids)`` is what is kept of a word's ids,
    ``combine(entries)`` what is kept of several (of none: what adds nothing).

    A text is cut before every space that follows a non-space character;
    pre-tokens never cross such a cut, so each piece is encoded by itself.
    Two bounded caches, of pieces and of words (each in two generations of
    ``piece_cache`` and ``word_cache`` short strings), save most of the work.
    The cut of a piece into pre-tokens is the tokenizer file's own; pieces of
    plain Latin letters, with or without one punctuation mark behind them,
    need no pattern.
    """

    #: Letters below this code point are the same in every Unicode version.
    LATIN = "\u0250"

    def __init__(self, spec_json: str, entry, combine, piece_cache: int = 60_000,
                 word_cache: int = 200_000, bpe: Merger | None = None, merge=None):
        from tokenizers import Tokenizer
        import regex

        spec = json.loads(spec_json)
        self.bpe = bpe or Merger(spec)
        self.merge = merge or (lambda word: self.bpe.merge(word.encode()))
        self.pretokens = Tokenizer.from_str(spec_json).pre_tokenizer.pre_tokenize_str
        self.entry, self.combine, self.nothing = entry, combine, combine([])
        self.size, self.word_size = piece_cache, word_cache
        self.young, self.old, self.words, self.old_words = {}, {}, {}, {}
        named = sorted(self.bpe.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, named)) + ")").split if named else None

    def _word(self, word: str):
        e = self.words.get(word)
        if e is None:
            e = self.old_words.get(word)
            if e is None:
                e = self.entry(self.merge(word))
            if len(word) <= 32:
                if len(self.words) >= self.word_size:
                    self.old_words, self.words = self.words, {}
                self.words[word] = e
        return e

    def _piece(self, piece: str):
        core = piece[1:] if piece[:1] == " " else piece
        if core.isascii() or max(core) < self.LATIN:
            if core.isalpha():
                return self._word(piece)
            if core[-1:] in (".", ",") and core[:-1].isalpha():
                return self.combine((self._word(piece[:-1]), self._word(core[-1])))
        to_byte = self.bpe.to_byte
        return self.combine([self._word(bytes([to_byte[c] for c in token]).decode())
                             for token, _ in self.pretokens(piece)])

    def _keep(self, piece: str, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[piece] = value

    def _plain(self, text: str) -> list:
        """Entries of a text without special tokens."""
        pieces = text.split(" ")
        out = list(map(self.young.get, pieces))  # most pieces are known
        out[0], n, i = None, len(pieces), 0  # the first has no space before it
        while True:
            try:
                i = out.index(None, i)
            except ValueError:
                return out
            p = pieces[i]
            e = (self.young.get(p) or self.old.get(p)) if i else None
            if e is not None:
                self._keep(p, e)
            else:
                j = i + 1  # white space at a piece's end belongs with what follows
                while j < n and (not pieces[j - 1] or pieces[j - 1][-1].isspace()):
                    out[j] = self.nothing
                    j += 1
                s = p if j == i + 1 else " ".join(pieces[i:j])
                e = self._piece(" " + s if i else s)
                if i and j == i + 1 and p and len(p) <= 40 and not p[-1].isspace():
                    self._keep(p, e)
            out[i] = e

    def entries(self, text: str) -> list:
        if self.split is None or not any(s in text for s in self.bpe.special):
            return self._plain(text) if text else []
        out = []
        for part in self.split(text):
            if part in self.bpe.special:
                out.append(self.entry([self.bpe.special[part]]))
            elif part:
                out += self._plain(part)
        return out


_ENCODERS: dict = {}


def encoder(kind: str, spec_json: str, make) -> Encoder:
    """One encoder (with its cache) per worker process, kind and file."""
    key = kind, hashlib.md5(spec_json.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = make()
    return _ENCODERS[key]


def tokenizer_file(spark: SparkSession, path: str):
    """The vocabulary file's text as a broadcast (a fixed-size model file)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds ``out``, the token ids (array<int>) of the whole text, equal to
    the tokenizers library's without added special tokens.

    Special-token strings inside a text become their id.  Very long texts are
    encoded whole (one text and its ids must fit in a task).  Null and empty
    texts have no ids.  Rows, order and the other columns stay as they are;
    an existing column ``out`` is replaced.
    """
    spec = tokenizer_file(docs.sparkSession, path)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder("ids", spec.value, lambda: Encoder(
            spec.value, lambda i: np.array(i, np.int32).tobytes(), b"".join))
        for batch in texts:
            yield pd.Series([np.frombuffer(b"".join(enc.entries(t or "")), np.int32) for t in batch])

    return docs.withColumn(out, ids(F.col(text)))


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text of an id array: vocabulary strings concatenated
    and read as UTF-8 (invalid bytes become U+FFFD).  Null ids give ''."""
    spec = tokenizer_file(docs.sparkSession, path)

    @F.pandas_udf(T.StringType())
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder("decode", spec.value, lambda: Merger(json.loads(spec.value)))
        for batch in batches:
            yield pd.Series([bpe.decode(i.tolist() if i is not None else ()).decode("utf-8", "replace")
                             for i in batch])

    return docs.withColumn(out, texts(F.col(ids)))


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes each text without carrying its ids between steps:
    ``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas)
    and ``decoded_sha256`` (decoded text, UTF-8), as lower-case hex.

    Null texts count as empty; very long texts are encoded whole (a text and
    its ids must fit in a task).  Null ids and repeated rows are kept as they
    are; an empty table gives an empty result; other columns are not carried.
    """
    spec = tokenizer_file(docs.sparkSession, path)
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("i", T.StringType()),
                           T.StructField("d", T.StringType())])

    @F.pandas_udf(schema)
    def digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def make() -> Encoder:
            bpe = Merger(json.loads(spec.value))
            return Encoder(spec.value, lambda i: (len(i), ",".join(map(str, i)), bpe.decode(i)),
                           lambda e: (sum([x[0] for x in e]), ",".join([x[1] for x in e]),
                                      b"".join([x[2] for x in e])),
                           piece_cache=150_000, word_cache=400_000, bpe=bpe)

        enc = encoder("digests", spec.value, make)
        for batch in texts:
            rows = []
            for t in batch:
                n, ids, back = enc.combine([e for e in enc.entries(t or "") if e[0]])
                back = back.decode("utf-8", "replace").encode("utf-8")
                rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest()))
            yield pd.DataFrame(rows, columns=["n", "i", "d"])

    r = docs.select(F.col(id_col).alias("doc_id"), digests(F.col(text)).alias("_r"))
    return r.select("doc_id", F.col("_r.n").alias("n_tokens"), F.col("_r.i").alias("ids_sha256"),
                    F.col("_r.d").alias("decoded_sha256"))
