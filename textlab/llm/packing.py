"""Operator 7, packing by cutting-stock column generation.

Each document's ids are cut into full sequences and a remainder.  The
remainders' length histogram (at most one number per length) is a
cutting-stock problem: a linear program over packing patterns whose columns
are priced by knapsack dynamic programming.  Rounded patterns, and exact fills
of the residue that rounding leaves, are filled with the documents of each
length by rank; the few pieces that fit nowhere are laid end to end by a
running sum and cut into full sequences, the last one into powers of two.

Only the histogram reaches the driver.  Ranks are spread over hash cells, and
the pattern table has at most one row per pattern and length.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.bpe import Encoder, Merger, encoder, tokenizer_file
from textlab.llm.common import ranked, written


#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ------------------------------------------------------- cutting-stock model
def price(values: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Knapsack dynamic programming: copies of each length (capacity
    ``size``) with the largest total value; values of 0 or less are unused."""
    use = np.flatnonzero(values > 0)
    counts = np.zeros(lengths.size, np.int64)
    if not use.size:
        return counts
    v, ln = values[use], lengths[use]
    best, take = np.zeros(size + 1), np.full(size + 1, -1)
    fits = np.searchsorted(ln, np.arange(size + 1), side="right")  # lengths ascend
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            got = v[:n] + best[c - ln[:n]]
            k = int(got.argmax())
            if got[k] > best[c]:
                best[c], take[c] = got[k], k
    c = size
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            counts[use[take[c]]] += 1
            c -= ln[take[c]]
    return counts


def _table(values: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack dynamic programming for every capacity up to ``size``: the
    largest total value, and the length taken there (-1: none)."""
    use = np.flatnonzero(values > 0)
    best, take = np.zeros(size + 1), np.full(size + 1, -1)
    v, ln = values[use], lengths[use]
    fits = np.searchsorted(ln, np.arange(size + 1), side="right")  # lengths ascend
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            got = v[:n] + best[c - ln[:n]]
            k = int(got.argmax())
            if got[k] > best[c]:
                best[c], take[c] = got[k], use[k]
    return best, take


def _walk(take: np.ndarray, lengths: np.ndarray, capacity: int, counts: dict[int, int]) -> dict[int, int]:
    """Adds the best fill of a capacity to ``counts``."""
    c = capacity
    while c > 0:
        if (k := int(take[c])) < 0:
            c -= 1
        else:
            counts[k] = counts.get(k, 0) + 1
            c -= int(lengths[k])
    return counts


def price(values: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Copies of each length (capacity ``size``) with the largest total value;
    values of 0 or less are unused."""
    counts = np.zeros(lengths.size, np.int64)
    for k, n in _walk(_table(values, lengths, size)[1], lengths, size, {}).items():
        counts[k] = n
    return counts


def _greedy(lengths: np.ndarray, demand: np.ndarray, size: int) -> tuple[list[dict], list[float]]:
    """A first set of patterns that meets the demand: the longest open length
    is joined by the fullest fill from the open lengths, and the length that
    runs out is closed."""
    left, open_, patterns, level = demand.astype(np.float64), np.ones(lengths.size, bool), [], []
    for _ in range(lengths.size):
        top = int(np.flatnonzero(open_)[-1])
        weight = np.where(open_ & (left > 0), lengths * (1.0 + 1e-9 * np.log1p(left)), 0)
        room = int(size - lengths[top])
        counts = _walk(_table(weight, lengths, room)[1], lengths, room, {})
        counts[top] = counts.get(top, 0) + 1
        at, n = np.array(list(counts)), np.array(list(counts.values()))
        ratio = left[at] / n
        k = int(ratio.argmin())
        left[at] = np.maximum(left[at] - ratio[k] * n, 0)
        left[at[k]], open_[at[k]] = 0.0, False
        patterns.append(counts), level.append(float(ratio[k]))
    return patterns, level


def _master(patterns: list[dict], demand: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Levels and dual prices of the linear program over ``patterns``: the
    least sum of levels that holds ``demand`` exactly.  A primal-dual
    interior-point method (predictor and corrector): unlike a simplex basis
    it has no degenerate steps, and its prices are central, not extreme."""
    m, n = demand.size, len(patterns)
    sizes = np.array([len(p) for p in patterns])
    col, row = np.repeat(np.arange(n), sizes), np.fromiter((i for p in patterns for i in p), np.int64, sizes.sum())
    val = np.fromiter((c for p in patterns for c in p.values()), np.float64, sizes.sum())
    # pairs of entries of one column, for A diag(x/s) A'
    rep, first = sizes[col], np.cumsum(sizes) - sizes
    a = np.repeat(np.arange(col.size), rep)
    b = np.repeat(first[col], rep) + np.arange(a.size) - np.repeat(np.cumsum(rep) - rep, rep)
    place, weight, of = row[a] * m + row[b], val[a] * val[b], col[a]
    times = lambda x: np.bincount(row, val * x[col], m)
    turned = lambda y: np.bincount(col, val * y[row], n)

    def normal(d: np.ndarray) -> np.ndarray:
        out = np.bincount(place, weight * d[of], m * m).reshape(m, m)
        out[np.diag_indices(m)] *= 1 + 1e-13
        return out

    scale = float(demand.max())
    goal, full = demand / scale, normal(np.ones(n))
    x, y = turned(np.linalg.solve(full, goal)), np.linalg.solve(full, times(np.ones(n)))
    s = 1 - turned(y)
    x, s = x + max(-1.5 * x.min(), 0) + 1e-9, s + max(-1.5 * s.min(), 0) + 1e-9
    x, s = x + 0.5 * (x @ s) / s.sum(), s + 0.5 * (x @ s) / x.sum()
    for _ in range(100):
        lack, slack = goal - times(x), 1 - turned(y) - s
        if max(abs(x.sum() - goal @ y) / (1 + x.sum()), np.abs(lack).max(), np.abs(slack).max()) < tolerance:
            break
        try:
            matrix = normal(x / s)

            def step(target: np.ndarray):
                dy = np.linalg.solve(matrix, lack + times(x / s * slack - target / s))
                ds = slack - turned(dy)
                return (target - x * ds) / s, dy, ds

            far = lambda v, d: min(1.0, (-v[d < 0] / d[d < 0]).min(initial=np.inf))
            dx, _, ds = step(-x * s)
            ahead = ((x + far(x, dx) * dx) @ (s + far(s, ds) * ds)) / (x @ s)
            dx, dy, ds = step(-x * s - dx * ds + ahead ** 3 * (x @ s) / n)
        except np.linalg.LinAlgError:
            break  # as near as doubles get
        if not (np.isfinite(dx).all() and np.isfinite(ds).all()):
            break
        p, d = 0.99 * far(x, dx), 0.99 * far(s, ds)
        x, y, s = x + p * dx, y + d * dy, s + d * ds
    return x * scale, y


def cutting_stock(lengths: np.ndarray, demand: np.ndarray, size: int, max_pivots: int | None = None,
                  gap: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and their linear-program levels: the fewest sequences
    of ``size`` that hold exactly ``demand`` pieces of each length, by column
    generation.

    The first patterns are greedy ones and those of one length each.  In each
    round the program over the patterns so far gives dual prices, and knapsack
    dynamic programming prices all patterns under them: for every length, the
    most valuable pattern that holds it enters if it is worth more than a
    sequence; so do those found under prices drawn halfway to proportional
    ones, which steadies the search.  It ends when no pattern is worth more, or
    the total is within ``gap`` of the lower bound (material, or prices over
    the best value).  ``max_pivots`` limits the rounds; 0 gives the greedy
    start.
    """
    m = lengths.size
    if not m:
        return np.zeros((0, 0), np.int64), np.zeros(0)
    goal, even = demand.astype(np.float64), lengths / size
    patterns, level = _greedy(lengths, demand, size)
    x, bound, done = np.array(level), float((lengths * demand).sum()) / size, 0
    if (max_pivots is None or max_pivots > 0) and x.sum() > bound * (1 + gap):
        seen = {tuple(sorted(p.items())) for p in patterns}

        def add(counts: dict[int, int]) -> bool:
            key = tuple(sorted(counts.items()))
            if key in seen:
                return False
            seen.add(key), patterns.append(counts)
            return True

        for i in range(m):
            add({i: int(size // lengths[i])})
        while True:
            x, dual = _master(patterns, goal, 1e-4)
            best, take = _table(dual, lengths, size)
            bound = max(bound, float(dual @ goal) / max(1.0, best[size]))
            if x.sum() <= bound * (1 + gap) or done == max_pivots:
                break
            done, new = done + 1, 0
            for prices, (_, takes) in ((dual, (best, take)), (None, _table((dual + even) / 2, lengths, size))):
                for i in range(m):
                    room = int(size - lengths[i])
                    if prices is not None and prices[i] + best[room] <= 1 + 1e-7:
                        continue
                    counts = _walk(takes, lengths, room, {})
                    counts[i] = counts.get(i, 0) + 1
                    if prices is not None or sum(dual[k] * n for k, n in counts.items()) > 1 + 1e-7:
                        new += add(counts)
            if not new:
                break
        x, _ = _master(patterns, goal, 1e-9)
        x = np.maximum(x, 0)
    out = np.zeros((len(patterns), m), np.int64)
    for r, counts in enumerate(patterns):
        out[r, list(counts)] = list(counts.values())
    return out, x


def _exact_fill(left: np.ndarray, lengths: np.ndarray, room: int) -> dict[int, int] | None:
    """Copies of the lengths still ``left`` that fill ``room`` exactly, long
    ones first; None if there are none.  Reachable sums are bits of a number."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for k in np.flatnonzero((left > 0) & (lengths <= room))[::-1]:
        many, ln, copies = int(left[k]), int(lengths[k]), 1
        while many and ln * min(copies, many) <= room:
            copies = min(copies, many)
            steps.append((int(k), copies, reach))
            reach |= reach << (ln * copies) & mask
            many, copies = many - copies, copies * 2
        if reach >> room & 1:
            break
    if not reach >> room & 1:
        return None
    counts, c = {}, room
    for k, copies, before in reversed(steps):
        if not before >> c & 1:
            counts[k] = counts.get(k, 0) + copies
            c -= int(lengths[k]) * copies
    return counts


def rounded(patterns: np.ndarray, level: np.ndarray, lengths: np.ndarray, demand: np.ndarray,
            size: int) -> list[tuple[dict[int, int], int]]:
    """Full patterns (counts by length, times) within the demand: levels
    rounded down, then single sequences of what is left of them by falling
    fraction, then the residue, longest first, by exact fills of what is left.
    Patterns with a gap are no use here, as left-over pieces can be cut."""
    left, out = demand.astype(np.int64).copy(), []

    def use(counts: dict[int, int], times: int) -> None:
        at = list(counts)
        n = np.array([counts[k] for k in at])
        times = min(times, int((left[at] // n).min()))
        if times > 0:
            left[at] -= n * times
            out.append((counts, times))

    full = [r for r in np.flatnonzero(level > 1e-6) if int(patterns[r] @ lengths) == size]
    counts = {r: {int(k): int(patterns[r, k]) for k in np.flatnonzero(patterns[r])} for r in full}
    for r in sorted(full, key=lambda r: -level[r]):
        use(counts[r], int(level[r] + 1e-6))
    for r in sorted(full, key=lambda r: -(level[r] % 1)):
        use(counts[r], 1)
    open_ = np.ones(lengths.size, bool)
    while (tops := np.flatnonzero(open_ & (left > 0))).size:
        top = int(tops[-1])
        left[top] -= 1
        fill = _exact_fill(left, lengths, int(size - lengths[top]))
        left[top] += 1
        if fill is None:
            open_[top] = False
        else:
            fill[top] = fill.get(top, 0) + 1
            use(fill, int(left[top]))
    return out


def slots(lengths: np.ndarray, demand: np.ndarray, size: int, **lp) -> tuple[pd.DataFrame, int]:
    """Rounded patterns as rank intervals, and the number of their sequences.

    Row (len, lo, hi, copies, base, offset): pieces of that length with rank
    lo..hi-1 go to sequence base + (rank - lo) // copies, at ``offset`` plus
    (rank - lo) % copies pieces.  Ranks beyond the last interval are left over.
    """
    used, rows, base = np.zeros(lengths.size, np.int64), [], 0
    for counts, times in rounded(*cutting_stock(lengths, demand, size, **lp), lengths, demand, size) if lengths.size else ():
        offset = 0
        for k, copies in sorted(counts.items()):
            rows.append((lengths[k], used[k], used[k] + times * copies, copies, base, offset))
            used[k] += times * copies
            offset += int(lengths[k]) * copies
        base += times
    columns = ["len", "lo", "hi", "copies", "base", "offset"]
    return pd.DataFrame(rows, columns=columns).astype(np.int64), base


# ----------------------------------------------------------------- on Spark
def _cut_documents(spec, size: int, end_id: int):
    """(_row, _id, text) to ids in full sequences (their checksums) and the
    remainder (its ids)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder("pack", spec.value, lambda: fast_encoder(spec.value))
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            n, crcs, rest, crc = [], [], [], []
            for t in b["_text"]:
                ids = b"".join(enc.entries(t)) + end
                n.append(len(ids) // 4)
                whole = len(ids) // (4 * size) * 4 * size
                crcs.append([zlib.crc32(ids[i:i + 4 * size]) for i in range(0, whole, 4 * size)])
                tail = ids[whole:]
                crc.append(zlib.crc32(tail))
                a = np.frombuffer(tail, "<u4")
                rest.append(tail if a.size and a.max() > 0xFFFF else a.astype("<u2").tobytes())
            yield pd.DataFrame({"_row": b["_row"], "_id": b["_id"], "_n": n, "_crcs": crcs,
                                "_rest": rest, "_crc": crc})
    return run


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian 32-bit ids."""
    return struct.pack(f"<{len(ids)}I", *ids)


class FastEncoder:
    """Little-endian 32-bit ids of whole texts.  Texts of Latin letters and
    marks without special-token strings go to the tiktoken library whole, if
    the file has the pattern and the merge order that it assumes (it ranks a
    pair by the id of its result); its Unicode tables equal the tokenizers
    library's there.  Other texts are cut by the file's own pre-tokenizer."""

    def __init__(self, spec_json: str):
        import tiktoken

        spec = json.loads(spec_json)
        bpe, merge, self.whole = Merger(spec), None, None
        if max(bpe.single) < bpe.merged[0] and all(a < b for a, b in zip(bpe.merged, bpe.merged[1:])):
            ranks = {bpe.strings[i]: i for i in (*bpe.single, *bpe.merged)}
            plain = tiktoken.Encoding("pack", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
            merge = plain.encode_ordinary
            cutter = spec["pre_tokenizer"] or {}
            if cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) \
                    and not cutter.get("add_prefix_space") and not spec.get("normalizer"):
                self.whole = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = Encoder(spec_json, pack_ids, b"".join, piece_cache=500_000, word_cache=250_000, bpe=bpe, merge=merge)
        self.special = list(bpe.special)
        self.foreign = re.compile(f"[^\x00-{chr(ord(Encoder.LATIN) - 1)}]").search

    def entries(self, text: str) -> list[bytes]:
        """The ids, in one or several pieces."""
        if self.whole is None or self.foreign(text) or any(s in text for s in self.special):
            return self.slow.entries(text)
        return [self.whole.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()]


def fast_encoder(spec_json: str) -> FastEncoder:
    return FastEncoder(spec_json)


def _place(table: pd.DataFrame, spread: int = 1 << 40):
    """Ranked remainders to (sequence, offset), or null beyond the patterns."""
    t = table.sort_values(["len", "lo"])
    start = (t["len"] * spread + t["lo"]).to_numpy()
    cols = {c: t[c].to_numpy() for c in t.columns}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ln, rank = b["_len"].to_numpy(np.int64), b["_rank"].to_numpy(np.int64)
            k = np.searchsorted(start, ln * spread + rank, side="right") - 1
            seq, off = np.full(len(b), -1, np.int64), np.zeros(len(b), np.int64)
            if start.size:
                ok = (k >= 0) & (cols["len"][k] == ln) & (rank < cols["hi"][k])
                q, a = (rank - cols["lo"][k])[ok], cols["copies"][k][ok]
                seq[ok] = cols["base"][k][ok] + q // a
                off[ok] = cols["offset"][k][ok] + q % a * ln[ok]
            yield pd.DataFrame({"_row": b["_row"], "_seq": seq, "_off": off})
    return run


def _free_cuts(size: int, first: int):
    """Left-over remainders, each with its place in one long row of ids, cut
    at full sequences; the ids behind the last full one are cut at powers of
    two.  A remainder needs only its own place and the total."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                pos, total = r["_pos"], r["_sum"]
                whole = total // size
                tail, at = [], whole * size  # (end, start) of the power-of-two sequences
                for bit in range(size.bit_length() - 2, -1, -1):
                    if (total - whole * size) >> bit & 1:
                        tail.append((at + (1 << bit), at))
                        at += 1 << bit
                ids = np.frombuffer(r["_rest"], "<u2" if len(r["_rest"]) < 4 * r["_len"] else "<u4").astype("<u4")
                cut = 0
                while cut < ids.size:
                    p = pos + cut
                    if p < whole * size:
                        seq, begin = p // size, p // size * size
                        end = begin + size
                    else:
                        k = next(i for i, t in enumerate(tail) if p < t[0])
                        seq, (end, begin) = whole + k, tail[k]
                    n = min(ids.size - cut, end - p)
                    out.append((r["_id"], r["_base"] + cut, n, zlib.crc32(ids[cut:cut + n].tobytes()), r["_n"],
                                first + seq, p - begin))
                    cut += n
            yield pd.DataFrame(out, columns=PIECE)
    return run


#: The columns of a piece.
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", size: int = 1024,
         end_id: int = 0, **lp) -> DataFrame:
    """Packs the token ids of every whole text, plus ``end_id``, into
    sequences of at most ``size`` (a power of two).

    One row per piece: ``doc_id``, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32`` (unsigned, of little-endian 32-bit ids),
    ``doc_tokens`` (ids of its document, end id included), ``sequence_id`` and
    ``offset`` in the sequence.  Every id lies in exactly one piece, and every
    sequence is full or has a power of two of ids, so none needs padding.

    Null and empty texts have the end id alone; very long texts are encoded
    whole (one text and its ids must fit in a task).  Null ids and repeated rows
    are packed as rows of their own.  An empty table gives an empty result.
    Other columns are not carried.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    spark = docs.sparkSession
    spec = tokenizer_file(spark, path)
    src = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
                      F.coalesce(F.col(text), F.lit("")).alias("_text"))
    id_type = dict(src.dtypes)["_id"]
    cut = src.mapInPandas(_cut_documents(spec, size, end_id),
                          f"_row long, _id {id_type}, _n long, _crcs array<long>, _rest binary, _crc long")
    cut = written(cut, "cut-documents").withColumn("_len", F.col("_n") % size).withColumn(
        "_base", F.col("_n") - F.col("_len"))

    hist = cut.groupBy("_len").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("_crcs")).alias("full"))
    hist = hist.orderBy("_len").collect()  # one row per length, at most `size`
    full = sum(r["full"] for r in hist)
    lengths = np.array([r["_len"] for r in hist if r["_len"]], np.int64)
    demand = np.array([r["n"] for r in hist if r["_len"]], np.int64)
    table, made = slots(lengths, demand, size, **lp)

    # remainders: ranked among their length, then placed by the pattern table
    rest = cut.where(F.col("_len") > 0)
    order = ranked(rest.select("_row", "_len"), ["_len"], ["_row"], "_rank")
    place = order.mapInPandas(_place(table), "_row long, _seq long, _off long")
    place = written(rest.select("_row", "_id", "_n", "_len", "_base", "_crc").join(place, "_row"), "placed")
    whole = place.where(F.col("_seq") >= 0).select(
        F.col("_id").alias("doc_id"), F.col("_base").alias("start"), F.col("_len").alias("length"),
        F.col("_crc").alias("ids_crc32"), F.col("_n").alias("doc_tokens"),
        F.col("_seq").alias("sequence_id"), F.col("_off").alias("offset"))

    loose = ranked(place.where(F.col("_seq") < 0).select("_row", "_id", "_n", "_len", "_base"), [], ["_row"],
                   "_pos", weight="_len", total="_sum")
    pieces = loose.join(cut.select("_row", "_rest"), "_row").mapInPandas(
        _free_cuts(size, made + full), f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in PIECE[1:]))

    # full sequences: numbered behind the patterns' by a spread-out running sum
    heavy = cut.where(F.size("_crcs") > 0).select("_row", "_id", "_n", "_crcs", F.size("_crcs").cast("long").alias("_k"))
    heavy = ranked(heavy, [], ["_row"], "_first", weight="_k")
    heavy = heavy.select("_id", "_n", "_first", F.posexplode("_crcs").alias("_i", "_crc")).select(
        F.col("_id").alias("doc_id"), (F.col("_i") * size).cast("long").alias("start"),
        F.lit(size).cast("long").alias("length"), F.col("_crc").alias("ids_crc32"),
        F.col("_n").alias("doc_tokens"), (F.lit(made) + F.col("_first") + F.col("_i")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(pieces).unionByName(heavy)
