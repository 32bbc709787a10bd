"""Exact positional index (P1) and positional splits (A2-A4).

The reference slices datasets by row position (``train[:90%]``,
``train[-10%:]``, ``df[:-500]``).  A global ``row_number()`` would pull all
rows into one task, and ``monotonically_increasing_id`` is not dense, so P1
is composed from distributed pieces:

1. the whole order key is read as a row of 64-bit words whose order is the
   key's order (a null flag and a value per column; 7 bytes at a time of a
   string);
2. a radix histogram splits the key space: the digit below the bits that all
   rows share is counted, and only buckets with more than a cell's share of
   the rows are split by the next digits, whichever word they are in.  A hot
   or null leading key is so split by the words behind it.  Counts and word
   ranges of a bounded number of buckets reach the driver, never rows;
3. neighbouring buckets form cells of at most twice the mean size;
4. ``row_number()`` inside ``(groups, cell)`` -- many small sorted windows --
   plus the count of the cells before, which the histogram has told already.

The counting passes read the key columns only; the rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.session import cut_lineage

_MIN, _MAX, _PIECE = -(1 << 63), (1 << 63) - 1, 7


def _default_cells(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(1000, max(2, 4 * n))


def _double_word(x: Column) -> Column:
    """The bits of a double as a long in the order of the values (NaN last)."""
    v = x.cast("double")
    a, one = F.abs(v), 2.0 ** 52
    two = lambda e: F.pow(F.lit(2.0), e)
    e = F.greatest(F.floor(F.log2(a)), F.lit(-1022))
    e = e + (a / two(e) >= 2).cast("long") - ((a / two(e) < 1) & (e > -1022)).cast("long")  # log2 rounds
    bits = (e + 1022) * F.lit(1 << 52) + F.floor(a / two(e) * one)
    bits = F.when(a == 0, F.lit(0)).when(a == float("inf"), F.lit(2047 << 52)).otherwise(bits)
    return F.when(F.isnan(v), F.lit(_MAX)).when(v < 0, -bits).otherwise(bits)


def _key_words(df: DataFrame, col: str, pieces: int) -> list[Column]:
    """Longs whose order, one after the other, is the order of ``col`` (nulls
    first); of strings, the first ``pieces`` pieces and the length."""
    x, kind = F.col(f"`{col}`"), df.schema[col].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = x.cast("binary")
        value = [F.conv(F.rpad(F.hex(F.substring(raw, _PIECE * k + 1, _PIECE)), 2 * _PIECE, "0"), 16, 10).cast("long")
                 for k in range(pieces)] + [F.octet_length(x).cast("long")]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = [_double_word(x)]
    elif isinstance(kind, T.DecimalType) and kind.scale <= 18:
        whole = F.floor(x).cast("decimal(38,0)")
        high = F.floor(whole / F.lit(10 ** 18)).cast("long")
        value = [high, F.pmod(whole, F.lit(10 ** 18)).cast("long"), ((x - F.floor(x)) * 10 ** 18).cast("long")]
    elif isinstance(kind, T.TimestampType):
        value = [F.unix_micros(x)]
    elif isinstance(kind, T.DateType):
        value = [F.unix_date(x).cast("long")]
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        value = [(x.cast("int") if isinstance(kind, T.BooleanType) else x).cast("long")]
    else:
        raise TypeError(f"no order words for {col} of type {kind.simpleString()}")
    return [x.isNotNull().cast("long"), *[F.coalesce(v, F.lit(0).cast("long")) for v in value]]


def _digit(word: Column, shift: Column, bits: int) -> Column:
    """``bits`` bits of a word from ``shift`` on, in unsigned order."""
    flipped = word.bitwiseXOR(F.lit(_MIN))
    return F.call_function("shiftrightunsigned", flipped, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


class _Node:
    """A bucket: its rows, the range of each word, and how it is split."""

    def __init__(self, n: int, low: list, high: list):
        self.n, self.low, self.high = n, low, high
        self.number = self.word = self.shift = None
        self.children: dict[int, _Node] = {}

    def choose(self, bits: int) -> bool:
        """The first word that still differs and the place of its digit."""
        for i, (a, b) in enumerate(zip(self.low, self.high)):
            if a != b:
                self.word, self.shift = i, max(0, (a ^ b).bit_length() - bits if (a < 0) == (b < 0) else 64 - bits)
                return True
        return False


class OrderedCells:
    """Cells 0, 1, ... of a table, ascending with the order key within each
    group, none above twice the mean size.

    ``assign(df)`` adds ``_cell`` (int) and, without groups, ``_before``
    (rows of all earlier cells).  ``n`` is the number of rows.  Rows that
    agree in all order columns are parted by a written row number if there
    are more of them than fit in a cell: use ``rows`` from then on.
    The rows must be the same in every pass over them.
    """

    def __init__(self, df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                 n_cells: int | None = None):
        self.cells = n_cells or _default_cells(df)
        self.rows, self.order, self.groups = df, list(order_cols), list(group_cols)
        self.pieces, self.tied, self.longest = 2, False, 0
        self.texts = [c for c in self.order if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))]
        if self.texts:
            self.longest = df.agg(F.max(F.greatest(F.lit(0), F.lit(0), *[
                F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c in self.texts]))).first()[0] or 0
        self._split()

    def _words(self) -> list[Column]:
        words = [F.xxhash64(*[F.col(f"`{c}`") for c in self.groups])] if self.groups else []
        for c in self.order:
            if c in self.texts and self.pieces * _PIECE < self.longest:
                # no later word counts before the string is read to its end, nor does its length
                return words + _key_words(self.rows, c, self.pieces)[:-1]
            words += _key_words(self.rows, c, self.pieces)
        return [*words, *([F.col("_copy")] if self.tied else [])]

    def _ranges(self, k: int) -> list[Column]:
        return [F.count(F.lit(1)).alias("n"), *[f(f"_w{i}").alias(f"{name}{i}") for i in range(k)
                                                for f, name in ((F.min, "low"), (F.max, "high"))]]

    def _node(self, row, k: int) -> _Node:
        return _Node(row["n"], [row[f"low{i}"] for i in range(k)], [row[f"high{i}"] for i in range(k)])

    def _longer(self) -> bool:
        """Reads more pieces of strings, if there are any; else numbers the
        copies.  False if neither is left to do."""
        if self.pieces * _PIECE < self.longest:
            self.pieces *= 2
            return True
        if not self.tied:
            self.tied = True
            self.rows = cut_lineage(self.rows.withColumn("_copy", F.monotonically_increasing_id()))
            return True
        return False

    def _split(self) -> None:
        while True:
            words = self._words()
            k, self.bits = len(words), []
            d = self.rows.select(*[w.alias(f"_w{i}") for i, w in enumerate(words)])
            self.root = self._node(d.agg(*self._ranges(k)).first(), k)
            self.n, self.root.number = self.root.n, 0
            share = max(1, -(-self.n // self.cells))
            self.levels, heavy, stuck = [], [self.root] if self.n > share else [], False
            while heavy and not stuck:
                bits = 8 if self.levels else min(12, max(8, (4 * self.cells - 1).bit_length()))
                self.bits.append(bits)
                stuck = not all([h.choose(bits) for h in heavy])
                if stuck:
                    break
                self.levels.append({h.number: h for h in heavy})
                found = self._walk(d, last=True).where("_d is not null").groupBy("_b", "_d").agg(*self._ranges(k)).collect()
                nodes = self.levels[-1]
                for r in found:
                    nodes[r["_b"]].children[r["_d"]] = self._node(r, k)
                heavy = [c for h in heavy for c in h.children.values() if c.n > share]
                for i, c in enumerate(heavy):
                    c.number = len(self.levels) << 20 | i
            if not (stuck and self._longer()):
                break
        self._number(share)

    def _number(self, share: int) -> None:
        """Cells of the leaves, in order."""
        before, todo = 0, [self.root]
        while todo:
            node = todo.pop()
            if node.children:
                todo += [node.children[d] for d in sorted(node.children, reverse=True)]
            else:
                node.cell = before // share
                before += node.n
                node.before = before - node.n
        first: dict[int, int] = {}
        for node in self._leaves():
            first[node.cell] = min(first.get(node.cell, node.before), node.before)
        self.first = first

    def _leaves(self) -> list[_Node]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            todo += node.children.values()
            if not node.children:
                out.append(node)
        return out

    def _walk(self, d: DataFrame, last: bool) -> DataFrame:
        """``d`` (words ``_w0``, ...) with its bucket ``_b`` and, there, its
        digit ``_d``; without ``last``, ``_cell`` and ``_before``."""
        spark = d.sparkSession
        d = d.select("*", F.lit(0).alias("_b"), F.lit(self.root.word).cast("int").alias("_wi"),
                     F.lit(self.root.shift).cast("int").alias("_sh"))
        cells, befores = [], []
        for level, nodes in enumerate(self.levels):
            used = sorted({h.word for h in nodes.values()})
            digit = F.lit(None).cast("int")
            for i in used:
                digit = F.when(F.col("_wi") == i, _digit(F.col(f"_w{i}"), F.col("_sh"), self.bits[level])).otherwise(digit)
            d = d.withColumn("_d", digit)
            if last and level == len(self.levels) - 1:
                break
            rows = [(b, x, c.number, c.word, c.shift, None if last or c.children else c.cell,
                     None if last or c.children else self.first[c.cell])
                    for b, h in nodes.items() for x, c in h.children.items() if not last or c.number is not None]
            table = spark.createDataFrame(rows, f"_pb int, _pd int, _nb int, _nw int, _ns int, _c{level} int, _f{level} long")
            # a bounded table: at most 256 rows per cell (4,096 at the first level)
            d = d.join(F.broadcast(table), (F.col("_b") == F.col("_pb")) & (F.col("_d") == F.col("_pd")), "left")
            d = d.withColumns({"_b": F.col("_nb"), "_wi": F.col("_nw"), "_sh": F.col("_ns")}).drop(
                "_pb", "_pd", "_nb", "_nw", "_ns", "_d")
            cells.append(F.col(f"_c{level}")), befores.append(F.col(f"_f{level}"))
        if last:
            return d
        return d.withColumn("_cell", F.coalesce(*cells, F.lit(0))).withColumn(
            "_before", F.coalesce(*befores, F.lit(0).cast("long"))).drop(
            "_b", "_wi", "_sh", *[f"_{x}{i}" for i in range(len(cells)) for x in "cf"])

    def assign(self) -> DataFrame:
        """The rows with ``_cell`` and ``_before`` (of no use with groups)."""
        words = self._words()
        d = self.rows.select("*", *[w.alias(f"_w{i}") for i, w in enumerate(words)])
        return self._walk(d, last=False).drop("_copy", *[f"_w{i}" for i in range(len(words))])


def positional_index(df: DataFrame, order_cols: Sequence[str],
                     group_cols: Sequence[str] = (), out: str = "idx",
                     total: str | None = None, n_cells: int | None = None) -> DataFrame:
    """Add a dense 0-based position ``out`` in ``order_cols`` order within
    each group (any sortable scalar types; nulls come first; rows that agree
    in all of them take neighbouring positions in any order).  ``total`` also
    adds the group size.  Null group values are groups of their own."""
    group_cols = list(group_cols)
    cells = OrderedCells(df, order_cols, group_cols, n_cells)
    keyed = cells.assign()
    w = Window.partitionBy(*group_cols, "_cell").orderBy(*[F.col(c) for c in order_cols])
    ranked = keyed.withColumn("_rn", F.row_number().over(w))
    if group_cols:
        sizes = keyed.groupBy(*group_cols, "_cell").agg(F.count(F.lit(1)).alias("_sz"))
        wc = Window.partitionBy(*group_cols).orderBy("_cell")
        offsets = sizes.select(
            *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], F.col("_cell").alias("_oc"),
            F.coalesce(F.sum("_sz").over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
            F.sum("_sz").over(Window.partitionBy(*group_cols)).alias("_all"))
        on = F.col("_cell") == F.col("_oc")
        for i, c in enumerate(group_cols):
            on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
        ranked = ranked.join(offsets, on).drop("_oc", *[f"_g{i}" for i in range(len(group_cols))])
    else:
        ranked = ranked.withColumn("_off", F.col("_before")).withColumn("_all", F.lit(cells.n).cast("long"))
    res = ranked.withColumn(out, (F.col("_off") + F.col("_rn") - 1).cast("long"))
    if total:
        res = res.withColumn(total, F.col("_all"))
    return res.drop("_cell", "_before", "_rn", "_off", "_all")


def _py_round_half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("long")


def split_fraction(df: DataFrame, key: str, pct: float = 90.0,
                   mode: str = "parity", group_cols: Sequence[str] = ()) -> DataFrame:
    """A2 + A3: ``(rows..., split)`` where ``split`` is ``train`` for the first
    ``pct`` % by position and ``validation`` for the last ``100-pct`` %.

    ``mode='parity'`` rounds both boundaries independently, half to even,
    like a ``[:90%]`` / ``[-10%:]`` slice pair -- for n ending in 5 one row
    can fall in neither split or in both (then it is emitted twice).
    ``mode='complement'`` cuts once: every row is in exactly one split.
    """
    idx = positional_index(df, [key], group_cols, out="_idx", total="_n")
    n = F.col("_n").cast("double")
    head_end = _py_round_half_even(F.lit(pct) * n / 100.0)
    if mode == "parity":
        tail_start = F.col("_n") + _py_round_half_even(-F.lit(100.0 - pct) * n / 100.0)
    elif mode == "complement":
        tail_start = head_end
    else:
        raise ValueError("mode must be 'parity' or 'complement'")
    labels = F.filter(
        F.array(F.when(F.col("_idx") < head_end, F.lit("train")),
                F.when(F.col("_idx") >= tail_start, F.lit("validation"))),
        lambda s: s.isNotNull())
    return (idx.withColumn("split", F.explode(labels))
            .withColumnRenamed("_idx", "position").drop("_n"))


def split_tail(df: DataFrame, key: str, n: int = 500) -> tuple[DataFrame, DataFrame]:
    """A4: ``(head, tail)`` -- the last ``n`` rows by ``key`` and the rest.

    Every row is in exactly one part; rows with an equal key are ordered by a
    hash of all their columns.  The cut is the last row of one top-n; only if
    equal rows lie on both sides of it are those rows, and no others, counted
    off by position.
    """
    d = df.withColumn("_tie", F.xxhash64(*df.columns))
    row = F.struct(F.col(key).alias("k"), F.col("_tie").alias("t"))
    if n < 1:
        return df, df.where(F.lit(False))
    top = d.select(key, "_tie").orderBy(F.col(key).desc(), F.col("_tie").desc()).limit(n)
    last = top.agg(F.min(row).alias("c"), F.count(F.lit(1)).alias("n")).first()
    if last["n"] < n:
        return df.where(F.lit(False)), df
    cut, tie = last["c"]["k"], last["c"]["t"]
    k, t = F.col(key), F.col("_tie")
    same = k.eqNullSafe(F.lit(cut)) & (t == tie)
    after = (k > F.lit(cut)) if cut is not None else k.isNotNull()
    after = F.coalesce(after, F.lit(False)) | (k.eqNullSafe(F.lit(cut)) & (t > tie))
    beyond = d.agg(F.count_if(after), F.count_if(same)).first()
    in_tail = after | same
    parts = d.where(~in_tail), d.where(in_tail)
    if (keep := n - beyond[0]) < beyond[1]:  # equal rows on both sides of the cut
        ranked = positional_index(d.where(same), [key], out="_idx")
        ahead = F.col("_idx") < beyond[1] - keep
        parts = (parts[0].unionByName(ranked.where(ahead).drop("_idx")),
                 d.where(after).unionByName(ranked.where(~ahead).drop("_idx")))
    return tuple(p.drop("_tie") for p in parts)
