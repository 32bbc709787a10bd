"""Operator 11, conversation prefix trie by composable fingerprints.

A turn is an element of a monoid: K residues t of its SHA-256, and a
sequence of turns has the product sum(t_i * B^i) mod P for K multipliers B.
Products compose, product(a + b) = product(a) + B^len(a) * product(b), so
the prefixes of a rebuilt conversation (another conversation's head, then
its own suffix) come from prefix products of the *stored* conversations
alone; no rebuilt turn list is ever made.  The members of a head are counted
once for all conversations that share it.

Prefixes of equal depth and product form a node.  Each group is verified: all
its members must have the same parent node and refer to the same stored turn
(by the half of its SHA-256 that the products don't use).  If any group is
not pure, other multipliers are drawn.

Sums over subtrees follow chains: every node belongs to its member of least
priority (a fixed permutation of the ids), the nodes of a conversation form
a path, and the number of chain changes towards the root is logarithmic in
expectation.  Totals climb from chain to chain by joins, and a running sum
along each chain finishes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from textlab.llm.common import written
from textlab.operators.positions import OrderedCells

K, PRIME = 4, (1 << 31) - 1
#: Rows of a block of a chain, and ids of a piece of a list of ends.
BLOCK, PIECE = 4096, 256


def multipliers(draw: int, modulus: int) -> list[int]:
    """The K multipliers of one draw."""
    return [2 + int.from_bytes(hashlib.sha256(f"{draw}:{k}".encode()).digest()[:8], "big") % (modulus - 2) for k in range(K)]


def _powers(bases: list[int], modulus: int):
    @F.pandas_udf("array<long>")
    def powers(exponent: pd.Series) -> pd.Series:
        """B^exponent mod P for each multiplier, by repeated squaring."""
        e, out = exponent.to_numpy(np.int64), np.ones((len(exponent), K), np.int64)
        square, left = np.array(bases, np.int64), e.copy()
        while left.any():
            odd = (left & 1).astype(bool)
            out[odd] = out[odd] * square % modulus
            square, left = square * square % modulus, left >> 1
        return pd.Series(list(out))
    return powers


def _priority(c: Column) -> Column:
    """A fixed permutation of 64-bit ids (xor-shifts are invertible)."""
    x = c.bitwiseXOR(F.lit(0x2545F4914F6CDD1D))
    for _ in range(2):
        x = x.bitwiseXOR(F.shiftleft(x, 13))
        x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
        x = x.bitwiseXOR(F.shiftleft(x, 17))
    return x


def _key(parts: list[Column], a: str, b: str) -> list[Column]:
    """K residues as two longs."""
    return [F.shiftleft(parts[0], 31).bitwiseOR(parts[1]).alias(a), F.shiftleft(parts[2], 31).bitwiseOR(parts[3]).alias(b)]


def _stored_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str, modulus: int) -> DataFrame:
    """Narrow rows: conversation, turn, residues, reference, code points."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    d = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), F.length(t).cast("long").alias("points"),
        F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256).alias("_h"))
    part = lambda at, n: F.conv(F.substring("_h", at, n), 16, 10).cast("long")
    return d.select("c", "turn", "points", part(33, 15).alias("r0"), part(48, 15).alias("r1"),
                    *[(part(1 + 8 * k, 8) % modulus).alias(f"t{k}") for k in range(K)])


def _prefix_products(stored: DataFrame, cells: OrderedCells, powers, modulus: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their place ``lp`` and product ``f`` (before the turn: ``e``)
    inside their (conversation, cell) piece; and the pieces with the length
    ``ol`` and product ``o`` of the pieces before, and the power ``w`` by
    which a piece's own product is multiplied."""
    order = W.partitionBy("_cell", "c").orderBy("turn", "r0", "r1")
    d = cells.assign().drop("_before").withColumn("lp", (F.row_number().over(order) - 1).cast("long"))
    d = d.withColumn("_p", powers("lp"))
    d = d.select("*", *[(F.col(f"t{k}") * F.col("_p")[k] % modulus).alias(f"m{k}") for k in range(K)])
    run = W.partitionBy("_cell", "c").orderBy("lp").rowsBetween(W.unboundedPreceding, W.currentRow)
    d = d.select("*", *[F.sum(f"m{k}").over(run).alias(f"_f{k}") for k in range(K)])
    rows = written(d.select("c", "_cell", "lp", "points", "r0", "r1", *[(F.col(f"_f{k}") % modulus).alias(f"f{k}") for k in range(K)],
                            *[((F.col(f"_f{k}") - F.col(f"m{k}")) % modulus).alias(f"e{k}") for k in range(K)]), "prefix-products")
    own = [F.sum(F.pmod(F.col(f"f{k}") - F.col(f"e{k}"), F.lit(modulus))) % modulus for k in range(K)]
    pieces = rows.groupBy("c", "_cell").agg(F.count(F.lit(1)).alias("n"), *[s.alias(f"s{k}") for k, s in enumerate(own)])
    before = W.partitionBy("c").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("ol", F.coalesce(F.sum("n").over(before), F.lit(0)))
    pieces = pieces.withColumn("n_own", F.sum("n").over(W.partitionBy("c"))).withColumn("w", powers("ol"))
    pieces = pieces.select("c", "_cell", "ol", "n_own", "w", *[
        F.coalesce(F.sum(F.col(f"s{k}") * F.col("w")[k] % modulus).over(before) % modulus, F.lit(0)).alias(f"o{k}")
        for k in range(K)])
    return rows, written(pieces, "pieces")


def _at(name: str, k: int, modulus: int) -> Column:
    """A stored prefix product: the pieces before, then this piece's own."""
    return (F.col(f"o{k}") + F.col("w")[k] * F.col(f"{name}{k}")) % modulus


def _conversations(rows: DataFrame, pieces: DataFrame, base: Callable, head: Callable, max_head: int,
                   modulus: int) -> tuple[DataFrame, DataFrame]:
    """``heads``: of each conversation the first turns that others may borrow
    (array ``pre``); and one row per conversation: head length ``h``, borrowed
    turns ``hh``, the products of the borrowed (``b``) and skipped turns (``s``)."""
    first = rows.where(F.col("lp") < max_head).join(pieces, ["c", "_cell"]).withColumn("j", F.col("lp") + F.col("ol")).where(
        F.col("j") < max_head)
    first = first.groupBy("c").agg(F.sort_array(F.collect_list(F.struct(  # at most max_head turns
        "j", "points", "r0", "r1", *[_at("f", k, modulus).alias(f"f{k}") for k in range(K)]))).alias("pre"))
    first = written(first, "first-turns")
    convs = pieces.groupBy("c").agg(F.first("n_own").alias("n_own")).join(first, "c")
    convs = convs.withColumn("h", head(F.col("c")).cast("long")).withColumn("base", base(F.col("c")).cast("long"))
    heads = first.select(F.col("c").alias("base"), F.col("pre").alias("hpre")).join(
        convs.select("base").distinct(), "base", "left_semi")
    convs = convs.join(heads, "base", "left").withColumn(
        "hh", F.least("h", F.coalesce(F.size("hpre"), F.lit(0)).cast("long")))
    prefix = lambda arr, n, k: F.when(n > 0, F.get(arr, (n - 1).cast("int"))[f"f{k}"]).otherwise(F.lit(0))
    convs = convs.select("c", "base", "h", "hh", "n_own", *[prefix(F.col("hpre"), F.col("hh"), k).alias(f"b{k}") for k in range(K)],
                         *[prefix(F.col("pre"), F.least("h", "n_own"), k).alias(f"s{k}") for k in range(K)])
    return heads, written(convs, "conversations")


def _members(rows, pieces, heads, convs, bases: list[int], modulus: int, max_head: int) -> tuple[DataFrame, DataFrame]:
    """Rows (depth, product, parent's product, reference, n members, least
    member and priority): one per own turn, one per borrowed head turn; and
    the ends (depth, product, c)."""
    # B^(hh - h): the own suffix moves by the turns that the head has less
    shift = [F.array(*[F.lit(pow(pow(b, -1, modulus), i, modulus)) for i in range(max_head + 1)]) for b in bases]
    d = rows.join(pieces.join(convs.drop("n_own"), "c"), ["c", "_cell"]).withColumn("j", F.col("lp") + F.col("ol"))
    d = d.where(F.col("j") >= F.col("h"))

    def rebuilt(name: str) -> list[Column]:
        moved = lambda k: shift[k][(F.col("h") - F.col("hh")).cast("int")]
        return [(F.col(f"b{k}") + moved(k) * F.pmod(_at(name, k, modulus) - F.col(f"s{k}"), F.lit(modulus))) % modulus
                for k in range(K)]

    own = d.select((F.col("hh") + F.col("j") - F.col("h") + 1).alias("depth"), *_key(rebuilt("f"), "fa", "fb"),
                   *_key(rebuilt("e"), "pa", "pb"), "r0", "r1", "points", F.lit(1).cast("long").alias("n"), "c",
                   _priority(F.col("c")).alias("owner"), F.col("c").alias("tc"), F.col("j").alias("tp"),
                   (F.col("j") == F.col("n_own") - 1).alias("_end"))
    zero = F.lit(0).cast("long")
    shared = convs.where(F.col("hh") > 0).groupBy("base", "hh").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("c"), F.min(_priority(F.col("c"))).alias("owner"))
    shared = shared.join(heads, "base").select("base", "n", "c", "owner", "hpre", F.posexplode(
        F.slice("hpre", 1, F.col("hh").cast("int"))).alias("i", "x"))
    here = [F.col("x")[f"f{k}"] for k in range(K)]
    above = [F.when(F.col("i") > 0, F.get("hpre", F.col("i") - 1)[f"f{k}"]).otherwise(zero) for k in range(K)]
    shared = shared.select((F.col("i") + 1).cast("long").alias("depth"), *_key(here, "fa", "fb"), *_key(above, "pa", "pb"),
                           "x.r0", "x.r1", "x.points", "n", "c", "owner", F.col("base").alias("tc"),
                           F.col("x.j").alias("tp"), F.lit(False).alias("_end"))
    short = convs.where(F.col("n_own") <= F.col("h")).select(
        F.col("hh").alias("depth"), *_key([F.col(f"b{k}") for k in range(K)], "fa", "fb"), "c")
    return own.unionByName(shared), own.where("_end").select("depth", "fa", "fb", "c").unionByName(short)


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (depth, fa, fb, c) to pieces: up to PIECE ids of a node, joined."""
    key, ids, key_cols = None, [], ["depth", "fa", "fb"]

    def piece():
        return (*key, ids[0], ",".join(map(str, ids)))

    for b in batches:
        out = []
        for *k, c in b[[*key_cols, "c"]].itertuples(index=False, name=None):
            if k != key or len(ids) == PIECE:
                if ids:
                    out.append(piece())
                key, ids = k, []
            ids.append(c)
        yield pd.DataFrame(out, columns=[*key_cols, "first", "ids"])
    if ids:
        yield pd.DataFrame([piece()], columns=[*key_cols, "first", "ids"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted pieces to one SHA-256 per node, fed piece by piece."""
    key, state, cols = None, None, ["depth", "fa", "fb", "ends_sha256"]
    for b in batches:
        out = []
        for *k, ids in b[["depth", "fa", "fb", "ids"]].itertuples(index=False, name=None):
            if k == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(out, columns=cols)
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=cols)


def _end_digests(ends: DataFrame) -> DataFrame:
    """One SHA-256 per node with ends.  Ids are sorted by ranges of (node,
    id), so a node with very many is dealt over tasks; what meets in one task
    is a node's joined pieces, which are hashed as a stream."""
    node, n = ["depth", "fa", "fb"], int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.repartitionByRange(n, *node, "c").sortWithinPartitions(*node, "c").mapInPandas(
        _joined, "depth long, fa long, fb long, first long, ids string")
    return pieces.repartition(n, *node).sortWithinPartitions(*node, "first").mapInPandas(
        _hashed, "depth long, fa long, fb long, ends_sha256 string")


def _climb(chains: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """(owner, weight, leaf) totals of each chain with all chains that hang
    from it, directly or not.  A round moves what came last one chain up."""
    up = chains.select("owner", "p_owner").where(F.col("p_owner").isNotNull())
    moved = chains.select("owner", "weight", "leaf")
    parts = [moved]
    for _ in range(max_rounds):
        moved = written(moved.join(up, "owner").groupBy(F.col("p_owner").alias("owner")).agg(
            F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf")), "climb")
        if moved.isEmpty():
            break
        parts.append(moved)
    else:
        raise RuntimeError(f"chains did not end in {max_rounds} rounds")
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    return total.groupBy("owner").agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """Adds ``saved_tokens`` and ``n_leaves``: sums of ``weight`` and ``leaf``
    over each node's subtree."""
    hung = nodes.where(F.col("p_owner") != F.col("owner")).select("owner", "p_owner", (F.col("depth") - 1).alias("p_depth"))
    own = nodes.groupBy("owner").agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))
    chains = written(own.join(hung, "owner", "left"), "chains")
    totals = _climb(chains).join(chains.select("owner", "p_owner", "p_depth").where(F.col("p_owner").isNotNull()), "owner")
    here = totals.groupBy(F.col("p_owner").alias("owner"), F.col("p_depth").alias("depth")).agg(
        F.sum("weight").alias("_w"), F.sum("leaf").alias("_l"))
    d = nodes.join(here, ["owner", "depth"], "left").withColumns({
        "_w": F.col("weight") + F.coalesce("_w", F.lit(0)), "_l": F.col("leaf") + F.coalesce("_l", F.lit(0)),
        "_blk": F.floor(F.col("depth") / BLOCK)})
    # a running sum from a chain's end, block by block
    deeper = W.partitionBy("owner").orderBy(F.col("_blk").desc()).rowsBetween(W.unboundedPreceding, -1)
    blocks = d.groupBy("owner", "_blk").agg(F.sum("_w").alias("_bw"), F.sum("_l").alias("_bl"))
    blocks = blocks.select("owner", "_blk", F.coalesce(F.sum("_bw").over(deeper), F.lit(0)).alias("_bw"),
                           F.coalesce(F.sum("_bl").over(deeper), F.lit(0)).alias("_bl"))
    run = W.partitionBy("owner", "_blk").orderBy(F.col("depth").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    d = d.withColumns({"_w": F.sum("_w").over(run), "_l": F.sum("_l").over(run)}).join(blocks, ["owner", "_blk"])
    return d.withColumns({"saved_tokens": F.col("_w") + F.col("_bw"), "n_leaves": F.col("_l") + F.col("_bl")})


def prefix_trie(turns: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], max_head: int,
                conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                modulus: int = PRIME, draws: int = 20) -> DataFrame:
    """The prefix trie of all rebuilt conversations: of conversation c, the
    first ``head(c)`` (0 to ``max_head``) stored turns of conversation
    ``base(c)``, then its own stored turns after its first ``head(c)``.

    One row per node, i.e. distinct sequence of first d rebuilt turns (role
    and text): ``conv_id`` (smallest member), ``depth`` d, ``parent_conv_id``
    (the parent's; null for the root), ``n_convs`` (members: rebuilt
    conversations that start with it), ``n_children``, ``n_leaves`` (childless
    nodes of its subtree, itself included), ``saved_tokens`` (over its
    subtree: (members - 1) x code points of the last text), ``ends_sha256``
    (of the members with just d turns: ids ascending, comma-joined), and the
    stored turn it ends with, ``turn_conv`` and ``turn_pos`` (null: root).

    Turns are ordered by ``turn``, null first, ties by the second half of the
    SHA-256 of role and text.  Null roles and texts count as empty; rows
    without a conversation id belong to none and are left out.  A repeated row
    is a turn of its own.  Very long texts are read once, for their hash and
    length.  A base that is absent lends nothing; a rebuilt conversation may
    be turnless and then ends at the root.  An empty table gives no rows.
    Other columns are not read.

    A conversation of any length is dealt over cells of its turns and a hot
    prefix is summed before it is shuffled.  Only counts reach the driver.
    """
    stored = written(_stored_turns(turns, conv, turn, role, text, modulus), "stored-turns")
    cells = OrderedCells(stored, ["c", "turn", "r0", "r1"])
    node = ["depth", "fa", "fb"]
    for draw in range(draws):
        bases = multipliers(draw, modulus)
        powers = _powers(bases, modulus)
        rows, pieces = _prefix_products(stored, cells, powers, modulus)
        heads, convs = _conversations(rows, pieces, base, head, max_head, modulus)
        members, ends = _members(rows, pieces, heads, convs, bases, modulus, max_head)
        same = [F.min(c) == F.max(c) for c in ("pa", "pb", "r0", "r1")]
        groups = members.groupBy(*node).agg(
            F.sum("n").alias("n_convs"), F.min(F.struct("c", "tc", "tp")).alias("_m"), F.min("owner").alias("owner"),
            F.max("points").alias("points"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
            (same[0] & same[1] & same[2] & same[3]).alias("pure"))
        groups = written(groups, "nodes")
        if groups.where(~F.col("pure")).isEmpty():
            break
    else:
        raise RuntimeError(f"equal products of different prefixes in each of {draws} draws")
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"),
                     F.min(_priority(F.col("c"))).alias("owner")).where(F.col("n_convs") > 0)
    root = root.select(*[zero.alias(x) for x in node], "n_convs", "conv_id", "owner", zero.alias("points"),
                       null.alias("pa"), null.alias("pb"), null.alias("turn_conv"), null.alias("turn_pos"))
    nodes = groups.select(*node, "n_convs", F.col("_m.c").alias("conv_id"), "owner", "points", "pa", "pb",
                          F.col("_m.tc").alias("turn_conv"), F.col("_m.tp").alias("turn_pos")).unionByName(root)
    children = nodes.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"),
                                                       F.col("pb").alias("fb")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"),
                           F.col("conv_id").alias("parent_conv_id"), F.col("owner").alias("p_owner"))
    nodes = nodes.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = nodes.join(parents, ["depth", "pa", "pb"], "left").withColumns({
        "weight": (F.col("n_convs") - 1) * F.col("points"), "leaf": (F.col("n_children") == 0).cast("long")})
    nodes = _subtree_sums(written(nodes, "trie"))
    nodes = nodes.join(_end_digests(ends), node, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        "ends_sha256", "turn_conv", "turn_pos")
