"""Operator 2, sharding by balanced label propagation.  DataFrame functions
only.

Documents that share a link key (here: equal texts) should land in one shard,
while shard sizes stay even.  Members of a group are alike, so propagation
works on the occupancy table (group, shard, members) instead of documents: a
group with a third of all rows is at most one row per shard.

Each round, the members of a group that sit elsewhere ask to move to the
shard that holds most of their neighbours and still takes rows.  Requests
between two shards are granted up to a quota: what is asked in the opposite
direction (a swap keeps both sizes) plus a share of the free places.  Quotas
are split over hash cells, so no shard's requests meet in one task.  The
documents without links fill the shards up at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textlab.llm.common import ranked, spread, written
from textlab.session import cut_lineage

CELLS = 32


def _target(shards: int, total: Column) -> Column:
    """Rows of shard ``_s`` under the law `rows`: counts at most one apart."""
    return F.floor(total / shards) + (F.col("_s") < total % shards).cast("long")


def _round(occ: DataFrame, load: DataFrame, shards: int) -> DataFrame:
    """One propagation round on ``occ (_g, _s, _n)``; ``load (_s, _room)``
    has each shard's free places.  Returns the new occupancy with ``_moved``,
    the number of members that changed place into that row."""
    everyone = W.partitionBy("_g")
    h = F.xxhash64("_g", "_s")
    o = occ.join(F.broadcast(load), "_s").withColumn("_h", h)  # at most one row per shard
    key = F.struct(F.col("_n").alias("n"), F.col("_h").alias("h"), F.col("_s").alias("s"))
    down = everyone.orderBy(F.col("_n").desc(), F.col("_h").desc()).rowsBetween(W.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(down), F.lit(0))
    o = o.withColumn("_all", F.sum("_n").over(everyone)).withColumn("_key", key)
    # the wish: the fullest place that can hold the whole group; else the fullest places that
    # can hold it together, filled in that order; else (no room anywhere) the fullest, by swaps
    o = o.select("*", F.max(F.when(F.col("_n") + F.col("_room") >= F.col("_all"), F.col("_key"))).over(everyone).alias("_one"),
                 F.max("_key").over(everyone).alias("_fullest"),
                 (before(F.col("_n") + F.col("_room")) < F.col("_all")).alias("_goal"))
    o = o.withColumn("_space", F.when(F.col("_goal"), F.col("_room")).otherwise(0)).withColumn(
        "_hi", before("_space") + F.col("_space"))
    o = o.select("*", F.collect_list(F.when(F.col("_space") > 0, F.struct(F.col("_hi").alias("hi"), F.col("_s").alias("s"))))
                 .over(everyone).alias("_goals"), before(F.when(F.col("_goal"), F.lit(0)).otherwise(F.col("_n"))).alias("_ahead"))
    ahead = F.col("_ahead")
    several = F.array_min(F.filter("_goals", lambda t: t["hi"] > ahead))["s"]
    to = (F.when(F.col("_one").isNotNull(), F.col("_one.s"))
          .when(F.size("_goals") > 0, F.when(~F.col("_goal"), several))
          .otherwise(F.col("_fullest.s")))
    ask = o.withColumn("_to", to).where(F.col("_to").isNotNull() & (F.col("_to") != F.col("_s"))).select(
        "_g", F.col("_s").alias("_from"), "_to", "_n")
    ask = ask.withColumn("_cell", spread(F.col("_g"), CELLS))

    # quotas from sums per pair of shards and cell (at most shards * shards * CELLS rows)
    cells = ask.groupBy("_from", "_to", "_cell").agg(F.sum("_n").alias("_asked"))
    pair = W.partitionBy("_a", "_b")
    both = cells.withColumn("_a", F.least("_from", "_to")).withColumn("_b", F.greatest("_from", "_to"))
    way = lambda up: F.sum(F.when((F.col("_from") < F.col("_to")) == F.lit(up), F.col("_asked")).otherwise(0)).over(pair)
    both = both.withColumn("_swap", F.least(way(True), way(False))).withColumn(
        "_all", F.sum("_asked").over(W.partitionBy("_from", "_to")))
    both = both.withColumn("_extra", F.col("_all") - F.col("_swap"))
    one = F.row_number().over(W.partitionBy("_from", "_to").orderBy("_cell")) == 1
    both = both.withColumn("_first", one)
    extra = F.when(F.col("_first"), F.col("_extra")).otherwise(0)
    up_to = W.partitionBy("_to").orderBy("_from", "_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    both = both.withColumn("_into", F.sum(extra).over(W.partitionBy("_to"))).withColumn(
        "_run", F.sum(extra).over(up_to)).join(
        F.broadcast(load.select(F.col("_s").alias("_to"), F.col("_room"))), "_to")
    # the free places in proportion to what is asked, whole numbers that add up
    part_of = lambda c: F.floor(F.col("_room") * c / F.greatest("_into", F.lit(1)))
    share = F.least(F.col("_extra"), part_of(F.col("_run")) - part_of(F.col("_run") - F.col("_extra")))
    both = both.withColumn("_quota", F.col("_swap") + share)
    run = W.partitionBy("_from", "_to").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    both = both.withColumn("_before", F.coalesce(F.sum("_asked").over(run), F.lit(0)))
    # the cell's part of the quota: the quota laid over the cells in order
    part = F.greatest(F.least(F.col("_asked"), F.col("_quota") - F.col("_before")), F.lit(0))
    quota = both.select("_from", "_to", "_cell", part.alias("_part"))

    line = W.partitionBy("_from", "_to", "_cell").orderBy(F.col("_n").desc(), "_g").rowsBetween(
        W.unboundedPreceding, -1)
    got = ask.join(quota, ["_from", "_to", "_cell"]).withColumn(
        "_ahead", F.coalesce(F.sum("_n").over(line), F.lit(0)))
    got = got.withColumn("_k", F.greatest(F.least(F.col("_n"), F.col("_part") - F.col("_ahead")), F.lit(0))).where(
        F.col("_k") > 0)
    zero = F.lit(0).cast("long")
    change = occ.select("_g", "_s", "_n", zero.alias("_moved")).unionByName(
        got.select("_g", F.col("_from").alias("_s"), (-F.col("_k")).alias("_n"), zero.alias("_moved"))).unionByName(
        got.select("_g", F.col("_to").alias("_s"), F.col("_k").alias("_n"), F.col("_k").alias("_moved")))
    return change.groupBy("_g", "_s").agg(F.sum("_n").alias("_n"), F.sum("_moved").alias("_moved")).where(
        F.col("_n") > 0)


def balanced_shards(docs: DataFrame, shards: int, link: Column, size: Column, carry: list[Column] = (),
                    id_col: str = "doc_id", max_rounds: int = 12) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, the ``carry``
    columns, ``shard`` and ``slot`` (gapless from 0 in each shard).

    Row counts of the shards are at most one apart.  Rows with an equal
    ``link`` value are neighbours; null links have none.  Null ids, repeated
    rows and ties are rows like any other; of very long texts only the link
    value and the size travel.  An empty table gives an empty
    result.  Columns of ``docs`` not named here are not carried.

    Propagation ends when no member moves, or after ``max_rounds``; the
    result is balanced after any number of rounds.
    """
    base = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
                       size.cast("long").alias("size"), *carry, link.alias("_g"))
    base = written(base, "shard-input")
    # a member's place in its group, and the group's size, without one task per group
    member = ranked(base.select("_row", "_g"), ["_g"], ["_row"], "_i", total="_members")
    member = written(member.withColumn("_linked", F.col("_g").isNotNull() & (F.col("_members") > 1)), "shard-members")
    total = base.agg(F.count(F.lit(1))).scalar()
    targets = cut_lineage(base.sparkSession.range(shards).select(F.col("id").cast("int").alias("_s")).select(
        "_s", _target(shards, total).cast("long").alias("_target")))

    # the start: group members dealt out evenly over all shards
    groups = member.where("_linked").groupBy("_g").agg(F.first("_members").alias("_members"))
    groups = ranked(groups, [], ["_g"], "_at", weight="_members")
    deal = F.explode(F.sequence(F.lit(0), F.least(F.col("_members"), F.lit(shards)).cast("int") - 1))
    occ = groups.select("_g", "_members", "_at", deal.alias("_d")).select(
        "_g", F.pmod(F.col("_at") + F.col("_d"), F.lit(shards)).cast("int").alias("_s"),
        (F.floor(F.col("_members") / shards) + (F.col("_d") < F.col("_members") % shards).cast("long")).alias("_n"))
    occ = cut_lineage(occ.select("_g", "_s", F.col("_n").cast("long").alias("_n")))

    def room() -> DataFrame:
        used = occ.groupBy("_s").agg(F.sum("_n").alias("_used"))
        return targets.join(used, "_s", "left").select(
            "_s", (F.col("_target") - F.coalesce("_used", F.lit(0))).alias("_room"))

    for _ in range(max_rounds):
        new = cut_lineage(_round(occ, room(), shards))
        moved = new.agg(F.sum("_moved")).first()[0]
        occ = new.select("_g", "_s", "_n")
        if not moved:
            break

    # members take the intervals of their group, other rows fill the free places
    run = W.partitionBy("_g").orderBy("_s").rowsBetween(W.unboundedPreceding, W.currentRow)
    cuts = occ.withColumn("_hi", F.sum("_n").over(run)).groupBy("_g").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_hi").alias("hi"), F.col("_s").alias("s")))).alias("_cuts"))
    first = lambda cuts, i: F.element_at(F.filter(cuts, lambda c: i < c["hi"]), 1)["s"]
    linked = member.where("_linked").join(cuts, "_g").select("_row", first(F.col("_cuts"), F.col("_i")).alias("shard"))
    fill = W.orderBy("_s").rowsBetween(W.unboundedPreceding, W.currentRow)  # one row per shard
    free = room().withColumn("_hi", F.sum("_room").over(fill)).agg(F.sort_array(F.collect_list(
        F.struct(F.col("_hi").alias("hi"), F.col("_s").alias("s")))).alias("_cuts"))
    single = ranked(member.where(~F.col("_linked")).select("_row"), [], ["_row"], "_i")
    single = single.withColumn("_cuts", free.scalar()).select("_row", first(F.col("_cuts"), F.col("_i")).alias("shard"))
    placed = written(linked.unionByName(single), "shard-places")
    out = ranked(base.drop("_g").join(placed, "_row"), ["shard"], ["_row"], "slot")
    return out.drop("_row")
