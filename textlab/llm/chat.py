"""Operator 8, chat formatting with typed content parts.  DataFrame functions
only.

A visitor walks each turn's content parts in order: text parts are escaped,
image, audio and document parts become numbered placeholders, and their
references and expanded token counts are recorded.  Turns are framed by
control strings, conversations joined in turn order, and the loss mask lists
the spans of assistant text.

Texts can't forge control strings: inside texts, ``~`` is written ``~t``, and
``~b`` is put behind every ``[`` and ``<``, with which all control strings
begin.  No character's writing depends on its neighbours, so neither one text
nor several parts or turns together can spell one.  The reader
(:func:`read_back`) takes frames apart and undoes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textlab.functions.arrays import evaluate_once

#: Control strings: begin and end of a frame, by role; any other role has its
#: name in the frame.
FRAMES = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")}
OTHER = ("[ROLE]", "[:]", "[/ROLE]")
BEGIN = "<s>"
#: Expanded tokens of an attachment: per image patch, second and page.
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 14, 25, 512

PART = ("struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("~"), F.lit("~t"))
    for c in "[<":
        out = F.replace(out, F.lit(c), F.lit(c + "~b"))
    return out


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~b"), F.lit("")), F.lit("~t"), F.lit("~"))


def text_part(text: Column) -> Column:
    """A content array of one text part (null text: empty)."""
    null = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), null.cast("string").alias("uri"),
        null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"),
        null.cast("int").alias("pages")))


def part_tokens(p: Column) -> Column:
    """Tokens that an attachment's placeholder stands for."""
    side = lambda c: F.ceil(F.coalesce(p[c], F.lit(0)) / PATCH)
    return (F.when(p["type"] == "image", side("width") * side("height"))
            .when(p["type"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * AUDIO_TOKENS))
            .when(p["type"] == "document", F.coalesce(p["pages"], F.lit(0)) * PAGE_TOKENS)
            .otherwise(0)).cast("long")


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 content: str = "content") -> DataFrame:
    """One row per turn: ``_conv``, ``_ord`` (order in the conversation),
    ``_role``, ``_body`` (flattened parts) and ``_att`` (its attachments:
    kind, reference, placeholder number, expanded tokens).

    Parts of unknown type count as text; null contents are empty; null parts
    are skipped.  Placeholder numbers run through the whole conversation.
    """
    kinds = ("image", "audio", "document")
    t = turns.select(
        F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.filter(F.coalesce(F.col(content), F.array().cast(f"array<{PART}>")),
                 lambda p: p.isNotNull()).alias("_parts"))
    by_turn = W.partitionBy("_conv").orderBy("_turn", "_role", "_parts")
    before = by_turn.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("_files", F.filter("_parts", lambda p: p["type"].isin(*kinds)))
    t = evaluate_once(t.withColumn("_ord", F.row_number().over(by_turn)).withColumn(
        "_base", F.coalesce(F.sum(F.size("_files")).over(before), F.lit(0))))
    parts = F.col("_parts")

    def visit(p: Column, i: Column) -> Column:
        n = F.col("_base") + F.size(F.filter(F.slice(parts, F.lit(1), i), lambda q: q["type"].isin(*kinds)))
        mark = F.concat(F.lit("["), F.upper(p["type"]), F.lit(" "), n.cast("string"), F.lit("]"))
        return F.when(p["type"].isin(*kinds), mark).otherwise(escape(F.coalesce(p["text"], F.lit(""))))

    return t.select(
        "_conv", "_ord", "_role", F.array_join(F.transform("_parts", visit), "").alias("_body"),
        F.transform("_files", lambda p, i: F.struct(
            (F.col("_base") + i).cast("long").alias("number"), p["type"].alias("kind"), p["uri"].alias("uri"),
            part_tokens(p).alias("tokens"))).alias("_att"))


def format_conversations(turns: DataFrame, **columns) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``
    (start and length in code points of each assistant text, as escaped),
    ``attachments`` and ``expanded_tokens``.

    Turns are ordered by turn number (then role and content; repeated rows
    all count).  A null conversation id is one conversation, null turns come
    first, null roles are ''.  Very long texts are formatted whole (a
    conversation's string and its turns must fit in a task's memory); an empty
    table gives no rows.  Each turn is formatted before turns meet; only
    one conversation's own frames are ever collected together, since they
    make one string.  Other columns are not carried.
    """
    t = format_turns(turns, **columns)
    known = F.col("_role")
    head = F.when(known == "system", FRAMES["system"][0]).when(known == "user", FRAMES["user"][0]).when(
        known == "assistant", FRAMES["assistant"][0]).otherwise(
        F.concat(F.lit(OTHER[0]), escape(known), F.lit(OTHER[1])))
    tail = F.when(known == "system", FRAMES["system"][1]).when(known == "user", FRAMES["user"][1]).when(
        known == "assistant", FRAMES["assistant"][1]).otherwise(F.lit(OTHER[2]))
    t = t.select("_conv", "_ord", "_role", "_att", head.alias("_head"), "_body", tail.alias("_tail"))
    t = t.withColumn("_frame", F.concat("_head", "_body", "_tail"))
    before = W.partitionBy("_conv").orderBy("_ord").rowsBetween(W.unboundedPreceding, -1)
    start = F.length(F.lit(BEGIN)) + F.coalesce(F.sum(F.length("_frame")).over(before), F.lit(0)) + F.length("_head")
    t = t.withColumn("_span", F.struct(start.cast("long").alias("start"), F.length("_body").cast("long").alias("length")))
    g = t.groupBy("_conv").agg(F.sort_array(F.collect_list(F.struct(
        "_ord", "_frame", (F.col("_role") == "assistant").alias("_loss"), "_span", "_att"))).alias("_t"))
    rows = F.col("_t")
    g = g.select(
        F.col("_conv").alias("conv_id"),
        F.concat(F.lit(BEGIN), F.array_join(F.transform(rows, lambda x: x["_frame"]), "")).alias("formatted"),
        F.transform(F.filter(rows, lambda x: x["_loss"]), lambda x: x["_span"]).alias("loss_spans"),
        F.flatten(F.transform(rows, lambda x: x["_att"])).alias("attachments"))
    return g.withColumn("expanded_tokens", F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """Takes formatted conversations apart: ``conv_id``, ``turns`` (role and
    unescaped text of each frame, from the string alone), ``loss_text`` (the
    unescaped text under the mask) and ``formatted``."""
    ends = [FRAMES["system"][1], FRAMES["user"][1], FRAMES["assistant"][1], OTHER[2]]
    lit = lambda s: s.replace("[", r"\[").replace("]", r"\]")
    split = "(?<=" + "|".join(map(lit, ends)) + ")"
    body = F.substring(F.col("formatted"), F.lit(len(BEGIN) + 1), F.length("formatted"))
    d = evaluate_once(formatted.withColumn("_f", F.filter(F.split(body, split), lambda x: x != "")))

    def inner(f: Column, frame: tuple[str, str]) -> Column:
        return F.substring(f, F.lit(len(frame[0]) + 1), F.length(f) - len(frame[0]) - len(frame[1]))

    def frame(f: Column) -> Column:
        out = None
        for r, fr in FRAMES.items():
            s = F.struct(F.lit(r).alias("role"), unescape(inner(f, fr)).alias("text"))
            out = F.when(f.startswith(fr[0]), s) if out is None else out.when(f.startswith(fr[0]), s)
        rest = inner(f, (OTHER[0], OTHER[2]))
        cut = F.instr(rest, OTHER[1])
        return out.otherwise(F.struct(
            unescape(F.substring(rest, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(rest, cut + len(OTHER[1]), F.length(rest))).alias("text")))

    return d.select(
        "conv_id", F.transform("_f", frame).alias("turns"),
        F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
            F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "").alias("loss_text"),
        "formatted")
