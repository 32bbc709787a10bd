"""Operator 1, URL filters: rules first, then naive Bayes on segmented names.

Host labels and path parts are split into words by a unigram Viterbi
segmentation, with word counts taken from the pages' visible text.  Urls that
a rule decides train a multinomial naive Bayes model over those words, and
the model decides the rest.

Everything is joined and counted on distinct strings (url skeletons without
digits, then distinct names), so a host with a third of all pages is one row
until its verdict is joined back.  Lexicon and model are tables, never
broadcast by hand.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.llm.common import lower_az, written

#: Longest lexicon word; longer runs of letters are split.
MAX_WORD = 24
#: Long names are cut into pieces of this many letters (and MAX_WORD - 1 more)
#: before their substrings are taken, as a substring costs its position.
PIECE = 512


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both '' for a null url or one
    without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_az(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits the host or one of
    its parent domains and begins the path, as a struct of ``rule`` and
    ``verdict``; null if none fits.  Of two equally long, `block` wins."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        s = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, s) if out is None else out.when(fits, s)
    empty = F.lit(None).cast("struct<rule:string,verdict:string>")
    return empty if out is None else out.otherwise(empty)


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Unigram counts ``(word, n)`` of the visible text's a-z words."""
    visible = F.regexp_replace(F.coalesce(F.col(html), F.lit("")),
                               r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&[a-z]+;", " ")
    words = F.split(F.lower(visible), "[^a-z]+")
    return (pages.select(F.explode(words).alias("word"))
            .where((F.col("word") != "") & (F.length("word") <= MAX_WORD))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def viterbi(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split of ``name`` into words.  A string that is no
    lexicon word counts as one word of probability 10 / (total * 10**length)."""
    log_total = math.log(max(total, 1) + 1)
    best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for begin in range(max(0, end - MAX_WORD), end):
            word = name[begin:end]
            n = counts.get(word)
            p = best[begin] + (math.log(n) if n else math.log(10) * (1 - len(word))) - log_total
            if p > best[end]:
                best[end], back[end] = p, begin
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _segment(names: pd.Series, found: pd.Series, totals: pd.Series) -> pd.Series:
    return pd.Series([viterbi(n, {f["word"]: f["n"] for f in fs}, t)
                      for n, fs, t in zip(names, found, totals)])


def _digest(c: str) -> Column:
    """32 bytes that stand for a string of any length in rows made from it."""
    return F.unhex(F.sha2(F.col(c), 256))


def segment(names: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Distinct ``names (name)`` of a-z letters to ``(name, words)``.

    Each name's substrings are joined with the lexicon, so a task only sees
    the words its own names can contain."""
    names = names.withColumn("_id", _digest("name"))
    n = F.length("name")
    pieces = names.select("_id", F.explode(F.transform(F.sequence(F.lit(1), n, F.lit(PIECE)), lambda at: F.struct(
        F.substring("name", at, F.lit(PIECE + MAX_WORD - 1)).alias("s"),
        F.least(F.lit(PIECE), n - at + 1).alias("begins")))).alias("_p")).select("_id", "_p.*")
    cut = pieces.select("_id", "s", F.explode(F.sequence(F.lit(1), F.col("begins"))).alias("_i")).select(
        "_id", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("s") - F.col("_i") + 1)),
                                     lambda k: F.substring("s", F.col("_i"), k))).alias("word"))
    found = cut.distinct().join(lexicon, "word").groupBy("_id").agg(
        F.collect_list(F.struct("word", "n")).alias("found"))
    total = lexicon.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    return names.join(found, "_id", "left").withColumn("total", total).select("name", _segment(
        "name", F.coalesce("found", F.array().cast("array<struct<word:string,n:bigint>>")), "total").alias("words"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url: str = "url",
                html: str = "html", alpha: float = 1.0) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``,
    ``rule``, ``verdict``, ``score`` (log odds of `block` under the model) and
    ``words`` (the segmented name, space-separated).

    The verdict is the longest fitting rule's, else `block` where the score is
    above 0, else `allow`.  The model learns from every url that a rule
    decides; without any, or with one class only, its score follows the class
    prior alone.  Null urls and urls without ``://`` have empty host and path
    and the words of none.  Null ids, repeated rows and ties are judged alike;
    null html adds no words.  Very long pages and urls are read whole; a
    url's tokens and a name's substrings carry a digest of fixed size, so
    memory grows with one url's length (tested at 200,000 characters).  An
    empty table gives an empty result.  Other columns are not carried.
    """
    host, path = url_parts(F.col(url))
    p = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    p = p.withColumn("_r", rule_for(F.col("host"), F.col("path"), rules))
    mask = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "0")
    p = p.withColumn("_mask", F.concat(mask(F.col("host")), F.lit(" "), mask(F.col("path"))))

    keys = written(p.groupBy("_mask").agg(
        F.sum((F.col("_r.verdict") == "block").cast("long")).alias("_block"),
        F.sum((F.col("_r.verdict") == "allow").cast("long")).alias("_allow")).withColumn(
        "_key", _digest("_mask")), "url-keys")
    part = lambda c, kind: F.transform(
        F.filter(F.split(c, "[^\\p{L}0-9]+"), lambda x: x != ""),
        lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))
    at = F.instr("_mask", " ")
    tokens = keys.select("_key", "_block", "_allow", F.explode(F.concat(
        part(F.substring(F.col("_mask"), F.lit(1), at - 1), "host"),
        part(F.substring(F.col("_mask"), at + 1, F.length("_mask")), "path"))).alias("_t")).select(
        "_key", "_block", "_allow", "_t.kind", "_t.name")
    names = tokens.where(F.col("name").rlike("^[a-z]{2,}$")).select("name").distinct()
    split = written(segment(names, word_counts(pages, html)), "url-names")
    tokens = written(tokens.join(split, "name", "left").withColumn("words", F.coalesce("words", F.array("name"))),
                     "url-tokens")

    counts = tokens.groupBy("kind", "name").agg(F.sum("_block").alias("b"), F.sum("_allow").alias("a"),
                                               F.first("words").alias("words"))
    features = counts.select("kind", F.explode("words").alias("word"), "b", "a").groupBy("kind", "word").agg(
        F.sum("b").alias("b"), F.sum("a").alias("a")).where(F.col("a") + F.col("b") > 0)
    sums = features.agg(F.struct(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("v"))).scalar()
    model = features.withColumn("_n", sums).select(
        "kind", "word", (F.log((F.col("b") + alpha) / (F.col("_n.b") + alpha * F.col("_n.v")))
                         - F.log((F.col("a") + alpha) / (F.col("_n.a") + alpha * F.col("_n.v")))).alias("llr"))
    prior = keys.agg(F.log((F.coalesce(F.sum("_block"), F.lit(0)) + alpha)
                           / (F.coalesce(F.sum("_allow"), F.lit(0)) + alpha))).scalar()
    by_name = counts.select("kind", "name", F.posexplode("words").alias("_i", "word")).join(
        model, ["kind", "word"], "left").groupBy("kind", "name").agg(F.sum(F.coalesce("llr", F.lit(0.0))).alias("s"))
    scored = tokens.select("_key", "kind", "name", F.array_join("words", " ").alias("_w")).join(
        by_name, ["kind", "name"]).groupBy("_key").agg(
        F.sum("s").alias("_s"), F.array_join(F.array_sort(F.collect_set("_w")), " ").alias("words"))
    out = p.withColumn("_key", _digest("_mask")).join(scored, "_key", "left").withColumn("score", F.coalesce("_s", F.lit(0.0)) + prior)
    learned = F.when(F.col("score") > 0, "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                      F.coalesce(F.col("_r.verdict"), learned).alias("verdict"), "score",
                      F.coalesce("words", F.lit("")).alias("words"))
