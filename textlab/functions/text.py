"""String column expressions shared by the operators (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# Whitespace as Python's str.isspace() defines it: \t \n \x0b \x0c \r,
# the separators \x1c-\x1f, space, \x85 and every Unicode separator (Z*).
WS_CLASS = r"\t\n\x0B\f\r\x1C-\x1F \x85\p{Z}"
# Word characters as Python's str regex \w sees them for our purposes.
WORD_CLASS = r"\p{L}\p{N}_"
# Token pattern: a run of word characters, a run of whitespace, or any other
# single character.  The three alternatives cover every character.
TOKEN_PATTERN = f"[{WORD_CLASS}]+|[{WS_CLASS}]+|[^{WORD_CLASS}{WS_CLASS}]"
# The English articles the SQuAD normaliser removes.
ARTICLES = ("a", "an", "the")
# ASCII punctuation (Python's string.punctuation), as a regex class.
ASCII_PUNCT_CLASS = r"[!-/:-@\[-`{-~]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_left(c) -> Column:
    """Remove leading whitespace in the str.lstrip() sense (``ltrim``
    only removes spaces)."""
    return F.regexp_replace(_c(c), f"^[{WS_CLASS}]+", "")


def capitalize(c) -> Column:
    """First character upper case, the rest lower case (not initcap)."""
    x = _c(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def words(c) -> Column:
    """Word tokens of a text (runs of word characters)."""
    return F.regexp_extract_all(_c(c), F.lit(f"[{WORD_CLASS}]+"), 0)


def raw_tokens(c) -> Column:
    """All tokens (words, whitespace runs, single other characters) in text
    order; their concatenation is the text."""
    return F.regexp_extract_all(_c(c), F.lit(TOKEN_PATTERN), 0)


def split_ws(c) -> Column:
    """Python ``str.split()``: split on whitespace runs, drop empties."""
    return F.filter(F.split(_c(c), f"[{WS_CLASS}]+"), lambda t: t != F.lit(""))


def normalize_answer(c) -> Column:
    """H1 (SQuAD v1.1 normaliser): lower case, drop ASCII punctuation, drop
    the words a/an/the, collapse whitespace.

    The article rule uses Unicode word boundaries written as look-arounds, so
    a letter such as 'ß' counts as part of a word (``er aß`` keeps ``aß``).
    """
    x = F.lower(_c(c))
    x = F.regexp_replace(x, ASCII_PUNCT_CLASS, "")
    arts = "|".join(ARTICLES)
    x = F.regexp_replace(x, f"(?<![{WORD_CLASS}])(?:{arts})(?![{WORD_CLASS}])", " ")
    return F.array_join(split_ws(x), " ")


def multiset_overlap(a, b) -> Column:
    """H3: size of the multiset intersection of two string arrays
    (``array_intersect`` would use set semantics)."""
    a, b = _c(a), _c(b)
    return F.aggregate(
        F.array_distinct(a), F.lit(0),
        lambda acc, t: acc + F.least(F.size(F.filter(a, lambda x: x == t)),
                                     F.size(F.filter(b, lambda x: x == t))))
