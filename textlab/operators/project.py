"""Projections and rule-based columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PathRules:
    """What model paths mean in a deployment."""

    family_token: str        # in paths of the family whose names keep their slashes
    family_tokenizer: str    # ... and its tokenizer
    local_tokenizer: str     # tokenizer of other models at a backslash path
    converted_suffix: str    # removed from model names
    own_token: str           # in paths of own models
    own_root: str            # output root of own models
    other_root: str          # ... and of all others


def choose_label(df: DataFrame, granularity: str, coarse_col: str = "coarse-grained",
                 fine_col: str = "fine-grained", text_col: str = "text") -> DataFrame:
    """B1 + B2: ``(sentence, label)`` with the label column chosen by
    granularity (``coarse`` -> coarse column, anything else -> fine)."""
    chosen = coarse_col if granularity == "coarse" else fine_col
    return df.select(F.col(text_col).alias("sentence"), F.col(chosen).alias("label"))


def _last_segment(path: Column, sep: str) -> Column:
    return F.element_at(F.split(path, sep.replace("\\", "\\\\"), -1), -1)


def resolve_models(df: DataFrame, rules: PathRules, path_col: str = "path") -> DataFrame:
    """From a model path derive ``model_name`` (last segment after
    ``\\`` -- or after ``/`` when there is no backslash and the family token
    is absent -- with the converted suffix removed), ``tokenizer`` (ordered
    rule: family token, backslash path, slash path, else the path itself)
    and ``output_root`` (own models vs others)."""
    p = F.col(path_col)
    has_family = p.contains(rules.family_token)
    has_bs = p.contains("\\")
    has_fs = p.contains("/")
    name = (F.when(has_family | has_bs, _last_segment(p, "\\"))
            .when(has_fs, _last_segment(p, "/"))
            .otherwise(p))
    name = F.replace(name, F.lit(rules.converted_suffix), F.lit(""))
    tok = (F.when(has_family, F.lit(rules.family_tokenizer))
           .when(has_bs, F.lit(rules.local_tokenizer))
           .otherwise(p))
    root = F.when(p.contains(rules.own_token), F.lit(rules.own_root)).otherwise(
        F.lit(rules.other_root))
    return df.select("*", name.alias("model_name"), tok.alias("tokenizer"),
                     root.alias("output_root"))


def attach_by_key(df: DataFrame, other: DataFrame, key: str,
                  cols: Sequence[str]) -> DataFrame:
    """Attach columns by an explicit key (never by row position)."""
    return df.join(other.select(key, *cols), key, "left")
