"""QA scoring and post-processing.

Per window everything is array work on one row (top-k, candidate pairs,
validity filter, best candidate), so windows never meet before the single
``groupBy(example_id)`` that keeps the best candidate per example.  That
aggregate is a ``max(struct)`` with partial aggregation: an example with very
many windows (a hot key) costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.functions.arrays import evaluate_once, with_top_k
from textlab.functions.text import WORD_CLASS


def overlap_logits(w: DataFrame, seeds: Sequence[int] | None = None) -> DataFrame:
    """F3 default scorer (no model needed): question/context word overlap.

    For context token j of the window, m_j = 1 when its lower-cased text is
    a question word.  start = 4 m_j + 2 m_{j+1} + [word] + 0.5 ((j+seed) mod 3),
    end = 4 m_j + 2 m_{j-1} + [word] + 0.5 ((j+2 seed) mod 3); the CLS
    position scores 0 and the question / separator positions -1.

    With ``seeds`` the windows are expanded to one row per seed (a literal
    list, narrow explode) after the seed-independent arrays are built.
    """
    word_re = f"^[{WORD_CLASS}]+$"
    w = evaluate_once(w.withColumn("_qw", F.array_distinct(F.transform(
        F.filter("q_tok.tok", lambda t: t.rlike(word_re)), lambda t: F.lower(t)))))
    w = w.withColumn("_m", F.transform(
        "ctx_tok", lambda t: F.when(F.array_contains(F.col("_qw"), F.lower(t)), 1).otherwise(0)))
    w = evaluate_once(w.withColumn("_wd", F.transform(
        "ctx_tok", lambda t: F.when(t.rlike(word_re), 1).otherwise(0)))
        .drop("_qw"))

    def base(i, kind):
        j = i - F.col("ctx_lo")
        m = F.get(F.col("_m"), j)
        wd = F.get(F.col("_wd"), j)
        nb = F.get(F.col("_m"), j + 1 if kind == "start" else j - 1)
        ctx = (4 * m + 2 * F.coalesce(nb, F.lit(0)) + wd).cast("double")
        # never null: arrays without nulls are sorted as plain numbers
        return F.coalesce(F.when((i >= F.col("ctx_lo")) & (i <= F.col("ctx_hi")), ctx)
                          .when(i == 0, F.lit(0.0)).otherwise(F.lit(-1.0)), F.lit(-1.0))

    pos = F.sequence(F.lit(0), F.col("seq_len") - 1)
    # seed-independent part, once per window (then a barrier so the seed
    # step below references it instead of recomputing it per seed)
    w = evaluate_once(w.withColumn("_bs", F.transform(pos, lambda i: base(i, "start")))
                      .withColumn("_be", F.transform(pos, lambda i: base(i, "end")))
                      .drop("_qw", "_m", "_wd"))
    if seeds is not None:
        w = w.withColumn("seed", F.explode(F.array(*[F.lit(int(x)) for x in seeds])))
        seed = F.col("seed")
    else:
        seed = F.lit(0)

    def jitter(b, mult):
        """``b`` plus 0.5 ((j + mult seed) mod 3) on the context: the three
        values in turn from the seed's place on, nothing outside."""
        lo, n = F.col("ctx_lo"), F.col("ctx_hi") - F.col("ctx_lo") + 1
        turns = F.flatten(F.array_repeat(F.array(F.lit(0.0), F.lit(0.5), F.lit(1.0)), (F.col("seq_len") / 3 + 2).cast("int")))
        at = F.slice(turns, (F.lit(mult) * (seed % 3)) % 3 + 1, n)
        none = lambda k: F.array_repeat(F.lit(0.0), k)
        return F.zip_with(b, F.concat(none(lo), at, none(F.col("seq_len") - lo - n)), lambda x, y: F.coalesce(x + y, F.lit(0.0)))

    def direct(b, mult):
        """The same for a negative seed, whose remainders have its sign."""
        j = lambda i: i - F.col("ctx_lo")
        inside = lambda i: (i >= F.col("ctx_lo")) & (i <= F.col("ctx_hi"))
        return F.transform(b, lambda x, i: F.when(inside(i), x + ((j(i) + mult * seed) % 3) * 0.5).otherwise(x))

    step = direct if any(x < 0 for x in seeds or ()) else jitter
    return (w.withColumn("start_logits", step("_bs", 1))
            .withColumn("end_logits", step("_be", 2))
            .drop("_bs", "_be"))


def window_best(w: DataFrame, n_best: int = 20, max_answer_tokens: int = 30,
                cls_index: int = 0, keys: Sequence[str] = (), order_col: str | None = None) -> DataFrame:
    """G2-G5 per window: top-``n_best`` starts and ends (lower index first
    on equal logits), the validity rules (both offsets in the context,
    ``end >= start``, at most ``max_answer_tokens`` tokens) and the best
    pair as ``cand = struct(score, -order, -window_idx, -start_rank,
    -end_rank, st, en)`` -- the struct order is the tie order of a stable
    descending sort over (example order, window, start rank, end rank);
    ``order_col`` numbers the examples of a repeated id.  Also G8's per-window
    null score.

    Instead of materialising all ``n_best^2`` pairs: for a fixed start the
    first qualifying end in rank order has the highest end logit and, among
    equal ones, the lowest rank, so it is that start's best pair; the
    window's best is the maximum over the (at most ``n_best``) starts.
    """
    sl, el, off = F.col("start_logits"), F.col("end_logits"), F.col("offsets")
    # the window's own slice of the text, or the whole context
    ctx = ["ctx_text", "ctx_at"] if "ctx_text" in w.columns else ["context"] if "context" in w.columns else []
    nth = F.col(order_col).cast("long") if order_col else F.lit(0).cast("long")
    w = w.select(*keys, "example_id", "window_idx", "start_logits", "end_logits", "offsets",
                 *ctx, F.size(off).alias("_n_off"), (-nth).alias("_no"))
    w = evaluate_once(with_top_k(w, {"_s_top": "start_logits", "_e_top": "end_logits"}, n_best))
    n_off = F.col("_n_off")

    def ranked_valid(col):
        r = F.transform(col, lambda x, r: F.struct(x.alias("p"), r.alias("r")))
        return F.filter(r, lambda x: (x["p"] < n_off) & F.get(off, x["p"]).isNotNull())

    w = evaluate_once(w.withColumn("_vs", ranked_valid("_s_top"))
                      .withColumn("_ve", ranked_valid("_e_top")))

    # first qualifying end per valid start, computed once (lambda bodies get
    # no common-subexpression elimination, so it is not referenced twice)
    pairs = F.transform("_vs", lambda s: F.struct(s.alias("s"), F.get(F.filter(
        "_ve", lambda y: (y["p"] >= s["p"]) & (y["p"] - s["p"] + 1 <= max_answer_tokens)),
        0).alias("e")))

    def cand(x):
        s, e = x["s"], x["e"]
        return F.struct(
            (F.get(sl, s["p"]) + F.get(el, e["p"])).alias("score"), F.col("_no").alias("no"), (-F.col("window_idx")).alias("nw"), (-s["r"]).alias("nsi"),
            (-e["r"]).alias("nei"), F.get(off, s["p"])["st"].alias("st"),
            F.get(off, e["p"])["en"].alias("en"))

    best = F.array_max(F.transform(F.filter(pairs, lambda x: x["e"].isNotNull()), cand))
    null_score = F.get(sl, cls_index) + F.get(el, cls_index)
    out = w.select(*keys, "example_id", "window_idx", *ctx, best.alias("cand"),
                   null_score.alias("null_score"))
    if ctx:
        # G5 inside the window pass: only the window's winning text (at most
        # max_answer_tokens tokens) travels, never the context itself
        c = F.col("cand")
        out = out.withColumn("cand", F.when(c.isNotNull(), F.struct(
            c["score"].alias("score"), c["no"].alias("no"), c["nw"].alias("nw"), c["nsi"].alias("nsi"),
            c["nei"].alias("nei"), c["st"].alias("st"), c["en"].alias("en"),
            F.substring(F.col(ctx[0]), c["st"] - (F.col("ctx_at") if len(ctx) > 1 else F.lit(0)) + 1,
                        c["en"] - c["st"]).alias("text"))))
        out = out.drop(*ctx)
    return out


def best_answers(scored_windows: DataFrame, examples: DataFrame,
                 n_best: int = 20, max_answer_tokens: int = 30,
                 key_values: dict[str, Sequence] | None = None, order_col: str | None = None) -> DataFrame:
    """One prediction per example ``(keys..., example_id,
    prediction_text, score, null_score)``.

    ``scored_windows`` carry ``example_id, window_idx, offsets,
    start_logits, end_logits`` and the window's text (``ctx_text`` and
    ``ctx_at``, or the whole ``context``), plus the run keys named in
    ``key_values``, e.g. ``{"seed": [0, 1, 2]}``; ``examples`` carry ``id``.
    The answer text is cut in the window pass (G5), so the one shuffle
    (``groupBy(example_id)``, partial ``max``) moves short answer strings
    and the final left join from the examples (G7: no valid candidate or
    no window -> empty text, score 0.0) moves ids only.

    Ids are unique, or ``order_col`` (in both tables) numbers the examples of
    an id (G9): the windows of all of them compete, the earlier one on ties,
    and the last example's context gives the text at the best span's place.
    """
    keys = list(key_values or {})
    wb = window_best(scored_windows, n_best, max_answer_tokens, keys=keys, order_col=order_col)
    if order_col is None:
        return collect_answers(wb, examples, key_values)
    last = keep_last_per_id(examples.select("id", F.col(order_col).cast("long").alias("_order"), "context"), "id", "_order")
    found = collect_answers(wb, last, key_values, whole=True)
    b = F.col("best")
    j = found.join(last.withColumnRenamed("id", "example_id"), "example_id")
    own = F.when(b["no"] == -F.col("_order"), b["text"]).otherwise(
        F.substring(F.col("context"), b["st"] + 1, b["en"] - b["st"]))
    return j.select(*keys, "example_id", F.coalesce(own, F.lit("")).alias("prediction_text"),
                    F.coalesce(b["score"], F.lit(0.0)).alias("score"), "null_score")


def collect_answers(window_bests: DataFrame, examples: DataFrame, key_values: dict[str, Sequence] | None = None,
                    whole: bool = False) -> DataFrame:
    """Each example's prediction from the best candidates of its
    windows (:func:`window_best`); with ``whole``, the candidate itself."""
    key_values = key_values or {}
    keys = list(key_values)
    per_ex = window_bests.groupBy(*keys, "example_id").agg(
        F.max("cand").alias("best"), F.max("null_score").alias("null_score"))
    ex = examples.select(F.col("id").alias("example_id"))
    if keys:
        # run keys are a literal list: expand examples with a narrow explode
        import itertools
        combos = list(itertools.product(*key_values.values()))
        arr = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, c)])
                        for c in combos])
        ex = ex.select("*", F.explode(arr).alias("_k")).select(
            *[F.col(f"_k.{k}").alias(k) for k in keys], "example_id")
    j = ex.join(per_ex, [*keys, "example_id"], "left")
    b = F.col("best")
    if whole:
        return j
    return j.select(*keys, "example_id",
                    F.coalesce(b["text"], F.lit("")).alias("prediction_text"),
                    F.coalesce(b["score"], F.lit(0.0)).alias("score"), "null_score")


def keep_last_per_id(df: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """When an id occurs more than once, keep the last occurrence by
    ``order_col`` (a later entry overwrites an earlier one).  A grouped
    ``max_by`` with partial aggregation: a repeated id costs one row per
    task in the shuffle, never a group gathered in one place."""
    cols = [c for c in df.columns if c != id_col]
    last = F.max_by(F.struct(*cols), F.col(order_col))
    return df.groupBy(id_col).agg(last.alias("_r")).select(id_col, *[F.col(f"_r.{c}").alias(c)
                                                                     for c in cols])
