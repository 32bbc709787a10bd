"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

R = 6  # rounding of floating outputs, as in queries.py

# --------------------------------------------------------------- building blocks
SCORED_EMB = """
scored AS (
  SELECT vec_id, label AS target,
         CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS prediction
  FROM (SELECT vec_id, label,
               CAST(list_slice(embedding, 1, 10) AS DOUBLE[]) AS l
        FROM embeddings)
)"""


def report_ctes(conf: str, keys: list[str]) -> str:
    """CTEs pc/rep computing I2-I10 from a CTE ``conf(keys, target,
    prediction, n)``; final CTE ``rep(keys, metric, class_name, value)``."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    on = " AND ".join([f"t.{x} = p.{x}" for x in keys] + ["t.class_id = p.class_id"])
    part = f"PARTITION BY {k}" if keys else ""
    tk = ", ".join(f"COALESCE(t.{x}, p.{x}) AS {x}" for x in keys)
    tkc = (tk + ", ") if keys else ""
    grp = f"GROUP BY {k}" if keys else ""
    return f"""
t AS (SELECT {kc}target AS class_id, SUM(n) AS true_n,
             SUM(CASE WHEN target = prediction THEN n ELSE 0 END) AS tp
      FROM {conf} GROUP BY {kc}target),
p AS (SELECT {kc}prediction AS class_id, SUM(n) AS pred_n
      FROM {conf} GROUP BY {kc}prediction),
pc0 AS (SELECT {tkc}COALESCE(t.class_id, p.class_id) AS class_id,
               CAST(COALESCE(true_n, 0) AS DOUBLE) AS true_n,
               CAST(COALESCE(pred_n, 0) AS DOUBLE) AS pred_n,
               CAST(COALESCE(tp, 0) AS DOUBLE) AS tp
        FROM t FULL OUTER JOIN p ON {on}),
pc AS (SELECT *, SUM(true_n) OVER ({part}) AS N FROM pc0),
pcm AS (SELECT {kc}class_id, tp, true_n, pred_n, N,
               COALESCE((N - true_n - pred_n + 2 * tp) / NULLIF(N, 0), 0) AS accuracy,
               COALESCE(tp / NULLIF(pred_n, 0), 0) AS precision,
               COALESCE(tp / NULLIF(true_n, 0), 0) AS recall,
               COALESCE(2 * tp / NULLIF(pred_n + true_n, 0), 0) AS f1
        FROM pc),
sm AS (SELECT {kc}AVG(accuracy) AS a, AVG(precision) AS pr, AVG(recall) AS rc,
              AVG(f1) AS f, SUM(tp) AS s_tp, SUM(pred_n) AS s_pn,
              SUM(true_n) AS s_tn, MAX(N) AS s_N
       FROM pcm {grp}),
rep AS (
{_stack(kc)}
)"""


def _stack(kc: str) -> str:
    per = {"accuracy": "accuracy", "precision": "precision",
           "recall": "recall", "f1": "f1"}
    macro = {"accuracy": "a", "precision": "pr", "recall": "rc", "f1": "f"}
    micro = {"accuracy": "COALESCE(s_tp / NULLIF(s_N, 0), 0)",
             "precision": "COALESCE(s_tp / NULLIF(s_pn, 0), 0)",
             "recall": "COALESCE(s_tp / NULLIF(s_tn, 0), 0)",
             "f1": "COALESCE(2 * s_tp / NULLIF(s_pn + s_tn, 0), 0)"}
    parts = []
    for m, e in per.items():
        parts.append(f"SELECT {kc}'{m}' AS metric, CAST(class_id AS VARCHAR) AS class_name, "
                     f"{e} AS value FROM pcm")
    for m, e in macro.items():
        parts.append(f"SELECT {kc}'{m}' AS metric, 'macro' AS class_name, {e} AS value FROM sm")
    for m, e in micro.items():
        parts.append(f"SELECT {kc}'{m}' AS metric, 'micro' AS class_name, {e} AS value FROM sm")
    return "\n  UNION ALL\n  ".join(parts)


CLF_REPORT = f"""
WITH {SCORED_EMB},
conf AS (SELECT target, prediction, COUNT(*) AS n FROM scored GROUP BY ALL),
{report_ctes('conf', [])}
SELECT metric, class_name, ROUND(value, {R}) AS value FROM rep
"""

CONFUSION_MATRIX = f"""
WITH {SCORED_EMB},
conf AS (SELECT target, prediction, COUNT(*) AS n FROM scored GROUP BY ALL),
ids AS (SELECT CAST(i AS INTEGER) AS i FROM range(10) r(i))
SELECT a.i AS target, b.i AS prediction, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM ids a CROSS JOIN ids b LEFT JOIN conf c ON c.target = a.i AND c.prediction = b.i
"""



# ------------------------------------------------------------------- E4 / J
def _grid_values() -> str:
    from textlab.plans.queries import GRID, TASK
    rows = ",\n    ".join(
        f"('{TASK}', '{p['model']}', CAST({p['lr']!r} AS DOUBLE), "
        f"{p['num_epochs']}, {p['seed']}, {p['config_no']})" for p in GRID)
    return (f"g(task, model, lr, num_epochs, seed, config_no) AS (VALUES\n    {rows})")


RUN = "task, model, lr, num_epochs, seed"
CFG = "task, model, lr, num_epochs"


def _runs(split: str) -> str:
    off = "((g.config_no * 5 + g.seed) % 54)"
    if split == "test":
        off = f"(({off} + 27) % 54)"
    return f"""{_grid_values()},
runs_{split} AS (
  SELECT g.task, g.model, g.lr, CAST(g.num_epochs AS INTEGER) AS num_epochs,
         CAST(g.seed AS INTEGER) AS seed, e.vec_id, e.label AS target,
         CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS prediction
  FROM embeddings e CROSS JOIN g,
       LATERAL (SELECT list_slice(e.embedding, {off} + 1, {off} + 10) AS l)
)"""


def _val_rep() -> str:
    return f"""WITH {_runs('validation')},
conf AS (SELECT {RUN}, target, prediction, COUNT(*) AS n
         FROM runs_validation GROUP BY ALL),
{report_ctes('conf', RUN.split(', '))}"""


RUN_METRICS = f"""{_val_rep()}
SELECT {RUN}, metric, class_name, ROUND(value, {R}) AS value FROM rep
"""

_CFG_SUMMARY = f"""cs AS (
  SELECT {CFG},
         AVG(CASE WHEN metric = 'accuracy' THEN value END) AS mean_accuracy,
         STDDEV_POP(CASE WHEN metric = 'accuracy' THEN value END) AS std_accuracy,
         AVG(CASE WHEN metric = 'f1' THEN value END) AS mean_f1,
         STDDEV_POP(CASE WHEN metric = 'f1' THEN value END) AS std_f1,
         CAST(COUNT(DISTINCT seed) AS BIGINT) AS n_seeds
  FROM rep WHERE class_name = 'macro' AND metric IN ('accuracy', 'f1')
  GROUP BY {CFG}),
best AS (
  SELECT task, model, lr, num_epochs, mean_f1 FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY task, model
                                 ORDER BY ROUND(mean_f1, 9) DESC, lr, num_epochs) AS rn
    FROM cs) WHERE rn = 1)"""

CONFIG_SUMMARY = f"""{_val_rep()},
{_CFG_SUMMARY}
SELECT {CFG}, n_seeds, ROUND(mean_accuracy, {R}) AS mean_accuracy,
       ROUND(std_accuracy, {R}) AS std_accuracy, ROUND(mean_f1, {R}) AS mean_f1,
       ROUND(std_f1, {R}) AS std_f1
FROM cs
"""

BEST_CONFIG = f"""{_val_rep()},
{_CFG_SUMMARY}
SELECT task, model, lr, num_epochs, ROUND(mean_f1, {R}) AS mean_f1 FROM best
"""


def _test_summary() -> str:
    test_runs = _runs("test").split(",\nruns_test AS", 1)[1]
    return f"""{_val_rep()},
{_CFG_SUMMARY},
runs_test AS {test_runs},
tconf AS (SELECT {RUN}, target, prediction, COUNT(*) AS n
          FROM runs_test r SEMI JOIN best b USING ({CFG}) GROUP BY ALL),
{report_ctes('tconf', RUN.split(', ')).replace('t AS (', 'tt AS (', 1)
   .replace('FROM t FULL OUTER JOIN p', 'FROM tt t FULL OUTER JOIN pp p')
   .replace('p AS (', 'pp AS (', 1)
   .replace('pc0 AS', 'tpc0 AS').replace('FROM pc0', 'FROM tpc0')
   .replace('pc AS', 'tpc AS').replace('FROM pc)', 'FROM tpc)')
   .replace('pcm AS', 'tpcm AS').replace('FROM pcm', 'FROM tpcm')
   .replace('sm AS', 'tsm AS').replace('FROM sm', 'FROM tsm')
   .replace('rep AS', 'trep AS')},
ss AS (
  SELECT {CFG}, CAST(COUNT(DISTINCT seed) AS BIGINT) AS n_seeds,
         CASE WHEN metric = 'f1' THEN 'F1'
              ELSE upper(substr(metric, 1, 1)) || lower(substr(metric, 2)) END AS metric,
         upper(substr(class_name, 1, 1)) || lower(substr(class_name, 2)) AS class_name,
         AVG(value) AS mean, STDDEV_SAMP(value) AS std
  FROM trep WHERE metric IN ('accuracy', 'f1')
  GROUP BY {CFG}, metric, class_name)"""


SEED_SUMMARY = f"""{_test_summary()}
SELECT {CFG}, n_seeds, metric, class_name, ROUND(mean, {R}) AS mean,
       ROUND(std, {R}) AS std FROM ss
"""

LEADERBOARD = f"""{_test_summary()}
SELECT task, model, lr, num_epochs, ROUND(mean, {R}) AS mean, ROUND(std, {R}) AS std,
       CAST(RANK() OVER (PARTITION BY task ORDER BY mean DESC) AS INTEGER) AS rank
FROM ss WHERE metric = 'F1' AND class_name = 'Macro'
"""


# ------------------------------------------------------- P1, A2-A4, C, E1-E3
SPLIT_FRACTION = """
WITH x AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY doc_id) - 1 AS position,
                  COUNT(*) OVER () AS n FROM documents)
SELECT doc_id, CAST(position AS BIGINT) AS position, 'train' AS split FROM x
WHERE position < round_even(90 * n / 100.0, 0)
UNION ALL
SELECT doc_id, CAST(position AS BIGINT) AS position, 'validation' AS split FROM x
WHERE position >= n + round_even(-10 * n / 100.0, 0)
"""

_TAIL = """
tail AS (SELECT doc_id FROM documents ORDER BY doc_id DESC LIMIT 500),
parts AS (SELECT d.*, CASE WHEN t.doc_id IS NULL THEN 'train' ELSE 'validation' END AS split
          FROM documents d LEFT JOIN tail t USING (doc_id))"""

SPLIT_TAIL = f"""WITH {_TAIL}
SELECT doc_id, split FROM parts
"""

_CLASSES = """
classes AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY source) - 1 AS INTEGER) AS class_id,
                   source AS class_name
            FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL))"""

LABEL_CLASSES = f"""WITH {_CLASSES}
SELECT class_id, class_name FROM classes
"""

LABEL_ENCODE = f"""WITH {_CLASSES}, {_TAIL}
SELECT p.doc_id, p.source, c.class_id AS label_id, p.split
FROM parts p LEFT JOIN classes c ON p.source = c.class_name
"""


def _shuffled() -> str:
    from textlab.plans.queries import BATCH_EPOCHS, BATCH_SEEDS, BATCH_SIZE
    se = ", ".join(f"({s}, {e})" for s in BATCH_SEEDS for e in BATCH_EPOCHS)
    return f"""
WITH se(seed, epoch) AS (VALUES {se}),
x AS (SELECT d.doc_id, CAST(se.seed AS INTEGER) AS seed, CAST(se.epoch AS INTEGER) AS epoch,
             ('0x' || substr(md5(CAST(se.seed AS VARCHAR) || ':' || CAST(se.epoch AS VARCHAR)
                                 || ':' || CAST(d.doc_id AS VARCHAR)), 1, 15))::BIGINT AS h
      FROM documents d CROSS JOIN se),
y AS (SELECT doc_id, seed, epoch,
             ROW_NUMBER() OVER (PARTITION BY seed, epoch ORDER BY h, doc_id) - 1 AS position
      FROM x)
SELECT doc_id, seed, epoch, CAST(position AS BIGINT) AS position,
       CAST(position // {BATCH_SIZE} AS BIGINT) AS batch_id FROM y
"""


def _eval_batches() -> str:
    from textlab.plans.queries import BATCH_SIZE
    return f"""
WITH y AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT doc_id, CAST(position AS BIGINT) AS position,
       CAST(position // {BATCH_SIZE} AS BIGINT) AS batch_id FROM y
"""


# ------------------------------------------------------------ D, F3, G, H, J6
def _qa_consts():
    from textlab.functions.text import WORD_CLASS, WS_CLASS
    from textlab.plans import queries as q
    return WORD_CLASS, WS_CLASS, q


def _long_ex() -> str:
    W, S, q = _qa_consts()
    return f"""
bw AS (SELECT item_id, text, regexp_extract_all(text, '[{W}]+') AS ws FROM benchmark),
ex AS (SELECT CAST(b.item_id AS VARCHAR) || '-' || CAST(d.doc_id AS VARCHAR) AS id,
              array_to_string(b.ws, ' ') AS question, d.text AS context,
              CAST(strpos(d.text, b.text) - 1 AS INTEGER) AS a_start, b.text AS a_text
       FROM bw b JOIN documents d ON strpos(d.text, b.text) > 0
       WHERE b.text <> '')"""


def _qa_base(source: str = "conversations") -> str:
    """CTEs: ex (id, question, context, a_start, a_text), tokens, windows."""
    W, S, q = _qa_consts()
    tok = f"[{W}]+|[{S}]+|[^{W}{S}]"
    return {"conversations": _conv_ex, "long": _long_ex, "variants": _variant_ex}[source]() + _qa_tokens_windows()


def _variant_ex() -> str:
    """The conversation examples, varied by conversation number."""
    W, S, _ = _qa_consts()
    base = _conv_ex().replace("\nex AS (", "\nex1 AS (")
    return base + f""",
ex2 AS (SELECT *, CAST(split_part(id, '-', 1) AS BIGINT) % 8 AS v,
               regexp_extract_all(context, '[{W}]+')[1] AS w1 FROM ex1),
ex AS (SELECT id, CASE v WHEN 0 THEN a_text WHEN 3 THEN w1 WHEN 4 THEN repeat(question || ' ', 80)
                         WHEN 5 THEN NULL ELSE question END AS question,
              CASE WHEN v <> 6 THEN context END AS context,
              CAST(CASE WHEN v IN (2, 6) THEN NULL WHEN v = 1 THEN a_start + 3 ELSE a_start END AS INTEGER) AS a_start,
              CASE WHEN v IN (2, 6) THEN NULL WHEN v = 7 THEN a_text || '!x' ELSE a_text END AS a_text,
              CASE WHEN v = 3 THEN w1 END AS a_text2
       FROM ex2)"""


def _conv_ex() -> str:
    W, S, q = _qa_consts()
    return f"""
u AS (SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn, text AS context FROM conversations
      WHERE role = 'assistant'),
ex0 AS (SELECT CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR) AS id,
               regexp_replace(question, '^[{S}]+', '') AS question, context
        FROM u JOIN a USING (conv_id, turn)),
ew AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
       FROM (SELECT id, regexp_extract_all(context, '[{W}]+') AS ws FROM ex0)),
lw AS (SELECT id, w FROM (SELECT id, w, ROW_NUMBER() OVER
          (PARTITION BY id ORDER BY length(w) DESC, i) AS rn FROM ew) WHERE rn = 1),
ex AS (SELECT ex0.id, ex0.question, ex0.context,
              CAST(strpos(ex0.context, lw.w) - 1 AS INTEGER) AS a_start, lw.w AS a_text
       FROM ex0 LEFT JOIN lw USING (id))"""


def _qa_tokens_windows() -> str:
    W, S, q = _qa_consts()
    tok = f"[{W}]+|[{S}]+|[^{W}{S}]"
    return f""",
rt AS (SELECT id, kind, unnest(ts) AS t, generate_subscripts(ts, 1) AS i
       FROM (SELECT id, 'q' AS kind, regexp_extract_all(question, '{tok}') AS ts FROM ex
             UNION ALL
             SELECT id, 'c' AS kind, regexp_extract_all(context, '{tok}') AS ts FROM ex)),
rto AS (SELECT id, kind, t, i,
               COALESCE(SUM(length(t)) OVER (PARTITION BY id, kind ORDER BY i
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
        FROM rt),
tk AS (SELECT id, kind, t, CAST(st AS INTEGER) AS st, CAST(st + length(t) AS INTEGER) AS en,
              ROW_NUMBER() OVER (PARTITION BY id, kind ORDER BY i) - 1 AS k
       FROM rto WHERE NOT regexp_full_match(t, '[{S}]+')),
nq AS (SELECT ex.id, CAST(COUNT(tk.t) AS INTEGER) AS n_q FROM ex
       LEFT JOIN tk ON tk.id = ex.id AND tk.kind = 'q' GROUP BY ex.id),
nc AS (SELECT ex.id, CAST(COUNT(tk.t) AS INTEGER) AS n_ctx FROM ex
       LEFT JOIN tk ON tk.id = ex.id AND tk.kind = 'c' GROUP BY ex.id),
prep AS (SELECT ex.*, n_q, n_ctx, {q.QA_MAX_LENGTH} - n_q - 3 AS budget
         FROM ex JOIN nq USING (id) JOIN nc USING (id)),
quar AS (SELECT id AS example_id,
                CASE WHEN question IS NULL THEN 'null question'
                     WHEN context IS NULL THEN 'null context'
                     WHEN budget <= {q.QA_STRIDE} THEN 'question too long'
                     WHEN a_text IS NOT NULL AND length(a_text) = 0 THEN 'empty answer text'
                     WHEN n_ctx = 0 THEN 'no context tokens'
                END AS reason FROM prep),
okp AS (SELECT prep.* FROM prep JOIN quar ON quar.example_id = prep.id WHERE quar.reason IS NULL),
win0 AS (SELECT okp.*, budget - {q.QA_STRIDE} AS step,
                CAST(ceil(greatest(0, n_ctx - budget) / (budget - {q.QA_STRIDE}))
                     * (budget - {q.QA_STRIDE}) AS INTEGER) AS last_start FROM okp),
win AS (SELECT id AS example_id, n_q, n_ctx, budget, a_start, a_text,
               CAST(unnest(range(0, last_start + 1, step)) AS INTEGER) AS w_start,
               CAST(generate_subscripts(range(0, last_start + 1, step), 1) - 1 AS INTEGER)
                 AS window_idx
        FROM win0),
wf AS (SELECT *, CAST(least(budget, n_ctx - w_start) AS INTEGER) AS w_len,
              n_q + 2 AS ctx_lo, n_q + 2 + least(budget, n_ctx - w_start) - 1 AS ctx_hi,
              n_q + least(budget, n_ctx - w_start) + 3 AS seq_len FROM win),
wt AS (SELECT wf.example_id, wf.window_idx, tk.k - wf.w_start AS j, tk.t, tk.st, tk.en
       FROM wf JOIN tk ON tk.id = wf.example_id AND tk.kind = 'c'
        AND tk.k >= wf.w_start AND tk.k < wf.w_start + wf.w_len),
wagg AS (SELECT wf.example_id, wf.window_idx,
                MIN(wt.st) FILTER (WHERE wt.j = 0) AS first_st,
                MAX(wt.en) FILTER (WHERE wt.j = wf.w_len - 1) AS last_en,
                COUNT(wt.j) AS n_offsets,
                COUNT(wt.j) FILTER (WHERE wt.st <= wf.a_start) AS n_le,
                COUNT(wt.j) FILTER (WHERE wt.en < wf.a_start + length(wf.a_text)) AS n_lt
         FROM wf LEFT JOIN wt USING (example_id, window_idx)
         GROUP BY wf.example_id, wf.window_idx)"""


def _qa_features() -> str:
    return f"""WITH {_qa_base()}
SELECT example_id, window_idx, n_q, n_ctx, w_start, w_len, CAST(ctx_lo AS INTEGER) AS ctx_lo,
       CAST(ctx_hi AS INTEGER) AS ctx_hi, CAST(seq_len AS INTEGER) AS seq_len, first_st,
       last_en, CAST(n_offsets AS INTEGER) AS n_offsets
FROM wf JOIN wagg USING (example_id, window_idx)
"""


def _qa_labels(source: str = "conversations") -> str:
    return f"""WITH {_qa_base(source)}
SELECT example_id, window_idx,
       CAST(CASE WHEN ok THEN ctx_lo + n_le - 1 ELSE 0 END AS INTEGER) AS start_position,
       CAST(CASE WHEN ok THEN ctx_lo + n_lt ELSE 0 END AS INTEGER) AS end_position
FROM (SELECT wf.*, wagg.n_le, wagg.n_lt,
             COALESCE(a_text IS NOT NULL AND first_st <= a_start
                      AND last_en >= a_start + length(a_text), FALSE) AS ok
      FROM wf JOIN wagg USING (example_id, window_idx))
"""


def _qa_quarantine(source: str = "conversations") -> str:
    return f"""WITH {_qa_base(source)}
SELECT example_id, reason FROM quar WHERE reason IS NOT NULL
"""


def _qa_examples() -> str:
    return f"""WITH {_qa_base()}
SELECT id, question, a_start AS answer_start, a_text AS answer_text FROM ex
"""


def _span_validation(source: str = "conversations") -> str:
    return f"""WITH {_qa_base(source)}
SELECT id, a_start AS stored_start,
       CASE WHEN strpos(context, a_text) > 0 THEN CAST(strpos(context, a_text) - 1 AS INTEGER)
       END AS found_start,
       CASE WHEN a_text IS NULL THEN 'no_answer'
            WHEN substring(context, a_start + 1, length(a_text)) = a_text THEN 'ok'
            WHEN strpos(context, a_text) > 0 THEN 'repairable'
            ELSE 'missing' END AS status
FROM ex
"""


def _qa_pred_ctes(seeds, source: str = "conversations") -> str:
    W, S, q = _qa_consts()
    sv = ", ".join(f"({s})" for s in seeds)
    return f"""{_qa_base(source)},
seeds(seed) AS (VALUES {sv}),
qw AS (SELECT id, list_distinct(list(lower(t))) AS qwords FROM tk
       WHERE kind = 'q' AND regexp_full_match(t, '[{W}]+') GROUP BY id),
wm AS (SELECT wt.*, CASE WHEN list_contains(COALESCE(qw.qwords, []), lower(wt.t))
                         THEN 1 ELSE 0 END AS m,
              CASE WHEN regexp_full_match(wt.t, '[{W}]+') THEN 1 ELSE 0 END AS wd
       FROM wt LEFT JOIN qw ON qw.id = wt.example_id),
wm2 AS (SELECT *, COALESCE(LEAD(m) OVER (PARTITION BY example_id, window_idx ORDER BY j), 0) AS m_next,
               COALESCE(LAG(m) OVER (PARTITION BY example_id, window_idx ORDER BY j), 0) AS m_prev
        FROM wm),
pos AS (SELECT wf.example_id, wf.window_idx, wf.ctx_lo, wf.ctx_hi,
               CAST(unnest(range(0, wf.seq_len)) AS INTEGER) AS i FROM wf),
lg AS (SELECT p.example_id, p.window_idx, s.seed, p.i, w.st, w.en,
              CASE WHEN p.i >= p.ctx_lo AND p.i <= p.ctx_hi
                     THEN CAST(4 * w.m + 2 * w.m_next + w.wd AS DOUBLE)
                          + ((w.j + s.seed) % 3) * 0.5
                   WHEN p.i = 0 THEN 0.0 ELSE -1.0 END AS sl,
              CASE WHEN p.i >= p.ctx_lo AND p.i <= p.ctx_hi
                     THEN CAST(4 * w.m + 2 * w.m_prev + w.wd AS DOUBLE)
                          + ((w.j + 2 * s.seed) % 3) * 0.5
                   WHEN p.i = 0 THEN 0.0 ELSE -1.0 END AS el
       FROM pos p CROSS JOIN seeds s
       LEFT JOIN wm2 w ON w.example_id = p.example_id AND w.window_idx = p.window_idx
                      AND w.j = p.i - p.ctx_lo),
st AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY example_id, window_idx, seed
                                                   ORDER BY sl DESC, i) - 1 AS r FROM lg)
       WHERE r < {q.QA_N_BEST}),
et AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY example_id, window_idx, seed
                                                   ORDER BY el DESC, i) - 1 AS r FROM lg)
       WHERE r < {q.QA_N_BEST}),
cand AS (SELECT s.example_id, s.seed, s.window_idx, s.r AS si, e.r AS ei, s.sl + e.el AS score,
                s.st AS cst, e.en AS cen
         FROM st s JOIN et e USING (example_id, window_idx, seed)
         WHERE s.st IS NOT NULL AND e.en IS NOT NULL AND e.i >= s.i
           AND e.i - s.i + 1 <= {q.QA_MAX_ANSWER}),
best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY example_id, seed
                          ORDER BY score DESC, window_idx, si, ei) AS rn FROM cand) WHERE rn = 1),
nulls AS (SELECT example_id, seed, MAX(sl + el) AS null_score FROM lg WHERE i = 0
          GROUP BY example_id, seed),
pred AS (SELECT s.seed, ex.id AS example_id,
                CASE WHEN b.score IS NULL THEN ''
                     ELSE substring(ex.context, b.cst + 1, b.cen - b.cst) END AS prediction_text,
                COALESCE(b.score, 0.0) AS score, n.null_score
         FROM ex CROSS JOIN seeds s
         LEFT JOIN best b ON b.example_id = ex.id AND b.seed = s.seed
         LEFT JOIN nulls n ON n.example_id = ex.id AND n.seed = s.seed)"""


def _qa_predictions() -> str:
    from textlab.plans.queries import QA_SEEDS
    return f"""WITH {_qa_pred_ctes(QA_SEEDS)}
SELECT seed, example_id, prediction_text, ROUND(score, {R}) AS score,
       ROUND(null_score, {R}) AS null_score FROM pred
"""


def _norm(x: str) -> str:
    W, S, _ = _qa_consts()
    art = f"(^|[^{W}])(a|an|the)([^{W}]|$)"
    y = f"regexp_replace(lower({x}), '[!-/:-@\\[-`{{-~]', '', 'g')"
    y = f"regexp_replace(regexp_replace({y}, '{art}', '\\1 \\3', 'g'), '{art}', '\\1 \\3', 'g')"
    return (f"array_to_string(list_filter(regexp_split_to_array({y}, '[{S}]+'), "
            f"lambda z: z <> ''), ' ')")


def _toks(x: str) -> str:
    _, S, _ = _qa_consts()
    return f"list_filter(regexp_split_to_array({x}, '[{S}]+'), lambda z: z <> '')"


def _qa_score_ctes(lowercase: bool, source: str = "conversations", only: str = "TRUE",
                   second_gold: bool = False) -> str:
    from textlab.plans import queries as q
    pt = "lower(prediction_text)" if lowercase else "prediction_text"
    gt = "lower(gold.g)" if lowercase else "gold.g"
    more = " UNION ALL SELECT id, a_text2 FROM ex WHERE a_text2 IS NOT NULL" if second_gold else ""
    return f"""{_qa_pred_ctes(q.QA_SEEDS, source)},
gold AS (SELECT id, a_text AS g FROM ex{more}),
sc0 AS (SELECT p.seed, p.example_id, {_norm(pt)} AS pn,
               CASE WHEN gold.g IS NULL THEN NULL ELSE {_norm(gt)} END AS gn
        FROM pred p JOIN gold ON gold.id = p.example_id WHERE {only}),
sc1 AS (SELECT *, {_toks('pn')} AS pt, {_toks('gn')} AS gtk FROM sc0),
sc2 AS (SELECT *, COALESCE(list_sum(list_transform(list_distinct(pt), lambda t:
                    least(len(list_filter(pt, lambda x: x = t)),
                          len(list_filter(gtk, lambda x: x = t))))), 0) AS common FROM sc1),
sc AS (SELECT seed, example_id,
              MAX(CASE WHEN gn IS NULL THEN 0.0 WHEN pn = gn THEN 1.0 ELSE 0.0 END) AS em,
              MAX(CASE WHEN gn IS NULL OR common = 0 THEN 0.0
                   ELSE (2 * (common / len(pt)) * (common / len(gtk)))
                        / ((common / len(pt)) + (common / len(gtk))) END) AS f1
       FROM sc2 GROUP BY seed, example_id),
scores AS (SELECT seed, SUM(em) * 100 / (SELECT COUNT(*) FROM ex) AS exact_match,
                  SUM(f1) * 100 / (SELECT COUNT(*) FROM ex) AS f1,
                  CAST((SELECT COUNT(*) FROM ex) AS BIGINT) AS n FROM sc GROUP BY seed)"""


def _qa_scores(lowercase: bool) -> str:
    return f"""WITH {_qa_score_ctes(lowercase)}
SELECT seed, ROUND(exact_match, {R}) AS exact_match, ROUND(f1, {R}) AS f1, n FROM scores
"""


def _qa_scores_partial() -> str:
    return f"""WITH {_qa_score_ctes(False, only="p.example_id NOT LIKE '%2'")}
SELECT seed, ROUND(exact_match, {R}) AS exact_match, ROUND(f1, {R}) AS f1, n FROM scores
"""


def _qa_summary() -> str:
    return f"""WITH {_qa_score_ctes(False)},
lng AS (SELECT seed, 'exact_match' AS metric, exact_match AS value FROM scores
        UNION ALL SELECT seed, 'f1' AS metric, f1 AS value FROM scores)
SELECT 'conversations' AS task, 'overlap' AS model, metric, ROUND(AVG(value), {R}) AS mean,
       ROUND(MEDIAN(value), {R}) AS median, ROUND(STDDEV_SAMP(value), {R}) AS std,
       CAST(COUNT(value) AS BIGINT) AS n_seeds
FROM lng GROUP BY metric
"""


# ------------------------------------------------------- D15, D4, K, B, F1, J11
def _tokens_sql(x: str) -> str:
    W, S, _ = _qa_consts()
    tok = f"[{W}]+|[{S}]+|[^{W}{S}]"
    return (f"list_filter(regexp_extract_all({x}, '{tok}'), "
            f"lambda t: NOT regexp_full_match(t, '[{S}]+'))")


def _vocab_ctes() -> str:
    from textlab.plans.queries import VOCAB_SIZE
    return f"""
ft AS (SELECT unnest({_tokens_sql('text')}) AS token FROM documents),
freq AS (SELECT token, COUNT(*) AS n FROM ft GROUP BY token
         ORDER BY n DESC, token LIMIT {VOCAB_SIZE}),
vocab AS (SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3))
                 sp(token, token_id)
          UNION ALL
          SELECT token, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, token) - 1 + 4 AS INTEGER)
          FROM freq)"""


def _piece_ctes(table: str, size: int, words: str) -> str:
    """CTEs: pv (sub-word vocabulary of a table's texts, with ids) and pieces
    (word, i, piece, pos, len) of the words of a CTE ``words(word)``: the
    longest entry at each place, place after place; ``[UNK]`` for the whole
    word where no entry fits.  Needs WITH RECURSIVE."""
    W, _, _ = _qa_consts()
    return f"""
pt AS (SELECT unnest({_tokens_sql('text')}) AS token FROM {table}),
pfreq AS (SELECT token FROM pt GROUP BY token ORDER BY COUNT(*) DESC, token LIMIT {size}),
pch AS (SELECT DISTINCT unnest(string_split(regexp_replace(text, '[^{W}]', '', 'g'), '')) AS ch FROM {table}),
pv AS (SELECT token, CAST(ROW_NUMBER() OVER (ORDER BY token) + 3 AS INTEGER) AS id
       FROM (SELECT token FROM pfreq UNION SELECT ch FROM pch WHERE ch <> '' UNION SELECT '##' || ch FROM pch WHERE ch <> '')),
longest AS (SELECT MAX(length(token)) AS n FROM pv),
pw AS (SELECT DISTINCT word FROM {words}),
walk(word, i, piece, pos, len) AS (
  SELECT word, 0, NULL::VARCHAR, 1::BIGINT, 0::BIGINT FROM pw
  UNION ALL
  SELECT word, i, piece, pos, len FROM (
    SELECT c.word, c.i, v.token AS piece, c.pos, c.n AS len,
           ROW_NUMBER() OVER (PARTITION BY c.word ORDER BY c.n DESC) AS rn
    FROM (SELECT word, i + 1 AS i, pos + len AS pos,
                 unnest(range(1, least(length(word) - (pos + len) + 1, (SELECT n FROM longest)) + 1)) AS n
          FROM walk WHERE pos + len <= length(word)) c
    JOIN pv v ON v.token = CASE WHEN c.pos = 1 THEN '' ELSE '##' END || substr(c.word, c.pos, c.n)) WHERE rn = 1),
whole AS (SELECT word, MAX(pos + len) > length(word) AS ok FROM walk GROUP BY word),
pieces AS (SELECT word, i, piece, pos, len FROM walk JOIN whole USING (word) WHERE ok AND i > 0
           UNION ALL SELECT word, 1, '[UNK]', 1, length(word) FROM whole WHERE NOT ok)"""


def _subword_pieces() -> str:
    from textlab.plans.queries import VOCAB_SIZE
    W, _, _ = _qa_consts()
    return f"""WITH RECURSIVE
dw AS (SELECT unnest(regexp_extract_all(text, '[{W}]+')) AS word FROM documents),
{_piece_ctes('documents', VOCAB_SIZE, 'dw')}
SELECT word, CAST(COUNT(*) AS INTEGER) AS n_pieces, string_agg(piece, ' ' ORDER BY i) AS pieces FROM pieces GROUP BY word
"""


def _qa_pair_encoding() -> str:
    from textlab.plans.queries import QA_PIECES
    _, _, q = _qa_consts()
    L = q.QA_MAX_LENGTH
    base = _qa_base().replace("\ntk AS (", "\ntk0 AS (", 1)
    cut = base.index("\nnq AS (")
    rep = lambda x, n: f"repeat('{x}', CAST({n} AS INTEGER))"
    pad = f"({L} - seq_len)"
    return f"""WITH RECURSIVE {base[:cut]}
qw AS (SELECT t AS word FROM tk0),
{_piece_ctes('conversations', QA_PIECES, 'qw')},
tk AS (SELECT tk0.id, tk0.kind, p.piece AS t, COALESCE(pv.id, 1) AS pid, CAST(tk0.st + p.pos - 1 AS INTEGER) AS st,
              CAST(tk0.st + p.pos - 1 + p.len AS INTEGER) AS en,
              ROW_NUMBER() OVER (PARTITION BY tk0.id, tk0.kind ORDER BY tk0.k, p.i) - 1 AS k
       FROM tk0 JOIN pieces p ON p.word = tk0.t LEFT JOIN pv ON pv.token = p.piece),
{base[cut:]},
qs AS (SELECT id AS example_id, string_agg(pid || ' ', '' ORDER BY k) AS q_ids FROM tk WHERE kind = 'q' GROUP BY id),
cs AS (SELECT wf.example_id, wf.window_idx, string_agg(tk.pid || ' ', '' ORDER BY tk.k) AS c_ids,
              string_agg(tk.st || ':' || tk.en, ' ' ORDER BY tk.k) AS offsets
       FROM wf JOIN tk ON tk.id = wf.example_id AND tk.kind = 'c' AND tk.k >= wf.w_start AND tk.k < wf.w_start + wf.w_len
       GROUP BY wf.example_id, wf.window_idx),
al AS (SELECT wf.*, wagg.n_le, wagg.n_lt, COALESCE(q_ids, '') AS q_ids, c_ids, offsets,
              COALESCE(a_text IS NOT NULL AND first_st <= a_start AND last_en >= a_start + length(a_text), FALSE) AS ok
       FROM wf JOIN wagg USING (example_id, window_idx) LEFT JOIN qs USING (example_id) JOIN cs USING (example_id, window_idx))
SELECT example_id, TRUE AS pad_on_right, window_idx, w_start, w_len,
       '2 ' || q_ids || '3 ' || c_ids || '3' || {rep(' 0', pad)} AS input_ids,
       {rep('1 ', 'seq_len - 1')} || '1' || {rep(' 0', pad)} AS attention_mask,
       '- ' || {rep('0 ', 'n_q')} || '- ' || {rep('1 ', 'w_len')} || '-' || {rep(' -', pad)} AS sequence_ids,
       offsets, CAST(n_q + 2 AS INTEGER) AS first_offset, {L} AS length, 0 AS cls_index,
       CAST(CASE WHEN ok THEN n_q + 2 + n_le - 1 ELSE 0 END AS INTEGER) AS start_position,
       CAST(CASE WHEN ok THEN n_q + 2 + n_lt ELSE 0 END AS INTEGER) AS end_position
FROM al
UNION ALL
SELECT example_id, FALSE, window_idx, w_start, w_len,
       {rep('0 ', pad)} || '2 ' || c_ids || '3 ' || q_ids || '3',
       {rep('0 ', pad)} || {rep('1 ', 'seq_len - 1')} || '1',
       {rep('- ', pad)} || '- ' || {rep('0 ', 'w_len')} || '- ' || {rep('1 ', 'n_q')} || '-',
       offsets, CAST({pad} + 1 AS INTEGER), {L}, CAST({pad} AS INTEGER),
       CAST({pad} + CASE WHEN ok THEN n_le ELSE 0 END AS INTEGER),
       CAST({pad} + CASE WHEN ok THEN 1 + n_lt ELSE 0 END AS INTEGER)
FROM al
"""


def _vocabulary() -> str:
    return f"""WITH {_vocab_ctes()}
SELECT CAST(token_id AS INTEGER) AS token_id, token FROM vocab
"""


def _encode_docs() -> str:
    from textlab.plans.queries import ENCODE_MAX_LENGTH as L
    return f"""WITH {_vocab_ctes()},
dt AS (SELECT doc_id, {_tokens_sql('text')} AS toks FROM documents),
kept AS (SELECT doc_id, unnest(toks[1:{L - 2}]) AS token,
                generate_subscripts(toks[1:{L - 2}], 1) AS i FROM dt),
kid AS (SELECT k.doc_id, i, COALESCE(v.token_id, 1) AS id FROM kept k LEFT JOIN vocab v USING (token)),
agg AS (SELECT doc_id, COUNT(*) AS nk, list(id ORDER BY i) AS ids, COUNT(*) FILTER (WHERE id = 1) AS nu
        FROM kid GROUP BY doc_id)
SELECT dt.doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, len(toks) > {L - 2} AS truncated,
       CAST(COALESCE(nu, 0) AS INTEGER) AS n_unk,
       CAST(COALESCE(nk, 0) + 2 AS INTEGER) AS n_attention,
       array_to_string([2] || COALESCE(ids, []) || [3], ' ')
         || repeat(' 0', CAST({L} - 2 - COALESCE(nk, 0) AS INTEGER)) AS ids, {L} AS length
FROM dt LEFT JOIN agg USING (doc_id)
"""


def _corpus_stats() -> str:
    return f"""
SELECT source, CAST(COUNT(*) AS BIGINT) AS n_docs,
       CAST(SUM(len({_tokens_sql('text')})) AS BIGINT) AS n_tokens,
       CAST(SUM(octet_length(encode(text))) AS BIGINT) AS n_bytes
FROM documents GROUP BY ROLLUP (source)
"""


def _corpus_sources() -> str:
    return f"""
WITH c AS (SELECT source, text FROM documents
           UNION ALL SELECT 'conversations' AS source, text FROM conversations
           UNION ALL SELECT 'benchmark' AS source, text FROM benchmark)
SELECT source, CAST(COUNT(*) AS BIGINT) AS n_docs,
       CAST(SUM(len({_tokens_sql('text')})) AS BIGINT) AS n_tokens,
       CAST(SUM(octet_length(encode(text))) AS BIGINT) AS n_bytes
FROM c GROUP BY ROLLUP (source)
"""


_LABEL_SETS = """
ls AS (SELECT d.doc_id,
              list_filter([d.lang, CASE WHEN l.quality = 1 THEN 'quality' END,
                           CASE WHEN l.toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS labels,
              list_filter([CASE WHEN d.n_chars >= 1000 THEN d.lang ELSE 'en' END,
                           CASE WHEN d.n_chars > 3000 THEN 'quality' END,
                           CASE WHEN contains(d.text, '!') THEN 'toxic' END],
                          lambda x: x IS NOT NULL) AS predicted
       FROM documents d JOIN labels l USING (doc_id))"""


def _multilabel_report() -> str:
    return f"""WITH {_LABEL_SETS},
t AS (SELECT DISTINCT doc_id, unnest(labels) AS label FROM ls),
p AS (SELECT DISTINCT doc_id, unnest(predicted) AS label FROM ls),
j AS (SELECT COALESCE(t.label, p.label) AS label,
             CASE WHEN t.doc_id IS NOT NULL THEN 1 ELSE 0 END AS it,
             CASE WHEN p.doc_id IS NOT NULL THEN 1 ELSE 0 END AS ip
      FROM t FULL OUTER JOIN p ON t.doc_id = p.doc_id AND t.label = p.label),
per AS (SELECT label, CAST(SUM(it * ip) AS DOUBLE) AS tp, CAST(SUM((1 - it) * ip) AS DOUBLE) AS fp,
               CAST(SUM(it * (1 - ip)) AS DOUBLE) AS fn FROM j GROUP BY label),
pm AS (SELECT label, tp, fp, fn, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS precision,
              COALESCE(tp / NULLIF(tp + fn, 0), 0) AS recall,
              COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1 FROM per),
sm AS (SELECT AVG(precision) AS ap, AVG(recall) AS ar, AVG(f1) AS af,
              SUM(tp) AS stp, SUM(fp) AS sfp, SUM(fn) AS sfn FROM pm)
SELECT 'precision' AS metric, label AS class_name, ROUND(precision, {R}) AS value FROM pm
UNION ALL SELECT 'recall', label, ROUND(recall, {R}) FROM pm
UNION ALL SELECT 'f1', label, ROUND(f1, {R}) FROM pm
UNION ALL SELECT 'precision', 'macro', ROUND(ap, {R}) FROM sm
UNION ALL SELECT 'recall', 'macro', ROUND(ar, {R}) FROM sm
UNION ALL SELECT 'f1', 'macro', ROUND(af, {R}) FROM sm
UNION ALL SELECT 'precision', 'micro', ROUND(COALESCE(stp / NULLIF(stp + sfp, 0), 0), {R}) FROM sm
UNION ALL SELECT 'recall', 'micro', ROUND(COALESCE(stp / NULLIF(stp + sfn, 0), 0), {R}) FROM sm
UNION ALL SELECT 'f1', 'micro', ROUND(COALESCE(2 * stp / NULLIF(2 * stp + sfp + sfn, 0), 0), {R}) FROM sm
"""


def _labelset_stats() -> str:
    return f"""WITH {_LABEL_SETS},
k AS (SELECT len(list_distinct(labels)) AS k FROM ls)
SELECT 'n_rows' AS stat, ROUND(CAST(COUNT(*) AS DOUBLE), {R}) AS value FROM k
UNION ALL SELECT 'max_labels', ROUND(CAST(MAX(k) AS DOUBLE), {R}) FROM k
UNION ALL SELECT 'mean_labels', ROUND(AVG(k), {R}) FROM k
UNION ALL SELECT 'n_labels', ROUND(CAST(COUNT(DISTINCT l) AS DOUBLE), {R})
          FROM (SELECT unnest(labels) AS l FROM ls)
"""


def _resolve_models() -> str:
    from textlab.plans.queries import MODEL_RULES as r
    return f"""
WITH p AS (SELECT page_id, 'slash' AS style, url AS path FROM pages
           UNION ALL SELECT page_id, 'backslash', replace(url, '/', '\\') FROM pages)
SELECT page_id, style,
       replace(CASE WHEN contains(path, '{r.family_token}') OR contains(path, '\\')
                      THEN string_split(path, '\\')[-1]
                    WHEN contains(path, '/') THEN string_split(path, '/')[-1]
                    ELSE path END, '{r.converted_suffix}', '') AS model_name,
       CASE WHEN contains(path, '{r.family_token}') THEN '{r.family_tokenizer}'
            WHEN contains(path, '\\') THEN '{r.local_tokenizer}'
            ELSE path END AS tokenizer,
       CASE WHEN contains(path, '{r.own_token}') THEN '{r.own_root}'
            ELSE '{r.other_root}' END AS output_root
FROM p
"""


def _nb_report() -> str:
    from textlab.plans.queries import NB_ALPHAS, NB_CLASSES
    W, _, _ = _qa_consts()
    al = ", ".join(f"(CAST({a!r} AS DOUBLE))" for a in NB_ALPHAS)
    cl = ", ".join(f"({c})" for c in NB_CLASSES)
    return f"""
WITH lab AS (SELECT d.doc_id, d.text, l.quality AS class_id
             FROM documents d JOIN labels l USING (doc_id)),
ps AS (SELECT *, ROW_NUMBER() OVER (ORDER BY doc_id) - 1 AS position, COUNT(*) OVER () AS n FROM lab),
train AS (SELECT * FROM ps WHERE position < round_even(90 * n / 100.0, 0)),
test AS (SELECT * FROM ps WHERE position >= n + round_even(-10 * n / 100.0, 0)),
al(alpha) AS (VALUES {al}),
cls(class_id) AS (VALUES {cl}),
trw AS (SELECT doc_id, class_id, unnest(regexp_extract_all(lower(text), '[{W}]+')) AS word FROM train),
nwc AS (SELECT word, class_id, COUNT(*) AS n_wc FROM trw GROUP BY word, class_id),
nc AS (SELECT class_id, COUNT(*) AS n_c FROM trw GROUP BY class_id),
voc AS (SELECT DISTINCT word FROM nwc),
vs AS (SELECT CAST(COUNT(*) AS DOUBLE) AS v FROM voc),
nd AS (SELECT CAST(COUNT(*) AS DOUBLE) AS nd FROM train),
ll AS (SELECT al.alpha, voc.word, cls.class_id,
              ln((COALESCE(nwc.n_wc, 0) + al.alpha) / (COALESCE(nc.n_c, 0) + al.alpha * vs.v)) AS lp
       FROM voc CROSS JOIN cls CROSS JOIN al CROSS JOIN vs
       LEFT JOIN nwc ON nwc.word = voc.word AND nwc.class_id = cls.class_id
       LEFT JOIN nc ON nc.class_id = cls.class_id),
prior AS (SELECT al.alpha, c.class_id, ln(c.d_c / nd.nd) AS prior
          FROM (SELECT class_id, COUNT(*) AS d_c FROM train GROUP BY class_id) c
          CROSS JOIN al CROSS JOIN nd),
tw AS (SELECT doc_id, word, COUNT(*) AS cnt
       FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[{W}]+')) AS word FROM test)
       GROUP BY doc_id, word),
s AS (SELECT ll.alpha, tw.doc_id, ll.class_id, SUM(tw.cnt * ll.lp) AS ll
      FROM tw JOIN ll USING (word) GROUP BY ll.alpha, tw.doc_id, ll.class_id),
sc AS (SELECT al.alpha, t.doc_id, cls.class_id, t.class_id AS target,
              COALESCE(pr.prior, 0.0) + COALESCE(s.ll, 0.0) AS score
       FROM test t CROSS JOIN al CROSS JOIN cls
       LEFT JOIN prior pr ON pr.alpha = al.alpha AND pr.class_id = cls.class_id
       LEFT JOIN s ON s.alpha = al.alpha AND s.doc_id = t.doc_id AND s.class_id = cls.class_id),
pred AS (SELECT alpha, doc_id, target, class_id AS prediction FROM (
           SELECT *, ROW_NUMBER() OVER (PARTITION BY alpha, doc_id ORDER BY score DESC, class_id) AS rn
           FROM sc) WHERE rn = 1),
conf AS (SELECT alpha, target, prediction, COUNT(*) AS n FROM pred GROUP BY ALL),
{report_ctes('conf', ['alpha'])}
SELECT alpha, metric, class_name, ROUND(value, {R}) AS value FROM rep
"""


def _logreg_report() -> str:
    from textlab.plans.queries import LOGREG_FEATURES as D, LOGREG_ITERS, LOGREG_REGS
    W, _, _ = _qa_consts()
    regs = ", ".join(f"({k}, CAST({r!r} AS DOUBLE))" for k, r in enumerate(LOGREG_REGS))
    steps, snap = [], []
    for t in range(max(LOGREG_ITERS)):
        steps.append(f"""
m{t} AS MATERIALIZED (SELECT tx.doc_id, wv.k, 1 / (1 + exp(-SUM(tx.x * wv.v))) - MAX(tx.y) AS r
  FROM tx JOIN wv{t} wv USING (f) GROUP BY tx.doc_id, wv.k),
wv{t + 1} AS MATERIALIZED (SELECT f, k, neww AS w, neww + {t} / {t + 3}.0 * (neww - w) AS v FROM (
  SELECT wv.f, wv.k, wv.w, wv.v - (g.s / (SELECT n FROM nt) + CASE WHEN wv.f = {D} THEN 0 ELSE reg END * wv.v) / (0.5 + reg) AS neww
  FROM wv{t} wv JOIN regs USING (k)
  JOIN (SELECT tx.f, m.k, SUM(tx.x * m.r) AS s FROM tx JOIN m{t} m USING (doc_id) GROUP BY tx.f, m.k) g USING (f, k)))""")
        if t + 1 in LOGREG_ITERS:
            snap.append(f"SELECT {t + 1} AS max_iter, f, k, w FROM wv{t + 1}")
    return f"""
WITH lab AS (SELECT d.doc_id, d.text, l.quality AS y FROM documents d JOIN labels l USING (doc_id)),
ps AS (SELECT *, (ROW_NUMBER() OVER (ORDER BY doc_id) - 1) < round_even(90 * COUNT(*) OVER () / 100.0, 0) AS fit FROM lab),
nt AS MATERIALIZED (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM ps WHERE fit),
tf AS MATERIALIZED (SELECT doc_id, fit, y, ('0x' || substr(md5(word), 1, 15))::BIGINT % {D} AS f, COUNT(*) AS tf
  FROM (SELECT doc_id, fit, y, unnest(regexp_extract_all(lower(text), '[{W}]+')) AS word FROM ps) GROUP BY ALL),
idf AS (SELECT f, ln(((SELECT n FROM nt) + 1) / (COUNT(*) FILTER (WHERE fit) + 1)) AS idf FROM tf GROUP BY f),
ti AS (SELECT doc_id, f, tf * idf AS x FROM tf JOIN idf USING (f)),
nm AS (SELECT doc_id, sqrt(SUM(x * x)) AS norm FROM ti GROUP BY doc_id),
xs AS MATERIALIZED (SELECT doc_id, f, CASE WHEN norm > 0 THEN x / norm ELSE 0 END AS x FROM ti JOIN nm USING (doc_id)
  UNION ALL SELECT doc_id, {D}, 1.0 FROM ps),
tx AS MATERIALIZED (SELECT xs.*, ps.y FROM xs JOIN ps USING (doc_id) WHERE ps.fit),
regs(k, reg) AS (VALUES {regs}),
wv0 AS MATERIALIZED (SELECT f, k, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS v FROM (SELECT DISTINCT f FROM tx), regs),
{",".join(steps)},
fitted AS ({" UNION ALL ".join(snap)}),
pred AS (SELECT reg AS reg_param, max_iter, ps.doc_id, MAX(ps.y) AS target, CASE WHEN SUM(xs.x * fitted.w) > 0 THEN 1 ELSE 0 END AS prediction
  FROM ps JOIN xs USING (doc_id) JOIN fitted USING (f) JOIN regs USING (k) WHERE NOT ps.fit GROUP BY reg, max_iter, ps.doc_id),
conf AS (SELECT reg_param, max_iter, target, prediction, COUNT(*) AS n FROM pred GROUP BY ALL),
{report_ctes('conf', ['reg_param', 'max_iter'])}
SELECT reg_param, max_iter, metric, class_name, ROUND(value, {R}) AS value FROM rep
"""


def _compare_models() -> str:
    return f"""WITH {_qa_pred_ctes((0, 1))}
SELECT ex.id AS example_id, ex.a_text AS answer_text,
       MAX(CASE WHEN p.seed = 0 THEN p.prediction_text END) AS overlap_s0,
       MAX(CASE WHEN p.seed = 1 THEN p.prediction_text END) AS overlap_s1
FROM ex LEFT JOIN pred p ON p.example_id = ex.id
GROUP BY ex.id, ex.a_text
"""


def _long_qa_examples() -> str:
    return f"""WITH {_long_ex()}
SELECT id, question, a_start AS answer_start, CAST(length(context) AS INTEGER) AS context_chars
FROM ex
"""


def _long_qa_labels() -> str:
    return f"""WITH {_qa_base('long')}
SELECT example_id, window_idx, w_start, w_len,
       CAST(CASE WHEN ok THEN ctx_lo + n_le - 1 ELSE 0 END AS INTEGER) AS start_position,
       CAST(CASE WHEN ok THEN ctx_lo + n_lt ELSE 0 END AS INTEGER) AS end_position
FROM (SELECT wf.*, wagg.n_le, wagg.n_lt,
             COALESCE(a_text IS NOT NULL AND first_st <= a_start
                      AND last_en >= a_start + length(a_text), FALSE) AS ok
      FROM wf JOIN wagg USING (example_id, window_idx))
"""


def _long_qa_predictions() -> str:
    from textlab.plans.queries import QA_SEEDS
    return f"""WITH {_qa_pred_ctes(QA_SEEDS, 'long')}
SELECT seed, example_id, prediction_text, ROUND(score, {R}) AS score,
       ROUND(null_score, {R}) AS null_score FROM pred
"""


def _long_qa_scores() -> str:
    return f"""WITH {_qa_score_ctes(False, 'long')}
SELECT seed, ROUND(exact_match, {R}) AS exact_match, ROUND(f1, {R}) AS f1, n FROM scores
"""

def all_sql() -> dict[str, str]:
    return {
        "clf_report": CLF_REPORT,
        "confusion_matrix": CONFUSION_MATRIX,
        "run_metrics": RUN_METRICS,
        "config_summary": CONFIG_SUMMARY,
        "best_config": BEST_CONFIG,
        "seed_summary": SEED_SUMMARY,
        "leaderboard": LEADERBOARD,
        "split_fraction": SPLIT_FRACTION,
        "split_tail": SPLIT_TAIL,
        "label_classes": LABEL_CLASSES,
        "label_encode": LABEL_ENCODE,
        "shuffled_batches": _shuffled(),
        "eval_batches": _eval_batches(),
        "qa_examples": _qa_examples(),
        "qa_features": _qa_features(),
        "qa_labels": _qa_labels(),
        "qa_quarantine": _qa_quarantine(),
        "span_validation": _span_validation(),
        "qa_predictions": _qa_predictions(),
        "qa_scores": _qa_scores(False),
        "qa_scores_lower": _qa_scores(True),
        "qa_scores_partial": _qa_scores_partial(),
        "qa_summary": _qa_summary(),
        "vocabulary": _vocabulary(),
        "encode_docs": _encode_docs(),
        "subword_pieces": _subword_pieces(),
        "qa_pair_encoding": _qa_pair_encoding(),
        "corpus_stats": _corpus_stats(),
        "corpus_sources": _corpus_sources(),
        "multilabel_report": _multilabel_report(),
        "labelset_stats": _labelset_stats(),
        "resolve_models": _resolve_models(),
        "nb_report": _nb_report(),
        "logreg_report": _logreg_report(),
        "compare_models": _compare_models(),
        "stored_runs": RUN_METRICS.replace(
            "FROM rep\n", "FROM rep WHERE lr = CAST(1e-05 AS DOUBLE) AND seed IN (0, 1)\n"),
        "streamed_clf_report": CLF_REPORT,
        "long_qa_examples": _long_qa_examples(),
        "long_qa_labels": _long_qa_labels(),
        "long_qa_predictions": _long_qa_predictions(),
        "long_qa_scores": _long_qa_scores(),
    }
