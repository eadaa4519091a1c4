"""Score-side queries: thresholds, metrics, rankings, margins.

Bound to the deterministic ``scores`` view: reports with at least one kept
term, one row per (report, label).  A fixed 30 % of reports (by md5 of the
id) is the calibration part, where thresholds are tuned; metrics are read
on the remaining evaluation part.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import TERM_SEP, WS
from ..operators import metrics as M
from ..operators.features import ordered_index
from ..session import settle
from . import oracle as O
from . import views as V
from .catalog import query

CAL_SHARE = 0.3
WORST_K, TOP_ERRORS, RELIABILITY_TOPK = 5, 25, 6
TOPK_LABELS, HARD_TOP, HARD_PICK = 5, 30, 8
DIVERSE_TRUE_N = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12]
PREVIEW_N, PREVIEW_SEED = 10, 42


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- Spark bindings
def scored(spark, sf):
    """Long scores with their part, written once as Parquet in spark.checkpoint.dir: the tuner and
    the metrics read them in several branches (quantiles, min/max, grid counts, evaluation)."""
    r = V.reports(spark, sf).where(F.col("REAC_n_rows_symptom_v2") > 0).select("primaryid", *V.PARTS.y_cols)
    part = F.when(V.unit_hash("primaryid", F.lit("cal")) < CAL_SHARE, "cal").otherwise("eval")
    s = V.scores_from_labels(r.withColumn("part", part), "primaryid", V.PARTS.y_cols, ["part"])  # a report's part is found once, not for each label
    return settle(s.select("primaryid", "label", "y", "score", "part"), "scores")


def thresholds(spark, sf):
    s = scored(spark, sf)
    return M.tune_quantile(s.where(F.col("part") == "cal"))


def predictions(spark, sf):
    s = scored(spark, sf)
    thr = M.tune_quantile(s.where(F.col("part") == "cal"))
    return M.apply_thresholds(s.where(F.col("part") == "eval"), thr)


def conf_table(spark, sf):
    return M.confusion(predictions(spark, sf))


def report_text(spark, sf):
    return V.reports(spark, sf).select("primaryid", F.col(V.TEXT).alias("text"))


# ---------------------------------------------------------------- SQL
def dlit(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def dlist(xs) -> str:
    return "[" + ", ".join(dlit(x) for x in xs) + "]"


def prf_sql(tp: str, fp: str, fn: str) -> tuple[str, str, str]:
    p = f"(CASE WHEN {tp} + {fp} > 0 THEN CAST({tp} AS DOUBLE) / CAST({tp} + {fp} AS DOUBLE) ELSE 0.0 END)"
    r = f"(CASE WHEN {tp} + {fn} > 0 THEN CAST({tp} AS DOUBLE) / CAST({tp} + {fn} AS DOUBLE) ELSE 0.0 END)"
    f = f"(CASE WHEN {p} + {r} > 0 THEN 2.0 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    return p, r, f


_F1 = prf_sql("tp", "fp", "fn")[2]
N_FB = M.FALLBACK_STEPS - 1


#: From ``cal`` (where thresholds are tuned) and ``ev``, both (primaryid, label, y, score), to ``thr``, ``pred`` and ``conf``.
TUNING = f"""
qv AS (SELECT label, list_sort(list_distinct(quantile_cont(score, {dlist(M.QUANTILE_LEVELS)}))) AS qg,
              min(score) AS mn, max(score) AS mx FROM cal GROUP BY label),
qgrid AS (SELECT label, mx, CASE WHEN len(qg) >= {M.MIN_QUANTILE_GRID} THEN qg WHEN mn = mx THEN [mn]
              ELSE list_transform(range(0, {N_FB + 1}), lambda i: CASE WHEN i = {N_FB} THEN mx
                   ELSE mn + CAST(i AS DOUBLE) * ((mx - mn) / {dlit(N_FB)}) END) END AS g FROM qv),
qk AS (SELECT label, mx, unnest(g) AS thr, generate_subscripts(g, 1) AS k FROM qgrid),
qcnt AS (SELECT q.label, q.k, q.thr, sum(c.y) AS n_pos, count_if(c.y = 1 AND c.score >= q.thr) AS tp,
                count_if(c.y = 0 AND c.score >= q.thr) AS fp FROM qk q JOIN cal c ON c.label = q.label GROUP BY ALL),
qf AS (SELECT *, {_F1} AS f1 FROM (SELECT *, n_pos - tp AS fn FROM qcnt)),
thr AS (SELECT label, CASE WHEN n_pos > 0 THEN thr ELSE 1.0 END AS threshold,
               CASE WHEN n_pos > 0 THEN f1 ELSE 0.0 END AS best_f1
        FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, k) AS r FROM qf) WHERE r = 1),
pred AS (SELECT ev.primaryid, ev.label, ev.y, ev.score, coalesce(t.threshold, 0.5) AS threshold,
                CAST(ev.score >= coalesce(t.threshold, 0.5) AS INTEGER) AS pred FROM ev LEFT JOIN thr t ON ev.label = t.label),
conf0 AS (SELECT label, CAST(sum(y) AS BIGINT) AS support, count_if(y = 1 AND pred = 1) AS tp,
                 count_if(y = 0 AND pred = 1) AS fp, count_if(y = 1 AND pred = 0) AS fn, count_if(y = 0 AND pred = 0) AS tn,
                 max(threshold) AS threshold, avg(pred) * 100 AS pred_pos_rate_pct, avg(score) AS prob_mean
          FROM pred GROUP BY label),
conf AS (SELECT label, support, tp, fp, fn, tn, {prf_sql('tp', 'fp', 'fn')[0]} AS precision,
                {prf_sql('tp', 'fp', 'fn')[1]} AS recall, {_F1} AS f1, threshold, pred_pos_rate_pct, prob_mean FROM conf0)"""


def _base_sql() -> str:
    return O.scores_ctes() + f""",
sp AS (SELECT *, CASE WHEN {O.unit_hash('primaryid', "'cal'")} < {CAL_SHARE} THEN 'cal' ELSE 'eval' END AS part FROM scores),
cal AS (SELECT * FROM sp WHERE part = 'cal'),
ev AS (SELECT * FROM sp WHERE part = 'eval'),""" + TUNING + """,
rtext AS (SELECT primaryid, REAC_pt_symptom_v2 AS text FROM reports)"""


BASE = _base_sql()


def with_base(*more: str) -> str:
    return "WITH " + BASE + ("," + ",".join(more) if more else "") + "\n"


def _micro_macro_sql(src: str) -> str:
    p, r, f = prf_sql("tp", "fp", "fn")
    return f"""SELECT {p} AS micro_precision, {r} AS micro_recall, {f} AS micro_f1, macro_precision, macro_recall,
       macro_f1, n_labels FROM (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg(precision) AS macro_precision,
       avg(recall) AS macro_recall, avg(f1) AS macro_f1, count(*) AS n_labels FROM {src})"""


MM_COLS = ["micro_precision", "micro_recall", "micro_f1", "macro_precision", "macro_recall", "macro_f1"]


def _round_cols(cols, src="") -> str:
    return ", ".join(f"round({src}{c}, 6) AS {c}" for c in cols)


# ---------------------------------------------------------------- thresholds
@query("threshold_grid", with_base(f"""
gk AS (SELECT label, unnest({dlist(M.BASE_GRID)}) AS thr, generate_subscripts({dlist(M.BASE_GRID)}, 1) AS k
       FROM (SELECT DISTINCT label FROM cal)),
gc AS (SELECT g.label, g.k, g.thr, sum(c.y) AS n_pos, count_if(c.y = 1 AND c.score >= g.thr) AS tp,
              count_if(c.y = 0 AND c.score >= g.thr) AS fp FROM gk g JOIN cal c ON c.label = g.label GROUP BY ALL),
gf AS (SELECT *, {_F1} AS f1 FROM (SELECT *, n_pos - tp AS fn FROM gc))""") + """
SELECT label, round(CASE WHEN n_pos > 0 THEN thr ELSE 0.5 END, 6) AS threshold,
       round(CASE WHEN n_pos > 0 THEN f1 ELSE 0.0 END, 6) AS best_f1
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, k) AS r FROM gf) WHERE r = 1""", "S*")
def threshold_grid(spark, sf):
    """M7: per label the threshold of a 19-step grid (.05-.95) with max F1 on the calibration part."""
    s = scored(spark, sf).where(F.col("part") == "cal")
    return M.tune_grid(s).select("label", r6(F.col("threshold")).alias("threshold"), r6(F.col("best_f1")).alias("best_f1"))


@query("threshold_quantile", with_base() + "SELECT label, round(threshold, 6) AS threshold, round(best_f1, 6) AS best_f1 FROM thr",
       "S*")
def threshold_quantile(spark, sf):
    """M8: per label the best of 61 score quantiles (.01-.99) by F1 on the calibration part."""
    return thresholds(spark, sf).select("label", r6(F.col("threshold")).alias("threshold"),
                                        r6(F.col("best_f1")).alias("best_f1"))


@query("apply_thresholds", with_base() + """
SELECT primaryid, label, y, round(score, 6) AS score, round(threshold, 6) AS threshold, pred FROM pred""", "S*")
def apply_thresholds(spark, sf):
    """M9 + C6: pred = score >= tuned threshold of the label (by name; default 0.5) on the evaluation part."""
    p = predictions(spark, sf)
    return p.select("primaryid", "label", "y", r6(F.col("score")).alias("score"),
                    r6(F.col("threshold")).alias("threshold"), "pred")


# ---------------------------------------------------------------- metrics
CONF_FLOATS = ["precision", "recall", "f1", "threshold", "pred_pos_rate_pct", "prob_mean"]


@query("confusion_per_label", with_base() + f"""
SELECT label, support, tp, fp, fn, tn, {_round_cols(CONF_FLOATS)} FROM conf""", "S*")
def confusion_per_label(spark, sf):
    """Support, tp/fp/fn/tn, precision, recall, F1, threshold, predicted-positive %, mean score."""
    c = conf_table(spark, sf)
    return c.select("label", "support", "tp", "fp", "fn", "tn", *[r6(F.col(x)).alias(x) for x in CONF_FLOATS])


@query("micro_macro", with_base() + f"SELECT {_round_cols(MM_COLS)}, n_labels FROM ({_micro_macro_sql('conf')})",
       "S*")
def micro_macro(spark, sf):
    """Micro P/R/F1 from pooled counts, macro P/R/F1 as means over labels."""
    m = M.micro_macro(conf_table(spark, sf))
    return m.select(*[r6(F.col(c)).alias(c) for c in MM_COLS], "n_labels")


@query("brier_mean", with_base() + """
SELECT round(avg(brier), 6) AS brier_mean, count(*) AS n_labels
FROM (SELECT label, avg(power(y - score, 2)) AS brier FROM ev GROUP BY label)""", "S*")
def brier_mean(spark, sf):
    """Mean over labels of the Brier score on the evaluation part."""
    b = M.brier_mean(scored(spark, sf).where(F.col("part") == "eval"))
    return b.select(r6(F.col("brier_mean")).alias("brier_mean"), "n_labels")


@query("reliability_bins", with_base(f"""
top6 AS (SELECT label FROM conf ORDER BY support DESC, label LIMIT {RELIABILITY_TOPK})""") + f"""
SELECT label, CAST(bin AS INTEGER) AS bin, count(*) AS count, round(avg(score), 6) AS p_mean, round(avg(y), 6) AS y_rate
FROM (SELECT label, score, y, least(greatest(len(list_filter({dlist(M.RELIABILITY_EDGES)}, lambda e: e <= score)) - 1, 0),
                                    {len(M.RELIABILITY_EDGES) - 2}) AS bin
      FROM ev WHERE label IN (SELECT label FROM top6))
GROUP BY label, bin""", "S*")
def reliability_bins(spark, sf):
    """10-bin reliability table (count, mean score, positive rate) for the 6 best-supported labels."""
    s = scored(spark, sf).where(F.col("part") == "eval")
    top = conf_table(spark, sf).orderBy(F.desc("support"), "label").limit(RELIABILITY_TOPK)
    r = M.reliability_bins(s, top)
    return r.select("label", F.col("bin").cast("int").alias("bin"), "count", r6(F.col("p_mean")).alias("p_mean"),
                    r6(F.col("y_rate")).alias("y_rate"))


TOK_SQL = f"len(list_filter(string_split_regex(coalesce(text, ''), '{WS}+'), lambda w: w <> ''))"


def _token_bin_sql(n: str) -> str:
    whens = " ".join(f"WHEN {n} > {lo} AND {n} <= {hi} THEN '({lo}, {hi}]'"
                     for lo, hi in zip(M.TOKEN_BINS[:-1], M.TOKEN_BINS[1:]))
    return f"CASE {whens} END"


@query("slice_by_token_len", with_base(f"""
tb AS (SELECT primaryid, {_token_bin_sql(TOK_SQL)} AS token_bin FROM rtext),
pb AS (SELECT pred.*, tb.token_bin FROM pred JOIN tb ON pred.primaryid = tb.primaryid WHERE tb.token_bin IS NOT NULL),
big AS (SELECT token_bin, count(DISTINCT primaryid) AS rows FROM pb GROUP BY token_bin HAVING count(DISTINCT primaryid) >= 200),
lc AS (SELECT token_bin, label, count_if(y = 1 AND pred = 1) AS tp, count_if(y = 0 AND pred = 1) AS fp,
              count_if(y = 1 AND pred = 0) AS fn FROM pb GROUP BY token_bin, label),
lf AS (SELECT *, {_F1} AS f1 FROM lc),
agg AS (SELECT token_bin, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg(f1) AS macro_f1 FROM lf GROUP BY token_bin),
dens AS (SELECT token_bin, avg(t) AS avg_labels_true, avg(p) AS avg_labels_pred
         FROM (SELECT token_bin, primaryid, sum(y) AS t, sum(pred) AS p FROM pb GROUP BY token_bin, primaryid) GROUP BY token_bin)""") + f"""
SELECT big.token_bin, big.rows, round({_F1}, 6) AS micro_f1, round(macro_f1, 6) AS macro_f1,
       round(avg_labels_true, 6) AS avg_labels_true, round(avg_labels_pred, 6) AS avg_labels_pred
FROM big JOIN agg ON big.token_bin = agg.token_bin JOIN dens ON big.token_bin = dens.token_bin""", "S*")
def slice_by_token_len(spark, sf):
    """micro/macro F1 and mean true/predicted labels per token-length bin (bins of >= 200 reports)."""
    p = predictions(spark, sf)
    toks = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), WS + "+"), lambda w: w != ""))
    tb = report_text(spark, sf).select("primaryid", M.token_bin(toks).alias("token_bin")).where(
        F.col("token_bin").isNotNull())
    pb = p.join(tb, "primaryid")
    per_label = M.confusion(pb.withColumnRenamed("label", "_l").withColumn("label", F.struct("token_bin", "_l")))
    per_label = per_label.select(F.col("label.token_bin").alias("token_bin"), "tp", "fp", "fn", "f1")
    agg = per_label.groupBy("token_bin").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                                             F.avg("f1").alias("macro_f1"))
    _, _, micro = M.prf(F.col("tp"), F.col("fp"), F.col("fn"))
    rows = M.per_row_counts(pb.withColumn("_id", F.struct("token_bin", "primaryid")), "_id").groupBy(
        F.col("_id.token_bin").alias("token_bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("true_n").alias("avg_labels_true"),
        F.avg("pred_n").alias("avg_labels_pred")).where(F.col("rows") >= 200)
    return rows.join(agg, "token_bin").select(
        "token_bin", "rows", r6(micro).alias("micro_f1"), r6(F.col("macro_f1")).alias("macro_f1"),
        r6(F.col("avg_labels_true")).alias("avg_labels_true"), r6(F.col("avg_labels_pred")).alias("avg_labels_pred"))


@query("label_density", with_base("""
pr AS (SELECT primaryid, sum(y) AS t, sum(pred) AS p FROM pred GROUP BY primaryid)""") + """
SELECT count(*) AS rows, round(avg(t), 6) AS mean_true, round(quantile_cont(CAST(t AS DOUBLE), 0.95), 6) AS p95_true,
       round(avg(p), 6) AS mean_pred, round(quantile_cont(CAST(p AS DOUBLE), 0.95), 6) AS p95_pred FROM pr""", "S*")
def label_density(spark, sf):
    """Mean and p95 of true / predicted labels per report (evaluation part)."""
    r = M.per_row_counts(predictions(spark, sf), "primaryid")
    # percentile keeps a value -> count map; per-row label counts take at most n_labels + 1 values
    return r.agg(F.count(F.lit(1)).alias("rows"), r6(F.avg("true_n")).alias("mean_true"),
                 r6(F.percentile(F.col("true_n").cast("double"), 0.95)).alias("p95_true"),
                 r6(F.avg("pred_n")).alias("mean_pred"),
                 r6(F.percentile(F.col("pred_n").cast("double"), 0.95)).alias("p95_pred"))


# ---------------------------------------------------------------- rankings
@query("worst_best_labels", with_base() + f"""
SELECT kind, CAST(rank AS INTEGER) AS rank, label, round(f1, 6) AS f1 FROM (
  SELECT 'worst' AS kind, label, f1, row_number() OVER (ORDER BY f1, label) AS rank FROM conf
  UNION ALL
  SELECT 'best' AS kind, label, f1, row_number() OVER (ORDER BY f1 DESC, label) AS rank FROM conf) WHERE rank <= {WORST_K}""",
       "S*")
def worst_best_labels(spark, sf):
    """5 worst and 5 best labels by F1 (ties by label)."""
    c = conf_table(spark, sf).select("label", "f1")  # one row per label
    w = c.withColumn("rank", F.row_number().over(Window.orderBy("f1", "label"))).withColumn("kind", F.lit("worst"))
    b = c.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("f1"), "label"))).withColumn("kind", F.lit("best"))
    return (w.unionByName(b).where(F.col("rank") <= WORST_K)
            .select("kind", F.col("rank").cast("int").alias("rank"), "label", r6(F.col("f1")).alias("f1")))


@query("top_errors_per_label", with_base(f"""
worst AS (SELECT label FROM conf ORDER BY f1, label LIMIT {WORST_K}),
err AS (SELECT p.label, CASE WHEN p.pred = 1 THEN 'FP_high_prob' ELSE 'FN_low_prob' END AS error_type, p.primaryid, p.score
        FROM pred p WHERE p.label IN (SELECT label FROM worst) AND p.pred <> p.y),
rk AS (SELECT *, row_number() OVER (PARTITION BY label, error_type
           ORDER BY CASE WHEN error_type = 'FP_high_prob' THEN -score ELSE score END, primaryid) AS rank FROM err)""") + f"""
SELECT rk.label, rk.error_type, CAST(rk.rank AS INTEGER) AS rank, rk.primaryid, round(rk.score, 6) AS prob, t.text
FROM rk JOIN rtext t ON rk.primaryid = t.primaryid WHERE rk.rank <= {TOP_ERRORS}""", "S*")
def top_errors_per_label(spark, sf):
    """E2 + H9: for the 5 worst labels, 25 false positives with the highest scores and 25 false
    negatives with the lowest, stacked, with their text."""
    p = predictions(spark, sf)
    worst = conf_table(spark, sf).orderBy("f1", "label").limit(WORST_K).select("label")
    err = (p.join(F.broadcast(worst), "label", "left_semi").where(F.col("pred") != F.col("y"))
           .withColumn("error_type", F.when(F.col("pred") == 1, "FP_high_prob").otherwise("FN_low_prob")))
    key = F.when(F.col("error_type") == "FP_high_prob", -F.col("score")).otherwise(F.col("score"))
    w = Window.partitionBy("label", "error_type").orderBy(key, "primaryid")
    top = err.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP_ERRORS)
    return top.join(report_text(spark, sf), "primaryid").select(
        "label", "error_type", F.col("rank").cast("int").alias("rank"), "primaryid",
        r6(F.col("score")).alias("prob"), "text")


def _fmt_sql(lab: str, score: str, thr: str) -> str:
    return f"printf('%s:%.3f(thr=%.3f)', {lab}, {score}, {thr})"


TOPK_SQL = f"""
tk AS (SELECT primaryid, string_agg({_fmt_sql('label', 'score', 'threshold')}, '; ' ORDER BY score DESC, label)
              FILTER (WHERE r <= {TOPK_LABELS}) AS top{TOPK_LABELS}, max(score) AS confidence_max
       FROM (SELECT *, row_number() OVER (PARTITION BY primaryid ORDER BY score DESC, label) AS r FROM pred)
       GROUP BY primaryid)"""


@query("topk_labels_per_row", with_base(TOPK_SQL) + f"""
SELECT primaryid, top{TOPK_LABELS}, round(confidence_max, 6) AS confidence_max FROM tk""", "S*")
def topk_labels_per_row(spark, sf):
    """Per report the 5 highest-scoring labels as name:score(thr=threshold), and the max score."""
    t = M.topk_labels(predictions(spark, sf), "primaryid", TOPK_LABELS)
    return t.select("primaryid", f"top{TOPK_LABELS}", r6(F.col("confidence_max")).alias("confidence_max"))


MARGIN_SQL = """
mg AS (SELECT primaryid, least(pos_margin, coalesce(-maxf, 'inf'::DOUBLE)) AS overall_margin, pos_margin,
              coalesce(-maxf, 'inf'::DOUBLE) AS neg_margin, true_n, pred_n
       FROM (SELECT primaryid, min(CASE WHEN y = 1 THEN score - threshold END) AS pos_margin,
                    max(CASE WHEN y = 0 THEN score - threshold END) AS maxf,
                    CAST(sum(y) AS BIGINT) AS true_n, CAST(sum(pred) AS BIGINT) AS pred_n FROM pred GROUP BY primaryid)
       WHERE true_n > 0)"""
MARGIN_COLS = ["overall_margin", "pos_margin", "neg_margin"]


@query("margin_terms", with_base() + """
SELECT primaryid, label, round(score - threshold, 6) AS delta FROM pred""", "S*")
def margin_terms(spark, sf):
    """delta = score - threshold per (report, label)."""
    p = predictions(spark, sf)
    return p.select("primaryid", "label", r6(F.col("score") - F.col("threshold")).alias("delta"))


@query("case_margins", with_base(MARGIN_SQL) + f"""
SELECT primaryid, {_round_cols(MARGIN_COLS)}, true_n, pred_n FROM mg""", "S*")
def case_margins(spark, sf):
    """Per report with a true label, positive / negative / overall margin to the thresholds."""
    m = M.case_margins(predictions(spark, sf), "primaryid")
    return m.select("primaryid", *[r6(F.col(c)).alias(c) for c in MARGIN_COLS], "true_n", "pred_n")


def hard_cases(spark, sf):
    p = predictions(spark, sf).checkpoint(eager=True)  # read by three branches
    m = M.case_margins(p, "primaryid")
    hard = m.orderBy("overall_margin", "primaryid").limit(HARD_TOP)  # partial top-k per task
    sets = M.label_sets(p.join(hard.select("primaryid"), "primaryid", "left_semi"), "primaryid")
    top = M.topk_labels(p.join(hard.select("primaryid"), "primaryid", "left_semi"), "primaryid", TOPK_LABELS)
    return hard.join(sets, "primaryid").join(top, "primaryid").join(report_text(spark, sf), "primaryid")


@query("hard_case_topn", with_base(MARGIN_SQL, TOPK_SQL, f"""
hard AS (SELECT * FROM mg ORDER BY overall_margin, primaryid LIMIT {HARD_TOP}),
sets AS (SELECT primaryid, array_to_string(list_sort(list(label) FILTER (WHERE y = 1)), '; ') AS true_labels,
                coalesce(array_to_string(list_sort(list(label) FILTER (WHERE pred = 1)), '; '), '') AS pred_labels
         FROM pred WHERE primaryid IN (SELECT primaryid FROM hard) GROUP BY primaryid)""") + f"""
SELECT h.primaryid, {_round_cols(MARGIN_COLS, 'h.')}, h.true_n, h.pred_n, s.true_labels, s.pred_labels,
       tk.top{TOPK_LABELS}, CAST(length(t.text) AS INTEGER) AS text_len
FROM hard h JOIN sets s ON h.primaryid = s.primaryid JOIN tk ON h.primaryid = tk.primaryid
     JOIN rtext t ON h.primaryid = t.primaryid""", "S*")
def hard_case_topn(spark, sf):
    """The 30 reports with the smallest overall margin, with true/predicted labels and top-5."""
    h = hard_cases(spark, sf)
    return h.select("primaryid", *[r6(F.col(c)).alias(c) for c in MARGIN_COLS], "true_n", "pred_n",
                    F.array_join("true_labels", TERM_SEP).alias("true_labels"),
                    F.array_join("pred_labels", TERM_SEP).alias("pred_labels"), f"top{TOPK_LABELS}",
                    F.length("text").cast("int").alias("text_len"))


def _diverse_rank_sql() -> str:
    order = ", ".join(str(n) for n in DIVERSE_TRUE_N)
    return f"""
hard AS (SELECT *, row_number() OVER (ORDER BY overall_margin, primaryid) AS hrank FROM mg
         ORDER BY overall_margin, primaryid LIMIT {HARD_TOP}),
tfirst AS (SELECT primaryid, list_position([{order}], true_n) AS tpos FROM
           (SELECT *, row_number() OVER (PARTITION BY true_n ORDER BY hrank) AS r FROM hard)
           WHERE r = 1 AND true_n IN ({order})),
prio AS (SELECT h.primaryid, h.true_n, round(h.overall_margin, 6) AS overall_margin,
                CASE WHEN f.tpos IS NOT NULL THEN f.tpos ELSE 1000 + h.hrank END AS pkey
         FROM hard h LEFT JOIN tfirst f ON h.primaryid = f.primaryid)"""


@query("diverse_pick", with_base(MARGIN_SQL, _diverse_rank_sql()) + f"""
SELECT CAST(row_number() OVER (ORDER BY pkey) AS INTEGER) AS pick, primaryid, true_n, overall_margin
FROM prio ORDER BY pkey LIMIT {HARD_PICK}""", "S*")
def diverse_pick(spark, sf):
    """E5: from the 30 hardest, the hardest report per true-label count (1..10, 12), then fill by margin to 8."""
    m = M.case_margins(predictions(spark, sf), "primaryid")
    hard = m.orderBy("overall_margin", "primaryid").limit(HARD_TOP)  # <= 30 rows from here on
    hard = hard.withColumn("hrank", F.row_number().over(Window.orderBy("overall_margin", "primaryid")))
    order = F.array(*[F.lit(n) for n in DIVERSE_TRUE_N])
    first = (hard.withColumn("_r", F.row_number().over(Window.partitionBy("true_n").orderBy("hrank")))
             .where((F.col("_r") == 1) & F.col("true_n").isin(DIVERSE_TRUE_N))
             .select("primaryid", F.array_position(order, F.col("true_n")).alias("tpos")))
    prio = hard.join(first, "primaryid", "left").withColumn(
        "pkey", F.coalesce(F.col("tpos"), F.lit(1000) + F.col("hrank")))
    top = prio.orderBy("pkey").limit(HARD_PICK)
    return top.select(F.row_number().over(Window.orderBy("pkey")).cast("int").alias("pick"), "primaryid", "true_n",
                      r6(F.col("overall_margin")).alias("overall_margin"))


@query("label_set_diff", with_base("""
ls AS (SELECT primaryid, list_sort(list(label) FILTER (WHERE y = 1)) AS t, list_sort(list(label) FILTER (WHERE pred = 1)) AS p
       FROM pred GROUP BY primaryid)""") + """
SELECT primaryid, coalesce(array_to_string(list_filter(t, lambda x: list_contains(p, x)), '; '), '') AS overlap,
       coalesce(array_to_string(list_filter(t, lambda x: NOT list_contains(coalesce(p, []), x)), '; '), '') AS missing_true,
       coalesce(array_to_string(list_filter(p, lambda x: NOT list_contains(coalesce(t, []), x)), '; '), '') AS extra_pred
FROM ls""")
def label_set_diff(spark, sf):
    """H8: per report, labels both true and predicted, true but missed, predicted but not true."""
    s = M.label_sets(predictions(spark, sf), "primaryid")
    t, p = F.col("true_labels"), F.col("pred_labels")
    return s.select("primaryid", F.array_join(F.array_sort(F.array_intersect(t, p)), TERM_SEP).alias("overlap"),
                    F.array_join(F.array_sort(F.array_except(t, p)), TERM_SEP).alias("missing_true"),
                    F.array_join(F.array_sort(F.array_except(p, t)), TERM_SEP).alias("extra_pred"))


@query("largest_reports", O.with_(O.reports_ctes()) + """
SELECT primaryid, CAST(DRUG_n_rows AS BIGINT) AS DRUG_n_rows, CAST(rank AS INTEGER) AS rank FROM (
  SELECT primaryid, DRUG_n_rows, row_number() OVER (ORDER BY DRUG_n_rows DESC, primaryid) AS rank
  FROM reports_raw WHERE DRUG_n_rows IS NOT NULL) WHERE rank <= 10""")
def largest_reports(spark, sf):
    """The 10 reports with the most child rows (ties by id)."""
    r = V.reports_raw(spark, sf, (), ("DRUG_n_rows",)).where(F.col("DRUG_n_rows").isNotNull())
    top = r.orderBy(F.desc("DRUG_n_rows"), "primaryid").limit(10)  # TakeOrderedAndProject
    return top.select("primaryid", F.col("DRUG_n_rows").cast("long").alias("DRUG_n_rows"),
                      F.row_number().over(Window.orderBy(F.desc("DRUG_n_rows"), "primaryid")).cast("int").alias("rank"))


@query("random_preview", with_base(TOPK_SQL, f"""
pv AS (SELECT DISTINCT primaryid FROM pred ORDER BY md5('{PREVIEW_SEED}|' || CAST(primaryid AS VARCHAR)), primaryid
       LIMIT {PREVIEW_N})""") + f"""
SELECT pv.primaryid, r.y_labels, tk.top{TOPK_LABELS}, r.REAC_pt_symptom_v2 AS text, r.o_orderpriority
FROM pv JOIN tk ON pv.primaryid = tk.primaryid JOIN reports r ON pv.primaryid = r.primaryid""")
def random_preview(spark, sf):
    """E11 + C7: 10 evaluation reports picked by a seeded hash, with true labels, top-5 and raw text/metadata."""
    p = predictions(spark, sf)
    ids = p.select("primaryid").distinct()
    pick = ids.orderBy(F.md5(F.concat_ws("|", F.lit(str(PREVIEW_SEED)), F.col("primaryid").cast("string"))),
                       "primaryid").limit(PREVIEW_N)
    top = M.topk_labels(p.join(pick, "primaryid", "left_semi"), "primaryid", TOPK_LABELS)
    r = V.reports(spark, sf).select("primaryid", "y_labels", F.col(V.TEXT).alias("text"), "o_orderpriority")
    return pick.join(top, "primaryid").join(r, "primaryid").select(
        "primaryid", "y_labels", f"top{TOPK_LABELS}", "text", "o_orderpriority")


@query("rules_broadcast", with_base("""
tuned AS (SELECT label, threshold FROM thr WHERE best_f1 > 0),
rule AS (SELECT l.label, coalesce(t.threshold, 0.5) AS threshold, CASE WHEN t.label IS NULL THEN 'default' ELSE 'tuned' END AS origin
         FROM (SELECT DISTINCT label FROM ev) l LEFT JOIN tuned t ON l.label = t.label)""") + """
SELECT rule.label, round(any_value(rule.threshold), 6) AS threshold, any_value(origin) AS origin,
       count(*) AS n_reports, count_if(ev.score >= rule.threshold) AS n_pred
FROM ev JOIN rule ON ev.label = rule.label GROUP BY rule.label""", "S*")
def rules_broadcast(spark, sf):
    """Thresholds matched to the scores by label name; a label for which no threshold reached an F1 above 0 takes 0.5."""
    s = scored(spark, sf)
    tuned = M.tune_quantile(s.where(F.col("part") == "cal")).where(F.col("best_f1") > 0)
    return M.thresholds_in_use(s.where(F.col("part") == "eval"), tuned).select(
        "label", r6(F.col("threshold")).alias("threshold"), "origin", "n_reports", "n_pred")


@query("stack_errors", with_base() + """
SELECT 'FP' AS error_type, label, primaryid, round(score, 6) AS prob, round(threshold, 6) AS threshold FROM pred WHERE pred = 1 AND y = 0
UNION ALL
SELECT 'FN', label, primaryid, round(score, 6), round(threshold, 6) FROM pred WHERE pred = 0 AND y = 1""", "S*")
def stack_errors(spark, sf):
    """H9: the false positives and the false negatives of all labels in one table."""
    p = predictions(spark, sf)

    def errors(kind, pred):
        return p.where((F.col("pred") == pred) & (F.col("y") == 1 - pred)).select(
            F.lit(kind).alias("error_type"), "label", "primaryid", r6(F.col("score")).alias("prob"), r6(F.col("threshold")).alias("threshold"))
    return errors("FP", 1).unionByName(errors("FN", 0))


@query("pred_vs_raw_text", with_base("""
said AS (SELECT primaryid, coalesce(string_agg(label, '; ' ORDER BY label) FILTER (WHERE pred = 1), '') AS pred_labels FROM pred GROUP BY primaryid)""") + """
SELECT said.primaryid, r.y_labels, said.pred_labels, r.REAC_pt_symptom_v2 AS text, r.o_orderpriority
FROM said JOIN reports r ON said.primaryid = r.primaryid""", "S*")
def pred_vs_raw_text(spark, sf):
    """The predicted labels of every evaluation report beside its true labels, raw text and metadata."""
    said = predictions(spark, sf).groupBy("primaryid").agg(
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("pred") == 1, F.col("label")))), "; ").alias("pred_labels"))  # one row per label
    r = V.reports(spark, sf).select("primaryid", "y_labels", F.col(V.TEXT).alias("text"), "o_orderpriority")
    return said.join(r, "primaryid").select("primaryid", "y_labels", "pred_labels", "text", "o_orderpriority")


# ---------------------------------------------------------------- controls and leaderboard
def _shuffled_y(spark, sf):
    """Labels of the next report in a seeded hash order (cyclic): the shuffled-label control."""
    s = scored(spark, sf).where(F.col("part") == "eval")
    ids = s.select("primaryid").distinct().withColumn("_h", F.md5(F.concat_ws("|", F.lit("shuffle"),
                                                                              F.col("primaryid").cast("string"))))
    ranked = ordered_index(ids, "_h", F.substring("_h", 1, 2), "_rank")  # exact rank, no single-task sort
    n = ids.count()
    # the report at rank r takes the labels of the report at rank r + 1 (mod n)
    nxt = ranked.select(F.col("primaryid").alias("_src"), ((F.col("_rank") - 1 + F.lit(n)) % F.lit(n)).alias("_rank"))
    pairs = ranked.join(nxt, "_rank").select("primaryid", "_src")
    y2 = s.select(F.col("primaryid").alias("_src"), "label", F.col("y").alias("_y2"))
    return s.join(pairs, "primaryid").join(y2, ["_src", "label"]).select(
        "primaryid", "label", F.col("_y2").alias("y"), "score", "part")


def model_metrics(spark, sf):
    """One row per (stage, model): val = calibration part, test = evaluation part."""
    s = scored(spark, sf)  # checkpointed; read by eight branches
    cal, ev = s.where(F.col("part") == "cal"), s.where(F.col("part") == "eval")
    ones = cal.select("label").distinct()
    variants = {
        ("baseline", "fixed_0.5"): ones.withColumn("threshold", F.lit(0.5)),
        ("baseline", "always_0"): ones.withColumn("threshold", F.lit(float("inf"))),
        ("tuned", "grid"): M.tune_grid(cal),
        ("tuned", "quantile"): M.tune_quantile(cal),
    }
    out = None
    for (stage, model), thr in variants.items():
        row = None
        for part, df in (("val", cal), ("test", ev)):
            mm = M.micro_macro(M.confusion(M.apply_thresholds(df, thr))).select(
                F.col("micro_f1").alias(f"{part}_micro_f1"), F.col("macro_f1").alias(f"{part}_macro_f1"))
            row = mm if row is None else row.crossJoin(mm)  # one-row frames
        row = row.select(F.lit(stage).alias("stage"), F.lit(model).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out


MODEL_VARIANTS = [("baseline", "fixed_0.5", "0.5"), ("baseline", "always_0", "'inf'::DOUBLE")]


def _mm_sql() -> str:
    parts = []
    thr_srcs = {("baseline", "fixed_0.5"): "SELECT DISTINCT label, 0.5 AS threshold FROM cal",
                ("baseline", "always_0"): "SELECT DISTINCT label, 'inf'::DOUBLE AS threshold FROM cal",
                ("tuned", "grid"): "SELECT label, CASE WHEN n_pos > 0 THEN thr ELSE 0.5 END AS threshold FROM "
                                   "(SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, k) AS r FROM gf) WHERE r = 1",
                ("tuned", "quantile"): "SELECT label, threshold FROM thr"}
    p, r, f = prf_sql("tp", "fp", "fn")
    for (stage, model), t in thr_srcs.items():
        cols = []
        for part, src in (("val", "cal"), ("test", "ev")):
            c = (f"(SELECT {f} FROM (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM lcm)) AS {part}_micro_f1, "
                 f"(SELECT avg({f}) FROM lcm) AS {part}_macro_f1")
            lc = (f"SELECT s.label, count_if(s.y = 1 AND s.score >= t.threshold) AS tp, "
                  f"count_if(s.y = 0 AND s.score >= t.threshold) AS fp, count_if(s.y = 1 AND s.score < t.threshold) AS fn "
                  f"FROM {src} s JOIN ({t}) t ON s.label = t.label GROUP BY s.label")
            cols.append(c.replace("FROM lcm", f"FROM ({lc})"))
        parts.append(f"SELECT '{stage}' AS stage, '{model}' AS model, {', '.join(cols)}")
    return " UNION ALL ".join(parts)


MM_SQL = with_base(f"""
gk AS (SELECT label, unnest({dlist(M.BASE_GRID)}) AS thr, generate_subscripts({dlist(M.BASE_GRID)}, 1) AS k
       FROM (SELECT DISTINCT label FROM cal)),
gc AS (SELECT g.label, g.k, g.thr, sum(c.y) AS n_pos, count_if(c.y = 1 AND c.score >= g.thr) AS tp,
              count_if(c.y = 0 AND c.score >= g.thr) AS fp FROM gk g JOIN cal c ON c.label = g.label GROUP BY ALL),
gf AS (SELECT *, {_F1} AS f1 FROM (SELECT *, n_pos - tp AS fn FROM gc))""")
#: Stages whose best model is chosen by validation; the others go by test.
CHOOSE_BY_VAL = ["tuned"]
LB_COLS = ["val_micro_f1", "val_macro_f1", "test_micro_f1", "test_macro_f1"]


@query("leaderboard", MM_SQL + f"""
SELECT CAST(row_number() OVER (ORDER BY val_micro_f1 DESC, val_macro_f1 DESC, stage, model) AS INTEGER) AS rank,
       stage, model, {_round_cols(LB_COLS)} FROM ({_mm_sql()})""", "S*")
def leaderboard(spark, sf):
    """E6 + M13: threshold strategies (fixed .5, always-0 control, grid, quantile) ranked by val micro then macro F1."""
    m = model_metrics(spark, sf)  # 4 rows
    w = Window.orderBy(F.desc("val_micro_f1"), F.desc("val_macro_f1"), "stage", "model")
    return m.select(F.row_number().over(w).cast("int").alias("rank"), "stage", "model",
                    *[r6(F.col(c)).alias(c) for c in LB_COLS])


@query("best_of_stage", MM_SQL + f"""
SELECT stage, model, {_round_cols(LB_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY stage ORDER BY CASE WHEN stage IN ('tuned') THEN val_micro_f1
                               ELSE coalesce(test_micro_f1, val_micro_f1) END DESC, model) AS r
  FROM ({_mm_sql()})) WHERE r = 1""", "S*")
def best_of_stage(spark, sf):
    """Best model per stage: by val micro F1 in the stages that choose by validation, else by test when present."""
    m = model_metrics(spark, sf)
    chosen = F.when(F.col("stage").isin(CHOOSE_BY_VAL), F.col("val_micro_f1")).otherwise(F.coalesce("test_micro_f1", "val_micro_f1"))
    w = Window.partitionBy("stage").orderBy(chosen.desc(), "model")
    return m.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "stage", "model", *[r6(F.col(c)).alias(c) for c in LB_COLS])


@query("mark_extremes", MM_SQL + f"""
SELECT stage, model, metric, round(value, 6) AS value,
       round(value, 9) = round(max(value) OVER (PARTITION BY metric), 9) AS is_max,
       round(value, 9) = round(min(value) OVER (PARTITION BY metric), 9) AS is_min,
       round(value, 9) = round(max(value) OVER (PARTITION BY stage, metric), 9) AS is_stage_max,
       round(value, 9) = round(min(value) OVER (PARTITION BY stage, metric), 9) AS is_stage_min
FROM (UNPIVOT ({_mm_sql()}) ON {', '.join(LB_COLS)} INTO NAME metric VALUE value)""", "S*")
def mark_extremes(spark, sf):
    """Per metric, flag the models holding the column maximum and minimum, over all stages and inside each."""
    m = model_metrics(spark, sf)
    long = m.select("stage", "model", F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in LB_COLS])).alias("m")).select(
        "stage", "model", "m.metric", "m.value")
    marks = []
    for prefix, w in (("is_", Window.partitionBy("metric")), ("is_stage_", Window.partitionBy("stage", "metric"))):
        marks += [(F.round("value", 9) == F.round(f("value").over(w), 9)).alias(prefix + name) for name, f in (("max", F.max), ("min", F.min))]
    return long.select("stage", "model", "metric", r6(F.col("value")).alias("value"), *marks)


@query("majority_and_shuffle_controls", with_base("""
ids AS (SELECT DISTINCT primaryid FROM ev),
rk AS (SELECT primaryid, row_number() OVER (ORDER BY md5('shuffle|' || CAST(primaryid AS VARCHAR))) - 1 AS rnk,
              count(*) OVER () AS n FROM ids),
pairs AS (SELECT a.primaryid, b.primaryid AS src FROM rk a JOIN rk b ON b.rnk = (a.rnk + 1) % a.n),
sh AS (SELECT e.primaryid, e.label, e2.y, e.score FROM ev e JOIN pairs p ON e.primaryid = p.primaryid
       JOIN ev e2 ON e2.primaryid = p.src AND e2.label = e.label),
lc AS (SELECT s.label, count_if(s.y = 1 AND s.score >= t.threshold) AS tp, count_if(s.y = 0 AND s.score >= t.threshold) AS fp,
              count_if(s.y = 1 AND s.score < t.threshold) AS fn FROM sh s JOIN thr t ON s.label = t.label GROUP BY s.label)""") + f"""
SELECT round({_F1}, 6) AS micro_f1, (SELECT round(avg({_F1}), 6) FROM lc) AS macro_f1,
       (SELECT round({_F1}, 6) FROM (SELECT count_if(y = 1 AND score >= 'inf'::DOUBLE) AS tp, count_if(y = 0 AND score >= 'inf'::DOUBLE) AS fp,
                                            count_if(y = 1 AND score < 'inf'::DOUBLE) AS fn FROM ev)) AS majority_micro_f1
FROM (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM lc)""", "S*")
def majority_and_shuffle_controls(spark, sf):
    """micro/macro F1 of the tuned thresholds against labels shuffled across reports, and the always-0 control."""
    sh = _shuffled_y(spark, sf)
    thr = thresholds(spark, sf)
    mm = M.micro_macro(M.confusion(M.apply_thresholds(sh, thr)))
    ev = scored(spark, sf).where(F.col("part") == "eval")
    never = thr.select("label", F.lit(float("inf")).alias("threshold"))  # no score reaches it
    zero = M.micro_macro(M.confusion(M.apply_thresholds(ev, never))).select(r6(F.col("micro_f1")).alias("majority_micro_f1"))
    return mm.select(r6(F.col("micro_f1")).alias("micro_f1"), r6(F.col("macro_f1")).alias("macro_f1")).crossJoin(zero)  # one row each
