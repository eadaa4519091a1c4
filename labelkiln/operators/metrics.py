"""Score-side operators on long scores ``(id, label, y, score)``.

Scale notes
-----------
* Thresholds are tuned from per-(label, grid bucket) histograms: each
  score is mapped to "how many grid thresholds are <= score" and counted
  map-side, so the shuffle carries labels x grid rows, not scores.
* Exact quantiles never hold one label's scores in one task: values are
  first collapsed to (value, count) pairs, then cut into buckets at
  ``percentile_approx`` boundaries (a mergeable sketch); exact ranks are
  prefix sums of per-bucket counts plus a running sum inside a bucket.
* Per-row label sets are bounded by the number of labels, so per-id
  aggregates (``collect_list`` of a row's labels) are bounded.
* Top-k per group uses ``row_number() <= k``; Spark plans it with a
  partial ``WindowGroupLimit`` before the exchange, so a hot label ships
  only k rows per map task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

# threshold grids and quantile levels are generated from the reference's parameters
BASE_GRID = [float(x) for x in np.linspace(0.05, 0.95, 19)]      # fixed grid search
QUANTILE_LEVELS = [float(x) for x in np.linspace(0.01, 0.99, 61)]  # quantile grid search
FALLBACK_STEPS = 31          # even steps min..max when the quantile grid has < 10 values
MIN_QUANTILE_GRID = 10
RELIABILITY_EDGES = [float(x) for x in np.linspace(0, 1, 11)]
TOKEN_BINS = [0, 1, 2, 3, 5, 8, 12, 20, 999]


def _arr(xs) -> Column:
    return F.array(*[F.lit(float(x)) for x in xs])


def count_le(grid: Column, x: Column) -> Column:
    """Number of grid values <= x (grid sorted ascending): the bucket of x."""
    return F.size(F.filter(grid, lambda t: t <= x))


def coarse_of(grid: Column, step: int) -> Column:
    """Every ``step``-th value of a sorted grid (built once per grid row, not per data row)."""
    return F.filter(grid, lambda t, i: (i + 1) % step == 0)


def count_le_2level(grid: Column, coarse: Column, step: int, x: Column) -> Column:
    """count_le in ~2 * step comparisons: whole coarse blocks below x, then one block.

    Lambdas run interpreted, so a per-row scan of a long grid is the cost
    that matters; c coarse values <= x means the first c * step grid
    values are <= x and the (c+1)-th coarse value is not.
    """
    c = F.size(F.filter(coarse, lambda t: t <= x))
    return c * step + F.size(F.filter(F.slice(grid, c * step + 1, step - 1), lambda t: t <= x))


def prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """precision, recall, F1 from counts; 0 where undefined (zero_division=0)."""
    tp, fp, fn = (c.cast("double") for c in (tp, fp, fn))
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f = F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))
    return p, r, f


# ---------------------------------------------------------------- exact quantiles
def exact_quantiles(df: DataFrame, keys: list[str], value: str, levels: list[float],
                    n_buckets: int = 1024) -> DataFrame:
    """(keys..., q_idx, level, q) -- linear interpolation between order statistics
    at position level * (n - 1), as numpy / Spark ``percentile``."""
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    v = F.col(value).cast("double")
    vc = df.where(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    step = 32
    bnd = vc.groupBy(*keys).agg(F.percentile_approx("_v", probs, 10 * n_buckets).alias("_bnd"),
                                F.sum("_c").alias("_n"))
    bnd = bnd.withColumn("_coarse", coarse_of(F.col("_bnd"), step))
    # one row per key: a key is a label or a split, never a data-sized set
    b = vc.join(F.broadcast(bnd.select(*keys, "_bnd", "_coarse")), keys).select(
        *keys, "_v", "_c", count_le_2level(F.col("_bnd"), F.col("_coarse"), step, F.col("_v")).alias("_b"))
    b = settle(b, "quantile-buckets")  # the histogram and the ranks read it; a value's bucket is the dear part
    hist = b.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
    wk = Window.partitionBy(*keys).orderBy("_b")
    offs = hist.select(*keys, "_b", "_bc",
                       F.coalesce(F.sum("_bc").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias("_off"))
    # ranks needed by each level, and the bucket holding each rank
    lv = F.array(*[F.struct(F.lit(i).alias("q_idx"), F.lit(q).alias("level")) for i, q in enumerate(levels)])
    need = bnd.select(*keys, "_n", F.explode(lv).alias("l")).select(
        *keys, "_n", "l.q_idx", "l.level", (F.col("l.level") * (F.col("_n") - 1)).alias("_pos"))
    need = need.select("*", F.floor("_pos").cast("bigint").alias("_r0"),
                       F.ceil("_pos").cast("bigint").alias("_r1"))
    ranks = (need.select(*keys, F.explode(F.array("_r0", "_r1")).alias("_r")).distinct()
             .join(offs, keys).where((F.col("_r") >= F.col("_off")) & (F.col("_r") < F.col("_off") + F.col("_bc")))
             .select(*keys, "_b", "_r"))
    wv = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cum = (b.join(F.broadcast(ranks.select(*keys, "_b").distinct()), keys + ["_b"], "left_semi")
           .join(F.broadcast(offs.select(*keys, "_b", "_off")), keys + ["_b"])
           .select(*keys, "_b", "_v", (F.col("_off") + F.sum("_c").over(wv)).alias("_hi"), "_c"))
    at = (cum.join(F.broadcast(ranks), keys + ["_b"])
          .where((F.col("_r") >= F.col("_hi") - F.col("_c")) & (F.col("_r") < F.col("_hi")))
          .select(*keys, "_r", "_v"))
    lo = at.select(*keys, F.col("_r").alias("_r0"), F.col("_v").alias("_v0"))
    hi = at.select(*keys, F.col("_r").alias("_r1"), F.col("_v").alias("_v1"))
    out = need.join(lo, keys + ["_r0"]).join(hi, keys + ["_r1"])
    q = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("_pos") - F.col("_r0"))
    out = out.select(*keys, "q_idx", "level", q.alias("q"))
    return out.drop("_all") if keys == ["_all"] else out


# ---------------------------------------------------------------- thresholds
def counts_at_grid(scores: DataFrame, grid: DataFrame) -> DataFrame:
    """(label, k, thr, n, n_pos, tp, fp, fn) for pred = score >= thr at each grid point.

    ``grid`` is (label, grid array<double> sorted ascending), one row per label.
    """
    step = 8
    gr = grid.select("label", "grid", coarse_of(F.col("grid"), step).alias("_coarse"))
    g = scores.join(F.broadcast(gr), "label").select(
        "label", F.col("y").cast("long").alias("y"),
        count_le_2level(F.col("grid"), F.col("_coarse"), step, F.col("score")).alias("_g"))
    h = g.groupBy("label", "_g").agg(F.sum("y").alias("_p"), F.count(F.lit(1)).alias("_c"))
    gk = grid.select("label", F.posexplode("grid").alias("_k0", "thr"))
    j = gk.join(h, "label")
    ge = F.col("_g") >= F.col("_k0") + 1
    out = j.groupBy("label", "_k0", "thr").agg(
        F.sum("_c").alias("n"), F.sum("_p").alias("n_pos"),
        F.sum(F.when(ge, F.col("_p")).otherwise(0)).alias("tp"),
        F.sum(F.when(ge, F.col("_c") - F.col("_p")).otherwise(0)).alias("fp"))
    return out.select("label", (F.col("_k0") + 1).alias("k"), "thr", "n", "n_pos", "tp", "fp",
                      (F.col("n_pos") - F.col("tp")).alias("fn"))


def best_threshold(counts: DataFrame, no_pos_thr: Column) -> DataFrame:
    """(label, threshold, best_f1): max F1, first (smallest) threshold on ties;
    labels without positives get ``no_pos_thr`` (may use column ``max_score``) and F1 0."""
    _, _, f1 = prf(F.col("tp"), F.col("fp"), F.col("fn"))
    w = Window.partitionBy("label").orderBy(F.desc("f1"), "k")  # labels x grid rows: small
    best = (counts.withColumn("f1", f1).withColumn("_np", no_pos_thr)
            .withColumn("_r", F.row_number().over(w)).where("_r = 1"))
    return best.select("label", F.when(F.col("n_pos") > 0, F.col("thr")).otherwise(F.col("_np")).alias("threshold"),
                       F.when(F.col("n_pos") > 0, F.col("f1")).otherwise(F.lit(0.0)).alias("best_f1"))


def tune_grid(scores: DataFrame, grid: list[float] = BASE_GRID) -> DataFrame:
    """M7: fixed grid; no positives -> 0.5."""
    labels = scores.select("label").distinct().withColumn("grid", _arr(grid))
    return best_threshold(counts_at_grid(scores, labels), F.lit(0.5))


def quantile_grid(scores: DataFrame, levels: list[float] = QUANTILE_LEVELS) -> DataFrame:
    """(label, grid, max_score): distinct quantiles of the scores; fewer than 10 distinct
    values -> 31 even steps from min to max (a single value when min = max)."""
    q = exact_quantiles(scores, ["label"], "score", levels)
    dq = q.groupBy("label").agg(F.array_sort(F.collect_set("q")).alias("_qg"))  # <= len(levels) per label
    mm = scores.groupBy("label").agg(F.min("score").alias("_mn"), F.max("score").alias("max_score"))
    n = FALLBACK_STEPS - 1
    step = (F.col("max_score") - F.col("_mn")) / F.lit(float(n))
    even = F.transform(F.sequence(F.lit(0), F.lit(n)),
                       lambda i: F.when(i == n, F.col("max_score")).otherwise(F.col("_mn") + i * step))
    fallback = F.when(F.col("_mn") == F.col("max_score"), F.array(F.col("_mn"))).otherwise(even)
    return dq.join(mm, "label").select(
        "label", F.when(F.size("_qg") < MIN_QUANTILE_GRID, fallback).otherwise(F.col("_qg")).alias("grid"),
        "max_score")


def tune_quantile(scores: DataFrame, proba: bool = True) -> DataFrame:
    """M8: quantile grid; no positives -> 1.0 for probabilities, else max score + 1."""
    grid = quantile_grid(scores)
    c = counts_at_grid(scores, grid.select("label", "grid")).join(grid.select("label", "max_score"), "label")
    no_pos = F.lit(1.0) if proba else F.col("max_score") + F.lit(1.0)
    return best_threshold(c, no_pos)


def apply_thresholds(scores: DataFrame, thresholds: DataFrame, default: float = 0.5) -> DataFrame:
    """M9 + C6: pred = score >= threshold of the label (matched by name, default 0.5)."""
    t = F.broadcast(thresholds.select("label", "threshold"))  # one row per label
    out = scores.join(t, "label", "left").withColumn("threshold", F.coalesce("threshold", F.lit(default)))
    return out.withColumn("pred", (F.col("score") >= F.col("threshold")).cast("int"))


# ---------------------------------------------------------------- metrics
def thresholds_in_use(scores: DataFrame, thresholds: DataFrame, default: float = 0.5) -> DataFrame:
    """Per label of the scores its threshold, whether it was tuned or is the default, and the rows it scores and predicts."""
    used = (apply_thresholds(scores, thresholds, default).groupBy("label")
            .agg(F.max("threshold").alias("threshold"), F.count(F.lit(1)).alias("n_reports"), F.sum("pred").cast("long").alias("n_pred")))
    named = thresholds.select("label", F.lit("tuned").alias("origin"))
    return used.join(named, "label", "left").withColumn("origin", F.coalesce("origin", F.lit("default")))


def confusion(pred: DataFrame) -> DataFrame:
    """D16 per label: support, tp, fp, fn, tn, precision, recall, f1, threshold,
    pred_pos_rate_pct, prob_mean."""
    y, p = F.col("y"), F.col("pred")
    c = pred.groupBy("label").agg(
        F.sum(y).cast("long").alias("support"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.max("threshold").alias("threshold"), (F.avg(p) * 100).alias("pred_pos_rate_pct"),
        F.avg("score").alias("prob_mean"))
    pr, rc, f1 = prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select("label", "support", "tp", "fp", "fn", "tn", pr.alias("precision"), rc.alias("recall"),
                    f1.alias("f1"), "threshold", "pred_pos_rate_pct", "prob_mean")


def micro_macro(conf: DataFrame) -> DataFrame:
    """Micro P/R/F1 from pooled counts; macro = mean of per-label values."""
    a = conf.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                 F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
                 F.avg("f1").alias("macro_f1"), F.count(F.lit(1)).alias("n_labels"))
    p, r, f = prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return a.select(p.alias("micro_precision"), r.alias("micro_recall"), f.alias("micro_f1"),
                    "macro_precision", "macro_recall", "macro_f1", "n_labels")


def brier_mean(scores: DataFrame) -> DataFrame:
    """Mean over labels of mean((y - score)^2)."""
    d = F.col("y").cast("double") - F.col("score")
    per = scores.groupBy("label").agg(F.avg(d * d).alias("brier"))
    return per.agg(F.avg("brier").alias("brier_mean"), F.count(F.lit(1)).alias("n_labels"))


def reliability_bins(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """10 bins of the score by the linspace edges (top bin closed), per label in ``labels``."""
    b = count_le(_arr(RELIABILITY_EDGES), F.col("score")) - 1
    b = F.least(F.greatest(b, F.lit(0)), F.lit(len(RELIABILITY_EDGES) - 2))
    s = scores.join(F.broadcast(labels.select("label")), "label", "left_semi")
    return s.groupBy("label", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"),
                                                   F.avg("score").alias("p_mean"), F.avg("y").alias("y_rate"))


def token_bin(n_tokens: Column) -> Column:
    """Right-closed bins (0,1], (1,2], ... (20,999]; 0 or > 999 tokens -> null."""
    out = F.lit(None).cast("string")
    for lo, hi in reversed(list(zip(TOKEN_BINS[:-1], TOKEN_BINS[1:]))):
        out = F.when((n_tokens > lo) & (n_tokens <= hi), F.lit(f"({lo}, {hi}]")).otherwise(out)
    return out


def per_row_counts(pred: DataFrame, id_col: str) -> DataFrame:
    """(id, true_n, pred_n) -- a row's labels are bounded by the label count."""
    return pred.groupBy(id_col).agg(F.sum("y").cast("long").alias("true_n"),
                                    F.sum("pred").cast("long").alias("pred_n"))


def case_margins(pred: DataFrame, id_col: str) -> DataFrame:
    """G8 + G9 per row with at least one true label: pos = min(score - thr) over true
    labels, neg = -max(score - thr) over false labels (+inf when none), overall = least."""
    d = F.col("score") - F.col("threshold")
    a = pred.groupBy(id_col).agg(
        F.min(F.when(F.col("y") == 1, d)).alias("pos_margin"),
        F.max(F.when(F.col("y") == 0, d)).alias("_maxf"),
        F.sum("y").cast("long").alias("true_n"), F.sum("pred").cast("long").alias("pred_n"))
    a = a.where(F.col("true_n") > 0)
    neg = F.coalesce(-F.col("_maxf"), F.lit(float("inf")))
    return a.select(id_col, F.least("pos_margin", neg).alias("overall_margin"), "pos_margin",
                    neg.alias("neg_margin"), "true_n", "pred_n")


def label_sets(pred: DataFrame, id_col: str) -> DataFrame:
    """(id, true_labels array, pred_labels array), sorted by name."""
    return pred.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.when(F.col("y") == 1, F.col("label")))).alias("true_labels"),
        F.array_sort(F.collect_list(F.when(F.col("pred") == 1, F.col("label")))).alias("pred_labels"))


def topk_labels(pred: DataFrame, id_col: str, k: int) -> DataFrame:
    """Per row the k highest scores (ties by label) as ``name:0.123(thr=0.456)``."""
    s = pred.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("neg"), F.col("label"), F.col("score"), F.col("threshold")))).alias("_s"))
    return s.select(id_col, *topk_texts(F.col("_s"), k))


def topk_texts(ranked, k: int) -> list:
    """E3 of one row: the text and the highest score, from its list of (neg, label, score, threshold) in order."""
    txt = F.transform(F.slice(ranked, 1, k), lambda e: F.format_string(
        "%s:%.3f(thr=%.3f)", e["label"], e["score"], e["threshold"]))
    return [F.array_join(txt, "; ").alias(f"top{k}"), F.element_at(ranked, 1)["score"].alias("confidence_max")]
