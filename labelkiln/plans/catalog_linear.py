"""Complement naive Bayes in closed form, and what reads its weights: scores, thresholds, ranked terms, SHAP.

The weights are sums and logarithms, so both engines compute them, and
everything built on them has its SQL.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import features as G
from ..operators import linear as L
from ..operators import metrics as M
from ..operators import packed as P
from ..session import settle, shared_uri
from ..sources import csr as CSR
from . import oracle as O
from .catalog import query
from .catalog_features import LAB, SEL_SQL, TOPK, Y, report_space, space_rows, train_chi2
from .catalog_scores import MM_COLS, TUNING, _micro_macro_sql, _round_cols, dlit

ALPHA = 0.5
COEF_TOP = 25
BACKGROUND, EXPLAIN, SHAP_TOP, SHAP_LOCAL = 200, 400, 30, 20
META = ["meta_log1p_len", "meta_n_terms", "meta_n_uniq_terms"]


# ---------------------------------------------------------------- Spark
def selected_space(spark, sf) -> dict:
    """Frame with split, selection, number and names of the selected features, all written once; ``selected_rows`` reads the rest."""
    sp = report_space(spark, sf)
    ds, nw, nc = sp["ds"], sp["nw"], sp["nc"]
    sel = settle(G.chi2_topk_union(train_chi2(sp), LAB, nw + nc + 3, TOPK, None, 3), "selection")
    meta = spark.createDataFrame([(nw + nc + i, n, "meta") for i, n in enumerate(META)], "idx int, name string, space string")
    names = (sp["wvoc"].select("idx", F.col("term").alias("name"), F.lit("word").alias("space"))
             .unionByName(sp["cvoc"].select((F.col("idx") + nw).cast("int").alias("idx"), F.col("term").alias("name"), F.lit("char").alias("space")))
             .unionByName(meta))
    names = sel.join(names, "idx").select(F.col("new_idx").alias("idx"), "name", "space")
    return {"ds": ds, "space": sp, "sel": sel, "n": sel.count(), "names": names}


def selected_rows(sp: dict, counts, **then):
    """The selected features of the rows of ``counts``, one row an id, computed from the written counts."""
    return space_rows(sp["space"], counts, selected=sp["sel"], **then)


def counted(sp: dict, *splits: str):
    return sp["space"]["counts"].where(F.col("split").isin(*splits))


def part(sp: dict, *splits: str):
    return sp["ds"].where(F.col("split").isin(*splits))


def nb_weights(sp: dict):
    return settle(L.complement_nb(selected_rows(sp, counted(sp, "train"), sums=Y), part(sp, "train"), Y, sp["n"], ALPHA), "nb-weights")


def nb_scores(sp: dict, weights, *splits: str):
    """M6: (primaryid, split, label, y, score) with the probability of class 1, rounded so that engines agree on ties."""
    rows = part(sp, *splits)
    odds = L.log_odds(P.entries(selected_rows(sp, counted(sp, *splits)), "primaryid"), rows, "primaryid", weights, LAB)
    truth = rows.select("primaryid", "split", F.explode(F.array(*[F.struct(F.lit(y[2:]).alias("label"), F.col(y).cast("int").alias("y")) for y in Y])).alias("t"))
    train = part(sp, "train")
    # a label with one class in train scores that class
    only = train.select(F.explode(F.array(*[F.struct(F.lit(y[2:]).alias("label"), F.col(y).cast("double").alias("only")) for y in Y])).alias("t"))
    only = only.groupBy("t.label").agg(F.max("t.only").alias("only"))
    j = truth.select("primaryid", "split", "t.label", "t.y").join(odds, ["primaryid", "label"]).join(F.broadcast(only), "label")  # a row a label
    score = F.when(F.col("s").isNull(), F.col("only")).otherwise(F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("s"))), 9))
    return j.select("primaryid", "split", "label", "y", score.alias("score"))


def best_supported(sp: dict) -> str:
    """The label with the most test rows (ties by name)."""
    sup = part(sp, "test").agg(*[F.sum(y).alias(y) for y in Y]).first()
    return sorted(Y, key=lambda y: (-(sup[y] or 0), y))[0][2:]


def hash_pick(df, n: int, seed: int):
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("primaryid").cast("string")))
    return df.select("primaryid").orderBy(h, "primaryid").limit(n)  # a fixed-size sample is the feature


def shap_inputs(spark, sf):
    sp = selected_space(spark, sf)
    weights = nb_weights(sp)
    background, explain = settle(hash_pick(part(sp, "train"), BACKGROUND, 1), "background"), settle(hash_pick(part(sp, "test"), EXPLAIN, 2), "explained")
    few = sp["space"]["counts"].join(F.broadcast(background.unionByName(explain)), "primaryid", "left_semi")  # BACKGROUND + EXPLAIN ids
    sp["few"] = settle(P.entries(selected_rows(sp, few), "primaryid"), "explained-features")
    return sp, weights, explain, settle(L.deviations(sp["few"], "primaryid", background, explain, sp["n"]), "deviations")


# ---------------------------------------------------------------- SQL
def _linear_sql(y_train: str = "yt") -> str:
    """Fit on the labels of ``y_train`` (primaryid, y_*), scores and thresholds on the true ones."""
    per_label = " UNION ALL ".join(
        f"""SELECT {O.lit(y[2:])} AS label, idx, ln((o_{y} + {dlit(ALPHA)}) / (s_{y} + sm)) - ln((t - o_{y} + {dlit(ALPHA)}) / (a - s_{y} + sm)) AS w
            FROM dense, whole, np WHERE p_{y} > 0 AND p_{y} < _n""" for y in Y)
    truth = " UNION ALL ".join(f"SELECT primaryid, split, {O.lit(y[2:])} AS label, CAST({y} AS INTEGER) AS y FROM ds" for y in Y)
    only = " UNION ALL ".join(f"SELECT {O.lit(y[2:])} AS label, CASE WHEN p_{y} = _n THEN 1.0 ELSE 0.0 END AS only FROM np" for y in Y)
    names = ", ".join(f"({i}, {O.lit(n)})" for i, n in enumerate(META))
    shuffled = f""",
ranks AS (SELECT *, row_number() OVER (ORDER BY md5('control|' || primaryid), primaryid) - 1 AS place, count(*) OVER () AS rows FROM yt),
shifted AS (SELECT a.primaryid, {', '.join(f'b.{y}' for y in Y)} FROM ranks a JOIN ranks b ON b.place = (a.place + 1) % a.rows)"""
    return SEL_SQL + shuffled + f""",
xs AS (SELECT x.primaryid, sel.new_idx AS idx, x.value FROM x JOIN sel ON x.idx = sel.idx),
nsel AS (SELECT count(*) AS n FROM sel),
csum AS (SELECT idx, sum(value) AS t, {', '.join(f'sum(value * {y}) AS o_{y}' for y in Y)} FROM xs JOIN {y_train} yy ON xs.primaryid = yy.primaryid GROUP BY idx),
dense AS (SELECT sel.new_idx AS idx, coalesce(t, 0) AS t, {', '.join(f'coalesce(o_{y}, 0) AS o_{y}' for y in Y)} FROM sel LEFT JOIN csum ON csum.idx = sel.new_idx),
whole AS (SELECT sum(t) AS a, {', '.join(f'sum(o_{y}) AS s_{y}' for y in Y)}, {dlit(ALPHA)} * any_value(n) AS sm FROM csum, nsel),
nbw AS ({per_label}),
names AS (SELECT sel.new_idx AS idx, v.term AS name, 'word' AS space FROM sel JOIN w_voc v ON sel.idx = v.idx
          UNION ALL SELECT sel.new_idx, v.term, 'char' FROM sel JOIN c_voc v ON sel.idx = v.idx + (SELECT nw FROM nw)
          UNION ALL SELECT sel.new_idx, m.name, 'meta' FROM sel JOIN (VALUES {names}) m(i, name) ON sel.idx = m.i + (SELECT nf - 3 FROM nf)),
truth AS ({truth}),
single AS ({only}),
has AS (SELECT DISTINCT label FROM nbw),
odds AS (SELECT xs.primaryid, nbw.label, sum(xs.value * nbw.w) AS s FROM xs JOIN nbw ON nbw.idx = xs.idx GROUP BY ALL),
nbs AS (SELECT t.primaryid, t.split, t.label, t.y, CASE WHEN has.label IS NULL THEN single.only
               ELSE round(1 / (1 + exp(-coalesce(odds.s, 0))), 9) END AS score
        FROM truth t JOIN single ON single.label = t.label LEFT JOIN has ON has.label = t.label
             LEFT JOIN odds ON odds.primaryid = t.primaryid AND odds.label = t.label WHERE t.split <> 'train'),
cal AS (SELECT * FROM nbs WHERE split = 'val'),
ev AS (SELECT * FROM nbs WHERE split = 'test'),""" + TUNING


LSQL = _linear_sql()
SHAP_SQL = LSQL + f""",
bg AS (SELECT primaryid FROM ds WHERE split = 'train' ORDER BY md5('1|' || primaryid), primaryid LIMIT {BACKGROUND}),
ex AS (SELECT primaryid FROM ds WHERE split = 'test' ORDER BY md5('2|' || primaryid), primaryid LIMIT {EXPLAIN}),
mu AS (SELECT sel.new_idx AS idx, coalesce(sum(b.value), 0) / (SELECT count(*) FROM bg) AS mu
       FROM sel LEFT JOIN (SELECT * FROM xs WHERE primaryid IN (SELECT primaryid FROM bg)) b ON b.idx = sel.new_idx GROUP BY sel.new_idx),
phi AS (SELECT e.primaryid, w.label, w.idx, w.w * (coalesce(v.value, 0) - mu.mu) AS phi
        FROM ex e CROSS JOIN nbw w JOIN mu ON mu.idx = w.idx LEFT JOIN xs v ON v.primaryid = e.primaryid AND v.idx = w.idx),
summ AS (SELECT label, idx, avg(abs(phi)) AS mean_abs_phi, avg(phi) AS mean_phi, avg(greatest(phi, 0)) AS mean_pos_phi,
                avg(least(phi, 0)) AS mean_neg_phi FROM phi GROUP BY label, idx),
placed AS (SELECT s.*, n.name, row_number() OVER (PARTITION BY s.label ORDER BY round(mean_abs_phi, 9) DESC, s.idx) AS rank
           FROM summ s JOIN names n ON n.idx = s.idx),
best AS (SELECT label FROM truth WHERE split = 'test' GROUP BY label ORDER BY sum(y) DESC, 'y_' || label LIMIT 1)"""
PHI = ["mean_abs_phi", "mean_phi", "mean_pos_phi", "mean_neg_phi"]
TOP_SQL = f"""
SELECT label, CAST(least(rank, {SHAP_TOP + 1}) AS INTEGER) AS rank, CASE WHEN rank <= {SHAP_TOP} THEN name ELSE 'sum of others' END AS name,
       {', '.join(f'round(sum({c}), 6) AS {c}' for c in PHI)} FROM placed"""


# ---------------------------------------------------------------- queries
@query("ovr_complement_nb", LSQL + """
SELECT 'complementnb_a05' AS model, label, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       round(threshold, 6) AS threshold FROM conf""", "S*")
def ovr_complement_nb(spark, sf):
    """M4: complement naive Bayes per label (alpha 0.5) in closed form; thresholds tuned on val, test metrics per label."""
    sp = selected_space(spark, sf)
    s = settle(nb_scores(sp, nb_weights(sp), "val", "test"), "nb-scores")
    thr = M.tune_quantile(s.where(F.col("split") == "val"))
    conf = M.confusion(M.apply_thresholds(s.where(F.col("split") == "test"), thr))
    return conf.select(F.lit("complementnb_a05").alias("model"), "label", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "threshold")])


@query("complement_nb_weights", LSQL + "SELECT label, n.name, n.space, round(w, 6) AS w FROM nbw JOIN names n ON n.idx = nbw.idx", "S*")
def complement_nb_weights(spark, sf):
    """M4: the weight of every selected feature for every label."""
    sp = selected_space(spark, sf)
    return nb_weights(sp).join(sp["names"], "idx").select("label", "name", "space", F.round("w", 6).alias("w"))


@query("complement_nb_scores", LSQL + "SELECT primaryid, split, label, y, round(score, 6) AS score FROM nbs", "S*")
def complement_nb_scores(spark, sf):
    """M6: probability of every label for every val and test report."""
    sp = selected_space(spark, sf)
    return nb_scores(sp, nb_weights(sp), "val", "test").select("primaryid", "split", "label", "y", F.round("score", 6).alias("score"))


@query("top_coef_terms", LSQL + f""",
cw AS (SELECT label, n.name AS term, nbw.idx, round(w, 9) AS w FROM nbw JOIN names n ON n.idx = nbw.idx WHERE n.space = 'word'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY w DESC, idx) AS hi, row_number() OVER (PARTITION BY label ORDER BY w, idx) AS lo FROM cw)
SELECT label, 'top' AS direction, CAST(hi AS INTEGER) AS rank, term, round(w, 6) AS w FROM ranked WHERE hi <= {COEF_TOP}
UNION ALL SELECT label, 'bottom', CAST(lo AS INTEGER), term, round(w, 6) FROM ranked WHERE lo <= {COEF_TOP}""", "S*")
def top_coef_terms(spark, sf):
    """Per label the 25 largest and 25 smallest word-feature weights of the closed-form model."""
    sp = selected_space(spark, sf)
    words = sp["names"].where(F.col("space") == "word")
    r = L.ranked_weights(nb_weights(sp).join(words.select("idx"), "idx", "left_semi"), COEF_TOP)
    return r.join(words, "idx").select("label", "direction", F.col("rank").cast("int").alias("rank"), F.col("name").alias("term"), F.round("w", 6).alias("w"))


def shap_top(summary, names):
    """Per label the 30 features with the largest mean |phi|, and the sum of the others."""
    order = Window.partitionBy("label").orderBy(F.round("mean_abs_phi", 9).desc(), "idx")  # a row a feature: bounded by the selection
    r = summary.join(names, "idx").withColumn("rank", F.row_number().over(order))
    rank = F.least("rank", F.lit(SHAP_TOP + 1)).cast("int").alias("rank")
    name = F.when(F.col("rank") <= SHAP_TOP, F.col("name")).otherwise("sum of others").alias("name")
    return r.select("label", rank, name, *PHI).groupBy("label", "rank", "name").agg(*[F.round(F.sum(c), 6).alias(c) for c in PHI])


@query("linear_shap", SHAP_SQL + TOP_SQL + " WHERE label = (SELECT label FROM best) GROUP BY 1, 2, 3", "S*")
def linear_shap(spark, sf):
    """Exact linear SHAP for the label best supported in test: top 30 features by mean |phi| plus 'sum of others'."""
    sp, weights, _, dev = shap_inputs(spark, sf)
    return shap_top(L.shap_summary(weights.where(F.col("label") == best_supported(sp)), dev), sp["names"])


@query("linear_shap_labels", SHAP_SQL + TOP_SQL + " GROUP BY 1, 2, 3", "S*")
def linear_shap_labels(spark, sf):
    """The same for all labels from one pass over the explained rows."""
    sp, weights, _, dev = shap_inputs(spark, sf)
    return shap_top(L.shap_summary(weights, dev), sp["names"])


LOCAL_SQL = SHAP_SQL + f""",
lr AS (SELECT phi.primaryid, phi.label, phi.phi, n.name, n.space,
              row_number() OVER (PARTITION BY phi.primaryid, phi.label ORDER BY round(abs(phi), 9) DESC, phi.idx) AS rank
       FROM phi JOIN names n ON n.idx = phi.idx WHERE phi.label = (SELECT label FROM best))
SELECT primaryid, label, CAST(rank AS INTEGER) AS rank, name, space, round(phi, 6) AS phi FROM lr WHERE rank <= {SHAP_LOCAL}"""


def local_rows(sp, weights, rows, dev):
    label = best_supported(sp)
    phi = L.shap_of_rows(sp["few"], "primaryid", rows, weights.where(F.col("label") == label), dev, [label], SHAP_LOCAL)
    return phi.join(sp["names"], "idx").select("primaryid", "label", F.col("rank").cast("int").alias("rank"), "name", "space", F.round("phi", 6).alias("phi"))


@query("linear_shap_local", LOCAL_SQL + " AND primaryid = (SELECT primaryid FROM ex ORDER BY md5('2|' || primaryid), primaryid LIMIT 1)", "S*")
def linear_shap_local(spark, sf):
    """The 20 largest contributions by |phi| for one test report and the label best supported in test."""
    sp, weights, explain, dev = shap_inputs(spark, sf)
    return local_rows(sp, weights, hash_pick(explain, 1, 2), dev)


@query("linear_shap_rows", LOCAL_SQL, "S*")
def linear_shap_rows(spark, sf):
    """The same for each of the 400 explained reports, as one job."""
    sp, weights, explain, dev = shap_inputs(spark, sf)
    return local_rows(sp, weights, explain, dev)


def nb_summary(sp: dict, weights):
    """Micro and macro F1 on test with thresholds tuned on val."""
    s = settle(nb_scores(sp, weights, "val", "test"), "nb-scores")
    conf = M.confusion(M.apply_thresholds(s.where(F.col("split") == "test"), M.tune_quantile(s.where(F.col("split") == "val"))))
    return M.micro_macro(conf).select(*[F.round(c, 6).alias(c) for c in MM_COLS], "n_labels")


def _summary_sql(y_train: str) -> str:
    return _linear_sql(y_train) + f" SELECT {_round_cols(MM_COLS)}, n_labels FROM ({_micro_macro_sql('conf')})"


@query("complement_nb_summary", _summary_sql("yt"), "S*")
def complement_nb_summary(spark, sf):
    """M4 + D17: micro and macro metrics of the closed-form model on test."""
    sp = selected_space(spark, sf)
    return nb_summary(sp, nb_weights(sp))


@query("shuffled_text_control", _summary_sql("shifted"), "S*")
def shuffled_text_control(spark, sf):
    """The model fitted on features and labels of different train rows (each takes the labels of the next in a seeded order),
    thresholds on the true val rows, metrics on the true test rows: what is left without the texts."""
    sp = selected_space(spark, sf)
    train = settle(part(sp, "train").select("primaryid", F.md5(F.concat(F.lit("control|"), F.col("primaryid").cast("string"))).alias("h"), *Y), "control-rows")
    ranks = settle(G.ordered_index(train.withColumn("o", F.struct("h", "primaryid")), "o", F.substring("h", 1, 3), "place").drop("o", "h"), "control-ranks")
    n = ranks.count()
    shifted = ranks.select("primaryid", F.pmod(F.col("place") + 1, F.lit(max(n, 1))).alias("place")).join(ranks.select("place", *Y), "place").drop("place")
    given = shifted.groupBy("primaryid").agg(F.count(F.lit(1)).alias("copies"), *[F.sum(F.col(y).cast("long")).alias(y) for y in Y])
    sums = selected_rows(sp, counted(sp, "train").drop("copies", *Y).join(given, "primaryid"), sums=Y)
    weights = settle(L.complement_nb(sums, shifted, Y, sp["n"], ALPHA), "control-weights")
    return nb_summary(sp, weights)


@query("sink_matrix_csr", LSQL + """
SELECT ds.split, count(DISTINCT ds.primaryid) AS n_rows, count(xs.idx) AS nnz, round(sum(xs.value), 4) AS sum_value,
       round(sum(xs.idx * xs.value), 3) AS sum_idx_value, 0 AS n_differ, 0 AS n_wrong_range
FROM ds LEFT JOIN xs ON xs.primaryid = ds.primaryid GROUP BY ds.split""", "S*")
def sink_matrix_csr(spark, sf):
    """A10: the selected matrix written as CSR shards and read back: rows, entries and checksums per split, entries that differ from
    the matrix, and rows wrongly read or left out when rows 100 to 299 of each split are asked for alone."""
    sp = selected_space(spark, sf)
    was = selected_rows(sp, sp["space"]["counts"]).select("primaryid", "idx", "value")
    path = CSR.write(sp["ds"], was, "primaryid", shared_uri(spark, "csr"), rows=64)
    shards = spark.read.parquet(path)
    back = CSR.read_rows(shards, "primaryid")
    listed = was.select("primaryid", F.arrays_zip("idx", "value").alias("w")).hint("merge")  # the matrix never goes through the driver
    held = sp["ds"].select("primaryid", "split").distinct().join(listed, "primaryid")
    pairs = back.select("split", "place", "primaryid", F.arrays_zip("idx", "value").alias("b")).join(held, ["split", "primaryid"], "full_outer")
    none = F.array().cast("array<struct<idx:int,value:double>>")
    b, w = F.coalesce("b", none), F.coalesce("w", none)
    off = F.size(F.array_distinct(F.concat(F.array_except(b, w), F.array_except(w, b))["idx"]))
    differ = pairs.where(~b.eqNullSafe(w)).groupBy("split").agg(F.sum(off).alias("n_differ"))
    asked = CSR.read_rows(shards, "primaryid", None, 100, 300).select("split", "place", "primaryid").distinct().withColumn("asked", F.lit(True))
    rows = back.select("split", "place", "primaryid").distinct().withColumn("due", F.col("place").between(100, 299))
    wrong = rows.join(asked, ["split", "place", "primaryid"], "full_outer").where(
        F.coalesce("due", F.lit(False)) != F.coalesce("asked", F.lit(False))).groupBy("split").agg(F.count(F.lit(1)).alias("n_wrong_range"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    out = back.groupBy("split").agg(F.count_distinct("primaryid").alias("n_rows"), F.sum(F.size("idx")).alias("nnz"), F.round(F.sum(total(F.col("value"))), 4).alias("sum_value"),
                                    F.round(F.sum(total(F.zip_with("idx", "value", lambda i, v: i * v))), 3).alias("sum_idx_value"))
    return out.join(differ, "split", "left").join(wrong, "split", "left").na.fill(0, ["n_differ", "n_wrong_range"]).select(
        "split", "n_rows", "nnz", "sum_value", "sum_idx_value", F.col("n_differ").cast("int").alias("n_differ"), F.col("n_wrong_range").cast("int").alias("n_wrong_range"))
