"""Model queries (M1-M4, M6, M10-M12, M14, E10, G10, A10): real Spark ML fits, rows-only checks.

The model frame is the report feature space of ``catalog_features``
(word + char TF-IDF fitted on train, meta features), reduced by the
chi-square union selection and assembled into vectors once per session
(checkpointed).  Thresholds are tuned on val with the quantile grid (M8)
and applied to test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import features as G
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import packed as P
from ..operators import textmodel as TM
from ..operators.splits import hash_sample, hash_split
from ..operators import oversample as OV
from ..session import scratch_path, settle, shared_uri
from ..streaming.hardcases import running_topn
from . import views as V
from .catalog import query
from .catalog_features import LAB, SEL_SQL, TOPK, Y, report_space, space_rows, train_chi2

META_NAMES = ["meta_log1p_len", "meta_n_terms", "meta_n_uniq_terms"]
#: Trials of the registered search, and rows of the train subsample they are fitted on (all when fewer).
TRIALS, SUBSAMPLE = 4, 60_000
SHAP_BACKGROUND, SHAP_EXPLAIN, SHAP_TOP, SHAP_LOCAL = 200, 400, 30, 20
COEF_TOP, PREDICT_TOPK = 25, 5


@dataclass
class ModelFrame:
    frame: DataFrame      # primaryid, split, y_*, features
    x: DataFrame          # long features after selection (primaryid, idx, value)
    names: DataFrame      # (idx, name, space) of the selected features
    n_features: int
    terms: DataFrame      # whole vocabulary with idf and selected index (textmodel)
    meta: DataFrame       # selected meta features (textmodel)
    matrix: DataFrame     # the written matrix, one row an id: primaryid, split, copies, y_* (sums over copies), size, idx, value


#: Written frames and saved models of this session's inputs; rewritten tables have another stamp.
_MEMO: dict = {}


def _stamp(spark, sf) -> tuple:
    """Session, input folder, and sizes and times of the files that the model queries read."""
    out = [spark.sparkContext.applicationId, sf]
    for name in ("orders", "lineitem", "part"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in [fs.getFileStatus(path), *fs.listStatus(path)]:
            out += [status.getLen(), status.getModificationTime()]
    return tuple(out)


def model_space(spark, sf) -> dict:
    """What all models share: the report space with its written counts, the selection, its size and names, the most copies of an id."""
    key = ("space", *_stamp(spark, sf))
    if key not in _MEMO:
        sp = report_space(spark, sf)
        nw, nc = sp["nw"], sp["nc"]
        sel = G.chi2_topk_union(train_chi2(sp), LAB, nw + nc + 3, TOPK, None, 3).checkpoint(eager=True)
        meta = spark.createDataFrame([(nw + nc + i, n) for i, n in enumerate(META_NAMES)], "idx int, term string")
        orig = (sp["wvoc"].select("idx", "term", F.lit("word").alias("space"))
                .unionByName(sp["cvoc"].select((F.col("idx") + F.lit(nw)).alias("idx"), "term", F.lit("char").alias("space")))
                .unionByName(meta.withColumn("space", F.lit("meta"))))
        names = sel.join(orig, "idx").select(F.col("new_idx").alias("idx"), F.col("term").alias("name"), "space")
        _MEMO[key] = dict(sp, sel=sel, n=sel.count(), names=names.checkpoint(eager=True), copies=sp["counts"].agg(F.max("copies")).first()[0] or 1)
    return _MEMO[key]


def _frame_rows(ms: dict, rows: DataFrame, *cols: str) -> DataFrame:
    """(primaryid, split, y_*, cols): the table rows behind rows with one for an id."""
    if ms["copies"] > 1:  # a row for each copy of an id
        rows = rows.withColumn("_c", F.explode(F.expr("sequence(1, int(copies))")))
    return rows.select("primaryid", "split", *[(F.col(y) / F.col("copies")).cast("tinyint").alias(y) for y in Y], *cols)


def model_frame(spark, sf) -> ModelFrame:
    key = ("frame", *_stamp(spark, sf))
    if key in _MEMO:
        return _MEMO[key]
    ms = model_space(spark, sf)
    nw, sel = ms["nw"], ms["sel"]
    vectors, matrix = MD.assemble_rows(space_rows(ms, ms["counts"], selected=sel), ms["n"])
    mf = ModelFrame(_frame_rows(ms, vectors, "features"), P.entries(matrix, "primaryid"), ms["names"], ms["n"],
                    TM.selected_terms(ms["wvoc"], ms["cvoc"], nw, sel).checkpoint(eager=True), TM.selected_meta(spark, nw + ms["nc"], sel), matrix)
    _MEMO[key] = mf
    return mf


def _part(mf: ModelFrame, split: str) -> DataFrame:
    return mf.frame.where(F.col("split") == split)


def evaluate(mf: ModelFrame, fam: MD.Family, train: DataFrame | None = None, val: DataFrame | None = None,
             test: DataFrame | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """Fit on train, tune thresholds on val (M8), apply on test: (per-label metrics, test preds, models)."""
    train = _part(mf, "train") if train is None else train
    val = _part(mf, "val") if val is None else val
    test = _part(mf, "test") if test is None else test
    models = MD.fit_ovr(train, Y, fam)
    sv = settle(MD.score_ovr(models, val, "primaryid", fam), "val-scores")  # the quantiles, their range and the grid counts read it
    thr = M.tune_quantile(sv, proba=fam.kind == "proba")
    pred = M.apply_thresholds(sv if test is val else MD.score_ovr(models, test, "primaryid", fam), thr)  # rows judged on val have their scores already
    return M.confusion(pred), pred, models


def _metrics_out(conf: DataFrame, fam: MD.Family) -> DataFrame:
    return conf.select(F.lit(fam.name).alias("model"), "label", "support", "precision", "recall", "f1", "threshold")


@query("ovr_logreg")
def ovr_logreg(spark, sf):
    """M1: one balanced L2 logistic model per label (C=2), thresholds tuned on val, test metrics per label."""
    conf, _, _ = evaluate(model_frame(spark, sf), MD.LOGREG_C2_BAL)
    return _metrics_out(conf, MD.LOGREG_C2_BAL)


@query("ovr_linearsvc")
def ovr_linearsvc(spark, sf):
    """M2: LinearSVC per label (C=1, decision values) and the balanced sigmoid pseudo-probability variant."""
    mf = model_frame(spark, sf)
    return _metrics_out(evaluate(mf, MD.LINEARSVC_C1)[0], MD.LINEARSVC_C1).unionByName(
        _metrics_out(evaluate(mf, MD.LINEARSVC_BAL_SIGMOID)[0], MD.LINEARSVC_BAL_SIGMOID))


@query("ovr_sgd_logloss")
def ovr_sgd_logloss(spark, sf):
    """M3: small-alpha (1e-5) L2 log-loss linear model per label."""
    return _metrics_out(evaluate(model_frame(spark, sf), MD.SGD_LOGLOSS)[0], MD.SGD_LOGLOSS)


@query("ovr_sgd_hinge")
def ovr_sgd_hinge(spark, sf):
    """M3: small-alpha (1e-5) hinge linear model per label."""
    return _metrics_out(evaluate(model_frame(spark, sf), MD.SGD_HINGE)[0], MD.SGD_HINGE)


@query("ovr_sgd_elasticnet")
def ovr_sgd_elasticnet(spark, sf):
    """M3: log loss with elastic-net penalty (alpha 1e-5, l1 share 0.15) per label."""
    return _metrics_out(evaluate(model_frame(spark, sf), MD.SGD_ELASTICNET)[0], MD.SGD_ELASTICNET)


@query("ovr_sgd_balanced")
def ovr_sgd_balanced(spark, sf):
    """M3: small-alpha (1e-5) log-loss linear model per label with balanced class weights."""
    return _metrics_out(evaluate(model_frame(spark, sf), MD.SGD_BALANCED)[0], MD.SGD_BALANCED)


CAL_FOLDS = 3


def calibrated_scores(mf: ModelFrame, spark) -> DataFrame:
    """M5: per label, sigmoid-calibrated LinearSVC over 3 hash folds of train; the score of a
    val/test row is the mean of the 3 calibrated probabilities."""
    fold = F.abs(F.xxhash64(F.lit(7), "primaryid")) % F.lit(CAL_FOLDS)
    train = _part(mf, "train").withColumn("_fold", fold)
    rest = mf.frame.where(F.col("split").isin("val", "test"))
    held = out = None
    for f in range(CAL_FOLDS):
        models = MD.fit_ovr(train.where(F.col("_fold") != f), Y, MD.LINEARSVC_C1)
        m = MD.score_ovr(models, train.where(F.col("_fold") == f), "primaryid", MD.LINEARSVC_C1)
        m = m.select("label", F.lit(f).alias("fold"), F.col("score").alias("m"), "y")
        sc = MD.score_ovr(models, rest, "primaryid", MD.LINEARSVC_C1, keep=["split"]).withColumn("fold", F.lit(f))
        held, out = (m, sc) if held is None else (held.unionByName(m), out.unionByName(sc))
    ab = MD.sigmoid_calibration(settle(held, "held-out-margins"), ["label", "fold"])  # all labels and folds together
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("a") * F.col("score") + F.col("b"))))
    return out.join(F.broadcast(ab), ["label", "fold"]).groupBy("primaryid", "split", "label", "y").agg(F.avg(p).alias("score"))


@query("calibrated_svc")
def calibrated_svc(spark, sf):
    """M5: 3-fold sigmoid-calibrated LinearSVC per label; thresholds tuned on val, test metrics per label."""
    mf = model_frame(spark, sf)
    s = settle(calibrated_scores(mf, spark), "calibrated-scores")
    thr = M.tune_quantile(s.where(F.col("split") == "val"))
    conf = M.confusion(M.apply_thresholds(s.where(F.col("split") == "test"), thr))
    fam = MD.Family("calibrated_linearsvc", "proba", C=1.0)
    return _metrics_out(conf, fam)


@query("score_matrix")
def score_matrix(spark, sf):
    """M6: long test scores (id, label, y, score, kind, threshold, pred) of the logistic models."""
    _, pred, _ = evaluate(model_frame(spark, sf), MD.LOGREG_C2_BAL)
    return pred


TRIAL_FIELDS = ("trial int, model string, C double, alpha double, balanced boolean, l1_share double, n_fit long, "
                "val_micro_f1 double, val_macro_f1 double")


def run_search(spark, mf: ModelFrame, folder: str, n: int = TRIALS, seed: int = 42) -> DataFrame:
    """The trial table in ``folder``.  Each trial is fitted on the train subsample, its thresholds are tuned and it is
    judged on val, and its row is written when it ends; trials whose row is there already are not run again."""
    _, fs = _hadoop_path(spark, folder)
    done = {r["trial"] for r in spark.read.schema(TRIAL_FIELDS).parquet(folder).select("trial").collect()} if fs else set()
    train = MD.packed_tightly(settle(hash_sample(_part(mf, "train"), "primaryid", SUBSAMPLE, seed), "search-train"))
    val, n_fit = settle(_part(mf, "val"), "search-val"), train.count()  # every trial reads them
    for trial, fam in enumerate(MD.draw_trials(n, seed)):
        if trial in done:
            continue
        conf, _, _ = evaluate(mf, fam, train, val, val)
        M.micro_macro(conf).select(
            F.lit(trial).alias("trial"), F.lit(fam.name).alias("model"), F.lit(fam.C).cast("double").alias("C"),
            F.lit(fam.alpha).cast("double").alias("alpha"), F.lit(fam.balanced).alias("balanced"),
            F.lit(fam.l1_share).cast("double").alias("l1_share"), F.lit(n_fit).cast("long").alias("n_fit"),
            F.col("micro_f1").alias("val_micro_f1"), F.col("macro_f1").alias("val_macro_f1")).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(TRIAL_FIELDS).parquet(folder).where(F.col("trial") < n)


def _hadoop_path(spark, folder: str):
    """(path, whether it exists)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def search_folder(spark, sf) -> str:
    """The trial table of this input: one a session."""
    key = ("search", *_stamp(spark, sf))
    if key not in _MEMO:
        _MEMO[key] = shared_uri(spark, "trials")
    return _MEMO[key]


@query("param_search")
def param_search(spark, sf):
    """Seeded trials over four model families; objective = val micro F1 after M8 thresholds."""
    return run_search(spark, model_frame(spark, sf), search_folder(spark, sf))


def final_model(spark, sf):
    """(family, models, thresholds, fit rows, calibration rows) of the best trial, refitted on 90 % of train and val
    with thresholds from the other 10 % (H7); one a session and input."""
    key = ("final", *_stamp(spark, sf))
    if key not in _MEMO:
        mf = model_frame(spark, sf)
        best = param_search(spark, sf).orderBy(F.desc("val_micro_f1"), F.desc("val_macro_f1"), "trial").limit(1).first()
        fam = MD.draw_trials(best["trial"] + 1)[best["trial"]]
        parts = hash_split(mf.frame.where(F.col("split").isin("train", "val")), "primaryid", 0.10, 43, "cal", "fit")
        fit, cal = (settle(parts.where(F.col("part") == p).drop("part"), f"final-{p}") for p in ("fit", "cal"))
        models = MD.fit_ovr(fit, Y, fam)
        scores = settle(MD.score_ovr(models, cal, "primaryid", fam), "final-scores")
        thr = settle(M.tune_quantile(scores, proba=fam.kind == "proba"), "final-thresholds")
        _MEMO[key] = fam, models, thr, fit.count(), cal.count()
    return _MEMO[key]


@query("final_refit")
def final_refit(spark, sf):
    """Best trial of the search, refitted on 90 % of train+val, thresholds on the other 10 %, test metrics."""
    fam, models, thr, n_fit, n_cal = final_model(spark, sf)
    test = MD.score_ovr(models, _part(model_frame(spark, sf), "test"), "primaryid", fam)
    mm = M.micro_macro(M.confusion(M.apply_thresholds(test, thr)))
    return mm.select(F.lit(fam.name).alias("model"), F.lit(n_fit).alias("n_fit"), F.lit(n_cal).alias("n_cal"),
                     F.col("micro_f1").alias("test_micro_f1"), F.col("macro_f1").alias("test_macro_f1"))


@query("top_coef_terms_logreg")
def top_coef_terms_logreg(spark, sf):
    """Per label the 25 largest and 25 smallest word-feature coefficients of the logistic model."""
    mf = model_frame(spark, sf)
    models = MD.fit_ovr(_part(mf, "train"), Y, MD.LOGREG_C2_BAL)
    coef = MD.coefficients(models, spark).join(mf.names.where(F.col("space") == "word"), "idx")
    return MD.top_coef(coef, COEF_TOP).select("label", "direction", F.col("rank").cast("int").alias("rank"),
                                              F.col("name").alias("term"), "w")


def _hash_pick(df: DataFrame, n: int, seed: int) -> DataFrame:
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("primaryid").cast("string")))
    return df.select("primaryid").orderBy(h, "primaryid").limit(n)  # a fixed-size sample is the feature


def _shap_fit(spark, sf) -> tuple[dict, str, DataFrame, DataFrame, DataFrame]:
    """(space, label best supported in test, its coefficients, train rows, test rows) of the SHAP queries.

    One label is fitted, so its vectors are read twice, for the summary and
    for the fit's own blocks: they are computed from the written counts and
    are not written themselves.
    """
    ms = model_space(spark, sf)
    counts = {s: ms["counts"].where(F.col("split") == s) for s in ("train", "test")}
    train, test = (_frame_rows(ms, c) for c in counts.values())
    sup = test.agg(*[F.sum(y).alias(y) for y in Y]).first()
    label = sorted(Y, key=lambda y: (-(sup[y] or 0), y))[0]
    vectors = _frame_rows(ms, space_rows(ms, counts["train"], selected=ms["sel"], size=ms["n"]), "features")
    return ms, label, MD.coefficients(MD.fit_ovr(vectors, [label], MD.LOGREG_C2_BAL, labels=train), spark), train, test


def _features_of(ms: dict, ids: DataFrame) -> DataFrame:
    """(primaryid, idx, value): the selected features of a few rows."""
    few = ms["counts"].join(F.broadcast(ids), "primaryid", "left_semi")  # SHAP_BACKGROUND + SHAP_EXPLAIN ids at most
    return settle(P.entries(space_rows(ms, few, selected=ms["sel"]), "primaryid"), "explained-features")


@query("linear_shap_logreg")
def linear_shap_logreg(spark, sf):
    """Exact linear SHAP for the label best supported in test: top 30 features by mean |phi| plus 'sum of others'."""
    ms, label, coef, train, test = _shap_fit(spark, sf)
    bg, ex = settle(_hash_pick(train, SHAP_BACKGROUND, 1), "background"), settle(_hash_pick(test, SHAP_EXPLAIN, 2), "explained")
    s = MD.linear_shap(_features_of(ms, bg.unionByName(ex)), "primaryid", coef, bg, ex, ms["n"]).join(ms["names"], "idx")
    w = Window.orderBy(F.desc("mean_abs_phi"), "idx")  # one row per feature: bounded by the selection cap
    r = s.withColumn("rank", F.row_number().over(w))
    top = r.where(F.col("rank") <= SHAP_TOP).select("rank", "name", "mean_abs_phi", "mean_phi", "mean_pos_phi",
                                                   "mean_neg_phi")
    rest = r.where(F.col("rank") > SHAP_TOP).agg(
        F.lit(SHAP_TOP + 1).alias("rank"), F.lit("sum of others").alias("name"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("mean_abs_phi", "mean_phi", "mean_pos_phi", "mean_neg_phi")])
    return top.unionByName(rest).withColumn("label", F.lit(label[2:]))


@query("linear_shap_local_logreg")
def linear_shap_local_logreg(spark, sf):
    """The 20 largest contributions by |phi| for one test report and the label best supported in test."""
    ms, label, coef, train, test = _shap_fit(spark, sf)
    background = settle(_hash_pick(train, SHAP_BACKGROUND, 1), "background")
    picked = settle(_hash_pick(test, 1, 2), "explained")
    row = picked.first()["primaryid"]
    x = _features_of(ms, background.unionByName(picked))
    mu = (x.join(background, "primaryid", "left_semi").groupBy("idx")
          .agg((F.sum("value") / F.lit(float(background.count()))).alias("mu")))
    phi = MD.local_shap(x, "primaryid", row, coef, mu, ms["n"])
    top = phi.orderBy(F.abs("phi").desc(), "idx").limit(SHAP_LOCAL)
    return top.join(ms["names"], "idx").select(F.lit(row).alias("primaryid"), F.lit(label[2:]).alias("label"), "name", "space", "phi")


def save_model(spark, sf) -> str:
    """Save the final model (M11) with everything that scoring needs; the folder."""
    mf = model_frame(spark, sf)
    fam, models, thr, _, _ = final_model(spark, sf)
    weights, intercepts = TM.weights_of(spark, models)
    labels = intercepts.join(thr.select("label", "threshold"), "label", "left").select(
        "label", "intercept", F.coalesce("threshold", F.lit(0.5)).alias("threshold"), F.lit(fam.kind).alias("kind"))
    return TM.TextModel(mf.terms, weights, mf.meta, labels).save(shared_uri(spark, "model"))


def saved_model(spark, sf) -> TM.TextModel:
    """The saved model of this input, loaded from its folder; fitted and saved when there is none yet."""
    key = ("model", *_stamp(spark, sf))
    if key not in _MEMO:
        _MEMO[key] = save_model(spark, sf)
    return TM.load(spark, _MEMO[key])


#: Texts that no report has, scored beside the requested reports.
NEW_TEXTS = [("new-1", "hot bolt; blue ring"), ("new-2", "small plate; unknown thing"), ("new-3", ""), ("new-4", None)]


@query("batch_predict")
def batch_predict(spark, sf):
    """M14 + B7: every report, ids no report has, and new texts, scored with the final model: labels and the five best scores."""
    model = saved_model(spark, sf)
    reports = V.reports(spark, sf).select("primaryid", F.col(V.TEXT).alias("text"))
    missing = V.demo(spark, sf).agg((F.max("primaryid") + 1).alias("primaryid"))  # an id no report has
    req = V.demo(spark, sf).select("primaryid").unionByName(missing)
    found = req.join(reports.select("primaryid", "text", F.lit(True).alias("known")), "primaryid", "left")
    new = spark.createDataFrame(NEW_TEXTS, "request string, text string").select("request", "text", F.lit("NEW_TEXT").alias("status"))
    rows = found.select(F.col("primaryid").cast("string").alias("request"), "text",
                        F.when(F.col("known"), "FOUND").otherwise("NOT_FOUND").alias("status")).unionByName(new)
    rows = settle(rows, "predict-requests")  # read by the features and the answer
    p = TM.predict_rows(model, rows.where("status <> 'NOT_FOUND'"), "request")
    every = p.select("request", F.flatten(F.array_repeat("scores", F.col("copies").cast("int"))).alias("s"))  # a request that comes twice has each label twice
    ranked = F.array_sort(F.transform("s", lambda e: F.struct((-e["score"]).alias("neg"), e["label"].alias("label"), e["score"].alias("score"), e["threshold"].alias("threshold"))))
    labs = F.array_join(F.array_sort(F.transform(F.filter("s", lambda e: e["pred"] == 1), lambda e: e["label"])), "; ").alias("pred_labels")
    every = every.select("request", labs, ranked.alias("r")).select("request", "pred_labels", *M.topk_texts(F.col("r"), PREDICT_TOPK))
    return rows.join(every.hint("merge"), "request", "left")


@query("stream_scoring_topn")
def stream_scoring_topn(spark, sf):
    """Report texts streamed file by file and scored with the saved model in each batch; running top-30 of hard cases."""
    model = saved_model(spark, sf)
    work = scratch_path(spark, "stream-score")
    src = V.reports(spark, sf).where("label_sum > 0").select("primaryid", F.col(V.TEXT).alias("text"), *Y)
    src.write.parquet(work + "/in")
    pairs = F.array(*[F.struct(F.lit(y[2:]).alias("label"), F.col(y).cast("int").alias("y")) for y in Y])

    def score(batch):
        truth = batch.select("primaryid", F.explode(pairs).alias("p")).select("primaryid", "p.label", "p.y")
        return TM.predict(model, batch, "primaryid").join(truth, ["primaryid", "label"])
    return running_topn(spark, work + "/in", spark.read.parquet(work + "/in").schema, "primaryid", 30, work, score=score)


@query("sink_matrix", SEL_SQL + """
SELECT ds.split, count(*) AS n_rows, (SELECT count(*) FROM sel)::INTEGER AS n_features FROM ds GROUP BY ds.split""")
def sink_matrix(spark, sf):
    """A10: the assembled matrix (id, split, features, y_*) written as parquet and read back; rows per split."""
    return model_frame(spark, sf).matrix.groupBy("split").agg(F.sum("copies").alias("n_rows"), F.max("size").alias("n_features"))


@query("smote_oversample", """
SELECT c.label AS class, greatest(t.n - c.n, c.n) - least(t.n - c.n, c.n) AS n_synthetic
FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label) c, (SELECT count(*) AS n FROM embeddings) t
WHERE t.n > c.n""")
def smote_oversample(spark, sf):
    """Per class of ``embeddings`` (one-vs-rest), SMOTE rows that raise the minority to the majority."""
    from pyspark.ml.functions import array_to_vector
    e = V.table(spark, sf, "embeddings").select(
        F.col("vec_id"), array_to_vector(F.col("embedding").cast("array<double>")).alias("vec"), "label")
    e = e.checkpoint(eager=True)
    dim = len(e.select("vec").first()[0])
    classes = sorted(r[0] for r in e.select("label").distinct().collect())  # class values: a short list
    out = None
    for c in classes:
        b = e.select(F.col("vec_id").cast("string").alias("vec_id"), "vec",
                     (F.col("label") == c).cast("int").alias("y"))
        syn = MD.smote(b, "vec_id", "vec", "y", dim)
        row = syn.agg(F.count(F.lit(1)).alias("n_synthetic")).select(F.lit(c).alias("class"), "n_synthetic")
        out = row if out is None else out.unionByName(row)
    return out


def smote_plan(mf: ModelFrame):
    """(synthetic rows, plan) of all labels, from the train split."""
    train = _part(mf, "train").select("primaryid", *Y)
    x, mine = mf.matrix.select("primaryid", "idx", "value"), mf.matrix.where(F.col("split") == "train").select("primaryid", "idx", "value")
    if not OV.once(x, "primaryid"):  # an id may have rows in several splits, which are one row to SMOTE
        mine = x.join(mine.select("primaryid"), "primaryid", "left_semi")
    rows, plan = OV.smote_rows(mine, train, "primaryid", Y)
    return settle(rows, "smote-rows-made"), plan


_SMOTE_SQL = " UNION ALL ".join(f"SELECT '{y[2:]}' AS label, sum({y}) AS pos, count(*) AS n FROM ds WHERE split = 'train'" for y in Y)


@query("smote_sparse", SEL_SQL + f"""
SELECT label, CAST(least(pos, n - pos) AS BIGINT) AS n_min, CAST(abs(n - 2 * pos) AS BIGINT) AS n_synthetic, CAST(abs(n - 2 * pos) AS BIGINT) AS n_on_segment
FROM ({_SMOTE_SQL}) WHERE pos > 0 AND pos < n AND 2 * pos <> n""")
def smote_sparse(spark, sf):
    """SMOTE on the sparse training features, all labels: minority size, synthetic rows, and how many lie on the segment between
    their two rows of the class (each value between those of both)."""
    mf = model_frame(spark, sf)
    rows, plan = smote_plan(mf)
    fine = OV.compared(rows, plan, mf.matrix.select("primaryid", "idx", "value"), "primaryid")
    n = OV.minority(_part(mf, "train").select("primaryid", *Y), "primaryid", Y)[1].select("label", "n_min")
    return fine.groupBy("label").agg(F.count(F.lit(1)).alias("n_synthetic"), F.count_if(~F.col("off")).alias("n_on_segment")).join(n, "label")


@query("smote_fit")
def smote_fit(spark, sf):
    """G10 + M1: the logistic models fitted on train with and without the synthetic rows, thresholds tuned on val: test F1 of both per label."""
    mf = model_frame(spark, sf)
    rows, plan = smote_plan(mf)
    train = _part(mf, "train")
    plain, _, _ = evaluate(mf, MD.LOGREG_C2, train)
    made = plan.select("label", "syn", "class").join(rows.hint("merge"), ["label", "syn"], "left")  # a row without a feature stays
    empty = lambda c: F.coalesce(c, F.array().cast(made.schema[c].dataType)).alias(c)
    vectors, _ = MD.assemble_rows(made.select("label", "class", empty("idx"), empty("value")), mf.n_features)
    models = {}
    for y in Y:
        more = vectors.where(F.col("label") == y[2:]).select(F.col("class").cast("int").alias(y), "features")
        models |= MD.fit_ovr(train.select(F.col(y).cast("int").alias(y), "features").unionByName(more), [y], MD.LOGREG_C2)
    thr = M.tune_quantile(settle(MD.score_ovr(models, _part(mf, "val"), "primaryid", MD.LOGREG_C2), "smote-scores"))
    conf = M.confusion(M.apply_thresholds(MD.score_ovr(models, _part(mf, "test"), "primaryid", MD.LOGREG_C2), thr))
    added = plan.groupBy("label").agg(F.count(F.lit(1)).alias("n_synthetic"))
    return (plain.select("label", "support", F.col("f1").alias("f1_plain")).join(conf.select("label", F.col("f1").alias("f1_smote")), "label")
            .join(added, "label", "left").na.fill(0, ["n_synthetic"]))
