"""One-vs-rest linear models on long-form features.

* Vectors are assembled from ``(id, idx, value)`` per id -- a row's own
  features, so the group is bounded -- in front of ML fits.
* Spark's ``OneVsRest`` is multiclass (one label per row), so multilabel
  OvR is a loop of binary fits; fits run as concurrent Spark jobs from a
  small driver thread pool over one checkpointed training frame.
* sklearn ``C`` maps to ``regParam = 1 / (C * sum(weights))`` with
  ``standardization=False``; ``balanced`` weights are n / (2 * n_class).
* A label with one class in train gets a constant score (no fit).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import COMPRESSION, settle, shared_uri

FIT_THREADS = 8  # concurrent label fits (driver threads, one Spark job each)
FIT_SHARE, FIT_BYTES = 0.5, 64 << 30  # a fit keeps its own blocks of the training vectors: those of concurrent fits take this share of the executors' memory, and so many bytes, at most
TASK_BYTES = 16 << 20  # vectors of a task of a small fit
MAX_ITER = 200  # fits stop at their tolerance, at this many iterations at the latest
TOL, TOL_SGD = 1e-4, 1e-3  # relative change at which a fit has converged


def assemble(long: DataFrame, id_col: str, n_features: int, keep: DataFrame | None = None) -> DataFrame:
    """(id, idx, value) -> (columns of ``keep``, features): sparse vectors of width n_features, written once.

    A row's own entries are its group, so it is bounded by the row.  The
    vector's own fields are built by Spark, and the written table is read
    back with the vector type, so no row passes through Python.  Rows of
    ``keep`` without an entry get an empty vector.
    """
    entry = F.struct(F.col("idx").cast("int").alias("idx"), F.col("value").cast("double").alias("value"))
    g = long.groupBy(id_col).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    rows = g if keep is None else keep.join(g, id_col, "left")
    e = F.coalesce("_e", F.array().cast("array<struct<idx:int,value:double>>"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(n_features).cast("int").alias("size"),
                      e["idx"].alias("indices"), e["value"].alias("values")).alias("features")
    named = [id_col] if keep is None else keep.columns
    path = shared_uri(long.sparkSession, "vectors")
    rows.select(*named, vector).write.parquet(path, compression=COMPRESSION)
    fields = [rows.schema[c] for c in named]
    return long.sparkSession.read.schema(StructType([*fields, StructField("features", VectorUDT())])).parquet(path)


def assemble_rows(rows: DataFrame, n_features: int) -> tuple[DataFrame, DataFrame]:
    """(vectors, lists) of rows with lists idx (ascending) and value: written once, read with the vector type and as (kept columns, size, idx, value)."""
    named = [c for c in rows.columns if c not in ("idx", "value")]
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(n_features).cast("int").alias("size"),
                      F.col("idx").alias("indices"), F.col("value").alias("values")).alias("features")
    path, plain = shared_uri(rows.sparkSession, "vectors"), rows.select(*named, vector)
    plain.write.parquet(path, compression=COMPRESSION)
    read = rows.sparkSession.read
    lists = read.schema(plain.schema).parquet(path).select(*named, "features.size", F.col("features.indices").alias("idx"), F.col("features.values").alias("value"))
    return read.schema(StructType([*[rows.schema[c] for c in named], StructField("features", VectorUDT())])).parquet(path), lists


def memory_bytes(spark) -> int:
    """What the executors together can hold in memory."""
    held, each = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator(), []
    while held.hasNext():
        each.append(held.next()._1())
    return sum(each) if len(each) == 1 else sum(each) * (len(each) - 1) // len(each)  # the driver is among them


def vector_bytes(train: DataFrame) -> int:
    """What the training vectors take in memory: 12 bytes an entry (their files are many times smaller)."""
    got = train.agg(F.count(F.lit(1)).alias("n"), Summarizer.metrics("numNonZeros").summary(F.col("features")).alias("s")).first()
    return 12 * int(got["s"]["numNonZeros"].toArray().sum()) + 24 * got["n"] if got["n"] else 0


def packed_tightly(train: DataFrame) -> DataFrame:
    """The same rows in tasks of TASK_BYTES of vectors: a step of a fit is one job, which on a small table costs what its tasks cost."""
    return train.coalesce(max(1, -(-vector_bytes(train) // TASK_BYTES)))  # no more tasks than before


def fit_threads(train: DataFrame) -> int:
    """How many fits run at once: FIT_THREADS, fewer where the training vectors are large in memory."""
    size = vector_bytes(train)
    return max(1, min(FIT_THREADS, int(min(FIT_BYTES, FIT_SHARE * memory_bytes(train.sparkSession)) // max(1, size))))


@dataclass(frozen=True)
class Family:
    """A model family: ``kind`` is 'proba' or 'score' (decision value)."""
    name: str
    kind: str
    C: float | None = None
    alpha: float | None = None
    balanced: bool = False
    sigmoid: bool = False
    l1_share: float = 0.0


LOGREG_C2_BAL = Family("logreg_bal_C2", "proba", C=2.0, balanced=True)
LOGREG_C2 = Family("logreg_C2", "proba", C=2.0)
LINEARSVC_C1 = Family("linearsvc_C1", "score", C=1.0)
LINEARSVC_BAL_SIGMOID = Family("linearsvc_bal_sigmoid", "proba", C=1.0, balanced=True, sigmoid=True)
SGD_LOGLOSS = Family("sgd_logloss", "proba", alpha=1e-5)
SGD_ELASTICNET = Family("sgd_logloss_elasticnet", "proba", alpha=1e-5, l1_share=0.15)
SGD_BALANCED = Family("sgd_logloss_balanced", "proba", alpha=1e-5, balanced=True)
SGD_HINGE = Family("sgd_hinge", "score", alpha=1e-5)
COMPLEMENT_NB = Family("complementnb_a05", "proba", alpha=0.5)


def _estimator(fam: Family, label_col: str, sum_w: float, max_iter: int):
    weight = {"weightCol": "_w"} if fam.balanced else {}
    if fam.name.startswith("complementnb"):
        return NaiveBayes(modelType="complement", smoothing=fam.alpha, labelCol=label_col, featuresCol="features")
    reg = fam.alpha if fam.alpha is not None else 1.0 / (fam.C * sum_w)
    cls = LinearSVC if fam.kind == "score" or fam.sigmoid else LogisticRegression
    if cls is LogisticRegression and fam.l1_share:
        weight["elasticNetParam"] = fam.l1_share
    return cls(featuresCol="features", labelCol=label_col, regParam=reg, standardization=False,
               maxIter=max_iter, tol=TOL if fam.alpha is None else TOL_SGD, **weight)


def fit_ovr(train: DataFrame, y_cols: list[str], fam: Family, max_iter: int = MAX_ITER, labels: DataFrame | None = None) -> dict:
    """label column -> fitted model, or ('const', value) for a single-class label.

    ``labels`` are the rows of ``train`` without vectors, where these are computed as they are read.
    """
    stats = (train if labels is None else labels).agg(F.count(F.lit(1)).alias("n"), *[F.sum(y).alias(y) for y in y_cols]).first()
    n = stats["n"]

    def fit(y):
        pos = stats[y] or 0
        if pos == 0 or pos == n:
            return y, ("const", 1.0 if pos == n else 0.0)
        d = train.withColumn("_y", F.col(y).cast("double"))
        sum_w = float(n)
        if fam.balanced:  # n / (2 * n_class): the weights sum to n
            d = d.withColumn("_w", F.when(F.col("_y") == 1, F.lit(n / (2.0 * pos)))
                             .otherwise(F.lit(n / (2.0 * (n - pos)))))
        return y, _estimator(fam, "_y", sum_w, max_iter).fit(d)

    both = any(0 < (stats[y] or 0) < n for y in y_cols)
    with ThreadPoolExecutor(max_workers=fit_threads(train) if both and len(y_cols) > 1 else 1) as pool:
        return dict(pool.map(fit, y_cols))


def score_ovr(models: dict, df: DataFrame, id_col: str, fam: Family, keep: list[str] = ()) -> DataFrame:
    """M6: long (id, label, y, score, kind): probability of class 1, else the decision value
    (a sigmoid of it for the pseudo-probability variant)."""
    rows, scores = df, []
    for y, m in models.items():
        at = f"_s_{y}"
        if isinstance(m, tuple):
            rows = rows.withColumn(at, F.lit(m[1]))
        else:
            raw = m.copy({m.rawPredictionCol: "_raw", m.predictionCol: "_pred"} | ({m.probabilityCol: "_prob"} if m.hasParam("probabilityCol") else {}))
            out = raw.transform(rows)
            if fam.kind == "proba" and not fam.sigmoid:
                s = vector_to_array("_prob")[1]
            elif fam.sigmoid:
                s = F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array("_raw")[1]))
            else:
                s = vector_to_array("_raw")[1]
            rows = out.withColumn(at, s).drop("_raw", "_prob", "_pred")
        scores.append(F.struct(F.lit(y[2:]).alias("label"), F.col(y).cast("int").alias("y"), F.col(at).alias("score")))
    res = rows.select(id_col, *keep, F.explode(F.array(*scores)).alias("_s"))  # one pass over the vectors for all labels
    return res.select(id_col, *keep, "_s.label", "_s.y", "_s.score", F.lit(fam.kind).alias("kind"))


def coefficients(models: dict, spark) -> DataFrame:
    """(label, idx, w) for fitted linear models plus (label, -1, intercept)."""
    rows = []
    for y, m in models.items():
        if isinstance(m, tuple) or not hasattr(m, "coefficients"):
            continue
        w = m.coefficients.toArray()
        rows += [(y[2:], int(i), float(v)) for i, v in enumerate(w)]
        rows.append((y[2:], -1, float(m.intercept)))
    return spark.createDataFrame(rows, "label string, idx int, w double")


def top_coef(coef: DataFrame, k: int) -> DataFrame:
    """Per label the k largest and k smallest coefficients, ranked."""
    c = coef.where(F.col("idx") >= 0)
    hi = c.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("w"), "idx")))
    lo = c.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("w", "idx")))
    return (hi.where(F.col("rank") <= k).withColumn("direction", F.lit("top"))
            .unionByName(lo.where(F.col("rank") <= k).withColumn("direction", F.lit("bottom"))))


def linear_shap(x_long: DataFrame, id_col: str, coef: DataFrame, background_ids: DataFrame,
                explain_ids: DataFrame, n_features: int) -> DataFrame:
    """Per feature mean |phi|, mean phi, mean max(phi, 0), mean min(phi, 0) over the
    explained rows, phi(row, j) = w_j * (x_j - mean_background_j).

    Closed form from the sparse entries: a row without feature j has
    phi = -w_j * mu_j, so each feature needs only sums over its non-zero
    entries and their count -- no (rows x features) grid.
    """
    spark = x_long.sparkSession
    n_bg, n_e = background_ids.count(), explain_ids.count()
    mu = (x_long.join(background_ids, id_col, "left_semi").groupBy("idx")
          .agg((F.sum("value") / F.lit(float(n_bg))).alias("mu")))
    feats = (spark.range(n_features).select(F.col("id").cast("int").alias("idx"))
             .join(mu, "idx", "left").join(coef.where(F.col("idx") >= 0).select("idx", "w"), "idx")
             .select("idx", "w", F.coalesce("mu", F.lit(0.0)).alias("mu")))
    phi = (x_long.join(explain_ids, id_col, "left_semi").select(F.col("idx").cast("int").alias("idx"), "value")
           .join(feats, "idx").select("idx", (F.col("w") * (F.col("value") - F.col("mu"))).alias("phi")))
    nz = phi.groupBy("idx").agg(F.count(F.lit(1)).alias("nnz"), F.sum("phi").alias("s"),
                                F.sum(F.abs("phi")).alias("sa"), F.sum(F.greatest("phi", F.lit(0.0))).alias("sp"),
                                F.sum(F.least("phi", F.lit(0.0))).alias("sn"))
    j = feats.join(nz, "idx", "left").na.fill(0, ["nnz", "s", "sa", "sp", "sn"])
    z, n0, n = -F.col("w") * F.col("mu"), F.lit(n_e) - F.col("nnz"), F.lit(float(n_e))
    return j.select("idx", ((F.col("sa") + n0 * F.abs(z)) / n).alias("mean_abs_phi"),
                    ((F.col("s") + n0 * z) / n).alias("mean_phi"),
                    ((F.col("sp") + n0 * F.greatest(z, F.lit(0.0))) / n).alias("mean_pos_phi"),
                    ((F.col("sn") + n0 * F.least(z, F.lit(0.0))) / n).alias("mean_neg_phi"))


def local_shap(x_long: DataFrame, id_col: str, row_id, coef: DataFrame, mu: DataFrame, n_features: int) -> DataFrame:
    """M12 local: phi of every feature for one row (features left-joined with the row's entries)."""
    spark = x_long.sparkSession
    xr = x_long.where(F.col(id_col) == F.lit(row_id)).select(F.col("idx").cast("int").alias("idx"), "value")
    feats = (spark.range(n_features).select(F.col("id").cast("int").alias("idx"))
             .join(mu, "idx", "left").join(coef.where(F.col("idx") >= 0).select("idx", "w"), "idx"))
    return feats.join(xr, "idx", "left").select(
        "idx", (F.col("w") * (F.coalesce("value", F.lit(0.0)) - F.coalesce("mu", F.lit(0.0)))).alias("phi"))


def _rank_along(df: DataFrame, id_col: str, key: "F.Column", name: str, n_buckets: int = 256) -> DataFrame:
    """Exact 0-based rank of rows by (key, id) without a single-task sort:
    percentile_approx boundaries -> buckets -> bucketed row_number + offsets."""
    from .features import ordered_index
    from .metrics import coarse_of, count_le_2level
    d = df.withColumn("_key", key)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bnd = d.agg(F.percentile_approx("_key", probs, 10 * n_buckets).alias("_bnd"))
    bnd = bnd.select("_bnd", coarse_of(F.col("_bnd"), 16).alias("_coarse"))
    d = d.crossJoin(F.broadcast(bnd)).withColumn(
        "_bk", count_le_2level(F.col("_bnd"), F.col("_coarse"), 16, F.col("_key"))).drop("_bnd", "_coarse")
    d = d.withColumn("_ord", F.struct("_key", id_col))
    return ordered_index(d, "_ord", F.col("_bk"), name).drop("_ord", "_bk", "_key")


def smote(df: DataFrame, id_col: str, vec_col: str, label_col: str, dim: int, k: int = 3, seed: int = 42,
          n_projections: int = 4, window: int = 8) -> DataFrame:
    """Synthetic minority rows x + u * (nn - x) until the minority matches the majority.

    Neighbours without emitting all pairs of any group: minority rows are
    ranked exactly along ``n_projections`` seeded random directions and each
    row is paired with its ``window`` rank-neighbours on each side; the k
    nearest of those candidates (exact distance) are its neighbours.  Each
    minority row j-th copy gets the global index (j-1) * n_min + rank(row),
    and indexes below the deficit are kept -- exactly the deficit, no sort.
    """
    import numpy as np
    counts = df.groupBy(label_col).count().collect()  # two rows
    by = {r[label_col]: r["count"] for r in counts}
    if len(by) < 2:
        return df.limit(0).select(id_col, vec_col, label_col).withColumn("synthetic", F.lit(True))
    minority = min(by, key=lambda c: (by[c], c))
    n_min, n_maj = by[minority], max(by.values())
    deficit = n_maj - n_min
    mino = df.where(F.col(label_col) == minority).select(id_col, vec_col)
    x = vector_to_array(vec_col)
    cands = None
    for t in range(n_projections):
        r = np.random.default_rng(seed + t).standard_normal(dim)
        proj = F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in r]), lambda p, q: p * q),
                           F.lit(0.0), lambda acc, v: acc + v)
        rk = _rank_along(mino.select(id_col, vec_col), id_col, proj, "_rk").select(id_col, "_rk").checkpoint(eager=True)
        nb = rk.select(F.col(id_col).alias("a"), F.explode(F.sequence(F.col("_rk") + 1, F.col("_rk") + window)).alias("_rk"))
        pr = nb.join(rk.select(F.col(id_col).alias("b"), "_rk"), "_rk").select("a", "b")
        pr = pr.unionByName(pr.select(F.col("b").alias("a"), F.col("a").alias("b")))
        cands = pr if cands is None else cands.unionByName(pr)
    cands = cands.distinct().checkpoint(eager=True)  # <= 2 * window * n_projections per row
    va = mino.select(F.col(id_col).alias("a"), vector_to_array(vec_col).alias("_xa"))
    vb = mino.select(F.col(id_col).alias("b"), vector_to_array(vec_col).alias("_xb"))
    dist = F.aggregate(F.zip_with("_xa", "_xb", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda acc, v: acc + v)
    nn = (cands.join(va, "a").join(vb, "b").withColumn("dist", dist)
          .withColumn("_r", F.row_number().over(Window.partitionBy("a").orderBy("dist", "b")))
          .where(F.col("_r") <= k).select("a", "b", "_r"))
    per = -(-deficit // n_min)
    hkey = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"))), 1, 12), 16, 10)
    order = _rank_along(mino.select(id_col), id_col, hkey.cast("bigint"), "_ra").select(F.col(id_col).alias("a"), "_ra")
    cand = (order.select("a", "_ra", F.explode(F.sequence(F.lit(1), F.lit(per))).alias("j"))
            .where((F.col("j") - 1) * F.lit(n_min) + F.col("_ra") < F.lit(deficit))
            .withColumn("_pick", (F.abs(F.xxhash64(F.lit(seed), "a", "j")) % F.lit(k)) + 1))
    # rows with fewer than k candidates fall back to their nearest one
    nmax = nn.groupBy("a").agg(F.max("_r").alias("_kmax"))
    cand = cand.join(nmax, "a").withColumn("_pick", F.least("_pick", "_kmax"))
    syn = (cand.join(nn.withColumnRenamed("_r", "_pick"), ["a", "_pick"]).select("a", "j", "b")
           .join(va, "a").join(vb, "b"))
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "a", "j")), 1, 8), 16, 10).cast("double") / 4294967296.0
    newv = array_to_vector(F.zip_with("_xa", "_xb", lambda p, q: p + u * (q - p)))
    return syn.select(F.concat_ws("-", F.lit("syn"), "a", "j").alias(id_col), newv.alias(vec_col),
                      F.lit(minority).alias(label_col), F.lit(True).alias("synthetic"))


#: Families of the parameter search, in the order of their trials, and the ranges the reference's search draws from (fixed values).
SEARCH_FAMILIES = ["logreg", "linearsvc", "sgd_logloss", "sgd_hinge"]
C_RANGE, ALPHA_RANGE, L1_RANGE = (0.25, 8.0), (1e-6, 1e-4), (0.0, 1.0)


def draw_trials(n: int, seed: int = 42) -> list[Family]:
    """N seeded trials, the families in turn: C or alpha log-uniform, class weights, penalty and l1 share.

    A trial's draws depend on its number alone, so a longer search begins
    with the trials of a shorter one.
    """
    import numpy as np
    out = []
    for trial in range(n):
        rng = np.random.default_rng([seed, trial])
        kind = SEARCH_FAMILIES[trial % len(SEARCH_FAMILIES)]
        log_uniform = lambda lo, hi: float(np.exp(rng.uniform(np.log(lo), np.log(hi))))
        strength, balanced = log_uniform(*(ALPHA_RANGE if kind.startswith("sgd") else C_RANGE)), bool(rng.integers(2))
        elastic = float(rng.uniform(*L1_RANGE)) if rng.integers(2) else 0.0
        name, out_kind = f"{kind}-{trial}", "score" if kind in ("linearsvc", "sgd_hinge") else "proba"
        if kind.startswith("sgd"):
            out.append(Family(name, out_kind, alpha=strength, balanced=balanced, l1_share=elastic if kind == "sgd_logloss" else 0.0))
        else:
            out.append(Family(name, out_kind, C=strength, balanced=balanced))
    return out


#: Newton steps of a sigmoid calibration at most, and the change of both parameters at which it ends.
CAL_STEPS, CAL_TOL = 50, 1e-10


def sigmoid_calibration(margins: DataFrame, keys: list[str]) -> DataFrame:
    """M5: (keys, a, b) with P(y = 1 | m) = 1 / (1 + exp(-(a m + b))) for all groups of ``keys`` together.

    ``margins`` has (keys, m, y).  The cross entropy against Platt's targets
    (n1 + 1) / (n1 + 2) and 1 / (n0 + 2) is minimised by damped Newton steps:
    each step is one aggregate over all rows (gradient, Hessian and loss of
    every group), and only the parameters, one row a group, come to the
    driver.  The targets lie inside (0, 1), so a group with one class, or
    with equal margins, has its optimum too: a constant probability.
    """
    spark = margins.sparkSession
    n = margins.groupBy(*keys).agg(F.sum(F.col("y").cast("double")).alias("n1"), F.count(F.lit(1)).cast("double").alias("n"))
    rows = margins.join(F.broadcast(n), keys).select(  # a row a group
        *keys, F.col("m").cast("double").alias("m"),
        F.when(F.col("y") == 1, (F.col("n1") + 1) / (F.col("n1") + 2)).otherwise(F.lit(1.0) / (F.col("n") - F.col("n1") + 2)).alias("t"))
    rows = settle(rows, "margins")
    schema = StructType([*[margins.schema[k] for k in keys], StructField("a", DoubleType()), StructField("b", DoubleType())])
    state = {tuple(r[k] for k in keys): [0.0, 0.0, None, None, 1.0] for r in n.select(*keys).collect()}  # a, b, loss, step, damping
    live = set(state)
    for _ in range(CAL_STEPS):
        if not live:
            break
        at = spark.createDataFrame([(*k, state[k][0], state[k][1]) for k in sorted(live)], schema)
        z = F.col("a") * F.col("m") + F.col("b")
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        g, w = p - F.col("t"), p * (F.lit(1.0) - p)
        loss = F.greatest(z, F.lit(0.0)) - z * F.col("t") + F.log1p(F.exp(-F.abs(z)))
        sums = rows.join(F.broadcast(at), keys).groupBy(*keys).agg(
            F.sum(g * F.col("m")).alias("ga"), F.sum(g).alias("gb"), F.sum(w * F.col("m") * F.col("m")).alias("haa"),
            F.sum(w * F.col("m")).alias("hab"), F.sum(w).alias("hbb"), F.sum(loss).alias("loss")).collect()
        for r in sums:
            k = tuple(r[c] for c in keys)
            a, b, before, step, damp = state[k]
            if before is not None and r["loss"] > before + 1e-12 * abs(before) and damp > 1e-6:  # too far: half the step
                damp /= 2
                state[k] = [a - step[0] * damp, b - step[1] * damp, before, step, damp]
                continue
            haa, hbb = r["haa"] + 1e-12, r["hbb"] + 1e-12
            det = haa * hbb - r["hab"] ** 2
            if det <= 1e-14 * haa * hbb:  # equal margins: only their sum with b is determined
                da, db = 0.0, -r["gb"] / hbb
            else:
                da, db = -(hbb * r["ga"] - r["hab"] * r["gb"]) / det, -(haa * r["gb"] - r["hab"] * r["ga"]) / det
            state[k] = [a + da, b + db, r["loss"], (da, db), 1.0]
            if max(abs(da), abs(db)) < CAL_TOL * max(1.0, abs(a), abs(b)):
                live.discard(k)
    return spark.createDataFrame([(*k, v[0], v[1]) for k, v in sorted(state.items())], schema)
