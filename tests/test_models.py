"""Invariants of the model queries (rows-only in the oracle gate) at sf0.001."""

import numpy as np
from pyspark.sql import functions as F

from labelkiln.operators import metrics as M
from labelkiln.plans.catalog import load_all

SF = "/root/testdata/sf0.001"


def test_logreg_scores_are_probabilities_and_beat_always_zero(spark):
    pred = load_all()["score_matrix"].fn(spark, SF)
    r = pred.agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    assert r["n"] > 0 and 0.0 <= r["lo"] <= r["hi"] <= 1.0
    mm = M.micro_macro(M.confusion(pred)).first()
    assert mm["micro_f1"] > 0.0  # the always-0 control scores exactly 0


def test_per_label_metrics_are_bounded(spark):
    conf = load_all()["ovr_logreg"].fn(spark, SF).collect()
    assert len(conf) == 8
    assert all(0.0 <= r["f1"] <= 1.0 and 0.0 <= r["precision"] <= 1.0 for r in conf)


def test_saved_model_scores_like_the_fit(spark):
    from labelkiln.operators import models as MD
    from labelkiln.operators import textmodel as TM
    from labelkiln.plans import catalog_models as CM
    from labelkiln.plans import views as V
    fam, models, thr, n_fit, n_cal = CM.final_model(spark, SF)
    frame = CM.model_frame(spark, SF).frame
    test = frame.where("split = 'test'")
    assert n_fit + n_cal == frame.where("split <> 'test'").count() and n_cal < n_fit
    pred = M.apply_thresholds(MD.score_ovr(models, test, "primaryid", fam), thr)
    want = {(r["primaryid"], r["label"]): (r["score"], r["pred"]) for r in pred.collect()}
    model = CM.saved_model(spark, SF)
    assert CM.saved_model(spark, SF).labels.inputFiles() == model.labels.inputFiles()  # a second call fits nothing
    texts = V.reports(spark, SF).select("primaryid", F.col(V.TEXT).alias("text"))
    got = {(r["primaryid"], r["label"]): (r["score"], r["pred"]) for r in TM.predict(model, texts, "primaryid").collect()}
    assert set(want) <= set(got)
    assert all(abs(got[k][0] - want[k][0]) < 1e-6 for k in want)
    assert sum(got[k][1] != want[k][1] for k in want) <= 0.01 * len(want)  # a score on its threshold may fall to either side


def test_search_goes_on_where_it_ended(spark, monkeypatch):
    from labelkiln.operators import models as MD
    from labelkiln.plans import catalog_models as CM
    from labelkiln.session import shared_uri
    runs = []

    def fake(mf, fam, *parts):
        runs.append(fam.name)
        return spark.createDataFrame([("a", 1, 1, 0, 0, 1.0, 1.0, 1.0)], "label string, support long, tp long, fp long, fn long, precision double, recall double, f1 double"), None, None
    monkeypatch.setattr(CM, "evaluate", fake)
    folder, mf = shared_uri(spark, "trials-test"), CM.model_frame(spark, SF)
    assert CM.run_search(spark, mf, folder, 2).count() == 2
    rows = CM.run_search(spark, mf, folder, 5).orderBy("trial").collect()
    assert [r["trial"] for r in rows] == [0, 1, 2, 3, 4] and len(runs) == 5  # the first two are not fitted again
    assert [r["model"] for r in rows] == [f.name for f in MD.draw_trials(5)] and MD.draw_trials(8)[:5] == MD.draw_trials(5)
    for f in MD.draw_trials(40):
        assert f.C is None or 0.25 <= f.C <= 8 if f.alpha is None else 1e-6 <= f.alpha <= 1e-4


def brute_nearest(vectors, k):
    ids = sorted(vectors)
    keys = sorted({i for v in vectors.values() for i in v})
    m = np.array([[vectors[i].get(c, 0.0) for c in keys] for i in ids])
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return {i: np.sort(d[a])[:k] for a, i in enumerate(ids)}


def test_smote_neighbours_and_segments(spark):
    from labelkiln.operators import oversample as OV
    rng = np.random.default_rng(4)
    rows = {i: {int(c): float(v) for c, v in zip(rng.choice(60, 6, replace=False), rng.random(6) + 0.1)} for i in range(900)}
    rows |= {i: dict(rows[i % 40]) for i in range(900, 1300)}  # groups of equal rows
    x = spark.createDataFrame([(i, c, v) for i, r in rows.items() for c, v in r.items()], "id long, idx int, value double")
    members = spark.createDataFrame([("a", i) for i in rows if i % 2] + [("b", i) for i in rows if i % 5 == 0], "label string, id long")
    got = {}
    for r in OV.nearest(x, "id", members, 3).collect():
        got.setdefault((r["label"], r["id"]), []).append(r["dist"])
    hits = total = 0
    for label, keep in (("a", lambda i: i % 2), ("b", lambda i: i % 5 == 0)):
        for i, want in brute_nearest({i: r for i, r in rows.items() if keep(i)}, 3).items():
            found = sorted(got[label, i])
            hits += sum(d <= want[-1] + 1e-6 for d in found)
            total += 3
    assert hits / total >= 0.9
    y = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 7 != 0), 0) for i in rows], "id long, y_a int, y_b int, y_c int")
    entries, plan = OV.smote(x, y, "id", ["y_a", "y_b", "y_c"])
    syn = {}
    for r in entries.collect():
        syn.setdefault((r["label"], r["syn"]), {})[r["idx"]] = r["value"]
    plans = plan.collect()
    third, seventh = sum(i % 3 == 0 for i in rows), sum(i % 7 == 0 for i in rows)
    count = lambda lab: sum(p["label"] == lab for p in plans)
    assert (count("a"), count("b"), count("c")) == (len(rows) - 2 * third, len(rows) - 2 * seventh, 0)  # one class: nothing to do
    assert len({(p["label"], p["syn"]) for p in plans}) == len(plans) and {p["class"] for p in plans if p["label"] == "b"} == {0}
    for p in plans[::7]:
        a, b = rows[p["a"]], rows[p["b"]]
        assert 0 <= p["u"] < 1 and (p["a"] % 3 == 0 == p["b"] % 3 if p["label"] == "a" else p["a"] % 7 == 0 == p["b"] % 7)
        for c in a.keys() | b.keys():
            assert abs(syn[p["label"], p["syn"]][c] - ((1 - p["u"]) * a.get(c, 0) + p["u"] * b.get(c, 0))) < 1e-12


def test_smote_edges(spark):
    from labelkiln.operators import oversample as OV
    x = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0), (2, 1, 1.0), (3, 1, 1.0), (4, 0, 3.0)], "id long, idx int, value double")
    y = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0)], "id long, y_a int")
    entries, plan = OV.smote(x, y, "id", ["y_a"])  # a class of one row: its copies are the row
    assert [(r["a"], r["b"]) for r in plan.collect()] == [(1, 1)] * 2
    assert all(abs(r["value"] - 1.0) < 1e-12 for r in entries.collect())
    assert OV.smote(x.limit(0), y.limit(0), "id", ["y_a"])[1].count() == 0


def test_batch_predict_answers_every_kind_of_request(spark):
    rows = {r["request"]: r for r in load_all()["batch_predict"].fn(spark, SF).collect()}
    assert {r["status"] for r in rows.values()} == {"FOUND", "NOT_FOUND", "NEW_TEXT"}
    for r in rows.values():
        assert (r["pred_labels"] is None) == (r["status"] == "NOT_FOUND")
    assert "thermal" in rows["new-1"]["pred_labels"]


def test_stream_scoring(spark):
    rows = load_all()["stream_scoring_topn"].fn(spark, SF).collect()
    assert 0 < len(rows) <= 30 and all(r["true_n"] > 0 for r in rows)


def test_selection_of_n_rows(spark):
    from labelkiln.operators.select import largest, smallest_hash
    rows = [(f"t{k:04d}", k % 17) for k in range(3000)]
    df = spark.createDataFrame(rows, "term string, cf long")
    for n in (1, 176, 177, 900, 2999, 3000, 4000):
        want = {t for t, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:n]}
        assert {r["term"] for r in largest(df, "cf", "term", n).collect()} == want
    h = df.select("term", F.md5("term").alias("h"))
    for n in (1, 500, 3000, 5000):
        want = {r["term"] for r in h.orderBy("h", "term").limit(n).collect()}
        assert {r["term"] for r in smallest_hash(h, "h", "term", n).collect()} == want
    assert largest(df.limit(0), "cf", "term", 5).count() == 0


def plain_platt(m, y, steps=200):
    """The same optimum by Newton's method in plain numpy."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack((m, np.ones_like(m)), 1)
    loss = lambda v: (np.logaddexp(0, x @ v) - t * (x @ v)).sum()
    v = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ v))
        d = np.linalg.pinv(x.T @ (x * (p * (1 - p))[:, None])) @ (x.T @ (p - t))
        k = 1.0
        while loss(v - k * d) > loss(v) and k > 1e-8:
            k /= 2
        v = v - k * d
    return v


def test_calibration_equals_plain_newton(spark):
    from labelkiln.operators import models as MD
    rng = np.random.default_rng(2)
    groups = {"noisy": (m := rng.normal(size=300), (rng.random(300) < 1 / (1 + np.exp(-2 * m))).astype(int)),
              "apart": (m := rng.normal(size=80) * 5, (m > 0).astype(int)), "reversed": (m := rng.normal(size=60), (m < 0.3).astype(int)),
              "none": (rng.normal(size=30), np.zeros(30, int)), "all": (rng.normal(size=30), np.ones(30, int)),
              "equal": (np.full(40, 1.5), (np.arange(40) % 4 == 0).astype(int)), "one": (np.array([2.0]), np.array([1]))}
    rows = [(k, f, float(a), int(b)) for k, (m, y) in groups.items() for f in range(2) for a, b in zip(m, y)]
    df = spark.createDataFrame(rows, "label string, fold int, m double, y int")
    got = {(r["label"], r["fold"]): np.array([r["a"], r["b"]]) for r in MD.sigmoid_calibration(df, ["label", "fold"]).collect()}
    for k, (m, y) in groups.items():
        want = plain_platt(m, y)
        for f in range(2):
            p, q = (1 / (1 + np.exp(-(v[0] * m + v[1]))) for v in (got[k, f], want))
            assert np.abs(p - q).max() < 1e-6, k
            assert k in ("equal", "one") or np.abs(got[k, f] - want).max() < 1e-6 * max(1, np.abs(want).max()), k


def test_shared_folders_keep_their_file_system(spark):
    """A folder without scheme is on the default file system, whatever that is; one with a scheme stays there."""
    from labelkiln.session import qualified, shared_uri
    hadoop = spark._jsc.hadoopConfiguration()
    default = hadoop.get("fs.defaultFS")
    try:
        hadoop.set("fs.viewfs.mounttable.store.link./tmp", "file:///tmp")
        hadoop.set("fs.defaultFS", "viewfs://store/")
        assert qualified(spark, "/tmp/shared-test") == "viewfs://store/tmp/shared-test"
        assert qualified(spark, "file:/tmp/shared-test") == "file:///tmp/shared-test"
    finally:
        hadoop.set("fs.defaultFS", default)
    assert "://" in shared_uri(spark, "x")


def test_concurrent_fits_go_by_the_vectors_memory_not_their_files(spark, monkeypatch):
    from labelkiln.operators import models as MD
    lists = F.transform(F.sequence(F.lit(0), F.lit(199)), lambda i: i.cast("int")).alias("idx")
    rows = spark.range(2000).select("id", lists, F.transform(lists, lambda i: (i + 1).cast("double")).alias("value"))
    vectors, _ = MD.assemble_rows(rows, 200)  # 12 bytes an entry and 24 a row: 4.8 MB; their files hold each value once
    monkeypatch.setattr(MD, "FIT_BYTES", 10_000_000)
    assert MD.fit_threads(vectors) == 2
    monkeypatch.setattr(MD, "FIT_BYTES", 64 << 30)
    monkeypatch.setattr(MD, "memory_bytes", lambda s: 30_000_000)
    assert MD.fit_threads(vectors) == 3
    none = vectors.where("id < 0").withColumn("y_a", F.lit(1))
    assert MD.fit_ovr(none, ["y_a"], MD.LOGREG_C2) == {"y_a": ("const", 1.0)}


def test_shap_of_one_fit_writes_no_vectors_and_equals_the_written_frame(spark):
    import os

    from labelkiln.operators import models as MD
    from labelkiln.plans import catalog_models as CM
    from labelkiln.session import ensure_checkpoint_dir
    folders = lambda: {f for f in os.listdir(ensure_checkpoint_dir(spark)) if f.startswith("vectors")}
    CM._MEMO.clear()
    before = folders()
    got = load_all()["linear_shap_local_logreg"].fn(spark, SF).collect()
    whole = load_all()["linear_shap_logreg"].fn(spark, SF).collect()
    assert folders() == before and len(got) == CM.SHAP_LOCAL and len(whole) == CM.SHAP_TOP + 1
    mf = CM.model_frame(spark, SF)
    train, y = CM._part(mf, "train"), f"y_{got[0]['label']}"
    coef = MD.coefficients(MD.fit_ovr(train, [y], MD.LOGREG_C2_BAL), spark)
    bg = CM._hash_pick(train, CM.SHAP_BACKGROUND, 1)
    mu = mf.x.join(bg, "primaryid", "left_semi").groupBy("idx").agg((F.sum("value") / F.lit(float(bg.count()))).alias("mu"))
    phi = MD.local_shap(mf.x, "primaryid", got[0]["primaryid"], coef, mu, mf.n_features).join(mf.names, "idx")
    want = {(r["name"], r["space"]): r["phi"] for r in phi.collect()}
    assert all(abs(want[r["name"], r["space"]] - r["phi"]) < 1e-6 for r in got)
    assert min(abs(r["phi"]) for r in got) >= sorted(map(abs, want.values()))[-CM.SHAP_LOCAL] - 1e-6


def test_csr_lists_never_go_through_the_driver(spark, tmp_path):
    from labelkiln.sources import csr as CSR
    frame = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(20)], "id long, split string")
    x = spark.createDataFrame([(i, [0, i + 1], [0.5, float(i)]) for i in range(0, 20, 2)], "id long, idx array<int>, value array<double>")
    x.write.parquet(str(tmp_path / "x"))  # a small file, whatever its lists hold
    x = spark.read.parquet(str(tmp_path / "x"))
    plan = CSR.shards_of(frame, x, "id", 4)._jdf.queryExecution().executedPlan().toString()
    broadcasts = [part.split("BroadcastExchange")[0] for part in plan.split("BroadcastHashJoin")[1:]]
    assert "SortMergeJoin" in plan and not any("LeftOuter" in b for b in broadcasts)
    shards = spark.read.parquet(CSR.write(frame, x, "id", str(tmp_path / "csr"), 4))
    got = {r["id"]: (r["idx"], r["value"]) for r in CSR.read_rows(shards, "id").collect()}
    assert got == {i: ([0, i + 1], [0.5, float(i)]) if i % 2 == 0 else ([], []) for i in range(20)}


def test_smote_rows_travel_as_lists(spark):
    from labelkiln.operators import oversample as OV
    rng = np.random.default_rng(5)
    rows = {i: {int(c): float(v) for c, v in zip(sorted(rng.choice(30, 5, replace=False)), rng.random(5) + 0.1)} for i in range(60)}
    lists = spark.createDataFrame([(i, list(r), list(r.values())) for i, r in rows.items()] + [(60, [], [])], "id long, idx array<int>, value array<double>")
    y = spark.createDataFrame([(i, int(i % 4 == 0)) for i in rows] + [(60, 1)], "id long, y_a int")
    made, plan = OV.smote_rows(lists, y, "id", ["y_a"])
    made, plan = made.cache(), plan.cache()
    steps = made._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in steps  # no entry is a table row that has to be collected again
    got = {r["syn"]: dict(zip(r["idx"], r["value"])) for r in made.collect()}
    for p in plan.collect():
        a, b = rows.get(p["a"], {}), rows.get(p["b"], {})
        want = {c: (1 - p["u"]) * a.get(c, 0) + p["u"] * b.get(c, 0) for c in sorted(a.keys() | b.keys())}
        assert list(got.get(p["syn"], {})) == list(want) and np.allclose(list(got.get(p["syn"], {}).values()), list(want.values()), atol=1e-12)
    assert {(r["syn"], r["off"]) for r in OV.compared(made, plan, lists, "id").collect()} == {(s, False) for s in got}
    wrong = made.withColumn("value", F.when(F.col("syn") == min(got), F.transform("value", lambda v: v + 1e-3)).otherwise(F.col("value")))
    wrong = wrong.withColumn("idx", F.when(F.col("syn") == max(got), F.transform("idx", lambda i: i + 100)).otherwise(F.col("idx")))
    assert {r["syn"] for r in OV.compared(wrong, plan, lists, "id").collect() if r["off"]} == {min(got), max(got)}
    twice = lists.where("id < 2").unionByName(lists.where("id = 1"))  # an id in two rows is one row with the entries of both
    assert {r["id"]: r["idx"] for r in OV.listed(twice, "id").collect()} == {0: list(rows[0]), 1: sorted(2 * list(rows[1]))}


def test_prediction_stays_inside_the_row(spark):
    from labelkiln.operators import textmodel as TM
    terms = [("word", "hot", 1.5, 0), ("word", "bolt", 1.2, None), ("char", " ho", 2.0, 1), ("char", "lt ", 1.1, None)]
    weights, meta = [(0, "a", 2.0), (1, "a", -1.0), (2, "a", 0.5), (1, "b", 3.0)], [(1, 2)]
    labels = [("a", 0.25, 0.5, "proba"), ("b", -1.0, 0.0, "score"), ("c", -50.0, 0.5, "proba")]
    model = TM.TextModel(spark.createDataFrame(terms, "space string, term string, idf double, idx int"), spark.createDataFrame(weights, "idx int, label string, w double"),
                         spark.createDataFrame(meta, "place int, idx int"), spark.createDataFrame(labels, "label string, intercept double, threshold double, kind string"))
    rows = spark.createDataFrame([("x", "hot bolt"), ("y", "bolt"), ("y", "hot; hot"), ("z", None), (None, "hot")], "id string, text string")
    plan = TM.predict_rows(model, rows, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan  # the texts travel once, no term does
    log = lambda n: 1 + np.log(n)
    norm = lambda *v: np.sqrt(sum(x * x for x in v))
    word = {"x": 1.5 / norm(1.5, 1.2), "y": 1.5 * log(2) / norm(1.5 * log(2), 1.2), "z": 0.0, None: 0.0}
    char = {"x": 2.0 / norm(2.0, 1.1), "y": 2.0 * log(2) / norm(2.0 * log(2), 1.1), "z": 0.0, None: 0.0}
    n_terms = {"x": 1, "y": 1 + 2, "z": 0, None: 0}  # both rows of an id count
    got = {}
    for r in TM.predict(model, rows, "id").collect():
        got.setdefault((r["id"], r["label"]), []).append((r["score"], r["threshold"], r["pred"]))
    assert {k: len(v) for k, v in got.items()} == {(i, c): 1 + (i == "y") for i in word for c in "abc"}
    for i in word:
        a = 1 / (1 + np.exp(-(2 * word[i] - char[i] + 0.5 * n_terms[i] + 0.25)))
        want = {"a": (a, 0.5), "b": (3 * char[i] - 1.0, 0.0), "c": (1 / (1 + np.exp(50.0)), 0.5)}
        for c, (score, threshold) in want.items():
            assert all(np.isclose(s, score, atol=1e-9) and t == threshold and p == int(score >= threshold) for s, t, p in got[i, c])
