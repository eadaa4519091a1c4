"""Custom operators against brute force on small fixtures."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkiln.operators import metrics as M
from labelkiln.operators.features import ordered_index
from labelkiln.sources import files as FS


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.random(3000), np.full(1500, 0.25)])  # a hot value
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r.k, r.q_idx): r.q for r in M.exact_quantiles(df, ["k"], "v", M.QUANTILE_LEVELS, 64).collect()}
    for k in ("a", "b"):
        arr = np.array([v for kk, v in rows if kk == k])
        want = np.quantile(arr, M.QUANTILE_LEVELS)
        for i, w in enumerate(want):
            assert got[(k, i)] == pytest.approx(w, abs=1e-12)


def _tune_brute(y, s, grid):
    best_f, best_t = -1.0, None
    for t in grid:
        p = s >= t
        tp, fp, fn = int((p & (y == 1)).sum()), int((p & (y == 0)).sum()), int((~p & (y == 1)).sum())
        pr = tp / (tp + fp) if tp + fp else 0.0
        rc = tp / (tp + fn) if tp + fn else 0.0
        f = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        if f > best_f:
            best_f, best_t = f, t
    return best_t, best_f


def test_threshold_tuning_matches_loop(spark):
    rng = np.random.default_rng(1)
    rows = []
    for lab in ("a", "b", "c"):
        y = (rng.random(800) < (0.3 if lab != "c" else 0.0)).astype(int)
        s = np.clip(0.5 * y + 0.6 * rng.random(800), 0, 1)
        rows += [(i, lab, int(yy), float(ss)) for i, (yy, ss) in enumerate(zip(y, s))]
    df = spark.createDataFrame(rows, "id long, label string, y int, score double")
    got = {r.label: (r.threshold, r.best_f1) for r in M.tune_quantile(df).collect()}
    grid_got = {r.label: (r.threshold, r.best_f1) for r in M.tune_grid(df).collect()}
    for lab in ("a", "b"):
        y = np.array([r[2] for r in rows if r[1] == lab])
        s = np.array([r[3] for r in rows if r[1] == lab])
        t, f = _tune_brute(y, s, np.unique(np.quantile(s, M.QUANTILE_LEVELS)))
        assert got[lab][0] == pytest.approx(t) and got[lab][1] == pytest.approx(f)
        t2, f2 = _tune_brute(y, s, np.array(M.BASE_GRID))
        assert grid_got[lab][0] == pytest.approx(t2) and grid_got[lab][1] == pytest.approx(f2)
    assert got["c"] == (1.0, 0.0)          # no positives, probabilities
    assert grid_got["c"] == (0.5, 0.0)     # no positives, fixed grid


def test_ordered_index_is_exact_rank(spark):
    rng = np.random.default_rng(2)
    vals = [f"{x:08x}" for x in rng.integers(0, 2**32, 2000)]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = {r.t: r.idx for r in ordered_index(df, "t", F.substring("t", 1, 1)).collect()}
    assert [got[v] for v in sorted(set(vals))] == list(range(len(set(vals))))


def test_read_delimited_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="lk-test-", dir="/tmp")
    p = os.path.join(d, "t.txt")
    with open(p, "w") as f:
        f.write("a$b$c\n1$2$3\n4$5\n6$7$8$9\n10$11$12\n")
    rows = [tuple(r) for r in FS.read_delimited(spark, p, "$").collect()]
    # the long row is skipped; the short row is kept with a null
    assert rows == [("1", "2", "3"), ("4", "5", None), ("10", "11", "12")]


def test_sniff_separator(spark):
    d = tempfile.mkdtemp(prefix="lk-test-", dir="/tmp")
    paths = []
    for name, text in (("p.txt", "\n\na|b|c\n1|2|3\n"), ("s.txt", "a;b,c;d\n")):
        paths.append(os.path.join(d, name))
        with open(paths[-1], "w") as f:
            f.write(text)
    got = {os.path.basename(r.file): r.sep for r in FS.sniff_separators(spark, paths).collect()}
    assert got == {"p.txt": "|", "s.txt": ";"}


def test_smote_makes_exact_deficit(spark):
    from pyspark.ml.functions import array_to_vector
    from labelkiln.operators.models import smote
    rng = np.random.default_rng(3)
    rows = [(str(i), [float(x) for x in rng.standard_normal(4)], int(i < 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, e array<double>, y int").select(
        "id", array_to_vector("e").alias("vec"), "y")
    syn = smote(df, "id", "vec", "y", dim=4)
    assert syn.count() == 170 - 30
    assert syn.select("id").distinct().count() == 140


def test_labels_without_a_threshold_take_the_default(spark):
    scores = spark.createDataFrame([(1, "a", 1, 0.3), (2, "a", 0, 0.2), (1, "b", 1, 0.5), (2, "b", 0, 0.49), (1, "c", 0, 0.9)],
                                   "primaryid int, label string, y int, score double")
    thr = spark.createDataFrame([("a", 0.25), ("z", 0.1)], "label string, threshold double")  # no score of z
    got = {r["label"]: (r["threshold"], r["origin"], r["n_reports"], r["n_pred"]) for r in M.thresholds_in_use(scores, thr).collect()}
    assert got == {"a": (0.25, "tuned", 2, 1), "b": (0.5, "default", 2, 1), "c": (0.5, "default", 1, 1)}
    assert M.thresholds_in_use(scores.limit(0), thr).count() == 0
    assert {r["origin"] for r in M.thresholds_in_use(scores, thr.limit(0)).collect()} == {"default"}


def test_a_filter_does_not_repeat_the_cleaning(spark):
    from labelkiln.plans import views as V
    df = spark.createDataFrame([(1, "red bolt; old widget"), (2, "anvil"), (3, None), (4, " hot rod ;; new ring")], "primaryid long, REAC_pt string")
    out = V.clean_and_label(df).where((F.col("REAC_n_rows_symptom_v2") > 0) & (F.col("label_sum") > 0))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(REAC_pt_symptom_v2") == len(V.PARTS.y_cols)
    got = {r["primaryid"]: r for r in out.collect()}
    assert set(got) == {1, 4} and got[1]["REAC_pt_symptom_v2"] == "red bolt" and got[1]["REAC_pt_dropped_v2"] == "old widget"
    assert got[4]["REAC_pt_symptom_v2"] == "hot rod; new ring" and got[4]["REAC_n_rows_symptom_v2"] == 2 and got[4]["label_sum"] == 4


def test_splits_exchange_bytes_of_hashes_once(spark):
    import hashlib

    from labelkiln.operators import splits as S
    df = spark.createDataFrame([(i, f"text {i % 30}" if i % 31 else None, i % 2) for i in range(90)], "id long, text string, y_a int")
    a = S.noleak_group_split(df, "text", "id", ["y_a"])
    ds = S.split_propagate(df, "text", a)
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    split = {r["text_hash"]: r["split"] for r in a.collect()}
    assert ds.columns == ["text_hash", "id", "text", "y_a", "split"]
    got = ds.collect()
    assert len(got) == 90 and all(r["text_hash"] == md5(r["text"]) and r["split"] == split[md5(r["text"])] for r in got)
    texts = {r["text"] or "" for r in got}
    strata = {}
    for t in texts:  # the label of the first row of the text; no positive: a stratum of its own
        strata.setdefault(min((r["id"], r["y_a"]) for r in got if (r["text"] or "") == t)[1], []).append(t)
    for ts in strata.values():
        n = (len(ts) * 10 + 50) // 100
        h = lambda t: hashlib.md5(f"42|{t}".encode()).hexdigest()
        assert {t for t in ts if split[md5(t)] == "test"} == set(sorted(ts, key=h)[:n])
    assert len(bytes(df.select(S.hash_bytes(S.text_hash(F.col("text")))).first()[0])) == 16
