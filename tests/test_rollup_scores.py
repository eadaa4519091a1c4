"""The one-list roll-up, scores of all labels from one pass, quantile buckets written once, signs of SMOTE in slices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from labelkiln.operators import models as MD
from labelkiln.operators import oversample as OV
from labelkiln.operators.rollup import agg_table
from labelkiln.plans import catalog_scores as CS
from labelkiln.plans import views as V

LINES = [(1, 1, "red bolt"), (1, 2, " red bolt "), (1, 3, ""), (1, 2, "old gear"), (2, 1, None), (2, 2, "  "), (None, 1, "hot rod"),
         *[(3, i, f"part {i % 60:02d}") for i in range(1, 200)], (3, 0, "")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_list_keeps_blank_keys_and_order(spark):
    df = spark.createDataFrame(LINES, "k long, n long, v string")
    out = agg_table(df, "k", {"items": "v"}, ["n"], [], 50, position=F.col("n"))
    both = agg_table(df, "k", {"items": "v"}, ["n"], ["rows"], 50, position=F.col("n"))
    assert plan(out).count("Exchange hashpartitioning") == 2 and plan(both).count("Exchange hashpartitioning") == 3  # before they run
    got = {r["k"]: r["items"] for r in out.collect()}
    assert got[1] == "red bolt; old gear" and got[2] == "" and got[None] == "hot rod"
    assert got[3] == "; ".join(f"part {i:02d}" for i in range(1, 51))  # a blank value takes no place of the 50
    assert {r["k"]: r["items"] for r in both.collect()} == got


def test_one_list_is_read_off_the_sorted_rows(spark):
    df = spark.createDataFrame(LINES, "k long, n long, v string")
    out = agg_table(df, "k", {"items": "v"}, ["n"], [], 50, as_array=True, position=F.col("n"))
    assert "ObjectHashAggregate" not in plan(out)
    got = {r["k"]: r["items"] for r in out.collect()}
    assert len(got) == 4 and got[1] == ["red bolt", "old gear"] and got[2] == [] and got[3] == [f"part {i:02d}" for i in range(1, 51)]


def tables(spark, folder, lines, parts):
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(1, "s")], "s_suppkey long, s_name string").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(k, 1, "F", "1-URGENT") for k in (1, 2, 3)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"
                          ).write.parquet(f"{folder}/orders.parquet")


def test_the_term_list_is_that_of_all_columns(spark, tmp_path):
    line = lambda o, p, n, s=1, price=1.0: (o, p, s, n, 1.0, price, 0.0, 0.0, "A", "F", None)
    lines = [line(1, 7, 2), line(1, 8, 1), line(1, 9, 1, 5), line(1, 9, 1, 2), line(1, None, None), line(2, 99, 1), line(3, 8, None), line(3, 7, 1), line(1, 7, 1, 9, 0.5)]
    parts = [(7, "old gear"), (8, "red bolt"), (9, "hot rod"), (9, "cold rod"), (10, "x")]  # a key twice
    tables(spark, str(tmp_path), lines, parts)
    few = {r["primaryid"]: r["REAC_pt"] for r in V.report_rollup(spark, str(tmp_path), lists=("REAC_pt",), counts=()).collect()}
    whole = {r["primaryid"]: r["REAC_pt"] for r in V.report_rollup(spark, str(tmp_path)).collect()}
    assert few == whole == {1: "old gear; red bolt; cold rod; hot rod", 2: "", 3: "red bolt; old gear"}
    s = CS.scored(spark, str(tmp_path))
    assert s.count() == 2 * len(V.PARTS.y_cols) and "parquet" in plan(s)  # written as Parquet, not as serialized rows


def test_all_labels_are_scored_by_one_scan(spark):
    rows = spark.createDataFrame([(i, [0, 1], [float(i % 5), float(i % 3)], i % 2, int(i % 5 > 2), 0) for i in range(60)],
                                 "primaryid long, idx array<int>, value array<double>, y_a int, y_b int, y_c int")
    frame, _ = MD.assemble_rows(rows, 2)
    for fam in (MD.LOGREG_C2_BAL, MD.LINEARSVC_C1, MD.LINEARSVC_BAL_SIGMOID):
        models = MD.fit_ovr(frame, ["y_a", "y_b", "y_c"], fam, 20)
        out = MD.score_ovr(models, frame, "primaryid", fam)
        assert plan(out).count("FileScan parquet") == 1
        got = {(r["primaryid"], r["label"]): (r["y"], r["score"], r["kind"]) for r in out.collect()}
        assert len(got) == 180 and got[7, "c"] == (0, 0.0, fam.kind)
        for y in ("y_a", "y_b"):
            for r in models[y].transform(frame).collect():
                want = r["probability"][1] if fam.kind == "proba" and not fam.sigmoid else r["rawPrediction"][1]
                want = 1 / (1 + np.exp(-want)) if fam.sigmoid else want
                assert np.isclose(got[r["primaryid"], y[2:]][1], want, atol=1e-12) and got[r["primaryid"], y[2:]][0] == r[y]


def test_signs_are_held_a_slice_at_a_time(spark, monkeypatch):
    held = []
    signs = OV._signs
    monkeypatch.setattr(OV, "SIGNS", 64)
    monkeypatch.setattr(OV, "_signs", lambda idx, n, seed: held.append(len(idx) * n) or signs(idx, n, seed))
    lists = [[1, 2, 3], [], [4], list(range(40)), [], [5, 6], [7]]
    batch = pa.record_batch({"idxs": pa.array(lists, pa.list_(pa.int32())), "values": pa.array([[float(i + 1) for i in x] for x in lists], pa.list_(pa.float64()))})
    seen = []

    class Rows:
        schema = spark.createDataFrame([], "idxs array<int>, values array<double>").schema

        def mapInArrow(self, run, schema):
            seen.extend(run(iter([batch])))
    OV._projected(Rows(), "id", 8, 3)
    for x, p in zip(lists, seen[0].column("p").to_pylist()):
        assert np.allclose(p, (signs(np.array(x, np.int32), 8, 3) * (np.array(x)[:, None] + 1.0)).sum(0) if x else np.zeros(8))
    assert len(held) > 1 and max(held) <= 40 * 8 + 64  # a slice beyond a long row, never the batch


def test_roll_up_shuffles_rows_once_but_those_of_hot_keys(spark, monkeypatch):
    from labelkiln.operators import rollup
    rows = [(1, i % 900 + 1, f" a{(i * 37) % 211}", "x" if i % 5 else None, "") for i in range(3000)] + [(2, 7, "b", None, ""), (2, 3, "c", "y", ""), (2, 3, "b", "z", ""), (None, 1, "d", "w", "")]
    df = spark.createDataFrame(rows, "k long, o int, a string, b string, e string")
    cols, seen = {"A": "a", "B": "b", "E": "e"}, []
    want = sorted(map(tuple, agg_table(df, "k", cols, ["o"], ["n"], 50).select("k", "n", "A", "B", "E").collect()), key=str)
    assert len(want) == 3 and max(r[1] for r in want) == 3000
    for most in (5000, 1000, 0):  # no hot key, one, all (a null key meets none)
        monkeypatch.setattr(rollup, "HOT_ROWS", most)
        got = agg_table(df, "k", cols, ["o"], ["n"], 50, position=F.col("o").cast("decimal(38,0)"), keys=df.select("k"))
        assert sorted(map(tuple, got.select("k", "n", "A", "B", "E").collect()), key=str) == want
        seen.append(plan(got).split("Union")[1].split("LeftAnti")[0].count("Exchange hashpartitioning"))
    assert seen == [1, 1, 1]  # the branch of all other keys
