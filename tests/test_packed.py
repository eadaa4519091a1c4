"""Terms and features as lists in one row per id, against plain Python."""

import math
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelkiln.operators import features as G
from labelkiln.operators import linear as L
from labelkiln.operators import models as MD
from labelkiln.operators import packed as P

ROWS = [(1, "train", "red bolt red", 1), (2, "train", "red bolt; old gear", 0), (2, "train", "red bolt; old gear", 0),
        (3, "test", "old\tgear é", 1), (4, "train", "", 0), (5, "train", None, 0), (6, "train", "bolt", 1)]


def grams(text):
    out = []
    for w in (text or "").lower().split():
        p = f" {w} "
        out += [p[i:i + n] for n in range(3, max(min(5, len(p)), 3) + 1) for i in range(len(p) - n + 1)]
    return out


def frame(spark):
    return spark.createDataFrame(ROWS, "id long, split string, text string, y_a int")


def counts(spark):
    return P.count_terms(frame(spark), "id", {"word": P.word_lists(), "char": P.char_lists()}, ["split"], ["y_a"], meta=True)


def test_counts_are_those_of_the_texts(spark):
    got = {r["id"]: r for r in counts(spark).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6} and got[2]["copies"] == 2 and got[1]["y_a"] == 1
    for i in got:
        want = Counter(g for r in ROWS if r[0] == i for g in grams(r[2]))
        assert dict(zip(got[i]["char_terms"], got[i]["char_tf"])) == want
    assert dict(zip(got[1]["word_terms"], got[1]["word_tf"])) == {"red": 2, "bolt": 1, "red bolt": 1, "bolt red": 1}
    # the texts of an id don't run into each other
    assert dict(zip(got[2]["word_terms"], got[2]["word_tf"])) == dict.fromkeys(["red", "bolt", "old", "gear", "red bolt", "bolt old", "old gear"], 2)


def test_no_shuffle_by_term_before_the_vocabulary(spark):
    p = counts(spark)._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning") == 1  # texts, by id


@pytest.mark.parametrize("limit", [10 ** 6, 0])  # looked up in the tasks, or joined by term
def test_features_mask_and_sums(spark, monkeypatch, limit):
    monkeypatch.setattr(P, "LOOKUP_TERMS", limit)
    c = counts(spark).localCheckpoint()
    voc = G.fit_vocabulary(P.term_table(c.where("split = 'train'"), "word"), 6, 1, 1.0)
    v = {r["term"]: (r["idx"], r["idf"]) for r in voc.collect()}
    assert v["red"][1] == pytest.approx(math.log(7 / 3) + 1)
    rows = P.features(c, "id", {"word": voc}, {"word": 10}, 100).localCheckpoint()
    got = {r["id"]: dict(zip(r["idx"], r["value"])) for r in rows.collect()}
    w = {t: (1 + math.log(n)) * v[t][1] for t, n in {"red": 2, "bolt": 1, "red bolt": 1, "bolt red": 1}.items()}
    norm = math.sqrt(sum(x * x for x in w.values()))
    assert {i: x for i, x in got[1].items() if i < 100} == pytest.approx({v[t][0] + 10: x / norm for t, x in w.items()})
    assert set(got[4]) == {100, 101, 102}  # no term: the meta features alone
    assert [r["idx"] for r in rows.where("id = 2").collect()][0][-6:] == [100, 100, 101, 101, 102, 102]  # once a copy
    sums = {r["idx"]: r for r in P.feature_sums(rows, ["y_a"]).collect()}
    at = v["bolt"][0] + 10
    assert sums[at]["total"] == pytest.approx(sum(got[i].get(at, 0) * n for i, n in ((1, 1), (2, 2), (6, 1))))
    assert sums[at]["o_y_a"] == pytest.approx(got[1][at] + got[6][at])
    chosen = spark.createDataFrame([(at, 0), (102, 1)], "idx int, new_idx int")
    kept = {r["id"]: r for r in P.mask(rows, chosen).collect()}
    assert kept[6]["idx"] == [0, 1] and kept[6]["value"][0] == pytest.approx(got[6][at]) and kept[3]["idx"] == [1]


def test_vectors_come_from_the_lists(spark):
    rows = spark.createDataFrame([(1, [0, 2], [1.0, 2.0]), (2, [], [])], "id long, idx array<int>, value array<double>")
    vectors, lists = MD.assemble_rows(rows, 3)
    assert {r["id"]: r["features"].toArray().tolist() for r in vectors.collect()} == {1: [1.0, 0.0, 2.0], 2: [0.0, 0.0, 0.0]}
    assert lists.agg(F.max("size")).first()[0] == 3 and MD.fit_threads(vectors) == MD.FIT_THREADS


def test_large_frames_are_fitted_fewer_at_a_time(spark, monkeypatch):
    rows = spark.createDataFrame([(1, [0], [1.0])], "id long, idx array<int>, value array<double>")
    monkeypatch.setattr(MD, "FIT_BYTES", 1)
    assert MD.fit_threads(MD.assemble_rows(rows, 1)[0]) == 1


def test_gram_summary_keeps_grams_in_their_row(spark):
    from labelkiln.functions import text as T
    from labelkiln.plans.catalog_features import _gram_summary
    out = _gram_summary(frame(spark), "id", "text", T.word_tokens, T.word_ngrams)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: (r["n_grams"], r["n_distinct"]) for r in out.collect()}
    assert got == {1: (5, 4), 2: (14, 7), 3: (3, 3), 6: (1, 1)}  # both texts of an id together; none without a gram


def test_rows_of_an_id_meet_across_batches_without_an_aggregate_of_texts(spark):
    rows = [(i % 7 if i % 11 else None, "train", f"red w{i}" if i % 5 else None, i % 3 if i % 13 else None) for i in range(300)] + [(99, "train", "x y", None)] * 40
    df = spark.createDataFrame(rows, "id long, split string, text string, y_a int").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        c = P.count_terms(df, "id", {"word": P.word_lists(), "char": P.char_lists()}, ["split"], ["y_a"], meta=True)
        assert "ObjectHashAggregate" not in c._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: r for r in c.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {r[0] for r in rows}
    for i, r in got.items():
        mine = [x for x in rows if x[0] == i]
        ys = [x[3] for x in mine if x[3] is not None]
        assert r["copies"] == len(mine) and len(r["meta"]) == 3 * len(mine) and r["y_a"] == (sum(ys) if ys else None)
        assert dict(zip(r["char_terms"], r["char_tf"])) == Counter(g for x in mine for g in grams(x[2]))
        words = [(x[2] or "").split() for x in mine]
        assert Counter(dict(zip(r["word_terms"], r["word_tf"]))) == Counter(w for t in words for w in t if len(w) > 1) + Counter(
            " ".join(p) for t in words for p in zip(t, t[1:]) if min(map(len, p)) > 1)


def test_class_weights_read_their_sums_once(spark):
    sc = spark.sparkContext
    seen = sc.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    sums = spark.createDataFrame([(0, 3.0, 1.0), (1, 2.0, 2.0)], "idx int, total double, o_y_a double")
    y = spark.createDataFrame([(1,), (0,)], "y_a int")
    w = {r["idx"]: r["w"] for r in L.complement_nb(sums.mapInArrow(count, sums.schema), y, ["y_a"], 3, 0.5).collect()}
    assert seen.value == 2 and set(w) == {0, 1, 2}
    assert w[0] == pytest.approx(math.log(1.5 / 4.5) - math.log(2.5 / 3.5))


def test_mask_and_sums_in_the_pass_of_the_features_equal_the_steps(spark):
    df = spark.createDataFrame([(i % 40, "train", f"red w{i % 9} bolt; w{i % 5}", i % 3 if i % 7 else None, None) for i in range(120)],
                               "id long, split string, text string, y_a int, y_b int")
    c = P.count_terms(df, "id", {"word": P.word_lists(), "char": P.char_lists()}, ["split"], ["y_a", "y_b"], meta=True).localCheckpoint()
    for r in c.collect():
        assert r["word_terms"] == sorted(r["word_terms"]) and r["char_terms"] == sorted(r["char_terms"])
    voc = {s: G.fit_vocabulary(P.term_table(c, s), 40, 1, 1.0).localCheckpoint() for s in ("word", "char")}
    n = voc["word"].count()
    args = (c, "id", voc, {"word": 0, "char": n}, n + voc["char"].count())
    rows = P.features(*args).localCheckpoint()
    for r in rows.collect():
        assert r["idx"] == sorted(r["idx"])
    chosen = spark.createDataFrame([(i, i // 2) for i in range(0, n + 10, 2)], "idx int, new_idx int")
    masked = P.mask(rows, chosen)
    as_rows = lambda d: sorted(map(tuple, d.select("id", "idx", "value").collect()))
    assert as_rows(P.features(*args, selected=chosen)) == as_rows(masked)
    plain = P.entries(masked, "copies", "y_a", "y_b").groupBy("idx").agg(F.sum(F.col("value") * F.col("copies")), *[F.sum(F.col("value") * F.col(y)) for y in ("y_a", "y_b")])
    want = {r[0]: r[1:] for r in plain.collect()}
    for sums in (P.features(*args, selected=chosen, sums=["y_a", "y_b"]), P.feature_sums(masked, ["y_a", "y_b"])):
        assert "Generate" not in sums._jdf.queryExecution().executedPlan().toString()  # no row an entry
        got = {r[0]: r[1:] for r in sums.collect()}
        assert got.keys() == want.keys() and all(r[2] is None for r in got.values())
        assert all(got[i][:2] == pytest.approx(want[i][:2]) for i in want)
    vectors = {r["id"]: r["features"] for r in P.features(*args, selected=chosen, size=50).where("copies = 1").collect()}
    lists = {r["id"]: dict(zip(r["idx"], r["value"])) for r in masked.where("copies = 1").collect()}
    assert {i: dict(zip(v.indices.tolist(), v.values.tolist())) for i, v in vectors.items()} == lists and all(v.size == 50 for v in vectors.values())


def test_batches_are_held_by_bytes(spark):
    key, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    before, read = spark.conf.get(key), spark.conf.get(rows)
    try:
        spark.conf.set(key, str(2 ** 31 - 1))
        spark.conf.set(rows, "4096")
        df = spark.range(0, 3000, 1, 1).select("id", F.expr("repeat('some words; ', 1000)").alias("text"), F.lit("train").alias("split"))
        P.count_terms(df, "id", {"word": P.word_lists()}, ["split"])
        assert int(spark.conf.get(key)) == P.BATCH_BYTES and int(spark.conf.get(rows)) == P.READ_ROWS  # lists of a batch are in memory together
        sizes = [r["n"] for r in df.mapInArrow(lambda bs: (pa.record_batch({"n": [b.nbytes]}) for b in bs), "n long").collect()]
        assert len(sizes) > 3 and max(sizes) < 2 * P.BATCH_BYTES
        spark.conf.set(key, "1000000")
        P.bounded(df)
        assert spark.conf.get(key) == "1000000"  # a smaller setting stays
    finally:
        spark.conf.set(key, before)
        spark.conf.set(rows, read)
