"""Unit rows of FIXTURES.md section 5 on the Column functions."""

import math

import pytest
from pyspark.sql import functions as F

from labelkiln import rules
from labelkiln.functions import text as T


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "x string").select(col(F.col("x")).alias("r")).first()["r"]


def test_normalize_text(spark):
    assert one(spark, T.normalize_text, " Rash;  Nausea,\tPain ") in ("rash nausea pain", "rash nausea pain ")


def test_normalize_symptom_text(spark):
    assert one(spark, T.normalize_symptom_text, "Rash ;rash;; Chest   pain; ") == "Rash; Chest pain"


def test_split_terms_v1_v2(spark):
    assert one(spark, lambda c: T.split_terms(c, distinct=True), "A; B; A") == ["A", "B"]
    assert one(spark, lambda c: T.split_terms(c), "A; B; A") == ["A", "B", "A"]


def test_normalize_id(spark):
    assert one(spark, T.normalize_id, " 10-088 013 ") == "10088013"


def test_keep_drop_v1(spark):
    rs = rules.get("adverse_v1")
    kept, dropped = T.keep_drop_terms(T.split_terms(F.col("x"), distinct=True), rs)
    row = spark.createDataFrame([("Off label use; Rash; Wrong dose administered",)], "x string").select(
        kept.alias("k"), dropped.alias("d")).first()
    assert row["k"] == ["Rash"]
    assert row["d"] == ["Off label use", "Wrong dose administered"]


def test_multilabel_v2_and_boundary(spark):
    rs = rules.get("adverse_v2")
    cols = T.multilabel(F.col("x"), rs)
    df = spark.createDataFrame([("Erythema; Swelling face",), ("Painful",)], "x string").select(*cols)
    first, second = df.collect()
    on = {c for c in df.columns if first[c] == 1}
    assert on == {"y_dermatologic", "y_edema_swelling"}
    assert second["y_pain_general"] == 0


def test_meta_features(spark):
    a, b, c = T.meta_features(F.col("x"))
    r = spark.createDataFrame([("Rash; rash; Pain",)], "x string").select(a, b, c).first()
    assert math.isclose(r[0], math.log1p(16)) and r[1] == 3 and r[2] == 2


def test_char_wb_short_word(spark):
    assert one(spark, T.char_wb_ngrams, "ab") == [" ab", "ab ", " ab "]


def test_char_wb_rule_long_word(spark):
    # sklearn char_wb: n = 3..5 inside " word "; padded length 6 > 5, so all n-grams, no whole-word extra
    got = one(spark, T.char_wb_ngrams, "ward")
    p = " ward "
    want = [p[i:i + n] for n in (3, 4, 5) for i in range(len(p) - n + 1)]
    assert sorted(got) == sorted(want)


def test_word_ngrams(spark):
    toks = T.word_tokens(F.col("x"))
    r = spark.createDataFrame([("The cat, the HAT a",)], "x string").select(T.word_ngrams(toks).alias("g")).first()["g"]
    assert r == ["the", "cat", "the", "hat", "the cat", "cat the", "the hat"]


def test_select_text_column():
    assert T.select_text_column(["a", "text", "REAC_pt"]) == "REAC_pt"
    with pytest.raises(ValueError, match="none of the text columns"):
        T.select_text_column(["a"])
