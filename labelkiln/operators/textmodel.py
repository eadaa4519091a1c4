"""A fitted text model as tables: save, load, and score any text as one DataFrame job.

Saved under one folder:

* ``terms``      -- (space, term, idf, idx): the whole vocabulary of both
  n-gram spaces; ``idx`` is the selected feature's index, null when the
  selection left the term out (it still counts in the row's norm);
* ``weights``    -- (idx, label, w): coefficients of the selected features;
* ``meta``       -- (place, idx): index of the three meta features, if selected;
* ``labels``     -- (label, intercept, threshold, kind): a 'score' model answers decision values, a 'proba' model probabilities.

Scoring repeats the training features (``packed``): the texts of an id meet
once, and its terms, TF-IDF with the saved idf, the norm over the whole
vocabulary and the product with the weights of every label are made inside
its row.  The weights (selected features x labels) go to every task, and so
does a vocabulary of up to ``packed.LOOKUP_TERMS`` terms; a larger one is
joined by term.  What is sent is sent once for a loaded model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packed as P

PARTS = ("terms", "weights", "meta", "labels")
SPACES = ("word", "char")


@dataclass
class TextModel:
    terms: DataFrame
    weights: DataFrame
    meta: DataFrame
    labels: DataFrame
    sent: tuple | None = None  # what scoring sends to the tasks, made once

    def ready(self) -> tuple:
        """(vocabularies, their lookups, weights, place of the first meta feature, label rows): a term left out by the selection has index -1;
        the weights of the meta features stand behind those of the selected ones."""
        if self.sent is None:
            spark = self.terms.sparkSession
            vocabs = {s: self.terms.where(F.col("space") == s).select("term", F.coalesce("idx", F.lit(-1)).alias("idx"), "idf") for s in SPACES}
            labels = self.labels.select("label", "intercept", "threshold", "kind").orderBy("label").collect()  # a row a label
            rows, meta = self.weights.select("idx", "label", "w").toArrow(), {r["idx"]: r["place"] for r in self.meta.collect()}
            last = self.terms.agg(F.max("idx")).first()[0]
            n = 1 + max([-1 if last is None else last, *meta, *rows["idx"].to_pylist()])
            w, at = np.zeros((n + 3, len(labels))), {r["label"]: k for k, r in enumerate(labels)}
            for i, label, x in zip(rows["idx"].to_pylist(), rows["label"].to_pylist(), rows["w"].to_pylist()):
                w[i, at[label]] += x
                if i in meta:
                    w[n + meta[i], at[label]] += x
            self.sent = vocabs, P.lookups(vocabs), spark.sparkContext.broadcast(w), n, labels
        return self.sent

    def save(self, path: str) -> str:
        for part in PARTS:
            getattr(self, part).write.mode("overwrite").parquet(f"{path}/{part}")
        return path


def load(spark: SparkSession, path: str) -> TextModel:
    return TextModel(*[spark.read.parquet(f"{path}/{part}") for part in PARTS])


def weights_of(spark: SparkSession, models: dict) -> tuple[DataFrame, DataFrame]:
    """((idx, label, w), (label, intercept)) of fitted linear models; one row per label leaves the driver.

    A label with one class in training has no weights; its intercept is
    beyond any threshold on that class's side.
    """
    fitted = [(y[2:], m.coefficients.toArray().tolist(), float(m.intercept)) for y, m in models.items() if not isinstance(m, tuple)]
    fixed = [(y[2:], [], 50.0 if m[1] else -50.0) for y, m in models.items() if isinstance(m, tuple)]
    rows = spark.createDataFrame(fitted + fixed, "label string, ws array<double>, intercept double")
    weights = rows.select("label", F.posexplode("ws").alias("idx", "w")).where("w <> 0").select("idx", "label", "w")
    return weights, rows.select("label", "intercept")


def predict_rows(model: TextModel, rows: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, copies, scores): one row an id, with (label, score, threshold, pred) of every label in label order; a null text is an empty one."""
    vocabs, sent, weights, n, labels = model.ready()
    texts = rows.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = P.count_terms(texts, id_col, {"word": P.word_lists(), "char": P.char_lists()}, meta=True)
    found = P.features(counts, id_col, vocabs, dict.fromkeys(SPACES, 0), n, sent=sent, weights=weights)
    out = []
    for k, r in enumerate(labels):
        raw = F.when(F.col(id_col).isNull(), F.lit(0.0)).otherwise(F.col("s")[k]) + F.lit(r["intercept"]).cast("double")  # no id, no features
        score = raw if r["kind"] == "score" else F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))
        threshold = F.lit(r["threshold"]).cast("double")
        out.append(F.struct(F.lit(r["label"]).alias("label"), score.alias("score"), threshold.alias("threshold"), (score >= threshold).cast("int").alias("pred")))
    return found.select(id_col, "copies", F.array(*out).alias("scores"))


def predict(model: TextModel, rows: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, label, score, threshold, pred) for every row and label; a null text is an empty one."""
    found = predict_rows(model, rows, id_col, text_col)
    each = found.select(id_col, F.explode(F.flatten(F.array_repeat("scores", F.col("copies").cast("int")))).alias("p"))
    return each.select(id_col, "p.label", "p.score", "p.threshold", "p.pred")


def selected_terms(word: DataFrame, char: DataFrame, n_word: int, selection: DataFrame) -> DataFrame:
    """The ``terms`` table from the two vocabularies (term, idx, idf) and the selection (idx, new_idx)."""
    both = (word.select(F.lit("word").alias("space"), "term", "idf", "idx")
            .unionByName(char.select(F.lit("char").alias("space"), "term", "idf", (F.col("idx") + F.lit(n_word)).cast("int").alias("idx"))))
    return both.join(selection, "idx", "left").select("space", "term", "idf", F.col("new_idx").alias("idx"))


def selected_meta(spark: SparkSession, first: int, selection: DataFrame) -> DataFrame:
    """The ``meta`` table: which of the three meta features, from index ``first``, were selected."""
    places = spark.createDataFrame([(k, first + k) for k in range(3)], "place int, idx int")
    return places.join(selection, "idx").select("place", F.col("new_idx").alias("idx"))

