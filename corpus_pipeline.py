"""Corpus pipeline over ``documents``: language ID, near-duplicates, decontamination, encoding.

Each stage takes what its predecessor kept, as written to Parquet and read
again, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from labelkiln.llm import decontaminate, langid, sentencepieces, simhash
from labelkiln.llm.common import settle, table

#: The vocabulary of the last stage; any SentencePiece model with byte pieces can take its place.
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _pieces(path: str) -> sentencepieces.Pieces:
    return sentencepieces.Pieces.load(path)


def encoded(spark: SparkSession, docs: DataFrame, keep: list[str], model: str = MODEL) -> DataFrame:
    """Columns ``keep``, the ids of the whole text, their number, and whether decoding gives back the text.

    Columns that have the name of one of these results give way to it.
    """
    keep = [c for c in keep if c not in ("ids", "n_pieces", "round_trip")]
    rows = docs.withColumn("__md5", F.md5("text"))
    out = sentencepieces.encode(rows, _pieces(model), [*keep, "__md5"], decoded="__decoded")
    return out.select(*keep, "ids", F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).alias("n_pieces"),
                      F.md5("__decoded").eqNullSafe(F.col("__md5")).alias("round_trip"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised."""
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.recognised(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no passage of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the documents; every column but the text is kept."""
    return encoded(spark, docs, [c for c in docs.columns if c != "text"])


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", pieces),
]

#: The stages learn, hash and align; SQL can't state them. tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
