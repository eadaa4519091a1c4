"""Language identification by nearest centroid.

A text becomes a vector of hashed character 1- to 3-grams (letters lower
case, every run of other characters one blank), weighted by the square
root of the count times the inverse document frequency and scaled to
length one.  Every language has up to ``clusters`` centroids from
spherical k-means; the language of the centroid with the largest cosine
wins.  A text is rejected when its distance (one minus that cosine) is
beyond the winning centroid's bound for texts of that length (texts of
fewer than four letters are never rejected for distance).  From ``LONG``
letters on the bound comes from the distances of learning texts to
centroids fitted without them: a high quantile plus ``LONG_SLACK``.  For
shorter texts, which lie far out in every language, it is 1.1 times the
largest distance of an excerpt, from 0.85 to 0.95; so it is at all lengths
for a language with fewer than ``FEW`` learning texts.

Learning: document frequencies are counted over all learning rows in one
pass; the centroids are fitted, one task per language, on a sample of
``sample_per_lang`` rows per language in expectation (drawn by a hash of
the text's id; at most 1.5 times as many are used).  The model holds
``languages x clusters x DIM`` floats, which is the size of what is
broadcast; it does not grow with the rows.

Edge cases: null text, or a text without a letter: ``und`` with score 0
and rejected; no learnable row at all: every text is ``und``; ties go to
the language first in alphabetical order; long texts are read whole, in
pieces of bounded memory; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import bounded, pylist, slices

DIM = 4096
CLUSTERS = 4
SAMPLE_PER_LANG = 1000
PIECE = 200_000
UNKNOWN = "und"
#: Lengths (in letters) at which the radius of a centroid is measured.
LENGTHS = (4, 8, 16, 32, 64, 128, 256, 512, 1024, 4096)
#: A short text is rejected beyond this multiple of the largest distance seen in learning at its length, taken into these bounds.
SLACK = 1.1
MIN_DISTANCE, MAX_DISTANCE = 0.85, 0.95
#: From this many letters on: beyond the larger of these quantiles, of whole texts and of excerpts, plus a slack;
#: never below ``LONG_MIN``, as a small sample may hold none of the odd texts (one word over and over) of its language.
LONG = 128
WHOLE_QUANTILE, EXCERPT_QUANTILE = 0.999, 0.95
LONG_SLACK = 0.05
LONG_MIN = 0.65
FEW = 50


@dataclass
class Model:
    idf: np.ndarray        # DIM
    langs: list[str]       # one per centroid
    centroids: np.ndarray  # centroids x DIM
    radius: np.ndarray     # centroids x len(LENGTHS), the distance beyond which a text of that length is rejected


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


def _codes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each run of non-letters one blank, and the text of each position."""
    parts = [(" " + t.lower() + " ").encode("utf-32-le", "surrogatepass") if t else b"" for t in texts]
    code = np.frombuffer(b"".join(parts), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(p) // 4 for p in parts])
    alpha = _letters()[code]
    keep = alpha.copy()
    keep[:1] = True
    keep[1:] |= alpha[:-1] | (owner[1:] != owner[:-1])
    return np.where(alpha, code, 32)[keep].astype(np.uint32), owner[keep]


def gram_counts(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(texts x DIM counts, letters per text) of a short list of texts."""
    total = np.zeros((len(texts), DIM), np.float32)
    letters = np.zeros(len(texts), np.int64)
    code, owner = _codes(texts)
    if not len(code):
        return total, letters
    blank = code == 32
    letters += np.bincount(owner, ~blank, len(texts)).astype(np.int64)
    base = owner * DIM
    h1 = code * np.uint32(2654435761)
    bins = [base[~blank] + (h1[~blank] >> np.uint32(20))]
    if len(code) > 1:
        inside = owner[1:] == owner[:-1]
        h2 = (h1[:-1] ^ (code[1:] + np.uint32(0x9E3779B9))) * np.uint32(2246822519)
        bins.append((base[1:] + (h2 >> np.uint32(20)))[inside])
    if len(code) > 2:
        inside = owner[2:] == owner[:-2]
        h3 = (h2[:-1] ^ (code[2:] + np.uint32(0x85EBCA6B))) * np.uint32(3266489917)
        bins.append((base[2:] + (h3 >> np.uint32(20)))[inside])
    for b in bins:
        total += np.bincount(b, minlength=len(texts) * DIM).reshape(len(texts), DIM)
    return total, letters


def _chunks(texts: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, counts, letters) over all texts; a very long text is summed piece by piece."""
    for lo, hi in slices(texts, PIECE):
        if hi - lo == 1 and texts[lo] and len(texts[lo]) > PIECE:
            counts, letters = np.zeros((1, DIM), np.float32), np.zeros(1, np.int64)
            for at in range(0, len(texts[lo]), PIECE):
                c, n = gram_counts([texts[lo][at:at + PIECE]])
                counts, letters = counts + c, letters + n
            yield lo, counts, letters
            continue
        for a in range(lo, hi, 128):
            yield a, *gram_counts(texts[a:min(a + 128, hi)])


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def _kmeans(x: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Spherical k-means; starts from the row nearest the mean, then the farthest rows in turn."""
    mean = x.mean(axis=0)
    starts = [int(np.argmax(x @ mean))]
    near = x @ x[starts[0]]
    while len(starts) < min(k, len(x)):
        starts.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[starts[-1]])
    c = x[starts].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        new = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c, atol=1e-6):
            break
        c = new
    return c


def _radii(texts: list, c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Largest distance of any excerpt of a given number of characters to its nearest centroid, per length."""
    out = []
    for n in LENGTHS:
        worst = 0.0
        for _, counts, letters in _chunks(_cut(texts, n)):
            near = (_vectors(counts, idf) @ c.T).max(axis=1)[letters >= max(1, n // 2)]
            worst = max(worst, float(1 - near.min(initial=1.0)))
        out.append(worst)
    return np.maximum.accumulate(np.array(out, np.float32)[::-1])[::-1]


def _cut(texts: list, n: int) -> list:
    return [t[(len(t) - n) // 2:][:n] if len(t) > n else t for t in texts]


def _long_radii(texts: list, x: np.ndarray, letters: np.ndarray, clusters: int, idf: np.ndarray) -> np.ndarray:
    """High quantiles of the distances of either half of the texts to centroids of the other, per length; 0: too few texts."""
    half = np.arange(len(x)) % 2 == 0
    other = [(np.flatnonzero(half == h), _kmeans(x[half != h], clusters)) for h in (True, False)]
    whole = np.zeros(len(x))
    for rows, c in other:
        whole[rows] = 1 - (x[rows] @ c.T).max(axis=1)
    out = np.zeros(len(LENGTHS), np.float32)
    for k, n in enumerate(LENGTHS):
        if n < LONG:
            continue
        if (letters >= n).sum() < FEW:  # longer texts are not farther out
            out[k] = out[k - 1]
            continue
        far = []
        for rows, c in other:
            for _, counts, size in _chunks(_cut([texts[r] for r in rows], n)):
                far.append(1 - (_vectors(counts, idf) @ c.T).max(axis=1)[size >= n // 2])
        out[k] = max(np.quantile(whole[letters >= n], WHOLE_QUANTILE), np.quantile(np.concatenate(far), EXCERPT_QUANTILE))
    return out


def _bounds(radius: np.ndarray, long_radius: np.ndarray) -> np.ndarray:
    """Distance beyond which each centroid rejects, per length.

    All languages share the largest of their long radii, so that a language
    with few odd texts in its sample doesn't reject the next one.
    """
    bound = np.clip(SLACK * radius, MIN_DISTANCE, MAX_DISTANCE)
    widest = long_radius.max(axis=0)
    known = (long_radius > 0) & (np.array(LENGTHS) >= LONG)
    return np.where(known, np.clip(widest + LONG_SLACK, LONG_MIN, MAX_DISTANCE), bound).astype(np.float32)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        clusters: int = CLUSTERS, sample_per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """Learn from the rows of ``docs`` that have a text and a language; None if there are none."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null")

    def document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIM, np.int64), 0
        for b in batches:
            texts = pylist(b, "text")
            for _, counts, _ in _chunks(texts):
                df += (counts > 0).sum(axis=0)
            n += len(texts)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([df.tolist()], pa.list_(pa.int64())), pa.array([n])], names=["df", "n"])

    seen = (bounded(rows).select("text").mapInArrow(document_frequency, "df array<long>, n long")
            .select(F.posexplode("df").alias("gram", "df"), "n")
            .groupBy("gram").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).collect())  # DIM rows
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not per_lang:
        return None
    n_docs = seen[0]["n"] if seen else 0
    idf = np.ones(DIM, np.float32)
    for r in seen:
        idf[r["gram"]] = np.log((1 + n_docs) / (1 + r["df"])) + 1

    share = F.create_map(*[x for lang, n in per_lang.items() for x in (F.lit(lang), F.lit(min(1.0, sample_per_lang / n)))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30))
    sample = rows.where(draw < share[F.col("lang")] * (1 << 30)).withColumn("draw", draw)

    def one_language(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", "id"]).head(sample_per_lang * 3 // 2)
        texts = pdf["text"].tolist()
        x, letters = map(np.concatenate, zip(*[(_vectors(c, idf), n) for _, c, n in _chunks(texts)]))
        if not letters.any():
            return pd.DataFrame({"lang": [], "vector": [], "radius": [], "long_radius": []})
        texts, x, letters = [t for t, n in zip(texts, letters) if n], x[letters > 0], letters[letters > 0]
        c = _kmeans(x, clusters)
        radius, long_radius = _radii(texts, c, idf), _long_radii(texts, x, letters, clusters, idf) if len(x) >= FEW else np.zeros(len(LENGTHS))
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "vector": [v.tolist() for v in c], "radius": [radius.tolist()] * len(c),
                             "long_radius": [long_radius.tolist()] * len(c)})

    found = sample.groupBy("lang").applyInPandas(
        one_language, "lang string, vector array<float>, radius array<float>, long_radius array<float>").collect()
    found.sort(key=lambda r: (r["lang"], r["vector"]))
    if not found:
        return None
    langs = [r["lang"] for r in found]
    bounds = _bounds(np.array([r["radius"] for r in found]), np.array([r["long_radius"] for r in found]))
    return Model(idf, langs, np.array([r["vector"] for r in found], np.float32), bounds)


def _bound_of(model: Model, best: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The bound of the winning centroid for texts of so many letters, between two lengths by the logarithm."""
    at = np.log(np.array(LENGTHS, float))
    n = np.clip(np.log(np.maximum(letters, 1)), at[0], at[-1])
    k = np.clip(np.searchsorted(at, n, "right") - 1, 0, len(at) - 2)
    part = (n - at[k]) / (at[k + 1] - at[k])
    return model.radius[best, k] * (1 - part) + model.radius[best, k + 1] * part


def predict_texts(texts: list, model: Model | None) -> list[tuple[str, float, bool]]:
    """(language, cosine, rejected) of each text."""
    out: list[tuple[str, float, bool]] = []
    for _, counts, letters in _chunks(texts):
        if model is None:
            out += [(UNKNOWN, 0.0, True)] * len(letters)
            continue
        cos = _vectors(counts, model.idf) @ model.centroids.T
        best = np.argmax(cos, axis=1)
        score = np.clip(cos[np.arange(len(best)), best], 0, 1).astype(float)
        far = (1 - score > _bound_of(model, best, letters)) & (letters >= LENGTHS[0])
        out += [(model.langs[b], s, bool(f)) if n else (UNKNOWN, 0.0, True)
                for b, s, f, n in zip(best.tolist(), score.tolist(), far.tolist(), letters.tolist())]
    return out


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` added (the text is read, never lang or source)."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)
    added = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("rejected", pa.bool_())]
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "rejected")]
    frame = docs.select(*[f"`{f.name}`" for f in kept])
    at = [f.name for f in kept].index(text_col)
    schema = StructType([*frame.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("rejected", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = predict_texts(b.column(at).to_pylist(), shared.value)
            cols = [pa.array([f[k] for f in found], field.type) for k, field in enumerate(added)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], schema=pa.schema([*b.schema, *added]))
    return bounded(frame).mapInArrow(run, schema)


def recognised(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs``, all columns as they are, without the rows that are rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not rejected for _, _, rejected in predict_texts(b.column(at).to_pylist(), shared.value)], pa.bool_()))
    return bounded(docs).mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    """The fold rule: rows whose crc32 of the id as text leaves 0 modulo 5 are kept out of learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
