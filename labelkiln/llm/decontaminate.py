"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. One pass over the corpus looks up the word n-grams of the test items in
   every whole document.  It writes, for each n-gram, the documents that
   hold it (partial counts per task) and the passages around hits of one
   item.  Passages whose words in common with the item cannot reach the
   threshold are left out; that bound is exact.
2. Per item, each window of ``span`` consecutive n-grams gives its rarest
   n-gram (by the counts over all documents) as a seed.  With ``span`` 1,
   the default, every n-gram is one, so every run of ``n`` unedited words of
   an item holds a seed.  A larger span aligns less but ranks by counts that
   hold the leaks themselves: beside many exact copies it picks the n-grams
   that an edited copy broke, and needs ``span + n - 1`` unedited words.
3. Passages join the seeds of their item; those with a seed are aligned with
   it word by word (Smith-Waterman: match 2, mismatch and gap -1).  The
   score is the best local alignment over the score of an exact copy.

The item table is broadcast in blocks of at most ``block_words`` words; a
larger benchmark is worked off block by block with the same result.

Edge cases: null or empty texts match nothing; items without a word are
ignored; items shorter than ``n`` words are one n-gram of their own
length; repeated items and documents each give their own rows; a null
``doc_id`` or ``item_id`` is carried through; long texts are read whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, pylist, settle, slices

N = 3
SPAN = 1
THRESHOLD = 0.4
BLOCK_WORDS = 2_000_000
CHARS = 1_000_000

MATCH, MISMATCH, GAP = 2, -1, -1

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Items:
    """One block of test items: words as integers and the n-grams with their places."""

    def __init__(self, rows: list[tuple], n: int = N):
        self.n = n
        self.vocab: dict[str, int] = {}
        self.ids, self.tokens = [], []
        for item_id, text in rows:
            ws = words(text)
            if ws:
                self.ids.append(item_id)
                self.tokens.append(np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws], np.int64))
        self.base = len(self.vocab) + 2
        grams = defaultdict(list)
        for i, t in enumerate(self.tokens):
            for at, key in enumerate(self.keys(t, min(n, len(t)))[0].tolist()):
                grams[key].append((i, at))
        self.grams = np.array(sorted(grams), np.int64)
        self.places = [grams[k] for k in self.grams.tolist()]

    def keys(self, t: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the n-grams of ``t`` without unknown words (0), and where they start."""
        key, good = np.zeros(max(0, len(t) - n + 1), np.int64), np.ones(max(0, len(t) - n + 1), bool)
        for k in range(n):
            part = t[k:len(t) - n + 1 + k]
            key = (key * np.int64(self.base) + part) & np.int64(0x0FFFFFFFFFFFFFFF)
            good &= part > 0
        return (key * np.int64(8) + n)[good], np.flatnonzero(good)

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Words of all texts as integers (0: in no item), the text of each; a -1 stands between texts."""
        get, ids, sizes = self.vocab.get, [], []
        for t in texts:
            ws = words(t)
            ids += map(get, ws, repeat(0))
            ids.append(-1)
            sizes.append(len(ws) + 1)
        return np.array(ids, np.int64), np.repeat(np.arange(len(texts)), sizes)

    def hits(self, ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``wanted``, word position) of every occurrence of the sorted keys ``wanted``."""
        found, where = [], []
        for n in np.unique(wanted % 8):
            key, at = self.keys(ids, int(n))
            place = np.searchsorted(wanted, key)
            place[place == len(wanted)] = 0
            ok = wanted[place] == key
            found.append(place[ok])
            where.append(at[ok])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(where)


def align(item: list[np.ndarray], passage: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each (item, passage) pair, and the passage word where it ends."""
    if not item:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, cols = max(map(len, item)), max(map(len, passage))
    a = np.full((len(item), rows), -2, np.int64)
    b = np.full((len(item), cols), -3, np.int64)
    for k, (x, y) in enumerate(zip(item, passage)):
        a[k, :len(x)], b[k, :len(y)] = x, y
    ramp = np.arange(cols + 1, dtype=np.int32) * -GAP
    h = np.zeros((len(item), cols + 1), np.int32)
    best, end = np.zeros(len(item), np.int32), np.zeros(len(item), np.int64)
    for r in range(rows):
        step = np.where(b == a[:, r:r + 1], MATCH, MISMATCH).astype(np.int32)
        new = np.zeros_like(h)
        new[:, 1:] = np.maximum(np.maximum(h[:, :-1] + step, h[:, 1:] + GAP), 0)
        new = np.maximum.accumulate(new + ramp, axis=1) - ramp  # gaps inside the row
        top = new.argmax(axis=1)
        score = new[np.arange(len(item)), top]
        better = score > best
        best[better], end[better] = score[better], top[better]
        h = new
    return best, end


def _reachable(item: np.ndarray, passage: np.ndarray, need: float) -> bool:
    """Whether the words in common could give the needed score."""
    known, have = np.unique(passage, return_counts=True)
    mine, want = np.unique(item, return_counts=True)
    place = np.searchsorted(known, mine)
    place[place == len(known)] = 0
    common = np.where(known[place] == mine, np.minimum(have[place], want), 0).sum()
    return MATCH * common >= need


def passages(texts: list, items: Items, threshold: float, df: np.ndarray) -> Iterator[tuple]:
    """(text, item, first word, n-grams hit, word ids) of every passage that could reach the threshold.

    Adds to ``df`` the number of texts that hold each n-gram of ``items``.
    """
    for lo, hi in slices(texts, CHARS):
        ids, owner = items.encode(texts[lo:hi])
        which, where = items.hits(ids, items.grams)
        if not len(which):
            continue
        df += np.bincount(np.unique(which * np.int64(hi - lo) + owner[where]) // (hi - lo), minlength=len(df))
        first = np.searchsorted(owner, np.arange(hi - lo + 1))
        spans = defaultdict(list)
        for gram, at, doc in zip(which.tolist(), where.tolist(), owner[where].tolist()):
            for item, off in items.places[gram]:
                size = len(items.tokens[item])
                spans[doc, item].append((at - off - size // 2, at - off + size + size // 2 + 1, gram))
        for (doc, item), found in spans.items():
            found.sort()
            begin, stop, grams = found[0][0], found[0][1], set()
            for a, b, gram in [*found, (1 << 60, 0, -1)]:
                if a > stop:
                    x, y = max(begin, int(first[doc])), min(stop, int(first[doc + 1]) - 1)
                    if _reachable(items.tokens[item], ids[x:y], threshold * MATCH * len(items.tokens[item])):
                        yield lo + doc, item, x - int(first[doc]), sorted(grams), ids[x:y]
                    begin, stop, grams = a, b, set()
                stop = max(stop, b)
                grams.add(gram)


def scored(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(share of an exact copy's score, end word) of each (item, passage) pair, aligned in padded groups."""
    share, end = np.zeros(len(pairs)), np.zeros(len(pairs), np.int64)
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][1]))
    while order:
        take = 1
        while take < len(order) and (take + 1) * len(pairs[order[take]][1]) <= 400_000:
            take += 1
        part, order = order[:take], order[take:]
        best, stop = align([pairs[k][0] for k in part], [pairs[k][1] for k in part])
        share[part], end[part] = best / (MATCH * np.array([len(pairs[k][0]) for k in part])), stop
    return share, end


def _blocks(bench: DataFrame, id_col: str, text_col: str, n: int, block_words: int) -> Iterator[Items]:
    rows, size = [], 0
    for r in bench.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null").toLocalIterator():
        rows.append((r["id"], r["text"]))
        size += len(words(r["text"]))
        if size >= block_words:
            yield Items(rows, n)
            rows, size = [], 0
    yield Items(rows, n)


def _seeds(items: Items, df: np.ndarray, span: int) -> list[tuple[int, int]]:
    """(item, n-gram) of the seeds: the rarest n-gram of each window, the first of equals."""
    chosen: set[tuple[int, int]] = set()
    for item, t in enumerate(items.tokens):
        place = np.searchsorted(items.grams, items.keys(t, min(items.n, len(t)))[0])
        for a in range(max(1, len(place) - span + 1)):
            window = place[a:a + span]
            window = window[df[window] > 0]  # what no document holds joins nothing
            if len(window):
                chosen.add((item, int(window[np.argmin(df[window])])))
    return sorted(chosen)


def _block_matches(docs: DataFrame, items: Items, threshold: float, span: int) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(items)
    row = ("doc_id long, text_key string, item int, at int, grams array<int>, words array<int>, gram int, df long")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        df = np.zeros(len(own.grams), np.int64)
        names = ["doc_id", "text_key", "item", "at", "grams", "words", "gram", "df"]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int64()]
        for b in batches:
            rows = list(passages(pylist(b, "text"), own, threshold, df))
            at = pa.array([r[0] for r in rows], pa.int64())
            cols = [b.column(0).take(at), b.column(1).take(at), *[pa.array([r[k] for r in rows], kinds[k + 1]) for k in (1, 2, 3, 4)],
                    pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=names)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(some), k) for k in kinds[:6]], pa.array(some, pa.int32()),
                                          pa.array(df[some], pa.int64())], names=names)

    seen = settle(bounded(docs).mapInArrow(look, row), "leak-passages")
    df = np.zeros(len(items.grams), np.int64)
    for r in seen.where("gram is not null").groupBy("gram").agg(F.sum("df").alias("df")).collect():  # at most the block's n-grams
        df[r["gram"]] = r["df"]
    seeds = spark.createDataFrame(_seeds(items, df, span), "item int, gram int").groupBy("item").agg(F.collect_set("gram").alias("seeds"))
    held = (seen.where("gram is null").join(seeds, "item").where(F.arrays_overlap("grams", "seeds"))
            .select("doc_id", "text_key", "item", "at", "words"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            item = b.column(2).to_pylist()
            share, end = scored([(own.tokens[i], np.array(w, np.int64)) for i, w in zip(item, b.column(4).to_pylist())])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([own.ids[i] for i in item], pa.int64()), pa.array(share),
                                              pa.array(end + b.column(3).to_numpy())],
                                             names=["doc_id", "text_key", "item_id", "score", "end_word"])
    return bounded(held).mapInArrow(score, "doc_id long, text_key string, item_id long, score double, end_word long").where(F.col("score") >= threshold)


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text: str = "text", threshold: float = THRESHOLD, n: int = N, span: int = SPAN,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text_key, item_id, score, end_word): the best passage of every document and item aligned at ``threshold`` or more.

    ``text_key`` is the md5 of the text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text_col).alias("text_key"), F.col(text_col).alias("text")).where(
        "text is not null")
    found = None
    for items in _blocks(bench, item_col, item_text, n, block_words):
        part = _block_matches(rows, items, threshold, span)
        found = part if found is None else found.union(part)
    return (found.groupBy("doc_id", "text_key", "item_id")
            .agg(F.max("score").alias("score"), F.max_by("end_word", F.struct("score", -F.col("end_word"))).alias("end_word")))


def without_leaks(docs: DataFrame, bench: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text aligns with a test item.

    Rows are taken out by the md5 of their text, so rows without an id and
    rows that share one are treated by their own text.  The table of leaked
    texts is written first; Spark broadcasts it only if its size allows.
    """
    leaked = settle(matches(docs, bench, text_col=text_col, **options).select("text_key").distinct(), "leaked-texts")
    keyed = docs.withColumn("__text_key", F.md5(text_col))
    return keyed.join(leaked, keyed["__text_key"] == leaked["text_key"], "left_anti").drop("__text_key")
