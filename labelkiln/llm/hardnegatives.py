"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its nearest rows of the same label.  A negative of
a positive is a row of another label whose score lies in a window below the
positive's: ``low * positive <= 100 * negative <= high * positive``.  The
windows of one anchor overlap, so none is searched by itself:

* The distinct upper limits of an anchor's windows, in descending order, cut
  the scores into disjoint slots: a slot reaches from its limit down to
  above the next one, the last down to the lowest of all windows.
* Each task scores its rows against a block of anchors and keeps, per
  anchor and slot, the best ``negatives`` rows; these lists are merged per
  (anchor, slot) over all tasks.
* The slots of an anchor in descending order, each with its best rows, are
  one ranked list.  The answer of a window is the start of that list from
  the window's slot on, down to its lower limit: any row left out of a slot
  has ``negatives`` better ones of the same slot before it.

Anchors are a part of all rows and grow with them, so they are taken in
blocks of at most ``BLOCK_CELLS`` components; a block is collected, broadcast
and compared with all rows, which stream through the tasks tile by tile.
Positives come from the same engine, with one slot and equal labels.

Components become ``floor(scale * x)`` in double precision, and scores are
exact integers: a tile whose sums might pass 2^53 is computed in Python
integers instead of doubles.

Edge cases: rows with a null id, label or vector, or a null or non-finite
component take no part; vectors are compared with vectors of the same
length; a row with the anchor's own id is none of its positives; repeated
rows each count; ties go to the smaller id; positives with a negative score
have empty windows; scores are held to +-2^56; an empty table or one without
anchors gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import bounded, settle, shared_folder

#: Vector components of a block of anchors (8 MB of doubles).
BLOCK_CELLS = 1 << 20
#: Scores held at once in a task.
TILE_CELLS = 1 << 21
LIMIT = 1 << 56
EXACT = float(1 << 53)
NONE = np.iinfo(np.int64).min


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, offsets) of an Arrow list column; null components are NaN, null lists empty."""
    column = column.cast(pa.list_(pa.float64()))
    start = np.asarray(column.offsets).astype(np.int64)
    size = np.where(np.asarray(column.is_valid()), np.diff(start), 0)
    flat = column.values.to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    at = np.repeat(start[:-1] - (end - size), size) + np.arange(int(size.sum()))
    return flat[at], np.concatenate(([0], end))


def _by_length(ids: np.ndarray, labels: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, row numbers, ids and labels, matrix) of the rows of each vector length."""
    size = np.diff(offsets)
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        yield d, at, np.stack((ids[at], labels[at])), flat[(offsets[at, None] + np.arange(d)).ravel()].reshape(len(at), d)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of integral values: exact, held to +-LIMIT."""
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LIMIT, LIMIT).astype(np.int64)


@dataclass
class Block:
    """Anchors with their slots: upper limits descending, ``NONE`` where an anchor has fewer, and the lowest score wanted."""

    key: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    flat: np.ndarray
    offsets: np.ndarray
    upper: np.ndarray   # anchors x slots
    lowest: np.ndarray
    same_label: bool
    keep: int


class Best:
    """The best rows of each (anchor, slot) among the rows seen so far."""

    def __init__(self, block: Block):
        self.block = block
        shape = (*block.upper.shape, block.keep)
        self.score, self.id = np.full(shape, NONE), np.full(shape, np.iinfo(np.int64).max)
        self.groups = {d: (at, m) for d, at, _, m in _by_length(block.ids, block.labels, block.flat, block.offsets)}

    def add(self, ids: np.ndarray, labels: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> None:
        for d, _, named, rows in _by_length(ids, labels, flat, offsets):
            anchors, vectors = self.groups.get(d, (np.zeros(0, np.int64), None))
            for lo in range(0, len(anchors), 1024):
                some, step, at = anchors[lo:lo + 1024], 128, 0
                while at < len(rows):  # few rows first, so that the rest meets full lists
                    self._tile(some, vectors[lo:lo + 1024], named[:, at:at + step], rows[at:at + step])
                    at, step = at + step, min(2 * step, max(128, TILE_CELLS // len(some)))

    def _tile(self, anchors: np.ndarray, vectors: np.ndarray, named: np.ndarray, rows: np.ndarray) -> None:
        b, slots = self.block, self.block.upper.shape[1]
        score = products(vectors, rows)
        slot = sum((score <= b.upper[anchors, s, None]).astype(np.int8) for s in range(slots)) - 1
        want = (b.labels[anchors, None] == named[1]) == b.same_label
        want &= (slot >= 0) & (score >= b.lowest[anchors, None])
        if b.same_label:
            want &= b.ids[anchors, None] != named[0]
        want &= score >= np.take_along_axis(self.score[anchors, :, -1], np.maximum(slot, 0), 1)
        a, r = np.nonzero(want)
        if not len(a):
            return
        cell = anchors[a] * slots + slot[a, r]
        touched = np.unique(cell)
        score_of, id_of = self.score.reshape(-1, b.keep), self.id.reshape(-1, b.keep)
        had = score_of[touched] != NONE
        cell = np.concatenate((cell, np.repeat(touched, had.sum(1))))
        value = np.concatenate((score[a, r], score_of[touched][had]))
        ids = np.concatenate((named[0][r], id_of[touched][had]))
        order = np.lexsort((ids, -value, cell))
        cell, value, ids = cell[order], value[order], ids[order]
        opens = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        place = np.arange(len(cell)) - np.repeat(opens, np.diff(np.concatenate((opens, [len(cell)]))))
        top = place < b.keep
        score_of[cell[top], place[top]] = value[top]
        id_of[cell[top], place[top]] = ids[top]

    def rows(self) -> pa.RecordBatch:
        a, s, k = np.nonzero(self.score != NONE)
        return pa.RecordBatch.from_arrays([pa.array(self.block.key[a]), pa.array(s.astype(np.int32)), pa.array(self.id[a, s, k]),
                                           pa.array(self.score[a, s, k])], names=["anchor", "slot", "id", "score"])


def usable(rows: DataFrame, scale: float, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v) of the rows that take part; ``v`` holds floor(scale * x)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offsets = _vectors(b.column(2))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            with np.errstate(all="ignore"):
                whole = np.floor(flat * scale)
            whole[~np.isfinite(whole)] = 0  # of rows left out, or beyond the doubles
            fine = pa.array(bad[offsets[1:]] == bad[offsets[:-1]])
            v = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(whole))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), v], names=["id", "label", "v"]).filter(fine)
    named = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    return bounded(named.dropna()).mapInArrow(run, "id long, label long, v array<double>")


def _search(spark: SparkSession, rows: DataFrame, block: Block, folder: str) -> None:
    """Append the best rows of each task to ``folder``."""
    shared = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for b in batches:
            best = best or Best(shared.value)
            best.add(b.column(0).to_numpy(), b.column(1).to_numpy(), *_vectors(b.column(2)))
        if best:
            yield best.rows()
    rows.mapInArrow(run, "anchor long, slot int, id long, score long").write.mode("append").parquet(folder)
    shared.destroy()


def _merged(found: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` rows of each (anchor, slot) over all tasks, with their rank."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _block(anchors: DataFrame, limits: DataFrame | None, keep: int) -> Block:
    """One block of anchors on the driver: at most BLOCK_CELLS components, and a few limits an anchor."""
    t = anchors.select("id", "label", "v", "anchor").toArrow().combine_chunks()
    key = t["anchor"].to_numpy()
    column = t["v"].chunk(0) if t["v"].num_chunks else pa.array([], pa.list_(pa.float64()))
    upper, lowest = np.full((len(key), 1), np.iinfo(np.int64).max), np.full(len(key), NONE + 1)
    if limits is not None:
        of = limits.toArrow()
        place = {k: i for i, k in enumerate(key.tolist())}
        at = np.array([place[k] for k in of["anchor"].to_pylist()], np.int64)
        slot = of["slot"].to_numpy()
        upper = np.full((len(key), int(slot.max(initial=0)) + 1), NONE)
        upper[at, slot] = of["upper"].to_numpy()
        lowest = np.full(len(key), np.iinfo(np.int64).max)
        np.minimum.at(lowest, at, of["lower"].to_numpy())
    return Block(key, t["id"].to_numpy(), t["label"].to_numpy(), *_vectors(column), upper, lowest, limits is None, keep)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is a condition on ``id_col``."""
    if not 0 <= low <= high:
        raise ValueError("0 <= low <= high")
    spark = rows.sparkSession
    table = settle(usable(rows, scale, id_col, label_col, vector_col), "negatives-rows")
    chosen = table.withColumnRenamed("id", id_col).where(is_anchor).withColumnRenamed(id_col, "id")
    size = chosen.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks = max(1, -(-size[0] * max(1, size[1]) // BLOCK_CELLS))
    anchors = settle(chosen.withColumn("anchor", F.monotonically_increasing_id())
                     .withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")), "negatives-anchors")
    near, far = shared_folder(spark, "negatives-near"), shared_folder(spark, "negatives-far")
    schema = "anchor long, slot int, id long, score long"
    for k in range(blocks):
        _search(spark, table, _block(anchors.where(F.col("block") == k), None, positives), near)
    found = (_merged(spark.read.schema(schema).parquet(near), positives)
             .select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
             .withColumn("upper", F.expr(f"{high} * positive_score div 100")).withColumn("lower", F.expr(f"({low} * positive_score + 99) div 100")))
    found = found.join(anchors.select("anchor", F.col("id").alias("anchor_id"), "block"), "anchor")
    # slots: the distinct upper limits of an anchor, descending; windows without any score have none
    descending = Window.partitionBy("anchor").orderBy(F.col("upper").desc())
    found = settle(found.where("positive_score >= 0 AND lower <= upper").withColumn("slot", F.dense_rank().over(descending) - 1), "negatives-positives")
    for k in range(blocks):
        some = found.where(F.col("block") == k)
        held = anchors.where(F.col("block") == k).join(some.select("anchor").distinct(), "anchor", "left_semi")
        _search(spark, table, _block(held, some.select("anchor", "slot", "upper", "lower"), negatives), far)
    listed = (_merged(spark.read.schema(schema).parquet(far), negatives).groupBy("anchor")  # at most positives * negatives rows a group
              .agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("descending"), "id"))).alias("ranked")))
    window = F.expr(f"slice(filter(ranked, r -> r.slot >= slot AND -r.descending >= lower), 1, {negatives})")
    answers = found.join(listed, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("k", "r"))
    return answers.select("anchor_id", "positive_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("r.id").alias("negative_id"),
                          "positive_score", (-F.col("r.descending")).alias("negative_score"))
