"""SimHash near-duplicates: exact tiled comparison of 64-bit fingerprints.

Fingerprints come from one Arrow pass over the texts.  Equal fingerprints
are folded into one class before any comparison, so a group of exact
copies costs one row.  Classes are laid out in tiles by the population
counts of the four 16-bit quarters of the fingerprint.  The quarters'
counts of two fingerprints within ``radius`` bits differ by at most
``radius`` in sum, so a tile meets only the tiles whose counts are that
near (an equi-join on the shifted counts); all other tile pairs are
skipped.  Within a tile pair every pair of fingerprints is compared with
exclusive-or and ``bitwise_count``; the task returns a spanning forest of
the links it found, which keeps every connection but never a quadratic
number of edges.  Components are merged by alternating large-star and
small-star rounds over written tables.

Edge cases: null or blank text has fingerprint zero and is linked like any
other; null ``doc_id`` rows are kept and never become a component id (a
component without any doc_id has a null id); repeated rows give repeated
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import bounded, settle, slices

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 2048

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def fingerprints_of(texts: list, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Fingerprints (uint64) of a list of texts; zero where there is no word."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for lo, hi in slices(texts, 400_000):
        hashes: list[int] = []
        counts = np.zeros(hi - lo, np.int64)
        for i in range(lo, hi):
            words = _WORD.findall(texts[i].translate(_LOWER)) if texts[i] else []
            if len(words) > shingle:
                # shingles are cut out of the space-joined text, so only one string is built per shingle
                joined = " ".join(words).encode("utf-8", "surrogatepass")
                ends = np.cumsum(np.fromiter((len(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words)) + 1)
                starts = np.concatenate(([0], ends[:-1]))[:len(words) - shingle + 1].tolist()
                stops = (ends[shingle - 1:] - 1).tolist()
                hashes += [digest(joined[a:b], seed) for a, b in zip(starts, stops)]
                counts[i - lo] = len(starts)
            elif words:
                hashes.append(digest(" ".join(words).encode("utf-8", "surrogatepass"), seed))
                counts[i - lo] = 1
        if hashes:
            out[lo:hi] = _majority(np.array(hashes, np.uint64), counts)
    return out


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of ``counts`` hashes, the word whose bits are set in over half of them."""
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    res = np.zeros(len(counts), np.uint64)
    value = np.zeros(len(full), np.uint64)
    for byte in range(8):
        part = ((hashes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.uint8)
        bits = np.unpackbits(part[:, None], axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        chosen = np.packbits(2 * ones > counts[full][:, None], axis=1, bitorder="little")[:, 0]
        value |= chosen.astype(np.uint64) << np.uint64(8 * byte)
    res[full] = value
    return res


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` and ``fp long`` (the unsigned fingerprint's bits) for every row."""
    frame = docs.select(*[f"`{c}`" for c in keep], F.col(text_col).alias("__text"))
    schema = StructType([*frame.schema.fields[:-1], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints_of(b.column(len(keep)).to_pylist(), shingle, seed)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*keep, "fp"])
    return bounded(frame).mapInArrow(run, schema)


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of the edges (a[i], b[i]) that form a spanning forest."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            parent[x] = y
            keep.append(i)
    return np.array(keep, np.int64)


def _tile_links(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles (or within one)."""
    froms, tos = [], []
    for lo in range(0, len(left), 256):
        part = left[lo:lo + 256]
        i, j = np.nonzero(np.bitwise_count(part[:, None] ^ right[None, :]) <= radius)
        if same:
            up = part[i] < right[j]
            i, j = i[up], j[up]
        keep = _forest(part[i].view(np.int64), right[j].view(np.int64))
        froms.append(part[i][keep])
        tos.append(right[j][keep])
    a, b = np.concatenate(froms).view(np.int64), np.concatenate(tos).view(np.int64)
    keep = _forest(a, b)
    return a[keep], b[keep]


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (src, dst) that connect exactly what all pairs within ``radius`` bits connect.

    ``classes``: distinct ``fp``.  Tile keys are population counts; a tile
    holds about ``tile`` fingerprints, a fuller key is split by hash.
    """
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int") for k in range(4)]
    keyed = classes.select("fp", *[q.alias(f"p{k}") for k, q in enumerate(quarter)])
    keys = ["p0", "p1", "p2", "p3"]
    width = keyed.groupBy(*keys).agg(F.ceil(F.count("*") / tile).cast("int").alias("subs"))
    tiles = (keyed.join(width, keys).withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
             .groupBy(*keys, "sub").agg(F.collect_list("fp").alias("fps")))
    tiles = settle(tiles, "simhash-tiles")
    # one half of the shifts (the first non-zero one is positive): a tile pair is met once
    shifts = [s for s in product(range(-radius, radius + 1), repeat=4)
              if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]
    offsets = F.array(*[F.struct(*[F.lit(v).alias(f"d{k}") for k, v in enumerate(s)]) for s in shifts])
    left = (tiles.select(*keys, F.col("sub").alias("lsub"), F.col("fps").alias("lfps"), F.explode(offsets).alias("d"))
            .select("lsub", "lfps", *[(F.col(f"p{k}") + F.col(f"d.d{k}")).alias(f"p{k}") for k in range(4)],
                    (F.expr("d.d0 = 0 and d.d1 = 0 and d.d2 = 0 and d.d3 = 0")).alias("own")))
    pairs = left.join(tiles, keys).where("not own or lsub <= sub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ls, rs = b.column(0), b.column(1)
            same = b.column(2).to_pylist()
            found = [_tile_links(ls[i].values.to_numpy().view(np.uint64), rs[i].values.to_numpy().view(np.uint64), radius, same[i])
                     for i in range(b.num_rows)]
            found = [f for f in found if len(f[0])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], names=["src", "dst"])
    return (pairs.select("lfps", "fps", F.expr("own and lsub = sub").alias("same"))
            .mapInArrow(run, "src long, dst long"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star round over edges (u > v)."""
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    # written, so that the join below has plain exchanges and a hub's edges can be split over tasks
    least = settle(near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "simhash-least")
    hooked = near.join(least, "u")
    if large:
        out = hooked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hooked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without an edge are absent.

    Alternates large-star and small-star rounds, each written to the
    shared folder, until a round changes nothing.
    """
    cur = settle(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
                 .where("u <> v").distinct(), "simhash-edges")
    seen = None
    while True:
        now = tuple(cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())
        if now == seen or now[0] == 0:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
        cur = settle(_star(settle(_star(cur, True), "simhash-large"), False), "simhash-small")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                    shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """(id, keep..., fp long, component_id): the smallest id reachable over links of ``radius`` bits or fewer."""
    fps = settle(fingerprints(docs, [id_col, *keep], text_col, shingle, seed), "simhash-fp")
    classes = settle(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-class")
    roots = components(links(classes, radius))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    owner = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-owner")
    return (fps.join(rooted.join(owner, "root").select("fp", "component_id"), "fp")
            .select(id_col, *keep, "fp", "component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null last), then the smallest md5 of its text.

    Rows leave by a sort-merge anti join with the losers, a table that grows
    with the corpus; rows that equal the survivor in id and text are folded
    into one.
    """
    keyed = docs.withColumn("__key", F.coalesce(F.md5(text_col), F.lit("")))
    found = settle(near_duplicates(keyed, id_col, text_col, ("__key",), shingle, radius, seed)
                   .withColumn("rank", F.struct(F.col(id_col).isNull().alias("nil"), F.col(id_col).alias("id"), F.col("__key").alias("key"))),
                   "simhash-found")
    # a component without any id is known by its fingerprint class: its rows share the null component
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    found = found.withColumn("group", group)
    best = settle(found.groupBy("group").agg(F.min("rank").alias("best")), "simhash-best")
    losers = settle(found.join(best, "group").where(~F.col("rank").eqNullSafe(F.col("best")))
                    .select(F.col("rank.id").alias("__lost_id"), F.col("rank.key").alias("__lost_key")).distinct(), "simhash-losers")
    kept = keyed.join(losers.hint("merge"), F.col(id_col).eqNullSafe(F.col("__lost_id")) & (F.col("__key") == F.col("__lost_key")), "left_anti")
    repeated = found.groupBy(id_col, "__key").count().where("count > 1").limit(1).count()
    if repeated:
        kept = kept.dropDuplicates([id_col, "__key"])
    return kept.drop("__key")


def hex16(col):
    """Sixteen lower-case hex digits of a long's bits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))
