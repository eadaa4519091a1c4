"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

* Equal vectors are folded into one class (its smallest ids), so a vector
  that holds a third of the rows costs one row.
* The forest is fitted on a sample of at most ``SAMPLE`` classes, drawn by
  hash; inner products become angles by one more component that brings all
  vectors to the same length.  Each node splits at the median of the
  projections on the difference of two of its vectors.
* Every class is indexed: it has one leaf in each tree.  Leaves are packed
  into tiles of about ``TILE`` rows; a fuller leaf is split by hash over
  several tiles, and its visitors go to each.
* A query is searched with one priority queue over all trees: the open node
  with the least sum of squared margins to the splits on its wrong side
  comes next, until ``budget`` leaves are found.  The query goes once to
  each tile that holds some of them, with the list of leaves; there all
  rows of these leaves are scored, and the best are merged over tiles.
* The budget is measured, not guessed: ``TUNE`` queries are compared with
  all rows, and the budget is the least number of leaves that finds
  ``RECALL`` of their neighbours (and ``FLOOR`` rows a tree at least, so
  small tables are searched whole).  Data without structure need a large
  share of the leaves; clustered data need few.

Scores are sums in double precision, in order of the components, of the
products of the original values.

Edge cases: null, zero or non-finite vectors, vectors with null
components, vectors whose length is not the most frequent one, and null ids
take no part; rows that repeat an id and vector count once; a row with the
query's own id is never its neighbour; ties go to the smaller id; an empty
table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pylist, settle

TREES = 4
SAMPLE = 16_384
LEAF = 16
TILE = 2_048
CHUNK = 1_024
TUNE = 64
RECALL = 0.95
FLOOR = 4_096


@dataclass
class Forest:
    """Nodes of all trees: direction, split, children (a leaf has none), number of the leaf."""

    scale: float            # largest norm
    direction: np.ndarray   # nodes x (dim + 1)
    split: np.ndarray
    child: np.ndarray       # nodes x 2; -1 at leaves
    leaf: np.ndarray        # -1 at inner nodes
    roots: list[int]

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def first_leaves(self) -> set[int]:
        """The first leaf of each tree; its leaves are numbered on from there."""
        return {int(self.leaf[r:][self.leaf[r:] >= 0][0]) for r in self.roots}

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Indexed vectors with the component that equals their lengths."""
        y = x / self.scale
        return np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))[:, None]], axis=1)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree (rows x trees)."""
        y = self.rows(x)
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(x), root)
            while len(open_ := np.flatnonzero(self.child[node, 0] >= 0)):
                at = node[open_]
                right = np.einsum("nd,nd->n", y[open_], self.direction[at]) > self.split[at]
                node[open_] = self.child[at, right.astype(int)]
            out[:, t] = self.leaf[node]
        return out

    def margins(self, q: np.ndarray) -> np.ndarray:
        """Signed margin of each query at each node."""
        y = q / np.linalg.norm(q, axis=1, keepdims=True)
        return y @ self.direction[:, :-1].T - self.split

    def search(self, margin: np.ndarray, budget: int, sizes: np.ndarray, floor: int) -> list[int]:
        """Leaves in the order of one queue over all trees: at least ``budget`` and at least ``floor`` rows."""
        margin, child, leaf = margin.tolist(), self.child.tolist(), self.leaf.tolist()
        queue = [(0.0, r) for r in self.roots]
        found, rows = [], 0
        while queue and (len(found) < budget or rows < floor):
            cost, node = heapq.heappop(queue)
            while leaf[node] < 0:  # go down the near side; the far side waits in the queue
                m = margin[node]
                near = child[node][m > 0]
                heapq.heappush(queue, (cost + m * m, child[node][m <= 0]))
                node = near
            found.append(leaf[node])
            rows += int(sizes[leaf[node]])
        return found


def fit(sample: np.ndarray, scale: float, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    f = Forest(scale, np.zeros((0, 0)), np.zeros(0), np.zeros((0, 2)), np.zeros(0), [])
    y = f.rows(sample)
    directions, splits, child, leaves = [], [], [], []

    def grow(members: np.ndarray) -> int:
        node = len(directions)
        directions.append(np.zeros(y.shape[1]))
        splits.append(0.0)
        child.append([-1, -1])
        leaves.append(-1)
        for _ in range(3 if len(members) >= 2 * leaf else 0):
            a, b = rng.choice(members, 2, replace=False)
            w = y[a] - y[b]
            norm = np.linalg.norm(w)
            if norm < 1e-9:
                continue
            p = y[members] @ (w / norm)
            t = float(np.median(p))
            if (p > t).any() and (p <= t).any():
                directions[node], splits[node] = w / norm, t
                child[node] = [grow(members[p <= t]), grow(members[p > t])]
                return node
        leaves[node] = sum(v >= 0 for v in leaves)
        return node

    roots = [grow(np.arange(len(y))) for _ in range(trees)]
    number = np.array(leaves)
    number[number >= 0] = np.arange((number >= 0).sum())
    return Forest(scale, np.array(directions), np.array(splits), np.array(child), number, roots)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component in double precision."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k].astype(np.float64) * b[:, k].astype(np.float64)
    return out


def _best(q: np.ndarray, qkey: np.ndarray, r: np.ndarray, rkey: np.ndarray, allowed: np.ndarray | None,
          k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, -scores, keys) of the ``k`` best allowed rows of each query that has one."""
    q64, r64 = q.astype(np.float64), r.astype(np.float64)
    s = q64 @ r64.T
    if allowed is not None:
        s[~allowed] = -np.inf
    edge = np.partition(s, max(0, s.shape[1] - k), axis=1)[:, max(0, s.shape[1] - k)]
    near = 1e-9 * (1 + np.abs(edge, where=np.isfinite(edge), out=np.zeros_like(edge)))  # what rounding might have put on either side
    i, j = np.nonzero((s >= (edge - near)[:, None]) & (s > -np.inf))
    exact = dot(q64[i], r64[j])
    order = np.lexsort((rkey[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    cuts = np.searchsorted(i, np.arange(len(q) + 1))
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            b = min(b, a + k)
            yield int(qkey[n]), -exact[a:b], rkey[j[a:b]]


def _classes(rows: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """(key, vec, ids, norm): one row per distinct usable vector; ``ids`` its ``k`` smallest, ``key`` the least."""
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where("id is not null and size(vec) > 0")
    double = rows.schema["vec"].dataType.elementType.simpleString() == "double"
    kind = np.float64 if double else np.float32
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    dim = sizes[0]["size"] if sizes else 0

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a first fold inside each batch, so that a frequent vector sends few ids
        for b in batches:
            ids, vecs = b.column(0).to_numpy(), b.column(1)
            values = vecs.flatten()
            x = values.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)  # nulls become nan
            ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            x, ids = np.ascontiguousarray(x[ok]), ids[ok]
            order = np.argsort(ids, kind="stable")
            groups: dict[bytes, list[int]] = {}
            for n in order.tolist():
                held = groups.setdefault(x[n].tobytes(), [])
                if len(held) < k and (not held or held[-1] != ids[n]):
                    held.append(int(ids[n]))
            yield pa.RecordBatch.from_arrays([pa.array(list(groups), pa.binary()), pa.array(list(groups.values()), pa.list_(pa.int64()))],
                                             names=["vec", "ids"])
    folded = rows.where(F.size("vec") == dim).mapInArrow(fold, "vec binary, ids array<long>")
    merged = folded.groupBy("vec").agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k).alias("ids"))
    return settle(merged.select(F.col("ids")[0].alias("key"), "vec", "ids"), "nn-classes")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1) if raw else np.zeros((0, 0), kind)


def _exact(classes: DataFrame, q: np.ndarray, qkey: np.ndarray, kind: type, k: int) -> DataFrame:
    """(q, found): the ``k`` best classes of a few given queries, by comparison with every class."""
    shared = classes.sparkSession.sparkContext.broadcast((q, qkey))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, names = shared.value
        for b in batches:
            keys, x = b.column(0).to_numpy(), _matrix(b.column(1), kind)
            if not len(x):
                continue
            at = {int(v): n for n, v in enumerate(keys)}
            rows = [(n, s, c, x[at[int(c)]].tobytes()) for n, neg, found in _best(own, names, x, keys, None, k)
                    for s, c in zip(neg.tolist(), found.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.float64(), pa.int64(), pa.binary()))], names=["q", "neg", "key", "vec"])
    found = classes.select("key", "vec").mapInArrow(run, "q long, neg double, key long, vec binary")
    return found.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("neg", "key", "vec"))), 1, k).alias("found"))


def search(rows: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES,
           recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where ``is_query`` holds, their ``k`` nearest other rows."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    kind = np.float64 if rows.schema[vec_col].dataType.elementType.simpleString() == "double" else np.float32
    k1 = k + 1  # a query meets its own class
    classes = _classes(rows, id_col, vec_col, k1)
    # the classes of the queries, found by their vectors' bytes
    asked = _classes_of(rows.where(is_query), classes, id_col, vec_col, kind)
    schema = "query_id long, rank int, vec_id long, score double"

    sample = classes.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("key", "vec").collect()  # at most SAMPLE vectors
    if not sample:
        return spark.createDataFrame([], schema)
    x = np.frombuffer(b"".join(r["vec"] for r in sample), kind).reshape(len(sample), -1).astype(np.float64)

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max((float(np.linalg.norm(_matrix(b.column(0), kind).astype(np.float64), axis=1).max(initial=0)) for b in batches), default=0.0)
        yield pa.RecordBatch.from_arrays([pa.array([most])], names=["norm"])
    scale = classes.select("vec").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0]
    forest = fit(x, scale, trees)
    shared = sc.broadcast(forest)  # at most trees x 2 x SAMPLE / LEAF nodes

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = shared.value.leaves(_matrix(b.column(1), kind).astype(np.float64))
            n, t = found.shape
            index = pa.array(np.repeat(np.arange(n), t))
            yield pa.RecordBatch.from_arrays([b.column(0).take(index), b.column(1).take(index), pa.array(found.ravel())],
                                             names=["key", "vec", "leaf"])
    placed = settle(classes.select("key", "vec").mapInArrow(place, "key long, vec binary, leaf long"), "nn-placed")
    sizes = np.zeros(forest.n_leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():  # one row per leaf
        sizes[r["leaf"]] = r["count"]

    # the budget that finds the asked share of the true neighbours of a few rows
    tune = sample[:TUNE]
    q = x[:len(tune)]
    want = {r["q"]: r["found"] for r in _exact(classes, q, np.arange(len(tune)), kind, k1).collect()}
    places = []
    margin = forest.margins(q)
    for n in range(len(tune)):
        order = {leaf: at for at, leaf in enumerate(forest.search(margin[n], forest.n_leaves, sizes, 0))}
        truth = np.frombuffer(b"".join(f["vec"] for f in want[n] if f["key"] != tune[n]["key"]), kind).astype(np.float64)
        if len(truth):
            places += [min(order[int(v)] for v in row) + 1 for row in forest.leaves(truth.reshape(-1, x.shape[1]))]
    budget = sorted(places)[min(len(places) - 1, int(np.ceil(recall * len(places))))] if places else 1

    # leaves into tiles: consecutive leaves of a tree share one (so a class is there once), a full leaf has several
    begins = forest.first_leaves()
    tile_of, tiles_of, tile, held = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for leaf, n in enumerate(sizes.tolist()):
        if held and (held + n > TILE or leaf in begins):
            tile, held = tile + 1, 0
        tile_of[leaf] = tile
        if n > TILE:
            tiles_of[leaf] = -(-n // TILE)
            tile += int(tiles_of[leaf])
        else:
            held += n
    layout = spark.createDataFrame([(n, int(a), int(b)) for n, (a, b) in enumerate(zip(tile_of, tiles_of))], "leaf long, first long, tiles long")
    row_tiles = (placed.join(F.broadcast(layout), "leaf")  # one row per leaf
                 .withColumn("tile", F.col("first") + F.pmod(F.xxhash64("key"), F.col("tiles")))
                 .groupBy("tile").agg(F.collect_list(F.struct("key", "vec", "leaf")).alias("rows")))

    floor = FLOOR * trees
    plan = sc.broadcast((tile_of, tiles_of, sizes, budget))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (first, tiles, size, most) = shared.value, plan.value
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                margin = own.margins(_matrix(part.column(1), kind).astype(np.float64))
                owner, tile, leaves = [], [], []
                for n in range(part.num_rows):
                    by_tile: dict[int, list[int]] = {}
                    for leaf in own.search(margin[n], most, size, floor):
                        for t in range(int(first[leaf]), int(first[leaf] + tiles[leaf])):
                            by_tile.setdefault(t, []).append(leaf)
                    owner += [n] * len(by_tile)
                    tile += by_tile
                    leaves += by_tile.values()
                at = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int64()), part.column(0).take(at), part.column(1).take(at),
                                                  pa.array(leaves, pa.list_(pa.int32()))], names=["tile", "key", "vec", "leaves"])
    probes = asked.select("key", "vec").distinct().mapInArrow(probe, "tile long, key long, vec binary, leaves array<int>")
    probes = settle(probes, "nn-probes")
    chunks = (probes.join(probes.groupBy("tile").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "tile")
              .withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")))
              .groupBy("tile", "chunk").agg(F.collect_list(F.struct("key", "vec", "leaves")).alias("queries")))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows_, queries in zip(b.column(0), b.column(1)):
                r, s = rows_.values, queries.values
                leaf, row_leaf = np.unique(r.field("leaf").to_numpy(), return_inverse=True)
                open_ = np.zeros((len(s), len(leaf)), bool)
                for n, own in enumerate(s.field("leaves")):
                    at = np.searchsorted(leaf, own.values.to_numpy())
                    at[at == len(leaf)] = 0
                    hit = leaf[at] == own.values.to_numpy()
                    open_[n, at[hit]] = True
                found = list(_best(_matrix(s.field("vec"), kind), s.field("key").to_numpy(), _matrix(r.field("vec"), kind),
                                   r.field("key").to_numpy(), open_[:, row_leaf], k1))
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                                  pa.array([f[1] for f in found], pa.list_(pa.float64())),
                                                  pa.array([f[2] for f in found], pa.list_(pa.int64()))], names=["query", "neg", "keys"])
    scored = row_tiles.join(chunks, "tile").select("rows", "queries").mapInArrow(score, "query long, neg array<double>, keys array<long>")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, best = None, {}

        def done() -> tuple[int, list[float], list[int]]:
            top = sorted((s, c) for c, s in best.items())[:k1]
            return query, [t[0] for t in top], [t[1] for t in top]

        def batch(rows_: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows_], pa.int64()), pa.array([r[1] for r in rows_], pa.list_(pa.float64())),
                                               pa.array([r[2] for r in rows_], pa.list_(pa.int64()))], names=["query", "neg", "keys"])
        for b in batches:
            out = []
            for q_, neg, keys in zip(*(pylist(b, c) for c in ("query", "neg", "keys"))):
                if q_ != query:
                    if query is not None:
                        out.append(done())
                    query, best = q_, {}
                best.update(zip(keys, neg))
            yield batch(out)
        if query is not None:
            yield batch([done()])
    merged = scored.repartition("query").sortWithinPartitions("query").mapInArrow(merge, "query long, neg array<double>, keys array<long>")

    # classes back to ids: per class of queries the k + 1 first ids, then each query without itself
    pairs = merged.select("query", F.explode(F.arrays_zip("neg", "keys")).alias("p")).select("query", "p.neg", F.col("p.keys").alias("key"))
    ids = pairs.join(classes.select("key", "ids"), "key").select("query", "neg", F.explode("ids").alias("id"))
    lists = ids.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("neg", "id"))), 1, k1).alias("found"))
    own = asked.join(lists, asked.key == lists.query).select(
        "query_id", F.posexplode(F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k)).alias("at", "f"))
    return own.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.id").alias("vec_id"), (-F.col("f.neg")).alias("score"))


def _classes_of(queries: DataFrame, classes: DataFrame, id_col: str, vec_col: str, kind: type) -> DataFrame:
    """(query_id, key, vec) of the query rows that have a class."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [np.array(v, kind).tobytes() if None not in v else b"" for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], names=["query_id", "vec"])
    rows = (queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).alias("vec"))
            .where("query_id is not null and vec is not null").mapInArrow(pack, "query_id long, vec binary").distinct())
    return settle(rows.join(classes.select("key", "vec"), "vec").select("query_id", "key", "vec"), "nn-asked")
