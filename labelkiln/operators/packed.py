"""Term counts and features with one table row per id: what a text holds never travels term by term.

A long ``(id, term, tf)`` table is ten to fifty times its texts, and every
group or window over it shuffles and sorts all of that.  Here the rows of an
id meet once, as texts; its distinct terms and their counts are lists in one
row, and so are its features:

* ``count_terms``  -- lists of terms and counts per space, written once;
* ``term_table``   -- the lists as (term, tf), for the vocabulary's aggregate;
* ``features``     -- lists ``idx`` (ascending) and ``value``, row by row;
* ``mask``         -- the selected features of each row, re-indexed;
* ``entries``      -- the long form, for aggregates over features;
* ``feature_sums`` -- sums of each feature, added up inside the tasks first.

``features`` does the steps that follow it in its own pass over the rows if
asked to: every step apart would send all lists through Python once more.

Ids may repeat: ``copies`` is the number of table rows behind an id, and
columns in ``sums`` are added up over them, so sums over an id's features
weigh it as a join with the table by id would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import text as T
from ..functions.text import WS

#: Words of a slice of an Arrow batch that is counted at once.
SLICE_WORDS = 100_000
#: Bytes of an Arrow batch: a count of rows bounds nothing where one text has a thousand times the terms of another.
BATCH_BYTES = 8 << 20
#: Rows of a batch of the Parquet reader, which holds all lists of a batch in memory: a document has thousands of terms.
READ_ROWS = 128
#: Vocabularies up to so many terms are sent to every task and looked up there; larger ones are joined by term.
LOOKUP_TERMS = 1_000_000


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to about BATCH_BYTES and those of Parquet files to READ_ROWS rows (smaller settings stay)."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)):
        now = conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def word_lists(token_re: str = T.WORD_TOKEN_DEFAULT):
    """Tokens of a text, whose 1- and 2-grams are the terms."""
    return "words", lambda text: T.word_tokens(text, token_re)


def char_lists(n_min: int = 3, n_max: int = 5):
    """Words of a text, whose char_wb n-grams are the terms."""
    return (n_min, n_max), lambda text: F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WS + "+"), lambda w: w != "")


def _positions(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then those of the next."""
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return np.diff(np.asarray(lists.offsets)).astype(np.int64)


def _counted(texts: pa.ListArray, kind) -> tuple[pa.ListArray, pa.ListArray]:
    """(distinct terms in their order, counts) of each row, from its texts' lists of words."""
    per_row = _sizes(texts)
    words = texts.flatten()
    per_text = _sizes(words)
    enc = words.flatten().dictionary_encode()
    known = enc.dictionary.to_pylist()
    code = enc.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(per_text)), per_text)
    row = np.repeat(np.arange(len(per_row)), per_row)[text]
    if kind == "words":  # each distinct pair of neighbours is spelled once
        ids = {w: i for i, w in enumerate(known)}
        near = text[1:] == text[:-1]
        pairs, at = np.unique(code[:-1][near] * max(1, len(known)) + code[1:][near], return_inverse=True)
        spelled = np.array([ids.setdefault(f"{known[p // len(known)]} {known[p % len(known)]}", len(ids)) for p in pairs.tolist()], np.int64)
        row, term = np.concatenate([row, row[1:][near]]), np.concatenate([code, spelled[at]])
    else:  # each distinct word is cut once
        lo, hi = kind
        ids, cut, sizes = {}, [], []
        for w in known:
            p = f" {w} "
            grams = [ids.setdefault(p[i:i + n], len(ids)) for n in range(lo, max(min(hi, len(p)), lo) + 1) for i in range(len(p) - n + 1)]
            cut += grams
            sizes.append(len(grams))
        sizes = np.array(sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        term = np.array(cut, np.int64)[_positions(starts[code], sizes[code])]
        row = np.repeat(row, sizes[code])
    spelled = sorted(ids)  # the terms of a row stand in term order, which is that of a vocabulary's indexes
    rank = np.empty(len(ids), np.int64)
    rank[np.fromiter(map(ids.get, spelled), np.int64, len(ids))] = np.arange(len(ids))
    key, n = np.unique(row * max(1, len(ids)) + rank[term], return_counts=True)
    offsets = _offsets(np.bincount(key // max(1, len(ids)), minlength=len(per_row)))
    terms = pa.array(spelled, pa.string()).take(pa.array(key % max(1, len(ids))))
    return pa.ListArray.from_arrays(offsets, terms), pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32)))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_WORDS together (a longer row stands alone)."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_WORDS)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)])


def _groups(batches, key: list[str]) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray]]:
    """(batches, first rows of the groups in them) of whole groups, from batches sorted by ``key``; one that goes on waits for its end."""
    last, waiting, held = object(), [], 0
    for b in batches:
        if not b.num_rows:
            continue
        at = list(zip(*[b.column(c).to_pylist() for c in key]))
        starts = [i for i, k in enumerate(at) if k != (at[i - 1] if i else last)]
        last = at[-1]
        if starts:
            ended = [0] * bool(held) + [held + i for i in starts[:-1]]
            if ended:
                yield [*waiting, b.slice(0, starts[-1])], np.array(ended, np.int64)
            waiting, held = [], 0
            b = b.slice(starts[-1])
        waiting.append(b)
        held += b.num_rows
    if waiting:
        yield waiting, np.zeros(1, np.int64)


def _added(column: pa.Array, starts: np.ndarray) -> pa.Array:
    """Sums of the groups' values as SQL adds them: nulls are passed over, a group of nulls is null."""
    known = np.add.reduceat(column.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), starts)
    return pa.array(np.add.reduceat(column.fill_null(0).to_numpy(), starts), mask=known == 0)


def count_terms(df: DataFrame, id_col: str, spaces: dict, keep: list[str] = (), sums: list[str] = (), text_col: str = "text",
                meta: bool = False) -> DataFrame:
    """(id, keep, copies, sums, meta, <space>_terms, <space>_tf): one row an id; ``keep`` has one value an id.

    ``spaces`` maps a name to ``word_lists()`` or ``char_lists()``.  Terms never cross from one text of an id to another.
    Rows travel once, as texts, and are sorted by id; equal ids then stand together, so no aggregate holds or sorts texts again.
    """
    key = [id_col, *keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    met = df.select(*key, *[F.col(c).cast("long").alias(c) for c in sums], text.alias("_text")).repartition(id_col).sortWithinPartitions(*key)
    kinds = {s: k for s, (k, _) in spaces.items()}
    parts = [F.array(*[c.cast("double") for c in T.meta_features(F.col("_text"))]).alias("meta")] if meta else []
    rows = met.select(*key, *sums, *parts, *[f(F.col("_text")).alias(s) for s, (_, f) in spaces.items()])
    out = StructType([*[rows.schema[c] for c in key], StructField("copies", LongType()), *[StructField(c, LongType()) for c in sums],
                      *([StructField("meta", ArrayType(DoubleType()))] if meta else []),
                      *[f for s in kinds for f in (StructField(f"{s}_terms", ArrayType(StringType())), StructField(f"{s}_tf", ArrayType(IntegerType())))]])

    taken = rows.columns

    def run(batches):
        for group, starts in _groups(batches, key):
            n = np.diff([*starts, sum(b.num_rows for b in group)])
            words = sum(np.concatenate([_sizes(b.column(s)) for b in group]) for s in kinds)
            at = {c: pa.concat_arrays([b.column(c) for b in group]) for c in taken}
            for lo, hi in _slices(np.add.reduceat(words, starts)):
                first = starts[lo:hi] - starts[lo]
                part = {c: pa.concat_arrays([a.slice(starts[lo], int(n[lo:hi].sum()))]) for c, a in at.items()}
                found = [pa.ListArray.from_arrays(_offsets(3 * n[lo:hi]), part["meta"].flatten())] if meta else []
                found += [x for s, k in kinds.items() for x in _counted(pa.ListArray.from_arrays(_offsets(n[lo:hi]), part[s]), k)]
                yield pa.RecordBatch.from_arrays([*[part[c].take(pa.array(first)) for c in key], pa.array(n[lo:hi]),
                                                  *[_added(part[c], first) for c in sums], *found], names=out.names)
    return bounded(rows).mapInArrow(run, out)


def term_table(counts: DataFrame, space: str) -> DataFrame:
    """(term, tf): the entries of all rows, for an aggregate by term."""
    return counts.select(F.explode(F.arrays_zip(f"{space}_terms", f"{space}_tf")).alias("e")).select(
        F.col(f"e.{space}_terms").alias("term"), F.col(f"e.{space}_tf").alias("tf"))


def _joined(counts: DataFrame, id_col: str, space: str, vocab: DataFrame) -> DataFrame:
    """``counts`` with the indexes, counts and idf of a space's known terms, found by a join: for a vocabulary no task can hold."""
    key = [c for c in counts.columns if not isinstance(counts.schema[c].dataType, ArrayType)]  # one row an id and what is kept of it
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    e = counts.select(*key, F.explode(F.arrays_zip(f"{space}_terms", f"{space}_tf")).alias("e")).select(*key, F.col(f"e.{space}_terms").alias("term"), F.col(f"e.{space}_tf").alias("tf"))
    found = e.join(vocab.select("term", "idx", "idf"), "term").groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(
        F.array_sort(F.collect_list(F.struct("idx", "tf", "idf"))).alias("_f"))
    on = same[0]
    for c in same[1:]:
        on = on & c
    lists = [F.coalesce(F.col(f"_f.{c}"), F.array().cast(f"array<{t}>")).alias(f"{space}_{c}") for c, t in (("idx", "int"), ("tf", "int"), ("idf", "double"))]
    return counts.join(found, on, "left").select(*[c for c in counts.columns if c not in (f"{space}_terms", f"{space}_tf")], *lists)


def lookups(vocabs: dict[str, DataFrame]):
    """The terms of each vocabulary that a task can hold, sent to all tasks: space -> (places by term, idx, idf)."""
    small = {}
    for s, vocab in vocabs.items():
        first = vocab.select("term", "idx", "idf").limit(LOOKUP_TERMS + 1)
        rows = first.toArrow() if first.count() <= LOOKUP_TERMS else None  # bounded by LOOKUP_TERMS
        if rows is not None:
            at = dict(zip(rows["term"].to_pylist(), range(rows.num_rows)))
            small[s] = at, np.asarray(rows["idx"].to_numpy(), np.int64), np.asarray(rows["idf"].to_numpy(), np.float64)
    return next(iter(vocabs.values())).sparkSession.sparkContext.broadcast(small)


def features(counts: DataFrame, id_col: str, vocabs: dict[str, DataFrame], offsets: dict[str, int], meta_at: int | None = None,
             selected: DataFrame | None = None, sums: list[str] | None = None, size: int | None = None, sent=None, weights=None) -> DataFrame:
    """G2 + G3: (id, kept columns, idx, value): sublinear TF-IDF of each space, L2-normalised per row and space, behind one another.

    The terms of a vocabulary of up to LOOKUP_TERMS go to every task (``sent``,
    if ``lookups`` sent them before); those of a larger one come by a join.
    ``meta_at`` is the index of the first of the three meta features, which an
    id has once for each of its copies.

    What follows may be done in the same pass, before the lists leave the
    task: ``selected`` is that of ``mask``, ``sums`` gives the result of
    ``feature_sums`` for these columns, ``size`` the lists as one vector
    ``features`` of that width, and ``weights``, a matrix sent to the tasks
    with a row a feature, the products ``s`` of a row with its columns
    (features below 0 count in the norm alone).
    """
    sent = lookups(vocabs) if sent is None else sent
    small, names = set(sent.value), list(vocabs)
    for s in names:
        if s not in small:
            counts = _joined(counts, id_col, s, vocabs[s])
    lists = {f"{s}_{c}" for s in vocabs for c in ("terms", "tf", "idx", "idf")} | {"meta"}
    plain = [f for f in counts.schema.fields if f.name not in lists and not f.name.endswith(("_terms", "_tf"))]
    if sums is not None:
        plain = [f for f in plain if f.name in ("copies", *sums)]
    out = StructType([*plain, StructField("idx", ArrayType(IntegerType())), StructField("value", ArrayType(DoubleType()))])
    pairs = None if selected is None else _selection(selected)

    def space(b: pa.RecordBatch, s: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tf = b.column(f"{s}_tf")
        row, tf = np.repeat(np.arange(b.num_rows), _sizes(tf)), tf.flatten().to_numpy().astype(np.float64)
        if s in sent.value:
            at, idx, idf = sent.value[s]
            enc = b.column(f"{s}_terms").flatten().dictionary_encode()
            found = np.array([at.get(t, -1) for t in enc.dictionary.to_pylist()], np.int64)
            place = found[enc.indices.to_numpy()] if len(found) else np.zeros(0, np.int64)
            known = place >= 0
            row, tf, place = row[known], tf[known], place[known]
            idx, idf = idx[place], idf[place]
        else:
            idx, idf = (b.column(f"{s}_{c}").flatten().to_numpy() for c in ("idx", "idf"))
        w = (1.0 + np.log(tf)) * idf
        norm = np.sqrt(np.bincount(row, weights=w * w, minlength=b.num_rows))
        return row, idx.astype(np.int64) + offsets[s], w / norm[row]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            parts = [space(b, s) for s in names]
            if meta_at is not None:
                n = _sizes(b.column("meta"))
                parts.append((np.repeat(np.arange(b.num_rows), n), meta_at + _positions(np.zeros(len(n), np.int64), n) % 3,
                              b.column("meta").flatten().to_numpy()))
            if weights is not None:
                w = weights.value
                met = [(row[i >= 0], i[i >= 0], v[i >= 0]) for row, i, v in parts]
                s = np.array([sum(np.bincount(row, weights=v * w[i, k], minlength=b.num_rows) for row, i, v in met) for k in range(w.shape[1])])
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in plain], pa.ListArray.from_arrays(_offsets(np.full(b.num_rows, w.shape[1])), pa.array(s.T.ravel()))],
                                                 names=[*[f.name for f in plain], "s"])
                continue
            idx, value, held = _side_by_side(parts, b.num_rows)
            cuts = _offsets(held)
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in plain], pa.ListArray.from_arrays(cuts, pa.array(idx.astype(np.int32))),
                                              pa.ListArray.from_arrays(cuts, pa.array(value.astype(np.float64)))], names=out.names)

    def steps(batches):
        found = run(batches)
        if pairs is not None:
            found = _masked(found, *pairs.value)
        if sums is not None:
            found = _summed(found, sums)
        return found if size is None else _vectors(found, size)
    wanted = [f.name for f in plain] + [f"{s}_{c}" for s in vocabs for c in (("terms", "tf") if s in small else ("idx", "tf", "idf"))]
    read = bounded(counts.select(*wanted, *(["meta"] if meta_at is not None else [])))
    if weights is not None:
        return read.mapInArrow(run, StructType([*plain, StructField("s", ArrayType(DoubleType()))]))
    if sums is not None:
        return _added_up(read.mapInArrow(steps, _sums_schema(sums)), sums)
    return read.mapInArrow(steps, out if size is None else StructType([*plain, StructField("features", VectorUDT())]))


def _side_by_side(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indexes, values, entries of each row), rows behind one another and ascending inside, from parts (row, idx, value) in row order."""
    sizes = [np.bincount(row, minlength=n_rows) for row, _, _ in parts]
    held = np.sum(sizes, axis=0).astype(np.int64)
    idx, value = np.empty(int(held.sum()), np.int64), np.empty(int(held.sum()), np.float64)
    at = np.cumsum(held) - held
    for (row, i, v), n in zip(parts, sizes):
        place = _positions(at, n)
        idx[place], value[place] = i, v
        at = at + n
    row = np.repeat(np.arange(n_rows), held)
    if np.any((idx[1:] < idx[:-1]) & (row[1:] == row[:-1])):  # lists written in another order, or copies of the meta features
        order = np.lexsort((idx, row))
        idx, value = idx[order], value[order]
    return idx, value, held


def _selection(selected: DataFrame):
    """The selected features (idx, new_idx), by idx, for every task; bounded by labels x top-k."""
    pairs = selected.select(F.col("idx").cast("int").alias("idx"), F.col("new_idx").cast("int").alias("new_idx")).toArrow()
    order = np.argsort(pairs["idx"].to_numpy())
    return selected.sparkSession.sparkContext.broadcast((pairs["idx"].to_numpy()[order], pairs["new_idx"].to_numpy()[order]))


def _masked(batches, was: np.ndarray, now: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        lists, value = b.column("idx"), b.column("value").flatten().to_numpy()
        row, idx = np.repeat(np.arange(b.num_rows), _sizes(lists)), lists.flatten().to_numpy()
        place = np.minimum(np.searchsorted(was, idx), max(0, len(was) - 1))
        kept = was[place] == idx if len(was) else np.zeros(len(idx), bool)
        cuts = _offsets(np.bincount(row[kept], minlength=b.num_rows))
        new = {"idx": pa.ListArray.from_arrays(cuts, pa.array(now[place[kept]].astype(np.int32))), "value": pa.ListArray.from_arrays(cuts, pa.array(value[kept]))}
        yield pa.RecordBatch.from_arrays([new.get(n, b.column(n)) for n in b.schema.names], names=b.schema.names)


def mask(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """The selected features (idx, new_idx) of each row, re-indexed."""
    pairs = _selection(selected)
    return bounded(rows).mapInArrow(lambda batches: _masked(batches, *pairs.value), rows.schema)


def _vectors(batches, size: int) -> Iterator[pa.RecordBatch]:
    """The lists of each row as the fields of a sparse vector."""
    for b in batches:
        kept = [n for n in b.schema.names if n not in ("idx", "value")]
        vector = pa.StructArray.from_arrays([pa.array(np.zeros(b.num_rows, np.int8)), pa.array(np.full(b.num_rows, size, np.int32)), b.column("idx"), b.column("value")],
                                            names=["type", "size", "indices", "values"])
        yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], vector], names=[*kept, "features"])


def entries(rows: DataFrame, *keep: str | Column) -> DataFrame:
    """(keep, idx, value): the long form of the rows."""
    return rows.select(*keep, F.explode(F.arrays_zip("idx", "value")).alias("_e")).select(
        *[k if isinstance(k, str) else k for k in keep], F.col("_e.idx").alias("idx"), F.col("_e.value").alias("value"))


def _sums_schema(y_cols: list[str]) -> StructType:
    return StructType([StructField("idx", IntegerType()), *[StructField(c, DoubleType()) for c in ("total", *[f"o_{c}" for c in y_cols])]])


def _summed(batches, y_cols: list[str]) -> Iterator[pa.RecordBatch]:
    """Sums of a batch's features, one row a feature: what leaves the task is no longer than the features met."""
    names = _sums_schema(y_cols).names
    for b in batches:
        row, idx, value = np.repeat(np.arange(b.num_rows), _sizes(b.column("idx"))), b.column("idx").flatten().to_numpy(), b.column("value").flatten().to_numpy()
        if not len(idx):
            continue
        found, at = np.unique(idx, return_inverse=True) if int(idx.max()) > 4 * len(idx) else (np.arange(int(idx.max()) + 1), idx)
        met = np.bincount(at, minlength=len(found)) > 0
        out = []
        for c in ("copies", *y_cols):  # as SQL adds them: nulls are passed over, a sum of nulls is null
            y = b.column(c)
            total = np.bincount(at, weights=value * y.fill_null(0).to_numpy().astype(np.float64)[row], minlength=len(found))
            null = None
            if y.null_count:
                null = np.bincount(at[y.is_valid().to_numpy(zero_copy_only=False)[row]], minlength=len(found))[met] == 0
            out.append(pa.array(total[met], mask=null))
        yield pa.RecordBatch.from_arrays([pa.array(found[met].astype(np.int32)), *out], names=names)


def _added_up(parts: DataFrame, y_cols: list[str]) -> DataFrame:
    return parts.groupBy("idx").agg(*[F.sum(c).alias(c) for c in ("total", *[f"o_{c}" for c in y_cols])])


def feature_sums(rows: DataFrame, y_cols: list[str]) -> DataFrame:
    """(idx, total, o_<y>...): sum of a feature over all table rows and over the positives of each label; sums per batch, then per task."""
    return _added_up(bounded(rows.select("copies", *y_cols, "idx", "value")).mapInArrow(lambda batches: _summed(batches, y_cols), _sums_schema(y_cols)), y_cols)
