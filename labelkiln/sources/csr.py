"""Feature matrices as CSR shards: indptr, indices and data per shard, with the place of its first row (A10).

A shard holds ``rows`` consecutive matrix rows in a single table row: ids,
``indptr`` (one entry more than ids), ``indices`` (ascending inside a row) and
``data``.  Rows keep the order of their index, so any range of rows is read
from the shards that hold it, without the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import ordered_index

SHARD_ROWS = 4_096


def shards_of(frame: DataFrame, x: DataFrame, id_col: str, rows: int = SHARD_ROWS) -> DataFrame:
    """The rows of ``frame`` (id, split) as shards, in id order, split by split; ``x`` has the lists (id, idx, value) of each id, idx ascending.

    The lists meet their rows by a sort: their files are so much smaller than the lists that Spark would take the matrix for
    a small table and send it whole through the driver.
    """
    placed = ordered_index(frame.select(id_col, "split").withColumn("_o", F.struct("split", id_col)), "_o",
                           F.struct("split", (F.col(id_col) / F.lit(65_536)).cast("bigint")), "row").drop("_o")
    first = placed.groupBy("split").agg(F.min("row").alias("base"))
    placed = placed.join(F.broadcast(first), "split").withColumn("place", F.col("row") - F.col("base"))  # a row a split
    e = F.coalesce("e", F.array().cast("array<struct<idx:int,value:double>>"))
    row = F.struct("place", id_col, e.alias("e"))
    entry = F.arrays_zip(F.col("idx").cast("array<int>").alias("idx"), F.col("value").cast("array<double>").alias("value"))
    listed = x.select(id_col, entry.cast("array<struct<idx:int,value:double>>").alias("e"))
    full = placed.join(listed.hint("merge"), id_col, "left").withColumn("shard", (F.col("place") / F.lit(rows)).cast("int"))
    shards = full.groupBy("split", "shard").agg(F.array_sort(F.collect_list(row)).alias("r"))  # ``rows`` rows at most
    flat = F.flatten(F.col("r.e"))
    ends = F.expr("transform(r, x -> size(x.e))")
    return shards.select("split", "shard", (F.col("shard") * rows).cast("long").alias("first_row"), F.col(f"r.{id_col}").alias("ids"),
                  ends.alias("sizes"), flat["idx"].alias("indices"), flat["value"].alias("data")).select(
        "split", "shard", "first_row", "ids",
        F.expr("aggregate(sizes, array(0L), (a, n) -> concat(a, array(element_at(a, -1) + n)))").alias("indptr"), "indices", "data")


def write(frame: DataFrame, x: DataFrame, id_col: str, path: str, rows: int = SHARD_ROWS) -> str:
    """Write the shards of ``frame``, a folder a split."""
    shards_of(frame, x, id_col, rows).write.partitionBy("split").parquet(path)
    return path


def read_rows(shards: DataFrame, id_col: str, split: str | None = None, start: int = 0, stop: int | None = None) -> DataFrame:
    """(split, place, id, idx, value) with lists idx and value: the rows ``start`` to ``stop`` of a split (all without it)."""
    if split is not None:
        shards = shards.where(F.col("split") == split)
    shards = shards.where(F.col("first_row") + F.size("ids") > start)
    if stop is not None:
        shards = shards.where(F.col("first_row") < stop)
    rows = shards.select("split", "first_row", "indptr", "indices", "data", F.posexplode("ids").alias("k", id_col))
    rows = rows.withColumn("place", F.col("first_row") + F.col("k")).where(F.col("place") >= start)
    if stop is not None:
        rows = rows.where(F.col("place") < stop)
    cut = "slice({}, int(indptr[k]) + 1, int(indptr[k + 1] - indptr[k]))".format
    return rows.select("split", "place", id_col, F.expr(cut("indices")).alias("idx"), F.expr(cut("data")).alias("value"))


def read(shards: DataFrame, id_col: str, split: str | None = None, start: int = 0, stop: int | None = None) -> DataFrame:
    """The same in long form, (split, place, id, idx, value); a row without entries has null idx."""
    rows = read_rows(shards, id_col, split, start, stop)
    return rows.select("split", "place", id_col, F.explode_outer(F.arrays_zip("idx", "value")).alias("e")).select(
        "split", "place", id_col, F.col("e.idx").alias("idx"), F.col("e.value").alias("value"))
