"""Per-report roll-up of child tables (D1 ordered distinct lists, D2 agg_table).

Scale design: a report can own an unbounded number of child rows (one
key may hold a third of the table), so no step collects a whole group.

1. stack the value columns to long ``(key, col, v, pos)``; blanks and
   nulls dropped, values stripped; one extra ``#rows`` entry per child
   row carries the row count;
2. ``groupBy(key, col, v)`` -> first position and row count; partial
   aggregation folds repeats map-side, and the hash on (key, col, v)
   spreads a hot key over all reducers;
3. ``row_number() over (key, col order by pos) <= max_items`` -- planned
   as a partial WindowGroupLimit before the shuffle, so at most
   ``max_items`` rows per key leave each map task;
4. ``groupBy(key)`` collects at most ``max_items`` structs per column,
   sorts them by position and joins them.

With ``keys`` (a table whose rows are counted by key) these steps are for the
keys of more than HOT_ROWS rows.  The rows of all others are shuffled once, by
key, as they are, and take steps 1 to 4 where they meet.

One list without a row count needs no ``#rows`` entries: a blank value
keeps its key and comes last.  Its window is over the key alone, so step 4
finds the key's rows where they are, in order: it reads the list off the
sorted rows instead of grouping and sorting them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TERM_SEP, strip
from ..session import settle

_ROWS = "#rows"
#: Rows of a key that one task takes as they are; the rows of a larger key are folded before they meet.
HOT_ROWS = 10_000


def agg_table(df: DataFrame, key: str, columns: dict[str, str], order_cols: list[str],
              count_names: list[str] | None = None, max_items: int = 50,
              as_array: bool = False, position: Column | None = None, keys: DataFrame | None = None) -> DataFrame:
    """D2 (and D1): per key, row count(s) plus ordered distinct lists.

    ``columns`` maps output name -> source column.  Each list holds the
    first ``max_items`` distinct stripped non-blank values in
    ``order_cols`` order, '; '-joined (or ``array<string>`` when
    ``as_array``).  A key whose values are all blank gets '' (not null).
    ``position`` is one number with the order of ``order_cols``: its minimum
    needs no sort, as that of a struct does.
    """
    count_names = count_names or []
    pos = (F.struct(*[F.col(c) for c in order_cols]) if position is None else position).alias("pos")
    if len(columns) == 1 and not count_names:
        return _one_list(df, key, *next(iter(columns.items())), pos, max_items, as_array)
    if keys is not None:
        n = F.count(F.lit(1)).alias("n")
        hot = settle(keys.groupBy(F.col(key).alias("_hot")).agg(n).where(F.col("n") > HOT_ROWS).select("_hot"), "hot-keys")
        few, many = (df.join(F.broadcast(hot), F.col(key) == F.col("_hot"), how) for how in ("left_anti", "left_semi"))  # a row for HOT_ROWS rows at most
        lists = lambda rows: _lists(rows, key, columns, "pos", count_names, max_items, as_array)
        few, many = (t.select(key, pos, *dict.fromkeys(columns.values())) for t in (few, many))
        return lists(few.repartition(key)).unionByName(lists(many))
    return _lists(df, key, columns, pos, count_names, max_items, as_array)


def _lists(df: DataFrame, key: str, columns: dict[str, str], pos: Column | str, count_names: list[str], max_items: int, as_array: bool) -> DataFrame:
    """Steps 1 to 4."""
    pairs = [F.struct(F.lit(_ROWS).alias("c"), F.lit("").alias("v"))]
    pairs += [F.struct(F.lit(out).alias("c"), strip(F.col(src).cast("string")).alias("v"))
              for out, src in columns.items()]
    long = (df.select(F.col(key), pos, F.explode(F.array(*pairs)).alias("cv"))
            .select(key, "pos", F.col("cv.c").alias("c"), F.col("cv.v").alias("v"))
            .where((F.col("c") == _ROWS) | (F.col("v").isNotNull() & (F.col("v") != ""))))
    firsts = long.groupBy(key, "c", "v").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key, "c").orderBy("pos", "v")
    top = firsts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_items)
    aggs = [F.sum(F.when(F.col("c") == _ROWS, F.col("n"))).alias(name) for name in count_names]
    for out in columns:
        items = F.sort_array(F.collect_list(F.when(F.col("c") == out, F.struct("pos", "v"))))
        arr = F.transform(items, lambda s: s["v"])
        aggs.append((arr if as_array else F.array_join(arr, TERM_SEP)).alias(out))
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("_n")]
    return top.groupBy(key).agg(*aggs)


def _one_list(df: DataFrame, key: str, out: str, src: str, pos: Column, max_items: int, as_array: bool) -> DataFrame:
    """(key, out): the first ``max_items`` distinct values; two exchanges, by (key, value) and by key."""
    v = F.coalesce(strip(F.col(src).cast("string")), F.lit(""))
    firsts = df.select(key, v.alias("v"), pos).groupBy(key, "v").agg(F.min("pos").alias("pos"))
    blank = F.col("v") == ""
    w = Window.partitionBy(key).orderBy(blank, "pos", "v")
    top = firsts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_items)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = top.withColumn("items", F.collect_list(F.when(~blank, F.col("v"))).over(whole)).where(F.col("rn") == 1)  # max_items rows at most
    return met.select(key, (F.col("items") if as_array else F.array_join("items", TERM_SEP)).alias(out))


def ordered_distinct_lists(df: DataFrame, key: str, columns: dict[str, str],
                           order_cols: list[str], max_items: int = 50,
                           as_array: bool = False) -> DataFrame:
    """D1 alone: ``key`` plus one ordered distinct list per output column."""
    return agg_table(df, key, columns, order_cols, [], max_items, as_array)
