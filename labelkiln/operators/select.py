"""The n largest rows of a table, chosen in parallel: a histogram finds the cut, a filter keeps the rows (G1, H6).

``orderBy().limit(n)`` sends up to n rows of every task to one task, which
ends at n in the tens of thousands.  Here only counts travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .features import ordered_index

#: Leading hash digits that a histogram counts: 16^4 rows at most.
DIGITS = 4


def _cut(hist: DataFrame, key: str, n: int, descending: bool) -> tuple | None:
    """(key at which the running count reaches n, count before it); None if there are fewer than n rows."""
    order = F.desc(key) if descending else F.asc(key)
    running = F.sum("_n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))  # one row a distinct key
    row = hist.withColumn("_s", running).where(F.col("_s") >= n).orderBy("_s").select(key, (F.col("_s") - F.col("_n")).alias("_before")).first()
    return None if row is None else (row[0], row["_before"])


def largest(df: DataFrame, count_col: str, tie_col: str, n: int) -> DataFrame:
    """The n rows with the largest integer ``count_col``, ties by the smaller string ``tie_col`` (distinct).

    The histogram has a row for each distinct count: their number grows with
    the square root of the sum at most.  Of the rows at the cut, those
    first by ``tie_col`` are found by their exact index.
    """
    found = _cut(df.groupBy(count_col).agg(F.count(F.lit(1)).alias("_n")), count_col, n, True)
    if found is None:
        return df
    cut, before = found
    above = df.where(F.col(count_col) > cut)
    ties = ordered_index(df.where(F.col(count_col) == cut), tie_col, F.substring(tie_col, 1, 3), "_place").where(F.col("_place") < n - before)
    return above.unionByName(ties.drop("_place"))


def smallest_hash(df: DataFrame, hash_col: str, id_col: str, n: int) -> DataFrame:
    """The n rows with the smallest hexadecimal ``hash_col``, ties by ``id_col``: a seeded sample of exactly n.

    Rows below the cut prefix are kept whole; only those of that one prefix
    (a 65,536th of the table) are ordered.
    """
    prefix = F.substring(hash_col, 1, DIGITS)
    found = _cut(df.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n")), "_p", n, False)
    if found is None:
        return df
    cut, before = found
    rest = df.where(prefix == cut).orderBy(hash_col, id_col).limit(n - before)
    return df.where(prefix < cut).unionByName(rest)
