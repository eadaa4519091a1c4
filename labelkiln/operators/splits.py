"""Text hashing, dedup, leakage-free stratified splits.

No step sorts a whole table or a whole stratum in one task:

* dedup keeps the first row per text with ``min_by`` (partial aggregate);
* an exact "first k of a stratum by hash order" is computed from a
  per-(stratum, hash-bucket) histogram -- bounded by
  strata x 16^digits rows, so it is broadcast -- plus a row_number inside
  each (stratum, bucket), which spreads any stratum over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import labname

NONE_STRATUM = "__none__"


def text_hash(text: Column) -> Column:
    """H1: md5 hex of the text (null -> '')."""
    return F.md5(F.coalesce(text, F.lit("")))


def seeded_hash(seed, *cols) -> Column:
    """md5 hex of 'seed|c1|c2...' (cast to string)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def hash_bytes(hex_hash: Column) -> Column:
    """The 16 bytes of a hex hash; never null, so that no null check on it sets apart what reads the same exchange."""
    return F.coalesce(F.unhex(hex_hash), F.lit(b""))


def unit(hex_hash: Column) -> Column:
    """Uniform [0, 1) from the first 32 bits of a hex hash."""
    return F.conv(F.substring(hex_hash, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def dedup_by_text(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """H2: one row per text hash, the one with the smallest id (partial aggregation, no sort)."""
    cols = [c for c in df.columns]
    h = df.withColumn("text_hash", text_hash(F.col(text_col)))
    agg = h.groupBy("text_hash").agg(F.min_by(F.struct(*cols), F.col(id_col)).alias("r"))
    return agg.select("text_hash", "r.*")


def exact_rank(df: DataFrame, part_cols: list[str], order_col: str, tie_col: str,
               digits: int = 3) -> DataFrame:
    """Add ``rank`` (1-based, by ``order_col``, a hash as hex or as its bytes, then ``tie_col``) within ``part_cols`` and ``part_n``.

    Buckets are the first ``digits`` hex characters of ``order_col``; the
    histogram (parts x 16^digits rows at most) is broadcast.
    """
    held = F.col(order_col) if df.schema[order_col].dataType.typeName() == "string" else F.hex(order_col)
    b = df.withColumn("_bucket", F.substring(held, 1, digits))
    hist = b.groupBy(*part_cols, "_bucket").agg(F.count(F.lit(1)).alias("_bn"))
    wcum = Window.partitionBy(*part_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wtot = Window.partitionBy(*part_cols)
    offsets = hist.select(*part_cols, "_bucket",
                          F.coalesce(F.sum("_bn").over(wcum), F.lit(0)).alias("_off"),
                          F.sum("_bn").over(wtot).alias("part_n"))
    w = Window.partitionBy(*part_cols, "_bucket").orderBy(order_col, tie_col)
    ranked = b.withColumn("_rn", F.row_number().over(w))
    out = ranked.join(F.broadcast(offsets), part_cols + ["_bucket"])
    return out.withColumn("rank", F.col("_off") + F.col("_rn")).drop("_bucket", "_rn", "_off", "_bn")


def share_count(n: Column, share_pct: int) -> Column:
    """round-half-up(n * share_pct / 100), exact for integer n."""
    return F.floor((n * F.lit(share_pct) + F.lit(50)) / F.lit(100)).cast("bigint")


def rarest_label_stratum(unique: DataFrame, y_cols: list[str]) -> DataFrame:
    """Stratum = the row's positive label with the fewest positives overall (ties by name)."""
    counts = unique.agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in y_cols])
    cand = F.array_compact(F.array(*[
        F.when(F.col(c) == 1, F.struct(F.col(f"_cnt_{c}").alias("n"), F.lit(labname(c)).alias("label")))
        for c in y_cols]))
    j = unique.crossJoin(F.broadcast(counts.select(*[F.col(c).alias(f"_cnt_{c}") for c in y_cols])))
    return j.withColumn("stratum", F.coalesce(F.array_min(cand)["label"], F.lit(NONE_STRATUM))).drop(
        *[f"_cnt_{c}" for c in y_cols])


def noleak_group_split(df: DataFrame, text_col: str, id_col: str, y_cols: list[str],
                       test_pct: int = 10, val_pct: int = 10, seed: int = 42,
                       stratified: bool = True, digits: int = 3) -> DataFrame:
    """H4: split unique texts into train/val/test; returns (text_hash, stratum, split).

    Inside each stratum, texts are ranked by md5(seed|text): the first
    round(test_pct% of n) go to test; the rest are ranked by
    md5(seed+1|text) and the first round(val_pct% of the rest) go to val.
    """
    # only hashes and labels travel: the text is hashed once and left behind, and a text's hash breaks ties;
    # a hash's 16 bytes have the order of its 32 digits
    h = df.select(hash_bytes(text_hash(F.col(text_col))).alias("text_hash"), hash_bytes(seeded_hash(seed, F.col(text_col))).alias("_h1"),
                  hash_bytes(seeded_hash(seed + 1, F.col(text_col))).alias("_h2"), id_col, *y_cols)
    uniq = h.groupBy("text_hash", "_h1", "_h2").agg(F.min(id_col).alias(id_col), *[F.min_by(y, id_col).alias(y) for y in y_cols])
    uniq = rarest_label_stratum(uniq, y_cols) if stratified else uniq.withColumn("stratum", F.lit("all"))
    u = uniq.select("text_hash", "stratum", "_h1", "_h2")
    r1 = exact_rank(u, ["stratum"], "_h1", "text_hash", digits)
    r1 = r1.withColumn("_test", F.col("rank") <= share_count(F.col("part_n"), test_pct)).drop("rank", "part_n")
    rest = r1.where(~F.col("_test"))
    r2 = exact_rank(rest, ["stratum"], "_h2", "text_hash", digits)
    r2 = r2.withColumn("split", F.when(F.col("rank") <= share_count(F.col("part_n"), val_pct), "val")
                       .otherwise("train")).select("text_hash", "stratum", "split")
    test = r1.where(F.col("_test")).select("text_hash", "stratum", F.lit("test").alias("split"))
    return r2.unionByName(test).withColumn("text_hash", F.lower(F.hex("text_hash")))


def split_propagate(df: DataFrame, text_col: str, assignment: DataFrame) -> DataFrame:
    """Every row takes the split of its text hash (equi-join on the hash)."""
    held = df.withColumn("_hash", hash_bytes(text_hash(F.col(text_col))))  # the join carries bytes, half of the digits
    found = held.join(assignment.select(hash_bytes(F.col("text_hash")).alias("_hash"), "split"), "_hash", "inner")
    return found.select(F.lower(F.hex("_hash")).alias("text_hash"), *[c for c in df.columns if c != "text_hash"], "split")


def leakage_counts(df: DataFrame, text_col: str, split_col: str = "split") -> DataFrame:
    """H3: number of text hashes shared by each pair of splits (one group-by on the hash)."""
    g = (df.select(text_hash(F.col(text_col)).alias("h"), F.col(split_col).alias("s"))
         .groupBy("h").agg(*[F.max((F.col("s") == s).cast("int")).alias(s) for s in ("train", "val", "test")]))
    return g.agg(F.sum(F.col("train") * F.col("val")).cast("long").alias("train_val"),
                 F.sum(F.col("train") * F.col("test")).cast("long").alias("train_test"),
                 F.sum(F.col("val") * F.col("test")).cast("long").alias("val_test"))


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """H6: the n rows with the smallest md5(seed|id) -- an exact seeded sample without replacement; all rows if fewer."""
    from .select import smallest_hash
    h = df.withColumn("_h", F.substring(seeded_hash(seed, F.col(id_col)), 1, 8))
    return smallest_hash(h, "_h", id_col, n).drop("_h")


def hash_split(df: DataFrame, id_col: str, share: float, seed: int, name_in: str, name_out: str) -> DataFrame:
    """H7: ``name_in`` when unit(md5(seed|id)) < share, else ``name_out`` (no shuffle)."""
    return df.withColumn("part", F.when(unit(seeded_hash(seed, F.col(id_col))) < share, name_in)
                         .otherwise(name_out))
