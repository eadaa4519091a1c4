"""Profiling aggregations (D3-D15, D22, D23): one pass, partial aggregation first."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS_RE, strip


def pct(num: Column, den: Column) -> Column:
    return num.cast("double") * F.lit(100.0) / den.cast("double")


def value_counts_pct(df: DataFrame, col: str, decimals: int = 2) -> DataFrame:
    """D3: count and percent of rows per value (percent rounded half-even)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return (counts.crossJoin(F.broadcast(total))  # one-row scalar side
            .select(col, "n", F.bround(pct(F.col("n"), F.col("total")), decimals).alias("pct")))


def presence(df: DataFrame, id_col: str, cat_col: str, decimals: int = 2) -> DataFrame:
    """Per category, distinct ids having it and their share of all distinct ids.

    Distinct (id, category) pairs are formed first (partial aggregation),
    so a category holding most rows does not collect ids in one task.
    """
    pairs = df.select(id_col, cat_col).distinct()
    per_cat = pairs.groupBy(cat_col).agg(F.count(F.lit(1)).alias("n_reports"))
    total = df.select(id_col).distinct().agg(F.count(F.lit(1)).alias("total"))
    return (per_cat.crossJoin(F.broadcast(total))
            .select(cat_col, "n_reports", F.bround(pct(F.col("n_reports"), F.col("total")), decimals)
                    .alias("pct_reports")))


def label_prevalence(df: DataFrame, y_cols: list[str], decimals: int = 3) -> DataFrame:
    """mean*100 per label, from one wide aggregate then unpivoted."""
    from ..functions.text import labname
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(c).cast("long")).alias(c) for c in y_cols])
    long = agg.select("_n", F.explode(F.array(*[
        F.struct(F.lit(labname(c)).alias("label"), F.col(c).alias("n_pos")) for c in y_cols])).alias("s"))
    return long.select("s.label", F.col("s.n_pos").cast("long").alias("n_pos"),
                       F.bround(pct(F.col("s.n_pos"), F.col("_n")), decimals).alias("prevalence_pct"))


def pairwise_counts(df: DataFrame, y_cols: list[str]) -> DataFrame:
    """(a, b, n, n_a, n_b, n_ab) for every label pair a<b, in one aggregate pass."""
    from ..functions.text import labname
    sums = [F.count(F.lit(1)).alias("_n")] + [F.sum(F.col(c).cast("long")).alias(c) for c in y_cols]
    pairs = list(combinations(y_cols, 2))
    sums += [F.sum((F.col(a) * F.col(b)).cast("long")).alias(f"{a}__{b}") for a, b in pairs]
    agg = df.agg(*sums)
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(labname(a)).alias("label_a"), F.lit(labname(b)).alias("label_b"),
                 F.col("_n").alias("n"), F.col(a).alias("n_a"), F.col(b).alias("n_b"),
                 F.col(f"{a}__{b}").alias("n_ab")) for a, b in pairs])).alias("p")).select("p.*")


def cooccurrence_topk(df: DataFrame, y_cols: list[str], k: int = 40) -> DataFrame:
    """Upper triangle of Y'Y, pairs with count > 0, top k (ties by names)."""
    p = pairwise_counts(df, y_cols).where(F.col("n_ab") > 0)
    return (p.orderBy(F.desc("n_ab"), "label_a", "label_b").limit(k)
            .select("label_a", "label_b", F.col("n_ab").alias("count")))


def label_correlation(df: DataFrame, y_cols: list[str]) -> DataFrame:
    """Pearson r (phi) for each label pair from counts; null when a variance is 0."""
    p = pairwise_counts(df, y_cols)
    n, a, b, ab = (F.col(c).cast("double") for c in ("n", "n_a", "n_b", "n_ab"))
    cov = n * ab - a * b
    var = (n * a - a * a) * (n * b - b * b)
    r = F.when(var > 0, cov / F.sqrt(var))
    return p.select("label_a", "label_b", F.round(r, 6).alias("r"))


def missing_like_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, cells that are null or a blank / placeholder token (each cell once)."""
    def miss(c):
        return F.col(c).isNull() | strip(F.col(c).cast("string")).rlike(NULL_TOKENS_RE)
    agg = df.agg(*[F.sum(miss(c).cast("long")).alias(c) for c in cols])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing_like")) for c in cols])).alias("s")
    ).select("s.*")


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, null count and non-null share."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in cols])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col("_n") - F.col(c)).alias("n_null"),
                 F.round(F.col(c).cast("double") / F.col("_n").cast("double"), 6).alias("coverage"))
        for c in cols])).alias("s")).select("s.*")


def top_terms(terms: DataFrame, term_col: str, k: int, lower: bool = False) -> DataFrame:
    """Term frequency, share of all term rows, top k by count then term."""
    t = F.lower(F.col(term_col)) if lower else F.col(term_col)
    counts = terms.select(t.alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    ranked = counts.orderBy(F.desc("n"), "term").limit(k)
    return (ranked.crossJoin(F.broadcast(total))
            .select("term", "n", F.round(pct(F.col("n"), F.col("total")), 6).alias("pct")))


#: Size of a quantile summary; the rank of an answer is off by less than ``SKETCH_ERROR`` of the rows.
SKETCH_K, SKETCH_ERROR = 1600, 0.01


def length_sketches(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """(keys, n, sketch): a mergeable quantile summary of an integer value for each group (a file, a day, a split).

    Sketches are a column like any other: written once, merged later over
    any grouping by ``sketch_quantiles`` without reading the rows again.
    """
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.kll_sketch_agg_bigint(value.cast("bigint"), SKETCH_K).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, keys: list[str], levels: dict[str, float]) -> DataFrame:
    """(keys, n, one column a level) from merged summaries, in whatever order they meet."""
    merged = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"))
    return merged.select(*keys, "n", *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(name) for name, q in levels.items()])
