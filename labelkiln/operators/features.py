"""Term counts, vocabulary, chi-square scores and selection.

Every step is an aggregate or one pass over rows:

* term counts, TF-IDF and the selected features are lists in one row per id
  (``packed``), so no window, group or join runs over single terms;
* the vocabulary is an aggregate by term with partial sums per task;
* chi-square needs one ``groupBy(idx)`` with one sum per label -- no
  explode of labels, no join of labels against features.

``term_counts`` and its like are the long form ``(id, term, tf)``, for a
bounded number of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import labname
from ..session import settle


def word_terms(text: Column, n_min: int = 1, n_max: int = 2,
               token_re: str = T.WORD_TOKEN_DEFAULT) -> Column:
    return T.word_ngrams(T.word_tokens(text, token_re), n_min, n_max)


def char_terms(text: Column, n_min: int = 3, n_max: int = 5) -> Column:
    return T.char_wb_ngrams(text, n_min, n_max)


def term_counts(df: DataFrame, id_col: str, terms: Column, keep: list[str] = ()) -> DataFrame:
    """(id, keep, term, tf): explode and count per (id, term) -- partial aggregation map-side; ``keep`` has one value an id."""
    return (df.select(F.col(id_col), *keep, F.explode(terms).alias("term"))
              .groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf")))


def word_term_counts(df: DataFrame, id_col: str, text_col: str = "text", **kw) -> DataFrame:
    """term_counts of word n-grams; tokens are projected once as their own column."""
    keep = kw.pop("keep", [])
    tok = df.select(id_col, *keep, T.word_tokens(F.col(text_col), kw.pop("token_re", T.WORD_TOKEN_DEFAULT)).alias("_tok"))
    return term_counts(tok, id_col, T.word_ngrams(F.col("_tok"), kw.get("n_min", 1), kw.get("n_max", 2)), keep)


def char_term_counts(df: DataFrame, id_col: str, text_col: str = "text", n_min: int = 3, n_max: int = 5,
                     keep: list[str] = ()) -> DataFrame:
    """(id, term, tf) of char_wb n-grams (same multiset as ``char_wb_ngrams``) built with
    generators -- words, then n, then start offset -- so the whole step stays in
    whole-stage codegen instead of interpreted lambdas."""
    w = (df.select(id_col, *keep, F.explode(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), T.WS + "+")).alias("w"))
         .where(F.col("w") != ""))
    p = w.select(id_col, *keep, F.concat(F.lit(" "), "w", F.lit(" ")).alias("p"))
    g = p.select(id_col, *keep, "p", F.explode(F.sequence(F.lit(n_min), F.greatest(F.least(F.lit(n_max), F.length("p")),
                                                                           F.lit(n_min)))).alias("n"))
    g = g.select(id_col, *keep, "p", "n", F.explode(F.sequence(F.lit(1), F.length("p") - F.col("n") + 1)).alias("i"))
    t = g.select(id_col, *keep, F.expr("substring(p, i, n)").alias("term"))
    return t.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def ordered_index(df: DataFrame, order_col: str, bucket: Column, idx_name: str = "idx", kind: str = "bigint") -> DataFrame:
    """0-based dense index by ``order_col`` with an order-preserving ``bucket`` (``kind`` int only for feature indexes).

    Rows are numbered inside each bucket, so no task sorts the whole table;
    the histogram (a row for each bucket) gives the offsets.
    """
    b = df.withColumn("_b", bucket)
    hist = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_bn"))
    offs = hist.select("_b", F.coalesce(F.sum("_bn").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy("_b").orderBy(order_col))
    out = b.withColumn("_rn", rn).join(offs, "_b")  # Spark broadcasts the offsets if their measured size allows
    return out.withColumn(idx_name, (F.col("_off") + F.col("_rn") - 1).cast(kind)).drop("_b", "_bn", "_off", "_rn")


def fit_vocabulary(tf: DataFrame, n_docs: int, min_df=1, max_df=1.0, max_features: int | None = None) -> DataFrame:
    """G1: (term, idx, df, cf, idf) with sklearn thresholds and smooth idf = ln((1+n)/(1+df)) + 1.

    ``min_df``/``max_df``: int = document count, float = share of n_docs.
    ``max_features`` keeps the most frequent terms by corpus count (ties by
    term); indexes follow term order.
    """
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum(F.col("tf").cast("long")).alias("cf"))
    lo = min_df if isinstance(min_df, int) else float(min_df) * n_docs
    hi = max_df if isinstance(max_df, int) else float(max_df) * n_docs
    kept = settle(stats.where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi))), "terms-kept")  # read for the cut, the ties and the index
    if max_features is not None:
        from .select import largest
        kept = largest(kept, "cf", "term", max_features)
    voc = ordered_index(kept, "term", F.substring("term", 1, 3), kind="int")  # three letters: no bucket holds a large share
    idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return voc.select("term", "idx", "df", "cf", idf.alias("idf"))


def meta_long(df: DataFrame, id_col: str, text_col: str, offset: int) -> DataFrame:
    """F11 as three long rows per id at idx offset, offset+1, offset+2 (zeros kept: dense block)."""
    a, b, c = T.meta_features(F.col(text_col))
    return df.select(id_col, F.explode(F.array(
        F.struct(F.lit(offset).alias("idx"), a.alias("value")),
        F.struct(F.lit(offset + 1).alias("idx"), b.cast("double").alias("value")),
        F.struct(F.lit(offset + 2).alias("idx"), c.cast("double").alias("value")))).alias("m")
    ).select(id_col, "m.idx", "m.value")


def chi2_scores(sums: DataFrame, y: DataFrame, y_cols: list[str]) -> DataFrame:
    """Sklearn chi2 per (label, idx) for binary labels from the features' sums (``packed.feature_sums``); NaN/inf -> 0.

    O1 = sum of x over positives, F = sum of x, p = positive share of rows;
    chi2 = (O1 - pF)^2 / (pF) + ((F - O1) - (1-p)F)^2 / ((1-p)F).
    """
    n = y.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(c).cast("long")).alias(f"_p_{c}") for c in y_cols])
    s = sums.withColumnRenamed("total", "_F").crossJoin(F.broadcast(n))  # one row
    rows = []
    for c in y_cols:
        p = F.col(f"_p_{c}").cast("double") / F.col("_n").cast("double")
        e1, e0 = p * F.col("_F"), (F.lit(1.0) - p) * F.col("_F")
        o1 = F.col(f"o_{c}")
        o0 = F.col("_F") - o1
        chi = F.when((e1 > 0) & (e0 > 0), (o1 - e1) * (o1 - e1) / e1 + (o0 - e0) * (o0 - e0) / e0).otherwise(0.0)
        rows.append(F.struct(F.lit(labname(c)).alias("label"), F.col(f"_p_{c}").alias("n_pos"), chi.alias("chi2")))
    return s.select("idx", F.explode(F.array(*rows)).alias("r")).select("r.label", "idx", "r.n_pos", "r.chi2")


def chi2_topk_union(scores: DataFrame, labels: list[str], n_features: int, topk: int,
                    max_total: int | None = None, keep_meta_last_n: int = 3) -> DataFrame:
    """Union of per-label top-k features (labels without positives skipped), plus the
    last ``keep_meta_last_n`` features.  With ``max_total``, labels are taken in order and
    the union stops at the first label after which it holds more features than that.

    Returns (idx, new_idx) sorted by idx.
    """
    order = {lab: i + 1 for i, lab in enumerate(labels)}
    lab_ord = F.create_map(*[x for lab, i in order.items() for x in (F.lit(lab), F.lit(i))])
    k = min(topk, n_features)
    # scores compare at 9 decimals so float noise cannot reorder equal scores; ties by idx
    w = Window.partitionBy("label").orderBy(F.round("chi2", 9).desc(), "idx")
    top = (scores.where(F.col("n_pos") > 0)
           .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
           .select("idx", lab_ord[F.col("label")].alias("j")))
    spark = scores.sparkSession
    meta = spark.range(max(0, n_features - keep_meta_last_n), n_features).select(
        F.col("id").cast("int").alias("idx"), F.lit(0).alias("j"))
    first = top.unionByName(meta).groupBy("idx").agg(F.min("j").alias("j"))
    if max_total is None:
        return ordered_index(first.select("idx"), "idx", (F.col("idx") / F.lit(4096)).cast("int"), "new_idx", "int")
    # cumulative union size after each label (labels are few: one small window)
    per_j = first.groupBy("j").agg(F.count(F.lit(1)).alias("_c"))
    cum = per_j.select("j", F.sum("_c").over(Window.orderBy("j").rowsBetween(Window.unboundedPreceding, 0))
                       .alias("_u"))
    stop = cum.where((F.col("_u") > max_total) & (F.col("j") > 0)).agg(F.min("j").alias("_stop"))
    sel = first.crossJoin(F.broadcast(stop)).where(F.col("_stop").isNull() | (F.col("j") <= F.col("_stop")))
    sel = sel.select("idx")
    return ordered_index(sel, "idx", (F.col("idx") / F.lit(4096)).cast("int"), "new_idx", "int")
