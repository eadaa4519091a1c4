"""Linear models whose weights are tables: complement naive Bayes in closed form, scores, ranks and SHAP.

Weights are long ``(idx, label, w)``.  Every step is an aggregate or a join
on the feature index; nothing is collected, and all labels are handled by
the same pass over the entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import labname
from ..session import settle


def complement_nb(sums: DataFrame, y: DataFrame, y_cols: list[str], n_features: int, alpha: float = 0.5) -> DataFrame:
    """M4: (idx, label, w) of one-vs-rest complement naive Bayes from the features' sums (``packed.feature_sums``).

    A class is scored by the terms of its complement, so the log odds of a
    row are the sum over its features of value * w with
    w = ln((o + alpha) / (sum o + n alpha)) - ln((t - o + alpha) / (sum (t - o) + n alpha)),
    o and t being the feature's sums over the positives and over all rows.
    A label with one class has no weights.  There is no intercept.
    """
    spark = sums.sparkSession
    sums = settle(sums, "class-sums")  # their totals and the weights read them; the features are computed once
    counts = y.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(c).cast("long")).alias(f"p_{c}") for c in y_cols])
    whole = sums.agg(F.sum("total").alias("all"), *[F.sum(f"o_{c}").alias(f"s_{c}") for c in y_cols])
    every = spark.range(n_features).select(F.col("id").cast("int").alias("idx")).join(sums, "idx", "left").na.fill(0.0)
    j = every.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(counts))  # one row each
    smooth = F.lit(alpha * n_features)
    rows = []
    for c in y_cols:
        o, s = F.col(f"o_{c}"), F.col(f"s_{c}")
        inside = (o + F.lit(alpha)) / (s + smooth)
        outside = (F.col("total") - o + F.lit(alpha)) / (F.col("all") - s + smooth)
        both = (F.col(f"p_{c}") > 0) & (F.col(f"p_{c}") < F.col("rows"))
        rows.append(F.when(both, F.struct(F.lit(labname(c)).alias("label"), (F.log(inside) - F.log(outside)).alias("w"))))
    return j.select("idx", F.explode(F.array_compact(F.array(*rows))).alias("r")).select("idx", "r.label", "r.w")


def log_odds(x: DataFrame, rows: DataFrame, id_col: str, weights: DataFrame, labels: list[str]) -> DataFrame:
    """(id, label, s): the weighted sums of every row in ``rows`` (0 where it has no entry); labels without weights are null."""
    wide = weights.groupBy("idx").agg(*[F.max(F.when(F.col("label") == lab, F.col("w"))).alias(f"w_{lab}") for lab in labels])
    sums = x.join(wide, "idx").groupBy(id_col).agg(*[F.sum(F.col("value") * F.col(f"w_{lab}")).alias(f"s_{lab}") for lab in labels])
    known = weights.groupBy().agg(F.collect_set("label").alias("_known"))  # at most one entry a label
    j = rows.select(id_col).join(sums, id_col, "left").crossJoin(F.broadcast(known))
    out = [F.struct(F.lit(lab).alias("label"), F.when(F.array_contains("_known", lab), F.coalesce(f"s_{lab}", F.lit(0.0))).alias("s")) for lab in labels]
    return j.select(id_col, F.explode(F.array(*out)).alias("r")).select(id_col, "r.label", "r.s")


def ranked_weights(weights: DataFrame, k: int) -> DataFrame:
    """(label, direction, rank, idx, w): the k largest and the k smallest weights of each label, compared at 9 decimals, ties by index."""
    w = weights.withColumn("w", F.round("w", 9))
    out = None
    for name, order in (("top", F.desc("w")), ("bottom", F.asc("w"))):
        r = (w.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(order, "idx")))
             .where(F.col("rank") <= k).select("label", F.lit(name).alias("direction"), "rank", "idx", "w"))
        out = r if out is None else out.unionByName(r)
    return out


def deviations(x: DataFrame, id_col: str, background: DataFrame, explain: DataFrame, n_features: int) -> DataFrame:
    """(idx, mu, d_abs, d, d_pos, d_neg): background mean of each feature, and means over the explained rows of
    |x - mu|, x - mu, max(x - mu, 0) and min(x - mu, 0).

    The linear SHAP value is w * (x - mu), so these serve every label.  Rows
    without the feature add -mu each; only entries are read.
    """
    spark = x.sparkSession
    n = background.agg(F.count(F.lit(1)).cast("double").alias("n_b")).crossJoin(explain.agg(F.count(F.lit(1)).cast("double").alias("n_e")))
    mu = x.join(background, id_col, "left_semi").groupBy("idx").agg(F.sum("value").alias("s_b"))
    every = spark.range(n_features).select(F.col("id").cast("int").alias("idx"))
    mu = every.join(mu, "idx", "left").crossJoin(F.broadcast(n)).select("idx", "n_e", (F.coalesce("s_b", F.lit(0.0)) / F.col("n_b")).alias("mu"))
    d = x.join(explain, id_col, "left_semi").join(mu, "idx").select("idx", (F.col("value") - F.col("mu")).alias("d"))
    own = d.groupBy("idx").agg(F.count(F.lit(1)).alias("k"), F.sum(F.abs("d")).alias("a"), F.sum("d").alias("s"),
                               F.sum(F.greatest("d", F.lit(0.0))).alias("p"), F.sum(F.least("d", F.lit(0.0))).alias("m"))
    j = mu.join(own, "idx", "left").na.fill(0)
    rest, z = F.col("n_e") - F.col("k"), -F.col("mu")
    return j.select("idx", "mu", ((F.col("a") + rest * F.abs(z)) / F.col("n_e")).alias("d_abs"), ((F.col("s") + rest * z) / F.col("n_e")).alias("d"),
                    ((F.col("p") + rest * F.greatest(z, F.lit(0.0))) / F.col("n_e")).alias("d_pos"),
                    ((F.col("m") + rest * F.least(z, F.lit(0.0))) / F.col("n_e")).alias("d_neg"))


def shap_summary(weights: DataFrame, dev: DataFrame) -> DataFrame:
    """(label, idx, mean_abs_phi, mean_phi, mean_pos_phi, mean_neg_phi) of all labels from the deviations."""
    w, up = F.col("w"), F.col("w") >= 0
    return weights.join(dev, "idx").select(
        "label", "idx", (F.abs(w) * F.col("d_abs")).alias("mean_abs_phi"), (w * F.col("d")).alias("mean_phi"),
        (w * F.when(up, F.col("d_pos")).otherwise(F.col("d_neg"))).alias("mean_pos_phi"),
        (w * F.when(up, F.col("d_neg")).otherwise(F.col("d_pos"))).alias("mean_neg_phi"))


def shap_of_rows(x: DataFrame, id_col: str, rows: DataFrame, weights: DataFrame, dev: DataFrame, labels: list[str], k: int) -> DataFrame:
    """M12 local: (id, label, rank, idx, phi): the k largest |phi| of every row and label, compared at 9 decimals, ties by index.

    phi of a feature the row has not is -w * mu, the same for all rows, so
    these are ranked once; a row with m entries needs the first k + m of them.
    """
    w = weights.join(dev.select("idx", "mu"), "idx").select("label", "idx", "w", "mu")
    entries = x.join(rows.select(id_col), id_col, "left_semi").select(id_col, F.col("idx").cast("int").alias("idx"), "value")
    own = entries.join(w, "idx").select(id_col, "label", "idx", (F.col("w") * (F.col("value") - F.col("mu"))).alias("phi"))
    size = rows.select(id_col).join(entries.groupBy(id_col).agg(F.count(F.lit(1)).alias("m")), id_col, "left").na.fill(0)
    absent = w.select("label", "idx", (-F.col("w") * F.col("mu")).alias("phi"))
    by_size = Window.partitionBy("label").orderBy(F.round(F.abs("phi"), 9).desc(), "idx")
    widest = size.agg(F.max("m").alias("widest"))
    lists = (absent.withColumn("place", F.row_number().over(by_size)).crossJoin(F.broadcast(widest)).where(F.col("place") <= F.col("widest") + k)
             .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("place", "idx", "phi"))).alias("list")))  # widest + k entries a label
    asked = size.withColumn("label", F.explode(F.array(*map(F.lit, labels))))
    lent = asked.join(lists, "label").select(id_col, "label", F.explode(F.expr(f"slice(list, 1, int(m) + {k})")).alias("e"))
    lent = lent.select(id_col, "label", "e.idx", "e.phi").join(entries.select(id_col, "idx"), [id_col, "idx"], "left_anti").select(id_col, "label", "idx", "phi")
    order = Window.partitionBy(id_col, "label").orderBy(F.round(F.abs("phi"), 9).desc(), "idx")
    return (own.unionByName(lent).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(id_col, "label", "rank", "idx", "phi"))
