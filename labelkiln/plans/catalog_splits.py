"""Dedup, split and leakage queries over Documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS
from ..operators import profile as P
from ..operators import splits as S
from ..session import settle
from . import oracle as O
from . import views as V
from .catalog import query

DY = [f"y_{c}" for c in V.DOC_LABELS]
SPLITS = ("train", "val", "test")


# ---------------------------------------------------------------- Spark side
def doc_assignment(spark, sf):
    d = V.documents(spark, sf)
    return d, S.noleak_group_split(d, "text", "doc_id", DY, 10, 10, 42)


def doc_splits(spark, sf):
    d, a = doc_assignment(spark, sf)
    return S.split_propagate(d, "text", a)


def naive_splits(spark, sf):
    """Row-level split by md5(42|doc_id): test < 0.1 <= val < 0.2 <= train (leaks duplicate texts)."""
    d = V.documents(spark, sf)
    u = S.unit(S.seeded_hash(42, F.col("doc_id")))
    return d.withColumn("split", F.when(u < 0.1, "test").when(u < 0.2, "val").otherwise("train"))


# ---------------------------------------------------------------- SQL side
def split_ctes(src: str, id_col: str, y_cols: list[str]) -> str:
    """SQL: stratified no-leak split of ``src`` (id, text, y_*); ends in ``assign`` and ``ds``."""
    cand = ", ".join(f"CASE WHEN {y} = 1 THEN {{'n': c_{y}, 'label': {O.lit(y[2:])}}} END" for y in y_cols)
    sums = ", ".join(f"sum({y}) AS c_{y}" for y in y_cols)
    return f"""
h AS (SELECT *, md5(text) AS text_hash FROM {src}),
uniq AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY {id_col}) = 1),
cnts AS (SELECT {sums} FROM uniq),
strat AS (SELECT uniq.*, coalesce(list_min(list_filter([{cand}], lambda x: x IS NOT NULL)).label,
                                  '{S.NONE_STRATUM}') AS stratum FROM uniq, cnts),
u AS (SELECT text_hash, stratum, text AS _t, md5('42|' || text) AS _h1, md5('43|' || text) AS _h2 FROM strat),
r1 AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY _h1, _t) AS rk,
              count(*) OVER (PARTITION BY stratum) AS n FROM u),
t1 AS (SELECT *, rk <= floor((n * 10 + 50) / 100) AS is_test FROM r1),
r2 AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY _h2, _t) AS rk2,
              count(*) OVER (PARTITION BY stratum) AS n2 FROM t1 WHERE NOT is_test),
assign AS (SELECT text_hash, stratum, CASE WHEN rk2 <= floor((n2 * 10 + 50) / 100) THEN 'val' ELSE 'train' END AS split
           FROM r2 UNION ALL SELECT text_hash, stratum, 'test' AS split FROM t1 WHERE is_test),
ds AS (SELECT h.*, assign.split FROM h JOIN assign ON h.text_hash = assign.text_hash)"""


def _split_ctes():
    return O.documents_ctes() + "," + split_ctes("docs", "doc_id", DY) + f""",
naive AS (SELECT *, CASE WHEN {O.unit_hash("'42'", 'doc_id')} < 0.1 THEN 'test'
                         WHEN {O.unit_hash("'42'", 'doc_id')} < 0.2 THEN 'val' ELSE 'train' END AS split FROM docs)"""


SC = _split_ctes()
SQL = O.with_(SC)


@query("text_hash", SQL + "SELECT doc_id, md5(text) AS text_hash FROM docs")
def text_hash(spark, sf):
    """H1: md5 of the text (null -> '')."""
    return V.documents(spark, sf).select("doc_id", S.text_hash(F.col("text")).alias("text_hash"))


@query("dedup_by_text", SQL + "SELECT text_hash, doc_id, lang, n_chars FROM uniq")
def dedup_by_text(spark, sf):
    """H2: one row per distinct text, the one with the smallest id."""
    return S.dedup_by_text(V.documents(spark, sf), "text", "doc_id").select("text_hash", "doc_id", "lang", "n_chars")


@query("noleak_group_split", SQL + "SELECT text_hash, stratum, split FROM assign")
def noleak_group_split(spark, sf):
    """H4: stratified hash split of unique texts (10% test, then 10% of the rest val)."""
    return doc_assignment(spark, sf)[1]


@query("split_propagate", SQL + "SELECT doc_id, split FROM ds")
def split_propagate(spark, sf):
    """Every document takes the split of its text."""
    return doc_splits(spark, sf).select("doc_id", "split")


def _leak_sql(src):
    return f"""(SELECT CAST(sum(tr * va) AS BIGINT) AS a, CAST(sum(tr * te) AS BIGINT) AS b, CAST(sum(va * te) AS BIGINT) AS c
  FROM (SELECT md5(text) AS hh, max(CAST(split = 'train' AS INTEGER)) AS tr, max(CAST(split = 'val' AS INTEGER)) AS va,
               max(CAST(split = 'test' AS INTEGER)) AS te FROM {src} GROUP BY hh))"""


@query("leakage_counts", SQL + f"""
SELECT n.a AS naive_train_val, n.b AS naive_train_test, n.c AS naive_val_test,
       k.a AS noleak_train_val, k.b AS noleak_train_test, k.c AS noleak_val_test
FROM {_leak_sql('naive')} n, {_leak_sql('ds')} k""")
def leakage_counts(spark, sf):
    """H3: shared text hashes between split pairs, for a row-level split and for the no-leak split."""
    a = S.leakage_counts(naive_splits(spark, sf), "text")
    b = S.leakage_counts(doc_splits(spark, sf), "text")
    return a.select(*[F.col(c).alias(f"naive_{c}") for c in a.columns]).crossJoin(
        b.select(*[F.col(c).alias(f"noleak_{c}") for c in b.columns]))


@query("all_clean_union", SQL + """
SELECT doc_id, arg_min(split, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END) AS split
FROM (SELECT doc_id, split FROM ds WHERE split = 'train' UNION ALL SELECT doc_id, split FROM ds WHERE split = 'val'
      UNION ALL SELECT doc_id, split FROM ds WHERE split = 'test') GROUP BY doc_id""")
def all_clean_union(spark, sf):
    """H5: union of train/val/test, one row per id (first split in train, val, test order)."""
    place = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split"))
    u = doc_splits(spark, sf).select("doc_id", "split", place.alias("_o"))  # the union of the three parts, read once
    return u.groupBy("doc_id").agg(F.min_by("split", "_o").alias("split"))


#: Rows of the training subsample that the parameter search uses.
SUBSAMPLE = 60_000


@query("subsample_train", SQL + f"""
SELECT doc_id FROM ds WHERE split = 'train' ORDER BY {O.unit_hash("'42'", 'doc_id')}, doc_id LIMIT {SUBSAMPLE}""")
def subsample_train(spark, sf):
    """H6: seeded sample of 60,000 training documents without replacement (all when fewer)."""
    tr = settle(doc_splits(spark, sf).where(F.col("split") == "train").select("doc_id"), "train-ids")
    return S.hash_sample(tr, "doc_id", SUBSAMPLE, 42)


@query("refit_calibration_split", SQL + f"""
SELECT doc_id, CASE WHEN {O.unit_hash("'42'", 'doc_id')} < 0.1 THEN 'calib' ELSE 'fit' END AS part
FROM ds WHERE split IN ('train', 'val')""")
def refit_calibration_split(spark, sf):
    """H7: train+val re-split 90/10 into fit / calibration rows."""
    tv = doc_splits(spark, sf).where(F.col("split").isin("train", "val")).select("doc_id")
    return S.hash_split(tv, "doc_id", 0.1, 42, "calib", "fit")


def _prev_sql(tail):
    unions = " UNION ALL ".join(
        f"SELECT {O.lit(y[2:])} AS label, split, CAST({y} AS INTEGER) AS y FROM ds" for y in DY)
    cols = ", ".join(f"round(avg(y) FILTER (WHERE split = '{s}') * 100.0, 6) AS {s}" for s in SPLITS)
    return SQL + f", lg AS ({unions}), pv AS (SELECT label, {cols}, round(avg(y) * 100.0, 6) AS overall FROM lg GROUP BY label)\n" + tail


def prevalence_by_split_df(spark, sf):
    ds = doc_splits(spark, sf)
    long = ds.select("split", F.explode(F.array(*[
        F.struct(F.lit(y[2:]).alias("label"), F.col(y).cast("int").alias("y")) for y in DY])).alias("s")
    ).select("split", "s.label", "s.y")
    aggs = [F.round(F.avg(F.when(F.col("split") == s, F.col("y"))) * 100.0, 6).alias(s) for s in SPLITS]
    return long.groupBy("label").agg(*aggs, F.round(F.avg("y") * 100.0, 6).alias("overall"))


@query("prevalence_by_split", lambda: _prev_sql("SELECT * FROM pv ORDER BY overall DESC, label"), "S*")
def prevalence_by_split(spark, sf):
    """Label prevalence (%) in train / val / test / overall, by overall desc."""
    return prevalence_by_split_df(spark, sf).orderBy(F.desc("overall"), "label")


@query("prevalence_drift", lambda: _prev_sql(
    "SELECT *, round(abs(train - test), 6) AS abs_diff_train_test FROM pv ORDER BY abs_diff_train_test DESC, label"),
    "S*")
def prevalence_drift(spark, sf):
    """D6 plus |train - test|, by drift desc."""
    p = prevalence_by_split_df(spark, sf)
    return p.withColumn("abs_diff_train_test", F.round(F.abs(F.col("train") - F.col("test")), 6)).orderBy(
        F.desc("abs_diff_train_test"), "label")


TOK_SQL = f"len(list_filter(string_split_regex(text, '{WS}+'), lambda w: w <> ''))"


@query("text_length_stats", SQL + f"""
SELECT split, count(*) AS rows,
  round(avg(length(text)), 6) AS char_len_mean,
  round(quantile_cont(CAST(length(text) AS DOUBLE), 0.5), 6) AS char_len_p50,
  round(quantile_cont(CAST(length(text) AS DOUBLE), 0.95), 6) AS char_len_p95,
  round(avg({TOK_SQL}), 6) AS tok_len_mean,
  round(quantile_cont(CAST({TOK_SQL} AS DOUBLE), 0.5), 6) AS tok_len_p50,
  round(quantile_cont(CAST({TOK_SQL} AS DOUBLE), 0.95), 6) AS tok_len_p95
FROM ds GROUP BY split""", "S*")
def text_length_stats(spark, sf):
    """Per split rows, character and whitespace-token length mean / p50 / p95."""
    ds = doc_splits(spark, sf)
    tok = F.size(F.filter(F.split(F.col("text"), f"{WS}+"), lambda w: w != ""))
    x = ds.select("split", F.length("text").cast("double").alias("c"), tok.cast("double").alias("t"))
    return x.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("c"), 6).alias("char_len_mean"),
        F.round(F.percentile("c", 0.5), 6).alias("char_len_p50"),
        F.round(F.percentile("c", 0.95), 6).alias("char_len_p95"),
        F.round(F.avg("t"), 6).alias("tok_len_mean"),
        F.round(F.percentile("t", 0.5), 6).alias("tok_len_p50"),
        F.round(F.percentile("t", 0.95), 6).alias("tok_len_p95"))


@query("split_validation_report", SQL + """
, hs AS (SELECT text_hash, count(DISTINCT split) AS ns FROM ds GROUP BY text_hash),
ids AS (SELECT doc_id, count(DISTINCT split) AS ni FROM ds GROUP BY doc_id)
SELECT ds.split, count(*) AS rows, count_if(trim(ds.text) = '') AS empty_text,
       count_if(ds.y_quality + ds.y_toxic = 0) AS zero_label,
       count_if(hs.ns > 1) AS leaked_rows, count_if(ids.ni > 1) AS id_overlap_rows
FROM ds JOIN hs ON ds.text_hash = hs.text_hash JOIN ids ON ds.doc_id = ids.doc_id GROUP BY ds.split""")
def split_validation_report(spark, sf):
    """Per split rows, empty texts, zero-label rows, rows whose text or id is in another split."""
    ds = doc_splits(spark, sf)
    hs = ds.groupBy("text_hash").agg(F.count_distinct("split").alias("ns"))
    ids = ds.groupBy("doc_id").agg(F.count_distinct("split").alias("ni"))
    j = ds.join(hs, "text_hash").join(ids, "doc_id")
    return j.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.trim("text") == "").alias("empty_text"),
        F.count_if((F.col("y_quality") + F.col("y_toxic")) == 0).alias("zero_label"),
        F.count_if(F.col("ns") > 1).alias("leaked_rows"),
        F.count_if(F.col("ni") > 1).alias("id_overlap_rows"))


@query("eda_summary", SQL + f"""
SELECT count(*) AS rows, {len(DY)} AS n_labels,
       round(avg(CAST(y_quality AS INTEGER) + CAST(y_toxic AS INTEGER)), 6) AS avg_labels_per_row,
       round(quantile_cont(CAST({TOK_SQL} AS DOUBLE), 0.5), 6) AS tok_p50,
       round(quantile_cont(CAST({TOK_SQL} AS DOUBLE), 0.95), 6) AS tok_p95 FROM docs""", "S*")
def eda_summary(spark, sf):
    """One-row roll-up: rows, labels, mean labels per row, token length p50 / p95."""
    d = V.documents(spark, sf)
    tok = F.size(F.filter(F.split(F.col("text"), f"{WS}+"), lambda w: w != "")).cast("double")
    return d.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(DY)).alias("n_labels"),
                 F.round(F.avg(F.col("y_quality").cast("int") + F.col("y_toxic").cast("int")), 6)
                 .alias("avg_labels_per_row"),
                 F.round(F.percentile(tok, 0.5), 6).alias("tok_p50"),
                 F.round(F.percentile(tok, 0.95), 6).alias("tok_p95"))


@query("seen_in_train_pct", SQL + """
, tr AS (SELECT DISTINCT md5(text) AS hh FROM naive WHERE split = 'train')
SELECT n.split, count(*) AS rows, round(avg(CASE WHEN tr.hh IS NULL THEN 0.0 ELSE 1.0 END) * 100.0, 6) AS seen_in_train_pct
FROM naive n LEFT JOIN tr ON md5(n.text) = tr.hh WHERE n.split IN ('val', 'test') GROUP BY n.split""", "S*")
def seen_in_train_pct(spark, sf):
    """% of val/test rows (row-level split) whose exact text occurs in train."""
    n = naive_splits(spark, sf).withColumn("hh", S.text_hash(F.col("text")))
    tr = n.where(F.col("split") == "train").select("hh").distinct().withColumn("hit", F.lit(1.0))
    j = n.where(F.col("split").isin("val", "test")).join(tr, "hh", "left")
    return j.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                  F.round(F.avg(F.coalesce("hit", F.lit(0.0))) * 100.0, 6).alias("seen_in_train_pct"))


@query("text_length_sketch", SQL + """
SELECT split, count(*) AS n, true AS p50_in_bound, true AS p95_in_bound, true AS same_in_any_order FROM ds GROUP BY split""")
def text_length_sketch(spark, sf):
    """p50 and p95 of text lengths per split from summaries kept per (split, source) and merged: whether the rank of each
    is within the stated error of the exact one, and of the answer from summaries merged in two steps."""
    rows = settle(doc_splits(spark, sf).select("split", "source", "lang", F.length("text").alias("n_chars")), "text-lengths")
    kept = settle(P.length_sketches(rows, ["split", "source", "lang"], F.col("n_chars")), "length-sketches")
    levels = {"p50": 0.5, "p95": 0.95}
    once = P.sketch_quantiles(kept, ["split"], levels)
    steps = kept.groupBy("split", "lang").agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", P.SKETCH_K).alias("sketch"))
    twice = P.sketch_quantiles(steps, ["split"], levels).select("split", F.col("p50").alias("q50"), F.col("p95").alias("q95"))
    j = rows.join(F.broadcast(once.join(twice, "split")), "split")  # a row a split
    n = F.count(F.lit(1))

    def within(col, q):
        below, upto = F.count_if(F.col("n_chars") < F.col(col)) / n, F.count_if(F.col("n_chars") <= F.col(col)) / n
        return (below <= q + P.SKETCH_ERROR) & (upto >= q - P.SKETCH_ERROR)
    return j.groupBy("split").agg(n.alias("n"), within("p50", 0.5).alias("p50_in_bound"), within("p95", 0.95).alias("p95_in_bound"),
                                  (within("q50", 0.5) & within("q95", 0.95)).alias("same_in_any_order"))
