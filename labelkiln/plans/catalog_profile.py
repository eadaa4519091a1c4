"""Label and column profiling queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import profile as P
from . import oracle as O
from . import views as V
from .catalog import query

R = O.reports_ctes()
Y = V.PARTS.y_cols
LAB = V.PARTS.sorted_labels
PAIRS = list(combinations(LAB, 2))


def _sql_prevalence():
    parts = " UNION ALL ".join(
        f"SELECT {O.lit(l)} AS label, CAST(sum(y_{l}) AS BIGINT) AS n_pos, "
        f"round_even(CAST(sum(y_{l}) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE), 3) AS prevalence_pct "
        f"FROM reports" for l in LAB)
    return O.with_(R) + parts


@query("label_prevalence", _sql_prevalence, "S*")
def label_prevalence(spark, sf):
    """mean*100 per label over all reports (3 decimals, half-even)."""
    return P.label_prevalence(V.reports(spark, sf), Y, 3)


@query("label_cardinality", O.with_(R) + """
SELECT label_sum, count(*) AS n_rows FROM reports GROUP BY label_sum""")
def label_cardinality(spark, sf):
    """Distribution of the number of labels per report."""
    return V.reports(spark, sf).groupBy("label_sum").agg(F.count(F.lit(1)).alias("n_rows"))


def _pair_sql(select_tail: str) -> str:
    sums = ", ".join(f"CAST(sum(y_{l}) AS BIGINT) AS {l}" for l in LAB)
    prods = ", ".join(f"CAST(sum(y_{a} * y_{b}) AS BIGINT) AS {a}__{b}" for a, b in PAIRS)
    unions = " UNION ALL ".join(
        f"SELECT {O.lit(a)} AS label_a, {O.lit(b)} AS label_b, _n AS n, {a} AS n_a, {b} AS n_b, {a}__{b} AS n_ab FROM w"
        for a, b in PAIRS)
    return O.with_(R) + f", w AS (SELECT count(*) AS _n, {sums}, {prods} FROM reports), p AS ({unions})\n" + select_tail


@query("cooccurrence_topk", lambda: _pair_sql(
    "SELECT label_a, label_b, n_ab AS count FROM p WHERE n_ab > 0 ORDER BY n_ab DESC, label_a, label_b LIMIT 40"))
def cooccurrence_topk(spark, sf):
    """Label pairs by co-occurrence count, top 40."""
    return P.cooccurrence_topk(V.reports(spark, sf), Y, 40)


@query("label_correlation", lambda: _pair_sql("""
SELECT label_a, label_b,
  round(CASE WHEN (CAST(n AS DOUBLE) * n_a - CAST(n_a AS DOUBLE) * n_a) * (CAST(n AS DOUBLE) * n_b - CAST(n_b AS DOUBLE) * n_b) > 0
        THEN (CAST(n AS DOUBLE) * n_ab - CAST(n_a AS DOUBLE) * n_b)
             / sqrt((CAST(n AS DOUBLE) * n_a - CAST(n_a AS DOUBLE) * n_a) * (CAST(n AS DOUBLE) * n_b - CAST(n_b AS DOUBLE) * n_b))
        END, 6) AS r FROM p"""), "S*")
def label_correlation(spark, sf):
    """Pearson correlation (phi) of every label pair; null for a constant label."""
    return P.label_correlation(V.reports(spark, sf), Y)


DOC_COLS = ["text", "lang", "source"]


@query("missing_like_count", " UNION ALL ".join(
    f"SELECT {O.lit(c)} AS column, CAST(count_if({c} IS NULL OR regexp_matches({O.strip(c)}, "
    f"{O.lit(T.NULL_TOKENS_RE)})) AS BIGINT) AS n_missing_like FROM documents" for c in DOC_COLS))
def missing_like_count(spark, sf):
    """Per documents column, null or blank/placeholder cells (each counted once)."""
    return P.missing_like_count(V.table(spark, sf, "documents"), DOC_COLS)


RAW_COLS = ["REAC_n_rows", "REAC_pt", "DRUG_returnflag", "DRUG_supplier"]


@query("null_profile", O.with_(R) + " UNION ALL ".join(
    f"SELECT {O.lit(c)} AS column, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
    f"round(CAST(count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS coverage FROM reports_raw"
    for c in RAW_COLS), "S*")
def null_profile(spark, sf):
    """Null count and non-null share per merged-report column (child-table coverage)."""
    return P.null_profile(V.reports_raw(spark, sf), RAW_COLS)


@query("key_uniqueness", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_distinct,
       count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders""")
def key_uniqueness(spark, sf):
    """Is the report id unique."""
    o = V.table(spark, sf, "orders")
    return o.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_distinct")).select(
        "n_rows", "n_distinct", (F.col("n_rows") == F.col("n_distinct")).alias("is_unique"))


NORM_ID_SQL = f"regexp_replace({O.strip('c_name')}, '[^0-9]+', '', 'g')"


@query("normalize_id", f"SELECT c_custkey, {NORM_ID_SQL} AS id_norm FROM customer")
def normalize_id(spark, sf):
    """B1: strip and keep digits only."""
    c = V.table(spark, sf, "customer")
    return c.select("c_custkey", T.normalize_id(F.col("c_name")).alias("id_norm"))


@query("id_length_dist", f"""
SELECT CAST(length({NORM_ID_SQL}) AS INTEGER) AS id_len, count(*) AS n FROM customer
GROUP BY 1 ORDER BY n DESC, id_len LIMIT 10""")
def id_length_dist(spark, sf):
    """Length histogram of normalised ids, top 10."""
    c = V.table(spark, sf, "customer")
    return (c.select(F.length(T.normalize_id(F.col("c_name"))).cast("int").alias("id_len"))
            .groupBy("id_len").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "id_len").limit(10))


@query("to_null_tokens", f"""
SELECT o_orderkey, {O.to_null_token('o_orderstatus')} AS o_orderstatus,
       {O.to_null_token('o_orderpriority')} AS o_orderpriority,
       {O.to_null_token("substr(o_orderpriority, 3)")} AS priority_word FROM orders""")
def to_null_tokens(spark, sf):
    """Strip; '', nan, null, none, n/a, na (any case) -> null on string columns."""
    o = V.table(spark, sf, "orders")
    return o.select("o_orderkey", T.to_null_token(F.col("o_orderstatus")).alias("o_orderstatus"),
                    T.to_null_token(F.col("o_orderpriority")).alias("o_orderpriority"),
                    T.to_null_token(F.substring("o_orderpriority", 3, 1 << 20)).alias("priority_word"))


@query("coerce_binary_labels", """
SELECT d.doc_id,
       CAST(coalesce(TRY_CAST(l.quality AS DOUBLE), 0) AS INTEGER) AS y_quality,
       CAST(coalesce(TRY_CAST(l.toxic AS DOUBLE), 0) AS INTEGER) AS y_toxic,
       (coalesce(TRY_CAST(l.quality AS DOUBLE), 0) NOT IN (0, 1)
        OR coalesce(TRY_CAST(l.toxic AS DOUBLE), 0) NOT IN (0, 1)) AS out_of_domain
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def coerce_binary_labels(spark, sf):
    """B2: missing / non-numeric labels -> 0, with a flag for values outside {0, 1}."""
    d = V.table(spark, sf, "documents").select("doc_id")
    lab = V.table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    q = F.coalesce(F.col("quality").try_cast("double"), F.lit(0.0))
    t = F.coalesce(F.col("toxic").try_cast("double"), F.lit(0.0))
    return j.select("doc_id", q.cast("int").alias("y_quality"), t.cast("int").alias("y_toxic"),
                    (~q.isin(0.0, 1.0) | ~t.isin(0.0, 1.0)).alias("out_of_domain"))


@query("lookup_by_id", O.with_(R) + """
, req AS (SELECT DISTINCT c_custkey * 4 AS primaryid FROM customer)
SELECT req.primaryid, CASE WHEN r.primaryid IS NULL THEN 'NOT_FOUND' ELSE 'FOUND' END AS status,
       r.REAC_pt_symptom_v2 AS text, r.y_labels
FROM req LEFT JOIN reports r ON req.primaryid = r.primaryid""")
def lookup_by_id(spark, sf):
    """Requested ids (derived from customer keys) -> report text and labels, or NOT_FOUND."""
    req = V.table(spark, sf, "customer").select((F.col("c_custkey") * 4).alias("primaryid")).distinct()
    r = V.reports(spark, sf).select("primaryid", F.col("REAC_pt_symptom_v2").alias("text"), "y_labels",
                                    F.lit("FOUND").alias("status"))
    j = req.join(r, "primaryid", "left")
    return j.select("primaryid", F.coalesce("status", F.lit("NOT_FOUND")).alias("status"), "text", "y_labels")
