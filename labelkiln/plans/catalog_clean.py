"""Roll-up, cleaning, term and label queries over Reports / Terms (slice 1 + F/B/D groups)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import profile as P
from ..operators.rollup import ordered_distinct_lists
from . import oracle as O
from . import views as V
from .catalog import query

R = O.reports_ctes()
Y = V.PARTS.y_cols
LAB = V.PARTS.sorted_labels


# ---------------------------------------------------------------- slice 1
def label_report_presence(spark, sf):
    """Per label: reports having it and their % of reports, after dropping noise terms (flagship)."""
    r = V.reports(spark, sf).where(F.col("REAC_n_rows_symptom_v2") > 0)
    return P.label_prevalence(r, Y, decimals=4).select(
        "label", F.col("n_pos").alias("n_reports"), F.col("prevalence_pct").alias("pct_reports"))


def _sql_label_report_presence():
    parts = " UNION ALL ".join(
        f"SELECT {O.lit(l)} AS label, CAST(sum(y_{l}) AS BIGINT) AS n_reports, "
        f"round_even(CAST(sum(y_{l}) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE), 4) AS pct_reports "
        f"FROM reports WHERE REAC_n_rows_symptom_v2 > 0" for l in LAB)
    return O.with_(R) + parts


query("label_report_presence", _sql_label_report_presence)(label_report_presence)


# ---------------------------------------------------------------- joins / rollup
@query("report_left_merge", O.with_(R) + "SELECT * FROM reports_raw")
def report_left_merge(spark, sf):
    """Orders left-joined with the per-report roll-up of line items (one key)."""
    return V.reports_raw(spark, sf)


@query("agg_table", O.with_(R) + "SELECT * FROM rollup")
def agg_table_q(spark, sf):
    """Per order, line count and four ordered distinct lists."""
    return V.report_rollup(spark, sf)


def _sql_supplier_parts():
    order = ", ".join(f"l.{c} NULLS FIRST" for c in ["l_orderkey"] + V.LINE_ORDER)
    return f"""
WITH child AS (
  SELECT l.l_suppkey AS k, {O.strip('p.p_name')} AS v,
         row_number() OVER (PARTITION BY l.l_suppkey ORDER BY {order}) AS pos
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey),
firsts AS (SELECT k, v, min(pos) AS pos FROM child WHERE v IS NOT NULL AND v <> '' GROUP BY k, v),
topv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos, v) AS rn FROM firsts) WHERE rn <= 50)
SELECT k AS l_suppkey, string_agg(v, '; ' ORDER BY pos) AS part_names FROM topv GROUP BY k"""


@query("ordered_distinct_join", _sql_supplier_parts)
def ordered_distinct_join(spark, sf):
    """Per supplier, first 50 distinct part names in line order ('; '-joined)."""
    child = V.table(spark, sf, "lineitem").join(
        V.table(spark, sf, "part").select("p_partkey", "p_name"),
        F.col("l_partkey") == F.col("p_partkey"), "left")
    return ordered_distinct_lists(child, "l_suppkey", {"part_names": "p_name"},
                                  ["l_orderkey"] + V.LINE_ORDER, 50)


@query("id_filter_early", """
WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem
           WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey)
SELECT l_orderkey AS primaryid, n AS n_rows FROM c""")
def id_filter_early(spark, sf):
    """Keep child rows whose id is a (finished) report id before aggregating (left semi)."""
    ids = V.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("l_orderkey"))
    li = V.table(spark, sf, "lineitem").join(ids, "l_orderkey", "left_semi")
    return li.groupBy(F.col("l_orderkey").alias("primaryid")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("semi_valid_ids", """
SELECT l_orderkey AS primaryid, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def semi_valid_ids(spark, sf):
    """The child rows whose id is a (finished) report id."""
    ids = V.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return V.table(spark, sf, "lineitem").join(ids, "l_orderkey", "left_semi").select(
        F.col("l_orderkey").alias("primaryid"), "l_linenumber", "l_partkey", "l_suppkey")


# ---------------------------------------------------------------- term cleaning
@query("split_terms", O.with_(R) + f"""
SELECT primaryid, {O.split_terms('REAC_pt', True)} AS terms_v1, {O.split_terms('REAC_pt')} AS terms_v2
FROM reports_raw""")
def split_terms(spark, sf):
    """term list per report; v1 keeps first occurrences only, v2 keeps repeats."""
    r = V.reports_raw(spark, sf, ("REAC_pt",), ())
    return r.select("primaryid", T.split_terms(F.col("REAC_pt"), True).alias("terms_v1"),
                    T.split_terms(F.col("REAC_pt")).alias("terms_v2"))


@query("keep_drop_terms", O.with_(R) + """
SELECT primaryid, REAC_pt_symptom_v2, REAC_pt_dropped_v2, REAC_n_rows_symptom_v2 FROM reports""")
def keep_drop_terms(spark, sf):
    """kept text, dropped text and kept count per report (exact set OR regex)."""
    return V.reports(spark, sf).select("primaryid", "REAC_pt_symptom_v2", "REAC_pt_dropped_v2",
                                       "REAC_n_rows_symptom_v2")


@query("multilabel_regex", O.with_(R) + f"SELECT primaryid, {', '.join(Y)} FROM reports")
def multilabel_regex(spark, sf):
    """one 0/1 column per label, regex found anywhere in the kept text."""
    return V.reports(spark, sf).select("primaryid", *Y)


@query("rebuild_y_labels", O.with_(R) + "SELECT primaryid, y_labels FROM reports")
def rebuild_y_labels(spark, sf):
    """F8: names of set labels joined '; ', null when none."""
    return V.reports(spark, sf).select("primaryid", "y_labels")


@query("label_sum", O.with_(R) + "SELECT primaryid, label_sum FROM reports")
def label_sum(spark, sf):
    """Row-wise sum of the label columns."""
    return V.reports(spark, sf).select("primaryid", "label_sum")


@query("label_sanity", O.with_(R) + """
SELECT CAST(count_if(label_sum = 0 AND y_labels IS NOT NULL) AS BIGINT) AS zero_sum_with_labels,
       CAST(count_if(label_sum > 0 AND y_labels IS NULL) AS BIGINT) AS pos_sum_without_labels,
       CAST(count(*) AS BIGINT) AS n_rows FROM reports""")
def label_sanity(spark, sf):
    """consistency of y_labels with label_sum."""
    r = V.reports(spark, sf)
    return r.agg(F.count_if((F.col("label_sum") == 0) & F.col("y_labels").isNotNull()).alias("zero_sum_with_labels"),
                 F.count_if((F.col("label_sum") > 0) & F.col("y_labels").isNull()).alias("pos_sum_without_labels"),
                 F.count(F.lit(1)).alias("n_rows"))


@query("drop_empty_text", O.with_(R) + """
SELECT primaryid, REAC_pt_symptom_v2 AS text, label_sum FROM reports
WHERE REAC_pt_symptom_v2 <> '' AND label_sum > 0""")
def drop_empty_text(spark, sf):
    """Keep rows with non-empty text and at least one label."""
    r = V.reports(spark, sf)
    return r.where((F.col("REAC_pt_symptom_v2") != "") & (F.col("label_sum") > 0)).select(
        "primaryid", F.col("REAC_pt_symptom_v2").alias("text"), "label_sum")


@query("normalize_symptom_text", O.with_(R) + f"""
SELECT primaryid, {O.normalize_symptom_text("REAC_pt || ' ; ' || upper(REAC_pt)")} AS symptom_text
FROM reports_raw""")
def normalize_symptom_text(spark, sf):
    """';'-split, whitespace-collapsed, case-insensitively deduplicated term text."""
    r = V.reports_raw(spark, sf, ("REAC_pt",), ())
    src = F.concat(F.col("REAC_pt"), F.lit(" ; "), F.upper(F.col("REAC_pt")))
    return r.select("primaryid", T.normalize_symptom_text(src).alias("symptom_text"))


# ---------------------------------------------------------------- terms
TERMS_SQL = O.with_(R) + f""", tl AS (SELECT primaryid, {O.split_terms('REAC_pt')} AS t FROM reports_raw),
terms AS (SELECT primaryid, unnest(generate_series(0, len(t) - 1)) AS pos, unnest(t) AS pt FROM tl)
"""


@query("explode_terms", TERMS_SQL + "SELECT primaryid, CAST(pos AS INTEGER) AS pos, pt FROM terms")
def explode_terms(spark, sf):
    """one row per (report, position, term)."""
    return V.terms(spark, sf).select("primaryid", F.col("pos").cast("int").alias("pos"), "pt")


@query("first_match_category", TERMS_SQL + f"""
SELECT primaryid, CAST(pos AS INTEGER) AS pos, pt, {O.first_match('pt', V.PARTS)} AS category FROM terms""")
def first_match_category(spark, sf):
    """one category per term by label priority, else 'other'."""
    return V.terms(spark, sf).select("primaryid", F.col("pos").cast("int").alias("pos"), "pt",
                                     T.first_match_category(F.col("pt"), V.PARTS).alias("category"))


NOISE = r"(?i)\b(?:gizmo)\b"


@query("filter_non_symptom_terms", TERMS_SQL + f"""
SELECT primaryid, CAST(pos AS INTEGER) AS pos, pt FROM terms WHERE NOT regexp_matches(pt, {O.lit(NOISE)})""")
def filter_non_symptom_terms(spark, sf):
    """drop exploded term rows matching a noise regex."""
    return V.terms(spark, sf).where(~F.col("pt").rlike(NOISE)).select(
        "primaryid", F.col("pos").cast("int").alias("pos"), "pt")


@query("value_counts_pct", TERMS_SQL + f"""
, c AS (SELECT {O.first_match('pt', V.PARTS)} AS category, count(*) AS n FROM terms GROUP BY 1)
SELECT category, n, round_even(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 2) AS pct FROM c""")
def value_counts_pct(spark, sf):
    """D3: count and percent (2 decimals, half-even) per term category."""
    t = V.terms(spark, sf).select(T.first_match_category(F.col("pt"), V.PARTS).alias("category"))
    return P.value_counts_pct(t, "category", 2)


@query("report_presence", TERMS_SQL + f"""
, c AS (SELECT DISTINCT primaryid, {O.first_match('pt', V.PARTS)} AS category FROM terms),
tot AS (SELECT count(DISTINCT primaryid) AS total FROM terms)
SELECT category, count(*) AS n_reports,
       round_even(CAST(count(*) AS DOUBLE) * 100.0 / CAST(any_value(total) AS DOUBLE), 2) AS pct_reports
FROM c, tot GROUP BY category""")
def report_presence(spark, sf):
    """Per term category, distinct reports having it and % of all reports with terms."""
    t = V.terms(spark, sf).select("primaryid", T.first_match_category(F.col("pt"), V.PARTS).alias("category"))
    return P.presence(t, "primaryid", "category", 2)


@query("top_terms", TERMS_SQL + """
, c AS (SELECT pt AS term, count(*) AS n FROM terms GROUP BY pt)
SELECT term, n, round(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 6) AS pct
FROM c ORDER BY n DESC, term LIMIT 300""")
def top_terms(spark, sf):
    """Term frequency and % of all term rows, top 300."""
    return P.top_terms(V.terms(spark, sf), "pt", 300)


@query("top_other_terms", TERMS_SQL + f"""
, c AS (SELECT pt AS term, count(*) AS n FROM terms WHERE {O.first_match('pt', V.PARTS)} = {O.lit(V.PARTS.fallback)} GROUP BY pt)
SELECT term, n, round(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 6) AS pct
FROM c ORDER BY n DESC, term LIMIT 300""")
def top_other_terms(spark, sf):
    """Frequency of the terms that no label matches, top 300."""
    t = V.terms(spark, sf).where(T.first_match_category(F.col("pt"), V.PARTS) == V.PARTS.fallback)
    return P.top_terms(t, "pt", 300)


@query("top_dropped_terms", O.with_(R) + f""", z AS (SELECT unnest({O.split_terms('REAC_pt_dropped_v2')}) AS term FROM reports),
c AS (SELECT term, count(*) AS n FROM z GROUP BY term)
SELECT term, n, round(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 6) AS pct
FROM c ORDER BY n DESC, term LIMIT 300""")
def top_dropped_terms(spark, sf):
    """Frequency of the terms that the drop rules took out, top 300."""
    t = V.reports(spark, sf).select(F.explode(T.split_terms(F.col("REAC_pt_dropped_v2"))).alias("pt"))
    return P.top_terms(t, "pt", 300)


@query("select_text_column", O.with_(R) + "SELECT primaryid, REAC_pt_symptom_v2 AS text FROM reports")
def select_text_column(spark, sf):
    """The first text column that the table has, by preference."""
    r = V.reports(spark, sf)
    return r.select("primaryid", F.col(T.select_text_column(r.columns)).alias("text"))


@query("zero_label_top_terms", O.with_(R) + f""", z AS (
  SELECT lower(unnest({O.split_terms('REAC_pt')})) AS term FROM reports WHERE label_sum = 0),
c AS (SELECT term, count(*) AS n FROM z GROUP BY term)
SELECT term, n, round(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 6) AS pct
FROM c ORDER BY n DESC, term LIMIT 2000""")
def zero_label_top_terms(spark, sf):
    """Lower-cased term frequency over reports with no label, top 2000."""
    r = V.reports(spark, sf).where(F.col("label_sum") == 0)
    t = r.select(F.explode(T.split_terms(F.col("REAC_pt"))).alias("pt"))
    return P.top_terms(t, "pt", 2000, lower=True)


@query("labname", "SELECT DISTINCT regexp_replace('y_' || l_returnflag, '^y_', '') AS label FROM lineitem")
def labname(spark, sf):
    """strip the first 'y_' prefix only."""
    li = V.table(spark, sf, "lineitem")
    return li.select(T.labname_col(F.concat(F.lit("y_"), F.col("l_returnflag"))).alias("label")).distinct()


@query("split_labels", O.with_(R) + f"""
SELECT primaryid, coalesce(list_filter(list_transform(string_split(y_labels, ';'), lambda t: {O.strip('t')}),
                                       lambda t: t <> ''), []) AS labels FROM reports""")
def split_labels(spark, sf):
    """parse y_labels to a list; null -> empty list."""
    return V.reports(spark, sf).select("primaryid", T.split_labels(F.col("y_labels")).alias("labels"))


# ---------------------------------------------------------------- text normalisation, DELETE handling
@query("normalize_text", O.with_(O.documents_ctes()) + f"""
SELECT doc_id, regexp_replace(regexp_replace(replace({O.strip("lower(text)")}, ';', ' '), '[,\\t\\r\\n]+', ' ', 'g'),
                              '{T.WS}+', ' ', 'g') AS text_norm FROM docs""")
def normalize_text(spark, sf):
    """lower, strip, ';' -> space, runs of [,\\t\\r\\n] -> space, collapse whitespace."""
    return V.documents(spark, sf).select("doc_id", T.normalize_text(F.col("text")).alias("text_norm"))


DELETE_SEGMENT = "AUTOMOBILE"


def delete_ids(spark, sf):
    """DELETE id list: digit-normalised customer names of one segment (leading zeros dropped), distinct, non-blank.

    Ids stay digit strings, so one of any length can match.
    """
    c = V.table(spark, sf, "customer").where(F.col("c_mktsegment") == DELETE_SEGMENT)
    d = T.normalize_id(F.col("c_name"))
    return c.select(F.regexp_replace(d, "^0+(?=[0-9])", "").alias("id")).where(F.col("id") != "").distinct()


DELETE_SQL = f"""
del AS (SELECT DISTINCT CASE WHEN ltrim(d, '0') = '' THEN '0' ELSE ltrim(d, '0') END AS id
        FROM (SELECT regexp_replace({O.strip('c_name')}, '[^0-9]+', '', 'g') AS d FROM customer
              WHERE c_mktsegment = '{DELETE_SEGMENT}') WHERE d <> ''),
dem AS (SELECT CAST(o_orderkey AS VARCHAR) AS primaryid, CAST(o_custkey AS VARCHAR) AS caseid FROM orders),
ov AS (SELECT (SELECT count(DISTINCT primaryid) FROM dem WHERE primaryid IN (SELECT id FROM del)) AS n_overlap_primaryid,
              (SELECT count(DISTINCT caseid) FROM dem WHERE caseid IN (SELECT id FROM del)) AS n_overlap_caseid),
ch AS (SELECT *, CASE WHEN n_overlap_primaryid = 0 AND n_overlap_caseid = 0 THEN 'none'
                      WHEN n_overlap_caseid > n_overlap_primaryid THEN 'caseid' ELSE 'primaryid' END AS key_used FROM ov)"""


def delete_choice(spark, sf):
    """C4: overlap of the DELETE ids with primaryid and with caseid; caseid only when strictly larger."""
    ids = delete_ids(spark, sf)
    dem = V.demo(spark, sf).select(F.col("primaryid").cast("string").alias("primaryid"),
                                   F.col("caseid").cast("string").alias("caseid"))
    n_p = dem.select("primaryid").distinct().join(ids, F.col("primaryid") == F.col("id"), "left_semi").count()
    n_c = dem.select("caseid").distinct().join(ids, F.col("caseid") == F.col("id"), "left_semi").count()
    key = "none" if n_p == 0 and n_c == 0 else ("caseid" if n_c > n_p else "primaryid")
    return n_p, n_c, key


@query("delete_key_choice", "WITH " + DELETE_SQL + "\nSELECT * FROM ch")
def delete_key_choice(spark, sf):
    """C4: which report key the DELETE list refers to (two semi-join counts, then a driver branch)."""
    n_p, n_c, key = delete_choice(spark, sf)
    return spark.createDataFrame([(n_p, n_c, key)], "n_overlap_primaryid long, n_overlap_caseid long, key_used string")


@query("anti_deleted_ids", "WITH " + DELETE_SQL + """
SELECT o.o_orderkey AS primaryid, o.o_custkey AS caseid FROM orders o, ch
WHERE ch.key_used = 'none'
   OR (ch.key_used = 'primaryid' AND CAST(o.o_orderkey AS VARCHAR) NOT IN (SELECT id FROM del))
   OR (ch.key_used = 'caseid' AND CAST(o.o_custkey AS VARCHAR) NOT IN (SELECT id FROM del))""")
def anti_deleted_ids(spark, sf):
    """Reports left after removing those whose chosen key is in the DELETE list (left anti join)."""
    _, _, key = delete_choice(spark, sf)
    dem = V.demo(spark, sf).select("primaryid", "caseid")
    if key == "none":
        return dem
    return dem.join(delete_ids(spark, sf), F.col(key).cast("string") == F.col("id"), "left_anti")
