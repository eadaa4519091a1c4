"""Source and sink queries.

Every input file here is written by Spark from a driver table into a
fresh folder under ``spark.checkpoint.dir`` (shared storage on a
cluster), then read back with the reference's parsing rules.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import text as T
from ..session import scratch_path
from ..sources import files as FS
from . import oracle as O
from . import views as V
from .catalog import query
from .catalog_scores import predictions, with_base
from .catalog_splits import DY, SC, doc_splits

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
ORDERS_SQL = "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ORDER_COLS) + " FROM orders"


def orders_export(spark, sf, sep: str, encoding: str = "UTF-8", rename=lambda c: c):
    o = V.table(spark, sf, "orders").select(*[F.col(c).cast("string").alias(rename(c)) for c in ORDER_COLS])
    return FS.write_delimited(o, scratch_path(spark, "orders-export"), sep, encoding)


@query("scan_delimited", ORDERS_SQL)
def scan_delimited(spark, sf):
    """A1: '$'-separated export of orders read back as all-string columns (rows with extra fields skipped)."""
    return FS.read_delimited(spark, orders_export(spark, sf, "$"), "$")


@query("scan_lower_header", ORDERS_SQL)
def scan_lower_header(spark, sf):
    """A2: latin-1 export with padded upper-case header names, read with stripped lower-case names."""
    path = orders_export(spark, sf, "$", "ISO-8859-1", rename=lambda c: f" {c.upper()} ")
    df = FS.read_delimited(spark, path, "$", "ISO-8859-1", lower_header=True)
    return df.toDF(*[c.lower() for c in df.columns])


ID_SQL = f"""SELECT id_raw FROM (SELECT regexp_replace({O.strip('c_name')}, '[^0-9]+', '', 'g') AS id_raw FROM customer)
WHERE id_raw <> ''"""


@query("scan_headerless_ids", ID_SQL)
def scan_headerless_ids(spark, sf):
    """A3: headerless id list (digits of customer names) read back as ``id_raw``."""
    ids = V.table(spark, sf, "customer").select(T.normalize_id(F.col("c_name")).alias("id")).where(F.col("id") != "")
    path = FS.write_delimited(ids, scratch_path(spark, "delete-ids"), "$", header=False)
    return FS.read_headerless_ids(spark, path, "$")


@query("sniff_delimiter", "SELECT sep AS written_sep, sep AS sniffed_sep FROM (VALUES " + ", ".join(
    f"({O.lit(s)})" if s != "\t" else "(chr(9))" for s in FS.SEPARATORS) + ") v(sep)")
def sniff_delimiter(spark, sf):
    """A4: the orders export written with each candidate separator; the sniffed separator per folder."""
    rows = []
    for i, sep in enumerate(FS.SEPARATORS):
        path = orders_export(spark, sf, sep)
        rows.append((path, sep))
    sn = FS.sniff_separators(spark, [p for p, _ in rows])
    folder = F.regexp_extract(F.col("file"), r"(orders-export-[0-9a-f]+)", 1)
    written = spark.createDataFrame([(os.path.basename(p), s) for p, s in rows], "folder string, written_sep string")
    return (sn.select(folder.alias("folder"), "sep").distinct().join(written, "folder")
            .select("written_sep", F.col("sep").alias("sniffed_sep")))


#: What a one-line latin-1 field can't hold: characters beyond U+00FF, quotes, backslashes, separators and control characters.
NOT_LATIN1_FIELD = r"[^\x{20}-\x{7E}\x{A0}-\x{FF}]|[\"$\\]"


@query("scan_encoding_fallback", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, nullif(trim(regexp_replace(text, {O.lit(NOT_LATIN1_FIELD)}, '?', 'g'), ' '), '') AS text,
       CASE WHEN (SELECT count_if(regexp_matches(text, '[\\x{{A0}}-\\x{{FF}}]')) FROM documents) > 0
            THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding FROM documents""")
def scan_encoding_fallback(spark, sf):
    """A5: whole document texts exported as latin-1 (what it can't hold as '?'), read with the UTF-8 -> latin-1 fallback."""
    held = F.regexp_replace("text", NOT_LATIN1_FIELD, "?")
    d = V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", F.trim(held).alias("text"))
    path = FS.write_delimited(d, scratch_path(spark, "latin1"), "$", "ISO-8859-1")
    df, enc = FS.read_with_encoding_fallback(spark, path, "$")
    return df.withColumn("encoding", F.lit(enc))


@query("scan_projected", """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey IS NOT NULL""")
def scan_projected(spark, sf):
    """Three columns of the export, id coerced to bigint, rows without a valid id dropped."""
    df = FS.read_delimited(spark, orders_export(spark, sf, "$"), "$", usecols=["o_orderkey", "o_orderstatus",
                                                                              "o_orderpriority"])
    return FS.scan_projected(df, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


#: Columns taken of a table by its prefix; of other tables the first three besides the keys.
PICK = {"DRUG": ["l_returnflag", "l_linestatus"], "REAC": ["pt"]}


@query("scan_table_discovery", """
SELECT * FROM (SELECT 'DRUG' AS prefix, count(*) AS n_rows, 'l_returnflag, l_linestatus' AS columns FROM lineitem
UNION ALL SELECT 'REAC', count(*), 'pt' FROM lineitem
UNION ALL SELECT 'SUPP', count(*), 's_suppkey, s_name, s_nationkey' FROM supplier)""")
def scan_table_discovery(spark, sf):
    """Child tables written as <PREFIX>25Q4.txt; DEMO, DELETE and tables without the key skipped; columns and rows per table."""
    root = scratch_path(spark, "quarter")
    li = V.child_lines(spark, sf)
    tables = {
        "DEMO25Q4.txt": V.demo(spark, sf),
        "DELETE25Q4.txt": V.demo(spark, sf).select("primaryid"),
        "REAC25Q4.txt": li.select(F.col("l_orderkey").alias("primaryid"), F.col("p_name").alias("pt")),
        "DRUG25Q4.txt": li.select(F.col("l_orderkey").alias("primaryid"), "l_returnflag", "l_linestatus", "s_name"),
        "PART25Q4.txt": V.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type"),  # no key
        "SUPP25Q4.txt": V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("primaryid"), "s_suppkey", "s_name",
                                                              "s_nationkey", "s_acctbal"),
    }
    for name, df in tables.items():
        FS.write_delimited(df.select(*[F.col(c).cast("string") for c in df.columns]), os.path.join(root, name), "$")
    out = None
    for prefix, path in FS.discover_tables(spark, root, "25Q4").items():
        df = FS.read_delimited(spark, path, "$", lower_header=True)
        if "primaryid" not in df.columns:
            continue
        others = [c for c in df.columns if c not in ("primaryid", "caseid")]
        keep = [c for c in PICK[prefix] if c in others] if prefix in PICK else others[:3]
        # count through a data column: a scan may not read the corrupt-record column alone
        c0 = F.col("primaryid")
        row = df.agg((F.count(c0) + F.count_if(c0.isNull())).alias("n_rows")).select(
            F.lit(prefix).alias("prefix"), "n_rows", F.lit(", ".join(keep)).alias("columns"))
        out = row if out is None else out.unionByName(row)
    return out


@query("sink_csv", ORDERS_SQL)
def sink_csv(spark, sf):
    """Orders written as '|'-separated text and read back unchanged."""
    return FS.read_delimited(spark, orders_export(spark, sf, "|"), "|")


@query("sink_split_partitioned", O.with_(SC) + f"""
SELECT split, count(*) AS n_rows, {', '.join(f'CAST(sum({y}) AS BIGINT) AS n_{y}' for y in DY)},
       count(DISTINCT text_hash) AS n_texts FROM ds GROUP BY split""")
def sink_split_partitioned(spark, sf):
    """Documents with their no-leak split written as parquet partitioned by split; counts read back."""
    ds = doc_splits(spark, sf).select("doc_id", "text", "text_hash", *DY, "split")
    path = scratch_path(spark, "splits")
    ds.write.mode("overwrite").partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     *[F.sum(y).cast("long").alias(f"n_{y}") for y in DY],
                                     F.count_distinct("text_hash").alias("n_texts"))


@query("sink_run_meta", O.with_(SC) + f"""
SELECT count_if(split = 'train') AS n_train, count_if(split = 'val') AS n_val, count_if(split = 'test') AS n_test,
       {len(DY)} AS n_labels, '{', '.join(DY)}' AS y_cols FROM ds""")
def sink_run_meta(spark, sf):
    """One-row run summary (split sizes, label columns) written as JSON and read back."""
    ds = doc_splits(spark, sf)
    meta = ds.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")]).select(
        "*", F.lit(len(DY)).alias("n_labels"), F.lit(", ".join(DY)).alias("y_cols"))
    path = scratch_path(spark, "run-meta")
    meta.coalesce(1).write.mode("overwrite").json(path)  # one row
    back = spark.read.schema(meta.schema).json(path)
    return back.select(*[F.col(c).cast("long").alias(c) for c in ("n_train", "n_val", "n_test")],
                       F.col("n_labels").cast("int").alias("n_labels"), "y_cols")


@query("sink_predictions", with_base() + """
SELECT primaryid, label, y, round(score, 6) AS score, round(threshold, 6) AS threshold, pred FROM pred""", "S*")
def sink_predictions(spark, sf):
    """Thresholded predictions written as parquet (id, label, y, score, threshold, pred) and read back."""
    path = scratch_path(spark, "predictions")
    predictions(spark, sf).write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.select("primaryid", "label", "y", F.round("score", 6).alias("score"),
                       F.round("threshold", 6).alias("threshold"), "pred")


#: Separator and encoding of the files of each quarter; some quarters lack a column.
QUARTERS = [("25Q1", "$", "UTF-8"), ("25Q2", "|", "ISO-8859-1"), ("25Q3", "$", "ISO-8859-1"), ("25Q4", ",", "UTF-8")]


@query("scan_mixed_quarters", """
SELECT 'REPT' AS prefix, CAST(o_orderkey AS VARCHAR) AS primaryid, o_orderstatus AS status, 'é ' || o_orderpriority AS note,
       CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS caseid,
       CASE o_orderkey % 4 WHEN 0 THEN '$' WHEN 1 THEN '|' WHEN 2 THEN '$' ELSE ',' END AS sep,
       CASE WHEN o_orderkey % 4 IN (1, 2) THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding FROM orders
UNION ALL SELECT 'SUPP', CAST(s_suppkey AS VARCHAR), NULL, s_name || ' ü', NULL, '^', 'ISO-8859-1' FROM supplier""")
def scan_mixed_quarters(spark, sf):
    """Quarters of a table in files of different separators, encodings and columns, each file read by its own layout."""
    root = scratch_path(spark, "quarters")
    o = V.table(spark, sf, "orders")
    for k, (quarter, sep, encoding) in enumerate(QUARTERS):
        df = o.where(F.col("o_orderkey") % 4 == k).select(
            F.col("o_orderkey").cast("string").alias(" PrimaryId"), F.col("o_orderstatus").alias("STATUS "),
            F.concat(F.lit("é "), "o_orderpriority").alias("note"), F.col("o_custkey").cast("string").alias("CaseId"))
        FS.write_delimited(df.drop("CaseId") if quarter == "25Q4" else df, os.path.join(root, f"REPT{quarter}.txt"), sep, encoding)
    s = V.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("primaryid"), F.concat("s_name", F.lit(" ü")).alias("note"))
    FS.write_delimited(s, os.path.join(root, "SUPP25Q4.txt"), "^", "ISO-8859-1")
    FS.write_delimited(s, os.path.join(root, "DELETE25Q4.txt"), "^")
    out = None
    for prefix, paths in sorted(FS.discover_table_files(spark, root).items()):
        df = FS.read_mixed(spark, paths)
        df = df.select(F.lit(prefix).alias("prefix"), *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                                                        for c in ("primaryid", "status", "note", "caseid", "sep", "encoding")])
        out = df if out is None else out.unionByName(df)
    return out
