"""Views that bind the operators to the driver tables.

* ``reports_raw``  -- C1: orders (DEMO role) left-joined with the D2
  roll-up of lineitem x part x supplier (REAC/DRUG roles).
* ``reports``      -- v2-style cleaning (F3/F5) and labels (F7/F8) on the
  roll-up, using the part-name rule set.
* ``terms``        -- F4: one row per (report, term).
* ``documents``    -- documents left-joined with labels (B2 coercion).
* ``scores``       -- long (id, label, y, score): a deterministic score
  from md5(id|label) blended with y, so Spark and the SQL oracle see
  the same numbers.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as rules_mod
from ..functions import text as T
from ..operators.rollup import agg_table

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

REPORT_LISTS = {"REAC_pt": "p_name", "DRUG_returnflag": "l_returnflag",
                "DRUG_linestatus": "l_linestatus", "DRUG_supplier": "s_name"}
REPORT_COUNTS = ["REAC_n_rows", "DRUG_n_rows"]

PARTS = rules_mod.get("parts")
DOC_LABELS = ["quality", "toxic"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def child_lines(spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = tuple(REPORT_LISTS)) -> DataFrame:
    """Child rows: one per line item, joined only with the tables whose values the ``lists`` take."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    needed = {REPORT_LISTS[c] for c in lists}
    if "p_name" in needed:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        li = li.join(part, li.l_partkey == part.p_partkey, "left")
    if "s_name" in needed:
        supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        li = li.join(supp, li.l_suppkey == supp.s_suppkey, "left")
    return li


def line_position() -> F.Column:
    """The place of a line item by the first six columns of LINE_ORDER as one decimal, nulls first: 3 digits of line
    number, 10 of part, 8 of supplier, 9 of price in cents, 4 of quantity in hundredths, 2 of discount in hundredths."""
    at = lambda c, unit=1: F.coalesce(F.round(F.col(c) * unit).cast("bigint") + 1, F.lit(0).cast("bigint"))
    high = at("l_linenumber") * 10_000_000_000 + at("l_partkey")
    middle = at("l_suppkey") * 1_000_000_000 + at("l_extendedprice", 100)
    low = at("l_quantity", 100) * 100 + F.least(at("l_discount", 100), F.lit(99))
    whole = (high.cast("decimal(13,0)") * F.lit(Decimal(10 ** 23)) + middle.cast("decimal(17,0)") * F.lit(Decimal(10 ** 6))
             + low.cast("decimal(6,0)"))
    return whole.cast("decimal(38,0)")


def part_position() -> F.Column:
    """The place of a line item by line number and part as one long, nulls first.  Values that a line takes from its part
    alone keep their order: lines with equal number and part have the same values, so the further columns decide nothing."""
    return F.coalesce(F.col("l_linenumber").cast("bigint") + 1, F.lit(0).cast("bigint")) * 10_000_000_000 + F.coalesce(
        F.col("l_partkey").cast("bigint") + 1, F.lit(0).cast("bigint"))


def report_rollup(spark: SparkSession, sf_dir: str, max_items: int = 50, lists: tuple[str, ...] = tuple(REPORT_LISTS),
                  counts: tuple[str, ...] = tuple(REPORT_COUNTS)) -> DataFrame:
    """D2 over the child rows: only the ``lists`` and ``counts`` that are asked for."""
    if not lists:  # row counts alone: one aggregate of the key
        n = F.count(F.lit(1))
        return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("primaryid")).agg(*[n.alias(c) for c in counts])
    if list(lists) == ["REAC_pt"] and not counts:  # key, part and place are all that a line brings to the join
        li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", part_position().alias("place"))
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        return (agg_table(li.join(part, li.l_partkey == part.p_partkey, "left"), "l_orderkey", {"REAC_pt": "p_name"}, [],
                          [], max_items, position=F.col("place")).withColumnRenamed("l_orderkey", "primaryid"))
    return (agg_table(child_lines(spark, sf_dir, lists), "l_orderkey", {c: REPORT_LISTS[c] for c in lists}, LINE_ORDER,
                      list(counts), max_items, position=line_position(), keys=table(spark, sf_dir, "lineitem").select("l_orderkey"))
            .withColumnRenamed("l_orderkey", "primaryid"))


def demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "orders")
            .select(F.col("o_orderkey").alias("primaryid"), F.col("o_custkey").alias("caseid"),
                    "o_orderstatus", "o_orderpriority"))


def reports_raw(spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = tuple(REPORT_LISTS),
                counts: tuple[str, ...] = tuple(REPORT_COUNTS)) -> DataFrame:
    """DEMO left join the per-report roll-up (same key; one exchange per side)."""
    return demo(spark, sf_dir).join(report_rollup(spark, sf_dir, lists=lists, counts=counts), "primaryid", "left")


def once(df: DataFrame, **cols: F.Column) -> DataFrame:
    """``df`` with further columns that are computed once a row: a filter on them is not turned back into their expressions,
    which the optimizer would write out (and run) at each place where the filter names them."""
    values = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.explode(F.array(values)).alias("_once")).select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in cols])


def clean_and_label(df: DataFrame, rules: rules_mod.RuleSet = PARTS,
                    text_col: str = "REAC_pt", suffix: str = "_v2") -> DataFrame:
    """F3 + F5 + F7 + F8 + B5, row by row."""
    terms = T.split_terms(F.col(text_col), distinct=rules.distinct_terms)
    kept, dropped = T.keep_drop_terms(terms, rules)
    sym, n = f"{text_col}_symptom{suffix}", f"REAC_n_rows_symptom{suffix}"
    out = once(once(df, _kept=kept), **{sym: F.array_join("_kept", T.TERM_SEP), n: F.size("_kept").cast("int")}).drop("_kept")
    out = out.select(*df.columns, sym, F.array_join(dropped, T.TERM_SEP).alias(f"{text_col}_dropped{suffix}"), n)
    out = once(out, **dict(zip(rules.y_cols, T.multilabel(F.col(sym), rules))))
    return out.select("*", reduce(add, [F.col(c).cast("int") for c in rules.y_cols]).alias("label_sum"),
                      T.rebuild_y_labels(rules.y_cols).alias("y_labels"))


def reports(spark: SparkSession, sf_dir: str, rules: rules_mod.RuleSet = PARTS) -> DataFrame:
    """Cleaned and labelled reports; of the roll-up only the term list is built."""
    return clean_and_label(reports_raw(spark, sf_dir, ("REAC_pt",), ()), rules)


TEXT = "REAC_pt_symptom_v2"


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(primaryid, pos, pt) from the raw reaction-term list."""
    r = reports_raw(spark, sf_dir, ("REAC_pt",), ())
    return r.select("primaryid", F.posexplode(T.split_terms(F.col("REAC_pt"))).alias("pos", "pt"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents left join labels; missing / non-numeric labels -> 0 (B2)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    out = d.join(lab, "doc_id", "left")
    ys = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).cast("tinyint").alias(f"y_{c}") for c in DOC_LABELS]
    return out.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
                      "lang", "source", "n_chars", *ys)


def unit_hash(*cols) -> F.Column:
    """Uniform [0, 1) from the first 32 bits of md5 of the '|'-joined values."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                 for c in cols]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def scores_from_labels(df: DataFrame, id_col: str, y_cols: list[str], keep: list[str] = ()) -> DataFrame:
    """Unpivot wide y_* to long and attach the deterministic score 0.3*y + 0.7*u."""
    long = df.select(id_col, *keep, F.explode(F.array(*[
        F.struct(F.lit(T.labname(c)).alias("label"), F.col(c).cast("int").alias("y")) for c in y_cols
    ])).alias("ly")).select(id_col, *keep, "ly.label", "ly.y")
    return long.select(id_col, *keep, "label", "y",
                       (F.lit(0.3) * F.col("y") + F.lit(0.7) * unit_hash(id_col, "label")).alias("score"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores over every report with at least one kept term."""
    r = reports(spark, sf_dir).where(F.col("REAC_n_rows_symptom_v2") > 0)
    return scores_from_labels(r, "primaryid", PARTS.y_cols)
