"""Rules applied once to each distinct term, then joined back.

A report's list holds few of the corpus's terms and the same terms recur in
most reports, so each distinct term is classified, labelled and kept or
dropped once; reports take the results by a join on the term, which Spark
broadcasts only when the term table's measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..rules import RuleSet
from ..session import settle


def term_table(terms: DataFrame, families: list[RuleSet] = (), rules: list[RuleSet] = (), term_col: str = "pt") -> DataFrame:
    """(term, cat_<family>..., keep_<rules>, labels_<rules>...) of every distinct term; labels are sorted by name."""
    distinct = terms.select(F.col(term_col).alias("term")).where(F.col("term").isNotNull()).distinct()
    out = [T.first_match_category(F.col("term"), f).alias(f"cat_{f.name}") for f in families]
    for r in rules:
        out.append((F.size(T.keep_drop_terms(F.array("term"), r)[0]) == 1).alias(f"keep_{r.name}"))
        out.append(F.array_compact(F.array(*[F.when(F.col("term").rlike(r.labels[lab]), F.lit(lab)) for lab in r.sorted_labels])).alias(f"labels_{r.name}"))
    return settle(distinct.select("term", *out), "term-rules")


def first_places(terms: DataFrame, id_col: str) -> DataFrame:
    """(id, pos, pt) with the first place of each distinct term of a report (the older rules' list)."""
    return terms.groupBy(id_col, "pt").agg(F.min("pos").alias("pos"))


def keep_chain(terms: DataFrame, table: DataFrame, id_col: str, first: RuleSet, then: RuleSet) -> DataFrame:
    """F5 chain, per report: the terms kept and dropped by ``first``, and of those kept, the ones kept and dropped by ``then``,
    and the labels that ``then`` gives to any term kept by both."""
    rows = first_places(terms, id_col) if first.distinct_terms else terms
    j = rows.join(table, rows.pt == table.term).select(
        id_col, "pos", "pt", F.col(f"keep_{first.name}").alias("k1"), F.col(f"keep_{then.name}").alias("k2"), F.col(f"labels_{then.name}").alias("labels"))
    # a report's list is bounded by the roll-up (50 terms)
    listed = lambda cond: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("pos", "pt")))), lambda s: s["pt"]), T.TERM_SEP)
    both = F.col("k1") & F.col("k2")
    return j.groupBy(id_col).agg(
        listed(F.col("k1")).alias("kept_first"), listed(~F.col("k1")).alias("dropped_first"), listed(both).alias("kept"),
        listed(F.col("k1") & ~F.col("k2")).alias("dropped_then"), F.count_if(both).alias("n_kept"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(both, F.col("labels")))))), T.TERM_SEP).alias("labels"))
