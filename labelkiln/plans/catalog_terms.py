"""Adverse-event rules on the driver tables: categories, the keep/drop chain and both label dictionaries.

Part names play terms: every word of a name stands for one reaction term
(``PT``), so a report's list of names gives a list of reaction terms.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import termrules as R
from ..rules import adverse, families
from . import oracle as O
from . import views as V
from .catalog import query

#: Reaction term that each word of a part name stands for.
PT = {"rod": "Nausea", "gizmo": "Product dose omission issue", "plate": "Rash pruritic", "gear": "Off label use", "anvil": "Pneumonia",
      "widget": "Drug ineffective", "bolt": "Back pain", "ring": "Fatigue", "small": "Headache", "cold": "Injection site pain",
      "large": "Renal failure", "blue": "Depression", "new": "Weight decreased", "red": "Anaemia", "old": "Hypertension", "hot": "Feeling hot"}
V1, V2 = adverse.ADVERSE_V1, adverse.ADVERSE_V2


def reactions(spark, sf):
    """(primaryid, pos, pt): the reaction terms of every report, in the order of its words; a word without a term is its own."""
    words = V.terms(spark, sf).select("primaryid", F.col("pos").alias("p"), F.posexplode(F.split("pt", " ")).alias("q", "w"))
    pairs = F.create_map(*[F.lit(x) for kv in PT.items() for x in kv])
    return words.select("primaryid", (F.col("p") * 100 + F.col("q")).alias("pos"), F.coalesce(F.try_element_at(pairs, F.col("w")), F.col("w")).alias("pt"))


def _sql() -> str:
    cases = " ".join(f"WHEN {O.lit(k)} THEN {O.lit(v)}" for k, v in PT.items())
    return O.with_(O.reports_ctes()) + f""",
tl AS (SELECT primaryid, {O.split_terms('REAC_pt')} AS ts FROM reports_raw),
t1 AS (SELECT primaryid, unnest(range(len(ts))) AS p, string_split(unnest(ts), ' ') AS ws FROM tl),
t2 AS (SELECT primaryid, p * 100 + unnest(range(len(ws))) AS pos, unnest(ws) AS w FROM t1),
rx AS (SELECT primaryid, pos, CASE w {cases} ELSE w END AS pt FROM t2)"""


RX = _sql()


def _first_places():
    return "fp AS (SELECT primaryid, pt, min(pos) AS pos FROM rx GROUP BY primaryid, pt)"


def _family(f):
    name = f"category_{f.name}"

    @query(name, RX + f"SELECT primaryid, CAST(pos AS INTEGER) AS pos, pt, {O.first_match('pt', f)} AS category FROM rx")
    def categories(spark, sf):
        rx = reactions(spark, sf)
        table = R.term_table(rx, [f])
        return rx.join(table, rx.pt == table.term).select("primaryid", F.col("pos").cast("int").alias("pos"), "pt", F.col(f"cat_{f.name}").alias("category"))
    categories.__doc__ = f"F6: category of every reaction term in the {f.name} family, each distinct term classified once."

    @query(f"presence_{f.name}", RX + f""",
c AS (SELECT DISTINCT primaryid, {O.first_match('pt', f)} AS category FROM rx), tot AS (SELECT count(DISTINCT primaryid) AS total FROM rx)
SELECT category, count(*) AS n_reports, round_even(CAST(count(*) AS DOUBLE) * 100.0 / CAST(any_value(total) AS DOUBLE), 2) AS pct_reports
FROM c, tot GROUP BY category""")
    def presence(spark, sf):
        return P.presence(categories(spark, sf), "primaryid", "category", 2)
    presence.__doc__ = f"D4: reports with a term of each {f.name} category, and their share."

    @query(f"top_other_terms_{f.name}", RX + f"""
SELECT pt AS term, count(*) AS n FROM rx WHERE {O.first_match('pt', f)} = {O.lit(f.fallback)} GROUP BY pt ORDER BY n DESC, term LIMIT 200""")
    def others(spark, sf):
        rest = categories(spark, sf).where(F.col("category") == f.fallback)
        return rest.groupBy(F.col("pt").alias("term")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(200)
    others.__doc__ = f"D23: the most frequent terms that the {f.name} family leaves in '{f.fallback}'."


for _f in families.FAMILIES:
    _family(_f)


def _listed(cond: str) -> str:
    return f"coalesce(string_agg(pt, '; ' ORDER BY pos) FILTER (WHERE {cond}), '')"


def _labels_of(rules, src: str) -> str:
    """SQL list of the labels of the joined text ``src``, sorted by name."""
    items = ", ".join(f"CASE WHEN regexp_matches({src}, {O.lit(rules.labels[lab])}) THEN {O.lit(lab)} END" for lab in rules.sorted_labels)
    return O.join_list(f"list_filter([{items}], lambda x: x IS NOT NULL)")


CHAIN_SQL = RX + ", " + _first_places() + f""",
kd AS (SELECT primaryid, pos, pt, NOT {O.is_dropped('pt', V1)} AS k1, NOT {O.is_dropped('pt', V2)} AS k2 FROM fp),
ch AS (SELECT primaryid, {_listed('k1')} AS kept_first, {_listed('NOT k1')} AS dropped_first, {_listed('k1 AND k2')} AS kept,
              {_listed('k1 AND NOT k2')} AS dropped_then, count_if(k1 AND k2) AS n_kept FROM kd GROUP BY primaryid)"""


@query("keep_drop_chain", CHAIN_SQL + f"SELECT *, {_labels_of(V2, 'kept')} AS labels FROM ch")
def keep_drop_chain(spark, sf):
    """F5 + F7 + F8: the older drop rules, their kept terms through the current ones, and the current labels of what is left."""
    rx = reactions(spark, sf)
    return R.keep_chain(rx, R.term_table(rx, rules=[V1, V2]), "primaryid", V1, V2)


@query("labels_v1", CHAIN_SQL + f"SELECT primaryid, {_labels_of(V1, 'kept_first')} AS labels FROM ch")
def labels_v1(spark, sf):
    """F7 + F8: labels of the older dictionary on the terms its drop rules keep."""
    rx = reactions(spark, sf)
    return R.keep_chain(rx, R.term_table(rx, rules=[V1]), "primaryid", V1, V1).select("primaryid", "labels")
