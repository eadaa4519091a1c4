"""DuckDB SQL fragments that mirror the views and Column functions.

Used only to state each query a second time, independently of Spark,
for the correctness gate.  Regexes are written so Java regex and RE2
read them the same way (explicit whitespace class, ``(?i)`` flags).
"""

from __future__ import annotations

from ..functions.text import NULL_TOKENS_RE, WS
from ..rules import RuleSet
from .views import DOC_LABELS, LINE_ORDER, PARTS, REPORT_LISTS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{WS}+|{WS}+$')}, '', 'g')"


def split_terms(x: str, distinct: bool = False) -> str:
    arr = f"list_filter(list_transform(string_split(coalesce({x}, ''), ';'), lambda t: {strip('t')}), lambda t: t <> '')"
    if distinct:
        arr = f"list_filter({arr}, lambda t, i: list_position({arr}, t) = i)"
    return arr


def is_dropped(t: str, rules: RuleSet) -> str:
    parts = []
    if rules.drop_exact:
        parts.append(f"{t} IN ({', '.join(lit(s) for s in rules.drop_exact)})")
    if rules.drop_regex:
        parts.append(f"regexp_matches({t}, {lit(rules.drop_regex)})")
    return "(" + " OR ".join(parts or ["false"]) + ")"


def join_list(arr: str) -> str:
    return f"coalesce(array_to_string({arr}, '; '), '')"


def label_cols(x: str, rules: RuleSet) -> str:
    return ", ".join(f"CAST(regexp_matches(coalesce({x}, ''), {lit(rules.labels[lab])}) AS TINYINT) AS y_{lab}"
                     for lab in rules.sorted_labels)


def first_match(x: str, rules: RuleSet) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, {lit(p)}) THEN {lit(lab)}" for lab, p in rules.labels.items())
    return f"CASE {whens} ELSE {lit(rules.fallback)} END"


def y_labels(y_cols: list[str]) -> str:
    items = ", ".join(f"CASE WHEN {c} = 1 THEN {lit(c[2:])} END" for c in y_cols)
    return f"nullif({join_list(f'list_filter([{items}], lambda x: x IS NOT NULL)')}, '')"


def label_sum(y_cols: list[str]) -> str:
    return "CAST(" + " + ".join(f"CAST({c} AS INTEGER)" for c in y_cols) + " AS INTEGER)"


def unit_hash(*exprs: str) -> str:
    joined = " || '|' || ".join(f"CAST({e} AS VARCHAR)" for e in exprs)
    return f"(CAST('0x' || substr(md5({joined}), 1, 8) AS BIGINT) / 4294967296.0)"


def to_null_token(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN regexp_matches({s}, {lit(NULL_TOKENS_RE)}) THEN NULL ELSE {s} END"


def _order_by(cols, alias="l"):
    return ", ".join(f"{alias}.{c} NULLS FIRST" for c in cols)


def _rollup_ctes(max_items: int = 50) -> str:
    src = {"p_name": "p.p_name", "l_returnflag": "l.l_returnflag", "l_linestatus": "l.l_linestatus",
           "s_name": "s.s_name"}
    cols = ", ".join(f"{v} AS {k}" for k, v in src.items())
    unions = " UNION ALL ".join(
        f"SELECT k, pos, {lit(out)} AS c, {strip(f'CAST({col} AS VARCHAR)')} AS v FROM child"
        for out, col in REPORT_LISTS.items())
    lists = ", ".join(f"string_agg(v, '; ' ORDER BY pos) FILTER (WHERE c = {lit(out)}) AS {out}"
                      for out in REPORT_LISTS)
    return f"""
child AS (
  SELECT l.l_orderkey AS k, {cols},
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {_order_by(LINE_ORDER)}) AS pos
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
       LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
lng AS ({unions}),
firsts AS (SELECT k, c, v, min(pos) AS pos FROM lng WHERE v IS NOT NULL AND v <> '' GROUP BY k, c, v),
topv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, c ORDER BY pos, v) AS rn FROM firsts)
         WHERE rn <= {max_items}),
lists AS (SELECT k, {lists} FROM topv GROUP BY k),
cnt AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey),
rollup AS (
  SELECT cnt.k AS primaryid, cnt.n AS REAC_n_rows, cnt.n AS DRUG_n_rows,
         {', '.join(f"coalesce(lists.{o}, '') AS {o}" for o in REPORT_LISTS)}
  FROM cnt LEFT JOIN lists ON cnt.k = lists.k)"""


def reports_ctes(rules: RuleSet = PARTS, max_items: int = 50) -> str:
    """CTE chain ending in ``reports_raw`` and ``reports`` (no leading WITH)."""
    terms = split_terms("REAC_pt", rules.distinct_terms)
    keep = f"list_filter(_terms, lambda t: NOT {is_dropped('t', rules)})"
    drop = f"list_filter(_terms, lambda t: {is_dropped('t', rules)})"
    return _rollup_ctes(max_items) + f""",
reports_raw AS (
  SELECT o.o_orderkey AS primaryid, o.o_custkey AS caseid, o.o_orderstatus, o.o_orderpriority,
         r.* EXCLUDE (primaryid)
  FROM orders o LEFT JOIN rollup r ON o.o_orderkey = r.primaryid),
rep1 AS (SELECT *, {terms} AS _terms FROM reports_raw),
rep2 AS (SELECT * EXCLUDE (_terms), {join_list(keep)} AS REAC_pt_symptom_v2,
                {join_list(drop)} AS REAC_pt_dropped_v2,
                CAST(len({keep}) AS INTEGER) AS REAC_n_rows_symptom_v2 FROM rep1),
rep3 AS (SELECT *, {label_cols('REAC_pt_symptom_v2', rules)} FROM rep2),
reports AS (SELECT *, {label_sum(rules.y_cols)} AS label_sum, {y_labels(rules.y_cols)} AS y_labels FROM rep3)"""


def scores_ctes() -> str:
    """``reports`` chain plus ``scores`` (long id, label, y, score)."""
    unions = " UNION ALL ".join(
        f"SELECT primaryid, {lit(lab)} AS label, CAST(y_{lab} AS INTEGER) AS y FROM reports "
        f"WHERE REAC_n_rows_symptom_v2 > 0" for lab in PARTS.sorted_labels)
    return reports_ctes() + f""",
scores_y AS ({unions}),
scores AS (SELECT primaryid, label, y, 0.3 * y + 0.7 * {unit_hash('primaryid', 'label')} AS score FROM scores_y)"""


def documents_ctes() -> str:
    ys = ", ".join(f"CAST(coalesce(TRY_CAST(lb.{c} AS DOUBLE), 0.0) AS TINYINT) AS y_{c}" for c in DOC_LABELS)
    return f"""
docs AS (
  SELECT d.doc_id, coalesce(d.text, '') AS text, d.lang, d.source, d.n_chars, {ys}
  FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def normalize_symptom_text(x: str) -> str:
    src = strip("coalesce(" + x + ", '')")
    parts = (f"list_filter(list_transform(string_split_regex({src}, {lit(WS + '*;' + WS + '*')}), "
             f"lambda t: regexp_replace({strip('t')}, {lit(WS + '+')}, ' ', 'g')), lambda t: t <> '')")
    low = f"list_transform({parts}, lambda x: lower(x))"
    dedup = f"list_filter({parts}, lambda t, i: list_position({low}, lower(t)) = i)"
    return join_list(dedup)
