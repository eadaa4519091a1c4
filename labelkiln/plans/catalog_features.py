"""Feature queries: n-grams, TF-IDF fit/transform, union, chi-square, selection."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import WS
from ..operators import features as G
from ..operators import packed as P
from ..operators import splits as S
from ..session import settle
from . import oracle as O
from . import views as V
from .catalog import query
from .catalog_splits import DY, doc_splits, split_ctes

Y = V.PARTS.y_cols
LAB = V.PARTS.sorted_labels
WTOK = T.WORD_TOKEN_DEFAULT


# ---------------------------------------------------------------- SQL builders
def sql_word_tokens(text: str, token_re: str = WTOK) -> str:
    return f"regexp_extract_all(lower(coalesce({text}, '')), {O.lit(token_re)})"


def sql_word_list(toks: str) -> str:
    """1-2 grams from a token-list column ``toks`` (tokenised once, in a CTE)."""
    return (f"list_concat({toks}, list_transform(generate_series(1, len({toks}) - 1), "
            f"lambda i: {toks}[i] || ' ' || {toks}[i + 1]))")


def sql_word_grams_cte(name: str, src: str, id_col: str, extra: str = "", token_re: str = WTOK) -> str:
    return f"""
{name}_t AS (SELECT {id_col}{extra}, {sql_word_tokens('text', token_re)} AS toks FROM {src}),
{name} AS (SELECT {id_col}{extra}, unnest({sql_word_list('toks')}) AS term FROM {name}_t)"""


def sql_char_grams_cte(name: str, src: str, id_col: str, extra: str = "") -> str:
    return f"""
{name}_w AS (SELECT {id_col}{extra}, ' ' || unnest(list_filter(string_split_regex(lower(coalesce(text, '')), {O.lit(WS + '+')}),
                                                   lambda w: w <> '')) || ' ' AS p FROM {src}),
{name} AS (SELECT {id_col}{extra}, unnest(flatten(list_transform(generate_series(3, least(5, length(p))),
                 lambda n: list_transform(generate_series(1, length(p) - n + 1), lambda i: substring(p, i, n))))) AS term
           FROM {name}_w)"""


def sql_tfidf_ctes(p: str, grams: str, id_col: str, fit_where: str, min_df, max_df, max_features=None,
                   offset: str = "0") -> str:
    """CTEs {p}tf, {p}voc, {p}x from a (id, split, term) CTE ``grams``."""
    lo = str(min_df) if isinstance(min_df, int) else f"CAST({min_df} AS DOUBLE) * n"
    hi = str(max_df) if isinstance(max_df, int) else f"CAST({max_df} AS DOUBLE) * n"
    cap = f"ORDER BY cf DESC, term LIMIT {max_features}" if max_features else ""
    return f"""
{p}tf AS (SELECT {id_col}, split, term, count(*) AS tf FROM {grams} GROUP BY ALL),
{p}n AS (SELECT count(*) AS n FROM ds WHERE {fit_where}),
{p}st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM {p}tf WHERE {fit_where} GROUP BY term),
{p}kept AS (SELECT * FROM {p}st, {p}n WHERE df >= {lo} AND df <= {hi} {cap}),
{p}voc AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf,
                  ln((1 + n) / (1 + df)) + 1 AS idf FROM {p}kept),
{p}w AS (SELECT t.{id_col}, v.idx + {offset} AS idx, (1 + ln(t.tf)) * v.idf AS w FROM {p}tf t JOIN {p}voc v ON t.term = v.term),
{p}x AS (SELECT {id_col}, idx, w / sqrt(sum(w * w) OVER (PARTITION BY {id_col})) AS value FROM {p}w)"""


def sql_meta(text: str) -> tuple[str, str, str]:
    s = O.strip(text)
    terms = (f"list_filter(list_transform(string_split_regex({s}, {O.lit(WS + '*;' + WS + '*')}), "
             f"lambda t: lower({O.strip('t')})), lambda t: t <> '')")
    return f"ln(1 + length({s}))", f"len({terms})", f"len(list_distinct({terms}))"


# ---------------------------------------------------------------- Reports feature space
def report_frame(spark, sf):
    """Clean reports (text non-empty, >= 1 label) with their no-leak split."""
    r = (V.reports(spark, sf).where((F.col("REAC_n_rows_symptom_v2") > 0) & (F.col("label_sum") > 0))
         .select("primaryid", F.col("REAC_pt_symptom_v2").alias("text"), *Y))
    r = settle(r, "clean-reports")  # the split and its join read it; the roll-up runs once
    a = S.noleak_group_split(r, "text", "primaryid", Y, 10, 10, 42)
    return S.split_propagate(r, "text", a)


def report_space(spark, sf) -> dict:
    """Word + char TF-IDF fitted on train plus 3 meta features, one row an id.

    Keys: ds (frame with split), counts (terms and counts per id), rows (its
    features), nw, nc, wvoc, cvoc.  ``rows`` is computed from the written
    counts where it is read; its floating-point lists are never written.
    """
    ds = settle(report_frame(spark, sf).select("primaryid", "split", "text", *Y), "reports-split")
    n_train = ds.where(F.col("split") == "train").count()
    counts = settle(P.count_terms(ds, "primaryid", {"word": P.word_lists(), "char": P.char_lists()}, ["split"], Y, meta=True), "report-counts")
    train = counts.where(F.col("split") == "train")
    wvoc = settle(G.fit_vocabulary(P.term_table(train, "word"), n_train, 2, 0.95), "word-vocabulary")
    cvoc = settle(G.fit_vocabulary(P.term_table(train, "char"), n_train, 3, 0.98), "char-vocabulary")
    sp = dict(ds=ds, counts=counts, nw=wvoc.count(), nc=cvoc.count(), wvoc=wvoc, cvoc=cvoc)
    return sp | {"rows": space_rows(sp, counts)}


def space_rows(sp: dict, counts, **then):
    """The features of the rows of ``counts``, all or some of a space's; ``then`` is what is done in the same pass (``packed.features``)."""
    return P.features(counts, "primaryid", {"word": sp["wvoc"], "char": sp["cvoc"]}, {"word": 0, "char": sp["nw"]}, sp["nw"] + sp["nc"], **then)


def _report_sql():
    src = ("rclean AS (SELECT primaryid, REAC_pt_symptom_v2 AS text, " + ", ".join(Y) +
           " FROM reports WHERE REAC_n_rows_symptom_v2 > 0 AND label_sum > 0)")
    m1, m2, m3 = sql_meta("text")
    return O.with_(O.reports_ctes(), src, split_ctes("rclean", "primaryid", Y),
                   sql_word_grams_cte("wg", "ds", "primaryid", ", split"),
                   sql_char_grams_cte("cg", "ds", "primaryid", ", split"),
                   sql_tfidf_ctes("w_", "wg", "primaryid", "split = 'train'", 2, 0.95),
                   "\nnw AS (SELECT count(*) AS nw FROM w_voc)",
                   sql_tfidf_ctes("c_", "cg", "primaryid", "split = 'train'", 3, 0.98, offset="(SELECT nw FROM nw)"),
                   "\nnc AS (SELECT count(*) AS nc FROM c_voc)",
                   f"""
mx AS (SELECT primaryid, unnest([0, 1, 2]) + (SELECT nw FROM nw) + (SELECT nc FROM nc) AS idx,
              unnest([{m1}, CAST({m2} AS DOUBLE), CAST({m3} AS DOUBLE)]) AS value FROM ds),
x AS (SELECT * FROM w_x UNION ALL SELECT * FROM c_x UNION ALL SELECT * FROM mx),
nf AS (SELECT (SELECT nw FROM nw) + (SELECT nc FROM nc) + 3 AS nf)""")


RSQL = _report_sql()


def _summary(rows, id_col="primaryid"):
    """Of each row that has a feature: nnz, sum, sum of squares, sum idx*value."""
    total = lambda f, arrays=("value",): F.aggregate(f(*map(F.col, arrays)), F.lit(0.0), lambda a, v: a + v)
    return rows.where(F.size("idx") > 0).select(
        id_col, F.size("idx").cast("long").alias("nnz"), F.round(total(lambda v: v), 6).alias("sum_value"),
        F.round(total(lambda v: F.transform(v, lambda t: t * t)), 6).alias("sum_sq"),
        F.round(total(lambda i, v: F.zip_with(i, v, lambda p, q: p * q), ("idx", "value")), 4).alias("sum_idx_value"))


SUMMARY_SQL = """SELECT primaryid, count(*) AS nnz, round(sum(value), 6) AS sum_value,
  round(sum(value * value), 6) AS sum_sq, round(sum(idx * value), 4) AS sum_idx_value FROM {x} GROUP BY primaryid"""


@query("meta_features", O.with_(O.reports_ctes()) + "SELECT primaryid, " + ", ".join(
    f"{'round(' + e + ', 6)' if i == 0 else 'CAST(' + e + ' AS INTEGER)'} AS {n}"
    for i, (e, n) in enumerate(zip(sql_meta("REAC_pt_symptom_v2"), ["log1p_len", "n_terms", "n_uniq_terms"])))
    + " FROM reports", "S*")
def meta_features(spark, sf):
    """log1p(text length), number of terms, number of distinct lower-cased terms."""
    a, b, c = T.meta_features(F.col("REAC_pt_symptom_v2"))
    return V.reports(spark, sf).select("primaryid", F.round(a, 6).alias("log1p_len"), b, c)


@query("feature_union", RSQL + SUMMARY_SQL.format(x="x"), "S*")
def feature_union(spark, sf):
    """Word TF-IDF + char_wb TF-IDF + meta, per report: nnz, sum, sum of squares, sum idx*value."""
    return _summary(report_space(spark, sf)["rows"])


CHI_SQL = RSQL + f""",
yt AS (SELECT primaryid, {', '.join(Y)} FROM ds WHERE split = 'train'),
np AS (SELECT count(*) AS _n, {', '.join(f'sum({y}) AS p_{y}' for y in Y)} FROM yt),
sums AS (SELECT idx, sum(value) AS _F, {', '.join(f'sum(value * {y}) AS o_{y}' for y in Y)}
         FROM x JOIN yt ON x.primaryid = yt.primaryid GROUP BY idx),
chi AS ({' UNION ALL '.join(f"""SELECT {O.lit(y[2:])} AS label, idx, n_pos, CASE WHEN e1 > 0 AND e0 > 0 THEN
     (o1 - e1) ^ 2 / e1 + ((_F - o1) - e0) ^ 2 / e0 ELSE 0 END AS chi2
   FROM (SELECT idx, _F, p_{y} AS n_pos, o_{y} AS o1, (CAST(p_{y} AS DOUBLE) / _n) * _F AS e1,
                (1 - CAST(p_{y} AS DOUBLE) / _n) * _F AS e0 FROM sums, np)""" for y in Y)})
"""


def report_chi2(spark, sf):
    """(space, number of features, chi2 per label and feature on train rows)."""
    sp = report_space(spark, sf)
    return sp, sp["nw"] + sp["nc"] + 3, train_chi2(sp)


def train_chi2(sp: dict):
    train = F.col("split") == "train"
    return G.chi2_scores(space_rows(sp, sp["counts"].where(train), sums=Y), sp["ds"].where(train), Y)


@query("chi2_scores", CHI_SQL + "SELECT label, idx, CAST(n_pos AS BIGINT) AS n_pos, round(chi2, 6) AS chi2 FROM chi",
       "S*")
def chi2_scores(spark, sf):
    """Sklearn-style chi-square of every feature against every label on train rows."""
    _, _, chi = report_chi2(spark, sf)
    return chi.select("label", "idx", "n_pos", F.round("chi2", 6).alias("chi2"))


#: Features per label, and the parameter of G5 that ends the union (the model path has no such end).
TOPK, CAP = 3000, 250_000


def _sel_sql():
    cases = " ".join(f"WHEN {O.lit(l)} THEN {i + 1}" for i, l in enumerate(LAB))
    return CHI_SQL + f""",
top AS (SELECT idx, j FROM (SELECT idx, CASE label {cases} END AS j,
          row_number() OVER (PARTITION BY label ORDER BY round(chi2, 9) DESC, idx) AS r FROM chi WHERE n_pos > 0)
        WHERE r <= least({TOPK}, (SELECT nf FROM nf))),
meta AS (SELECT CAST(unnest(generate_series(nf - 3, nf - 1)) AS INTEGER) AS idx, 0 AS j FROM nf),
firstj AS (SELECT idx, min(j) AS j FROM (SELECT * FROM top UNION ALL SELECT * FROM meta) GROUP BY idx),
cum AS (SELECT j, sum(c) OVER (ORDER BY j) AS u FROM (SELECT j, count(*) AS c FROM firstj GROUP BY j)),
stopj AS (SELECT min(j) AS s FROM cum WHERE u > {CAP} AND j > 0),
sel AS (SELECT idx, CAST(row_number() OVER (ORDER BY idx) - 1 AS INTEGER) AS new_idx FROM firstj, stopj
        WHERE s IS NULL OR j <= s)
"""


SEL_SQL = _sel_sql()


def report_selection(spark, sf):
    sp, nf, chi = report_chi2(spark, sf)
    return sp, settle(G.chi2_topk_union(chi, LAB, nf, TOPK, CAP, 3), "selection")


@query("chi2_topk_union", SEL_SQL + "SELECT CAST(idx AS INTEGER) AS idx, new_idx FROM sel", "S*")
def chi2_topk_union(spark, sf):
    """Per-label top-3000 chi-square features, union in label order until > 250,000, plus 3 meta."""
    _, sel = report_selection(spark, sf)
    return sel.select(F.col("idx").cast("int").alias("idx"), "new_idx")


@query("apply_mask", SEL_SQL + SUMMARY_SQL.format(
    x="(SELECT x.primaryid, sel.new_idx AS idx, x.value FROM x JOIN sel ON x.idx = sel.idx)"), "S*")
def apply_mask(spark, sf):
    """Keep the selected features, re-indexed; per report nnz / sums."""
    sp, sel = report_selection(spark, sf)
    return _summary(space_rows(sp, sp["counts"], selected=sel))


@query("sparse_nan_check", RSQL + """
SELECT count(*) AS nnz, count_if(isnan(value)) AS n_nan, (SELECT nf FROM nf) AS n_features,
       (SELECT count(*) FROM ds) AS n_rows FROM x""")
def sparse_nan_check(spark, sf):
    """No NaN in the feature matrix; nnz, width and rows."""
    sp = report_space(spark, sf)
    n_rows = sp["ds"].count()
    return P.entries(sp["rows"]).agg(F.count(F.lit(1)).alias("nnz"), F.count_if(F.isnan("value")).alias("n_nan")).select(
        "nnz", "n_nan", F.lit(sp["nw"] + sp["nc"] + 3).alias("n_features"), F.lit(n_rows).alias("n_rows"))


# ---------------------------------------------------------------- n-gram queries
def _fp(col):
    return F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint")


def _each(lists, step):
    return F.transform(lists, lambda t: step(t))


def _gram_summary(df, id_col, text_col, *steps):
    """Of each id that has one: grams, distinct grams and fingerprint, inside its row; ``steps`` lead from a text to its list of grams."""
    met = df.groupBy(id_col).agg(F.collect_list(F.coalesce(F.col(text_col), F.lit(""))).alias("g"))  # texts of an id, not grams, travel
    for step in steps:
        met = met.select(id_col, _each("g", step).alias("g"))
    g = met.select(id_col, F.flatten("g").alias("g")).where(F.size("g") > 0)
    prints = F.aggregate(F.transform("g", _fp), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return g.select(id_col, F.size("g").cast("long").alias("n_grams"), F.size(F.array_distinct("g")).cast("long").alias("n_distinct"), prints.alias("fingerprint"))


GRAM_SUMMARY_SQL = """SELECT {id}, count(*) AS n_grams, count(DISTINCT term) AS n_distinct,
  CAST(sum(CAST('0x' || substr(md5(term), 1, 8) AS BIGINT)) AS BIGINT) AS fingerprint FROM {src} GROUP BY {id}"""


@query("word_ngrams", O.with_(O.documents_ctes(), sql_word_grams_cte("g", "docs", "doc_id"))
       + GRAM_SUMMARY_SQL.format(id="doc_id", src="g"))
def word_ngrams(spark, sf):
    """per document, count / distinct count / md5 fingerprint of its word 1-2 grams."""
    return _gram_summary(V.documents(spark, sf), "doc_id", "text", T.word_tokens, T.word_ngrams)


@query("char_wb_ngrams", O.with_(O.reports_ctes(), "\nrt AS (SELECT primaryid, REAC_pt_symptom_v2 AS text FROM reports)",
                                 sql_char_grams_cte("cg", "rt", "primaryid"))
       + GRAM_SUMMARY_SQL.format(id="primaryid", src="cg"))
def char_wb_ngrams(spark, sf):
    """per report, count / distinct count / fingerprint of its char_wb 3-5 grams."""
    return _gram_summary(V.reports(spark, sf), "primaryid", "REAC_pt_symptom_v2", G.char_terms)


# ---------------------------------------------------------------- Documents TF-IDF
DOC_MIN_DF, DOC_MAX_DF, DOC_MAX_FEATURES = 5, 0.95, 90_000
DSQL = O.with_(O.documents_ctes(), split_ctes("docs", "doc_id", DY),
               sql_word_grams_cte("dg", "ds", "doc_id", ", split"),
               sql_tfidf_ctes("d_", "dg", "doc_id", "split = 'train'", DOC_MIN_DF, DOC_MAX_DF, DOC_MAX_FEATURES))


BASELINE_SQL = O.with_(O.documents_ctes(), split_ctes("docs", "doc_id", DY),
                       sql_word_grams_cte("dg", "ds", "doc_id", ", split", T.WORD_TOKEN_BASELINE),
                       sql_tfidf_ctes("d_", "dg", "doc_id", "split = 'train'", DOC_MIN_DF, DOC_MAX_DF, DOC_MAX_FEATURES))


def doc_tfidf(spark, sf, token_re=WTOK):
    """(number of train documents, word counts per document, train vocabulary): texts are cut once, and what is read again is written."""
    ds = doc_splits(spark, sf).select("doc_id", "split", "text", *[(F.col(y) == 1).cast("int").alias(y) for y in DY])
    counts = settle(P.count_terms(ds, "doc_id", {"word": P.word_lists(token_re)}, ["split"], DY), "word-counts")
    train = counts.where(F.col("split") == "train")
    n_train = train.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    voc = settle(G.fit_vocabulary(P.term_table(train, "word"), n_train, DOC_MIN_DF, DOC_MAX_DF, DOC_MAX_FEATURES), "word-vocabulary")
    return n_train, counts, voc


def doc_rows(counts, voc):
    return P.features(counts, "doc_id", {"word": voc}, {"word": 0})


@query("tfidf_fit", DSQL + "SELECT term, idx, df, cf, round(idf, 6) AS idf FROM d_voc", "S*")
def tfidf_fit(spark, sf):
    """G1: word 1-2 gram vocabulary fitted on train documents (min_df 5, max_df .95, the 90,000 most frequent)."""
    _, _, voc = doc_tfidf(spark, sf)
    return voc.select("term", "idx", "df", "cf", F.round("idf", 6).alias("idf"))


@query("tfidf_fit_baseline", BASELINE_SQL + "SELECT term, idx, df, cf, round(idf, 6) AS idf FROM d_voc", "S*")
def tfidf_fit_baseline(spark, sf):
    """G1: the baseline vectorizer's word vocabulary (own token pattern, min_df 5, at most 90,000 terms)."""
    _, _, voc = doc_tfidf(spark, sf, T.WORD_TOKEN_BASELINE)
    return voc.select("term", "idx", "df", "cf", F.round("idf", 6).alias("idf"))


CHAR_MIN_DF, CHAR_MAX_FEATURES = 3, 180_000
UNION_SQL = O.with_(
    O.documents_ctes(), split_ctes("docs", "doc_id", DY),
    f"""
nds AS (SELECT doc_id, split, regexp_replace(regexp_replace(replace({O.strip("lower(text)")}, ';', ' '), '[,\\t\\r\\n]+', ' ', 'g'),
                                             '{WS}+', ' ', 'g') AS text FROM ds)""",
    sql_char_grams_cte("cg", "nds", "doc_id", ", split"),
    sql_word_grams_cte("wg", "nds", "doc_id", ", split", T.WORD_TOKEN_BASELINE),
    sql_tfidf_ctes("c_", "cg", "doc_id", "split = 'train'", CHAR_MIN_DF, DOC_MAX_DF, CHAR_MAX_FEATURES),
    "\nnc AS (SELECT count(*) AS nc FROM c_voc)",
    sql_tfidf_ctes("w_", "wg", "doc_id", "split = 'train'", DOC_MIN_DF, DOC_MAX_DF, DOC_MAX_FEATURES, offset="(SELECT nc FROM nc)"),
    "\nx AS (SELECT * FROM c_x UNION ALL SELECT * FROM w_x)")


def baseline_space(spark, sf):
    """(char and word counts per document, char vocabulary, word vocabulary) of the normalised documents, fitted on train."""
    ds = doc_splits(spark, sf).select("doc_id", "split", T.normalize_text(F.col("text")).alias("text"))
    spaces = {"char": P.char_lists(), "word": P.word_lists(T.WORD_TOKEN_BASELINE)}
    counts = settle(P.count_terms(ds, "doc_id", spaces, ["split"]), "baseline-counts")
    train = counts.where(F.col("split") == "train")
    n_train = train.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    fit = lambda name, least, cap: settle(G.fit_vocabulary(P.term_table(train, name), n_train, least, DOC_MAX_DF, cap), f"baseline-{name}-vocabulary")
    return counts, fit("char", CHAR_MIN_DF, CHAR_MAX_FEATURES), fit("word", DOC_MIN_DF, DOC_MAX_FEATURES)


@query("tfidf_fit_baseline_char", UNION_SQL + "SELECT term, idx, df, cf, round(idf, 6) AS idf FROM c_voc", "S*")
def tfidf_fit_baseline_char(spark, sf):
    """G1: the baseline vectorizer's char_wb 3-5 gram vocabulary (normalised text, min_df 3, max_df .95, the 180,000 most frequent)."""
    return baseline_space(spark, sf)[1].select("term", "idx", "df", "cf", F.round("idf", 6).alias("idf"))


@query("feature_union_baseline", UNION_SQL + SUMMARY_SQL.format(x="x").replace("primaryid", "doc_id"), "S*")
def feature_union_baseline(spark, sf):
    """The baseline space, char TF-IDF then word TF-IDF, per document: nnz, sum, sum of squares, sum idx*value."""
    counts, cvoc, wvoc = baseline_space(spark, sf)
    return _summary(P.features(counts, "doc_id", {"char": cvoc, "word": wvoc}, {"char": 0, "word": cvoc.count()}), "doc_id")


@query("tfidf_transform", DSQL + "SELECT doc_id, idx, round(value, 6) AS value FROM d_x", "S*")
def tfidf_transform(spark, sf):
    """Sublinear TF-IDF, L2-normalised, for every document with the train vocabulary."""
    _, counts, voc = doc_tfidf(spark, sf)
    return P.entries(doc_rows(counts, voc), "doc_id").select("doc_id", "idx", F.round("value", 6).alias("value"))


@query("mean_tfidf_terms", DSQL + """
, tr AS (SELECT count(*) AS n FROM ds WHERE split = 'train'),
m AS (SELECT v.term, sum(x.value) / any_value(tr.n) AS mean_tfidf FROM d_x x JOIN ds ON x.doc_id = ds.doc_id
      JOIN d_voc v ON x.idx = v.idx, tr WHERE ds.split = 'train' GROUP BY v.term)
SELECT term, round(mean_tfidf, 6) AS mean_tfidf FROM m ORDER BY round(mean_tfidf, 9) DESC, term LIMIT 60""", "S*")
def mean_tfidf_terms(spark, sf):
    """Top 60 terms by mean TF-IDF over train documents."""
    n, counts, voc = doc_tfidf(spark, sf)
    x = P.entries(doc_rows(counts.where(F.col("split") == "train"), voc))
    m = x.groupBy("idx").agg((F.sum("value") / F.lit(float(n))).alias("mean_tfidf")).join(voc.select("idx", "term"), "idx")
    return (m.orderBy(F.round("mean_tfidf", 9).desc(), "term").limit(60)
            .select("term", F.round("mean_tfidf", 6).alias("mean_tfidf")))


@query("label_top_terms", DSQL + f"""
, pos AS ({' UNION ALL '.join(f"SELECT doc_id, {O.lit(y[2:])} AS label FROM ds WHERE split = 'train' AND {y} = 1" for y in DY)}),
np AS (SELECT label, count(*) AS n_pos FROM pos GROUP BY label HAVING count(*) >= 50),
m AS (SELECT pos.label, x.idx, sum(x.value) / any_value(np.n_pos) AS mean_tfidf FROM d_x x JOIN pos ON x.doc_id = pos.doc_id
      JOIN np ON pos.label = np.label GROUP BY pos.label, x.idx),
r AS (SELECT m.label, v.term, m.mean_tfidf,
             row_number() OVER (PARTITION BY m.label ORDER BY round(m.mean_tfidf, 9) DESC, v.term) AS rank
      FROM m JOIN d_voc v ON m.idx = v.idx)
SELECT label, CAST(rank AS INTEGER) AS rank, term, round(mean_tfidf, 6) AS mean_tfidf FROM r WHERE rank <= 25""", "S*")
def label_top_terms(spark, sf):
    """Per label with >= 50 positive train documents, top 25 terms by mean TF-IDF over positives."""
    from pyspark.sql import Window
    _, counts, voc = doc_tfidf(spark, sf)
    train = counts.where(F.col("split") == "train")
    npos = train.select(F.explode(F.array(*[F.struct(F.lit(y[2:]).alias("label"), F.col(y).alias("n")) for y in DY])).alias("p")).groupBy(
        "p.label").agg(F.sum("p.n").alias("n_pos")).where(F.col("n_pos") >= 50)
    sums = P.feature_sums(doc_rows(train.where(reduce(or_, [F.col(y) > 0 for y in DY])), voc), DY)
    per = sums.select("idx", F.explode(F.array(*[F.struct(F.lit(y[2:]).alias("label"), F.col(f"o_{y}").alias("s")) for y in DY])).alias("p")).select(
        "p.label", "idx", "p.s").where("s > 0")
    m = per.join(F.broadcast(npos), "label").select("label", "idx", (F.col("s") / F.col("n_pos")).alias("mean_tfidf")).join(voc.select("idx", "term"), "idx")  # a row a label
    w = Window.partitionBy("label").orderBy(F.round("mean_tfidf", 9).desc(), "term")
    return (m.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 25)
            .select("label", F.col("rank").cast("int").alias("rank"), "term", F.round("mean_tfidf", 6).alias("mean_tfidf")))
