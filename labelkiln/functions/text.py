"""String / array Column functions (all JVM-side, codegen-friendly).

Whitespace is the explicit class ``[ \\t\\n\\x0B\\f\\r]`` so that Spark
(Java regex) and the DuckDB oracle (RE2) agree on every character.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import RuleSet

WS = r"[ \t\n\x0B\f\r]"
STRIP_RE = rf"^{WS}+|{WS}+$"
TERM_SEP = "; "
NULL_TOKENS_RE = r"(?i)^(nan|null|none|n/a|na)?$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Python ``str.strip()`` on the ASCII whitespace class (Spark ``trim`` only strips spaces)."""
    return F.regexp_replace(_c(x), STRIP_RE, "")


def normalize_text(x) -> Column:
    """lower, strip, ';' -> ' ', runs of [,\\t\\r\\n] -> ' ', collapse whitespace (no final strip)."""
    s = strip(F.lower(F.coalesce(_c(x), F.lit(""))))
    s = F.regexp_replace(s, ";", " ")
    s = F.regexp_replace(s, r"[,\t\r\n]+", " ")
    return F.regexp_replace(s, rf"{WS}+", " ")


def split_terms(x, distinct: bool = False) -> Column:
    """split on ';', strip each piece, drop empties; ``distinct`` keeps first occurrences (v1)."""
    parts = F.transform(F.split(F.coalesce(_c(x), F.lit("")), ";"), strip)
    arr = F.filter(parts, lambda t: t != "")
    return F.array_distinct(arr) if distinct else arr


def normalize_symptom_text(x) -> Column:
    """split on ``\\s*;\\s*``, collapse inner whitespace, drop empties, case-insensitive
    dedup keeping the first spelling, join with '; '."""
    parts = F.transform(F.split(strip(F.coalesce(_c(x), F.lit(""))), rf"{WS}*;{WS}*"),
                        lambda t: F.regexp_replace(strip(t), rf"{WS}+", " "))
    parts = F.filter(parts, lambda t: t != "")
    low = F.transform(parts, F.lower)
    kept = F.filter(parts, lambda t, i: F.array_position(low, F.lower(t)) == i + 1)
    return F.array_join(kept, TERM_SEP)


def _is_dropped(t: Column, rules: RuleSet) -> Column:
    hit = t.isin(*rules.drop_exact) if rules.drop_exact else F.lit(False)
    if rules.drop_regex:
        hit = hit | t.rlike(rules.drop_regex)
    return hit


def keep_drop_terms(arr, rules: RuleSet) -> tuple[Column, Column]:
    """partition a term array into (kept, dropped): exact set (case-sensitive) OR regex."""
    a = _c(arr)
    return (F.filter(a, lambda t: ~_is_dropped(t, rules)),
            F.filter(a, lambda t: _is_dropped(t, rules)))


def first_match_category(x, rules: RuleSet) -> Column:
    """first label (priority order) whose regex matches, else the fallback name."""
    out = F.lit(rules.fallback)
    for lab, pat in reversed(list(rules.labels.items())):
        out = F.when(_c(x).rlike(pat), F.lit(lab)).otherwise(out)
    return out


def multilabel(x, rules: RuleSet) -> list[Column]:
    """one tinyint ``y_<label>`` per label (sorted order): regex found anywhere in the text."""
    t = F.coalesce(_c(x), F.lit(""))
    return [t.rlike(rules.labels[lab]).cast("tinyint").alias(f"y_{lab}") for lab in rules.sorted_labels]


def rebuild_y_labels(y_cols: list[str], null_if_empty: bool = True) -> Column:
    """F8: names of set labels joined '; ' (null when none, or '' when ``null_if_empty`` is False)."""
    names = F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(labname(c))) for c in y_cols]))
    s = F.array_join(names, TERM_SEP)
    return F.nullif(s, F.lit("")) if null_if_empty else s


def labname(c: str) -> str:
    """strip the first ``y_`` prefix only."""
    return c[2:] if c.startswith("y_") else c


def labname_col(x) -> Column:
    return F.regexp_replace(_c(x), "^y_", "")


def split_labels(x) -> Column:
    """parse a '; '-joined label string to an array; null -> empty array."""
    return F.coalesce(F.filter(F.transform(F.split(_c(x), ";"), strip), lambda t: t != ""),
                      F.array().cast("array<string>"))


def normalize_id(x) -> Column:
    """B1: strip, then remove every non-digit."""
    return F.regexp_replace(strip(_c(x)), r"[^0-9]+", "")


def to_null_token(x) -> Column:
    """Strip; '', nan, null, none, n/a, na (any case) -> null."""
    s = strip(_c(x))
    return F.when(s.rlike(NULL_TOKENS_RE), F.lit(None).cast("string")).otherwise(s)


def meta_features(x) -> tuple[Column, Column, Column]:
    """log1p(len(stripped)), number of terms, number of distinct lower-cased terms."""
    s = strip(F.coalesce(_c(x), F.lit("")))
    terms = F.filter(F.transform(F.split(s, rf"{WS}*;{WS}*"), lambda t: F.lower(strip(t))),
                     lambda t: t != "")
    return (F.log1p(F.length(s).cast("double")).alias("log1p_len"),
            F.size(terms).cast("int").alias("n_terms"),
            F.size(F.array_distinct(terms)).cast("int").alias("n_uniq_terms"))


WORD_TOKEN_DEFAULT = r"[\p{L}\p{N}_]{2,}"
WORD_TOKEN_BASELINE = r"[a-z0-9][a-z0-9\-_]+"


def word_tokens(x, token_re: str = WORD_TOKEN_DEFAULT) -> Column:
    """Tokens of the lower-cased text by a regex (default: 2+ word characters)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(x), F.lit(""))), F.lit(token_re), 0)


def word_ngrams(tokens, n_min: int = 1, n_max: int = 2) -> Column:
    """all n-grams (n_min..n_max) of a token array, space-joined.

    n-grams are zips of n shifted slices, so the token array is read a
    fixed number of times per row (a lambda indexing into it would
    re-evaluate it once per token).
    """
    t = _c(tokens)
    empty = F.array().cast("array<string>")

    def grams(n: int) -> Column:
        m = F.size(t) - n + 1
        acc = F.slice(t, 1, m)
        for k in range(1, n):
            acc = F.zip_with(acc, F.slice(t, k + 1, m), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.when(F.size(t) >= n, acc).otherwise(empty)

    per_n = [grams(n) for n in range(n_min, n_max + 1)]
    return F.flatten(F.array(*per_n)) if len(per_n) > 1 else per_n[0]


def char_wb_ngrams(x, n_min: int = 3, n_max: int = 5) -> Column:
    """character n-grams inside space-padded words.

    For padded length L, n runs from n_min to min(n_max, L); at n = L the
    whole padded word is emitted once and n stops growing.
    """
    text = F.lower(F.coalesce(_c(x), F.lit("")))
    words = F.filter(F.split(text, rf"{WS}+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(w: Column) -> Column:
        L = F.length(w)
        return F.flatten(F.transform(
            F.sequence(F.lit(n_min), F.greatest(F.least(F.lit(n_max), L), F.lit(n_min))),
            lambda n: F.transform(F.sequence(F.lit(1), L - n + 1), lambda i: F.substring(w, i, n))))

    return F.flatten(F.transform(padded, grams))


#: Preference order of the text columns of a report table.
TEXT_COLUMNS = ("REAC_pt_symptom_v2", "REAC_pt_symptom", "REAC_pt", "text")


def select_text_column(columns: list[str], preferred: tuple[str, ...] = TEXT_COLUMNS) -> str:
    """The first of ``preferred`` among ``columns``; an error names them if there is none."""
    for name in preferred:
        if name in columns:
            return name
    raise ValueError(f"none of the text columns {', '.join(preferred)} is there")
