"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Everything is DataFrame and SQL functions.

* Templates are one-line notices, standard headers and licence texts
  (``licence_texts``); a licence may have several.
* Units of a file are its lines, its blocks (what stands between blank
  lines; a comment and the code after it are blocks of their own), each run
  of up to ``RUN`` blocks in a row, and the whole text.  Words are runs of
  ``a-z0-9`` after lowering A-Z, so comment markers don't count.  A word
  weighs ``(1 + ln tf) * idf``; the document frequencies of the templates'
  words are counted over all files, and words of no template weigh the mean
  idf of those that are.
* A unit's cosine to a template is at most the root of the share of the
  template's squared weight that lies in words of the unit.  So one that
  reaches the threshold holds, beside light words, a number of the template's
  heavy words that follows from the weights (``reachable``).  Texts and units
  below it for every template are passed over; the bound is exact.
* Units are scored once per distinct text, so a line that millions of files
  share costs one row; a file's licence depends on its text alone, so copies
  share it too.
* A file without a licence of its own takes that of the nearest ancestor
  directory that has one.  A directory's licence is that of its licence file
  with the smallest path.  Distinct directories are joined with their
  ancestors; files then join their directory.

Broadcast hints are only on tables with one row per template word; the
words and counts of ``reachable`` are as many.

Edge cases: null or empty texts have no licence of their own but inherit;
null paths neither give nor inherit; of equal scores lines come before
blocks and blocks before the whole text, earlier ones first, then the first
licence by name; repeated files each get a row; long texts are scanned
whole; other columns are kept out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settle
from .licence_texts import HEADERS, NOTICES, TEXTS

THRESHOLD = 0.6
#: Most blocks in a row that are scored together: a text of so many paragraphs is found inside a longer file.
RUN = 6

TEMPLATES = NOTICES + HEADERS + TEXTS

#: A comment line (by its marker) and the start of a line that is none.
_COMMENT_END = r"((?:\A|\n)[ \t]*[*#;%/][^\n]*)\n([ \t]*[^ \t\r\n*#;%/])"
_BLANK_LINES = r"\n[ \t\r]*\n"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def words(low: Column) -> Column:
    return F.filter(F.split(low, "[^a-z0-9]+"), lambda w: w != "")


def _weights(units: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """(key, word, weight) of units (key, low)."""
    rest = idf.agg(F.avg("idf").alias("rest"))  # one row
    tf = units.select(key, F.explode(words(F.col("low"))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("tf"))
    return (tf.join(F.broadcast(idf), "word", "left").crossJoin(F.broadcast(rest))
            .select(key, "word", ((1 + F.log("tf")) * F.coalesce("idf", "rest")).alias("weight")))


def _needed(shape: DataFrame, threshold: float) -> list[tuple[list[str], int]]:
    """Per template its heavy words, and how many of them a unit must hold to reach the threshold.

    The light words left out weigh at most half of what a unit must share with the template.
    """
    forms: dict[str, list[tuple[float, str]]] = {}
    for r in shape.where("weight is not null").select("form", "word", "weight").collect():  # the templates' words; null: no files
        forms.setdefault(r["form"], []).append((r["weight"] ** 2, r["word"]))
    out = []
    for weighed in forms.values():
        weighed.sort(reverse=True)
        must = threshold * threshold * sum(w for w, _ in weighed) * (1 - 1e-9)
        light = 0.0
        while light + weighed[-1][0] <= must / 2:
            light += weighed.pop()[0]
        held, count = 0.0, 0
        while held + light < must:
            held += weighed[count][0]
            count += 1
        out.append(([word for _, word in weighed], count))
    return out


def reachable(low: Column, needed: list[tuple[list[str], int]]) -> Column:
    """Whether a lowered text holds enough heavy words of any template."""
    def literal(listed) -> Column:
        return F.array(*map(F.lit, sorted(listed)))
    found = F.array_intersect(F.split(low, "[^a-z0-9]+"), literal({w for listed, _ in needed for w in listed}))

    def any_form(f: Column) -> Column:
        hit = F.lit(False)
        for listed, count in needed:
            hit = hit | (F.size(F.array_intersect(f, literal(listed))) >= count)
        return F.when(F.size(f) > 0, hit).otherwise(False)
    return F.exists(F.array(found), any_form)  # binds the words found once


def _units(texts: DataFrame) -> DataFrame:
    """(text_key, line, block, blocks, low): lines, runs of blocks and the whole of texts (text_key, low)."""
    none = F.lit(None).cast("int")
    lines = texts.select("text_key", F.posexplode(F.split("low", "\n")).alias("line", "low")).select(
        "text_key", "line", none.alias("block"), none.alias("blocks"), "low")
    parts = F.split(F.regexp_replace("low", _COMMENT_END, "$1\n\n$2"), _BLANK_LINES)
    starts = texts.select("text_key", parts.alias("parts")).select("text_key", F.posexplode(F.transform(
        "parts", lambda _, i: F.slice("parts", i + 1, F.lit(RUN)))).alias("block", "run"))
    runs = starts.select("text_key", none.alias("line"), "block", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("run")), lambda n: F.struct(n.alias("blocks"), F.array_join(F.slice("run", F.lit(1), n), " ").alias("low")))).alias("u"))
    whole = texts.select("text_key", none, none, none, F.translate("low", "\n", " "))
    return lines.union(runs.select("text_key", "line", "block", "u.blocks", "u.low")).union(whole)


def own_licences(files: DataFrame, templates: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(text_key, license, score, line, block): the best licence of each distinct text that has one.

    ``line`` or ``block`` is the matching line or first matching block, from 0; both null: the whole text.
    """
    forms = templates.select("license", F.md5(F.concat_ws("\n", "license", "text")).alias("form"), lowered(F.col("text")).alias("low")).distinct()
    vocabulary = forms.select(F.explode(words(F.col("low"))).alias("word")).distinct()
    listed = sorted(r["word"] for r in vocabulary.collect())  # the templates' words
    texts = files.select(F.col(text_col).alias("text")).where("text is not null").withColumn("low", lowered(F.col("text")))
    seen = texts.select(F.array_intersect(F.split("low", "[^a-z0-9]+"), F.array(*map(F.lit, listed))).alias("found"))
    # the marker word '' is in every row and so counts the files
    df = seen.select(F.explode(F.concat(F.array(F.lit("")), F.array_remove("found", ""))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    df = settle(df, "licence-df")
    total = df.where("word = ''").select(F.col("df").alias("n"))
    idf = (vocabulary.join(F.broadcast(df), "word", "left").crossJoin(F.broadcast(total))
           .select("word", (F.log((1 + F.col("n")) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf")))
    idf = settle(idf, "licence-idf")

    shape = _weights(forms, "form", idf)
    shape = shape.withColumn("square", F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("form")))
    shape = settle(shape.join(F.broadcast(forms.select("form", "license")), "form"), "licence-shape")
    needed = _needed(shape, threshold)
    if not needed:
        return files.sparkSession.createDataFrame([], "text_key string, license string, score double, line int, block int")

    some = settle(texts.where(reachable(F.col("low"), needed)).select(F.md5("text").alias("text_key"), "low"), "licence-texts")
    units = _units(some).where(reachable(F.col("low"), needed))
    units = settle(units.withColumn("unit", F.md5("low")), "licence-units")

    distinct = units.groupBy("unit").agg(F.first("low").alias("low"))
    weight = settle(_weights(distinct, "unit", idf), "licence-weights")
    norm = weight.groupBy("unit").agg(F.sum(F.col("weight") * F.col("weight")).alias("norm"))
    dots = (weight.join(F.broadcast(shape.select("form", "license", "word", F.col("weight").alias("w"), "square")), "word")
            .groupBy("unit", "form", "license", "square").agg(F.sum(F.col("weight") * F.col("w")).alias("dot")))
    scored = (dots.join(norm, "unit").withColumn("score", F.col("dot") / F.sqrt(F.col("norm") * F.col("square")))
              .where(F.col("score") >= threshold))
    best = scored.groupBy("unit").agg(F.min(F.struct((-F.round("score", 9)).alias("neg"), "license")).alias("best"))
    placed = units.select("text_key", "line", "block", "blocks", "unit").join(best, "unit")
    kind = F.when(F.col("line").isNotNull(), 0).when(F.col("block").isNotNull(), 1).otherwise(2)
    chosen = F.struct("best.neg", kind.alias("kind"), "line", "block", "blocks", "best.license")
    return (placed.groupBy("text_key").agg(F.min(chosen).alias("c"))
            .select("text_key", "c.license", (-F.col("c.neg")).alias("score"), "c.line", "c.block"))


def inherited(directories: DataFrame, held: DataFrame) -> DataFrame:
    """(dir, from_dir, license): for the distinct ``dir`` of ``directories``, the nearest of it and its ancestors in ``held`` (dir, license)."""
    parts = F.split("dir", "/")
    up = directories.select("dir").distinct().select("dir", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("from_dir")))).alias("a"))
    found = up.select("dir", "a.depth", "a.from_dir").join(held.select(F.col("dir").alias("from_dir"), "license"), "from_dir")
    return (found.groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "license")).alias("b"))
            .select("dir", "b.from_dir", "b.license"))


def scan(files: DataFrame, keep: tuple[str, ...] = (), path_col: str = "path", text_col: str = "text",
         licence_file: Column | None = None, templates: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep``, path, license, score, origin (own, inherited or null) and from_dir of every file.

    ``licence_file`` marks the files whose licence holds for their directory,
    as a condition on the columns of ``files`` and on ``line`` and ``block``
    (of the match; both null: the whole text); by default files whose whole
    text matches or whose match is in their first line or begins with their
    first block.
    """
    if templates is None:
        templates = files.sparkSession.createDataFrame(TEMPLATES, "license string, text string")
    own = settle(own_licences(files, templates, text_col, threshold), "licence-own")
    gives = F.coalesce(F.coalesce("line", "block") == 0, F.lit(True)) if licence_file is None else licence_file
    rows = files.select(*keep, F.col(path_col).alias("path"), F.md5(text_col).alias("text_key"))
    rows = rows.withColumn("dir", F.regexp_extract("path", "(?s)^(.*)/[^/]*$", 1))
    rows = settle(rows.join(own, "text_key", "left"), "licence-rows")
    held = (rows.where(F.col("license").isNotNull() & F.col("path").isNotNull() & gives)
            .groupBy("dir").agg(F.min_by("license", F.struct("path", "license")).alias("license")))
    passed = inherited(rows.where("license is null and path is not null"), held)
    passed = settle(passed.select("dir", "from_dir", F.col("license").alias("passed")), "licence-passed")
    out = rows.join(passed, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(*keep, "path", F.coalesce("license", "passed").alias("license"), F.when(mine, F.col("score")).alias("score"),
                      F.when(mine, "own").when(F.col("passed").isNotNull(), "inherited").alias("origin"),
                      F.when(~mine, F.col("from_dir")).alias("from_dir"))
