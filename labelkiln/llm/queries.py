"""Registered queries of the training-data operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

import corpus_pipeline

from . import bytebpe, collocations, decontaminate, hardnegatives, htmltext, langid, licences, neighbours, simhash, tokenrecords, urlfilter, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


SQL["op1_nearest_neighbours"] = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id, list_dot_product(q.v, r.v) AS score
  FROM usable q JOIN usable r ON r.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@register
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs.select("doc_id", langid.held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@register
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document; its path is source / language / thousand of ids / id."""
    return licences.scan(table(spark, sf_dir, "documents").withColumn("path", document_path()), ("doc_id",))


def document_path():
    part = lambda c: F.coalesce(F.col(c), F.lit("_"))
    return F.concat_ws("/", part("source"), part("lang"), F.floor(F.col("doc_id") / 1000).cast("string"),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def _licence_sql() -> str:
    forms = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licences.TEMPLATES)
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    split = "unnest(regexp_extract_all({}, '[a-z0-9]+'))".format
    best = "row_number() OVER (PARTITION BY {} ORDER BY {})".format
    blocks = (f"string_split_regex(regexp_replace(low, '{licences._COMMENT_END}', '\\1' || chr(10) || chr(10) || '\\2', 'g'), "
              f"'{licences._BLANK_LINES}')")
    return f"""
WITH templates(license, body) AS (VALUES {forms}),
docs AS (
  SELECT doc_id, text, {low('text')} AS low,
         concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), CAST(doc_id // 1000 AS VARCHAR)) AS dir FROM documents),
form_words AS (SELECT license, body AS form, {split(low('body'))} AS word FROM templates),
doc_words AS (SELECT rid, word FROM (SELECT rid, {split('low')} AS word FROM (SELECT row_number() OVER () AS rid, low FROM docs WHERE text IS NOT NULL))
              WHERE word IN (SELECT word FROM form_words) GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM doc_words GROUP BY word),
idf AS (SELECT word, ln((1 + (SELECT count(*) FROM docs WHERE text IS NOT NULL)) / (1 + coalesce(df, 0))) + 1 AS idf
        FROM (SELECT DISTINCT word FROM form_words) LEFT JOIN df USING (word)),
rest AS (SELECT avg(idf) AS rest FROM idf),
shape AS (SELECT license, form, word, (1 + ln(count(*))) * any_value(idf) AS w FROM form_words JOIN idf USING (word) GROUP BY license, form, word),
square AS (SELECT license, form, sum(w * w) AS square FROM shape GROUP BY license, form),
texts AS (SELECT DISTINCT text, low FROM docs WHERE text IS NOT NULL),
starts AS (SELECT text, parts, unnest(range(len(parts))) AS block FROM (SELECT text, {blocks} AS parts FROM texts)),
runs AS (SELECT text, parts, block, unnest(range(1, least({licences.RUN}, len(parts) - block) + 1)) AS blocks FROM starts),
lines AS (SELECT text, low AS body, 2 AS kind, 0 AS line, 0 AS blocks FROM texts UNION ALL
          SELECT text, array_to_string(parts[block + 1:block + blocks], ' ') AS body, 1 AS kind, block AS line, blocks FROM runs UNION ALL
          SELECT text, unnest(parts) AS body, 0 AS kind, unnest(range(len(parts))) AS line, 0 AS blocks
          FROM (SELECT text, string_split(low, chr(10)) AS parts FROM texts)),
units AS (SELECT DISTINCT body FROM lines),
unit_words AS (SELECT body, word, (1 + ln(count(*))) * coalesce(any_value(idf), any_value(rest)) AS weight
               FROM (SELECT body, {split('body')} AS word FROM units) LEFT JOIN idf USING (word), rest GROUP BY body, word),
norm AS (SELECT body, sum(weight * weight) AS norm FROM unit_words GROUP BY body),
dots AS (SELECT body, license, form, sum(weight * w) AS dot FROM unit_words JOIN shape USING (word) GROUP BY body, license, form),
scored AS (SELECT body, license, round(dot / sqrt(norm * square), 9) AS score FROM dots JOIN norm USING (body) JOIN square USING (license, form)
           WHERE dot / sqrt(norm * square) >= {licences.THRESHOLD}),
own AS (SELECT text, license, score, line FROM (
          SELECT text, license, score, line, {best('text', 'score DESC, kind, line, blocks, license')} AS place FROM lines JOIN scored USING (body)) WHERE place = 1),
files AS (SELECT doc_id, dir, dir || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, license, score, line
          FROM docs LEFT JOIN own USING (text)),
held AS (SELECT dir, license FROM (
           SELECT dir, license, {best('dir', 'path, license')} AS place FROM files WHERE license IS NOT NULL AND line = 0) WHERE place = 1),
up AS (SELECT dir, unnest(range(1, len(string_split(dir, '/')) + 1)) AS depth FROM (SELECT DISTINCT dir FROM files WHERE license IS NULL)),
passed AS (SELECT dir, from_dir, passed FROM (
             SELECT up.dir, held.dir AS from_dir, license AS passed, {best('up.dir', 'depth DESC')} AS place
             FROM up JOIN held ON held.dir = array_to_string(string_split(up.dir, '/')[1:depth], '/')) WHERE place = 1)
SELECT doc_id, path, coalesce(license, passed) AS license, score,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN passed IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN license IS NULL THEN from_dir END AS from_dir
FROM files LEFT JOIN passed USING (dir)
"""


SQL["op3_license_scan"] = _licence_sql()


@register
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


@register
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, look every capture up in the index, and read the records back."""
    pages = table(spark, sf_dir, "pages")
    archive = warc.write(pages)
    wanted = pages.select(warc.capture_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id")).distinct()
    return warc.read(archive.lookup(wanted)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_warc"] = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""


@register
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that align, with the score of the best passage."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "end_word")


@register
def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of every document, read the files back and digest them."""
    manifest = tokenrecords.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return tokenrecords.digests(spark, manifest)


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, 2 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


#: (host, path, verdict) of the rules that op9 applies.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@register
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and winning rule of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


SQL["op9_url_filter"] = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(rhost, rpath, verdict) AS (VALUES """ + ", ".join(str(r) for r in URL_RULES) + """),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY host, path
                            ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, verdict DESC) AS place
  FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON b.host = p.host AND b.path = p.path AND b.place = 1
"""


@register
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives back the text."""
    return corpus_pipeline.encoded(spark, table(spark, sf_dir, "documents"), ["doc_id"])


@register
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language."""
    found = collocations.mine(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL["op11_collocations"] = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\f\r]')) AS piece FROM documents)) WHERE len(words) > 0),
total AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
spans AS (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM pieces, (SELECT unnest(range(1, 6)) AS size) WHERE len(words) >= size),
f AS (SELECT lang, size, words[i:i + size - 1] AS w, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, size, w, f AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1),
scored AS (
  SELECT c.lang, c.size, c.w, a, k, x.f AS l, y.f AS r, (1000::HUGEINT * a * n::HUGEINT) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.w = c.w[1:k] JOIN f y ON y.lang = c.lang AND y.w = c.w[k + 1:] JOIN total t ON t.lang = c.lang),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS p FROM scored) WHERE p = 1),
parts AS (SELECT DISTINCT g.lang, g.w[i:j] AS w, g.f FROM f g, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(1, 6)) AS j)
          WHERE i < j AND j <= g.size AND j - i + 1 < g.size),
kept AS (SELECT * FROM lowest c WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.lang = c.lang AND p.w = c.w AND 100 * p.f >= 100 * c.a)),
ranked AS (SELECT *, array_to_string(w, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of the positives of every row whose id is divisible by 100; where it is divisible by 7, the label is the next one."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


SQL["op12_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS anchor_id, r.vec_id AS vec_id, q.label = r.label AS same, list_dot_product(q.v, r.v)::BIGINT AS score
  FROM usable q JOIN usable r ON r.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
positives AS (SELECT * FROM (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same) WHERE place <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@register
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of the text decoded from them."""
    return bytebpe.round_trip(table(spark, sf_dir, "documents"), bytebpe.read(public_tokenizers.path("byte_bpe_50k.json")), ["doc_id"])


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over documents."""
    return corpus_pipeline.run(spark, sf_dir)
