"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import itertools
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from labelkiln.llm import (decontaminate, htmltext, langid, licences, neighbours, sentencepieces, simhash, tokenrecords,
                           urlfilter, warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, ids string, rank int, line int, key string, text_key string"
LONG = "the cat sat on the mat and so did we all. " * 4000


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None, 1, 0.5, "x", 2, 3, "k", "t") for i, t, lang in rows], DOCS)


ODD = [(1, None, "en"), (2, "", "en"), (3, "  \n\t ", None), (4, "12 34 !!", "de"), (5, LONG, "en"), (5, LONG, "en"),
       (6, LONG + "end", "en"), (None, "the cat sat on the mat", "en"), (None, None, None), (7, "das ist ein kurzer Satz über den Hund", "de"),
       (8, "The cat sat on the mat", "en"), (9, "▁ \x00 é日本語😀 <|endoftext|>", "fr")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_frame(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return docs_frame(spark, [])


def test_language(odd, none):
    model = langid.fit(odd.where(~langid.held_out()))
    rows = langid.predict(odd.select("doc_id", "text"), model).collect()
    assert len(rows) == len(ODD)
    by_text = {r["text"]: r for r in rows}
    for t in (None, "", "  \n\t ", "12 34 !!"):
        assert (by_text[t]["lang_pred"], by_text[t]["score"], by_text[t]["rejected"]) == ("und", 0.0, True)
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "fr", "und") for r in rows)
    assert langid.fit(none) is None
    assert {r["lang_pred"] for r in langid.predict(odd.select("text"), None).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0
    kept = langid.recognised(odd, model)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 5


def test_language_rejects_other_scripts(spark):
    rng = np.random.default_rng(3)
    word = lambda letters: "".join(rng.choice(list(letters), 5))
    rows = [(i, " ".join(word("abcde" if i % 2 else "mnopq") for _ in range(80)), "one" if i % 2 else "two") for i in range(120)]
    model = langid.fit(docs_frame(spark, rows).where(~langid.held_out()))
    fresh = [" ".join(word("abcde") for _ in range(60)), " ".join(word("mnopq") for _ in range(60)), "другой текст на другом языке " * 5]
    found = langid.predict_texts(fresh, model)
    assert [f[0] for f in found[:2]] == ["one", "two"] and [f[2] for f in found] == [False, False, True]


def test_simhash(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    blank = [r for r in rows if r["fp"] == 0]
    assert len(blank) == 4 and {r["component_id"] for r in blank} == {1}  # null, empty and blank texts
    cat = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] in (8, None) and r["fp"] != 0}
    assert cat == {8: 8, None: 8}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()].count(5) == 1
    assert simhash.keep_first(none).count() == 0


def test_decontamination(spark, odd, none):
    bench = spark.createDataFrame([(1, "the cat sat on the mat", 1), (1, "the cat sat on the mat", 1), (2, None, 1), (None, "", 1), (3, "Satz", 1)],
                                  "item_id long, text string, score int")
    rows = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.matches(odd, bench).collect()}
    assert rows == {(i, 1): 1.0 for i in (5, 6, 8, None)} | {(7, 3): 1.0}
    kept = decontaminate.without_leaks(odd, bench)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, None, 9}
    assert decontaminate.matches(none, bench).count() == 0
    assert decontaminate.without_leaks(odd, bench.limit(0)).count() == len(ODD)
    # the same rows whatever the size of the blocks of items
    blocks = decontaminate.matches(odd, bench, block_words=1)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == set(rows)


def test_pieces(odd, none):
    out = corpus_pipeline.encoded(odd.sparkSession, odd, [c for c in odd.columns if c != "text"])
    assert out.columns == [c for c in odd.columns if c not in ("text", "ids")] + ["ids", "n_pieces", "round_trip"]
    rows = out.collect()
    assert len(rows) == len(ODD) and all(r["round_trip"] for r in rows)
    assert {r["doc_id"]: r["ids"] for r in rows if r["doc_id"] in (1, 2)} == {1: None, 2: []}
    assert corpus_pipeline.encoded(odd.sparkSession, none, ["doc_id"]).count() == 0
    pieces = sentencepieces.Pieces.load(corpus_pipeline.MODEL)
    back = sentencepieces.decode(sentencepieces.encode(odd, pieces, ["doc_id", "score"], decoded=None), pieces, ["doc_id"]).collect()
    assert sorted((r["text"] or "" for r in back)) == sorted(t or "" for _, t, _ in ODD)


def test_tokens(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = tokenrecords.digests(odd.sparkSession, tokenrecords.write(odd, path)).orderBy("start").collect()
    want = sorted(((i is not None, i or 0), t.encode(x or "", add_special_tokens=False).ids + [0]) for i, x, _ in ODD)
    assert [r["doc_id"] for r in rows] == [i if has else None for (has, i), _ in want]
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted((len(x), crc(x)) for _, x in want)
    assert tokenrecords.digests(odd.sparkSession, tokenrecords.write(none, path)).count() == 0
    record = tokenrecords.frame(b"abcd")
    assert tokenrecords.unframe(record) == b"abcd"
    for k in range(len(record)):
        with pytest.raises(Exception):
            tokenrecords.unframe(record[:k] + bytes([record[k] ^ 1]) + record[k + 1:])


PAGES = "page_id long, url string, html string, host string, rule string, digest string, text string"


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "r", "d", "t") for r in rows], PAGES)


def test_html(spark):
    body = "<p>" + "word " * 50
    cases = [(None, ""), ("", ""), ("plain words", "plain words"), ("<nav>a", ""),
             ("<article><h1>A &amp; B</h1><p>x\n\n y<br>z</article>", "A & B x y z"),
             (f"<ul><li><a href=x>menu</a></ul>{body}<div class='sidebar'>no</div>{body}<footer>f", " ".join(["word"] * 100)),
             ("<script>var a='</p>'</script><style>p{}</style><!-- <p>c</p> --><p>t", "t"),
             ('<article><p>one</p><div class="comments"><p>' + "no " * 99 + "</p></div><p>two</p></article>", "one two"),
             ('<body class="comments-open"><article class="post comments-open"><p>kept</p><article class="comment">no</article></article>', "kept"),
             ("<a " + "x" * 30 + " \"'" * 2000, ""), ("<article><p>" + "long " * 200_000 + "</article>", " ".join(["long"] * 200_000))]
    rows = {r["page_id"]: r for r in htmltext.extract(pages_frame(spark, [(n, None, c[0]) for n, c in enumerate(cases)])).collect()}
    assert [rows[n]["text"] for n in range(len(cases)) if n != 9] == [c[1] for n, c in enumerate(cases) if n != 9]
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert htmltext.extract(pages_frame(spark, [])).count() == 0


STORY = [f"Paragraph {n} of the story goes on for a good while and tells what happened on that day in the town." for n in range(4)]


def test_html_article_used_for_cards():
    story = "".join(f"<p>{t}</p>" for t in STORY)
    card = "<article><h3><a href=x>Another story</a></h3><p>A short teaser.</p></article>"
    assert htmltext.main_text(f"<body><div>{story}</div><div>{card * 3}</div></body>") == " ".join(STORY)
    # lines outside surge beside an article, and every line of the article is kept
    page = f"<body><div><p>{STORY[0]}</p></div><p><a href=x>menu</a></p><main><h1>Hi</h1><article><p>a</p><nav>n</nav>{story}</article><p>z</p></main></body>"
    assert htmltext.main_text(page) == " ".join([STORY[0], "Hi", "a", *STORY, "z"])


@pytest.mark.parametrize("wrap", ['div class="content has-sidebar"', 'div id="no-sidebar"', 'section class="post comments-open"',
                                  'div class="layout sidebar"', 'div class="sidebar"', "form"])
def test_html_wrappers_with_noise_names(wrap):
    story, end = "".join(f"<p>{t}</p>" for t in STORY), f"</{wrap.split()[0]}>"
    for page in (f"<{wrap}>{story}{end}", f"<{wrap}><article>{story}</article>{end}", f"<div><{wrap}><main>{story}</main>{end}</div>"):
        assert htmltext.main_text(f"<body><nav>menu</nav>{page}<footer>f</footer></body>") == " ".join(STORY)
    for noise in ('div class="sidebar"', 'div class="site-footer"', 'div id="cookie-notice"'):
        assert htmltext.main_text(f"<body><{noise}><p>{STORY[0]}</p></div><div>{story}</div></body>") == " ".join(STORY)


@pytest.mark.parametrize("left_out", ["<div class=ad>x</div>", '<div class="notice">x</div>', "<video>x</video>", "<div class=ad>x</div><aside>y</aside>"])
def test_html_short_text_after_what_stands_in_the_story(left_out):
    first = f"<p>{STORY[0]}</p>"
    assert htmltext.main_text(f"<div>{first}{left_out}<p>The end.</p></div>") == f"{STORY[0]} The end."
    assert htmltext.main_text(f"<div><h1>Title</h1>{left_out}{first}</div>") == f"Title {STORY[0]}"
    assert htmltext.main_text(f"<body><div>{first}{left_out}</div><p>Elsewhere.</p></body>") == STORY[0]
    assert htmltext.main_text(f"<body><div>{first}</div><footer>f</footer><p>Elsewhere.</p></body>") == STORY[0]


def test_warc(spark):
    big = "<p>é" + "x" * 200
    rows = [(3, "http://a.com/1", big), (2, "http://a.com/1", big), (9, None, big), (4, "http://b.org/?q=\n1", "short"), (5, "u", "short"),
            (6, "http://c.net", None), (7, "http://c.net", ""), (8, "http://c.net", "y" * 300_000), (2, "http://a.com/1", big), (None, "http://n.n/", big)]
    pages = pages_frame(spark, rows)
    archive = warc.write(pages)
    wanted = pages.select(warc.capture_key(F.col("url")).alias("key"), "page_id").distinct()
    got = warc.read(archive.lookup(wanted)).collect()
    assert len(got) == len(rows)
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in got) == sorted(
        [(3, "revisit", 2), (2, "response", 0), (2, "response", 0), (9, "revisit", 2), (0, "revisit", 2)] + [(k, "response", 0) for k in (4, 5, 6, 7, 8)])
    assert {r["page_id"]: r["payload_bytes"] for r in got} == {i: len((h or "").encode()) for i, _, h in rows}
    assert archive.lookup(wanted.where("false")).count() == 0
    assert archive.lookup(spark.createDataFrame([("com,a)/zzz", 1), ("", 77)], "key string, page_id long")).count() == 0
    empty = warc.write(pages_frame(spark, []))
    assert empty.lookup(wanted).count() == 0


def test_warc_blocks(spark, monkeypatch):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.com/"), F.col("id") % 7).alias("url"), F.lit("x").alias("html"))
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    archive = warc.write(pages)
    keys = pages.select(warc.capture_key(F.col("url")).alias("key"), "page_id")
    assert sorted(r["page_id"] for r in archive.lookup(keys).collect()) == list(range(500))
    assert archive.lookup(keys.where("page_id % 50 = 7")).count() == 10


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("example.com", "/en/", "allow"), ("www.example.com", "/en/", "allow"),
         ("com", "/en/deep/er", "block"), ("org", "", "block"), ("é.net", "/", "block")]


def brute_rule(host, path):
    fits = {(h, p) for h, p, _ in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)}
    verdict = {(h, p): max(v for a, b, v in RULES if (a, b) == (h, p)) for h, p in fits}
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), verdict[r]), default=None)
    return (best[0] + best[1], verdict[best]) if best else (None, "allow")


def test_urls(spark):
    hosts = ["com", "example.com", "www.example.com", "a.b.example.com", "other.com", "notexample.com", "x.org", "é.net", "EXAMPLE.com", "h:80", ""]
    paths = ["", "/", "/en/", "/en", "/en/deep/er/x", "/fr/?q=/en/", "/en/#x", "/\x02/\U0001F600"]
    urls = [f"http://{h}{p}" for h, p in itertools.product(hosts, paths)] * 2 + [None, "", "no scheme.com/en/", "a://b://c/"]
    pages = pages_frame(spark, [(n, u, None) for n, u in enumerate(urls)])
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = urlfilter.judge(pages, rules).collect()
    assert len(rows) == len(urls)
    for r in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r["page_id"]] or "")
        host, path = (m[1].lower() if m[1].isascii() else m[1], m[2]) if m else ("", "")
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == (brute_rule(host, path) if host else (None, "allow")), urls[r["page_id"]]
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_licences(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/x", "code"), ("a/b/y", None), ("a/b/z", "more\nAll rights reserved."),
            ("c/n", ""), (None, "Released under the MIT license"), (None, "x"), ("a/x", "code"), ("a/c/LICENSE", "licensed under the Apache License, version 2.0"),
            ("a/c/d/e", "long " * 100_000)]
    files = spark.createDataFrame([(*r, 1, "l", 2) for r in rows], "path string, text string, line int, license string, score int")
    got = [(r["path"], r["license"], r["origin"], r["from_dir"]) for r in licences.scan(files.select("path", "text")).collect()]
    assert sorted(got, key=str) == sorted([
        ("a/LICENSE", "MIT", "own", None), ("a/x", "MIT", "inherited", "a"), ("a/x", "MIT", "inherited", "a"), ("a/b/y", "MIT", "inherited", "a"),
        ("a/b/z", "Proprietary", "own", None), ("c/n", None, None, None), (None, "MIT", "own", None), (None, None, None, None),
        ("a/c/LICENSE", "Apache-2.0", "own", None), ("a/c/d/e", "Apache-2.0", "inherited", "a/c")], key=str)
    assert licences.scan(files.limit(0)).count() == 0
    assert licences.scan(files).count() == len(rows)


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 8))
    rows = [(i, base[i].tolist()) for i in range(60)] + [(100 + i, base[0].tolist()) for i in range(50)]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, [1.0]), (905, []), (0, base[0].tolist()), (None, base[1].tolist())]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, key int, leaf int")
    got = neighbours.search(frame, F.col("vec_id") % 20 == 0, 20).collect()
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and i < 900}
    for q in [i for i in good if i % 20 == 0]:
        exact = {i: float(neighbours.dot(good[q][None], v[None])[0]) for i, v in good.items() if i != q}
        want = sorted(exact.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == want
    assert neighbours.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = neighbours.search(frame.where("vec_id in (0, 1)"), F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 1)]


def test_pipeline_stages_on_odd_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_fingerprint_definition():
    texts = ["A b  c\td", "one two", "x", "Ümlaut B c d", "\x0b\x0c", "é\xa0ü three four five"]
    got = simhash.fingerprints_of(texts).tolist()
    for t, f in zip(texts, got):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        assert f == sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
