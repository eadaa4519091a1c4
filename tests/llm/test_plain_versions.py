"""Language ID and HTML extraction against plain versions: dictionaries and loops over one text at a time."""

import math
from collections import Counter

import numpy as np
import pytest

from labelkiln.llm import htmltext, langid, queries
from labelkiln.llm.common import table

MORE = "/root/testdata/sf0.01"
M32 = 0xFFFFFFFF


def plain_grams(text):
    """(bin -> count, letters): hashed 1 to 3-grams, runs of non-letters being one blank, unigrams of letters only."""
    out, code = [], [" "]
    for c in " " + (text or "").lower() + " ":
        if c.isalpha() or code[-1] != " ":
            code.append(c if c.isalpha() else " ")
    for i, c in enumerate(code):
        h1 = ord(c) * 2654435761 & M32
        if c != " ":
            out.append(h1 >> 20)
        if i + 1 < len(code):
            h2 = (h1 ^ (ord(code[i + 1]) + 0x9E3779B9 & M32)) * 2246822519 & M32
            out.append(h2 >> 20)
            if i + 2 < len(code):
                out.append((h2 ^ (ord(code[i + 2]) + 0x85EBCA6B & M32)) * 3266489917 % (1 << 32) >> 20)
    return Counter(out), sum(c != " " for c in code)


def plain_prediction(text, model):
    grams, letters = plain_grams(text)
    if not letters:
        return "und", 0.0, True, 0.0
    v = {b: math.sqrt(n) * float(model.idf[b]) for b, n in grams.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    cos = [sum(x * float(c[b]) for b, x in v.items()) / norm for c in model.centroids]
    best = max(range(len(cos)), key=cos.__getitem__)
    score = min(max(cos[best], 0.0), 1.0)
    # the bound between the two lengths around, by the logarithm
    at = [math.log(n) for n in langid.LENGTHS]
    n = min(max(math.log(letters), at[0]), at[-1])
    k = max(i for i in range(len(at) - 1) if at[i] <= n)
    part = (n - at[k]) / (at[k + 1] - at[k])
    bound = float(model.radius[best][k]) * (1 - part) + float(model.radius[best][k + 1]) * part
    return model.langs[best], score, 1 - score > bound and letters >= langid.LENGTHS[0], bound


def test_language_equals_plain_nearest_centroid(spark):
    docs = table(spark, MORE, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op2_language_id(spark, MORE).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        lang, score, rejected, bound = plain_prediction(texts[r["doc_id"]], model)
        assert abs(r["score"] - score) < 1e-4, r
        if r["lang_pred"] != lang:  # only where two centroids are equally near
            grams, _ = plain_grams(texts[r["doc_id"]])
            assert abs(score - r["score"]) < 1e-5
        assert r["rejected"] == rejected or abs(1 - score - bound) < 1e-4, r


def test_language_ties_go_to_the_first_centroid():
    model = langid.Model(np.ones(langid.DIM, np.float32), ["a", "b"], np.ones((2, langid.DIM), np.float32) / math.sqrt(langid.DIM),
                         np.full((2, len(langid.LENGTHS)), 0.99, np.float32))
    assert [f[0] for f in langid.predict_texts(["some text", "other words here"], model)] == ["a", "a"]


def plain_main_text(page):
    """The sweep over line blocks, one line after the other."""
    texts, weights = htmltext.lines_of(page) if page else ([], [])
    n = len(texts)
    block = [sum(weights[i:i + htmltext.WINDOW]) for i in range(n)]
    surge = min(htmltext.SURGE, max(block, default=0))
    kept, inside, stretch = [], False, []

    def end():
        heavy = [k for k in stretch if weights[k]]
        kept.extend(texts[k] for k in stretch if texts[k] and heavy[0] <= k <= heavy[-1])
        stretch.clear()
    for i in range(n):
        if surge and not inside and block[i] >= surge:
            inside = True
        if inside and not block[i]:
            end()
            inside = False
        if inside:
            stretch.append(i)
    if inside:
        end()
    return " ".join(kept)


ODD_PAGES = [None, "", "plain", "<p>" + "a " * 60 + "<p>b<ul><li><a href=x>m</a><li><a>n</a></ul><p>c",
             "<div><p>" + "long text " * 20 + "</p></div><nav>menu</nav><div><p>short</p></div><div>" + "second part " * 30 + "</div>",
             "<article><p>x</p></article>" * 5 + "<div>" + "body " * 100 + "</div>", "<p>" + "w" * 79 + "<p><a>link</a>", "<table><tr><td>a<td>b</table>"]


@pytest.mark.parametrize("source", ["pages", "odd"])
def test_html_equals_plain_sweep(spark, source):
    if source == "odd":
        for p in ODD_PAGES:
            assert htmltext.main_text(p) == plain_main_text(p)
        return
    pages = {r["page_id"]: r["html"] for r in table(spark, MORE, "pages").collect()}
    rows = queries.op4_html_extraction(spark, MORE).collect()
    assert {r["page_id"] for r in rows} == set(pages)
    for r in rows:
        assert r["text"] == plain_main_text(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])
