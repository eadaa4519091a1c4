"""Registered queries against their SQL, brute force, an exact round trip or held-out accuracy."""

import html
import os
import random
import re
import sys
from itertools import product
from types import SimpleNamespace

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from labelkiln.llm import decontaminate, langid, neighbours, queries, sentencepieces
from labelkiln.llm.common import table

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare, duck_conn  # noqa: E402

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    r = compare(spark, duck_conn(SMALL), SimpleNamespace(name=name, fn=queries.QUERIES[name], sql=queries.SQL[name], oracle="S"), SMALL)
    assert r["ok"], r


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(docs):
    """doc_id -> (fingerprint, smallest id reachable) by comparing all pairs."""
    fps = {i: brute_fingerprint(t) for i, t in docs}
    least = {i: i for i in fps}
    changed = True
    near = {i: [j for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2] for i in fps}
    while changed:
        changed = False
        for i in fps:
            m = min(least[j] for j in near[i])
            changed |= m < least[i]
            least[i] = m
    return {i: (f"{fps[i]:016x}", least[i]) for i in fps}


def pairs_of(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]


def test_simhash_against_all_pairs(spark):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op8_simhash(spark, SMALL).collect()}
    assert got == brute_components(pairs_of(spark, SMALL))


def test_simhash_chain_and_dense_group(spark):
    """Fingerprints 1 to 2 bits apart in a chain, and a dense ball, become one component each."""
    from labelkiln.llm import simhash
    chain = [sum(1 << k for k in range(n)) for n in range(0, 33, 2)]
    far = 0xFFFF_FFFF_0000_0000 ^ 0x5555_0000_0000_5555
    ball = [far] + [far ^ (1 << a) for a in range(64)]
    signed = [v - (1 << 64) if v >> 63 else v for v in chain + ball]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), tile=8)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert len({roots.get(v, v) for v in signed[:len(chain)]}) == 1
    assert len({roots.get(v, v) for v in signed[len(chain):]}) == 1
    assert len({roots.get(v, v) for v in signed}) == 2


def test_language_held_out_accuracy(spark):
    rows = queries.op2_language_id(spark, MORE).join(table(spark, MORE, "documents").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert not any(r["rejected"] for r in rows)


#: Latin-script languages that no document is in.
UNLEARNED = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on "
    "toimittava toisiaan kohtaan veljeyden hengessä.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni "
    "postępować wobec innych w duchu braterstwa.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik "
    "zihniyeti ile hareket etmelidirler.",
    "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu. Watu wote "
    "wanastahili haki zote na uhuru wote."]


def test_language_rejects_unlearned_languages_and_noise(spark):
    rng = np.random.default_rng(1)
    letters = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(n)) for n in (60, 600)]
    base64 = ["".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), n)) for n in (400, 4000)]
    docs = table(spark, MORE, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    odd = [*UNLEARNED, *(t * 10 for t in UNLEARNED), *letters, *base64]
    assert all(rejected for _, _, rejected in langid.predict_texts(odd, model))
    kept = [r["text"] for r in docs.where(langid.held_out() & F.col("lang").isNotNull()).collect()]
    assert not any(rejected for _, _, rejected in langid.predict_texts(kept, model))


def plain_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i, j in product(range(1, len(a) + 1), range(1, len(b) + 1)):
        h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        best = max(best, h[i][j])
    return best


def test_alignment_scores():
    rng = np.random.default_rng(1)
    a = [rng.integers(1, 5, rng.integers(1, 9)) for _ in range(60)]
    b = [rng.integers(0, 5, rng.integers(1, 14)) for _ in range(60)]
    assert decontaminate.align(a, b)[0].tolist() == [plain_alignment(x.tolist(), y.tolist()) for x, y in zip(a, b)]


def test_decontamination_against_all_pairs(spark):
    bench = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    docs = pairs_of(spark, SMALL)
    items = decontaminate.Items(bench)
    want = set()
    for doc_id, text in docs:
        ids, _ = items.encode([text])
        share, _ = decontaminate.scored([(t, ids) for t in items.tokens])
        want |= {(doc_id, items.ids[k]) for k in np.flatnonzero(share >= decontaminate.THRESHOLD)}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op6_decontamination(spark, SMALL).collect()}
    assert got == want and got


def test_decontamination_finds_edited_copies(spark):
    rng = random.Random(4)
    bench = [(r["item_id"], r["text"]) for r in table(spark, MORE, "benchmark").collect()]
    clean = [t for _, t in pairs_of(spark, SMALL)][:len(bench)]
    planted = []
    for n, (_, text) in enumerate(bench):
        edited = [rng.choice(["zork", "flim", "quop"]) if rng.random() < 0.15 else w for w in text.split() if rng.random() > 0.05]
        planted.append((n, clean[n % len(clean)] + " " + " ".join(edited) + " " + clean[(n + 3) % len(clean)]))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(
        spark.createDataFrame(planted, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert sum((n, i) in got for n, (i, _) in enumerate(bench)) >= 0.95 * len(bench)


def test_decontamination_finds_edited_copies_beside_exact_ones(spark):
    """Every copy whose alignment with the whole document reaches the threshold and that keeps one n-gram is found."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(4000)]
    bench = [(i, " ".join(rng.sample(vocabulary, 15))) for i in range(60)]
    exact = [f"before {t} after" for _, t in bench for _ in range(10)]
    edited = [" ".join("zork" if rng.random() < 0.25 else w for w in t.split()) for _, t in bench for _ in range(10)]
    rows = list(enumerate(exact + edited))
    items = decontaminate.Items(bench)
    want = set()
    for n, text in rows:
        ids, _ = items.encode([text])
        item = n % len(exact) // 10
        if len(items.hits(ids, items.grams)[0]) and decontaminate.scored([(items.tokens[item], ids)])[0][0] >= decontaminate.THRESHOLD:
            want.add((n, item))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert len(want) > 1000 and got == want


def unigram_model(path):
    """The model file with its type set to unigram, for the reference library's own Viterbi."""
    data = open(path, "rb").read()

    def varint(at):
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at, out = 0, bytearray(data)
    while at < len(data):
        tag, at = varint(at)
        size, at = varint(at)
        if tag >> 3 == 2:  # trainer_spec
            inner, stop = at, at + size
            while inner < stop:
                key, inner = varint(inner)
                if key == 3 << 3:  # model_type
                    out[inner] = 1
                if key & 7 == 0:
                    _, inner = varint(inner)
                elif key & 7 == 2:
                    n, inner = varint(inner)
                    inner += n
                else:
                    inner += 8 if key & 7 == 1 else 4
        at += size
    return bytes(out)


def test_pieces_against_library():
    lib = sentencepiece.SentencePieceProcessor(model_proto=unigram_model(corpus_pipeline.MODEL))
    own = sentencepieces.Pieces.load(corpus_pipeline.MODEL)
    texts = ["Hello world", "the quick brown fox jumps over the lazy dog", "Zugeü für eneré ção und dementsprechend", "internationalization of unbelievable words"]
    # the first of its n best paths; its plain encode() gives a path of lower score for "the"
    assert [np.frombuffer(x, np.int32).tolist() for x in own.encode(texts)] == [lib.nbest_encode_as_ids(t, 2)[0] for t in texts]


def test_viterbi_against_all_paths():
    pieces = ["<unk>"] + [f"<0x{b:02X}>" for b in range(256)] + ["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "é", "éa"]
    scores = [0.0] * 257 + [-3.0, -2.5, -2.0, -3.5, -4.25, -5.0, -3.25, -7.0, -4.0, -4.5]
    own = sentencepieces.Pieces(pieces, scores, ["other"] + ["byte"] * 256 + ["normal"] * 10)
    table_ = {own.raw[i].decode(): scores[i] for i in range(257, 267)}

    def best(t):
        if not t:
            return 0.0
        ends = [table_[t[:n]] + best(t[n:]) for n in range(1, len(t) + 1) if t[:n] in table_]
        return max(ends + ([] if t[:1] in table_ else [own.unknown + best(t[1:])]))

    for n in range(1, 6):
        for letters in product("abé c", repeat=n):
            text = "".join(letters)
            ids = np.frombuffer(own.encode([text])[0], np.int32).tolist()
            assert ids == np.frombuffer(own._solve_one((" " + text).encode()), np.int32).tolist()
            assert own.decode(np.array(ids)) == text
            total = sum(scores[i] for i in ids if i >= 257) + own.unknown * text.count("c")
            assert abs(total - best(" " + text)) < 1e-9, text


def test_pieces_of_all_documents_round_trip(spark):
    rows = queries.op10_sentencepiece(spark, MORE)
    assert rows.where("round_trip").count() == table(spark, MORE, "documents").count() == rows.count()


def test_html_is_the_article(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, MORE, "pages").collect()}
    for r in queries.op4_html_extraction(spark, MORE).collect():
        article = re.search(r"(?s)<article>(.*)</article>", pages[r["page_id"]])[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(/?p|/?h1|br)>", " ", article))).split())


def test_neighbours_recall(spark):
    """A table larger than the floor: recall of the forest against brute force."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16))
    x = (centres[rng.integers(0, 40, 12_000)] + 0.5 * rng.standard_normal((12_000, 16))).astype(np.float32)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.search(frame, F.col("vec_id") % 200 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    s = x[::200].astype(float) @ x.T.astype(float)
    s[np.arange(60), np.arange(0, 12_000, 200)] = -np.inf
    top = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(got[200 * n] & set(t.tolist())) / 20 for n, t in enumerate(top)]) >= 0.9


def test_pipeline_against_brute_force(spark):
    docs = dict(pairs_of(spark, SMALL))
    lang = {r["doc_id"]: r["lang"] for r in table(spark, SMALL, "documents").collect()}
    model = langid.fit(table(spark, SMALL, "documents").where(~langid.held_out()))
    known = {i for i, (_, _, rejected) in zip(docs, langid.predict_texts(list(docs.values()), model)) if not rejected}
    least = brute_components([(i, t) for i, t in docs.items() if i in known])
    first = {i for i, (_, c) in least.items() if c == i}
    items = decontaminate.Items([(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()])
    clean = set()
    for i in first:
        ids, _ = items.encode([docs[i]])
        if decontaminate.scored([(t, ids) for t in items.tokens])[0].max() < decontaminate.THRESHOLD:
            clean.add(i)
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == clean and len(rows) == len(clean)
    assert all(r["round_trip"] and r["lang"] == lang[r["doc_id"]] for r in rows)
