"""Operators 11 to 13: brute force, the library, odd rows, and the paths that only large or hot inputs take."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelkiln.llm import bytebpe, collocations, hardnegatives, pretokens, queries, tokenrecords
from labelkiln.llm.common import table

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# ---- byte-level BPE

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def spec():
    return bytebpe.read(VOCABULARY)


def odd_texts(n=4000):
    rng = random.Random(7)
    fixed = ["", " ", "  ", "a\n <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext", " x", "  x", "x  ", "x \n", "x\n ", "a  b\n\n c \n d",
             "'s 't don't'll I'M", "日本語 テキスト　x", "\x1c \x1d\x00", "a" * 5000, " " * 3000, "\n" * 300 + " " * 7 + "z", "é" * 3000,
             "".join(rng.choice("abcdefghij") for _ in range(6000)), "".join(chr(rng.randrange(0x3000, 0x9000)) for _ in range(2000))]
    return fixed + ["".join(rng.choice(" \n\ta1!'s.é日\xa0<|>") for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_bpe_equals_library(library, spec):
    texts = odd_texts()
    own = bytebpe.Bpe(spec)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, own.kind).tolist() for g in own.encode([None, *texts])] == [[], *want]
    assert [own.decode(w) for w in want] == [library.decode(w, skip_special_tokens=False) for w in want]
    rng = random.Random(1)
    broken = [[rng.randrange(60_000) for _ in range(rng.randint(0, 9))] for _ in range(3000)]  # broken UTF-8 and unknown ids
    assert [own.decode(b) for b in broken] == [library.decode(b, skip_special_tokens=False) for b in broken]


def test_bpe_paths_agree(monkeypatch, spec):
    """Rounds that merge all pairs of a rank, one pair a word, and the heap give the same ids; so does a full table of parts."""
    texts = odd_texts(1500)
    want = bytebpe.Bpe(spec).encode(texts)
    single = bytebpe.Bpe(spec)
    assert single.all_at_once
    single.all_at_once = False
    short = [t for t in texts if len(t) < 100]
    assert single.encode(short) == [w for t, w in zip(texts, want) if len(t) < 100]
    monkeypatch.setattr(bytebpe, "LONG_WORD", 2)
    monkeypatch.setattr(pretokens, "KNOWN", 5)
    monkeypatch.setattr(pretokens, "LONG_PART", 3)
    heap = bytebpe.Bpe(spec)
    assert [g for lo in range(0, len(texts), 100) for g in heap.encode(texts[lo:lo + 100])] == want


def test_words_are_the_libraries(library):
    """Every code point falls into the same class of words as in the library's pre-tokenizer."""
    pattern = pretokens.words_pattern()
    points = [c for c in [*range(0x3100), *range(0xA000, 0xD800), *range(0xF900, 0x20000), 0x2B73A, 0x323B0, 0x3FC3F, 0xE0001]]
    for lo in range(0, len(points), 5000):
        text = "".join(f"a{chr(c)} 1{chr(c)} !{chr(c)}b\n" for c in points[lo:lo + 5000])
        assert [m.span() for m in pattern.finditer(text)] == [span for _, span in library.pre_tokenizer.pre_tokenize_str(text)]


def test_bpe_query(spark, library):
    rows = {r["doc_id"]: r for r in queries.op13_byte_bpe(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (rows[d["doc_id"]]["n_tokens"], rows[d["doc_id"]]["ids_sha256"], rows[d["doc_id"]]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_bpe_frames(spark, spec):
    odd = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "the  cat <|endoftext|>", None), (3, "ab " * 50_000, "z")],
                                "doc_id long, text string, ids string")
    out = bytebpe.encode(odd, spec, ["doc_id"])
    assert {(r["doc_id"], None if r["ids"] is None else len(r["ids"])) for r in out.where("doc_id < 3 or doc_id is null").collect()} == {(1, None), (2, 0), (None, 5)}
    back = bytebpe.decode(out, spec, ["doc_id"])
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back.where("text is not null").collect()) == [(0, "the  cat <|endoftext|>"), (2, ""), (3, "ab " * 50_000)]
    assert bytebpe.round_trip(odd, spec, ["doc_id", "ids"]).count() == 5
    assert bytebpe.round_trip(odd.limit(0), spec, ["doc_id"]).count() == 0


def test_bpe_refuses_other_files():
    with pytest.raises(ValueError):
        bytebpe.read(public_tokenizers.path("word_bpe_49k.json"))


def test_token_records_follow_the_library(library):
    texts = odd_texts(2000)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            own = tokenrecords.Encoder(f.read())
        assert (own.table is None) == name.startswith("word")
        t = Tokenizer.from_file(public_tokenizers.path(name))
        want = [e.ids + [0] for e in t.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(g, own.kind).tolist() for g in own.encode(pa.array(texts), 0)] == want


# ---- hard negatives

def brute_negatives(rows, anchor, k_pos=5, k_neg=10):
    """Every window searched by itself in exact integers; ``rows`` are (id, label, vector)."""
    use = [(i, lab, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, lab, v in rows
           if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, lab, v in use:
        if not anchor(i):
            continue
        scored = [(j, m, sum(a * b for a, b in zip(v, w))) for j, m, w in use if len(w) == len(v)]
        near = sorted(((-s, j) for j, m, s in scored if m == lab and j != i))[:k_pos]
        far = sorted((-s, j) for j, m, s in scored if m != lab)
        for p, j in near:
            window = [(s, n) for s, n in far if 30 * -p <= 100 * -s <= 90 * -p][:k_neg]
            out += [(i, j, r, n, -p, -s) for r, (s, n) in enumerate(window, 1)]
    return sorted(out)


EMB = "vec_id long, label int, embedding array<float>, score double, id long, anchor int, slot string"


def mined(spark, rows, anchor="vec_id % 10 = 0"):
    frame = spark.createDataFrame([(i, lab, v, 0.0, 1, 2, "s") for i, lab, v in rows], EMB)
    return sorted(tuple(r) for r in hardnegatives.mine(frame, F.expr(anchor)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def random_rows(n, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(4)), rng.normal(size=dim).round(1).tolist()) for i in range(n)]


def test_negatives_brute_force(spark):
    rows = random_rows(300) + [(1000, 1, None), (1001, None, [1.0] * 6), (1002, 1, [None] * 6), (1003, 1, [float("inf")] * 6), (None, 1, [1.0] * 6),
                               (1010, 1, []), (1011, 1, []), (1020, 2, [1.0, 2.0]), (1021, 2, [1.0, 2.0]), (1022, 3, [1.0, 1.0])]
    rows += [(2000 + i, i % 2, [1.0] * 6) for i in range(40)]  # ties
    got = mined(spark, rows)
    assert got == brute_negatives(rows, lambda i: i % 10 == 0) and len(got) > 500


def test_negatives_in_blocks_and_tiles(spark, monkeypatch):
    rows = random_rows(400, seed=5)
    monkeypatch.setattr(hardnegatives, "BLOCK_CELLS", 50)
    monkeypatch.setattr(hardnegatives, "TILE_CELLS", 300)
    assert mined(spark, rows) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_beyond_doubles(spark):
    """Sums past 2^53 are exact, and past 2^56 held there."""
    rows = [(0, 1, [3e5, 1e-2]), (1, 1, [3e5, 2.5]), (2, 2, [2e5, 0.5]), (3, 2, [2e5, 0.25]), (4, 2, [1e30, 0.0])]
    got = mined(spark, rows)
    assert got == [r for r in brute_negatives(rows, lambda i: i % 10 == 0)] and len(got) == 2
    assert max(abs(int(x)) for x in hardnegatives.products(np.array([[1e30]]), np.array([[1e30], [-1e30]])).ravel()) == hardnegatives.LIMIT


def test_negatives_edges(spark):
    rows = random_rows(30)
    assert mined(spark, rows[:0] or [(None, None, None)]) == []
    assert mined(spark, rows, "vec_id < 0") == []
    doubled = mined(spark, rows + rows)
    assert {r[0] for r in doubled} <= {0, 10, 20}
    lone = [(0, 1, [1.0, 0.0]), (1, 2, [0.5, 0.0])]  # no other row of the label
    assert mined(spark, lone) == []
    opposite = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 2, [0.0, 1.0]), (3, 1, [0.0, 1.0])]  # scores below and at 0
    assert mined(spark, opposite) == brute_negatives(opposite, lambda i: i % 10 == 0) == [(0, 3, 1, 2, 0, 0)]


def test_negatives_slots_are_disjoint():
    """A task keeps the best rows of each slot, whatever comes first."""
    block = hardnegatives.Block(np.array([7]), np.array([0]), np.array([1]), np.array([1.0]), np.array([0, 1]),
                                np.array([[90, 45]]), np.array([20]), False, 2)
    for order in (range(101), range(100, -1, -1)):
        best = hardnegatives.Best(block)
        for v in order:
            best.add(np.array([v]), np.array([2]), np.array([float(v)]), np.array([0, 1]))
        assert [(r["slot"], r["score"]) for r in best.rows().to_pylist()] == [(0, 90), (0, 89), (1, 45), (1, 44)]


# ---- collocations

def brute_phrases(docs, least, longest=5, top=2000):
    f, total = {}, Counter()
    for lang, text in docs:
        lang = lang or "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + n])] += 1
    out = []
    for lang, c in f.items():
        rows = []
        frequent = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in frequent.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside.get(p[i:j], 0), a)
        for p, a in frequent.items():
            if inside.get(p, -1) >= a:
                continue
            cut = min((int(Fraction(1000 * a * total[lang], c[p[:k]] * c[p[k:]])), k) for k in range(1, len(p)))
            rows.append((-cut[0], -a, " ".join(p).encode(), c[p[:cut[1]]], c[p[cut[1]:]]))
        out += [(lang, rank, p.decode(), -a, left, right, total[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrases(spark, docs, **kw):
    frame = spark.createDataFrame([(i, lang, text, 1, 2, "p") for i, (lang, text) in enumerate(docs)],
                                  "doc_id long, lang string, text string, n long, size int, phrase string")
    return sorted(tuple(r) for r in collocations.mine(frame, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_docs(n, seed=2):
    rng = random.Random(seed)
    words = ["The", "cat", "sat", "On", "a", "mat", "é", "É", "日本", "x\xa0y", "\x1c", "l'eau", "über"]
    mark = ["", "", "", "", ",", ". ", "\n", "\t", "  ", "\x0b", " ;"]
    return [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(mark) + rng.choice([" ", " ", "  ", "\t"]) for _ in range(rng.randint(0, 80))))
            for _ in range(n)]


def test_phrases_brute_force(spark):
    docs = random_docs(400) + [("en", None), ("en", ""), ("fr", " .\n"), ("en", "a b " * 3000), ("es", "uno dos tres " * 40)]
    got = phrases(spark, docs, least=8)
    assert got == brute_phrases(docs, 8) and len(got) > 300
    assert phrases(spark, docs, least=8, top=3, longest=3) == brute_phrases(docs, 8, 3, 3)


def test_phrases_burst_and_spill(spark, monkeypatch):
    """Containers that burst, tries and tables of words that spill many times, and texts counted in slices."""
    monkeypatch.setattr(collocations, "BURST", 3)
    monkeypatch.setattr(collocations, "ENTRIES", 40)
    monkeypatch.setattr(collocations, "CHARS", 300)
    docs = random_docs(300, seed=9)
    frame_rows = [b for lang, text in docs for b in [(lang, text)]]
    batches = [pa.RecordBatch.from_pylist([{"lang": a, "text": t} for a, t in frame_rows[lo:lo + 50]], schema=pa.schema([("lang", pa.string()), ("text", pa.string())]))
               for lo in range(0, len(frame_rows), 50)]

    class Everything:
        value = np.full(collocations.GATE_BITS // 64, ~np.uint64(0))

    out, runs = Counter(), 0
    for b in collocations._count_sequences(Everything, Everything, Everything, 8, 5)(iter(batches)):
        for r in b.to_pylist():
            assert r["keys"] == sorted(r["keys"]) and len(r["keys"]) == len(r["counts"])  # a run is sorted
            runs += 1
            for k, c in zip(r["keys"], r["counts"]):
                lang, _, phrase = k.decode().rpartition("\t")
                out[lang, phrase] += c
    assert runs > 100
    want = Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda x: x[0].lower(), text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 6):
                for i in range(len(w) - size + 1):
                    want["und" if lang is None else lang, " ".join(w[i:i + size])] += 1
    assert out == want
    monkeypatch.setattr(collocations, "HASHES", 20)
    hashes, dealt, totals = Counter(), 0, Counter()
    for b in collocations._count_words(8)(iter(batches)):
        for r in b.to_pylist():
            if r["lang"] is not None:
                totals[r["lang"]] += r["n"]
                continue
            dealt += 1
            for k, c in zip(np.cumsum(collocations._numbers(r["keys"]), dtype=np.uint64).tolist(), collocations._numbers(r["counts"]).tolist()):
                hashes[r["part"] << collocations.KEY_BITS - 8 | k] += c
    single = Counter()
    for (lang, phrase), c in want.items():
        if " " not in phrase:
            single[collocations.word_hash(lang, phrase.encode()) >> 64 - collocations.KEY_BITS] += c
    assert hashes == single and dealt > 30

    def total(run):
        return sum(int(collocations._numbers(r["counts"]).sum()) for b in run(iter(batches)) for r in b.to_pylist())
    by_size = Counter()
    for (_, phrase), c in want.items():
        by_size[phrase.count(" ") + 1] += c
    assert total(collocations._count_pairs(Everything, 8)) == by_size[2]
    assert total(collocations._count_longer(Everything, Everything, 8, 5)) == by_size[3] + by_size[4] + by_size[5]
    assert totals == Counter({lang: sum(c for (a, w), c in want.items() if a == lang and " " not in w) for lang in totals})


def test_phrases_edges(spark):
    assert phrases(spark, [(None, None)]) == []
    tie = [("en", "b c. a b. a c.")] * 10  # equal scores and counts: by phrase
    assert [r[2] for r in sorted(phrases(spark, tie, least=10), key=lambda r: r[1])] == ["a b", "a c", "b c"]
    assert phrases(spark, tie, least=10) == brute_phrases(tie, 10)


def test_phrase_scores_are_exact(spark):
    """Products beyond 64 bits."""
    a, n, left, right = 10**13 - 1, 10**15 - 7, 10**14 - 3, 10**13 + 9
    got = spark.range(1).select(F.expr(collocations.SCORE.format(scale=1000, a=f"{a}L", n=f"{n}L", l=f"{left}L", r=f"{right}L"))).first()[0]
    assert got == 1000 * a * n // (left * right)
