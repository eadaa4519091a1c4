"""Phrase collocations: exact counts of word sequences in a HAT-trie, and their association scores.

Sequences are counted by tasks in a HAT-trie: a shallow trie over word ids
whose leaves are hash containers of the rest of the sequence.  A container
of more than ``BURST`` sequences bursts into a node with a container for
each next word.  When a trie holds more than ``ENTRIES`` sequences, its
largest subtrees are spilled whole, as runs sorted by phrase, cut by prefix
partition (the leading bits of a hash of the first two words).  The runs of
a prefix partition meet in one task, which merges one partition after the
other.

A phrase is as rare as its rarest part, so only sequences all of whose words
and neighbouring pairs reach the least count need the trie.  Three passes find
out: the first counts hashes of words, the second hashes of pairs of words
that passed, the third hashes of longer sequences of such pairs.  Tasks deal their sorted hashes out by the leading bits, the
sums that reach the least count become a bitmap of ``GATE_BITS`` bits,
whatever the size of the corpus, and this gate is broadcast.  A hash or bit
that several share only lets more into the trie, whose counts are exact and
cut at the least count again.

Text is lower-cased in A-Z and split at ``PIECE_ENDS`` and the ASCII line ends into
pieces, and these at blanks and tabs into words.  Counts and totals are per
language.

Edge cases: a null text is empty, a null language is ``und`` (as is a
language of that name); texts of any length are read whole; repeated rows
count each time; phrases of equal score and count are ordered by their
UTF-8 bytes; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import bounded, pylist, settle, slices

PIECE_ENDS = ".,;:!?"
#: Sequences a container holds before it bursts, and depth of the trie below the first word.
BURST, DEPTH = 4_096, 3
#: Sequences, or words, a task holds before it spills.
ENTRIES = 400_000
GATE_BITS = 1 << 26
#: Leading bits of a hash that are counted, and hashes a task holds before it merges or deals them out.
KEY_BITS = 48
HASHES = 3_000_000
CHARS = 4_000_000

BREAK, BLANK = -1, -2  # in arrays of word ids: the end of a piece or a word that is not counted, and no word at all
#: Exact as long as scale * a * n and l * r stay below 10^38.
SCORE = ("(cast({scale} as decimal(4, 0)) * (cast({a} as decimal(17, 0)) * cast({n} as decimal(17, 0))))"
         " div (cast({l} as decimal(18, 0)) * cast({r} as decimal(18, 0)))")
_RUNS = "part long, keys array<binary>, counts array<long>"


def _table() -> bytes:
    t = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        t[c] = c + 32
    t[9] = 32
    for c in [*PIECE_ENDS.encode(), 10, 11, 12, 13]:
        t[c] = 10
    return bytes(t)


_FOLD = _table()


def folded(texts: list) -> bytes:
    """The texts, lower-cased, a line feed behind each piece and a blank or line feed behind each word."""
    return "\n".join([t for t in texts if t]).encode("utf-8", "surrogatepass").translate(_FOLD)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\t" + word)


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def in_gate(gate: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes >> np.uint64(64 - KEY_BITS)) & np.uint64(GATE_BITS - 1)
    return (gate[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0


class Ids:
    """Word ids of a task: one number for each (language, word) that the gate lets through."""

    def __init__(self, gate: np.ndarray):
        self.gate, self.by_lang = gate, {}
        self.langs: list[str] = []
        self.words: list[bytes] = []
        self.hashes = np.zeros(1024, np.uint64)

    def size(self) -> int:
        return sum(map(len, self.by_lang.values()))

    def of(self, lang: str, texts: list) -> np.ndarray:
        """Ids of the words of the texts in order, with ``BREAK`` between pieces and for words not let through."""
        if lang not in self.by_lang:
            self.by_lang[lang] = _Lookup(self, lang)
        words = folded(texts).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.by_lang[lang].__getitem__, words), np.int32, len(words))
        return ids[ids != BLANK]

    def add(self, lang: str, word: bytes) -> int:
        h = word_hash(lang, word)
        bit = h >> 64 - KEY_BITS & GATE_BITS - 1
        if not int(self.gate[bit >> 6]) >> (bit & 63) & 1:
            return BREAK
        i = len(self.words)
        if i == len(self.hashes):
            self.hashes = np.concatenate((self.hashes, np.zeros(i, np.uint64)))
        self.hashes[i] = h
        self.langs.append(lang)
        self.words.append(word)
        return i


class _Lookup(dict):
    def __init__(self, ids: Ids, lang: str):
        super().__init__({b"": BLANK, b"\n": BREAK})
        self.ids, self.lang = ids, lang

    def __missing__(self, word: bytes) -> int:
        self[word] = i = self.ids.add(self.lang, word)
        return i


class Node:
    """Burst container: children by next word, and the count of the sequence that ends here."""

    __slots__ = ("children", "here")

    def __init__(self):
        self.children: dict[int, Node | dict[bytes, int]] = {}
        self.here = 0


class HatTrie:
    """Counts of id sequences.  Containers map the rest of a sequence (its ids as bytes) to its count."""

    def __init__(self):
        self.root: dict[int, Node | dict[bytes, int]] = {}
        self.held: Counter[int] = Counter()  # sequences below each first word
        self.entries = 0

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct sequences of one length, sorted by their ids."""
        rows = np.ascontiguousarray(rows, "<i4")
        for first, lo, hi in _groups(rows[:, 0]):
            node = self.root.get(first)
            if node is None:
                node = self.root[first] = {}
            node, new = self._add(node, rows[lo:hi], 1, counts[lo:hi], 1)
            self.root[first] = node
            self.held[first] += new
            self.entries += new

    def _add(self, node, rows: np.ndarray, at: int, counts: np.ndarray, depth: int):
        """Add sequences whose ids before ``at`` lead to this node; (the node in its place, new sequences)."""
        if isinstance(node, Node):
            if at == rows.shape[1]:
                new = int(node.here == 0)
                node.here += int(counts.sum())
                return node, new
            new = 0
            for word, lo, hi in _groups(rows[:, at]):
                child, more = self._add(node.children.get(word, {}), rows[lo:hi], at + 1, counts[lo:hi], depth + 1)
                node.children[word] = child
                new += more
            return node, new
        before = len(node)
        rest = np.ascontiguousarray(rows[:, at:])
        keys = rest.view(f"V{4 * rest.shape[1]}").ravel().tolist() if rest.shape[1] else [b""] * len(rows)
        get = node.get
        for k, c in zip(keys, counts.tolist()):
            node[k] = get(k, 0) + c
        new = len(node) - before
        return (self._burst(node, depth) if len(node) > BURST and depth < DEPTH else node), new

    def _burst(self, container: dict[bytes, int], depth: int) -> Node:
        node = Node()
        for k, c in container.items():
            if not k:
                node.here = c
                continue
            node.children.setdefault(int.from_bytes(k[:4], "little"), {})[k[4:]] = c
        for word, child in node.children.items():
            if len(child) > BURST and depth + 1 < DEPTH:
                node.children[word] = self._burst(child, depth + 1)
        return node

    def take(self, room: int) -> Iterator[tuple[bytes, int]]:
        """Remove whole subtrees, the largest first, until at most ``room`` sequences are left; their (ids as bytes, count)."""
        for first, n in self.held.most_common():
            if self.entries <= room:
                return
            yield from _sequences(self.root.pop(first), first.to_bytes(4, "little"))
            self.entries -= self.held.pop(first)


def _groups(sorted_ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(sorted_ids)) + 1).tolist(), len(sorted_ids)]
    return zip(sorted_ids[cuts[:-1]].tolist(), cuts, cuts[1:])


def _sequences(node, prefix: bytes) -> Iterator[tuple[bytes, int]]:
    if isinstance(node, dict):
        for k, c in node.items():
            yield prefix + k, c
        return
    if node.here:
        yield prefix, node.here
    for word, child in node.children.items():
        yield from _sequences(child, prefix + word.to_bytes(4, "little"))


def _runs(found: Iterator[tuple[bytes, int]], ids: Ids, bits: int) -> Iterator[pa.RecordBatch]:
    """The sequences as phrases: for each prefix partition one run, sorted.  A phrase's partition are the leading bits of
    the hash of its first two words; its key is language, tab, phrase (which holds no tab)."""
    by_size: dict[int, tuple[list, list]] = {}
    for k, c in found:
        keys, counts = by_size.setdefault(len(k) // 4, ([], []))
        keys.append(k)
        counts.append(c)
    if not by_size:
        return
    words, langs = pa.array(ids.words, pa.binary()), pa.array(ids.langs, pa.string()).cast(pa.binary())
    join = lambda parts, by: pc.binary_join_element_wise(*parts, pa.scalar(by, pa.binary()))
    key, part, n = [], [], []
    for size, (keys, counts) in by_size.items():
        rows = np.frombuffer(b"".join(keys), "<i4").reshape(-1, size)
        phrase = join([words.take(pa.array(rows[:, k])) for k in range(size)], b" ")
        key.append(join([langs.take(pa.array(rows[:, 0])), phrase], b"\t"))
        h = ids.hashes[rows[:, 0]]
        part.append(((h if size == 1 else pair_hash(h, ids.hashes[rows[:, 1]])) >> np.uint64(64 - bits)).astype(np.int64))
        n.append(np.array(counts, np.int64))
    run = pa.table({"part": np.concatenate(part), "key": pa.concat_arrays(key), "n": np.concatenate(n)}).sort_by([("part", "ascending"), ("key", "ascending")])
    part = run["part"].to_numpy()
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])).astype(np.int32)
    listed = lambda c: pa.ListArray.from_arrays(pa.array(cuts), run[c].combine_chunks())
    yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), listed("key"), listed("n")], names=["part", "keys", "counts"])


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list]]:
    """(language, texts) of a batch, some ``CHARS`` characters at a time."""
    texts: dict[str, list] = {}
    for lang, text in zip(pylist(batch, "lang"), pylist(batch, "text")):
        if text:
            texts.setdefault("und" if lang is None else lang, []).append(text)
    for lang, some in texts.items():
        for lo, hi in slices(some, CHARS):
            yield lang, some[lo:hi]


class Sieve:
    """Sums of hashes, dealt out as one row for each value of the leading ``bits`` bits."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.size = bits, [], 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((hashes >> np.uint64(64 - KEY_BITS), counts.astype(np.int64)))
        self.size += len(hashes)
        if self.size > HASHES:
            merged = summed(self.parts)
            self.parts, self.size = [merged], len(merged[0])
            if self.size > HASHES // 2:
                yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        key, count = summed(self.parts)
        self.parts, self.size = [], 0
        part = (key >> np.uint64(KEY_BITS - self.bits)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        low = key & np.uint64((1 << KEY_BITS - self.bits) - 1)
        rows = [(int(part[a]), _planes(np.diff(low[a:b], prepend=np.uint64(0))), _planes(count[a:b])) for a, b in zip(cuts, cuts[1:])]
        yield _dealt([None] * len(rows), *zip(*rows), [None] * len(rows))


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, count = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(count, first)


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers, all first bytes before all second bytes and so on: the high ones, mostly 0, pack well."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").ravel()


_DEALT = "lang string, part long, keys binary, counts binary, n long"


def _dealt(lang: list, part: list, keys: list, counts: list, n: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(part, pa.int64()), pa.array(keys, pa.binary()),
                                       pa.array(counts, pa.binary()), pa.array(n, pa.int64())], names=["lang", "part", "keys", "counts", "n"])


def _count_words(bits: int):
    """Function for ``mapInArrow``: dealt-out hashes of words, and the number of words of each language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, total = Sieve(bits), Counter()
        counts: dict[str, Counter] = {}

        def hashed() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                total[lang] += c.total()
                yield from sieve.add(np.array([word_hash(lang, w) for w in c], np.uint64), np.array(list(c.values()), np.int64))
            counts.clear()
        for b in batches:
            for lang, texts in _by_lang(b):
                counts.setdefault(lang, Counter()).update(folded(texts).split())
                if sum(map(len, counts.values())) > ENTRIES:
                    yield from hashed()
        yield from hashed()
        yield from sieve.rows()
        some = [(lang, n) for lang, n in total.items() if n]
        yield _dealt([lang for lang, _ in some], *[[None] * len(some)] * 3, [n for _, n in some])
    return run


def _count_pairs(gate, bits: int):
    """Function for ``mapInArrow``: dealt-out hashes of pairs of words that the gate lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sieve = Ids(gate.value), Sieve(bits)
        for b in batches:
            for lang, texts in _by_lang(b):
                ids = own.of(lang, texts)
                at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
                pair, count = np.unique(ids[at].astype(np.int64) << 32 | ids[at + 1], return_counts=True)
                if len(pair):
                    yield from sieve.add(pair_hash(own.hashes[pair >> 32], own.hashes[pair & 0xFFFFFFFF]), count)
                if own.size() > 2 * ENTRIES:
                    own = Ids(gate.value)
        yield from sieve.rows()
    return run


def _gate(dealt: DataFrame, least: int, bits: int) -> np.ndarray:
    """Bitmap of the hashes whose sum reaches ``least``: at most GATE_BITS / 64 numbers come to the driver."""
    def flush(part: int, keys: list, counts: list) -> Iterator[pa.RecordBatch]:
        key, count = summed([(np.cumsum(_numbers(k), dtype=np.uint64), _numbers(c).astype(np.int64)) for k, c in zip(keys, counts)])
        bit = np.unique((key[count >= least] | np.uint64(part << KEY_BITS - bits)) & np.uint64(GATE_BITS - 1))
        if len(bit):
            place, first = np.unique(bit >> np.uint64(6), return_index=True)
            flags = np.bitwise_or.reduceat(np.uint64(1) << (bit & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(flags.view(np.int64))], names=["place", "flags"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, counts = None, [], []
        for b in batches:
            for p, k, c in zip(pylist(b, "part"), pylist(b, "keys"), pylist(b, "counts")):
                if p != part and keys:
                    yield from flush(part, keys, counts)
                    keys, counts = [], []
                part = p
                keys.append(k)
                counts.append(c)
        if keys:
            yield from flush(part, keys, counts)
    rows = dealt.where("part IS NOT NULL").select("part", "keys", "counts").repartition("part").sortWithinPartitions("part")
    found = bounded(rows).mapInArrow(run, "place long, flags long").groupBy("place").agg(F.expr("bit_or(flags)").alias("flags")).toArrow()
    gate = np.zeros(GATE_BITS // 64, np.uint64)
    gate[found["place"].to_numpy()] = found["flags"].to_numpy().view(np.uint64)
    return gate


def _chains(ids: np.ndarray, own: Ids, longest: int, pairs: np.ndarray, longer: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, hashes) of the sequences all of whose words and neighbouring pairs, and prefixes if ``longer`` is given, are let through."""
    at = np.flatnonzero(ids >= 0)
    h = np.zeros(len(ids), np.uint64)
    h[at] = own.hashes[ids[at]]
    linked = np.zeros(len(ids), bool)  # places whose pair with the next is let through
    yield 1, at, h[at]
    for size in range(2, longest + 1):
        at = at[at + size - 1 < len(ids)]
        at = at[ids[at + 1] >= 0] if size == 2 else at[linked[at + size - 2]]
        hashes = pair_hash(h[at], own.hashes[ids[at + size - 1]])
        if size == 2 or longer is not None:
            through = in_gate(pairs if size == 2 else longer, hashes)
            at, hashes = at[through], hashes[through]
        if size == 2:
            linked[at] = True
        h[at] = hashes
        yield size, at, hashes


def _count_longer(gate, pairs, bits: int, longest: int):
    """Function for ``mapInArrow``: dealt-out hashes of sequences of three words and more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sieve = Ids(gate.value), Sieve(bits)
        for b in batches:
            for lang, texts in _by_lang(b):
                for size, _, hashes in _chains(own.of(lang, texts), own, longest, pairs.value, None):
                    if size > 2 and len(hashes):
                        yield from sieve.add(*np.unique(hashes, return_counts=True))
                if own.size() > 2 * ENTRIES:
                    own = Ids(gate.value)
        yield from sieve.rows()
    return run


def _count_sequences(gate, pairs, longer, bits: int, longest: int):
    """Function for ``mapInArrow`` that counts sequences in a HAT-trie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trie = Ids(gate.value), HatTrie()
        for b in batches:
            for lang, texts in _by_lang(b):
                ids = own.of(lang, texts)
                code = np.zeros(len(ids), np.int64)  # number of the sequence that starts at a place
                for size, at, _ in _chains(ids, own, longest, pairs.value, longer.value):
                    key, first, number, count = np.unique(code[at] << 32 | ids[at + size - 1], return_index=True, return_inverse=True, return_counts=True)
                    code[at] = number
                    if len(key):
                        rows = ids[at[first, None] + np.arange(size)]
                        order = np.lexsort(rows.T[::-1])
                        trie.add(rows[order], count[order])
                    if trie.entries > ENTRIES:
                        yield from _runs(trie.take(ENTRIES // 2), own, bits)
                if own.size() > 2 * ENTRIES:
                    yield from _runs(trie.take(0), own, bits)
                    own = Ids(gate.value)
        yield from _runs(trie.take(0), own, bits)
    return run


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of the phrases whose counts in all runs reach ``least``: one prefix partition after the other."""
    def flush(keys: list, counts: list) -> Iterator[pa.RecordBatch]:
        t = pa.table({"key": pa.concat_arrays(keys), "n": pa.concat_arrays(counts)}).group_by("key").aggregate([("n", "sum")])
        t = t.filter(pc.greater_equal(t["n_sum"], least))
        named = [k.decode("utf-8", "surrogatepass").rpartition("\t") for k in t["key"].to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in named], pa.string()), pa.array([k[2] for k in named], pa.string()),
                                          t["n_sum"].combine_chunks().cast(pa.int64())], names=["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, counts = None, [], []
        for b in batches:
            for k, p in enumerate(pylist(b, "part")):
                if p != part and keys:
                    yield from flush(keys, counts)
                    keys, counts = [], []
                part = p
                keys.append(b.column(1)[k].values)
                counts.append(b.column(2)[k].values)
        if keys:
            yield from flush(keys, counts)
    return bounded(runs.repartition("part").sortWithinPartitions("part")).mapInArrow(run, "lang string, phrase string, n long")


def counts(docs: DataFrame, least: int, longest: int, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of at most ``longest`` words with f >= least, (lang, n) of all languages)."""
    context = docs.sparkSession.sparkContext
    texts = bounded(docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))
    bits = min(20, max(8, (8 * texts.rdd.getNumPartitions()).bit_length()))  # hashes of several tasks' worth of text a row group
    words = settle(texts.mapInArrow(_count_words(bits), _DEALT), "word-hashes")
    totals = words.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    gate = context.broadcast(_gate(words, least, bits))
    pairs = context.broadcast(_gate(texts.mapInArrow(_count_pairs(gate, bits), _DEALT), least, bits))
    longer = context.broadcast(_gate(texts.mapInArrow(_count_longer(gate, pairs, bits, longest), _DEALT), least, bits))
    runs = texts.mapInArrow(_count_sequences(gate, pairs, longer, bits, longest), _RUNS)
    found = settle(_merged(runs, least), "sequence-counts")
    return found.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), F.col("n").alias("f")), totals


def mine(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100, scale: int = 1000,
         lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, k): per language the ``top`` phrases by score.

    A phrase of 2 to ``longest`` words with a = f(phrase) >= ``least`` scores
    ``floor(scale * a * n / (l * r))`` at the cut (after k words, into parts
    with counts l and r) where that is lowest; equal cuts: the first.  A phrase
    goes if a longer one with ``100 * f(longer) >= share * a`` holds it: then
    one that is longer by one word does, as no phrase between is rarer.
    """
    frequent, totals = counts(docs, least, longest, lang_col, text_col)
    candidates = frequent.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    inner = (frequent.where("size > 2").withColumn("w", F.split("phrase", " "))
             .select("lang", F.explode(F.expr("array(array_join(slice(w, 1, size - 1), ' '), array_join(slice(w, 2, size - 1), ' '))")).alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = candidates.join(inner, ["lang", "phrase"], "left").where(F.expr(f"longer IS NULL OR 100 * longer < {share} * a")).drop("longer")
    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"), F.expr("array_join(slice(w, k + 1, size - k), ' ')").alias("right"))
    part = lambda name, count: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    scored = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    scored = scored.withColumn("score", F.expr(SCORE.format(scale=scale, a="a", n="n", l="l", r="r")))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "cut.k")
