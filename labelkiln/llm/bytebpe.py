"""Byte-level BPE encoding and decoding with batched merge rounds in numpy.

The vocabulary file gives tokens, merges in order of rank, and added
tokens; nothing is trained.  A text is cut at added tokens, then into words
by the pre-tokenizer's pattern.  Words that are not known yet are solved
together: the symbols of all of them lie in one flat array, and a round

* takes the lowest rank of each word over its adjacent pairs,
* merges every pair of that rank (from the left, where pairs overlap),
* looks up the ranks of the pairs that are new, by binary search over the
  sorted pair keys ``left * width + right``.

Words without a pair that merges leave the array.  Merging all pairs of a
rank at once equals merging one after the other if a merge's parts come
from merges of lower rank only; that is checked when the file is loaded,
and a file that fails it is merged one pair a word and round.  Words of more
than ``LONG_WORD`` bytes, where rounds would each touch the whole word, are
merged through a heap of their pairs instead, by the same rule.

Texts are cut at blanks into parts first (``pretokens``), and the ids of
parts met before are looked up.

Decoding joins the bytes of the tokens (added tokens included; unknown ids
are left out) and reads them as UTF-8, broken sequences as U+FFFD.

Edge cases: null and empty texts have no ids; ``encode`` keeps null ids for
null texts apart from empty ones; added tokens in a text become their own
id, the leftmost first, the longer of two; texts and words of any length
are encoded whole; null doc ids and repeated rows keep their rows; other
columns are only passed on when asked for.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from . import pretokens
from .common import bounded
from .pretokens import Table

#: Bytes up to which a word takes part in the rounds.
LONG_WORD = 2_000
#: Characters of texts handled at once.
CHARS = 4_000_000
NO_RANK = np.iinfo(np.int32).max

def byte_letters() -> list[str]:
    """The letter a byte-level vocabulary writes for each byte: itself if it is visible, else the next from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in visible)}
    return [hidden.get(b, chr(b)) for b in range(256)]


class Bpe:
    """Vocabulary, sorted pair keys, and the parts known so far."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model, pre = d["model"], d.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if (model.get("type", "BPE") != "BPE" or odd or d.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or (d.get("decoder") or {}).get("type") != "ByteLevel"):
            raise ValueError(f"not a plain byte-level BPE file: {odd or pre}")
        vocab = model["vocab"]
        added = {t["content"]: t["id"] for t in d.get("added_tokens", [])}
        if any(t.get(k) for t in d.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that take white space with them, or whole words only, are not supported")
        letters = byte_letters()
        self.byte_id = np.array([vocab[c] for c in letters], np.int32)
        self.width = max([*vocab.values(), *added.values()]) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        key, rank = left * self.width + right, np.arange(len(pairs), dtype=np.int32)
        order = np.lexsort((-rank, key))  # of a repeated pair the last counts
        order = order[np.concatenate(([True], key[order][1:] != key[order][:-1]))] if len(order) else order
        self.pair_key, self.pair_rank = key[order], rank[order]
        last = np.full(self.width, -1, np.int64)  # the highest rank that makes a token
        np.maximum.at(last, self.made, rank)
        self.all_at_once = bool((last[left] < rank).all() and (last[right] < rank).all())
        back = {c: b for b, c in enumerate(letters)}
        raw = [b""] * self.width
        for token, i in [*vocab.items(), *added.items()]:
            raw[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.kind = np.dtype("<u2") if self.width <= 1 << 16 else np.dtype("<u4")
        self.table = Table(self._of_letters, lambda words: self.merge([w.encode("utf-8", "surrogatepass") for w in words]),
                           {t: np.array([i], self.kind).tobytes() for t, i in added.items()}, self.kind)

    def _of_letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self.merge([b" " + w for w in words.cast(pa.large_binary()).to_pylist()])
        return np.frombuffer(b"".join(ids), self.kind), np.array(list(map(len, ids)), np.int64) // self.kind.itemsize

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian integers of ``kind``; none for null and empty texts."""
        ids, cuts = self.table.encode(pa.array(texts, pa.large_string()))
        flat, at = ids.tobytes(), (cuts * self.kind.itemsize).tolist()
        return [flat[a:b] for a, b in zip(at, at[1:])]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pair_key):
            return np.full(len(left), NO_RANK, np.int32)
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NO_RANK)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian integers of ``kind``."""
        size = np.array([len(w) for w in words], np.int64)
        short = np.flatnonzero((size > 0) & (size <= LONG_WORD))
        out = [b""] * len(words)
        for k in np.flatnonzero(size > LONG_WORD).tolist():
            out[k] = self._merge_long(words[k])
        for k, ids in zip(short.tolist(), self._rounds([words[k] for k in short.tolist()], size[short])):
            out[k] = ids
        return out

    def _rounds(self, words: list[bytes], size: np.ndarray) -> list[bytes]:
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.arange(len(words))  # of the words still in the arrays
        last = np.zeros(len(symbol), bool)  # symbols that end a word
        last[np.cumsum(size) - 1] = True
        rank = np.full(len(symbol), NO_RANK, np.int32)
        inner = np.flatnonzero(~last)
        rank[inner] = self._rank(symbol[inner], symbol[inner + 1])
        done_ids, done_owner, done_size = [], [], []
        while len(owner):
            start = np.cumsum(size) - size
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == NO_RANK
            if done.any():
                of_done = np.repeat(done, size)
                done_ids.append(symbol[of_done])
                done_owner.append(owner[done])
                done_size.append(size[done])
                live = ~of_done
                symbol, rank, last, owner, size, lowest = symbol[live], rank[live], last[live], owner[~done], size[~done], lowest[~done]
                if not len(owner):
                    break
                start = np.cumsum(size) - size
            hit = rank == np.repeat(lowest, size)
            at = np.flatnonzero(hit)
            if self.all_at_once:  # in a run of overlapping pairs every second one, from the left
                opens = np.concatenate(([True], np.diff(at) != 1))
                first = np.maximum.accumulate(np.where(opens, at, 0))
                at = at[(at - first) % 2 == 0]
            else:
                in_word = np.searchsorted(start, at, "right")
                at = at[np.concatenate(([True], np.diff(in_word) != 0))]
            symbol[at] = self.made[rank[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            gone = np.zeros(len(symbol), np.int64)
            gone[at] = 1
            size = size - np.add.reduceat(gone, start)
            new = np.zeros(len(symbol), bool)  # symbols whose pair with the next has changed
            new[at] = True
            place = np.cumsum(keep)[at] - 1
            symbol, rank, last, new = symbol[keep], rank[keep], last[keep], new[keep]
            prior = place[place > 0] - 1
            new[prior[~last[prior]]] = True
            rank[last] = NO_RANK
            look = np.flatnonzero(new & ~last)
            rank[look] = self._rank(symbol[look], symbol[look + 1])
        if not done_owner:
            return []
        owner, size = np.concatenate(done_owner), np.concatenate(done_size) * self.kind.itemsize
        flat, end = np.concatenate(done_ids).astype(self.kind).tobytes(), np.cumsum(size)
        out = [b""] * len(words)
        for k, a, b in zip(owner.tolist(), (end - size).tolist(), end.tolist()):
            out[k] = flat[a:b]
        return out

    def _merge_long(self, word: bytes) -> bytes:
        symbol = self.byte_id[np.frombuffer(word, np.uint8)]
        n = len(symbol)
        rank = self._rank(symbol[:-1], symbol[1:])
        symbol = symbol.tolist()
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        at = np.flatnonzero(rank != NO_RANK)
        heap = list(zip(rank[at].tolist(), at.tolist(), [symbol[i] for i in at.tolist()], [symbol[i + 1] for i in at.tolist()]))
        heapq.heapify(heap)
        ranks = self._rank_of()
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[i] < n:
                prior[after[i]] = i
            for x, y in ((prior[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := ranks.get(symbol[x] * self.width + symbol[y])) is not None:
                    heapq.heappush(heap, (q, x, symbol[x], symbol[y]))
        return np.array([s for s in symbol if s >= 0], self.kind).tobytes()

    def _rank_of(self) -> dict[int, int]:
        if not hasattr(self, "_ranks"):
            self._ranks = dict(zip(self.pair_key.tolist(), self.pair_rank.tolist()))
        return self._ranks

    def decode_bytes(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """Bytes of the tokens of each of the sequences ``ids[cuts[k]:cuts[k + 1]]``."""
        fit = (ids >= 0) & (ids < self.width)
        wide = np.where(fit, ids, 0).astype(np.int64)
        size = np.where(fit, self.raw_size[wide], 0)
        end = np.cumsum(size)
        from_ = np.repeat(self.raw_start[wide] - (end - size), size)
        flat = self.raw[from_ + np.arange(len(from_))].tobytes()
        at = np.concatenate(([0], end))[cuts].tolist()
        return [flat[a:b] for a, b in zip(at, at[1:])]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return self.decode_bytes(ids, np.array([0, len(ids)]))[0].decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _bpe(spec: str) -> Bpe:
    """One vocabulary a worker process, so that parts stay known from task to task."""
    return Bpe(spec)


def read(path: str) -> str:
    """The text of a vocabulary file, checked; its size does not depend on the corpus."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    Bpe(spec)
    return spec


def _rows(docs: DataFrame, spec: str, keep: list[str], text_col: str, fields: list[StructField], columns) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    frame = docs.select(*[f"`{c}`" for c in keep], F.col(text_col).alias("__text"))
    names = [*keep, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _bpe(shared.value)
        for b in batches:
            texts = b.column(len(keep))
            for lo, hi in pretokens.slices(texts, CHARS):
                ids, cuts = own.table.encode(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(lo, hi - lo) for k in range(len(keep))),
                                                  *columns(own, ids.astype("<u4"), cuts, texts.slice(lo, hi - lo))], names=names)
    return bounded(frame).mapInArrow(run, StructType([*frame.schema.fields[:-1], *fields]))


def encode(docs: DataFrame, spec: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``ids array<int>``, null for null texts."""
    def columns(own: Bpe, ids: np.ndarray, cuts: np.ndarray, texts: pa.Array) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32)),
                                         mask=texts.is_null())]
    return _rows(docs, spec, keep, text_col, [StructField("ids", ArrayType(IntegerType()))], columns)


def round_trip(docs: DataFrame, spec: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep``, the number of ids, and SHA-256 of the ids (unsigned 32-bit, little-endian) and of the text decoded from them."""
    def columns(own: Bpe, ids: np.ndarray, cuts: np.ndarray, texts: pa.Array) -> list[pa.Array]:
        raw, at = ids.tobytes(), (cuts * 4).tolist()
        decoded = [d.decode("utf-8", "replace").encode() for d in own.decode_bytes(ids.astype(np.int64), cuts)]
        return [pa.array(np.diff(cuts)), pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])]),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded])]
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _rows(docs, spec, keep, text_col, fields, columns)


def decode(rows: DataFrame, spec: str, keep: list[str], ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``rows`` and the text of their ids; null ids give a null text, null elements are left out."""
    shared = rows.sparkSession.sparkContext.broadcast(spec)
    frame = rows.select(*[f"`{c}`" for c in keep], F.filter(F.col(ids_col).cast("array<int>"), lambda x: x.isNotNull()).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _bpe(shared.value)
        for b in batches:
            texts = [None if v is None else own.decode(v) for v in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, text_col])
    return bounded(frame).mapInArrow(run, StructType([*frame.schema.fields[:-1], StructField(text_col, StringType())]))
