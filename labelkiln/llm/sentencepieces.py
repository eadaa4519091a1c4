"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The model file gives pieces and their scores, which are used as log
scores as they stand; nothing is trained.  The pieces' UTF-8 bytes (the
whitespace marker as a blank) go into a double-array trie.  A text gets
one blank in front and is cut before every blank that follows another
character and around line feeds.  No piece spans such a place (checked
when the model is loaded; otherwise a text stays in one part), so the best
path of the text is exactly the best paths of its parts, and parts that
recur are looked up.  Parts not seen before are solved together with
array operations, one step per byte position.  A character without a
piece of its own falls back to its byte pieces, at ten below the lowest
score of an ordinary piece.

Decoding joins the pieces' bytes and takes the leading blank off; blanks
stand for markers.  A marker character that is itself in the text is
encoded by bytes, so decoding gives back every text exactly.

Edge cases: null text gives null ids and null decoded text, empty text
gives no ids; of paths with equal scores the one whose last piece is
longest is taken; texts of any length are encoded whole; other columns
are not read.  The model (pieces and trie, a few MB fixed by the
vocabulary) is broadcast; the table of known parts holds at most
``KNOWN`` entries a task and is emptied when full, which changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import bounded, slices

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
KNOWN = 200_000
#: Parts of more bytes than this are solved one by one and not kept.
LONG = 128
CHARS = 1_000_000


def double_array(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie: from node s by byte c to t = base[s] + c if check[t] == s; value -1 ends no key."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for key, v in zip(keys, values):
        at = 0
        for c in key:
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
                ends.append(-1)
            at = children[at][c]
        ends[at] = v
    size = 8 * len(children) + 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0] = 1
    free = wide = 257  # first free slot (a base is never negative); where the search for several free slots goes on
    queue = [(0, 0)]
    for node, slot in queue:
        value[slot] = ends[node]
        codes = sorted(children[node])
        if not codes:
            continue
        while taken[free]:
            free += 1
        start = free if len(codes) == 1 else max(free, wide)
        while any(taken[start - codes[0] + c] for c in codes):
            start += 1
        if len(codes) > 1:
            wide = start
        base[slot] = start - codes[0]
        for c in codes:
            to = start - codes[0] + c
            taken[to], check[to] = 1, slot
            queue.append((children[node][c], to))
    last = int(np.flatnonzero(check >= 0).max(initial=0)) + 257
    return base[:last], check[:last], value[:last]


class Pieces:
    """The vocabulary: bytes and score of each piece, byte pieces, and the trie of ordinary pieces."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.raw = [b""] * len(pieces)
        self.byte_ids = np.full(256, -1, np.int32)
        ordinary = []
        for i, (p, kind) in enumerate(zip(pieces, kinds)):
            if kind == "byte":
                self.byte_ids[int(p[3:5], 16)] = i
                self.raw[i] = bytes([int(p[3:5], 16)])
            elif kind == "normal" and p:
                self.raw[i] = p.replace(MARKER, " ").encode()
                ordinary.append(i)
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no full set of byte pieces")
        self.score = np.array(scores, np.float64)
        self.unknown = float(self.score[ordinary].min(initial=0.0)) - UNKNOWN_PENALTY
        self.longest = max((len(self.raw[i]) for i in ordinary), default=1)
        self.base, self.check, self.value = double_array([self.raw[i] for i in ordinary], ordinary)
        inner_blank = any(b" " in self.raw[i].lstrip(b" ") for i in ordinary)
        self.feed_free = not any(b"\n" in self.raw[i] for i in ordinary)
        self.parts = re.compile("(?s).+" if inner_blank else r" *[^ \n]+|\n| +" if self.feed_free else r" *[^ ]+| +")
        self.known: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(m.get_piece_size())
        kinds = ["byte" if m.is_byte(i) else "other" if m.is_unknown(i) or m.is_control(i) or m.is_unused(i) else "normal" for i in n]
        return cls([m.id_to_piece(i) for i in n], [m.get_score(i) for i in n], kinds)

    def solve(self, parts: list[str]) -> list[bytes]:
        """Ids (little-endian 32-bit integers) of the best path of each part."""
        raw = [p.encode("utf-8", "surrogatepass") for p in parts]
        out = [b""] * len(parts)
        order = sorted(range(len(raw)), key=lambda k: len(raw[k]))
        while order and len(raw[order[-1]]) > LONG:
            k = order.pop()
            out[k] = self._solve_one(raw[k])
        at = 0
        while at < len(order):
            wide = max(8, len(raw[order[at]]) * 3 // 2)
            upto = at
            while upto < len(order) and len(raw[order[upto]]) <= wide and upto - at < 20_000:
                upto += 1
            group = order[at:upto]
            for k, ids in zip(group, self._solve_group([raw[k] for k in group])):
                out[k] = ids
            at = upto
        return out

    def _solve_one(self, text: bytes) -> bytes:
        base, check, value, score = self.base, self.check, self.value, self.score
        n = len(text)
        best = [-np.inf] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        step = {c: int(base[0]) + c for c in range(256)}
        for s in range(n):
            if best[s] == -np.inf:
                continue
            size = _char_bytes(text[s])
            single, node = False, 0
            for e in range(s, min(n, s + self.longest)):
                to = step[text[e]] if node == 0 else int(base[node]) + text[e]
                if check[to] != node:
                    break
                node = to
                v = int(value[node])
                if v >= 0:
                    single |= e + 1 == s + size
                    if best[s] + score[v] > best[e + 1]:
                        best[e + 1], back[e + 1] = best[s] + score[v], (s, v)
            if not single and best[s] + self.unknown > best[min(n, s + size)]:
                best[min(n, s + size)], back[min(n, s + size)] = best[s] + self.unknown, (s, -1)
        ids: list[int] = []
        e = n
        while e:
            s, v = back[e]
            ids += [v] if v >= 0 else self.byte_ids[list(text[s:e])].tolist()[::-1]
            e = s
        return np.array(ids[::-1], "<i4").tobytes()

    def _solve_group(self, raw: list[bytes]) -> list[bytes]:
        n, size = len(raw), np.array([len(r) for r in raw])
        wide = int(size.max(initial=0))
        text = np.frombuffer(b"".join(r.ljust(wide, b"\0") for r in raw), np.uint8).reshape(n, wide).astype(np.int32)
        best = np.full((n, wide + 1), -np.inf)
        best[:, 0] = 0
        origin, piece = np.zeros((n, wide + 1), np.int32), np.full((n, wide + 1), -1, np.int32)
        for s in range(wide):
            rows = np.flatnonzero((size > s) & (best[:, s] > -np.inf))
            if not len(rows):
                continue
            start = best[:, s]
            char = _CHAR_BYTES[text[rows, s]]
            single = np.zeros(n, bool)
            stop = np.zeros(n, np.int64)
            stop[rows] = s + char
            node, live = np.zeros(len(rows), np.int32), rows
            for e in range(s, min(wide, s + self.longest)):
                to = self.base[node] + text[live, e]
                ok = (self.check[to] == node) & (size[live] > e)
                live, node = live[ok], to[ok]
                if not len(live):
                    break
                v = self.value[node]
                end = v >= 0
                at, v = live[end], v[end]
                single[at[stop[at] == e + 1]] = True
                total = start[at] + self.score[v]
                up = total > best[at, e + 1]
                at = at[up]
                best[at, e + 1], origin[at, e + 1], piece[at, e + 1] = total[up], s, v[up]
            lone = rows[~single[rows]]
            to = np.minimum(stop[lone], size[lone])
            up = start[lone] + self.unknown > best[lone, to]
            lone, to = lone[up], to[up]
            best[lone, to], origin[lone, to], piece[lone, to] = start[lone] + self.unknown, s, -1
        rows, pos = np.flatnonzero(size > 0), size[size > 0]
        owners, places, ids = [], [], []
        while len(rows):
            frm, v = origin[rows, pos], piece[rows, pos]
            whole = v >= 0
            owners.append(rows[whole])
            places.append(frm[whole])
            ids.append(v[whole])
            r, a, width = rows[~whole], frm[~whole], (pos - frm)[~whole]
            for k in range(int(width.max(initial=0))):
                has = width > k
                owners.append(r[has])
                places.append(a[has] + k)
                ids.append(self.byte_ids[text[r[has], a[has] + k]])
            more = frm > 0
            rows, pos = rows[more], frm[more]
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.lexsort((np.concatenate(places), owner)) if owners else owner
        flat = np.concatenate(ids).astype("<i4")[order].tobytes() if owners else b""
        cuts = (np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))) * 4).tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list) -> list[bytes | None]:
        """Ids of each text as little-endian 32-bit integers; None for null."""
        cut = [self.parts.findall(" " + t) if t else [] for t in texts]
        new = list(set(chain.from_iterable(cut)) - self.known.keys())
        if len(self.known) + len(new) > KNOWN:
            self.known.clear()
            new = list(set(chain.from_iterable(cut)))
        table = self.known
        table.update(zip(new, self.solve(new)))
        out = [None if t is None else b"".join(map(table.__getitem__, c)) for t, c in zip(texts, cut)]
        if len(table) > KNOWN or any(len(p) > LONG for p in new):
            self.known = {}
        return out

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


_CHAR_BYTES = np.array([1 if c < 0xC0 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4 for c in range(256)])


def _char_bytes(lead: int) -> int:
    return int(_CHAR_BYTES[lead])


def encode(docs: DataFrame, pieces: Pieces, keep: list[str], text_col: str = "text", decoded: str | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``ids array<int>``; with ``decoded``, also the text decoded from those ids."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    frame = docs.select(*[f"`{c}`" for c in keep], F.col(text_col).alias("__text"))
    schema = StructType([*frame.schema.fields[:-1], StructField("ids", ArrayType(IntegerType())),
                         *([StructField(decoded, StringType())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            for lo, hi in slices(texts, CHARS):
                found = own.encode(texts[lo:hi])
                cuts = np.concatenate(([0], np.cumsum([len(f) // 4 if f else 0 for f in found]))).astype(np.int32)
                flat = np.frombuffer(b"".join(f for f in found if f), np.int32)
                null = pa.array([f is None for f in found])
                cols = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat), mask=null)]
                if decoded:
                    cols.append(pa.array([None if f is None else own.decode(flat[a:z]) for f, a, z in zip(found, cuts, cuts[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(lo, hi - lo) for k in range(len(keep))), *cols],
                                                 names=[*keep, "ids", *([decoded] if decoded else [])])
    return bounded(frame).mapInArrow(run, schema)


def decode(rows: DataFrame, pieces: Pieces, keep: list[str], ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``rows`` with the text of their ids; null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(pieces)
    frame = rows.select(*[f"`{c}`" for c in keep], F.col(ids_col).cast("array<int>").alias("__ids"))
    schema = StructType([*frame.schema.fields[:-1], StructField(text_col, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            texts = [None if v is None else own.decode(np.array(v, np.int32)) for v in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, text_col])
    return bounded(frame).mapInArrow(run, schema)
