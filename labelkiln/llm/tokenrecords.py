"""Token-id sequences in a length-delimited binary format with an offset index.

Documents are range-partitioned and sorted by id; each partition becomes
one record file and one index file.

Record file: ``MAGIC``, one byte with the width of an id (2 or 4), three
zero bytes, then per document

    length   unsigned 64-bit, bytes of the sequence
    crc      masked crc32 of the eight length bytes, unsigned 32-bit
    ids      little-endian unsigned integers of that width
    crc      masked crc32 of the ids, unsigned 32-bit

A masked crc is the crc rotated right by 15 bits plus ``MASK``, so that
sequences which hold crcs themselves keep their protection.  Index file:
per document its id, whether it has one, the offset of its record, and its
number of ids, each little-endian in ``ENTRY``; so records can be read in
any order (``fetch``).  File names are unique per task attempt; the
written manifest, one row per file, lists those that count.

Texts are encoded by the tokenizers library.  Where the vocabulary file
asks for plain byte-level pre-tokenization, each distinct word goes through
the tokenizer once in a while and is looked up otherwise (``pretokens``),
which gives the ids of the whole text (held against it in the tests); with
any other file whole texts go through the tokenizer.

Edge cases: null or empty text is a sequence of the end id alone; null
doc_id rows come first; repeated ids keep their rows, ordered by a hash
of the text; an empty table gives no file and no row.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import bounded, new_file, open_fs, pylist, settle, shared_folder, spread
from .pretokens import SPACES, Table, slices

MAGIC = b"TOKSEQ1\n"
HEADER = len(MAGIC) + 4
ENTRY = "<qBQQ"
MASK = 0xA282EAD8
#: Words joined for one call of the tokenizer.
JOINED = 2_000
CHARS = 4_000_000
#: How a byte-level vocabulary writes a blank and a line feed.
BLANK_BYTE, FEED_BYTE = "\u0120", "\u010a"
_SPACE = re.compile(f"[{SPACES}]")


class Encoder:
    """The tokenizer, and the table of parts it has encoded."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab()
        top = max(vocab.values(), default=0)
        self.width = 2 if top < 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.blank_first, self.feed_first = np.zeros(top + 1, bool), np.zeros(top + 1, bool)
        self.blank_first[[i for token, i in vocab.items() if token.startswith(BLANK_BYTE)]] = True
        self.feed_first[[i for token, i in vocab.items() if token.startswith(FEED_BYTE)]] = True
        d = json.loads(spec)
        pre, added = d.get("pre_tokenizer") or {}, d.get("added_tokens", [])
        plain = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not d.get("normalizer")
                 and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word")))
        self.table = Table(self._of_letters, self._words, {t["content"]: np.array([t["id"]], self.kind).tobytes() for t in added}, self.kind) if plain else None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with a blank in front: in a text of such words, exactly the first token of each begins with a blank."""
        ids, size = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)]
        cuts = [*range(0, len(words), JOINED), len(words)]
        for text in pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words.cast(pa.string())), " ").to_pylist():
            found = self._ids([" " + text])[0]
            start = np.flatnonzero(self.blank_first[found])
            ids.append(found)
            size.append(np.diff(start, append=len(found)))
        if sum(map(len, size)) != len(words):
            raise ValueError("the tokenizer does not cut before white space")
        return np.concatenate(ids), np.concatenate(size)

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words.  Joined to one text, words with a blank in front begin where a token with a blank begins,
        and words without white space, with a line feed between them, after its token."""
        out: dict[str, bytes] = {}
        blank, bare = [], []
        for w in words:
            if w[0] == " " and len(w) > 1 and (w[1:].isalpha() or not _SPACE.search(w, 1)):
                blank.append(w)
            elif w.isalpha() or not _SPACE.search(w):
                bare.append(w)
        for some, joined in ((blank, "".join), (bare, "\n".join)):
            for lo in range(0, len(some), JOINED):
                few = some[lo:lo + JOINED]
                ids = self._ids([joined(few)])[0]
                if some is blank:
                    start = np.flatnonzero(self.blank_first[ids])
                    end = np.concatenate((start[1:], [len(ids)]))
                else:
                    feed = np.flatnonzero(self.feed_first[ids])
                    start, end = np.concatenate(([0], feed + 1)), np.concatenate((feed, [len(ids)]))
                if len(start) != len(few):
                    raise ValueError("the tokenizer does not cut before white space")
                flat = ids.tobytes()
                out.update(zip(few, (flat[a:b] for a, b in zip((start * self.width).tolist(), (end * self.width).tolist()))))
        rest = [w for w in words if w not in out]
        out.update(zip(rest, (e.tobytes() for e in self._ids(rest))))
        return [out[w] for w in words]

    def encode(self, texts: pa.Array, end: int) -> list[bytes]:
        """Ids of each text and the end id, as bytes."""
        stop = np.array([end], self.kind).tobytes()
        if self.table is None:
            return [ids.tobytes() + stop for ids in self._ids(texts.fill_null("").to_pylist())]
        ids, cuts = self.table.encode(texts)
        flat, at = ids.tobytes(), (cuts * self.width).tolist()
        return [flat[a:b] + stop for a, b in zip(at, at[1:])]


@lru_cache(maxsize=1)
def _encoder(spec: str) -> Encoder:
    """One encoder a worker process, so parts stay known from task to task."""
    return Encoder(spec)


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(zlib.crc32(size))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def unframe(record: bytes) -> bytes:
    """The sequence of a whole record; raises on any damage."""
    size, crc = struct.unpack_from("<QI", record)
    payload = record[12:12 + size]
    if (masked(zlib.crc32(record[:8])) != crc or len(record) != size + 16
            or struct.unpack_from("<I", record, 12 + size)[0] != masked(zlib.crc32(payload))):
        raise ValueError("damaged token record")
    return payload


def write(docs: DataFrame, tokenizer_json: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending id order; the manifest (part, path, index, docs, tokens), one row per file."""
    spark = docs.sparkSession
    with open(tokenizer_json, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # the vocabulary file, whatever the size of the corpus
    folder = shared_folder(spark, "token-records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, index, at, docs_, tokens = TaskContext.get().partitionId(), None, None, HEADER, 0, 0
        encoder = _encoder(spec.value)
        for b in batches:
            ids, texts = pylist(b, "doc_id"), b.column(1)
            if out is None and ids:
                paths = [new_file(folder, f"{part:06d}", s) for s in (".rec", ".idx")]
                out, index = (open_fs(p)[0].open_output_stream(open_fs(p)[1]) for p in paths)
                out.write(MAGIC + bytes([encoder.width, 0, 0, 0]))
            for lo, hi in slices(texts, CHARS):
                for doc_id, payload in zip(ids[lo:hi], encoder.encode(texts.slice(lo, hi - lo), end_id)):
                    record = frame(payload)
                    n = len(payload) // encoder.width
                    out.write(record)
                    index.write(struct.pack(ENTRY, doc_id or 0, doc_id is not None, at, n))
                    at, docs_, tokens = at + len(record), docs_ + 1, tokens + n
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": paths[0], "index": paths[1], "docs": docs_, "tokens": tokens}])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(bounded(sorted_rows).mapInArrow(run, "part long, path string, index string, docs long, tokens long"), "token-manifest")


def offsets(manifest: DataFrame) -> DataFrame:
    """(doc_id, path, offset, start, n_tokens) of every record, from the index files alone."""
    spark = manifest.sparkSession
    rows, before = [], 0
    for r in manifest.orderBy("part").collect():  # one row per file
        rows.append((r["path"], r["index"], before))
        before += r["tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, index, start in zip(pylist(b, "path"), pylist(b, "index"), pylist(b, "start")):
                system, name = open_fs(index)
                with system.open_input_stream(name) as f:
                    while block := f.read(struct.calcsize(ENTRY) * 50_000):
                        e = np.frombuffer(block, np.dtype("<i8,u1,<u8,<u8"))
                        n = e["f3"].astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(e["f0"].copy(), mask=e["f1"] == 0), pa.array([path] * len(e)), pa.array(e["f2"].astype(np.int64)),
                             pa.array(start + np.cumsum(n) - n), pa.array(n)], names=["doc_id", "path", "offset", "start", "n_tokens"])
                        start += int(n.sum())
    files = spark.createDataFrame(rows, "path string, index string, start long")
    return bounded(spread(files, len(rows))).mapInArrow(run, "doc_id long, path string, offset long, start long, n_tokens long")


def fetch(records: DataFrame, keep: list[str], with_ids: bool = False) -> DataFrame:
    """Read records in any order by ``path``, ``offset`` and ``n_tokens``: columns ``keep``, ``ids_crc32`` and, if asked, ``ids``."""
    frame_ = records.select(*keep, F.col("path").alias("__path"), F.col("offset").alias("__offset"), F.col("n_tokens").alias("__n"))
    schema = StructType([*frame_.schema.fields[:len(keep)], StructField("ids_crc32", LongType()),
                         *([StructField("ids", ArrayType(IntegerType()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, width = None, None, 0
        for b in batches:
            crcs, ids = [], []
            for path, at, n in zip(pylist(b, "__path"), pylist(b, "__offset"), pylist(b, "__n")):
                if path != name:
                    system, where = open_fs(path)
                    name, file = path, system.open_input_file(where)
                    head = file.read_at(HEADER, 0)
                    if head[:len(MAGIC)] != MAGIC:
                        raise ValueError(f"not a token file: {path}")
                    width = head[len(MAGIC)]
                wide = np.frombuffer(unframe(file.read_at(n * width + 16, at)), f"<u{width}").astype("<u4")
                crcs.append(zlib.crc32(wide.tobytes()))
                if with_ids:
                    ids.append(wide.astype(np.int32))
            cols = [*(b.column(k) for k in range(len(keep))), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []),
                                             names=[*keep, "ids_crc32", *(["ids"] if with_ids else [])])
    return bounded(frame_).mapInArrow(run, schema)


def digests(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    return fetch(offsets(manifest), ["doc_id", "start", "n_tokens"])
