"""Texts as parts and words of byte-level pre-tokenization, and ids of texts from those of their words.

A byte-level pre-tokenizer never joins a character that is no white space
with white space after it, and of a run of white space before another
character it gives exactly the last blank to that character.  So a text may
be cut before a blank that follows no white space, or that is followed by
none.  Parts are named by keys: a key that ends with a blank is the part and
one blank more, any other key is the part without the blank in front of it.
Parts recur, so their ids are kept in a table; new parts are cut into words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Parts known to a worker; beyond them only those of the latest texts stay, which changes no result.
KNOWN = 400_000
#: Longer parts (in characters) are not kept.
LONG_PART = 1_000

#: Unicode White_Space.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNEVEN = re.compile(f" (?:[{SPACES}]|\\Z)")
_UNEVEN_RE2 = f" (?:[{SPACES}]|\\z)"
_PART = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
#: Marks that are a word of their own behind letters; letters that count as such in every version of Unicode.
CLOSERS = ".,;:!?"
_CLOSED = f"[{CLOSERS}]$"
_LETTERS = f"^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+[{CLOSERS}]?$"

# The words of byte-level pre-tokenization, in the order they are tried.
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
#: Code points that newer Unicode tables count as letters or numbers, and the pre-tokenizer's do not.
LATER = ("\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
         "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
         "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
         "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
         "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
         "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
         "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
         "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
         "\U0003d000-\U0003fc3f")


@lru_cache(maxsize=1)
def words_pattern() -> regex.Pattern:
    letter, number = rf"[^\P{{L}}{LATER}]", rf"[^\P{{N}}{LATER}]"
    other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{LATER}])"
    return regex.compile("|".join([*CONTRACTIONS, f" ?{letter}+", f" ?{number}+", f" ?{other}+", r"\s+(?!\S)", r"\s+"]))


def keys(text: str) -> list[str]:
    """Keys of the parts of ``text``, in order; the parts joined are the text."""
    if not text:
        return []
    if _UNEVEN.search(text) is None:  # every blank is followed by no white space
        cut = text.split(" ")
        cut[0] += " "
        return cut
    return [key_of(p) for p in _PART.findall(text)]


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` bytes each (a longer text stands alone)."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        before = int(total[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + size, "right")))
        yield lo, hi
        lo = hi


def key_of(part: str) -> str:
    return part[1:] if part[0] == " " and part.find(" ", 1) < 0 else part + " "


def segments(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start:start + size]``, one after the other."""
    end = np.cumsum(size)
    return flat[np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)]


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


class Table:
    """Ids of texts from those of their words, with a table of parts known so far.

    ``of_letters`` gives (ids, number of ids of each) of distinct words of
    letters with a blank in front (given without it, as an Arrow array),
    ``of_words`` the ids of any distinct words as bytes of ``kind``, and
    ``added`` those of added tokens.  Keys are Arrow strings, their ids pieces
    of one array, so that parts that occur once cost no Python object.
    """

    def __init__(self, of_letters: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], of_words: Callable[[list[str]], list[bytes]],
                 added: dict[str, bytes], kind: str):
        self.of_letters, self.of_words, self.added, self.kind = of_letters, of_words, added, np.dtype(kind)
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pattern = words_pattern()
        self.known = pa.array([], pa.large_string())
        self.flat, self.start, self.size = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _keys(self, text: str) -> list[str]:
        """Part keys of a text; an added token is its content with two blanks behind."""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return keys(text)
        out, at = [], 0
        for m in self.added_pattern.finditer(text):
            out += [*keys(text[at:m.start()]), m[0] + "  "]
            at = m.end()
        return out + keys(text[at:])

    def _other(self, new: list[str]) -> list[bytes]:
        """Ids of parts that are not letters alone."""
        cut = [None if k[-2:] == "  " and k[:-2] in self.added else self.pattern.findall(k[:-1] if k[-1:] == " " else " " + k) for k in new]
        words = list(dict.fromkeys(w for c in cut if c for w in c))
        ids = dict(zip(words, self.of_words(words)))
        return [self.added[k[:-2]] if c is None else b"".join([ids[w] for w in c]) for k, c in zip(new, cut)]

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Add new parts; their places in the table.  Letters with a mark behind them are the word and the mark."""
        letters = pc.match_substring_regex(new, _LETTERS)
        some, rest = new.filter(letters), new.filter(pc.invert(letters))
        closed = pc.match_substring_regex(some, _CLOSED).to_numpy(zero_copy_only=False)
        word = pc.replace_substring_regex(some, _CLOSED, "").dictionary_encode()
        ids, size = self.of_letters(word.dictionary)
        marks = {m: self.of_words([m])[0] for m in CLOSERS} if closed.any() else {}
        other = self._other(rest.to_pylist())
        before = len(self.flat)
        flat = np.concatenate((self.flat, ids, np.frombuffer(b"".join([*marks.values(), *other]), self.kind)))
        begin, length = before + _starts(size), size
        n_mark = np.array([len(m) for m in marks.values()], np.int64) // self.kind.itemsize
        mark_at = before + len(ids) + _starts(n_mark)
        # the ids of a closed word and its mark, next to each other
        code = word.indices.to_numpy().astype(np.int64)
        which = np.array([CLOSERS.index(m) for m in pc.utf8_slice_codeunits(some.filter(pa.array(closed)), -1).to_pylist()], np.int64)
        a, b = code[closed], which
        pair_start, pair_size = np.empty(2 * len(a), np.int64), np.empty(2 * len(a), np.int64)
        if len(a):
            pair_start[::2], pair_start[1::2], pair_size[::2], pair_size[1::2] = begin[a], mark_at[b], length[a], n_mark[b]
        n_other = np.array(list(map(len, other)), np.int64) // self.kind.itemsize
        start_some, size_some = begin[code], length[code]
        start_some[closed], size_some[closed] = len(flat) + _starts(pair_size[::2] + pair_size[1::2]), pair_size[::2] + pair_size[1::2]
        self.flat = np.concatenate((flat, segments(flat, pair_start, pair_size)))
        self.start = np.concatenate((self.start, start_some, before + len(ids) + int(n_mark.sum()) + _starts(n_other)))
        self.size = np.concatenate((self.size, size_some, n_other))
        old = len(self.known)
        self.known = pa.concat_arrays([self.known, some, rest])
        is_some = letters.to_numpy(zero_copy_only=False)
        return old + np.where(is_some, np.cumsum(is_some) - 1, len(some) + np.cumsum(~is_some) - 1)

    def _pieces(self, named: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of distinct parts."""
        found = pc.index_in(named, value_set=self.known)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        if found.null_count:
            at[at < 0] = self._learn(named.filter(found.is_null()))
        flat, start, size = self.flat, self.start[at], self.size[at]
        if len(self.known) > KNOWN:
            keep = (pc.binary_length(named).to_numpy() <= LONG_PART).nonzero()[0]
            self.known, self.size = named.take(pa.array(keep)), size[keep]
            self.flat, self.start = segments(flat, start[keep], self.size), _starts(self.size)
        return flat, start, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; where each text begins and ends); null and empty texts have none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, _UNEVEN_RE2)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd & (pc.binary_length(texts).to_numpy() > 0))
        cut = pc.split_pattern(texts.take(pa.array(plain)), " ")  # every blank there is followed by a word
        start = np.asarray(cut.offsets).astype(np.int64)
        parts = cut.values.slice(start[0], start[-1] - start[0]).dictionary_encode()
        start -= start[0]
        code, named = parts.indices.to_numpy().astype(np.int64), parts.dictionary
        first, again = np.unique(code[start[:-1]], return_inverse=True)  # parts without a blank in front
        code[start[:-1]] = len(named) + again
        verbatim = pc.binary_join_element_wise(named.take(pa.array(first)), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
        uneven = [self._keys(t) for t in texts.take(pa.array(np.flatnonzero(odd))).to_pylist()]
        # one number for each key: those of uneven texts may be among the others
        every = pa.concat_arrays([named, verbatim, pa.array(list(chain.from_iterable(uneven)), pa.large_string())]).dictionary_encode()
        place = every.indices.to_numpy().astype(np.int64)
        n = len(named) + len(verbatim)
        sizes = np.zeros(len(texts), np.int64)
        sizes[plain], sizes[odd] = np.diff(start), list(map(len, uneven))
        codes, of = np.empty(int(sizes.sum()), np.int64), np.repeat(odd, sizes)
        codes[~of], codes[of] = place[code], place[n:]
        flat, begin, size = self._pieces(every.dictionary)
        size_of = size[codes]
        ends = np.concatenate(([0], np.cumsum(size_of)))
        return segments(flat, begin[codes], size_of), ends[np.concatenate(([0], np.cumsum(sizes)))]
