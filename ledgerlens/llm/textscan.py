"""Words and word hashes of many texts at once, with numpy.

Works on the UTF-8 bytes of a slice of an Arrow string column.  A word is a
run of bytes other than space and ``\\x09``-``\\x0D``.  A 64-bit hash stands
for a word: every eight bytes are combined with a key of their place and mixed
by shifts and products, so that no sum of byte values can cancel; the mixed
blocks are added and mixed again with the length.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  #: the low k bytes
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WINDOW = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Texts:
    """Bytes of consecutive texts: text i is ``data[at[i]:at[i + 1]]``."""

    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        """From a string array; a null is an empty text."""
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        return cls(raw[at[0]: at[-1]], at - at[0])

    def words(self) -> Words:
        solid = ~_SPACE[self.data]
        n = len(solid)
        first, last = solid.copy(), solid.copy()
        if n:
            cut = np.zeros(n + 1, bool)
            cut[self.at] = True  # a text begins here
            first[1:] &= ~(solid[:-1] & ~cut[1:n])
            last[:-1] &= ~(solid[1:] & ~cut[1:n])
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return Words(self, begin, end, np.searchsorted(begin, self.at))


@dataclass
class Words:
    """Word j is ``data[begin[j]:end[j]]``; text i has words ``of[i]`` to ``of[i + 1]``."""

    texts: Texts
    begin: np.ndarray
    end: np.ndarray
    of: np.ndarray

    def hashes(self, lower: bool = True) -> np.ndarray:
        data = _LOWER[self.texts.data] if lower else self.texts.data
        return span_hashes(data, self.begin, self.end)

    def text_of(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))


@dataclass
class Blocks:
    """Spans as blocks of eight bytes, zeros after the last byte: span j has
    ``value[at[j]:at[j + 1]]``."""

    value: np.ndarray
    at: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Blocks:
        size = end - begin
        count = (size + 7) >> 3
        at = np.concatenate(([0], np.cumsum(count)))
        done = 8 * (np.arange(at[-1]) - np.repeat(at[:-1], count))
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        every = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        value = every[np.repeat(begin, count) + done]
        return cls(value & _KEEP[np.minimum(np.repeat(size, count) - done, 8)], at, size)

    def hashes(self) -> np.ndarray:
        """A hash for each span, none of them empty."""
        count = np.diff(self.at)
        if not len(count):
            return np.zeros(0, np.uint64)
        place = np.arange(self.at[-1]) - np.repeat(self.at[:-1], count)
        key = mix(np.arange(1, int(count.max()) + 1, dtype=np.uint64) * _STEP)
        mixed = mix(self.value ^ key[place])
        return mix(np.add.reduceat(mixed, self.at[:-1]) + self.size.astype(np.uint64) * _WINDOW)

    def equal(self, other: Blocks, at: np.ndarray) -> np.ndarray:
        """Which spans have the very bytes of span ``at[j]`` of ``other`` (none, if there is no such span)."""
        out = at < len(other.size)
        out[out] = self.size[out] == other.size[at[out]]
        same = np.flatnonzero(out)
        count = np.diff(self.at)[same]
        end = np.cumsum(count)
        inside = np.arange(end[-1] if len(end) else 0) - np.repeat(end - count, count)
        wrong = (self.value[np.repeat(self.at[same], count) + inside]
                 != other.value[np.repeat(other.at[at[same]], count) + inside])
        out[np.repeat(same, count)[wrong]] = False
        return out


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each non-empty span ``data[begin[j]:end[j]]``."""
    return Blocks.of(data, begin, end).hashes()


def distinct_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of each distinct non-empty span, in order, the number of each
    span's among them, and how often each occurs.  Spans are compared by their
    bytes; they come in order and do not overlap."""
    if not len(begin):
        none = np.zeros(0, np.int64)
        return none, none, none
    gaps = bool((begin[1:] != end[:-1]).any())
    at = np.stack((begin, end), 1).ravel() if gaps else np.append(begin, end[-1])
    every = pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                  [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    inverse = every.dictionary_encode().indices.to_numpy()
    if gaps:  # what lies between spans was encoded too
        _, inverse = np.unique(inverse[::2], return_inverse=True)
    times = np.bincount(inverse)
    first = np.empty(len(times), np.int64)
    first[inverse[::-1]] = np.arange(len(inverse))[::-1]
    return first, inverse, times


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words (``len - width + 1`` of them)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix(out * _STEP + hashes[k: k + n])
    return out


def slices(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about ``max_bytes`` each; a longer
    text is a range of its own."""
    lengths = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    begin = size = 0
    for i, n in enumerate(lengths.tolist()):
        if i > begin and size + n > max_bytes:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(lengths):
        yield begin, len(lengths)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    return sys.modules.setdefault("ledgerlens_worker", types.ModuleType("ledgerlens_worker")).__dict__


def per_text(texts: Texts, where: np.ndarray) -> np.ndarray:
    """How many of the sorted byte positions ``where`` lie in each text."""
    return np.diff(np.searchsorted(where, texts.at))


def repeats(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element: how often its hash occurs in its text, and whether
    this is the first place."""
    keyed = mix(hashes + owner.astype(np.uint64) * _STEP)
    _, first, inverse, count = np.unique(keyed, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(hashes), bool)
    is_first[first] = True
    return count[inverse], is_first


def base_counts(texts: Texts, words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of each text, from its words and their (case-kept) hashes.

    n_words; word_chars (code points in words); n_symbols (``#*$%&|<>``);
    n_dup_lines (lines with a word that equal an earlier line); n_repeat_words
    (words in 3-word windows found twice or more in the text).
    """
    n = len(texts.at) - 1
    data = texts.data
    owner = words.text_of()
    solid = ~_SPACE[data]
    out = {"n_words": np.diff(words.of),
           "word_chars": per_text(texts, np.flatnonzero(solid & ((data & 0xC0) != 0x80))),
           "n_symbols": per_text(texts, np.flatnonzero(_SYMBOL[data]))}
    # Lines, from cuts at line feeds and text ends.
    feeds = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate((texts.at[:-1], feeds + 1)), kind="stable")
    end = np.sort(np.concatenate((feeds, texts.at[1:])), kind="stable")
    has_word = np.searchsorted(words.begin, begin) < np.searchsorted(words.begin, end)
    begin, end = begin[has_word], end[has_word]
    line_owner = np.searchsorted(texts.at, begin, side="right") - 1
    _, first = repeats(line_owner, span_hashes(data, begin, end))
    out["n_lines"] = np.bincount(line_owner, minlength=n)
    out["n_dup_lines"] = np.bincount(line_owner[~first], minlength=n)
    # Windows of three words inside one text.
    runs = windows(hashes, 3)
    inside = owner[:-2] == owner[2:] if len(hashes) >= 3 else np.zeros(0, bool)
    twice = np.zeros(len(runs), bool)
    times, _ = repeats(owner[:-2][inside], runs[inside]) if len(runs) else (np.zeros(0), None)
    twice[inside] = times >= 2
    cover = np.zeros(len(hashes), bool)
    for k in range(3):
        cover[k: k + len(twice)] |= twice
    out["n_repeat_words"] = np.bincount(owner[cover], minlength=n)
    return out


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_END_SPACE = np.array([0x80 + k for k in range(11)] + [0xA8, 0xA9, 0xAF], np.uint8)


_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'")] = True


def units(texts: Texts) -> Words:
    """Spans of white space with the word after it, cut before punctuation,
    covering the texts.

    Byte-level pre-tokenisers look across no end of such a span, so spans can
    be encoded one by one.  A word that ends in a wider kind of white space
    is left together with the next span, as there they would look across.
    """
    words = texts.words()
    cut = words.end
    data = np.concatenate((np.zeros(3, np.uint8), texts.data))
    c, b, a = data[cut], data[cut + 1], data[cut + 2]  # the last three bytes before the cut
    wide = ((a >= 0x1C) & (a <= 0x1F)) | ((b == 0xC2) & ((a == 0x85) | (a == 0xA0))) \
        | ((c == 0xE1) & (b == 0x9A) & (a == 0x80)) | ((c == 0xE2) & (b == 0x80) & np.isin(a, _END_SPACE)) \
        | ((c == 0xE2) & (b == 0x81) & (a == 0x9F)) | ((c == 0xE3) & (b == 0x80) & (a == 0x80))
    # After a letter or digit, punctuation begins a match of its own too.
    raw = texts.data
    mark = np.flatnonzero(_MARK[raw[1:]] & _ALNUM[raw[:-1]]) + 1 if len(raw) else cut[:0]
    is_cut = np.zeros(len(raw) + 1, bool)
    is_cut[texts.at] = is_cut[cut[~wide]] = is_cut[mark] = True
    cuts = np.flatnonzero(is_cut)
    begin, end = cuts[:-1], cuts[1:]
    return Words(texts, begin, end, np.searchsorted(begin, texts.at))


#: Of a byte in a word: 1 of a letter, 2 a digit, 3 a sign, 0 none of these in
#: plain words.  A letter is one of ASCII, or of Latin-1 (0xC3 and the byte after it).
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 3
_CLASS[list(b"0123456789")] = 2
_CLASS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_CLASS[0x80:0xC0] = _CLASS[0xC3] = 1
_CLASS[list(b"'<")] = 0


def pieces(texts: Texts) -> Words:
    """Spans that cover the texts: plain words cut into runs of letters, single
    digits and runs of signs, in lower case, and other words whole and as they
    are, each with the white space before it.

    Plain words are of ASCII and Latin-1 letters, digits and signs, without
    ``'`` and ``<``.  The spans' data are a copy.
    """
    words = texts.words()
    data = texts.data
    n = len(data)
    if not n:
        return Words(texts, words.begin, words.end, words.of)
    kind = _CLASS[data]
    high = np.flatnonzero(data >= 0x80)
    before = np.where(high > 0, data[high - 1], 0)
    low = data[high] < 0xC0
    kind[high[low & ((before != 0xC3) | (data[high] == 0x97) | (data[high] == 0xB7))]] = 0
    solid = ~_SPACE[data]
    odd = np.unique(np.searchsorted(words.begin, np.flatnonzero(solid & (kind == 0)), side="right") - 1)
    edge = np.zeros(n + 1, np.int8)
    edge[words.begin[odd]] += 1
    edge[words.end[odd]] -= 1
    plain = np.cumsum(edge[:-1], dtype=np.int8) == 0
    is_cut = np.zeros(n + 1, bool)
    is_cut[1:n] = ((kind[1:] != kind[:-1]) | (kind[1:] == 2)) & solid[1:] & solid[:-1] & plain[1:] & plain[:-1]
    is_cut[words.end] = is_cut[texts.at] = True
    lower = data.copy()
    lower[(data >= 65) & (data <= 90) & plain] += 32
    accent = high[low & (data[high] <= 0x9E) & (before == 0xC3)]
    lower[accent[plain[accent]]] += 32
    cuts = np.flatnonzero(is_cut)
    return Words(Texts(lower, texts.at), cuts[:-1], cuts[1:], np.searchsorted(cuts[:-1], texts.at))
