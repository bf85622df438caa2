"""Encoding with public vocabularies, each distinct span once per worker."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import accumulate, chain, compress, islice

import numpy as np
import pyarrow as pa

from ledgerlens.llm.textscan import distinct_spans, worker_cache

Encode = Callable[[list[str]], list[list[int]]]


def byte_bpe_json(path: str) -> Encode:
    """A vocabulary file of the tokenizers library.

    Spans go to the library's pre-tokeniser many at a time, one a line, and
    each distinct piece to its model; whole encodings of short spans cost much
    more.  A span with white space other than one leading space goes alone.
    Added tokens' strings are ordinary text here; see ``added_tokens``.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.normalizer is not None:
        raise ValueError("the vocabulary normalises texts, so spans cannot be encoded one by one")
    split, model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
    line = split("\n")[0][0]

    def plain(span: str) -> bool:
        word = span[1:] if span[:1] == " " else span
        return word.split() == [word]

    def encode(spans: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in spans]
        held: dict[str, list[int]] = {}
        joined = [i for i, s in enumerate(spans) if plain(s)]
        alone = set(range(len(spans))).difference(joined)
        groups = [joined[a: a + 1000] for a in range(0, len(joined), 1000)] + [[i] for i in alone]
        for group in groups:
            at, many = 0, len(group) > 1
            for piece, _ in split("\n".join([spans[i] for i in group])):
                if many and piece == line:
                    at += 1
                    continue
                ids = held.get(piece)
                if ids is None:
                    ids = held[piece] = [t.id for t in model(piece)]
                out[group[at]] += ids
        return out

    return encode


#: A piece of ``textscan.pieces``: lower-case, of letters and signs that every normal form keeps.
_PIECE = re.compile("[ \t\n\v\f\r]*[!-&(-;=-~ß-öø-ÿ]*")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if
    it prints, else one of the letters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(other)}


def cuts_words(path: str) -> bool:
    """Whether the vocabulary lower-cases texts and cuts plain words as
    ``textscan.pieces`` does."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return ([n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
            and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
            == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def words_json(path: str) -> Encode:
    """A vocabulary file of the tokenizers library whose pre-tokeniser drops
    white space: spans that begin or end with it, and added tokens' strings in
    them, are encoded as in the whole text.

    Plain pieces go to the library's model, many at a time and one a word; any
    other span goes through the library whole.
    """
    import json

    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    if any(t.get("lstrip") or t.get("rstrip") or set(t["content"]) & set(" \t\n\v\f\r") for t in added):
        raise ValueError("the vocabulary's added tokens take white space in")
    if any("<" not in t["content"] for t in added):
        raise ValueError("the vocabulary's added tokens could be plain pieces")
    tokenizer, known = Tokenizer.from_file(path), cuts_words(path)
    bare = Tokenizer(tokenizer.model)  # its words are the pieces, already in byte letters
    bare.pre_tokenizer = WhitespaceSplit()
    letters = {b: x for b, x in byte_letters().items() if b != 0x20}
    suffix = tokenizer.model.end_of_word_suffix
    if not suffix:
        raise ValueError("the vocabulary does not mark the ends of words")
    last = np.zeros(tokenizer.get_vocab_size(), bool)
    last[[i for token, i in tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True

    def encode(spans: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in spans]
        plain = [known and _PIECE.fullmatch(s) is not None for s in spans]
        pieces = [s.strip(" \t\n\v\f\r") for s in compress(spans, plain)]
        at = [i for i, p in zip(compress(range(len(spans)), plain), pieces) if p]
        joined = " ".join(filter(None, pieces)).encode().decode("latin-1").translate(letters)
        ids = bare.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        # The last token of a word, and no other, ends in the suffix.
        cut = [0, *(np.flatnonzero(last[np.array(ids, np.int64)]) + 1).tolist()]
        for i, a, b in zip(at, cut[:-1], cut[1:], strict=True):
            out[i] = ids[a:b]
        whole = [i for i, s in enumerate(plain) if not s]
        for a in range(0, len(whole), 4096):
            some = whole[a: a + 4096]
            done = tokenizer.encode([spans[i] for i in some], is_pretokenized=True, add_special_tokens=False)
            for token, k in zip(done.ids, done.word_ids):
                out[some[k]].append(token)
        return out

    return encode


def added_tokens(path: str) -> dict[str, int]:
    """The strings that the tokenizers library cuts out of a text before all
    else, and their ids."""
    import json

    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("the vocabulary's added tokens look at the text around them")
    return {t["content"]: t["id"] for t in added}


def sentence_pieces(path: str) -> Encode:
    """A model file of the sentencepiece library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda spans: model.encode(spans, num_threads=1)


def rank_file(path: str, pattern: str) -> Encode:
    """A rank file of the tiktoken library."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda spans: [encoding.encode_ordinary(s) for s in spans]


class SpanCache:
    """Ids of spans by their bytes; starts anew beyond ``limit`` spans.  Spans
    over ``longest`` bytes are encoded each time and not kept."""

    def __init__(self, encode: Encode, limit: int = 1_000_000, longest: int = 64):
        self.encode, self.limit, self.longest = encode, limit, longest
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.at, self.flat = array("q", [0]), array("i")

    def ids(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All spans' ids in order, and the number of ids of each span."""
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        first, inverse, _ = distinct_spans(data, begin, end)
        if len(self.slot) + len(first) > self.limit:
            self._clear()
        raw = data.tobytes()
        keys = [raw[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
        known = list(map(self.slot.get, keys))
        new = [i for i, s in enumerate(known) if s is None]
        kept = len(self.at), len(self.flat)
        if new:
            new.sort(key=lambda i: len(keys[i]) > self.longest)  # those to forget come last
            spans = [keys[i] for i in new]
            done = self.encode([span.decode("utf-8", "replace") for span in spans])
            for slot, i in enumerate(new, len(self.at) - 1):
                known[i] = slot
            n = sum(len(span) <= self.longest for span in spans)
            self.slot.update(zip(spans[:n], range(len(self.at) - 1, len(self.at) - 1 + n)))
            kept = kept[0] + n, kept[1] + sum(map(len, done[:n]))
            self.at.extend(islice(accumulate(map(len, done), initial=self.at[-1]), 1, None))
            self.flat.extend(chain.from_iterable(done))
        slots = np.array(known, np.int64)[inverse]
        at, flat = np.frombuffer(self.at, np.int64), np.frombuffer(self.flat, np.int32)
        count = at[slots + 1] - at[slots]
        total = np.concatenate(([0], np.cumsum(count)))
        out = flat[np.arange(total[-1]) + np.repeat(at[slots] - total[:-1], count)]
        del at, flat  # arrays cannot change while they are viewed
        del self.at[kept[0]:], self.flat[kept[1]:]
        return out, count


def forget_spans(but: SpanCache | None = None) -> None:
    """Empty the worker's caches, all but ``but``, and give back what Arrow
    keeps free: a worker outlives its step, and the next one has no use for
    another vocabulary's spans."""
    for cache in list(worker_cache().values()):
        if isinstance(cache, SpanCache) and cache is not but:
            cache._clear()
    pa.default_memory_pool().release_unused()


def span_cache(kind: str, path: str, *more: str) -> SpanCache:
    """The worker's cache for a vocabulary; made on first use.  Those of other
    vocabularies are emptied."""
    held = worker_cache()
    key = f"{kind} {path}"
    if key not in held:
        make = {"tokenizers": byte_bpe_json, "words": words_json, "sentencepiece": sentence_pieces, "tiktoken": rank_file}[kind]
        held[key] = SpanCache(make(path, *more), *([400_000] if kind in ("words", "sentencepiece") else []))
    forget_spans(held[key])
    return held[key]
