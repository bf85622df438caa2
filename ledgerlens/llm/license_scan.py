"""License scan: winnowed fingerprints, an inverted index, banded alignment.

Templates are normalised to lower-case words.  Hashes of word k-grams are
winnowed: of every ``window`` neighbouring ones the least is kept, so a copied
run of ``k + window - 1`` words always shares one.  The kept hashes of all
templates are an inverted index from hash to (template, place).

A document is fingerprinted in the same way as it streams by; its hashes that
are in the index give anchors (template, place here, place there).  Anchors of
one template near one diagonal form a candidate region.  Each region is
aligned word by word with the template, in a band around its diagonals, which
tolerates changed, missing and inserted words.  Reported are the share of the
template's words that match, and the span of the text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.textscan import Texts, Words, slices, windows

#: Wordings of the Creative Commons family: (in notices, in full).
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

#: Notices, headers and whole texts by which files state their licence (fixed wording, public).
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "ISC": "Released under the ISC License.",
    "CC0-1.0": "Licensed under CC0 1.0 Universal.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software"),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License."),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "LGPL-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."),
    "AGPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
} | {
    f"CC-{kind}-{version}{form}": text
    for kind, words in CREATIVE_COMMONS.items() for version, port in (("4.0", "International"), ("3.0", "Unported"))
    for form, text in (("", f"This work is licensed under a Creative Commons {words} {version} {port} License."),
                       ("-short", f"Licensed under CC {kind} {version}."))
}

_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?\"'()[]{}<>")] = True


def normalised(texts: Texts) -> tuple[Words, np.ndarray]:
    """Words without punctuation at their ends, and their lower-cased hashes.
    Words of punctuation alone keep one character."""
    words = texts.words()
    begin, end = words.begin.copy(), words.end.copy()
    while True:
        cut = (end - begin > 1) & _EDGE[texts.data[begin]] if len(begin) else np.zeros(0, bool)
        if not cut.any():
            break
        begin += cut
    while True:
        cut = (end - begin > 1) & _EDGE[texts.data[end - 1]] if len(begin) else np.zeros(0, bool)
        if not cut.any():
            break
        end -= cut
    words = Words(texts, begin, end, words.of)
    return words, words.hashes()


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the kept k-grams: the rightmost least of each window."""
    n = len(grams)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(grams[::-1]))]) if n else np.zeros(0, np.int64)
    best = np.arange(n - window + 1)
    least = grams[: n - window + 1].copy()
    for k in range(1, window):
        other = grams[k: n - window + 1 + k]
        take = other <= least
        best = np.where(take, np.arange(k, n - window + 1 + k), best)
        least = np.where(take, other, least)
    return np.unique(best)


@dataclass
class Index:
    """The templates' words and the inverted index of their fingerprints."""

    names: list[str]
    words: list[np.ndarray]
    hashes: np.ndarray  # sorted
    template: np.ndarray
    place: np.ndarray
    k: int
    window: int

    @classmethod
    def of(cls, templates: dict[str, str], k: int, window: int) -> Index:
        names = sorted(templates)
        words = [normalised(Texts.of(pa.array([templates[t]])))[1] for t in names]
        rows = []
        for t, w in enumerate(words):
            if len(w) < k + window - 1:
                raise ValueError(f"template {names[t]} has fewer than {k + window - 1} words")
            grams = windows(w, k)
            rows += [(int(grams[i]), t, i) for i in winnow(grams, window).tolist()]
        rows.sort()
        table = np.array([r[0] for r in rows], np.uint64)
        return cls(names, words, table, np.array([r[1] for r in rows], np.int64),
                   np.array([r[2] for r in rows], np.int64), k, window)

    def anchors(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows (template, diagonal, place in the text) of the kept places ``at``."""
        low = np.searchsorted(self.hashes, grams[at], "left")
        many = np.searchsorted(self.hashes, grams[at], "right") - low
        where = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        here = np.repeat(at, many)
        return np.column_stack((self.template[where], here - self.place[where], here))


def align(text: np.ndarray, template: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int, int]:
    """Best local alignment inside the band: (matched words, first, end in the
    text, score).  Text word i pairs with template word i - d, |d - diagonal| <= band.

    A match is worth 2, a changed, missing or inserted word costs 1.
    """
    width = 2 * band + 1
    score = [0] * width
    began = [(0, 0)] * width  # (matches, first place) of the alignment that ends here
    best = (0, 0, 0, 0)
    low, high = max(0, diagonal - band), min(len(text), diagonal + len(template) + band)
    for i in range(low, high):
        new, new_began = [0] * width, [(0, i)] * width
        for c in range(width - 1, -1, -1):  # the template's words in order
            j = i - (diagonal + c - band)
            if not 0 <= j < len(template):
                continue
            same = text[i] == template[j]
            s, (m, f) = score[c], began[c]
            value, from_ = (s + 2, (m + 1, f if s else i)) if same else (s - 1, (m, f))
            if c and score[c - 1] - 1 > value:  # a word of the text more
                value, from_ = score[c - 1] - 1, began[c - 1]
            if c + 1 < width and new[c + 1] - 1 > value:  # a word of the template less
                value, from_ = new[c + 1] - 1, new_began[c + 1]
            if value > 0:
                new[c], new_began[c] = value, from_
                if value > best[3]:
                    best = (from_[0], from_[1], i + 1, value)
        score, began = new, new_began
    return best


def find(words: np.ndarray, index: Index, band: int, least: float, least_words: int) -> list[tuple[int, int, int, int]]:
    """Matches (template, first word, end word, matched words) in one text; of
    matches that overlap the one with more matched words stays."""
    if len(words) < index.k:
        return []
    grams = windows(words, index.k)
    found = index.anchors(grams, winnow(grams, index.window))
    if not len(found):
        return []
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    matches = {}
    previous = None
    for t, d, _ in found.tolist():
        if previous is not None and previous[0] == t and d - previous[1] <= band:
            continue  # the band of the region before covers this diagonal
        previous = (t, d)
        template = index.words[t]
        matched, first, end, _ = align(words, template, d, band)
        if matched >= min(least * len(template), least_words):
            matches[t, first, end] = matched
    kept: list[tuple[int, int, int, int]] = []
    used = np.zeros(len(words), bool)
    for (t, first, end), matched in sorted(matches.items(), key=lambda x: (-x[1], -x[1] / len(index.words[x[0][0]]), x[0])):
        if not used[first:end].any():
            kept.append((t, first, end, matched))
            used[first:end] = True
    return sorted(kept, key=lambda m: (m[1], m[0]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, k: int = 3, window: int = 2, band: int = 4,
         least: float = 0.75, least_words: int = 24, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per match: doc_id, license, coverage (share of the template's
    words that match), matched_words, begin_char, end_char, matched_text.

    A match holds ``least`` of the template's words, or ``least_words`` of them:
    a part of a long licence is reported too, with its coverage.
    The index of the templates is sent to every task; it is as large as they
    are.  Texts are read whole, however long.  Matches of one text do not overlap.  Null and empty texts, and texts
    of fewer than ``k`` words, have none.  Repeated rows give repeated
    matches; ties between templates go to the one with more matched words,
    then to the one whose share is larger, then by name.  Other columns are
    ignored.  No templates, or an empty table, give an empty result.
    """
    spark = docs.sparkSession
    sent = common.send(spark, Index.of(TEMPLATES if templates is None else templates, k, window))
    texts = common.small_batches(docs.select(F.col(key).cast("long").alias("doc_id"),
                                             F.col(text).cast("string").alias("text")))

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pickle.loads(sent.value)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = Texts.of(batch.column(1).slice(a, b - a))
                words, hashes = normalised(part)
                ids = batch.column(0).slice(a, b - a).to_pylist()
                rows = []
                for i, (s, e) in enumerate(zip(words.of[:-1].tolist(), words.of[1:].tolist())):
                    for t, first, end, matched in find(hashes[s:e], index, band, least, least_words):
                        begin, stop = int(words.begin[s + first]), int(words.end[s + end - 1])
                        whole = part.data[part.at[i]: stop].tobytes()
                        start = len(whole[: begin - part.at[i]].decode("utf-8", "replace"))
                        body = whole[begin - part.at[i]:].decode("utf-8", "replace")
                        rows.append((ids[i], index.names[t], matched / len(index.words[t]), matched, start,
                                     start + len(body), body))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(zip(*rows), (
                            pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                        ["doc_id", "license", "coverage", "matched_words", "begin_char", "end_char", "matched_text"])

    return texts.mapInArrow(matches, "doc_id long, license string, coverage double, matched_words long, "
                                     "begin_char long, end_char long, matched_text string")
