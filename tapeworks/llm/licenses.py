"""License scan: winnowed template fingerprints, banded sequence alignment.

1. *Words* are runs of ASCII letters, digits and all other non-ASCII characters,
   lower-cased; punctuation and line breaks don't count, so a reflowed notice
   still matches.
2. *Index.*  Of the hashes of every ``GRAM`` words in a row, the smallest of each
   ``WINNOW`` neighbours are a template's fingerprints; the inverted index maps a
   fingerprint to its templates and places.  Texts are winnowed alike, so a
   shared run of GRAM + WINNOW - 1 words always shares a fingerprint.
3. *Candidates.*  Hits of a template on nearby diagonals (place in text minus
   place in template) are one candidate place.
4. *Alignment.*  Template and text are aligned locally within a band around the
   diagonal (match 2, mismatch -1, gap -1).  Coverage is the share of the
   template's words matched; places with at least ``MIN_COVERAGE`` are found.
5. *Choice.*  Words in square brackets in a template tell it from others (name,
   version): a place counts only if each such group stands in it word for word.
   Of templates on one span the one with the most matched words is reported.

The templates are a parameter (name -> text); their index goes to the tasks, so
its size is that of the templates.  One pass over the texts, nothing is
shuffled.

Nulls and edge cases: a null or empty text has no matches, so no row.  A notice
that stands several times is reported each time.  A template found inside a
longer one is not reported beside it.  Templates shorter than a fingerprint run are
refused.  Repeated rows are scanned each by itself; a null doc_id is kept.  Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapeworks.llm.text import WordHasher, gram_hashes, utf8_column

GRAM = 3
WINNOW = 2
MIN_COVERAGE = 0.7
BAND_SHARE = 8  # the band is one word to either side for each so many template words, two at least

KEYS = re.compile(r"\[([^]]*)\]")

# Notices as their licenses ask for them, and common short forms.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    "MIT (notice)": "Released under the [MIT License].",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to [endorse or promote products] derived from this software without specific prior
        written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "Apache-2.0 (notice)": "Licensed under the [Apache License, Version 2.0].",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
        distribute, execute, and transmit the Software""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights
        to this work.""",
    "CC0-1.0 (notice)": "Licensed under [CC0 1.0] Universal.",
}


def _gnu(name: str, kind: str, version: str, thing: str = "program") -> dict[str, str]:
    title = f"GNU {kind}General Public License"
    return {
        name: f"""This {thing} is free software: you can redistribute it and/or modify it under the terms of the [{title}]
            as published by the Free Software Foundation, either [version {version}] of the License, or (at your option)
            any later version.""",
        f"{name} (notice)": f"This work is licensed under the [{title}, version {version}].",
        f"{name} (notice, v)": f"Licensed under the [{title} v{version}].",
    }


for _name, _kind, _version, _thing in (
        ("GPL-2.0", "", "2", "program"), ("GPL-3.0", "", "3", "program"), ("LGPL-2.1", "Lesser ", "2.1", "library"),
        ("LGPL-3.0", "Lesser ", "3", "library"), ("AGPL-3.0", "Affero ", "3", "program")):
    TEMPLATES |= _gnu(_name, _kind, _version, _thing)
for _name, _title in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _version, _where in (("4.0", "International"), ("3.0", "Unported"), ("2.0", "Generic")):
        TEMPLATES |= {
            f"CC-{_name}-{_version}":
                f"This work is licensed under a [Creative Commons {_title} {_version}] {_where} License.",
            f"CC-{_name}-{_version} (notice)": f"Licensed under [CC {_name} {_version}]."}
TEMPLATES |= {f"{_name} (notice)": f"Licensed under the [{_title}]." for _name, _title in (
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"), ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("BSL-1.0", "Boost Software License, version 1.0"), ("Zlib", "zlib License"), ("EUPL-1.2", "EUPL, version 1.2"))}
TEMPLATES |= {f"{_name} (SPDX)": f"SPDX-License-[Identifier: {_name}]" for _name in (
    "MIT", "MIT-0", "ISC", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0",
    "AGPL-3.0", "MPL-2.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "EUPL-1.2", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC-BY-NC-4.0")}


class Scanner:
    """The inverted index of some templates, and the scan of a text with it."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, winnow: int = WINNOW):
        self.gram, self.winnow = gram, winnow
        self.hasher = WordHasher()
        kind = np.zeros(256, bool)
        kind[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
        kind[0x80:] = True
        self.in_word = kind
        self.names = list(templates)
        self.words = [self.parts(x.encode())[0] for x in templates.values()]
        self.keys = [[self.parts(k.encode())[0] for k in KEYS.findall(x)] for x in templates.values()]
        postings = defaultdict(list)
        for t, words in enumerate(self.words):
            if len(words) < gram + winnow - 1:
                raise ValueError(f"template {self.names[t]!r} is too short to be found")
            at, prints = self.fingerprints(words)
            for place, f in zip(at.tolist(), prints.tolist()):
                postings[f].append((t, place))
        self.postings = dict(postings)
        self.index = np.array(sorted(postings), np.uint64)

    def parts(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes and byte offsets (starts, ends) of a text's words."""
        if not text:
            none = np.empty(0, np.int64)
            return none.astype(np.uint64), none, none
        text = text.lower()
        inside = np.zeros(len(text) + 2, np.int8)
        inside[1:-1] = self.in_word[np.frombuffer(text, np.uint8)]
        turn = np.diff(inside)
        starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        return self.hasher.pieces(text, starts, ends), starts, ends

    def fingerprints(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the grams that are the smallest of a window."""
        g = gram_hashes(words, self.gram)
        windows = len(g) - self.winnow + 1
        if windows < 1:
            return np.empty(0, np.int64), g[:0]
        low = g[:windows]
        for k in range(1, self.winnow):
            low = np.minimum(low, g[k:k + windows])
        chosen = np.zeros(len(g), bool)
        for k in range(self.winnow):
            chosen[k:k + windows] |= g[k:k + windows] == low
        at = np.flatnonzero(chosen)
        return at, g[at]

    def has_keys(self, t: int, words: np.ndarray) -> bool:
        """Whether each group of words that tells template ``t`` from others
        stands among ``words``."""
        for key in self.keys[t]:
            at = np.flatnonzero(words[: max(0, len(words) - len(key) + 1)] == key[0])
            if not any(np.array_equal(words[k:k + len(key)], key) for k in at.tolist()):
                return False
        return True

    def align(self, t: int, words: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
        """Best local alignment of template ``t`` within ``band`` of a diagonal:
        words matched, and the span of words (start, end) in the text."""
        template = self.words[t]
        width = 2 * band + 1
        # Per cell: score, matches, first word of the text.
        above = [(0, 0, 0)] * width
        best = (0, 0, 0, 0)
        for i, w in enumerate(template.tolist()):
            row = []
            for o in range(width):
                j = i + diagonal + o - band
                if not 0 <= j < len(words):
                    row.append((0, 0, 0))
                    continue
                score, found, start = above[o] if above[o][0] > 0 else (0, 0, j)
                cell = (score + 2, found + 1, start) if int(words[j]) == w else (score - 1, found, start)
                if o + 1 < width and above[o + 1][0] - 1 > cell[0]:  # a template word that the text lacks
                    cell = (above[o + 1][0] - 1, *above[o + 1][1:])
                if o and row[o - 1][0] - 1 > cell[0]:  # a word that only the text has
                    cell = (row[o - 1][0] - 1, *row[o - 1][1:])
                row.append(cell if cell[0] > 0 else (0, 0, 0))
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], j + 1)
            above = row
        return best[1], best[2], best[3]

    def scan(self, text: bytes | None, least: float = MIN_COVERAGE) -> list[tuple]:
        """(template, matched, template_words, start word, end word, start byte,
        end byte) of each place found, in the order of the text."""
        words, starts, ends = self.parts(text or b"")
        at, prints = self.fingerprints(words)
        if not len(at) or not len(self.index):
            return []
        slot = np.minimum(np.searchsorted(self.index, prints), len(self.index) - 1)
        hit = np.flatnonzero(self.index[slot] == prints)
        diagonals = defaultdict(set)
        for place, f in zip(at[hit].tolist(), prints[hit].tolist()):
            for t, own in self.postings[f]:
                diagonals[t].add(place - own)
        out = set()
        for t, found in diagonals.items():
            size = len(self.words[t])
            band = max(2, size // BAND_SHARE)
            first = None
            for d in sorted(found):
                if first is not None and d - first <= band:
                    continue  # within the band of the place before
                first = d
                if not self.has_keys(t, words[max(0, d - 2 * band):max(0, d + size + 4 * band)]):
                    continue
                matched, a, b = self.align(t, words, d, 2 * band)
                if matched >= least * size and self.has_keys(t, words[a:b]):
                    out.add((a, t, b, matched))
        chosen: list[tuple] = []
        for a, t, b, matched in sorted(out, key=lambda x: (-x[3], -x[3] / len(self.words[x[1]]), x)):
            # One span, seen from two diagonals or by two templates: the best is there already.
            if not any(min(b, y) - max(a, x) > (0 if t == u else min(b - a, y - x) / 2) for x, u, y, _ in chosen):
                chosen.append((a, t, b, matched))
        return [(self.names[t], matched, len(self.words[t]), a, b, int(starts[a]), int(ends[b - 1]))
                for a, t, b, matched in sorted(chosen)]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = MIN_COVERAGE) -> DataFrame:
    """One row per place found: doc_id, license, matched_words, template_words,
    coverage, the span in words (start_word, end_word) and in characters of the
    text (start_char, end_char)."""
    templates = TEMPLATES if templates is None else templates

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            source, found = [], []
            for row, text in enumerate(utf8_column(batch, "text")):
                for name, matched, size, a, b, x, y in scanner.scan(text, least):
                    source.append(row)
                    chars = len(text[:x].decode("utf-8", "replace"))
                    found.append((name, matched, size, matched / size, a, b, chars,
                                  chars + len(text[x:y].decode("utf-8", "replace"))))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
            columns = list(zip(*found)) if found else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(source, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "license", "matched_words", "template_words", "coverage", "start_word", "end_word", "start_char", "end_char"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, license string, matched_words long, template_words long, coverage double, "
              "start_word long, end_word long, start_char long, end_char long")
