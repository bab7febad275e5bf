"""Licence scans: regions of normalised text against licence templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import tokens
from .common import released, table

#: Least Dice coefficient of a match.
LEAST = 0.8

_GRANT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_3 = "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_END = "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_ISC = "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"
_GNU = "this program is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free software foundation either version {v} of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {name} for more details"
_APACHE = "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"
_UNLICENSE = "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"
_ZLIB = "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"
_MPL = "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"

#: (licence, template) in normalised form: the texts of short licences, the notices of long ones, and phrases that name one.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", f"{_GRANT} {_AS_IS}"),
    ("MIT", _GRANT),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3} {_BSD_END}"),
    ("ISC", _ISC),
    ("Apache-2.0", _APACHE),
    ("GPL-2.0", _GNU.format(name="general public license", v=2)),
    ("GPL-3.0", _GNU.format(name="general public license", v=3)),
    ("LGPL-3.0", _GNU.format(name="lesser general public license", v=3)),
    ("AGPL-3.0", _GNU.format(name="affero general public license", v=3)),
    ("MPL-2.0", _MPL),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
    *((name, f"{start} {phrase}") for start in ("licensed under", "released under", "this work is licensed under", "distributed under", "available under the terms of") for name, phrase in (
        ("MIT", "the mit license"), ("ISC", "the isc license"), ("BSD-2-Clause", "the bsd 2 clause license"), ("BSD-3-Clause", "the bsd 3 clause license"), ("Apache-2.0", "the apache license version 2 0"),
        ("GPL-2.0", "the gnu general public license version 2"), ("GPL-3.0", "the gnu general public license version 3"), ("LGPL-3.0", "the gnu lesser general public license version 3"),
        ("AGPL-3.0", "the gnu affero general public license version 3"), ("MPL-2.0", "the mozilla public license version 2 0"), ("CC-BY-4.0", "cc by 4 0"), ("CC-BY-SA-4.0", "cc by sa 4 0"),
        ("CC-BY-NC-4.0", "cc by nc 4 0"), ("CC-BY-ND-4.0", "cc by nd 4 0"), ("CC-BY-NC-SA-4.0", "cc by nc sa 4 0"), ("CC0-1.0", "cc0 1 0"),
    )),
)

#: Normal form: a to z in lower case, digits and other letters stay, all else separates words.
_NORMAL = np.full(256, 32, np.uint8)
for _c in (*range(48, 58), *range(97, 123), *range(128, 256)):
    _NORMAL[_c] = _c
_NORMAL[65:91] = np.arange(97, 123)


def bigrams(raw: np.ndarray, bounds: np.ndarray) -> tuple[tokens.Words, np.ndarray, np.ndarray]:
    """Words of normalised texts, and the hash of each word with the next in the text, and whether there is a next."""
    w = tokens.words_of(_NORMAL[raw], bounds)
    h = w.hashes
    pair = np.zeros(len(h), np.uint64)
    pair[:-1] = tokens.mix(h[:-1] * np.uint64(3) + h[1:])
    inside = np.ones(len(h), bool)
    ends = w.word_at[1:] - 1
    inside[ends[(ends >= 0) & (np.diff(w.word_at) > 0)]] = False
    return w, pair, inside


def grams_of(text: str) -> frozenset[int]:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    _, pair, inside = bigrams(raw, np.array([0, len(raw)]))
    return frozenset(pair[inside].tolist())


def dice(a: frozenset | set, b: frozenset | set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


@dataclass(frozen=True)
class Match:
    license: str
    dice: float
    start: int
    end: int


class Scanner:
    """Finds the regions of a text that match templates."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST):
        self.least = least
        self.templates = [(name, grams_of(text)) for name, text in templates]
        self.by_gram: dict[int, list[int]] = {}
        for k, (_, grams) in enumerate(self.templates):
            for g in grams:
                self.by_gram.setdefault(g, []).append(k)
        self.known = np.array(sorted(self.by_gram), np.uint64)
        # 2 * min / (a + b) >= least bounds the sizes of what can match
        self.bounds = [(len(g) * least / (2 - least), len(g) * (2 - least) / least) for _, g in self.templates]

    def regions(self, grams: list[int], at: list[int], all_grams: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(template, dice, first word, last word) of all windows of one text that match; grams and at: its known bigrams and where they begin.

        Windows begin and end at bigrams of the template, as others at an edge only lower the coefficient, and are of at
        most as many bigrams as a set that matches can have."""
        places: dict[int, list[int]] = {}
        for g, i in zip(grams, at):
            for k in self.by_gram[g]:
                places.setdefault(k, []).append(i)
        found = []
        for k, own in places.items():
            _, template = self.templates[k]
            low, high = self.bounds[k]
            # what matches shares at least `low` bigrams with the template
            need = max(1, int(np.ceil(low - 1e-9)))
            if len(own) < need:
                continue
            hits = np.array(own)
            starts = hits[: len(hits) - need + 1]
            for first in starts[hits[need - 1 :] - starts < high].tolist():
                seen, common = set(), 0
                for last, g in enumerate(all_grams[first : first + int(high)].tolist(), first):
                    hit = g in template
                    if g not in seen:
                        seen.add(g)
                        common += hit
                    if hit and common >= need and (d := 2 * common / (len(seen) + len(template))) >= self.least:
                        found.append((k, d, first, last + 1))
        return found

    def scan(self, texts: pa.Array) -> Iterator[list[Match]]:
        """For each text (null: empty) its matches, best first; of overlapping regions the best counts."""
        for _, raw, bounds in tokens.slices(texts):
            w, pair, inside = bigrams(raw, bounds)
            at = np.minimum(np.searchsorted(self.known, pair), len(self.known) - 1)
            hits = np.flatnonzero((self.known[at] == pair) & inside)
            cuts = np.searchsorted(hits, w.word_at)
            for i in range(len(bounds) - 1):
                own = hits[cuts[i] : cuts[i + 1]]
                if not len(own):
                    yield []
                    continue
                base = int(w.word_at[i])
                found = self.regions(pair[own].tolist(), (own - base).tolist(), pair[base : int(w.word_at[i + 1])])
                out: list[Match] = []
                taken = bytearray(int(w.word_at[i + 1]) - base + 1)
                for k, d, a, b in sorted(found, key=lambda x: (-x[1], x[2] - x[3], x[2], self.templates[x[0]][0])):
                    if taken.find(1, a, b + 1) < 0:
                        taken[a : b + 1] = b"\1" * (b + 1 - a)
                        out.append(Match(self.templates[k][0], d, a, b))
                yield out


SCHEMA = "doc_id bigint, license string, dice double, n_matches bigint, licenses array<string>"


def scanned(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """For each row of docs the licence that matches best in its whole text (null if none), its Dice coefficient (0 if none),
    the number of matching regions, and all licences found in order of their names. Null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            rows = list(scanner.scan(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([m[0].license if m else None for m in rows], pa.string()), pa.array([m[0].dice if m else 0.0 for m in rows], pa.float64()),
                 pa.array([len(m) for m in rows], pa.int64()), pa.array([sorted({x.license for x in m}) for m in rows], pa.list_(pa.string()))],
                ["doc_id", "license", "dice", "n_matches", "licenses"],
            )

    return docs.select("doc_id", "text").mapInArrow(released(run), SCHEMA)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLES: dict[str, str] = {}
