"""License scans: MinHash bands over overlapping windows of a text retrieve templates, exact containment decides.

Templates and windows are sets of shingles of five words (of fewer words only for templates that have no more).
Windows of a template's length class overlap so that an occurrence lies whole in one of them; ``collision_probability``
gives the chance that such a window shares a band with its template, above 0.999 for the settings here. A retrieved
pair is kept if the window holds at least 0.8 of the template's shingles, compared word by word, and agrees in the
words that tell versions and variants apart: all of the template's numbers and variant words lie in matching shingles,
and no other variant word stands between the first and the last of them.

A window may hold several notices: matching shingles are cut where their order in the template starts over, so each
occurrence is a match of its own. A notice whose parts were put in another order counts as one match of the window.

Templates are a parameter, held by every task; their number does not depend on the corpus. Documents are scanned where
they lie, so the scan has no shuffle and a hot source no effect.

Defined cases: words are runs of letters, digits and underscores in lower case; a null or wordless text matches
nothing; repeated rows are each reported; of overlapping matches with one template, the one with the highest
containment stays, then the leftmost; matches with different templates may overlap. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from driftline.llm.common import SHINGLE, WordHashes, grams, mix, sliding_min

ROWS, BANDS = 2, 32
CONTAINMENT = 0.8
STEP = 1.25  # ratio of neighbouring length classes
WORD = re.compile(r"\w+")

# notices as they stand in public texts; fixed values
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation"),
    ("LGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

# short notices of families that differ in variant and version only
GNU = (("GPL", "General", ("1", "2", "3")), ("LGPL", "Lesser General", ("2.1", "3")), ("LGPL", "Library General", ("2",)), ("AGPL", "Affero General", ("3",)))
CREATIVE = ("", "ShareAlike", "NonCommercial", "NoDerivatives", "NonCommercial-ShareAlike", "NonCommercial-NoDerivatives")
CREATIVE_VERSIONS = (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
SHORT = {"ShareAlike": "SA", "NonCommercial": "NC", "NoDerivatives": "ND"}


def family_templates() -> tuple[tuple[str, str], ...]:
    """Short notices of the GNU and Creative Commons families, in all their variants and versions."""
    out = []
    for name, variant, versions in GNU:
        for version in versions:
            code = f"{name}-{version if '.' in version else version + '.0'}"
            out += [(code, f"{start} licensed under the GNU {variant} Public License, version {version}") for start in ("This work is", "This program is")]
            out.append((code, f"under the terms of the GNU {variant} Public License, version {version}"))
            out.append((code, f"under the terms of the GNU {variant} Public License as published by the Free Software Foundation; either version {version} of the License"))
            out.append((code, f"under the terms of version {version} of the GNU {variant} Public License"))
    for variant in CREATIVE:
        parts = ["BY", *(SHORT[v] for v in variant.split("-") if v)]
        for version, region in CREATIVE_VERSIONS:
            code = f"CC-{'-'.join(parts)}-{version}"
            full = "-".join(["Attribution", *variant.split("-")] if variant else ["Attribution"])
            out.append((code, f"licensed under a Creative Commons {full} {version} {region} License"))
            out.append((code, f"licensed under CC {'-'.join(parts)} {version}"))
    known = {text_key(text) for _, text in TEMPLATES}
    return tuple(t for t in out if text_key(t[1]) not in known)


def text_key(text: str) -> tuple[str, ...]:
    return tuple(words_of(text))


# words that tell variants of one licence apart; numbers do as well, where the template has them
VARIANTS = frozenset("affero lesser library sharealike noncommercial noderivatives noderivs sa nc nd".split())


def telling(words: Sequence[str]) -> frozenset[str]:
    """What a match must hold: numbers, a leading v aside, and variant words."""
    return frozenset(w for w in words if w in VARIANTS or re.fullmatch(r"v?\d+", w))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def length_class(n: int) -> int:
    """The smallest class that holds n shingles: exact up to eight, then growing by ``STEP``."""
    size = 8
    while size < n:
        size = int(size * STEP)
    return n if n <= 8 else size


def stride_of(size: int) -> int:
    return max(1, size // 4)


def collision_probability(similarity: float, rows: int = ROWS, bands: int = BANDS) -> float:
    return 1 - (1 - similarity**rows) ** bands


def _seeds() -> np.ndarray:
    return mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def band_keys(least: np.ndarray) -> np.ndarray:
    """(bands, windows) keys from (hashes, windows) minima."""
    acc = np.repeat(np.arange(BANDS, dtype=np.uint64)[:, None], least.shape[1], 1)
    for r in range(ROWS):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + least[r::ROWS])
    return acc


@dataclass(frozen=True)
class Template:
    number: int
    name: str
    gram: int
    shingles: dict[tuple[str, ...], list[int]]  # places in the template
    telling: frozenset[str]


class Index:
    """Templates by band, for each (words in a shingle, length class)."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        known, seeds = WordHashes(), _seeds()
        self.groups: dict[tuple[int, int], dict[int, list[Template]]] = {}
        hashes: dict[int, list[np.ndarray]] = {}
        for number, (name, text) in enumerate(templates):
            words = words_of(text)
            if not words:
                continue
            k = min(SHINGLE, len(words))
            own: dict[tuple[str, ...], list[int]] = {}
            for i in range(len(words) - k + 1):
                own.setdefault(tuple(words[i : i + k]), []).append(i)
            h = np.unique(grams(known.of(words), k))
            hashes.setdefault(k, []).append(h)
            keys = band_keys(mix(h[None, :] ^ seeds[:, None]).min(axis=1, keepdims=True))[:, 0]
            group = self.groups.setdefault((k, length_class(len(words) - k + 1)), {})
            for key in keys.tolist():
                group.setdefault(key, []).append(Template(number, name, k, own, telling(words)))
        self.hashes = {k: np.unique(np.concatenate(v)) for k, v in hashes.items()}
        self.bands = {g: np.array(sorted(keys), np.uint64) for g, keys in self.groups.items()}
        self.seeds = seeds


def scan_text(words: list[str], hashes: np.ndarray, index: Index, containment: float) -> list[tuple[int, str, int, int, float]]:
    """(template, name, first word, words, containment) of the matches in one text."""
    found: dict[tuple[int, int, int], tuple[float, Template]] = {}
    for k, known in index.hashes.items():
        g = grams(hashes, k)
        if not len(g):
            continue
        # equal minima are equal shingles: a window without a shingle of any template shares no band
        near = known[np.minimum(np.searchsorted(known, g), len(known) - 1)] == g
        if not near.any():
            continue
        for (kk, size), bands in index.bands.items():
            if kk != k:
                continue
            step = stride_of(size)
            span = -(-(size + step - 1) // step)  # blocks of a window
            cuts = np.arange(0, len(g), step)
            hit = np.maximum.reduceat(near, cuts)
            width = min(span, len(cuts))
            busy = np.flatnonzero(-sliding_min(-hit.astype(np.int8), width))
            if not len(busy):
                continue
            wanted = np.unique((busy[:, None] + np.arange(width)).ravel())
            minima = np.empty((len(index.seeds), len(cuts)), np.uint64)
            for c in wanted.tolist():
                minima[:, c] = mix(g[None, c * step : (c + 1) * step] ^ index.seeds[:, None]).min(axis=1)
            least = np.stack([minima[:, busy + j] for j in range(width)]).min(axis=0)
            keys = band_keys(least)
            at = np.minimum(np.searchsorted(bands, keys), len(bands) - 1)
            for b, w in zip(*np.nonzero(bands[at] == keys)):
                first = int(busy[w]) * step
                for t in index.groups[k, size][int(keys[b, w])]:
                    _verify(t, words, first, min(len(g), first + width * step), containment, found)
    chosen: list[tuple[int, str, int, int, float]] = []
    for (number, a, z), (share, t) in sorted(found.items(), key=lambda x: (-x[1][0], x[0][1], x[0][0])):
        if all(c[0] != number or z <= c[2] or a >= c[2] + c[3] for c in chosen):
            chosen.append((number, t.name, a, z - a, share))
    return sorted(chosen, key=lambda c: (c[2], c[0]))


def _verify(t: Template, words: list[str], first: int, upto: int, containment: float, found: dict) -> None:
    """Exact containment of the template's shingles among those that start in [first, upto), by occurrence."""
    places = [i for i in range(first, upto) if tuple(words[i : i + t.gram]) in t.shingles]
    if len({tuple(words[i : i + t.gram]) for i in places}) < containment * len(t.shingles):
        return
    good = [m for m in (_judged(t, words, run) for run in occurrences(t, words, places)) if m[0] >= containment]
    for share, a, z in good or [_judged(t, words, places)]:
        if share >= containment and found.get((t.number, a, z), (0.0,))[0] < share:
            found[t.number, a, z] = (share, t)


def occurrences(t: Template, words: list[str], places: list[int]) -> list[list[int]]:
    """Places cut where their order in the template starts over."""
    runs, last = [], -1
    for i in places:
        ahead = [o for o in t.shingles[tuple(words[i : i + t.gram])] if o > last]
        if not ahead or not runs:
            runs.append([])
            ahead = ahead or t.shingles[tuple(words[i : i + t.gram])]
        runs[-1].append(i)
        last = ahead[0]
    return runs


def _judged(t: Template, words: list[str], places: list[int]) -> tuple[float, int, int]:
    """(containment, first word, end) of the shingles at ``places``; 0 if a telling word is missing or too many."""
    met = {tuple(words[i : i + t.gram]) for i in places}
    a, z = places[0], places[-1] + t.gram
    other = any(w in VARIANTS and w not in t.telling for w in words[a:z])
    lacking = t.telling - {w for shingle in met for w in shingle}
    return (0.0 if other or lacking else len(met) / len(t.shingles)), a, z


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, template, start_word, n_words, containment) of all matches.

    Without ``templates`` these are ``TEMPLATES`` followed by ``family_templates()``; ``template`` numbers them from 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(TEMPLATES + family_templates() if templates is None else templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = Index(shared.value), WordHashes()
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text or "")
                out += [(doc, m[1], m[0], *m[2:]) for m in scan_text(words, known.of(words), index, containment)]
            kinds = [b.column(0).type, pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "license", "template", "start_word", "n_words", "containment"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, license string, template int, start_word bigint, n_words bigint, containment double")
