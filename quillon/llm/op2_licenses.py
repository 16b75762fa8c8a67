"""Licence scans: winnowed fingerprints of templates pick candidates, a banded alignment judges them.

Templates are words; the fingerprints of their runs of GRAM words, thinned by winnowing, are an inverted index from
fingerprint to template and place. All of a text's runs are looked up at once (so every shared stretch of GUARANTEE
words is met, wherever the text's own window minima would lie). Hits on nearby diagonals of one template are a
candidate, which an alignment inside a band about these diagonals turns into matched words, coverage and a span.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame

from .common import MULTIPLIER, Hashes, mapped, mixed, pick
from .op7_decontaminate import NORMAL

GRAM, WINDOW = 3, 3
GUARANTEE = GRAM + WINDOW - 1  # words of a shared stretch that is always met
BAND = 8  # words that an alignment may drift from the diagonals of its hits
COVERAGE = 0.8  # of a template's words that must be matched

#: Notices in common use, by licence.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
}


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split()


def runs(h: np.ndarray) -> np.ndarray:
    n = len(h) - GRAM + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(GRAM if n > 0 else 0):
        out = (out + h[k : k + n]) * MULTIPLIER
    return mixed(out)


class Index:
    """Fingerprint -> (template, place), and the templates' words."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.hashes = Hashes(200_000)
        self.names, self.words = [], []
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for name, texts in templates.items():
            for text in texts:
                w = words(text)
                fp = runs(self.hashes.of(w))
                if not len(fp):
                    raise ValueError(f"a template of {name} has fewer than {GRAM} words")
                t = len(self.names)
                self.names.append(name)
                self.words.append(w)
                width = min(WINDOW, len(fp))
                for at in sorted({i + width - 1 - int(fp[i : i + width][::-1].argmin()) for i in range(len(fp) - width + 1)}):
                    found[int(fp[at])].append((t, at))
        self.places = dict(found)
        self.sorted = np.array(sorted(found), np.uint64)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """Licence, coverage, matched words and span (words, end exclusive) of each match; the best of overlapping ones."""
        w = words(text or "")
        fp = runs(self.hashes.of(w))
        if not len(fp):
            return []
        at = np.minimum(np.searchsorted(self.sorted, fp), len(self.sorted) - 1)
        hits = np.flatnonzero(self.sorted[at] == fp)
        by: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for p in hits.tolist():
            for t, place in self.places[int(fp[p])]:
                by[t].append((p, p - place))
        out = []
        for t, own in by.items():
            size = len(self.words[t])
            i = 0
            while i < len(own):
                first, diagonal = own[i]
                group, k = [], i
                while k < len(own) and own[k][0] < first + size + BAND:  # hits are in the order of their places
                    if abs(own[k][1] - diagonal) <= BAND:
                        group.append(own[k][1])
                    k += 1
                n, lo, hi = aligned(self.words[t], w, min(group) - BAND, max(group) + BAND)
                i += 1
                if n >= COVERAGE * size:
                    out.append((self.names[t], n / size, n, lo, hi))
                    while i < len(own) and own[i][0] < hi:
                        i += 1
        best: list[tuple[str, float, int, int, int]] = []
        taken = np.zeros(len(w), bool)
        for m in sorted(out, key=lambda m: (-m[2], m[3], m[0])):
            if not taken[m[3] : m[4]].any():
                taken[m[3] : m[4]] = True
                best.append(m)
        return sorted(best, key=lambda m: m[3])


def aligned(template: list[bytes], text: list[bytes], low: int, high: int) -> tuple[int, int, int]:
    """Most words of the template matched in order by the text between two diagonals, and where the match lies.

    Row i of the table holds, for each diagonal, the best (matches, fewest text words, start) of the template's first i
    words; text words before the first match are free.
    """
    width = high - low + 1
    best: list[tuple[int, int, int] | None] = [(0, 0, -1)] * width  # matches, minus the last matched place, start
    top = (0, 0, 0)
    for i, word in enumerate(template):
        row: list[tuple[int, int, int] | None] = [None] * width
        for d in range(width):
            j = i + low + d  # the text's word on this diagonal
            got = best[d + 1] if d + 1 < width else None  # the template's word has no partner
            if d and (row[d - 1] is not None) and (got is None or row[d - 1][0] > got[0]):
                got = row[d - 1]  # the text's word has no partner
            before = best[d]
            if 0 <= j < len(text) and text[j] == word and before is not None and (got is None or before[0] + 1 >= got[0]):
                got = before[0] + 1, -j, before[2] if before[0] else j
            elif before is not None and (got is None or before[0] > got[0]):
                got = before  # both go without a partner
            row[d] = got
            if got is not None and (got[0] > top[0] or got[0] == top[0] and got[0] and got[2] > top[2]):
                top = got
        best = row
    return top[0], max(top[2], 0), -top[1] + 1 if top[0] else 0


def scanned(
    docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_matches, licenses (distinct, sorted, joined), coverage (the best, 0 without a match), matched_words and
    spans (licence:start:end in words, joined) of each row. Null and empty texts match nothing. Nothing is shuffled; the
    index is that of the templates given."""
    held = docs.sparkSession.sparkContext.broadcast(templates or TEMPLATES)

    def row(index: Index, doc_id: int | None, text: str | None) -> tuple:
        found = index.scan(text)
        return (
            doc_id, len(found), ",".join(sorted({m[0] for m in found})), max((m[1] for m in found), default=0.0),
            sum(m[2] for m in found), ",".join(f"{m[0]}:{m[3]}:{m[4]}" for m in found),
        )

    return mapped(
        pick(docs, id_col, text_col), row,
        "doc_id long, n_matches long, licenses string, coverage double, matched_words long, spans string", lambda: Index(held.value),
    )
