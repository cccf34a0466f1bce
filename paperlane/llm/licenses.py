"""License scans: winnowed fingerprints find candidates, banded alignment measures them.

Templates are word sequences. Of their GRAM-word fingerprints each run of WINNOW keeps the least hash, and an inverted
index leads from the kept ones to template and place. All fingerprints of a document are looked up, so any run of
GRAM + WINNOW - 1 template words is met. Hits of one template on nearly one diagonal make a candidate, whose words
are aligned with the template's within BAND words of that diagonal; matched words over template words is the coverage.
Of overlapping matches of like length, such as versions of one license, the one that explains the words best remains.
Lines with an SPDX identifier are read as they stand, whatever they name.

The templates are a parameter; their index is sent to every task and grows with them only, not with the corpus.

Defined results: null and empty texts have no matches; a repeated notice is reported at each place; only A-Z has a lower case; repeated rows are
scanned each; empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text

GRAM = 3
WINNOW = 3
BAND = 6
COVERAGE = 0.8

# Public license notices.
TEMPLATES = {
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT (line)": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "GPL-2.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-or-later": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0 (line)": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1 (line)": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 (line)": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 (line)": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD (line)": "Released under the BSD License.",
    "BSD-2-Clause (line)": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause (line)": "Licensed under the BSD 3-Clause License.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC0-1.0 (line)": "CC0 1.0 Universal",
    "Public domain (line)": "This work is released into the public domain.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-4.0 (line)": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 (line)": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0 (line)": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 (line)": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 (line)": "Licensed under CC BY-NC-ND 4.0.",
    "All rights reserved": "All rights reserved.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

_WORD = re.compile(r"[a-z0-9]+")
_ID = r"\(*[A-Za-z0-9][A-Za-z0-9.+:-]*\)*"
_SPDX = re.compile(rf"SPDX-License-Identifier:[\x20\t]*({_ID}(?:[\x20\t]+(?:AND|OR|WITH)[\x20\t]+{_ID})*)", re.I)
_LOWER = {c: c + 32 for c in range(65, 91)}
RIVAL = 0.6  # share of the longer match that the shorter one has at least, if only one of both can hold


def ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


class Index:
    """Templates with the inverted index of their winnowed fingerprints."""

    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.templates = {name: _WORD.findall(ascii_lower(t)) for name, t in templates.items()}
        self.places: dict[tuple[str, ...], list[tuple[str, int]]] = {}
        for name, words in self.templates.items():
            grams = list(zip(*(words[i:] for i in range(GRAM))))
            hashes = [xxhash.xxh64_intdigest(" ".join(g)) for g in grams]
            kept = {min(range(i, min(i + WINNOW, len(grams))), key=lambda j: (hashes[j], -j)) for i in range(max(1, len(grams) - WINNOW + 1))} if grams else set()
            for j in sorted(kept):
                self.places.setdefault(grams[j], []).append((name, j))

    def matches(self, text: str | None, coverage: float = COVERAGE) -> list[tuple[str, int, int, float, int, int]]:
        """(license, matched words, template words, coverage, start, end) in order of place; code points, end exclusive."""
        spdx = _spdx(text) if text else []
        lower = ascii_lower(text or "")  # as long as the text, so places in it are places in the text
        words = _WORD.findall(lower)
        grams = list(zip(*(words[i:] for i in range(GRAM))))
        if self.places.keys().isdisjoint(grams):
            return spdx
        hits: dict[str, list[tuple[int, int]]] = {}
        for i, g in enumerate(grams):
            for name, j in self.places.get(g, ()):
                hits.setdefault(name, []).append((i, j))
        where = [m.span() for m in _WORD.finditer(lower)]
        found, places = [], []
        for name, pairs in hits.items():
            template = self.templates[name]
            done = -1
            for first, n in _candidates(pairs, len(template)):
                low, high = max(0, first - BAND), min(len(words), first + len(template) + BAND)
                if high <= done:
                    continue
                matched = _aligned(template, words[low:high], first - low)
                if n and len(matched) >= coverage * len(template):
                    a, b = low + matched[0][1], low + matched[-1][1]
                    if a > done:
                        found.append((name, len(matched), len(template), len(matched) / len(template), where[a][0], where[b][1]))
                        places.append((a, b + 1))
                        done = b
        return sorted(_best(found, places) + spdx, key=lambda m: (m[4], m[0]))


def _spdx(text: str) -> list[tuple[str, int, int, float, int, int]]:
    """The identifiers or expressions of a text's SPDX lines, as matches."""
    found = []
    for m in _SPDX.finditer(text):
        name = m[1].rstrip(".:-")
        end = m.start(1) + len(name)
        n = len(_WORD.findall(ascii_lower(text[m.start() : end])))
        found.append((f"SPDX {name}", n, n, 1.0, m.start(), end))
    return found


def _best(found: list[tuple], places: list[tuple[int, int]]) -> list[tuple]:
    """Matches without those that overlap a rival of like length which explains the words (from, to) better."""
    if len(found) < 2:
        return found
    order = sorted(range(len(found)), key=lambda i: places[i])
    rank = [2 * m[1] - m[2] - (b - a - m[1]) for m, (a, b) in zip(found, places)]
    lost, open_ = set(), []
    for i in order:
        a, b = places[i]
        open_ = [j for j in open_ if places[j][1] > a]
        for j in open_:
            c, d = places[j]
            shared = min(b, d) - a
            if shared >= RIVAL * max(b - a, d - c) and rank[i] != rank[j]:
                lost.add(i if rank[i] < rank[j] else j)
        open_.append(i)
    return [m for i, m in enumerate(found) if i not in lost]


def _candidates(pairs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """(first word of the template on the document, hits) of runs of hits on nearly one diagonal."""
    out: list[list[int]] = []
    for i, j in pairs:  # by place in the document
        d = i - j
        if out and abs(out[-1][0] - d) <= BAND and i - out[-1][2] <= length:
            out[-1][1] += 1
            out[-1][2] = i
        else:
            out.append([d, 1, i])
    return [(d, n) for d, n, _ in out]


def _aligned(template: list[str], words: list[str], shift: int) -> list[tuple[int, int]]:
    """Longest common subsequence of template and words within BAND of the diagonal word = template + shift: (i, j) pairs."""
    width = 2 * BAND + 1
    best = [[0] * (width + 1) for _ in range(len(template) + 1)]
    for i in range(len(template) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for k in range(width - 1, -1, -1):
            j = i + shift - BAND + k
            # the next template word lies one column to the left in the band of the next row
            value = max(below[k - 1] if k else 0, row[k + 1])
            if 0 <= j < len(words) and template[i] == words[j]:
                value = max(value, below[k] + 1)
            row[k] = value
    out, i, k = [], 0, 0
    while i < len(template) and k < width:
        j = i + shift - BAND + k
        if 0 <= j < len(words) and template[i] == words[j] and best[i][k] == best[i + 1][k] + 1:
            out.append((i, j))
            i += 1
        elif best[i][k] == best[i][k + 1]:
            k += 1
        else:
            i, k = i + 1, k - 1
    return out


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """key, license, matched_words, template_words, coverage, start, end; one row per match."""
    index = Index(templates)
    kind = pa.list_(pa.struct([("license", pa.string()), ("matched_words", pa.int64()), ("template_words", pa.int64()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))
    names = [f.name for f in kind.value_type]
    schema = "found array<struct<license:string,matched_words:bigint,template_words:bigint,coverage:double,start:bigint,end:bigint>>"
    udf = per_text(lambda: lambda t: ([dict(zip(names, m)) for m in index.matches(t, coverage)],), schema, [("found", kind)])
    return docs.select(F.col(key), udf(F.col(text)).alias("m")).select(key, F.inline("m.found"))
