"""License scans by winnowed fingerprints and banded alignment (operator 5).

Texts and templates are normalised alike: lower case, words of letters and digits, one space
between. Byte grams are hashed and winnowed: of each window of grams the rightmost least hash is
kept, so any common passage of GRAM + WINDOW - 1 normalised bytes shares a fingerprint. An
inverted index of template fingerprints gives candidates (template, diagonal); near diagonals are
one candidate region, whose words are aligned with the template's words within a band. Reported
are the share of template words matched, and the span of the match in the text.

A text is taken whole and alone: there is no shuffle, and memory is bounded by the batch.

Defined results: null and empty texts have no finding; very long texts are scanned whole; a
template found several times gives several spans; of overlapping findings the one of more
matched words stays (ties: higher coverage, then template name); repeated rows are reported alike;
an empty table gives an empty table; findings() carries only the named columns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pisteflow.llm import textkernels as tk

GRAM, WINDOW = 16, 6
#: Share of a template's words that a finding covers at least.
COVERAGE = 0.8
#: Words by which an alignment may leave the diagonal of its candidate: a quarter of the template,
#: within these bounds, so that the next copy of a short notice is no part of it.
BAND = (1, 12)

#: Templates of up to so many words are found only where the words that tell families and versions
#: apart are the template's, in its order.
SHORT = 100
_TELLING = frozenset(
    b"lesser library affero documentation nc sa nd noncommercial sharealike noderivatives noderivs gpl lgpl agpl gfdl mpl epl apache mit bsd isc"
    b" zlib boost mozilla eclipse artistic cc0 zero unlicense only later".split()
)
#: Up to LINE words, all words but these must be found.
LINE = 20
_FRAME = frozenset(b"licensed released distributed under the a this work project is".split())
_NUMBER = re.compile(rb"(?:[al]?gpl|[me]pl|gfdl|cc|bsd)?v?[0-9]+")
#: Words in front of a number that make it a version.
_VERSION = frozenset(b"version versions v cc by nc sa nd zero attribution sharealike noncommercial noderivatives noderivs license licenses mpl gpl lgpl agpl gfdl epl bsl apache cc0 universal".split())

#: Notices by name. Texts are those that their licences ask for, and common one-line forms.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
        and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version.""",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
    TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
    AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
    TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
    SOFTWARE."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
    PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
    LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
    OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
    INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
    SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
    PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
    THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission."""
TEMPLATES |= {
    "mit-warranty": _WARRANTY,
    "mit-text": TEMPLATES["mit"] + _WARRANTY,
    "bsd-warranty": _BSD_WARRANTY,
    "bsd-2-clause-text": TEMPLATES["bsd"] + _BSD_WARRANTY,
    "bsd-3-clause-text": TEMPLATES["bsd"] + _ENDORSE + _BSD_WARRANTY,
    "bsd-3-clause": TEMPLATES["bsd"] + _ENDORSE,
    "isc-warranty": _ISC_WARRANTY,
    "isc-text": TEMPLATES["isc"] + _ISC_WARRANTY,
    "0bsd-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_WARRANTY,
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that
        you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,
        and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from
        any source distribution.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the
        author or authors of this software dedicate any and all copyright interest in the software to the public domain.
        We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.
        We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
        this software under copyright law.""",
    "bsl-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
        and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
        execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties
        to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software
        and this entire statement, including the above license grant, this restriction and the following disclaimer, must
        be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless
        such copies or derivative works are solely in the form of machine-executable object code generated by a source
        language processor.""",
    "epl-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License
        2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "epl-1.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License
        v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html""",
}


def _notices() -> dict[str, str]:
    """Notices and one-line forms of families and versions, except those that are there by name."""
    out = {}
    for short, kind, versions in (("gpl", "", "123"), ("lgpl", "Lesser ", ("2.1", "3")), ("lgpl", "Library ", "2"), ("agpl", "Affero ", "3")):
        for v in versions:
            name, full = f"{short}-{v if '.' in v else v + '.0'}", f"GNU {kind}General Public License"
            out[f"{name}-or-later"] = f"is free software: you can redistribute it and/or modify it under the terms of the {full} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
            out[f"{name}-only"] = f"is free software; you can redistribute it and/or modify it under the terms of the {full} as published by the Free Software Foundation; version {v} of the License."
            spelt = [f"{full}, version {v}", f"{full} v{v if '.' in v else v + '.0'}", f"{short}-{v if '.' in v else v + '.0'}", f"{short}v{v}"]
            out |= {f"{name}-{k}": x for k, x in enumerate(spelt)}
    names = {"mit": ["MIT License"], "isc": ["ISC License"], "0bsd": ["0BSD License"], "zlib": ["zlib License"], "unlicense": ["Unlicense"], "artistic-2.0": ["Artistic License 2.0"], "bsl-1.0": ["Boost Software License, Version 1.0"], "cc0-1.0": ["CC0 1.0 Universal", "Creative Commons Zero 1.0 Universal"]}
    names |= {"bsd-2-clause": ["BSD 2-Clause License", "2-Clause BSD License"], "bsd-3-clause": ["BSD 3-Clause License", "3-Clause BSD License"], "apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License"]}
    names |= {f"{s}-{v}": [f"{full} {v}", f"{full}, version {v}", f"{full}, v. {v}"] for s, full, v in (("mpl", "Mozilla Public License", "1.1"), ("mpl", "Mozilla Public License", "2.0"), ("epl", "Eclipse Public License", "1.0"), ("epl", "Eclipse Public License", "2.0"))}
    names |= {f"gfdl-{v}": [f"GNU Free Documentation License, version {v}"] for v in ("1.1", "1.2", "1.3")}
    terms = {"": "", "-nc": "-NonCommercial", "-sa": "-ShareAlike", "-nd": "-NoDerivatives", "-nc-sa": "-NonCommercial-ShareAlike", "-nc-nd": "-NonCommercial-NoDerivatives"}
    for v, kind in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        names |= {f"cc-by{c}-{v}": [f"CC BY{c.upper()} {v}", f"Creative Commons Attribution{t} {v} {kind} License"] for c, t in terms.items()}
    for name, k in [(n, k) for n in out for k in "0123" if n.endswith(f"-{k}")]:
        names.setdefault(name[:-2], []).append(out.pop(name))
    for name, spelt in names.items():
        for k, x in enumerate(spelt):
            for frame in ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under"):
                for the in ("the ", "a " if "Creative" in x else ""):
                    out[f"{name}-line:{frame} {the}{k}".lower().replace(" ", "-")] = f"{frame} {the}{x}."
    spdx = [n for n in names if not n.startswith(("gpl", "lgpl", "agpl", "gfdl"))] + [f"{n}{e}" for n in names if n.startswith(("gpl", "lgpl", "agpl", "gfdl")) for e in ("", "-only", "-or-later")]
    out |= {f"{n}-spdx": f"SPDX-License-Identifier: {n}" for n in spdx}
    return out


_seen = {" ".join(re.findall("[a-z0-9]+", t.lower())) for t in TEMPLATES.values()}
for _name, _text in _notices().items():
    _plain = " ".join(re.findall("[a-z0-9]+", _text.lower()))
    if _plain not in _seen:
        _seen.add(_plain)
        TEMPLATES.setdefault(_name, _text)
#: Whole licences, one file each.
TEMPLATES |= {f"{f.stem}-text": f.read_text() for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
FINDING = T.StructType(
    [
        T.StructField("license", T.StringType(), False),
        T.StructField("coverage", T.DoubleType(), False),
        T.StructField("matched_words", T.IntegerType(), False),
        T.StructField("span_start", T.IntegerType(), False),
        T.StructField("span_end", T.IntegerType(), False),
    ]
)
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes of a run of texts, and the row of each byte; texts end in a space."""
    low = tk.lowered(data)
    text = np.where(((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128), low, np.uint8(32))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32) | (row[1:] != row[:-1])
    return text[keep], row[keep]


def winnowed(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions that winnowing keeps: the rightmost least gram of each window."""
    h = tk.window_hashes(text, GRAM)
    if not len(h):
        return h, np.zeros(0, np.int64)
    w = min(WINDOW, len(h))
    windows = np.lib.stride_tricks.sliding_window_view(h, w)
    at = np.unique(np.arange(len(windows)) + (w - 1 - windows[:, ::-1].argmin(axis=1)))
    return h[at], at


@dataclass
class Index:
    """Inverted index of template fingerprints: sorted hashes with template and byte position."""

    templates: dict[str, str]
    names: list[str] = field(default_factory=list)
    words: list[list[bytes]] = field(default_factory=list)

    def __post_init__(self):
        hashes, owner, place = [], [], []
        for k, (name, text) in enumerate(sorted(self.templates.items())):
            raw = np.frombuffer(text.encode(), np.uint8)
            norm, _ = normalised(raw, np.array([0, len(raw)]))
            h, at = winnowed(norm)
            hashes.append(h)
            owner.append(np.full(len(h), k))
            # Positions count words, so that a diagonal is a difference of word places.
            place.append(np.cumsum(norm == 32)[at])
            self.names.append(name)
            self.words.append(_WORD.findall(norm.tobytes()))
        self.counts = [Counter(w) for w in self.words]
        self.named = [Counter(x for x in w if x not in _FRAME) if len(w) <= LINE else Counter() for w in self.words]
        self.telling = [telling(w) if len(w) <= SHORT else None for w in self.words]
        order = np.argsort(np.concatenate(hashes), kind="stable")
        self.hashes, self.owner, self.place = (np.concatenate(x)[order] for x in (hashes, owner, place))


def telling(words: list[bytes]) -> list[bytes]:
    """The words that tell families and versions apart, in order."""
    out, version = [], False
    for k, w in enumerate(words):
        number = bool(_NUMBER.fullmatch(w)) and (version or not w.isdigit() or words[k + 1 : k + 2] == [b"clause"])
        if number or w in _TELLING:
            out.append(w.lstrip(b"v"))
        version = number or w in _VERSION
    return out


def align(text: list[bytes], template: list[bytes], diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched words, first, last text word) of the best banded alignment; first > last if none.

    Template word j may meet text word j + diagonal + k for k in -band..band. The score is that of
    a longest common subsequence.
    """
    # best[k] = (matched, -first) of paths that end before template word j on offset k.
    width = 2 * band + 1
    best: list[tuple[int, int, int]] = [(0, 1, 0)] * width  # matched, first (1: none yet), last
    n = len(text)
    for j, word in enumerate(template):
        row = []
        for k in range(width):
            i = j + diagonal + k - band
            here = best[k + 1] if k + 1 < width else (0, 1, 0)  # the template word is left out
            if row and row[-1][0] > here[0]:
                here = row[-1]  # the text word is left out
            if 0 <= i < n and text[i] == word:
                m, first, _ = best[k]
                if m + 1 > here[0]:
                    here = (m + 1, i if m == 0 else first, i)
            row.append(here)
        best = row
    m, first, last = max(best, key=lambda b: (b[0], -b[2]))
    return (m, first, last) if m else (0, 1, 0)


def scan_text(raw: bytes, hits: list[tuple[int, int]], index: Index, coverage: float) -> list[dict]:
    """Findings in one text; hits: (template, diagonal) of its fingerprints in the index."""
    low = raw.lower() if raw.isascii() else tk.lowered(np.frombuffer(raw, np.uint8)).tobytes()
    spans = [(m.start(), m.end()) for m in _WORD.finditer(low)]
    words = [low[a:b] for a, b in spans]
    found = []
    hits = sorted(set(hits))
    k = 0
    while k < len(hits):
        t, d = hits[k]
        band = min(max(BAND[0], len(index.words[t]) // 4), BAND[1])
        stop = d
        while k < len(hits) and hits[k][0] == t and hits[k][1] - stop <= band:
            stop = hits[k][1]
            k += 1
        # A region of many near diagonals is taken in steps of a band.
        for centre in range(d + min(band, (stop - d) // 2), stop + band, 2 * band) if stop > d else (d,):
            base = max(0, centre - band)
            part = words[base : centre + len(index.words[t]) + band + 1]
            # No alignment has more words than both have in common in any order.
            if len(part) < coverage * len(index.words[t]) or (Counter(part) & index.counts[t]).total() < coverage * len(index.words[t]):
                continue
            m, first, last = align(part, index.words[t], centre - base, band)
            share = m / len(index.words[t])
            if share >= coverage and index.named[t] <= Counter(part[first : last + 1]) and (index.telling[t] is None or telling(part[first : last + 1]) == index.telling[t]):
                found.append((m, share, index.names[t], base + first, base + last))
    found.sort(key=lambda f: (-f[0], -f[1], f[2], f[3]))
    kept: list[tuple] = []
    for f in found:
        if all(f[4] < g[3] or f[3] > g[4] for g in kept):
            kept.append(f)
    place = lambda b: len(raw[:b].decode(errors="ignore"))
    return [{"license": f[2], "coverage": f[1], "matched_words": f[0], "span_start": place(spans[f[3]][0]), "span_end": place(spans[f[4]][1])} for f in sorted(kept, key=lambda f: f[3])]


def findings(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row a finding: the kept columns, license, coverage, matched_words and the span in characters."""
    index = Index(templates or TEMPLATES)
    schema = T.StructType([*(df.schema[c] for c in keep), *FINDING.fields])
    at = "__license_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, got = [], []
            for base, _, data, offsets in tk.runs(batch.column(at)):
                text, row = normalised(data, offsets)
                h, pos = winnowed(text)
                if not len(h):
                    continue
                lo, hi = np.searchsorted(index.hashes, h, "left"), np.searchsorted(index.hashes, h, "right")
                hit = np.flatnonzero(hi > lo)
                if not len(hit):
                    continue
                # A gram counts only if it lies in one text; word places count from its text's start.
                hit = hit[row[pos[hit]] == row[np.minimum(pos[hit] + GRAM - 1, len(row) - 1)]]
                space = np.cumsum((text == 32) & np.concatenate(([False], row[1:] == row[:-1])))
                head = np.searchsorted(row, np.arange(len(offsets)))
                of: dict[int, list[tuple[int, int]]] = {}
                for k in hit.tolist():
                    r = int(row[pos[k]])
                    word = int(space[pos[k]] - space[head[r]])
                    for e in range(lo[k], hi[k]):
                        of.setdefault(r, []).append((int(index.owner[e]), word - int(index.place[e])))
                for r, hits in of.items():
                    for f in scan_text(data[offsets[r] : offsets[r + 1]].tobytes(), hits, index, coverage):
                        rows.append(base + r)
                        got.append(f)
            take = pa.array(rows, pa.int64())
            columns = [batch.column(k).take(take) for k in range(len(keep))]
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([g[f.name] for g in got], t) for f, t in zip(FINDING.fields, kinds, strict=True))], names=[*keep, *FINDING.names])

    return df.select(*(F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(keep)), df[text_col].alias(at)).mapInArrow(run, schema)
