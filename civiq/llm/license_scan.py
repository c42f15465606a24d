"""Licence scan by the Dice coefficient over word bigrams.

Method: texts and templates are normalised (lower case, words of letters and
digits, spelling variants and copyright lines evened out) and compared as bags
of word bigrams. A place in a text is a window of any width. Size bounds prune:
a window of w bigrams reaches Dice t with a template of m only for w from
m * t / (2 - t) to m * (2 - t) / t, with as many bigrams that the template knows
as the least width; so a template is compared only where enough of its bigrams
stand close together. Windows that begin or end with a bigram that the template
does not know are worse than their inner part and are not looked at.

Scale: a map; the templates (fixed lists) travel with the task.

Defined results: a null, empty or short text holds no licence; of overlapping
places the best, then the longest, then the first, then that of the smaller
licence name is reported; other columns are
carried through untouched.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, runs, ship, values, with_row
from .license_texts import WHOLE

THRESHOLD = 0.8

# Parts that licences share.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_MIT_DISCLAIMER = "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_DISCLAIMER = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_FSF = "as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."

# Licence notices and licences, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD-2-Clause": [_BSD, f"{_BSD} {_BSD_DISCLAIMER}"],
    "BSD-3-Clause": [f"{_BSD} {_BSD_THIRD}", f"{_BSD} {_BSD_THIRD} {_BSD_DISCLAIMER}"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
}

# Names that stand in the usual short notices. No wording shares so
# much with another licence's that a third licence's notice reaches the threshold.
NAMES = {
    "MIT": ["MIT License"], "ISC": ["ISC License"], "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "Apache-2.0": ["Apache License 2.0"], "MPL-1.1": ["Mozilla Public License 1.1", "Mozilla Public License, version 1.1"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0"], "Unlicense": ["Unlicense License"],
    "GPL-1.0-or-later": ["GNU General Public License"], "LGPL-2.0-or-later": ["GNU Lesser General Public License"], "AGPL-3.0": ["GNU Affero General Public License"],
}
_GNU = {"GPL": ("GNU General Public License", ("1.0", "2.0", "3.0")), "LGPL": ("GNU Lesser General Public License", ("2.1", "3.0")), "AGPL": ("GNU Affero General Public License", ("3.0",))}


def _add(name: str, *texts: str) -> None:
    TEMPLATES.setdefault(name, []).extend(texts)


for _name, _known in NAMES.items():
    _add(_name, *(f"{verb} under the {n}" for n in _known for verb in ("Licensed", "Released", "Distributed")))
for _short, (_long, _versions) in _GNU.items():
    for _v in _versions:
        _n = _v.removesuffix(".0")
        _add(f"{_short}-{_v}", f"This work is licensed under the {_long}, version {_n}.", f"Licensed under the {_long}, version {_n}", f"Licensed under the {_long} v{_n}.0" if _n in "123" else f"Licensed under the {_long} v{_n}",
             f"you can redistribute it and/or modify it under the terms of the {_long} {_FSF.format(_n)}")
_add("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License " + _FSF.format("2"))
for _short, _long in (("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-NC", "-NonCommercial"), ("BY-ND", "-NoDerivatives"), ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives")):
    for _v, _port in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        _add(f"CC-{_short}-{_v}", f"Licensed under CC {_short} {_v}.", f"This work is licensed under a Creative Commons Attribution{_long} {_v} {_port} License.")
_add("MIT", TEMPLATES["MIT"][1] + " " + _MIT_DISCLAIMER)
_add("ISC", TEMPLATES["ISC"][0] + " " + _ISC_DISCLAIMER)
_add("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_DISCLAIMER)
#: What is searched by default: notices, short licences and whole licences.
ALL = {n: TEMPLATES.get(n, []) + ([WHOLE[n]] if n in WHOLE else []) for n in {**TEMPLATES, **WHOLE}}

_COPYRIGHT = re.compile(r"^[^\w\n]*(?:copyright\b|\(c\)|©)[^\n]*$", re.I | re.M)
_WORD = re.compile(r"[^\W_]+")
# Spelling variants.
_VARIANTS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "neighbouring": "neighboring", "v3": "3", "v2": "2"}


def normalised(text: str | None) -> list[str]:
    """Words of a text for comparison; lines of a copyright notice go."""
    if not text:
        return []
    low = text.lower()
    if "copyright" in low or "(c)" in low or "©" in low:
        low = _COPYRIGHT.sub("", low)
    return [_VARIANTS.get(w, w) for w in _WORD.findall(low)]


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words[:-1], words[1:], strict=True))


def dice(a: list, b: list) -> float:
    """Dice coefficient of two bags."""
    if not a and not b:
        return 1.0
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


class _Look:
    """Places of one template in one text."""

    def __init__(self, at: np.ndarray, gram: np.ndarray, own: np.ndarray, size: int, threshold: float):
        """at, gram: places and numbers of the bigrams that the template has."""
        self.at, self.size = at, size
        self.widest = int(size * (2 - threshold) / threshold + 1e-9)
        # a bigram counts in a window unless the window holds as many of its
        # kind before it as the template has: place of the first of these
        order = np.argsort(gram, kind="stable")
        g = gram[order]
        start = np.repeat(runs(g), np.diff(np.append(runs(g), len(g))))
        back = np.arange(len(g)) - own[g]
        self.full = np.full(len(g), -1)
        self.full[order] = np.where(back >= start, at[order][np.maximum(back, 0)], -1)

    def starts(self, need: float) -> list[int]:
        """Those with enough known bigrams in the widest window."""
        ends = np.searchsorted(self.at, self.at + self.widest)
        return np.flatnonzero(ends - np.arange(len(self.at)) >= need).tolist()

    def best(self, i: int, free: int) -> tuple[float, int]:
        """Dice and word after the last of the best window (of several the
        longest) that begins at start i."""
        first = int(self.at[i])
        j = int(np.searchsorted(self.at, min(first + self.widest, free - 1)))
        if j <= i:
            return 0.0, 0
        value = 2 * np.cumsum(self.full[i:j] < first) / (self.size + self.at[i:j] - first + 1)
        end = len(value) - 1 - int(value[::-1].argmax())
        return float(value[end]), int(self.at[i + end]) + 2


class Scanner:
    def __init__(self, templates: dict[str, list[str]] = ALL, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.words: dict[str, int] = {}
        self.templates = []
        for name, texts in templates.items():
            for text in texts:
                ids = [self.words.setdefault(w, len(self.words) + 1) for w in normalised(text)]
                self.templates.append((name, ids))
        base = len(self.words) + 1
        self.base = base
        self.bags = [(name, np.array(ids[:-1], np.int64) * base + np.array(ids[1:], np.int64)) for name, ids in self.templates if len(ids) > 1]
        self.all = np.unique(np.concatenate([g for _, g in self.bags]))
        self.own = np.zeros((len(self.bags), len(self.all)), np.int32)  # times a template has a bigram
        for row, (_, bag) in zip(self.own, self.bags, strict=True):
            np.add.at(row, np.searchsorted(self.all, bag), 1)
        self.has = np.ascontiguousarray((self.own > 0).T)
        self.need = np.array([len(g) for _, g in self.bags]) * threshold / (2 - threshold) - 1e-9

    def _hits(self, gram: np.ndarray) -> np.ndarray:
        """How many of the known bigrams of a text each template knows."""
        hits = np.zeros(len(self.bags), np.int64)
        for at in range(0, len(gram), 1 << 14):
            hits += self.has[gram[at:at + (1 << 14)]].sum(axis=0)
        return hits

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(licence, Dice, first word, word after the last) of every place."""
        words = normalised(text)
        if len(words) <= self.need.min():
            return []
        ids = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        grams = ids[:-1] * self.base + ids[1:]
        gram = np.searchsorted(self.all, grams)
        at = np.flatnonzero(self.all[np.minimum(gram, len(self.all) - 1)] == grams)
        gram = gram[at]
        if len(at) < self.need.min():
            return []
        looks, heap = {}, []
        for k in np.flatnonzero(self._hits(gram) >= self.need).tolist():
            mine = self.has[gram, k]
            looks[k] = look = _Look(at[mine], gram[mine], self.own[k], len(self.bags[k][1]), self.threshold)
            heap.extend(self._entry(k, look, i, len(words)) for i in look.starts(self.need[k]))
        heap = [h for h in heap if h]
        heapify(heap)
        # of overlapping places the best, then the longest, stays; a place that
        # runs into a better one is cut before it and measured again
        taken: list[tuple[int, int]] = []
        kept = []
        while heap:
            value, _, first, name, k, i, last = heappop(heap)
            n = bisect_right(taken, (first, len(words)))
            if n and taken[n - 1][1] > first:
                continue
            free = taken[n][0] if n < len(taken) else len(words)
            if last > free:
                again = self._entry(k, looks[k], i, free)
                if again:
                    heappush(heap, again)
                continue
            taken.insert(n, (first, last))
            kept.append((name, -value, first, last))
        return sorted(kept, key=lambda f: f[2])

    def _entry(self, k: int, look: _Look, i: int, free: int):
        """Heap entry of the best place that begins at a start of a template
        and ends before the word `free`."""
        value, last = look.best(i, free)
        first = int(look.at[i])
        return (-value, first - last, first, self.bags[k][0], k, i, last) if value >= self.threshold else None


def scan(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """row (the whole input row) and licenses: array of (license, dice, first,
    last) for every place of the whole text that resembles a template."""
    ship(docs.sparkSession)
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batches):
        scanner = Scanner(threshold=threshold)
        for b in batches:
            found = [[dict(zip(("license", "dice", "first", "last"), f, strict=True)) for f in scanner.scan(x)] for x in values(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(found, kind)], ["row", "licenses"])

    whole = docs.select(F.struct(*columns(docs)).alias("row"), F.col(text_col).alias("text"))
    return whole.mapInArrow(run, with_row(whole, "licenses array<struct<license:string,dice:double,first:int,last:int>>"))
