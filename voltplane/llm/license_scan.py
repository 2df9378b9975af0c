"""Licence scan: runs of words of a document, normalised, are held against licence templates by the Dice coefficient of their word bigrams.

Normalised: A-Z lower-cased, everything but a-z, 0-9 and characters beyond ASCII taken as a blank, line breaks too: a licence is found in the middle of
a line of prose as well as over many lines. Dice = 2 |A and B| / (|A| + |B|) over multisets of bigrams, so Dice >= t needs sizes within
t / (2 - t) of each other, and at least t (|A| + |B|) / 2 bigrams in common.

* A text with fewer bigrams of a template than the smallest run in bounds would have to share with it is not held against that template.
* A run starts and ends with a bigram of its template, as any other is less like it than the same run cut there. A start is tried only if
  enough bigrams of the template lie within the longest run in bounds.
* Of the runs from one start against one template the one with the highest Dice counts, of equal ones the longest.

The templates are a short list that every task holds. Documents are scanned whole, in one map, without a shuffle, in parts of bounded size.

Of overlapping findings the one with the higher Dice stays; ties go to the earlier start, then the longer run, then the template's name.

Defined results: a null, empty or wordless text has no findings; repeated rows are scanned one by one; other columns stay, and a column named `licenses`
is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_TABLE, cut_at_blanks, in_parts, utf8

# fixed values: notices and short texts of public licences
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "ISC": [
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}

FINDING = T.StructType(
    [
        T.StructField("license", T.StringType()),
        T.StructField("dice", T.DoubleType()),
        T.StructField("first_word", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
        T.StructField("first_line", T.IntegerType()),
        T.StructField("n_lines", T.IntegerType()),
    ]
)
_WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(ALNUM_TABLE).split()


class Template:
    """The bigrams of a template by number, and what a run must have to be like it."""

    def __init__(self, name: str, counts: Counter, least: float):
        self.name, self.counts, self.size = name, counts, counts.total()
        self.shortest = max(1, math.ceil(self.size * least / (2 - least) - 1e-9))
        self.longest = math.floor(self.size * (2 - least) / least + 1e-9)
        self.fewest = math.ceil(least * (self.shortest + self.size) / 2 - 1e-9)


class Scanner:
    def __init__(self, templates: dict[str, list[str]], least: float):
        self.least = least
        self.words: dict[bytes, int] = {}
        numbers: dict[tuple[int, int], int] = {}
        self.templates = []
        for name, texts in templates.items():
            for text in texts:
                ids = [self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)]
                counts = Counter(numbers.setdefault(g, len(numbers)) for g in zip(ids, ids[1:], strict=False))
                if counts:
                    self.templates.append(Template(name, counts, least))
        #: The number of a bigram at (first word, second word), -1 if it is in no template.
        self.bigrams = np.full((len(self.words) + 1,) * 2, -1, np.int32)
        for (a, b), g in numbers.items():
            self.bigrams[a, b] = g
        #: For each template, which bigrams it has; the last column stands for none.
        self.has = np.zeros((len(self.templates), len(numbers) + 1), bool)
        for row, t in zip(self.has, self.templates, strict=True):
            row[list(t.counts)] = True

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, dice, first word, number of words) of each finding, in the order of the text."""
        get = self.words.get
        ids = np.concatenate([np.array([get(w, 0) for w in part.split()], np.int32) for part in cut_at_blanks(utf8(text).translate(ALNUM_TABLE))])
        grams = self.bigrams[ids[:-1], ids[1:]]
        places = np.flatnonzero(grams >= 0)
        if not len(places):
            return []
        grams = grams[places]
        often = np.bincount(grams, minlength=self.has.shape[1])
        found = [x for t, has in zip(self.templates, self.has, strict=True) if often[has].sum() >= t.fewest for x in self._runs(t, places[has[grams]], grams[has[grams]])]
        found.sort(key=lambda x: (-x[1], x[2], -x[3], x[0]))
        taken, out = bytearray(len(ids)), []
        for x in found:
            mine = slice(x[2], x[2] + x[3])
            if not any(taken[mine]):
                taken[mine] = b"\x01" * x[3]
                out.append(x)
        return sorted(out, key=lambda x: x[2])

    def _runs(self, t: Template, places: np.ndarray, grams: np.ndarray) -> Iterator[tuple[str, float, int, int]]:
        """The best run from each place of a bigram of the template."""
        within = np.searchsorted(places, places + t.longest) - np.arange(len(places))
        starts = np.flatnonzero(within >= t.fewest)
        for start in starts.tolist():
            have: Counter = Counter()
            common, best, end = 0, 0.0, 0
            first = int(places[start])
            for at, g in zip(places[start : start + within[start]].tolist(), grams[start : start + within[start]].tolist(), strict=True):
                have[g] += 1
                if have[g] <= t.counts[g]:
                    common += 1
                n = at - first + 1
                if n >= t.shortest and (dice := 2 * common / (n + t.size)) >= max(self.least, best):
                    best, end = dice, at
            if best:
                yield t.name, best, first, end - first + 2

    def findings(self, text: str | None) -> list[dict]:
        found = self.scan(text)
        if not found:
            return []
        data = utf8(text)
        spans = [m.span() for m in _WORD.finditer(data.translate(ALNUM_TABLE))]
        out, line, seen = [], 0, 0
        for name, dice, first, n in found:
            begin, end = spans[first][0], spans[first + n - 1][1]
            line, seen = line + data.count(b"\n", seen, begin), begin
            out.append({"license": name, "dice": dice, "first_word": first, "n_words": n, "first_line": line, "n_lines": data.count(b"\n", begin, end) + 1})
        return out


def license_scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: float = 0.8, text_col: str = "text") -> DataFrame:
    """The documents with licenses array<struct<license, dice, first_word, n_words, first_line, n_lines>>, in the order of the text."""
    docs = docs.drop("licenses")
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(TEMPLATES if templates is None else templates, least))
    schema = T.StructType([*docs.schema.fields, T.StructField("licenses", T.ArrayType(FINDING))])
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), *((c, pa.int32()) for c in ("first_word", "n_words", "first_line", "n_lines"))]))

    def scan() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        held = scanner.value

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found = [held.findings(t.as_py()) for t in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=schema.names)

        return part

    return docs.mapInArrow(in_parts(scan, text_col), schema)


def report(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, n_licenses, licenses (distinct names in order, comma-joined), best_dice, licenses_found (all findings)."""
    found = license_scan(docs.select("doc_id", "text"), **how).withColumnRenamed("licenses", "licenses_found")
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("licenses_found", lambda x: x["license"]))), ",")
    return found.select("doc_id", F.size("licenses_found").alias("n_licenses"), names.alias("licenses"), F.array_max(F.transform("licenses_found", lambda x: x["dice"])).alias("best_dice"), "licenses_found")
