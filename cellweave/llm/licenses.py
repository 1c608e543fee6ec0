r"""License scan: the best windows of a text by Dice coefficient over word bigrams.

Text and templates are normalised to runs of ASCII letters and digits in lower case. For a template of m distinct
bigrams, a window of s distinct bigrams can reach the Dice coefficient t only if t m / (2 - t) <= s <= m (2 - t) / t, and
it must share at least t m / (2 - t) bigrams; a template with fewer hits in a text is pruned before any window is
compared. Windows begin and end at hits. Of overlapping findings the better one stays (then the earlier, the longer, the
smaller name); whole permission texts are placed before the sentences that are templates too. Each text is scanned whole
and alone. Licences without a template are not found, or take the name of one they equal to ``LEAST``; ``templates_of``
reads further templates from a table.

Null text has no words and no findings. Rows may repeat and give repeated findings; null doc_id passes through.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, table

LEAST = 0.8
# Public licence texts and notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
        "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies."),
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Proprietary": "All rights reserved.",
}

# Neighbouring families and versions, so that the best Dice chooses between them.
TEMPLATES["GPL-2.0"] = "This work is licensed under the GNU General Public License, version 2."
TEMPLATES |= {f"LGPL-{v}": f"This work is licensed under the GNU Lesser General Public License, version {v.removesuffix('.0')}." for v in ("2.1", "3.0")}
TEMPLATES["AGPL-3.0"] = "This work is licensed under the GNU Affero General Public License, version 3."
for _name, _work, _family, _version in (
        ("GPL-2.0", "program", "General", "2"), ("LGPL-2.1", "library", "Lesser General", "2.1"), ("LGPL-3.0", "program", "Lesser General", "3"),
        ("AGPL-3.0", "program", "Affero General", "3")):
    TEMPLATES[f"{_name}-header"] = (
        f"This {_work} is free software: you can redistribute it and/or modify it under the terms of the GNU {_family} Public License as published by "
        f"the Free Software Foundation, either version {_version} of the License, or (at your option) any later version.")
for _name, _family, _version, _date in (
        ("GPL-2.0", "General", "2", "June 1991"), ("GPL-3.0", "General", "3", "29 June 2007"), ("LGPL-2.1", "Lesser General", "2.1", "February 1999"),
        ("LGPL-3.0", "Lesser General", "3", "29 June 2007"), ("AGPL-3.0", "Affero General", "3", "19 November 2007")):
    TEMPLATES[f"{_name}-title"] = f"GNU {_family} Public License Version {_version}, {_date}"
for _short, _long in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
                      ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _version, _port in (("4.0", "International"), ("3.0", "Unported")):
        _name = f"CC-{_short}-{_version}"
        # The first templates hold one of the two forms of some names; the other gets a name of its own.
        for _end, _text in (("", f"This work is licensed under a Creative Commons {_long} {_version} {_port} License."), ("-short", f"Licensed under CC {_short} {_version}.")):
            if _text not in TEMPLATES.values():
                TEMPLATES[_name + (_end or "-long" * (_name in TEMPLATES))] = _text
TEMPLATES |= {
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MPL-1.1": (
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this "
        "distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/"),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    "BUSL-1.1": "Use of this software is governed by the Business Source License included in the LICENSE file.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions:"),
}
_CLAUSES = (
    TEMPLATES["BSD"] + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. ")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_END = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
    "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.")
# Whole permission texts hold sentences that are templates themselves, so they are placed first.
WHOLE = {
    "BSD-2-Clause": _CLAUSES + _BSD_END,
    "BSD-3-Clause": _CLAUSES + _THIRD + _BSD_END,
    "ISC-full": TEMPLATES["ISC"] + _ISC_END,
    "0BSD": TEMPLATES["ISC"].split(", provided")[0] + "." + _ISC_END,
    "MIT-full": TEMPLATES["MIT-text"] + (
        ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "Unlicense-full": TEMPLATES["Unlicense"] + (
        " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."),
}
_WORD = re.compile(rb"[a-z0-9]+")


def normalised(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


class Scanner:
    def __init__(self, templates: Mapping[str, str], least: float, whole: Mapping[str, str] | None = None):
        self.least = least
        self.whole = frozenset(whole or ())
        self.sets = {name: frozenset(zip(w, w[1:])) for name, w in ((n, normalised(t)) for n, t in {**templates, **(whole or {})}.items())}
        self.owners = defaultdict(list)
        for name, own in sorted(self.sets.items()):
            for pair in own:
                self.owners[pair].append(name)

    def _windows(self, pairs: list, places: list[int], name: str) -> Iterator[tuple]:
        own = self.sets[name]
        low = math.ceil(self.least * len(own) / (2 - self.least) - 1e-9)
        high = math.floor(len(own) * (2 - self.least) / self.least + 1e-9)
        if len({pairs[p] for p in places}) < low:
            return
        for i, first in enumerate(places):
            seen, shared, at, best = set(), 0, first, None
            for last in places[i:]:
                for pair in pairs[at:last + 1]:
                    if pair not in seen:
                        seen.add(pair)
                        shared += pair in own
                at = last + 1
                if len(seen) > high:
                    break
                dice = 2 * shared / (len(seen) + len(own))
                if dice >= self.least and (best is None or dice > best[0]):
                    best = (dice, last)
            if best:
                yield (-best[0], first, first - best[1], name)

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, Dice, first word, word after the last) of the findings in order."""
        words = normalised(text)
        pairs = list(zip(words, words[1:]))
        places = defaultdict(list)
        for i, pair in enumerate(pairs):
            for name in self.owners.get(pair, ()):
                places[name].append(i)
        found = sorted(w for name, own in places.items() for w in self._windows(pairs, own, name))
        found.sort(key=lambda w: w[3] not in self.whole)
        taken, out = set(), []
        for dice, first, length, name in found:
            span = range(first, first - length + 2)
            if taken.isdisjoint(span):
                taken.update(span)
                out.append((name, -dice, first, span.stop))
        return sorted(out, key=lambda x: x[2])


def templates_of(rows: DataFrame) -> dict[str, str]:
    """Templates from a user's small table (license, text), for ``find``; rows with a null are left out, of a repeated name the least text counts."""
    named = rows.where("license is not null and text is not null").groupBy("license").agg(F.min("text").alias("text"))
    return {r["license"]: r["text"] for r in named.collect()}


def find(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST, whole: Mapping[str, str] = WHOLE) -> DataFrame:
    """One row per finding: doc_id, license, dice, start_word, end_word."""
    scanner = Scanner(templates, least, whole)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                for one in scanner.scan(text or ""):
                    rows.append(row)
                    found.append(one)
            names, dice, first, last = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(dice, pa.float64()),
                pa.array(first, pa.int64()), pa.array(last, pa.int64())], names=["doc_id", "license", "dice", "start_word", "end_word"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, license string, dice double, start_word long, end_word long")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return find(table(spark, folder, "documents"))
