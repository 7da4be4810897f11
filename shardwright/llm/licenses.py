"""License scans by sentence rules.

Texts are cut into sentences, which are normalised (lower case, only letters, digits and dots inside
numbers; one space between words).  A sentence that is known, word for word, has an identifier; the
sequence of identifiers is then matched against ordered rules, each a sequence of identifiers.  Unknown
sentences may stand between those of a rule, up to `gap` of them.  At each place the longest rule that
fits wins, the first listed if several do, and matching goes on behind it, so matches don't overlap.

Cases: null and empty texts have no matches.  Copyright notices are `unknown` sentences.  Repeated rows
are reported one by one; a text may hold several matches, of one licence too.  Other columns are
ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of licences and of notices, by identifier.
SENTENCES = {
    "mit-name": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "mit-ref": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "Distributed under the MIT License."],
    "bsd-use": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "bsd-warranty": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."],
    "bsd-ref": ["Licensed under the BSD License.", "Released under the BSD License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "apache-grant": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "you may not use this file except in compliance with the License."],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at"],
    "apache-warranty": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "apache-terms": ["See the License for the specific language governing permissions and limitations under the License."],
    "apache-ref": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "Licensed under the Apache License 2.0."],
    "gpl3-ref": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License v3.0."],
    "gpl2-ref": ["Licensed under the GNU General Public License, version 2.", "This work is licensed under the GNU General Public License, version 2."],
    "gpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl2-grant": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl-details": ["See the GNU General Public License for more details."],
    "mpl2-form": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "mpl2-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc0": ["Licensed under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0."],
    "reserved": ["All rights reserved."],
    "lgpl21-grant": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "lgpl3-grant": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl-warranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "lgpl-details": ["See the GNU Lesser General Public License for more details."],
    "agpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl-details": ["See the GNU Affero General Public License for more details."],
    "zlib-warranty": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-liability": ["In no event will the authors be held liable for any damages arising from the use of this software."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "bsl-grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"],
    "bsl-ref": ["Distributed under the Boost Software License, Version 1.0."],
    "epl2-ref": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "0bsd-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
}
# Licences that a tag names.
TAGGED = "MIT BSD-2-Clause BSD-3-Clause Apache-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 ISC 0BSD Zlib BSL-1.0 EPL-2.0 Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0".split()
SENTENCES |= {f"tag-{name}": [f"SPDX-License-Identifier: {name}"] for name in TAGGED}
# Rules in order, (licence, identifiers).
RULES = [
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("Apache-2.0", ("apache-grant", "apache-copy", "apache-warranty", "apache-terms")),
    ("Apache-2.0", ("apache-ref", "apache-grant", "apache-copy", "apache-warranty", "apache-terms")),
    ("GPL-3.0-or-later", ("gpl3-grant", "gpl-warranty", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-grant", "gpl-warranty", "gpl-details")),
    ("MPL-2.0", ("mpl2-form", "mpl2-copy")),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("MIT", ("mit-ref",)),
    ("BSD", ("bsd-ref",)),
    ("Apache-2.0", ("apache-ref",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL-2.0", ("gpl2-ref",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC0-1.0", ("cc0",)),
    ("LicenseRef-all-rights-reserved", ("reserved",)),
    ("LGPL-2.1-or-later", ("lgpl21-grant", "lgpl-warranty", "lgpl-details")),
    ("LGPL-3.0-or-later", ("lgpl3-grant", "lgpl-warranty", "lgpl-details")),
    ("AGPL-3.0-or-later", ("agpl3-grant", "gpl-warranty", "agpl-details")),
    ("Zlib", ("zlib-warranty", "zlib-liability", "zlib-grant")),
    ("BSL-1.0", ("bsl-grant",)),
    ("BSL-1.0", ("bsl-ref",)),
    ("EPL-2.0", ("epl2-ref",)),
    ("0BSD", ("0bsd-grant",)),
    *((name, (f"tag-{name}",)) for name in TAGGED),
]
#: Where a sentence ends: at stops before white space or the end, at blank lines and at list marks.
END = re.compile(r"[.;:!?]+(?=\s|$)|\n\s*\n|\n\s*(?:[*#/-]+|\d+\.)\s+|\n(?=[^a-z]*\n|[A-Z])")
NOISE = re.compile(r"[^a-z0-9.]+|\.(?![0-9])|(?<![0-9])\.")


def normalised(sentence: str) -> str:
    return " ".join(NOISE.sub(" ", sentence.lower()).split())


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences, stops included."""
    out, at = [], 0
    for m in END.finditer(text):
        stop = m.end() if m[0].strip(".;:!?") == "" else m.start()
        out.append((at, stop))
        at = m.end()
    return [*out, (at, len(text))]


KNOWN = {normalised(part): key for key, texts in SENTENCES.items() for text in texts for part in [text]}


def beginnings(known: dict[str, str]) -> set[str]:
    """The known sentences' first words, for each number of words."""
    return {" ".join(words[:n]) for words in map(str.split, known) for n in range(1, len(words) + 1)}


def identified(text: str, known: dict[str, str], starts: set[str]) -> list[tuple[int, int, int, str]]:
    """(number, start, end, identifier) of the known sentences; a number counts all sentences.

    Line ends, comment marks and stops may cut a known sentence into any number of pieces: pieces are
    joined as long as they begin one (starts: `beginnings`), and the longest known one is taken.
    """
    cuts, out, i = sentences(text), [], 0
    forms = [normalised(text[a:b]) for a, b in cuts]
    number = 0
    while i < len(cuts):
        if not forms[i]:
            i += 1
            continue
        group, j, last = forms[i], i + 1, None
        while group in starts:
            if group in known:
                last = j, known[group]
            while j < len(cuts) and not forms[j]:
                j += 1
            if j == len(cuts) or not forms[j]:
                break
            group, j = f"{group} {forms[j]}", j + 1
        if last:
            a, b = cuts[i][0], cuts[last[0] - 1][1]
            a += len(text[a:b]) - len(text[a:b].lstrip())
            b -= len(text[a:b]) - len(text[a:b].rstrip())
            out.append((number, a, b, last[1]))
            i = last[0]
        else:
            i += 1
        number += 1
    return out


def match_rules(found: list[tuple[int, int, int, str]], rules, gap: int) -> list[tuple[str, int, int, int]]:
    """(licence, start, end, sentences) of the rules that fit, from left to right."""
    out, i = [], 0
    while i < len(found):
        best = None
        for licence, keys in rules:
            if best and len(keys) <= len(best[1]):
                continue
            if tuple(f[3] for f in found[i : i + len(keys)]) == keys and all(b[0] - a[0] <= gap + 1 for a, b in zip(found[i : i + len(keys)], found[i + 1 : i + len(keys)], strict=False)):
                best = licence, keys
        if best:
            n = len(best[1])
            out.append((best[0], found[i][1], found[i + n - 1][2], n))
            i += n
        else:
            i += 1
    return out


#: Every known sentence holds one of these.
HINT = r"(?i)licen[sc]e|permi(?:t|ss)|copyright|redistribut|warrant|public|reserved|liable|endorse|creative"


def scan(docs: DataFrame, gap: int = 2) -> DataFrame:
    """doc_id, licence, first, last (code points, end exclusive), n_sentences: one row a match."""
    known, starts, rules = dict(KNOWN), beginnings(KNOWN), list(RULES)

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            maybe = pc.match_substring_regex(texts, HINT)
            rows = [(d, *m) for d, t in zip(batch.column(0).filter(maybe).to_pylist(), texts.filter(maybe).to_pylist(), strict=True) for m in match_rules(identified(t, known, starts), rules, gap)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 1 else pa.int64()) for i, c in enumerate(columns)], names=["doc_id", "licence", "first", "last", "n_sentences"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, licence string, first long, last long, n_sentences long")
