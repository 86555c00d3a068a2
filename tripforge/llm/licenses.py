"""License scan: normalised text against licence templates by the Dice
coefficient over word bigrams.

Normalising lower-cases, spells ``licence`` as ``license`` and keeps words of
``[a-z0-9]``.  A template with B bigrams is compared with stretches of a text:
runs of the template's own bigrams in the text, not further apart than half the
template.  Dice is 2 * common / (B + stretch), bigrams counted with repeats, so
it can reach the threshold t only if the stretch has between B * t / (2 - t) and
B * (2 - t) / t bigrams: templates outside these size bounds are pruned before
they are compared.  So a licence is found on a line, inside a paragraph, over
many lines or as the whole text alike.  Of overlapping finds the one of the
higher coefficient stays (ties: the longer, then by name); one inside a longer
one counts with its template's coefficient over all of the longer one.

Returns one row for each find; texts without a licence have none.  Null, empty
and one-word texts have no bigrams.  Repeated rows are each scanned.  Extra
columns are ignored.  The templates are a fixed list; nothing grows with the
corpus and nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import text_of
from tripforge.llm.license_texts import BODIES

# The wording of common licences and of the notices that name them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-4.0-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    **{f"CC-BY-{short}-4.0-work": f"This work is licensed under a Creative Commons Attribution-{name} 4.0 International License."
       for short, name in (("SA", "ShareAlike"), ("NC", "NonCommercial"), ("ND", "NoDerivatives"),
                           ("NC-SA", "NonCommercial-ShareAlike"), ("NC-ND", "NonCommercial-NoDerivatives"))},
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."),
}
for _name, _work, _license, _version in (
        ("GPL-2.0", "program", "General", "2"), ("LGPL-2.1", "library", "Lesser General", "2.1"),
        ("LGPL-3.0", "program", "Lesser General", "3"), ("AGPL-3.0", "program", "Affero General", "3")):
    TEMPLATES[f"{_name}-header"] = (
        f"This {_work} is free software; you can redistribute it and/or modify it under the terms of the GNU {_license} Public "
        f"License as published by the Free Software Foundation; either version {_version} of the License, or (at your option) "
        f"any later version. This {_work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {_license} Public "
        "License for more details.")
TEMPLATES |= BODIES
# the Affero licence is the GPL with its own name and section 13 (and a preamble of its own)
_before, _rest = BODIES["GPL-3.0"].split("13. Use with the GNU Affero General Public License.")
_affero = [x.replace("GNU General Public License", "GNU Affero General Public License")
           for x in (_before, _rest[_rest.index("14. Revised Versions"):])]
TEMPLATES["AGPL-3.0"] = (
    f"{_affero[0]}13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision of "
    "this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely "
    "through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of "
    "your version by providing access to the Corresponding Source from a network server at no charge, through some standard or "
    "customary means of facilitating copying of software. This Corresponding Source shall include the Corresponding Source for any "
    "work covered by version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph. "
    "Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a work "
    "licensed under version 3 of the GNU General Public License into a single combined work, and to convey the resulting work. The "
    "terms of this License will continue to apply to the part which is the covered work, but the work with which it is combined "
    f"will remain governed by version 3 of the GNU General Public License. {_affero[1]}")
_WORD = re.compile(r"[a-z0-9]+")


def normalised(text: str) -> list[str]:
    return _WORD.findall(text.lower().replace("licence", "license"))


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:]))


class Templates:
    """Templates by bigram, with the size bounds of a threshold."""

    def __init__(self, texts: dict[str, str], threshold: float):
        self.grams = {n: Counter(bigrams(normalised(t))) for n, t in sorted(texts.items())}
        self.size = {n: sum(c.values()) for n, c in self.grams.items()}
        self.low = {n: s * threshold / (2 - threshold) for n, s in self.size.items()}
        self.high = {n: s * (2 - threshold) / threshold for n, s in self.size.items()}
        self.threshold = threshold
        self.having = defaultdict(list)
        for n, c in self.grams.items():
            for g in c:
                self.having[g].append(n)
        self.openers = frozenset(g[0] for g in self.having)

    def dice(self, name: str, grams: list[tuple[str, str]]) -> float:
        own = Counter(grams)
        common = sum(min(n, own[g]) for g, n in self.grams[name].items() if g in own)
        return 2 * common / (self.size[name] + len(grams))

    def finds(self, text: str) -> list[tuple[str, float, int, int]]:
        """(name, coefficient, first word, words) of the licences in a text."""
        words = normalised(text)
        hits = defaultdict(list)
        openers, having = self.openers, self.having
        for i, w in enumerate(words[:-1]):
            if w in openers:
                for n in having.get((w, words[i + 1]), ()):
                    hits[n].append(i)
        found = []
        for n, at in hits.items():
            if len(at) < self.low[n] * self.threshold / 2:     # too few of its bigrams anywhere
                continue
            run = [at[0]]
            for i in [*at[1:], None]:
                if i is not None and i - run[-1] <= max(2, self.size[n] // 2):
                    run.append(i)
                    continue
                found += self._best(n, words, run)
                run = [i]
        # a find inside a longer one counts as its template does over all of that:
        # a licence's first clauses, or a notice in its text, are not another licence
        least = min((f[3] for f in found), default=0)
        longer = [f for f in found if f[3] > least]
        rank = {}
        for f in found:
            rank[f] = min([f[1], *(self.dice(f[0], bigrams(words[g[2]:g[2] + g[3]])) for g in longer
                                   if g[3] > f[3] and g[0] != f[0] and g[2] <= f[2] and f[2] + f[3] <= g[2] + g[3])])
        found.sort(key=lambda f: (-rank[f], -f[3], f[0], f[2]))
        taken, out = [], []
        for f in found:
            if all(f[2] >= z or f[2] + f[3] <= a for a, z in taken):
                taken.append((f[2], f[2] + f[3]))
                out.append(f)
        return sorted(out, key=lambda f: f[2])

    def _best(self, name: str, words: list[str], run: list[int]):
        """Finds in a run of the template's bigrams: greedily the best stretch that
        starts and ends at one of them and whose size lies in the bounds."""
        own, total, low, high, t = self.grams[name], self.size[name], self.low[name], self.high[name], self.threshold
        grams = [(words[k], words[k + 1]) for k in run]
        out, i = [], 0
        inside, have, start, end = Counter(), 0, 0, 0      # of run[start:end]: the common bigrams
        while i < len(run):
            reach = bisect_right(run, run[i] + high - 1)   # further ends are too far
            while end < reach:
                inside[grams[end]] += 1
                have += inside[grams[end]] <= own[grams[end]]
                end += 1
            while start < i:
                have -= inside[grams[start]] <= own[grams[start]]
                inside[grams[start]] -= 1
                start += 1
            best = None
            if 2 * have >= t * (total + max(low, have)) - 1e-9:      # else no end can do
                seen, common = Counter(), 0
                for j in range(i, reach):
                    seen[grams[j]] += 1
                    common += seen[grams[j]] <= own[grams[j]]
                    size = run[j] - run[i] + 1
                    d = 2 * common / (total + size)
                    if size >= low and d >= t and (best is None or d > best[1]):
                        best = (name, d, run[i], size + 1, j)
            if best:
                out.append(best[:4])
                i = best[4] + 1
            else:
                i += 1
        return out


def license_finds(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """(doc_id, license, dice, first_word, n_words): one row for each find."""
    texts = TEMPLATES if templates is None else templates

    def run(batches):
        t = Templates(texts, threshold)
        for b in batches:
            rows = [(i, *f) for i, x in zip(b["doc_id"], b["text"]) for f in t.finds(x)]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "dice", "first_word", "n_words"])
            yield out.astype({"doc_id": "Int64"})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(
        run, "doc_id long, license string, dice double, first_word long, n_words long")
