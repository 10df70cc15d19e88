"""License scans with DataFrame functions only.

A text is normalised (A-Z lowered, everything but a-z and 0-9 becomes one space, line
breaks too) and compared with licence templates by the Dice coefficient over the sets of
word bigrams, 2|A and B| / (|A| + |B|). Windows of as many words as the template has are
compared, one from each place where a bigram of the template stands (at the end of a
text what is left of it), so a notice is found inside a longer text and over line breaks.
A template is found at a coefficient of at least ``threshold``, in a window that holds at least half of the
bigrams that tell it from each of its rivals: templates of other licences that lie as close to it, whole or with a part ("lesser",
another clause). Of the versions that a template names, half at least must be there too. Of each template the best window is taken, and of windows that share over half the words of the smaller one
only the best counts: the higher coefficient, then the longer template, then the smaller name. So a text names the licence it holds and
not those that differ from it by a word.

Bounds prune without loss. Size: Dice >= t needs t/(2-t) <= |A|/|B| <= (2-t)/t, and as
|A and B| <= |A|, the text must hold t/(2-t) of the template's bigrams. Anchors: for each
template a few long words are kept that occur in more than 1 - t/(2-t) of its bigrams; a
text with none of those words holds too few. Texts without any anchor are not cut into
words, and a template is only compared in windows where the whole text holds enough of
it. All of it happens within a row: nothing is shuffled, whatever the keys.

Defined cases: null and empty texts hold no licence; of equally good windows of one template the first counts; a licence with several
templates counts once; very long texts are searched whole; repeated rows stay repeated;
other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.llm.common import ascii_lower, text_or_empty

THRESHOLD = 0.8
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: "
)
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BSD_2 = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(name: str, version: str, program: str = "program") -> str:
    """The header that the GNU licences ask files to carry."""
    return (
        f"This {program} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free "
        f"Software Foundation, either version {version} of the License, or (at your option) any later version. This {program} is distributed in the "
        f"hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        f"PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this {program}."
    )


#: Whole texts of short public licences, the headers that long ones ask files to carry, and customary one-line notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("This program is licensed under the GNU Affero General Public License, version 3.", _gnu("Affero General Public License", "3")),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain "
        "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License.",
    ),
    "BSD-2-Clause": ("This software is released under the BSD 2-Clause License.", _BSD + "1. " + _BSD_1 + "2. " + _BSD_2 + _BSD_AS_IS),
    "BSD-3-Clause": ("This software is released under the BSD 3-Clause License.", _BSD + "1. " + _BSD_1 + "2. " + _BSD_2 + "3. " + _BSD_3 + _BSD_AS_IS),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
        "covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
        "works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    ),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", _gnu("General Public License", "2")),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", _gnu("General Public License", "3")),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", _gnu("Lesser General Public License", "3", "library")),
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        _MIT, _MIT + _MIT_NOTICE + _AS_IS,
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
        "can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. 3. This notice may not be removed or altered from any source distribution.",
    ),
}

Templates = Mapping[str, Sequence[str]]
#: A bigram that names a version.
VERSION = "(version|v) [0-9]+"


def words(text: str) -> list[str]:
    """The words of a template, as the operator sees those of a text."""
    return re.findall("[a-z0-9]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def bigrams(text: str) -> list[str]:
    """A text's bigrams in order, repeats included."""
    w = words(text)
    return [f"{a} {b}" for a, b in zip(w, w[1:])]


def least_common(m: int, threshold: float) -> int:
    """How many of a template's m distinct bigrams a window that reaches the threshold holds at least."""
    return max(1, math.ceil(m * threshold / (2 - threshold) - 1e-9))


def anchors(templates: Templates, threshold: float) -> list[str]:
    """Words of which each text with a match holds at least one."""
    kept: set[str] = set()
    for text in sorted({t for ts in templates.values() for t in ts}):
        left = set(bigrams(text))
        spare = len(left) - least_common(len(left), threshold)  # so many may be missing in a match
        hit = 0
        for w in sorted({*words(text)}, key=lambda x: (x not in kept, -len(x), x)):
            if hit > spare:
                break
            found = {b for b in left if w in b.split(" ")}
            if found:
                kept.add(w)
                hit += len(found)
                left -= found
    return sorted(kept)


def rivals(templates: Templates, threshold: float) -> list[tuple[str, list[str], list[list[str]]]]:
    """(license, bigrams in order, for each rival those that tell it from that one) of each template.

    Its versions are told like those. A rival is a template of another licence of which a window as long as this template reaches the threshold with it.
    """
    each = [(n, bigrams(t)) for n, ts in sorted(templates.items()) for t in ts]
    out = []
    for name, g in each:
        own = set(g)
        told = {tuple(sorted(b for b in own if re.fullmatch(VERSION, b)))}
        for other, h in each:
            if other == name:
                continue
            windows = (set(h[i : i + len(g)]) for i in range(max(1, len(h) - len(g) + 1)))
            if max(2 * len(own & w) / (len(own) + len(w)) for w in windows) >= threshold:
                told.add(tuple(sorted(own - set(h))))
        out.append((name, g, sorted(list(x) for x in told if x)))
    return out


def _found(docs: DataFrame, templates: Templates, threshold: float, key: str, text: str) -> DataFrame:
    """(key, found): the windows that count in each row as (worse, less, license, at, size), worse being the negative coefficient."""
    sets = rivals(templates, threshold)
    if not sets or not all(g for _, g, _ in sets):
        raise ValueError("each template needs two words")
    texts = lambda xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")
    # one constant that every template is read from, so that the plan has each expression once
    known = F.array(*[
        F.struct(
            F.lit(name).alias("license"), texts(sorted(set(g))).alias("here"), F.lit(len(set(g))).alias("m"), F.lit(len(g)).alias("long"),
            F.lit(least_common(len(set(g)), threshold)).alias("need"), (F.array(*map(texts, told)) if told else F.array().cast("array<array<string>>")).alias("told"),
        )
        for name, g, told in sets
    ])
    low = docs.select(F.col(key).alias("key"), ascii_lower(text_or_empty(text)).alias("low"))
    some = F.lit(False)
    for a in anchors(templates, threshold):
        some = some | F.contains("low", F.lit(a))
    cut = F.when(some, F.split(F.trim(F.regexp_replace("low", "[^a-z0-9]+", " ")), " "))
    n = F.size("w") - 1
    grams = F.zip_with(F.slice("w", 1, n), F.slice("w", 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    every = texts(sorted({b for _, g, _ in sets for b in g}))
    rows = low.select("key", cut.alias("w")).select("key", F.when(n > 0, grams).alias("g"))
    rows = rows.select("key", "g", F.array_intersect("g", every).alias("held"))

    def window(t: Column, b: Column, i: Column) -> Column:
        """The window of a template from a place, null below the threshold."""
        part = F.slice("g", i + 1, t["long"])
        size = F.size(F.array_distinct(part))
        dice = F.lit(2.0) * F.size(F.array_intersect(part, t["here"])) / (size + t["m"])
        own = F.forall(t["told"], lambda d: 2 * F.size(F.array_intersect(part, d)) >= F.size(d))
        good = (size >= t["m"] * threshold / (2 - threshold) - 1e-9) & (dice >= threshold) & own
        made = F.struct((-dice).alias("worse"), (-t["long"]).alias("less"), t["license"].alias("license"), i.cast("bigint").alias("at"), (t["long"] + 1).alias("size"))
        return F.when(F.array_contains(t["here"], b) & good, made)

    def best(t: Column) -> Column:
        enough = (F.size("held") >= t["need"]) & (F.size(F.array_intersect("held", t["here"])) >= t["need"])
        return F.when(enough, F.array_min(F.transform("g", lambda b, i: window(t, b, i))))

    rows = rows.select("key", F.filter(F.transform(known, best), lambda x: x.isNotNull()).alias("all"))

    def beaten(f: Column, h: Column) -> Column:
        both = F.least(f["at"] + f["size"], h["at"] + h["size"]) - F.greatest(f["at"], h["at"])
        return (h["license"] != f["license"]) & (h < f) & (2 * both > F.least(f["size"], h["size"]))

    return rows.select("key", F.filter("all", lambda f: ~F.exists("all", lambda h: beaten(f, h))).alias("found"))


def license_spans(
    docs: DataFrame, templates: Templates = TEMPLATES, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, license, dice, first_word, n_words): the best window of each template found."""
    rows = _found(docs, templates, threshold, key, text).select("key", F.explode("found").alias("f"))
    return rows.select(
        F.col("key").alias(key), F.col("f.license").alias("license"), (-F.col("f.worse")).alias("dice"), F.col("f.at").alias("first_word"), F.col("f.size").alias("n_words")
    )


def scan(
    docs: DataFrame, templates: Templates = TEMPLATES, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each row of docs: key, n_licenses, license and dice of the best one (null: none), licenses (all, comma-joined)."""
    rows = _found(docs, templates, threshold, key, text)
    names = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["license"])))
    rows = rows.select("key", F.array_min("found").alias("b"), names.alias("names"))
    return rows.select(
        F.col("key").alias(key), F.size("names").cast("bigint").alias("n_licenses"), F.col("b.license").alias("license"), (-F.col("b.worse")).alias("dice"),
        F.when(F.size("names") > 0, F.array_join("names", ",")).alias("licenses"),
    )


def oracle_sql(templates: Templates = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for scan() over documents, without the pruning."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(n)}, {quote(' '.join(words(t)))})" for n, ts in sorted(templates.items()) for t in ts)
    grams = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    dice = "2.0::DOUBLE * len(list_intersect({0}, {1})) / (len({0}) + len({1}))"
    return f"""
WITH plain AS (SELECT row_number() OVER () AS k, license, {grams} AS g FROM (SELECT license, string_split(t, ' ') AS w FROM (VALUES {values}) v(license, t))),
near AS (SELECT DISTINCT a.k, b.k AS rival FROM plain a JOIN plain b ON a.license <> b.license, range(greatest(1, len(b.g) - len(a.g) + 1)) r(i)
  WHERE {dice.format("list_distinct(a.g)", "list_distinct(list_slice(b.g, i + 1, i + len(a.g)))")} >= {threshold}),
told AS (SELECT k, list(told) AS told FROM (SELECT near.k, list_filter(list_distinct(a.g), lambda x: NOT list_contains(b.g, x)) AS told FROM near JOIN plain a USING (k) JOIN plain b ON b.k = rival
  UNION ALL SELECT k, list_filter(list_distinct(g), lambda x: regexp_full_match(x, '{VERSION}')) FROM plain) GROUP BY k),
tpl AS (SELECT k, license, g, coalesce(told, []) AS told FROM plain LEFT JOIN told USING (k)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {grams} AS g FROM (SELECT doc_id,
  string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents)),
flat AS (SELECT r, unnest(g) AS b, generate_subscripts(g, 1) AS i FROM doc),
hit AS (SELECT r, i, k FROM flat JOIN (SELECT DISTINCT k, unnest(g) AS b FROM tpl) USING (b)),
win AS (SELECT r, i, k, license, len(tpl.g) + 1 AS n, told, list_distinct(list_slice(doc.g, i, i + len(tpl.g) - 1)) AS a, list_distinct(tpl.g) AS b FROM hit JOIN doc USING (r) JOIN tpl USING (k)),
good AS (SELECT * FROM (SELECT r, i, k, license, n, len(list_filter(told, lambda d: len(list_intersect(a, d)) * 2 < len(d))) = 0 AS own, {dice.format("a", "b")} AS dice FROM win) WHERE own AND dice >= {threshold}),
best AS (SELECT r, k, license, n, max(dice) AS dice, arg_min(i, (-dice, i)) AS i FROM good GROUP BY r, k, license, n),
kept AS (SELECT * FROM best f WHERE NOT EXISTS (SELECT 1 FROM best h WHERE h.r = f.r AND h.license <> f.license AND (-h.dice, -h.n, h.license, h.i) < (-f.dice, -f.n, f.license, f.i)
  AND 2 * (least(f.i + f.n, h.i + h.n) - greatest(f.i, h.i)) > least(f.n, h.n))),
per AS (SELECT r, count(DISTINCT license) AS n, arg_min(license, (-dice, -n, license, i)) AS license, max(dice) AS dice, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM kept GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licenses, license, dice, licenses FROM doc LEFT JOIN per USING (r)
"""
