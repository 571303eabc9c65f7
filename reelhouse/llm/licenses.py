"""Licence scans (operator 9), in DataFrame functions only.

A text is normalised (lower case, everything but letters and digits a break between words) and its
runs of words are compared with licence templates by the Dice coefficient over sets of word bigrams:
2 * common / (bigrams of the run + bigrams of the template).  A run has its template's number of
words (what is left of the text, if less), starts at any bigram of the template and takes no notice
of lines, so a notice wrapped over lines or inside a longer sentence, a header and a whole licence
text are found alike.  Of runs that overlap the better one stays: a run is reported unless one with
a higher coefficient (ties: larger template, earlier start, smaller names) shares a word with it.

A set of size a can reach the coefficient t with one of size b only if
t * b / (2 - t) <= a <= (2 - t) * b / t, and then they have at least t * b / (2 - t) in common.  Three
steps follow from this bound, each losing nothing:

* of any b - lower + 1 of a template's bigrams a match has one, so its longer word; a text without
  any such word of any template is done when its words are cut;
* a template with fewer than ``lower`` of its bigrams in the whole text is no candidate;
* a run whose ``lower``-th bigram of the template lies beyond its end is not compared.

Nothing is shuffled: a text is one row and one expression, templates are a parameter inside it.

Defined cases: null text and texts of fewer than two words match nothing; a template of fewer than
two words takes no part; repeated ids give their rows each; a null id stays null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Customary notices, the standard headers and the short licence texts as published,
# without the copyright line.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation; either version 2 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
        General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
    that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
    this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
    copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
    provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
    IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
    PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
    INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
    SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
    THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
    ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEXTS = {
    "BSD-2-Clause": f"{_BSD} {_BSD_DISCLAIMER}",
    "BSD-3-Clause": f"{_BSD} {_BSD_THIRD} {_BSD_DISCLAIMER}",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
        NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
        AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use
        this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not
        claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
        product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
        marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed
        or altered from any source distribution.""",
}
TEMPLATES = {"header": HEADERS, "notice": NOTICES, "text": TEXTS,
             "tag": {name: f"SPDX-License-Identifier: {name}" for name in sorted({*NOTICES, *HEADERS, *TEXTS})}}


def template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def least_common(size: int, percent: int) -> int:
    """How many of a template's ``size`` bigrams a run that reaches ``percent`` has at least."""
    return -(-percent * size // (200 - percent))


def needed_words(grams: list[str], percent: int) -> set[str]:
    """Words of which every run that reaches ``percent`` with the template has one."""
    ranked = sorted(grams, key=lambda g: (-max(map(len, g.split())), g))
    return {max(g.split(), key=len) for g in ranked[:len(grams) - least_common(len(grams), percent) + 1]}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _bigrams(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _runs(words: Column, grams: Column, candidates: Column, percent: int) -> Column:
    """Runs that reach ``percent``; ``candidates`` are templates with the places of their bigrams."""
    def compared(t: Column, x: Column) -> Column:
        return _let(F.array_distinct(F.slice(grams, x.p, t.n_words - 1)), lambda run: F.struct(
            x.p.alias("start"), t.license.alias("license"), t.kind.alias("kind"),
            F.size(F.array_intersect(run, t.grams)).alias("n_common"), F.size(run).alias("n_run"),
            F.size(t.grams).alias("n_template"), F.slice(words, x.p, t.n_words).alias("run")))

    def of_template(t: Column) -> Column:
        near = F.filter(t.hits, lambda x, i: F.get(t.hits, i + t.least - 1).p <= x.p + t.n_words - 2)
        return F.filter(F.transform(near, lambda x: compared(t, x)),
                        lambda m: 200 * m.n_common >= percent * (m.n_run + m.n_template))

    return F.flatten(F.transform(candidates, of_template))


def _dice(m: Column) -> Column:
    return F.round(F.lit(2.0) * m.n_common / (m.n_run + m.n_template), 6)


def _best(runs: Column, reach: int) -> Column:
    """Runs that no better one overlaps; at most ``reach`` runs start within a template's length."""
    def rank(m: Column) -> Column:
        return F.struct(-_dice(m), -m.n_template, m.start, m.license, m.kind)

    def beaten(m: Column, o: Column) -> Column:
        return ((o.start < m.start + F.size(m.run)) & (m.start < o.start + F.size(o.run)) & (rank(o) < rank(m)))

    return _let(F.sort_array(runs), lambda all_runs: F.filter(all_runs, lambda m, i: ~F.exists(
        F.slice(all_runs, F.greatest(i + 1 - reach, F.lit(1)), F.lit(2 * reach + 1)), lambda o: beaten(m, o))))


def license_matches(docs: DataFrame, templates: dict[str, dict[str, str]] | None = None, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per run of words that reaches ``percent`` and is overlapped by no better one: id, ``start``
    (its first word, from 0), ``n_words``, ``license`` and ``kind`` of the template (``templates``: kind →
    licence → text), ``n_common``, ``n_run`` and ``n_template`` bigrams, ``dice`` and ``run``, its words."""
    known = [(name, kind, len(template_words(text)), template_bigrams(text))
             for kind, texts in sorted((templates or TEMPLATES).items()) for name, text in sorted(texts.items())]
    known = [t for t in known if t[3]]
    if not known:
        raise ValueError("no template has two words")
    needed = sorted(set().union(*(needed_words(grams, percent) for *_, grams in known)))
    every = sorted({g for *_, grams in known for g in grams})
    reach = len(known) * max(n for _, _, n, _ in known)

    def places(grams: Column) -> Column:
        at = F.transform(grams, lambda g, i: F.when(g.isin(every), F.struct((i + 1).alias("p"), g.alias("gram"))))
        return F.filter(at, lambda x: x.isNotNull())

    def places_of(hits: Column, grams: list[str]) -> Column:
        return F.filter(hits, lambda x: x.gram.isin(grams))

    def candidates(hits: Column) -> Column:
        rows = [F.struct(F.lit(name).alias("license"), F.lit(kind).alias("kind"), F.lit(n).alias("n_words"),
                         F.lit(least_common(len(grams), percent)).alias("least"), _strings(grams).alias("grams"),
                         places_of(hits, grams).alias("hits"))
                for name, kind, n, grams in known]
        return F.filter(F.array(*rows), lambda t: F.size(t.hits) >= t.least)

    def of_words(words: Column) -> Column:
        found = _let(_bigrams(words), lambda grams: _let(places(grams), lambda hits: _best(
            _runs(words, grams, candidates(hits), percent), reach)))
        return F.when(F.arrays_overlap(words, _strings(needed)), found)

    # outer: an inner explode would have the expression made again for a filter before it
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"),
                       F.explode_outer(_let(_words(F.col(f"`{text_col}`")), of_words)).alias("m")).filter("m IS NOT NULL")
    m = F.col("m")
    return rows.select(F.col("_id").alias(id_col), (m.start - 1).cast("long").alias("start"),
                       F.size(m.run).cast("long").alias("n_words"), m.license.alias("license"), m.kind.alias("kind"),
                       m.n_common.cast("long").alias("n_common"), m.n_run.cast("long").alias("n_run"),
                       m.n_template.cast("long").alias("n_template"), _dice(m).alias("dice"),
                       F.array_join(m.run, " ").alias("run"))


def oracle_sql(percent: int = 80) -> str:
    """The same on table documents with the default templates, in DuckDB SQL."""
    rows = ", ".join("('{}', '{}', {}, [{}])".format(name, kind, len(template_words(text)),
                                                     ", ".join("'" + g.replace("'", "''") + "'" for g in template_bigrams(text)))
                     for kind, texts in sorted(TEMPLATES.items()) for name, text in sorted(texts.items()))
    return f"""
WITH t(license, kind, n_words, grams) AS (VALUES {rows}),
tg AS (SELECT license, kind, n_words, len(grams) AS n_template, unnest(grams) AS gram FROM t),
w AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(string_split(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda s: s <> '') AS words
      FROM documents WHERE text IS NOT NULL),
b AS (SELECT r, i, words[i] || ' ' || words[i + 1] AS gram
      FROM (SELECT r, words, unnest(range(1, len(words))) AS i FROM w WHERE len(words) > 1) x),
hit AS (SELECT b.r, b.i, b.gram, tg.license, tg.kind, tg.n_words, tg.n_template FROM b JOIN tg ON tg.gram = b.gram),
enough AS (SELECT r, license, kind FROM hit GROUP BY r, license, kind, n_template
           HAVING 200 * count(*) >= {percent} * (count(*) + n_template)),
start AS (SELECT DISTINCT hit.r, hit.i, hit.license, hit.kind, hit.n_words, hit.n_template
          FROM hit SEMI JOIN enough ON enough.r = hit.r AND enough.license = hit.license AND enough.kind = hit.kind),
common AS (SELECT s.r, s.i, s.license, s.kind, s.n_words, s.n_template, count(DISTINCT h.gram) AS n_common
           FROM start s JOIN hit h ON h.r = s.r AND h.license = s.license AND h.kind = s.kind
                AND h.i BETWEEN s.i AND s.i + s.n_words - 2 GROUP BY ALL),
run AS (SELECT c.*, w.doc_id, w.words[c.i:c.i + c.n_words - 1] AS words,
               len(list_distinct(list_transform(range(c.i, least(c.i + c.n_words - 1, len(w.words))),
                                                lambda k: w.words[k] || ' ' || w.words[k + 1]))) AS n_run
        FROM common c JOIN w ON w.r = c.r WHERE c.n_common * (200 - {percent}) >= {percent} * c.n_template),
ok AS (SELECT *, round(2.0::DOUBLE * n_common / (n_run + n_template), 6) AS dice FROM run
       WHERE 200 * n_common >= {percent} * (n_run + n_template))
SELECT doc_id, (i - 1)::BIGINT AS start, len(words)::BIGINT AS n_words, license, kind, n_common::BIGINT AS n_common,
       n_run::BIGINT AS n_run, n_template::BIGINT AS n_template, dice, array_to_string(words, ' ') AS run
FROM ok m WHERE NOT EXISTS (
  SELECT 1 FROM ok o WHERE o.r = m.r AND o.i < m.i + len(m.words) AND m.i < o.i + len(o.words)
     AND (-o.dice, -o.n_template, o.i, o.license, o.kind) < (-m.dice, -m.n_template, m.i, m.license, m.kind))"""
