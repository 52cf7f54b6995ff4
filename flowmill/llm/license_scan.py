"""Licence notices and licence texts, found by comparing word bigrams with templates; built-in functions only.

A text is compared as a whole, by paragraph, by line and by run of lines, so that a licence of several paragraphs or
comment lines inside a longer text is met as a whole. A unit of a distinct bigrams and a template of b agree by
the Dice coefficient 2 * common / (a + b). With a threshold of 0.8 that needs 3a >= 2b and 3b >= 2a, so most units are
left out by their number of words before any bigram is made, and most templates before any comparison. Runs are only
made of texts that hold, somewhere, the two thirds of a template's bigrams that any run in them needs, and only from lines
that are mostly licence text. Before that, texts without any of the words that every such unit needs are left out by one
pass of a pattern.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q

# The threshold, as a fraction.
DICE = (4, 5)

_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Public licence notices and texts by name, in order of preference at equal scores.
TEMPLATES: Mapping[str, str] = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 notice": "Licensed under CC BY-NC-ND 4.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        _PERMISSION + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause": _BSD_2 + _BSD_END,
    "BSD-3-Clause": _BSD_2 + _BSD_3 + _BSD_END,
}


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[^A-Za-z0-9]+", " ", text).strip().lower().split(" ")
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


# Words too common to tell a licence from other texts.
_COMMON = frozenset("a and any by for in is of or that the this to under with".split())


def telling_words(grams: Sequence[str]) -> list[str]:
    """Words of which every unit that reaches the threshold for these bigrams has at least one.

    Such a unit lacks at most ``spare`` of the bigrams, so it has one of any ``spare + 1``; the rarest-looking words that
    cover so many are taken.
    """
    p, d = DICE
    b = len(grams)
    least = -(-p * b // (2 * d - p))
    spare = b - -(-p * (least + b) // (2 * d))
    pairs = [g.split(" ") for g in grams]
    found, open_pairs = [], set(range(b))
    words = {w: {i for i, pair in enumerate(pairs) if w in pair} for pair in pairs for w in pair}
    while b - len(open_pairs) <= spare:
        word = min(words, key=lambda w: (w in _COMMON, len(w) < 5, -len(words[w] & open_pairs), -len(w), w))
        found.append(word)
        open_pairs -= words.pop(word)
    return found


def _any_of(words: Sequence[str]) -> str:
    """A pattern for any of the words, in either case, that looks at few alternatives in each place."""
    by_first: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        by_first.setdefault(word[0], []).append(word[1:])
    branches = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_first.items())
    return f"(?i)(?<![A-Za-z0-9])(?:{branches})(?![A-Za-z0-9])"


def _words(line: Column) -> Column:
    return F.filter(F.split(line, "[^A-Za-z0-9]+", -1), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))


def _paragraphs(lines: Column) -> Column:
    """Words between lines without words; nothing if there is no such line."""
    text = F.array_join(F.transform(lines, lambda x: F.array_join(x, " ")), "\n")
    parts = F.transform(F.split(text, "\n\n+", -1), lambda x: F.filter(F.split(x, "[ \n]", -1), lambda w: w != ""))
    return F.when(F.exists(lines, lambda x: F.size(x) == 0), parts).otherwise(F.array().cast(_LINES))


def _units(lines: Column) -> Column:
    """The words of every line, of every paragraph and of the whole text, if they differ from each other."""
    whole = F.when(F.size(lines) > 1, F.array(F.flatten(lines))).otherwise(F.array().cast(_LINES))
    return F.concat(lines, _paragraphs(lines), whole)


def _no_words() -> Column:
    return F.array().cast("array<string>")


def _with_shares(lines: Column, grams: Column) -> Column:
    """Every line with the number of its bigrams, and of the one that it ends, which are among the given ones."""

    def told(x: Column, i: Column) -> Column:
        before = F.slice(F.coalesce(F.get(lines, i - 1), _no_words()), -1, 1)
        return F.struct(x.alias("words"), F.size(F.array_intersect(_bigrams(F.concat(before, x)), grams)).alias("shared"))

    return F.transform(lines, told)


def _starts(lines: Column, grams: Column) -> Column:
    """Places (from 1) of lines of whose bigrams, with the one that the next line ends, more than p / 2d are among the
    given ones.

    Without another first line a run scores no less: of a run that reaches p / d, the shared bigrams are at least p / 2d
    of its own and the template's together, so a line that brings in a smaller share only lowers the score. Where bigrams
    of the line recur in the run this does not hold, and such a run is not looked at.
    """
    p, d = DICE

    def place(x: Column, i: Column) -> Column:
        after = F.slice(F.coalesce(F.get(lines, i + 1), _no_words()), 1, 1)
        shared = lambda own: 2 * d * F.size(F.array_intersect(own, grams)) > p * F.size(own)
        return F.when(F.exists(F.array(_bigrams(F.concat(x, after))), shared), i + 1)

    return F.filter(F.transform(lines, place), lambda i: i.isNotNull())


def _run_hits(lines: Column, start: Column, most: Column, best: Callable[[Column], Column]) -> Column:
    """Distinct hits of the runs of lines from one line on, up to ``most`` distinct bigrams and one line more than that.

    Every line has a word, so a longer run would have to repeat bigrams. A run of a distinct bigrams has at least p / (2d - p) * a of them in common with a template that it agrees with.
    """
    p, d = DICE

    def grown(state: Column, line: Column) -> Column:
        more = F.array_distinct(F.concat(state["grams"], _bigrams(F.concat(state["last"], line["words"]))))
        shared = state["shared"] + line["shared"]

        def step(g: Column) -> Column:
            found = F.array_union(state["hits"], F.filter(F.array(best(g)), lambda x: x.isNotNull()))
            return F.struct(
                g.alias("grams"),
                F.slice(line["words"], -1, 1).alias("last"),
                shared.alias("shared"),
                F.when((2 * d - p) * shared >= p * F.size(g), found).otherwise(state["hits"]).alias("hits"),
            )

        grown_by_one = F.element_at(F.transform(F.array(more), step), 1)
        return F.when(F.size(state["grams"]) > most, state).otherwise(grown_by_one)

    zero = F.struct(_no_words().alias("grams"), _no_words().alias("last"), F.lit(0).alias("shared"), F.array().cast(_HITS).alias("hits"))
    return F.aggregate(F.slice(lines, start, most + 1), zero, grown, lambda state: state["hits"])


def scan(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), templates: Mapping[str, str] = TEMPLATES
) -> DataFrame:
    """Per row: ``license`` (the best template's name), ``score`` (its Dice coefficient), ``licenses`` (best template of
    every unit that reaches the threshold, distinct, sorted, joined by ``;``) and ``n_licenses``.

    Without any: null, 0, empty, 0; so too for null and empty texts. At equal scores the earlier template wins. Texts of
    any length are compared whole, in time that grows with their length. Runs of lines pass over lines without words, so they
    join paragraphs; they start at lines that are mostly licence text (``_starts``) and have no more than ``most`` + 1
    lines, ``most`` being the distinct bigrams that a run may have. Templates need two words. Repeated rows stay; kept
    columns named like a result give way.
    """
    grams = {name: template_bigrams(t) for name, t in templates.items()}
    sizes = sorted({len(g) for g in grams.values()})
    p, d = DICE  # 2 * min(a, b) / (a + b) >= p / d is needed

    def in_size(words: Column) -> Column:
        # a unit of w words, v of them distinct, has at least v - 1 and at most w - 1 distinct bigrams
        high, low = F.size(words) - 1, F.size(F.array_distinct(words)) - 1
        fits = [((2 * d - p) * high >= p * b) & (p * low <= (2 * d - p) * b) for b in sizes]
        return F.when((2 * d - p) * high >= p * sizes[0], reduce(or_, fits)).otherwise(False)

    def listed(own: Sequence[str]) -> Column:
        return F.split(F.lit("|".join(own)), "[|]")

    def longest(unit: Column) -> Column:
        # most distinct bigrams of a run that can reach the threshold for a template of which the text has enough; else 0
        fits = []
        for own in grams.values():
            b = len(own)
            common = F.size(F.array_intersect(unit, listed(own)))
            fits.append(F.when((2 * d - p) * common >= p * b, (2 * d - p) * b // p).otherwise(0))
        return F.greatest(F.lit(0), *fits)

    def best(unit: Column) -> Column:
        a = F.size(unit)
        scored = []
        for place, (name, own) in enumerate(grams.items()):
            b = len(own)
            near = ((2 * d - p) * a >= p * b) & (F.lit((2 * d - p) * b) >= p * a)
            common = F.size(F.array_intersect(unit, listed(own)))
            score = F.when(near, F.when(d * 2 * common >= p * (a + b), 2.0 * common / (a + b)))
            hit = F.struct(score.alias("score"), F.lit(-place).alias("place"), F.lit(name).alias("name"))
            scored.append(F.when(score.isNotNull(), hit))
        return F.array_max(F.array(*scored))

    names = ["license", "score", "licenses", "n_licenses"]
    kept = [c for c in dict.fromkeys(keep) if c not in names]
    source = docs.select(*(q(c).alias(f"k{i}") for i, c in enumerate(kept)), q(text).cast("string").alias("text"))
    # one column after the other, so that no step is computed twice
    ids = [F.col(f"k{i}") for i in range(len(kept))]
    telling = _any_of([w for g in grams.values() for w in telling_words(g)])
    lines = F.transform(F.split("text", "\n", -1), _words)
    found = source.select(*ids, F.when(F.col("text").rlike(telling), lines).otherwise(F.array().cast(_LINES)).alias("lines"))
    found = found.select(*ids, F.transform("lines", lambda u: F.transform(u, F.lower)).alias("lines"))
    full = F.filter("lines", lambda x: F.size(x) > 0)
    found = found.select(*ids, _units(F.col("lines")).alias("units"), full.alias("lines"))
    # of up to two lines all runs are units already
    whole = F.when(F.size("lines") > 2, _bigrams(F.flatten("lines")))
    found = found.select(*ids, "units", "lines", whole.alias("whole"))
    most = F.when(F.size("whole") > 0, longest(F.col("whole"))).otherwise(0)
    found = found.select(*ids, "units", "lines", most.alias("most"))
    telling_grams = listed(list(dict.fromkeys(g for own in grams.values() for g in own)))
    starts = F.when(F.col("most") > 0, _starts(F.col("lines"), telling_grams)).otherwise(F.array().cast("array<int>"))
    found = found.select(*ids, "units", "lines", "most", starts.alias("starts"))
    shares = F.when(F.size("starts") > 0, _with_shares(F.col("lines"), telling_grams))
    found = found.select(*ids, "units", shares.alias("lines"), "most", "starts")
    in_runs = F.transform("starts", lambda i: _run_hits(F.col("lines"), i, F.col("most"), best))
    grams_of = F.transform(F.filter("units", in_size), _bigrams)
    hits = F.filter(F.transform(grams_of, best), lambda x: x.isNotNull())
    hits = F.concat(hits, F.flatten(in_runs))
    found = found.select(
        *(c.alias(name) for c, name in zip(ids, kept, strict=True)),
        F.coalesce(hits, F.array().cast(_HITS)).alias("_hits"),
    )
    top = F.array_max("_hits")
    licenses = F.array_sort(F.array_distinct(F.transform("_hits", lambda x: x["name"])))
    return found.select(
        *(q(c) for c in kept),
        top["name"].alias("license"),
        F.coalesce(top["score"], F.lit(0.0)).alias("score"),
        F.array_join(licenses, ";").alias("licenses"),
        F.size(licenses).cast("long").alias("n_licenses"),
    )


_LINES = "array<array<string>>"
_HITS = "array<struct<score:double,place:int,name:string>>"


def oracle(templates: Mapping[str, str] = TEMPLATES) -> str:
    """The same in SQL: units, runs of lines among them, and templates joined by their bigrams."""
    rows = ", ".join(
        f"({i}, '{name}', [{', '.join(repr(g) for g in template_bigrams(t))}])"
        for i, (name, t) in enumerate(templates.items())
    )
    return f"""
    WITH templates(place, name, grams) AS (VALUES {rows}),
    lines AS (
      SELECT doc_id, list_transform(string_split(text, chr(10)),
        lambda x: trim(lower(regexp_replace(x, '[^A-Za-z0-9]+', ' ', 'g')))) AS l
      FROM documents),
    units AS (
      SELECT DISTINCT doc_id, unnest(list_concat(l, list_concat(
        list_transform(regexp_split_to_array(array_to_string(l, chr(10)), '\\n\\n+'),
          lambda x: trim(replace(x, chr(10), ' '))),
        [array_to_string(list_filter(l, lambda x: x <> ''), ' ')]))) AS u
      FROM lines),
    filled AS (SELECT doc_id, list_filter(l, lambda x: x <> '') AS l FROM lines),
    known AS (SELECT list_distinct(flatten(list(grams))) AS g FROM templates),
    texts AS (
      SELECT doc_id, l, string_split(array_to_string(l, ' '), ' ') AS w FROM filled WHERE len(l) > 2),
    longest AS (
      SELECT doc_id, l, max(CASE WHEN 3 * len(list_intersect(t.g, grams)) >= 2 * len(grams) THEN 3 * len(grams) // 2 ELSE 0 END) AS most
      FROM (SELECT doc_id, l, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM texts) t,
        templates
      GROUP BY doc_id, l),
    first_lines AS (
      SELECT doc_id, l, most, s, string_split(l[s] || coalesce(' ' || string_split(l[s + 1], ' ')[1], ''), ' ') AS w
      FROM (SELECT doc_id, l, most, unnest(range(1, len(l) + 1)) AS s FROM longest WHERE most > 0)),
    starts AS (
      SELECT doc_id, l, most, s FROM (
        SELECT doc_id, l, most, s, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f
        FROM first_lines), known
      WHERE 10 * len(list_intersect(f, g)) > 4 * len(f)),
    runs AS (
      SELECT DISTINCT doc_id, array_to_string(l[s:e], ' ') AS u
      FROM (SELECT doc_id, l, s, unnest(range(s, least(s + most, len(l)) + 1)) AS e FROM starts)),
    words AS (
      SELECT doc_id, u, string_split(u, ' ') AS w FROM (SELECT * FROM units UNION SELECT * FROM runs)),
    grams AS (
      SELECT doc_id, u, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
      FROM words WHERE len(w) > 1),
    scored AS (
      SELECT doc_id, u, name, place, len(list_intersect(g, grams)) AS c, len(g) + len(grams) AS n
      FROM grams, templates
      WHERE 3 * len(g) >= 2 * len(grams) AND 3 * len(grams) >= 2 * len(g)),
    hits AS (
      SELECT doc_id, u, name, place, 2.0::DOUBLE * c / n AS score FROM scored WHERE 10 * c >= 4 * n
      QUALIFY row_number() OVER (PARTITION BY doc_id, u ORDER BY 2.0::DOUBLE * c / n DESC, place) = 1),
    best AS (
      SELECT doc_id, first(name ORDER BY score DESC, place) AS license, max(score) AS score,
        string_agg(DISTINCT name, ';' ORDER BY name) AS licenses, count(DISTINCT name) AS n_licenses
      FROM hits GROUP BY doc_id)
    SELECT d.doc_id, license, coalesce(score, 0.0::DOUBLE) AS score, coalesce(licenses, '') AS licenses,
      coalesce(n_licenses, 0) AS n_licenses
    FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id"""
