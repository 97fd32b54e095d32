"""Licence scans: Dice coefficient over word bigrams against licence templates.

A text's units are the whole text, its paragraphs (between lines without a-z and 0-9, so the
empty lines of a comment part them too), its sentences (after . ! ? before a blank; a sentence
may go over any number of lines of its paragraph) and the lines of its sentences, each
normalised: lower case, "licence" spelled "license", runs of anything but a-z and 0-9 one
blank. A unit matches a template if the Dice coefficient of their bigram bags (repeats
counted) is ``least`` or more: 2 * shared / (bigrams of both).

The long sentences of a notice are templates too (``with_sentences``), so a notice that is
wrapped inside a larger paragraph, or stands directly before code, is found by its sentences.

Sizes bound the coefficient: a unit of a bigrams can only match a template of b bigrams
if least / (2 - least) * b <= a <= (2 - least) / least * b, compared as integers (``least``
is the fraction that its decimal says). Units that fit no template's
bounds are dropped before their bigrams are made, others meet only the templates that
fit. A match also shares least / 2 * (a + b) bigrams, so it holds one of any set of bigrams
that covers all but fewer of the template's: units are first searched for a few bigrams of
each template that fits their size, and only those that hold one are taken apart. Neither
check loses a match. Units meet templates by equality of bigrams; counts are combined per task before
they are shuffled, keyed by the document's row, so a sentence that a third of all
documents repeat makes no hot key.

The templates are a parameter of a few hundred texts at most, checked against
``MOST_TEMPLATE_WORDS``; their bigrams are broadcast under that bound.

Defined cases: null and empty texts and units of fewer than two words match nothing;
equal units of a text count once; repeated rows give their own rows; the control
characters 1, 2 and 3 end a sentence, a paragraph and a line; a very long text is cut into its units
whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import table

LEAST = 0.8
MOST_TEMPLATE_WORDS = 500_000  # bounds the broadcast

# Public licence notices and headers, as (licence, text).
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD", "Released under the BSD License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    (
        "MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    (
        "MIT",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ),
    (
        "BSD",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "BSD",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.",
    ),
    (
        "ISC",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.",
    ),
    (
        "Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "LGPL-3.0",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at http://www.eclipse.org/legal/epl-2.0.",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
)


def normalised(text: str) -> str:
    """A template as the units are normalised."""
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip().replace("licence", "license")


LONG_SENTENCE = 12  # words from which a notice's sentence tells its licence


def with_sentences(notices) -> tuple:
    """The notices, and their sentences of ``LONG_SENTENCE`` words or more as templates of their own."""
    found = dict.fromkeys(notices)
    for licence, text in notices:
        for sentence in re.split(r"[.!?][ \t\r\n]+", text):
            if len(normalised(sentence).split()) >= LONG_SENTENCE and normalised(sentence) != normalised(text):
                found[licence, sentence] = None
    return tuple(found)


TEMPLATES = with_sentences(NOTICES)

_SENTENCE, _PARAGRAPH, _LINE = "\u0001", "\u0002", "\u0003"


def plain_text(text) -> "F.Column":
    """A text in normalised words, with marks where sentences, paragraphs and lines end."""
    breaks = F.regexp_replace(F.lower(text), r"\n[^a-z0-9\n]*\n[^a-z0-9]*", _PARAGRAPH)
    breaks = F.translate(F.regexp_replace(breaks, r"[.!?][ \t\r\n]+", _SENTENCE), "\n", _LINE)
    words = F.regexp_replace(breaks, f"[^a-z0-9{_SENTENCE}{_PARAGRAPH}{_LINE}]+", " ")
    return F.replace(words, F.lit("licence"), F.lit("license"))


def _count(text, *marks: str) -> "F.Column":
    left = text
    for mark in marks:
        left = F.replace(left, F.lit(mark), F.lit(""))
    return F.length(text) - F.length(left)


def units(plain, most: int) -> "F.Column":
    """Array of the distinct units of a ``plain_text``.

    Units of several lines that surely have more than ``most`` bigrams are left out at once:
    between two words there is one blank more than marks at most.
    """
    fits = lambda t: _count(t, " ") - _count(t, _SENTENCE, _PARAGRAPH, _LINE) - 2 <= most
    one = lambda t: F.regexp_replace(t, f"[ {_SENTENCE}{_PARAGRAPH}{_LINE}]+", " ")
    none = F.array().cast("array<string>")
    whole = F.when(fits(plain), F.array(one(plain))).otherwise(none)
    paragraphs = F.when(
        plain.contains(_PARAGRAPH), F.transform(F.filter(F.split(plain, _PARAGRAPH), fits), lambda p: one(p))
    ).otherwise(none)
    ended = F.replace(plain, F.lit(_PARAGRAPH), F.lit(_SENTENCE))
    wrapped = F.filter(F.split(ended, _SENTENCE), lambda t: t.contains(_LINE) & fits(t))
    sentences = F.when(plain.contains(_LINE), F.transform(wrapped, lambda t: one(t))).otherwise(none)
    lines = F.split(F.replace(ended, F.lit(_LINE), F.lit(_SENTENCE)), _SENTENCE)
    return F.array_distinct(F.transform(F.concat(whole, paragraphs, sentences, lines), lambda u: F.trim(u)))


def _template_rows(templates) -> list:
    """(template, licence, bigram, count, bigrams of the template) rows."""
    rows, total = [], 0
    for number, (licence, text) in enumerate(templates):
        words = normalised(text).split()
        total += len(words)
        bag = Counter(zip(words, words[1:]))
        rows += [(number, licence, f"{a} {b}", n, bag.total()) for (a, b), n in sorted(bag.items())]
    if total > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MOST_TEMPLATE_WORDS} words")
    return rows


def _fraction(least: float) -> tuple[int, int]:
    """(p, q) with least = p / q as its decimal is written."""
    exact = Fraction(str(least))
    return exact.numerator, exact.denominator


def _telling_bigrams(rows: list, least: float) -> list[list[str]]:
    """For every unit size a (from 1): bigrams of which a matching unit holds at least one.

    Per template of b bigrams: enough of them that a unit without any shares too few.
    Those that many templates have are taken first, so the lists stay short.
    """
    bags: dict[int, dict[str, int]] = {}
    for template, _, gram, n, _ in rows:
        bags.setdefault(template, {})[gram] = n
    common = Counter(gram for bag in bags.values() for gram in bag)
    p, q = _fraction(least)
    most = (2 * q - p) * max((sum(bag.values()) for bag in bags.values()), default=0) // p
    out = []
    for a in range(1, most + 1):
        grams: set[str] = set()
        for bag in bags.values():
            b = sum(bag.values())
            need = -(-p * (a + b) // (2 * q))
            if need > min(a, b):
                continue
            spare = b - need + 1
            for gram in sorted(bag, key=lambda g: (g not in grams, -common[g], g)):
                if spare <= 0:
                    break
                grams.add(gram)
                spare -= bag[gram]
        out.append(sorted(grams))
    return out


def license_matches(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id, license, matches (units), best (highest coefficient): a row per text and licence."""
    spark = docs.sparkSession
    rows = _template_rows(templates)
    grams = spark.createDataFrame(rows, "template int, license string, gram string, n long, b long")
    p, q = _fraction(least)
    telling = _telling_bigrams(rows, least)
    # A constant: the optimizer folds the parsed text into a literal.
    by_size = F.from_json(F.lit(json.dumps(telling)), "array<array<string>>")
    plain = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", plain_text(F.col("text")).alias("plain")
    )
    found = (
        plain.select("_row", "doc_id", F.posexplode(units(F.col("plain"), len(telling))))
        # Units have single blanks: their bigrams are counted without cutting them up.
        .withColumn("a", _count(F.col("col"), " ").cast("long"))
        .filter(
            F.col("a").between(1, len(telling))
            & F.exists(F.get(by_size, (F.col("a") - 1).cast("int")), lambda g: F.col("col").contains(g))
        )
        .withColumn("words", F.split("col", " "))
        .select(
            "_row",
            "doc_id",
            "pos",
            "a",
            F.explode(
                F.expr("transform(sequence(1, cast(a as int)), i -> concat(words[i - 1], ' ', words[i]))")
            ).alias("gram"),
        )
        .join(F.broadcast(grams), "gram")
        .filter((F.col("a") * (2 * q - p) >= F.col("b") * p) & (F.col("a") * p <= F.col("b") * (2 * q - p)))
    )
    shared = (
        found.groupBy("_row", "doc_id", "pos", "template", "license", "a", "b", "gram", "n")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_row", "doc_id", "pos", "template", "license", "a", "b")
        .agg(F.sum(F.least("n", "_n")).alias("shared"))
        .withColumn("dice", 2.0 * F.col("shared") / (F.col("a") + F.col("b")))
        .filter(2 * q * F.col("shared") >= p * (F.col("a") + F.col("b")))
    )
    return (
        shared.groupBy("_row", "doc_id", "license")
        .agg(F.countDistinct("pos").alias("matches"), F.max("dice").alias("best"))
        .drop("_row")
    )


def op9_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices in all documents: doc_id, license, matches, best."""
    return license_matches(table(spark, sf_dir, "documents"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _most_words(templates) -> int:
    """Words of the largest unit that can match."""
    p, q = _fraction(LEAST)
    return (2 * q - p) * max(len(normalised(text).split()) - 1 for _, text in templates) // p + 1


ORACLE_SQL = f"""
WITH t AS (
  SELECT (row_number() OVER ())::INTEGER AS template, license, string_split(text, ' ') AS words
  FROM (VALUES {", ".join(f"({_sql_text(a)}, {_sql_text(normalised(b))})" for a, b in TEMPLATES)}) AS v(license, text)
), tg AS (
  SELECT template, license, len(words) - 1 AS b, gram, count(*) AS n
  FROM (SELECT template, license, words,
               unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS gram FROM t)
  GROUP BY ALL
), plain AS (
  SELECT doc_id, replace(regexp_replace(replace(regexp_replace(regexp_replace(lower(text),
    '\\n[^a-z0-9\\n]*\\n[^a-z0-9]*', chr(2), 'g'), '[.!?][ \\t\\r\\n]+', chr(1), 'g'), chr(10), chr(3)),
    '[^a-z0-9\\x01\\x02\\x03]+', ' ', 'g'), 'licence', 'license') AS p
  FROM documents WHERE text IS NOT NULL
), u AS (
  SELECT DISTINCT doc_id, trim(unit) AS unit FROM (
    SELECT doc_id, regexp_replace(p, '[ \\x01\\x02\\x03]+', ' ', 'g') AS unit FROM plain
    UNION ALL SELECT doc_id, unnest(string_split(regexp_replace(p, '[ \\x01\\x03]+', ' ', 'g'), chr(2))) FROM plain
    UNION ALL SELECT doc_id, unnest(string_split_regex(regexp_replace(p, '[ \\x03]+', ' ', 'g'), '[\\x01\\x02]')) FROM plain
    UNION ALL SELECT doc_id, unnest(string_split_regex(p, '[\\x01\\x02\\x03]')) FROM plain)
), ug AS (
  SELECT doc_id, unit, a, gram, count(*) AS n FROM (
    SELECT doc_id, unit, len(w) - 1 AS a,
           unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram
    FROM (SELECT doc_id, unit, string_split(unit, ' ') AS w FROM u)
    WHERE len(w) BETWEEN 2 AND {_most_words(TEMPLATES)})
  GROUP BY ALL
), dice AS (
  SELECT doc_id, unit, template, license, 2.0::DOUBLE * sum(least(ug.n, tg.n))::BIGINT / (a + b) AS d
  FROM ug JOIN tg USING (gram) GROUP BY doc_id, unit, template, license, a, b
)
SELECT doc_id, license, count(DISTINCT unit) AS matches, max(d) AS best
FROM dice WHERE d >= 0.8 GROUP BY doc_id, license
"""
