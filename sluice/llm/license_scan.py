"""License notices in documents: MinHash bands retrieve templates, containment verifies them.

Only DataFrame functions are used. Words are runs of letters and digits in lower case; a
shingle is five of them in a row. Windows overlap: one starts at every shingle and holds
``WINDOW`` shingles. A window's bands are the least values of its shingle hashes, exclusive-or
a mask per band. A document that quotes ``WINDOW`` + 4 words of a template in a row has a
window equal to one of the template's, which collides in every band for certain; a window of
Jaccard similarity 0.5 collides in one of the four bands with probability 0.94, of 0.75 with
0.996. Templates of fewer shingles have windows of one shingle, which collide for certain. A
retrieved template is verified by the share of its distinct shingles, as words, that the
document contains: at least ``containment``.

The templates (a few license notices, compared as literals of the plan) are the bounded side;
documents are neither shuffled nor joined. Null and empty texts have no windows and no
licenses; templates of fewer than five words are refused; an empty table gives no rows; rows
that are repeated are judged each; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH, WINDOW = 5, 4
MASKS = (0x0, 0x5A3C96E1F00DB7C5, 0x33CC55AA0F1E2D4B, 0x6996C33CA55A1EE1)
#: Templates are literals of the plan; this many characters of them at most.
MAX_TEMPLATE_CHARS = 1_000_000

# The customary notices of some licenses, and the whole text of short ones.
NOTICES = {
    "agpl-header": (  # without what it shares with the header of gpl
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"
    ),
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "apache-2.0-header-end": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "bsd-3-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication",
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0"
    ),
    "gpl-2.0-or-later": "either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-or-later": "either version 3 of the License, or (at your option) any later version.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "isc-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "lgpl-header": (  # without what it shares with the header of gpl
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"
    ),
    "mit": "Released under the MIT License.",
    "mit-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mit-licensed": "licensed under the MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "zlib-full": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution."
    ),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once a row however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def shingle_hashes(words: Column) -> Column:
    """64-bit hash of every five words in a row."""
    each = F.transform(
        F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)])
    )
    return F.when(F.size(words) >= WIDTH, each).otherwise(F.array().cast("array<bigint>"))


def band_values(hashes: Column) -> Column:
    """Every band of every window, one after the other."""

    def band(mask: int) -> Column:
        masked = F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask)))
        return _let(
            masked,
            lambda m: F.transform(
                F.sequence(F.lit(0), F.size(m) - WINDOW), lambda i: F.least(*[F.get(m, i + k) for k in range(WINDOW)])
            ),
        )

    return F.when(F.size(hashes) >= WINDOW, F.concat(*[band(m) for m in MASKS])).otherwise(
        F.array().cast("array<bigint>")
    )


def prepare(spark: SparkSession, templates: dict[str, str]) -> list[tuple[str, list[str], list[int]]]:
    """Name, distinct shingles (as words) and retrieval values of each template, by the same
    expressions as for documents."""
    if sum(map(len, templates.values())) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_CHARS} characters; scan with some at a time")
    table = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    words = F.split(normalised(F.col("text")), " ")
    hashes = shingle_hashes(words)
    phrases = F.transform(
        F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: F.array_join(F.slice(words, i + 1, WIDTH), " ")
    )
    phrases = F.when(F.size(words) >= WIDTH, F.array_distinct(phrases))
    values = F.when(F.size(hashes) >= WINDOW, band_values(hashes)).otherwise(hashes)
    found = table.select("name", phrases.alias("phrases"), values.alias("values")).collect()
    short = [r["name"] for r in found if not r["phrases"]]
    if short:
        raise ValueError(f"templates of fewer than {WIDTH} words: {', '.join(short)}")
    return [(r["name"], r["phrases"], sorted(set(r["values"]))) for r in found]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = 0.8) -> DataFrame:
    """``docs`` with n_windows and ``licenses``: struct of name and containment, by name."""
    prepared = prepare(docs.sparkSession, NOTICES if templates is None else templates)
    kind = "array<struct<name:string,containment:double>>"
    if not prepared:
        n = F.greatest(F.size(F.split(normalised(F.col("text")), " ")) - WIDTH + 1, F.lit(0)).cast("long")
        return docs.withColumns({"n_windows": n, "licenses": F.array().cast(kind)})
    known = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.array(*map(F.lit, phrases)).alias("phrases"),
                F.array(*[F.lit(v).cast("long") for v in values]).alias("values"),
            )
            for name, phrases, values in prepared
        ]
    )
    wanted = F.array(*[F.lit(v).cast("long") for v in sorted({v for *_, values in prepared for v in values})])

    def judged(text: Column) -> Column:
        def verified(hits: Column) -> Column:
            padded = F.concat(F.lit(" "), text, F.lit(" "))
            retrieved = F.filter(known, lambda t: F.arrays_overlap(t["values"], hits))
            shares = F.transform(
                retrieved,
                lambda t: F.struct(
                    t["name"].alias("name"),
                    (
                        F.size(F.filter(t["phrases"], lambda p: F.contains(padded, F.concat(F.lit(" "), p, F.lit(" ")))))
                        / F.size(t["phrases"])
                    ).alias("containment"),
                ),
            )
            return F.filter(shares, lambda s: s["containment"] >= containment)

        def searched(hashes: Column) -> Column:
            hits = F.array_intersect(F.concat(hashes, band_values(hashes)), wanted)
            found = _let(hits, lambda h: F.when(F.size(h) > 0, verified(h)).otherwise(F.array().cast(kind)))
            return F.struct(F.size(hashes).cast("long").alias("n"), found.alias("found"))

        return _let(F.split(text, " "), lambda words: _let(shingle_hashes(words), searched))

    result = docs.withColumn("_scan", _let(normalised(F.col("text")), judged))
    return result.withColumns({"n_windows": F.col("_scan.n"), "licenses": F.col("_scan.found")}).drop("_scan")


def oracle(containment: float = 0.8) -> str:
    """DuckDB SQL of the registered query: every template's share of contained shingles."""
    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(NOTICES.items()))
    return rf"""
WITH t AS (
  SELECT name, string_split(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w
  FROM (VALUES {values}) v(name, text)
), p AS (
  SELECT DISTINCT name, array_to_string(w[i:i + 4], ' ') AS phrase
  FROM t, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
), d AS (
  SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS words FROM documents
), s AS (
  SELECT doc_id, name, avg(CASE WHEN contains(' ' || words || ' ', ' ' || phrase || ' ') THEN 1.0 ELSE 0.0 END) AS share
  FROM d, p GROUP BY doc_id, name
), f AS (
  SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses, count(*) AS n_licenses, max(share) AS containment
  FROM s WHERE share >= {containment} GROUP BY doc_id
)
SELECT d.doc_id, CAST(greatest(len(string_split(words, ' ')) - 4, 0) AS BIGINT) AS n_windows,
  coalesce(licenses, '') AS licenses, CAST(coalesce(n_licenses, 0) AS INTEGER) AS n_licenses, f.containment
FROM d LEFT JOIN f USING (doc_id)
"""
