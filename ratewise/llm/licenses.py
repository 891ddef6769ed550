"""Licence scans by canonical digest lookup (operator 9, built-in functions only).

A text is normalised (case, punctuation, white space, copyright and title lines, equivalent spellings) and its SHA-256 is
looked up, by a hash join, among the digests of known licence texts normalised in the same way. Units are the whole
document, each of its paragraphs (parts between blank lines) and each of its lines, always entire. With ``runs``, as in
the registered query, each run of as many consecutive paragraphs as a known text has is a unit too, so a known text is
found inside a longer document; a run's digest is that of its paragraphs' digests, so no text is normalised for it again.

Defined cases: null text has one empty unit that matches nothing; repeated rows and ids each give one row; a text that
matches several licences names them all, sorted, so there are no ties; paragraphs that normalise to nothing are no part of
a run; a text of any length is cut into units whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.scratch import broadcast_if_small
from ratewise.llm.text import ascii_lower, let

# Licence texts and notices as their authors publish them.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
GPL3_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version."""
BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
BSD_ENDORSEMENT = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

"""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
MPL2_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
GPL2_NOTICE = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
option) any later version."""
LGPL21_NOTICE = """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
your option) any later version."""
AGPL3_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version."""
KNOWN = (
    ("0BSD", ZERO_BSD),
    ("AGPL-3.0-or-later", AGPL3_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", APACHE_NOTICE),
    ("BSD-2-Clause", BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CONDITIONS + BSD_ENDORSEMENT + BSD_DISCLAIMER),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-or-later", GPL2_NOTICE),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", GPL3_NOTICE),
    ("ISC", ISC),
    ("LGPL-2.1-or-later", LGPL21_NOTICE),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", MIT),
    ("MPL-2.0", MPL2_NOTICE),
    ("Zlib", ZLIB),
)

# Spellings that count as equal.
EQUIVALENT = (("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sublicence", "sublicense"), ("noncommercial", "non commercial"),
              ("per cent", "percent"), ("copyright owner", "copyright holder"))
#: Lines left out: those that name a year or an owner after a copyright mark (running text that happens to begin with the
#: word stays), and those that are only a licence's title.
LEFT_OUT_LINE = (r"(?m)^[^\p{L}\n]*((copyright *[(©\[<0-9]|©|\(c\) *[0-9]|all rights reserved)[^\n]*|"
                 r"(the )?(mit|isc|expat|zlib|[0-3]-clause bsd|bsd [0-3]-clause) licen[sc]e( \([^()\n]*\))?[^\p{L}\n]*)$")
PARAGRAPH_END = r"\n[\x20\x09\x0D]*\n"
#: Paragraphs of the known texts that have more than one.
RUN_LENGTHS = tuple(sorted({n for _, t in KNOWN if (n := len(re.split(PARAGRAPH_END, t))) > 1}))


def normalised(text: Column) -> Column:
    """Lower case, no copyright or title lines, punctuation as blanks, one blank between words, equivalent spellings united."""
    t = F.regexp_replace(ascii_lower(text), LEFT_OUT_LINE, " ")
    t = F.concat(F.lit(" "), F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for old, new in EQUIVALENT:
        t = F.replace(t, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.btrim(t)


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def paragraph_digests(text: Column) -> Column:
    return F.transform(F.split(text, PARAGRAPH_END), digest)


def run_digests(paragraphs: Column, lengths) -> Column:
    """Digests of the runs of ``lengths`` consecutive paragraphs, from the paragraphs' digests, those of nothing left out."""
    def cut(ds: Column, n: int) -> Column:
        starts = F.when(F.size(ds) >= n, F.sequence(F.lit(1), F.size(ds) - (n - 1)))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.sha2(F.array_join(F.slice(ds, i, n), ","), 256))

    return let(F.filter(paragraphs, lambda d: d != F.sha2(F.lit(""), 256)), lambda ds: F.concat(*[cut(ds, n) for n in lengths]))


def digests_of(texts: DataFrame) -> DataFrame:
    """license, digest, n_paragraphs: of each known text (license, text) and of the run that its paragraphs make, if several."""
    ds = F.filter(paragraph_digests(F.col("text")), lambda d: d != F.sha2(F.lit(""), 256))
    of = texts.select("license", digest(F.col("text")).alias("digest"), ds.alias("ds"))
    run = of.where("size(ds) > 1").select("license", F.sha2(F.array_join("ds", ","), 256).alias("digest"), F.size("ds").alias("n_paragraphs"))
    return of.where("size(ds) > 0").select("license", "digest", F.lit(1).alias("n_paragraphs")).union(run).distinct()


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """:func:`digests_of` the given (license, text) pairs."""
    return digests_of(spark.createDataFrame([(k, t) for k, t in known], "license string, text string"))


def known_from(spark: SparkSession, path: str) -> DataFrame:
    """:func:`digests_of` the text files at ``path``, each named by its licence: ``GPL-3.0-only.txt``."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    return digests_of(files.select(F.regexp_replace("name", r"\.txt$", "").alias("license"), F.col("value").alias("text")))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  runs: bool = False) -> DataFrame:
    """doc_id, n_units, n_matched, licenses (sorted, comma-joined) and text_license (of the whole text, else null).

    ``known`` is of :func:`digests_of`. Units of a document that are alike after normalising count once. With ``runs``,
    runs of as many consecutive paragraphs as known texts have are units too.
    """
    lengths = RUN_LENGTHS
    if known is None:
        known = known_digests(docs.sparkSession)
    elif runs:
        lengths = sorted(r[0] for r in known.where("n_paragraphs > 1").select("n_paragraphs").distinct().collect())
    known = broadcast_if_small(known.groupBy("digest").agg(F.sort_array(F.collect_set("license")).alias("found")), "digest")
    text = F.coalesce(F.col(text_col), F.lit(""))
    paragraphs = F.split(text, PARAGRAPH_END)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("_row"), digest(text).alias("_whole"),
                       F.transform(paragraphs, digest).alias("_paragraphs"),
                       F.transform(F.array_except(F.split(text, "\n"), paragraphs), digest).alias("_lines"))
    # The row number is made once, below the join, and used once, above it, in one pass over the input; a row's units
    # meet again in the task that made them, before the shuffle.
    parts = [F.array("_whole"), F.col("_paragraphs"), F.col("_lines")]
    if runs and lengths:
        parts.append(run_digests(F.col("_paragraphs"), lengths))
    units = rows.select("doc_id", "_row", "_whole", F.explode(F.array_distinct(F.concat(*parts))).alias("digest"))
    return (units.join(known, "digest", "left").groupBy("_row", "doc_id")
            .agg(F.count("*").alias("n_units"), F.sum(F.coalesce(F.array_size("found"), F.lit(0))).cast("bigint").alias("n_matched"),
                 F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), ",").alias("licenses"),
                 F.min(F.when(F.col("digest") == F.col("_whole"), F.get("found", F.lit(0)))).alias("text_license"))
            .drop("_row"))


def oracle() -> str:
    """DuckDB SQL of :func:`scan_licenses` with ``runs`` over ``documents`` with the texts of KNOWN."""
    def norm(t: str) -> str:
        t = f"regexp_replace(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{LEFT_OUT_LINE}', ' ', 'g')"
        t = f"' ' || regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
        for old, new in EQUIVALENT:
            t = f"replace({t}, ' {old} ', ' {new} ')"
        return f"sha256(trim({t}, ' '))"

    quoted = [(name, text.replace("'", "''")) for name, text in KNOWN]
    values = ", ".join(f"('{name}', '{text}')" for name, text in quoted)
    end = r"'\n[\x20\x09\x0D]*\n'"
    lengths = ", ".join(f"({n})" for n in RUN_LENGTHS)
    ordered = f"list_filter(list_transform(regexp_split_to_array(t, {end}), lambda x: {norm('x')}), lambda x: x <> sha256(''))"
    return f"""
WITH texts AS (SELECT license, t FROM (VALUES {values}) v(license, t)),
known AS (SELECT license, {norm('t')} AS digest FROM texts
          UNION SELECT license, sha256(array_to_string(ds, ',')) FROM (SELECT license, {ordered} AS ds FROM texts) WHERE len(ds) > 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT rid, t AS part FROM d UNION SELECT rid, unnest(string_split(t, chr(10))) FROM d
      UNION SELECT rid, unnest(regexp_split_to_array(t, {end})) FROM d),
r AS (SELECT rid, ds, n, unnest(range(1, len(ds) - n + 2)) AS i FROM (SELECT rid, {ordered} AS ds FROM d), (VALUES {lengths}) l(n)),
u AS (SELECT rid, {norm('part')} AS digest FROM p UNION SELECT rid, sha256(array_to_string(ds[i:i + n - 1], ',')) FROM r),
m AS (SELECT u.rid, count(DISTINCT u.digest) AS n_units, count(license) AS n_matched,
        coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses
      FROM u LEFT JOIN known USING (digest) GROUP BY u.rid),
w AS (SELECT d.rid, min(license) AS text_license FROM d JOIN known ON {norm('d.t')} = known.digest GROUP BY d.rid)
SELECT d.doc_id, n_units, n_matched, licenses, text_license FROM d JOIN m USING (rid) LEFT JOIN w USING (rid)"""
