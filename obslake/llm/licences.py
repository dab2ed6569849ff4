"""Licence scan by canonical digest lookup (built-in functions only).

A text is brought to a canonical form (case, copyright lines, punctuation, white space and
equivalent spellings), digested, and the digests of entire texts are hash-joined to the
digests of known licences, made by the same expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.common import ascii_lower

# Spellings that licence matching guidelines treat as equal (after
# lower-casing and the removal of punctuation), as (from, to).
EQUIVALENT_SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("judgement", "judgment"),
    ("merchantibility", "merchantability"),
    ("https", "http"),
)

# Texts of known short licences and licence notices (public texts).
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
# Title lines that stand before the text of a licence.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "BSD-2-Clause": (
        "BSD 2-Clause License",
        "The BSD 2-Clause License",
        "BSD-2-Clause",
        "The 2-Clause BSD License",
        "Simplified BSD License",
        "BSD License",
    ),
    "BSD-3-Clause": (
        "BSD 3-Clause License",
        "The BSD 3-Clause License",
        "BSD-3-Clause",
        "The 3-Clause BSD License",
        "New BSD License",
        "BSD License",
    ),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "Zlib"),
}
BODIES = (
    ("MIT", MIT),
    ("ISC", ISC),
    ("BSD-2-Clause", BSD_CLAUSES + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CLAUSES + BSD_THIRD + BSD_DISCLAIMER),
    ("Zlib", ZLIB),
)
KNOWN_LICENCES = (
    *BODIES,
    *((licence, f"{title}\n\n{body}") for licence, body in BODIES for title in TITLES[licence]),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
)

# A copyright line: optional comment marks, then "copyright" with a sign or year, "(c)" or the sign, to
# the line's end; "copyright the ... authors" (contributors, developers, project) without either; also
# "all rights reserved" lines. A wrapped line of a licence that begins with "copyright notice" or
# "copyright holders" is none. Applied after A-Z lower-casing.
COPYRIGHT_LINE = (
    "^[ \\t/*#;-]*(?:copyright[ \\t:]*(?:\\(c\\)|©|[0-9]|the [^\\n]*(?:authors|contributors|developers|project))"
    "|\\(c\\)|©|all rights reserved)[^\\n]*$"
)
NOT_CANONICAL = "[^a-z0-9\\x{80}-\\x{10FFFF}]+"


def _spaced(phrase: str) -> str:
    return f" {phrase.replace(' ', '  ')} "


def canonical_text(text: Column) -> Column:
    """Canonical form: lower case, no copyright lines, words of letters and digits with one
    space between, equivalent spellings unified. Characters outside ASCII are kept."""
    # Only \\n ends a line (Java's flag d); words are held apart by two spaces, so that
    # neighbouring spellings never share one.
    bare = F.regexp_replace(ascii_lower(text), f"(?md){COPYRIGHT_LINE}", "")
    padded = F.concat(F.lit(" "), F.regexp_replace(bare, NOT_CANONICAL, "  "), F.lit(" "))
    for old, new in EQUIVALENT_SPELLINGS:
        padded = F.replace(padded, F.lit(_spaced(old)), F.lit(_spaced(new)))
    return F.trim(F.replace(padded, F.lit("  "), F.lit(" ")))


def canonical_digest(text: Column) -> Column:
    """SHA-256 (hex) of the canonical form; null for a null text."""
    return F.sha2(canonical_text(text), 256)


def known_digests(spark: SparkSession, licences=KNOWN_LICENCES) -> DataFrame:
    """(licence_id, digest) of known texts, one row per digest (smallest id on a tie)."""
    return digests_of(spark.createDataFrame(list(licences), "licence_id string, text string"))


def digests_of(texts: DataFrame) -> DataFrame:
    """(licence_id, digest) of a table (licence_id, text) of known texts of any size, one row per
    digest (smallest id on a tie). Rows with a null, and texts of which the canonical form leaves
    nothing, are no licence."""
    return (
        texts.where("licence_id IS NOT NULL")
        .select("licence_id", canonical_text(F.col("text")).alias("form"))
        .where("form <> ''")
        .groupBy(F.sha2("form", 256).alias("digest"))
        .agg(F.min("licence_id").alias("licence_id"))
    )


def licence_folder(spark: SparkSession, path: str) -> DataFrame:
    """(licence_id, text) of a shared folder of whole licence texts, a file each; the id is the file's
    name without ``.txt``."""
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), "\\.txt$", "")
    return spark.read.text(path, wholetext=True).select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("licence_id"), F.col("value").alias("text"))


def scan_licences(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``canonical_digest`` and ``licence_id`` (null: the whole text is no known licence).

    One left hash join on the digest; ``known`` holds one row per digest, so no row is
    multiplied and a hot document digest needs no shuffle of its own when ``known`` is
    small enough for Spark to broadcast by its measured size. Null text: both null.
    Empty text: the digest of the empty form, never a licence. Columns of ``docs`` named
    like the two results are replaced; repeated rows stay repeated.
    """
    kept = docs.drop("canonical_digest", "licence_id").withColumn("canonical_digest", canonical_digest(F.col(text)))
    ids = known.select(F.col("digest").alias("canonical_digest"), "licence_id")
    return kept.join(ids, "canonical_digest", "left")


def canonical_sql(text: str) -> str:
    """The canonical form of ``text`` as DuckDB SQL."""
    form = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    form = f"regexp_replace({form}, '(?m){COPYRIGHT_LINE}', '', 'g')"
    form = f"' ' || regexp_replace({form}, '{NOT_CANONICAL}', '  ', 'g') || ' '"
    for old, new in EQUIVALENT_SPELLINGS:
        form = f"replace({form}, '{_spaced(old)}', '{_spaced(new)}')"
    return f"trim(replace({form}, '  ', ' '), ' ')"


def scan_sql(docs: str = "documents", licences=KNOWN_LICENCES) -> str:
    """DuckDB SQL of ``scan_licences`` over ``docs``: doc_id, canonical_digest, licence_id."""
    quoted = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licences)
    return f"""
WITH known AS (
    SELECT sha256({canonical_sql('t')}) AS canonical_digest, min(licence_id) AS licence_id
    FROM (VALUES {quoted}) AS v(licence_id, t) GROUP BY 1),
digests AS (SELECT doc_id, sha256({canonical_sql('text')}) AS canonical_digest FROM {docs})
SELECT d.doc_id, d.canonical_digest, k.licence_id
FROM digests d LEFT JOIN known k ON d.canonical_digest = k.canonical_digest
"""
