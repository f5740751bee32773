"""License scan: texts and their parts are brought to a canonical form, hashed, and joined to known digests.

The canonical form is in lower case, without copyright lines, with one spelling of words that have several, and with
everything between words reduced to one space. Whole texts, paragraphs and lines are looked up, so a notice
is found in a longer document too. Known licenses are a short fixed list, so their digests are broadcast.
Texts without any of the words that all known licenses have one of are passed over; they can't be equal to one.

Defined cases: a null text has no license; rows without doc_id are reported under a null id; rows that repeat
a doc_id are counted together; very long texts are looked up whole and by all their paragraphs and lines; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licenses and notices, by identifier.
_GRANT = (
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
    'or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
    "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
    'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
    "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
    "either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
KNOWN = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), " + _GRANT),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), " + _GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "ISC License " + _ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
# A word that each known license has, and spellings with the one they are brought to.
TELLING = "licen|permission"
COPYRIGHT = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
SPELLINGS = (
    ("licence", "license"), ("organisation", "organization"), ("authorise", "authorize"), ("favour", "favor"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
)
BLANK_LINE = r"\n[ \t]*\n"


def canonical(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, " "), "[^a-z0-9]+", " "))
    for other, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(usual))
    return plain


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def licenses(docs: DataFrame, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``doc_id, license, is_whole, n_paragraphs, n_lines``: a row for each document and each license found in it."""
    listed = docs.sparkSession.createDataFrame(list(known), "license string, known_text string")
    listed = listed.select("license", digest(F.col("known_text")).alias("digest")).distinct()
    told = docs.select("doc_id", "text").where(F.lower("text").rlike(TELLING))
    units = F.concat(
        F.array(F.struct(F.lit("text").alias("scope"), F.col("text").alias("unit"))),
        F.transform(F.split("text", BLANK_LINE), lambda u: F.struct(F.lit("paragraph").alias("scope"), u.alias("unit"))),
        F.transform(F.split("text", "\n"), lambda u: F.struct(F.lit("line").alias("scope"), u.alias("unit"))),
    )
    each = told.select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.scope", digest(F.col("u.unit")).alias("digest"))
    found = each.join(F.broadcast(listed), "digest")
    return found.groupBy("doc_id", "license").agg(
        (F.max(F.when(F.col("scope") == "text", 1).otherwise(0)) == 1).alias("is_whole"),
        F.count(F.when(F.col("scope") == "paragraph", 1)).alias("n_paragraphs"),
        F.count(F.when(F.col("scope") == "line", 1)).alias("n_lines"),
    )


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _sql() -> str:
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def digest_sql(column: str) -> str:
        plain = f"trim(regexp_replace(regexp_replace(lower({column}), {text(COPYRIGHT)}, ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
        for other, usual in SPELLINGS:
            plain = f"replace({plain}, {text(other)}, {text(usual)})"
        return f"sha256({plain})"

    values = ", ".join(f"({text(name)}, {text(body)})" for name, body in KNOWN)
    return f"""
WITH known AS (SELECT DISTINCT license, {digest_sql("body")} AS digest FROM (VALUES {values}) AS k(license, body)),
units AS (
  SELECT doc_id, 'text' AS scope, text AS unit FROM documents
  UNION ALL SELECT doc_id, 'paragraph', unnest(regexp_split_to_array(text, {text(BLANK_LINE)})) FROM documents
  UNION ALL SELECT doc_id, 'line', unnest(string_split(text, chr(10))) FROM documents
)
SELECT doc_id, license, bool_or(scope = 'text') AS is_whole, count(*) FILTER (WHERE scope = 'paragraph') AS n_paragraphs,
       count(*) FILTER (WHERE scope = 'line') AS n_lines
FROM units JOIN known ON {digest_sql("unit")} = known.digest GROUP BY doc_id, license
"""


OP3_SQL = _sql()
