"""Licence texts by canonical digest.

A text is brought to a canonical form (case, copyright lines, punctuation, equivalent
spellings); the digest of the whole form is looked up among the digests of known licences by a
hash join. All of it is DataFrame functions.
"""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.tables import broadcast_within, texts_by_id
from newsloom.session import Staging

# Words that licence matching treats as the same.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("noncommercial", "non commercial"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("percent", "per cent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)

# Public licence texts and one-line notices.
KNOWN = (
    ("MIT-notice", "Released under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
)

# More public licence texts.
KNOWN += (
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    ),
    (
        "BSL-1.0",
        """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
)

# Title lines that files put above these texts, and licences whose text has its title as first paragraph.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "Zlib": ("zlib License", "The zlib License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"),
}
OWN_TITLE = ("BSL", "Apache", "GPL", "LGPL", "MPL", "GFDL", "CC0")

NO_WORDS = hashlib.sha256(b"").hexdigest()
# A copyright statement: the word with a sign, a year or a placeholder, or a sign with a year. Other
# lines that begin with the word are part of a sentence that was wrapped there.
_SIGN, _WHEN = r"(\(c\)|©|&copy;)", r"([<\[{(]?(year|yyyy|[0-9]{4}))"
_COPYRIGHT = (
    rf"(?m)^[\s/*#;-]*(copyright\s*(:?\s*{_SIGN}|:?\s*{_WHEN}|\s+by\s)|{_SIGN}\s*(copyright\s*)?{_WHEN}|all rights reserved\.?\s*$)[^\n]*$"
)
_GAP = r"[^\p{L}\p{N}]+"
_ANY_EQUIVALENT = " (?:" + "|".join(other for other, _ in EQUIVALENT) + ") "


def canonical(text: Column) -> Column:
    """Lower case without copyright lines, words separated by two blanks, one spelling each."""
    form = F.regexp_replace(F.regexp_replace(F.lower(text), _COPYRIGHT, " "), _GAP, "  ")
    form = F.concat(F.lit("  "), F.trim(form), F.lit("  "))

    def spelled(text: Column) -> Column:
        one = text
        for other, word in EQUIVALENT:
            one = F.replace(one, F.lit(f" {other} "), F.lit(f" {word.replace(' ', '  ')} "))
        return F.trim(F.when(text.rlike(_ANY_EQUIVALENT), one).otherwise(text))  # most lines have none

    # the one-element array gives the form a name, so that it is made once
    return F.element_at(F.transform(F.array(form), spelled), 1)


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form, never null: texts without words have that of ``""``.

    A null would make the join test the whole expression once more for every row.
    """
    return F.coalesce(F.sha2(canonical(F.coalesce(text, F.lit(""))), 256), F.lit(NO_WORDS))


def catalogue() -> list[tuple[str, str]]:
    """:data:`KNOWN` and the texts of ``licence_texts.json``, with and without their titles."""
    more = json.loads((Path(__file__).parent / "licence_texts.json").read_text("utf-8"))
    rows = [*KNOWN, *((r["license_id"], r["text"]) for r in more)]
    titled = [(name, f"{title}\n\n{text}") for name, text in rows for title in TITLES.get(name, ())]
    own_title = [(name, text.strip().split("\n\n", 1)[1]) for name, text in rows if name.startswith(OWN_TITLE) and "\n\n" in text.strip()]
    return rows + titled + own_title


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(catalogue(), "license_id string, text string")


def licensed(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, digest, license_id, n_license_lines, license_lines`` for every row of ``docs``.

    ``license_id`` is the known licence whose whole canonical text equals the document's, the
    first by name if several do, else null. A licence notice inside a document is a line of its
    own: each line is a text that is looked up in the same way; ``license_lines`` has the
    distinct ids found, sorted and comma-joined, and is empty without any.

    Null and empty texts have a null digest and match nothing. Rows that repeat an id share the
    lines of all of them; a row without an id has no lines. Empty tables are allowed, other
    columns are not read.
    """
    texts = texts_by_id(docs, id_column, text_column)
    keep = Staging(texts.sparkSession)
    sought = known.select(digest(F.col("text")).alias("digest"), "license_id").where(F.col("digest") != NO_WORDS)
    sought = keep(sought.groupBy("digest").agg(F.min("license_id").alias("license_id")), "known")
    rows = sought.count()

    lines = texts.where("doc_id IS NOT NULL").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    found = lines.select("doc_id", digest(F.col("line")).alias("digest")).join(broadcast_within(sought, rows), "digest")
    per_id = found.groupBy("doc_id", "license_id").agg(F.count("*").alias("lines"))
    per_doc = per_id.groupBy("doc_id").agg(
        F.sum("lines").alias("n_license_lines"), F.array_join(F.sort_array(F.collect_list("license_id")), ",").alias("license_lines")
    )
    whole = texts.select("doc_id", digest(F.col("text")).alias("digest")).join(broadcast_within(sought, rows), "digest", "left")
    return whole.join(per_doc, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("digest") != NO_WORDS, F.col("digest")).alias("digest"),
        "license_id",
        F.coalesce("n_license_lines", F.lit(0).cast("long")).alias("n_license_lines"),
        F.coalesce("license_lines", F.lit("")).alias("license_lines"),
    )


def plain_digest(text: str) -> str:
    """:func:`digest` of one text without Spark, for the values of the SQL form."""
    form = re.sub(r"[\W_]+", "  ", re.sub(_COPYRIGHT, " ", text.lower()))
    form = f"  {form.strip()}  "
    for other, word in EQUIVALENT:
        form = form.replace(f" {other} ", f" {word.replace(' ', '  ')} ")
    return hashlib.sha256(form.strip().encode()).hexdigest()


def _sql_canonical(text: str) -> str:
    form = f"regexp_replace(regexp_replace(lower({text}), '{_COPYRIGHT}', ' ', 'g'), '{_GAP}', '  ', 'g')"
    form = f"'  ' || trim({form}) || '  '"
    for other, word in EQUIVALENT:
        form = f"replace({form}, ' {other} ', ' {word.replace(' ', '  ')} ')"
    return f"trim({form})"


def _sql_digest(text: str) -> str:
    return f"sha256(nullif({_sql_canonical(text)}, ''))"


def oracle() -> str:
    """The same over ``documents`` as SQL, with the digests of the whole catalogue."""
    known = sorted({(plain_digest(text), name) for name, text in catalogue()} - {(NO_WORDS, name) for name, _ in catalogue()})
    values = ", ".join(f"('{value}', '{name}')" for value, name in known)
    return f"""
WITH known AS (SELECT digest, min(license_id) AS license_id FROM (VALUES {values}) AS t(digest, license_id) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
found AS (
  SELECT doc_id, license_id, count(*) AS n
  FROM (SELECT doc_id, {_sql_digest("line")} AS digest FROM lines) JOIN known USING (digest) GROUP BY 1, 2),
per_doc AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_license_lines, string_agg(license_id, ',' ORDER BY license_id) AS license_lines
  FROM found GROUP BY 1),
whole AS (SELECT doc_id, {_sql_digest("text")} AS digest FROM documents)
SELECT doc_id, digest, license_id, coalesce(n_license_lines, 0) AS n_license_lines, coalesce(license_lines, '') AS license_lines
FROM whole LEFT JOIN known USING (digest) LEFT JOIN per_doc USING (doc_id)
"""
