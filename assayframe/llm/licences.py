"""Licence scans by digests of normalised whole texts.

A text is normalised: case, punctuation, copyright lines and equivalent spellings no
longer count. Its digest is then looked up among the digests of known licences, by a hash
join. The units looked up are whole documents and each of their lines, so notices that
stand on a line of their own are found too. Nothing is matched in part.
"""

from __future__ import annotations

import json
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, left to right.
SPELLINGS = (
    ("licenc", "licens"), ("organis", "organiz"), ("favour", "favor"), ("honour", "honor"), ("recognis", "recogniz"),
    ("utilis", "utiliz"), ("authoris", "authoriz"), ("initialis", "initializ"), ("fulfilment", "fulfillment"),
    ("sub-licens", "sublicens"), ("non-commercial", "noncommercial"), ("whilst", "while"), ("https://", "http://"),
)
MARK = r"©|\(c\)"
COPYRIGHT_LINE = r"^[^\p{L}\p{N}]*copyright[ :]+(copyright[ :]+)*([0-9]{4}|<|\[|by ).*$"
PUNCTUATION = r"[^\p{L}\p{N}]+"

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Known licences and notices by their public identifiers.
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
     "to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software.\n" + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_END),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission.\n" + _BSD_END),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
]


def _shipped_texts() -> list[tuple[str, str]]:
    """Whole licence texts and their common forms, from the table beside this module: license_id, form, text."""
    lines = resources.files(__package__).joinpath("licence_texts.jsonl").read_text(encoding="utf-8").split("\n")
    return [(row["license_id"], row["text"]) for row in map(json.loads, filter(None, lines))]


KNOWN += _shipped_texts()
#: Known licences up to so many are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 10_000


def normal_line(line: Column) -> Column:
    """One line without what does not count; "" for a copyright line."""
    x = F.regexp_replace(F.lower(line), MARK, " copyright ")
    x = F.regexp_replace(x, COPYRIGHT_LINE, "")
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(x, PUNCTUATION, " "))


def digest(normal: Column) -> Column:
    """sha256 of a normalised text; null if nothing is left of it."""
    return F.when(normal != "", F.sha2(normal, 256))


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, r"\r\n|\n|\r"), normal_line)


def _whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_licences(spark: SparkSession) -> DataFrame:
    """license_id and text of the notices above and of the whole texts shipped with the package."""
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def licence_digests(licences: DataFrame) -> DataFrame:
    """One row per digest: the smallest id among licences that are the same once normalised."""
    made = licences.select("license_id", digest(_whole(_lines(F.col("text")))).alias("digest"))
    return made.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, licences: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns of ``docs`` if None), ``license_id``, ``notices`` and ``n_notices``.

    license_id: the licence that the whole document is, or null. notices: the licences that
    lines of it are, each once, in order; n_notices: how many lines those are.

    Null and empty texts, and texts of copyright lines only, are no licence. Rows with the
    same id and text have the same result. Columns of ``docs`` with those three names give
    way. Units meet the known digests before anything is shuffled; only those that match
    are gathered, and documents meet them by id.
    """
    made = ("license_id", "notices", "n_notices")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    known = licence_digests(licences)
    if licences.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    keyed = docs.select(F.col(doc_id).cast("string").alias("_id"), F.xxhash64(text).alias("_hash"), _lines(F.col(text)).alias("_lines"))
    units = keyed.select("_id", "_hash", F.posexplode(F.concat(F.array(_whole(F.col("_lines"))), F.col("_lines"))).alias("_place", "_normal"))
    found = units.withColumn("digest", digest(F.col("_normal"))).join(known, "digest")
    # a line's place makes it one, however many equal rows there are
    by_line = found.groupBy("_id", "_hash", "_place").agg(F.min("license_id").alias("license_id"))
    by_text = by_line.groupBy("_id", "_hash").agg(
        F.max(F.when(F.col("_place") == 0, F.col("license_id"))).alias("license_id"),
        F.sort_array(F.collect_set(F.when(F.col("_place") > 0, F.col("license_id")))).alias("notices"),
        F.count_if(F.col("_place") > 0).alias("n_notices"),
    ).toDF("_of", "_of_hash", *made)
    rows = docs.select(*kept, F.col(doc_id).cast("string").alias("_id"), F.xxhash64(text).alias("_hash"))
    joined = rows.join(by_text, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_hash") == F.col("_of_hash")), "left")
    return joined.select(*kept, "license_id", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"))


def normal_sql(line: str) -> str:
    """``normal_line`` in DuckDB."""
    x = f"regexp_replace(regexp_replace(lower({line}), '{MARK}', ' copyright ', 'g'), '{COPYRIGHT_LINE}', '', 'g')"
    for a, b in SPELLINGS:
        x = f"replace({x}, '{a}', '{b}')"
    return f"trim(regexp_replace({x}, '{PUNCTUATION}', ' ', 'g'), ' ')"
