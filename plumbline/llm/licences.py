"""Licence texts by canonical digest.

A text is brought to a canonical form (case, punctuation, copyright lines, equivalent spellings) and
its digest is joined with the digests of known licences. Every whole text is looked up, and every
line on its own, since notices stand between other lines.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal, after case and punctuation are gone.
SPELLINGS = (
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("per cent", "percent"),
    ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("utilis", "utiliz"),
    ("fulfilment", "fulfillment"),
    ("analogue", "analog"),
    ("programme ", "program "),
    ("https ", "http "),
)

# Notices by which a work names its licence, and first sentences of licences.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this permission"
        " notice appear in all copies.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted.",
    ),
)

_PROGRAM = (
    " is free software{sign} you can redistribute it and/or modify it under the terms of the GNU {kind} General Public"
    " License as published by the Free Software Foundation{either} version {version} of the License, or (at your"
    " option) any later version. {start} is distributed in the hope that it will be useful, but WITHOUT ANY"
    " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
    " GNU {kind} General Public License for more details. You should have received a copy of the GNU {kind} General"
    " Public License along with this {last}"
)
_WRITE = "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301"
_SEE = ". If not, see <https://www.gnu.org/licenses/>."


def _header(work: str, kind: str, version: str, last: str, sign: str = ":", either: str = ", either") -> str:
    start = f"This {work}"
    return start + _PROGRAM.format(start=start, kind=kind, version=version, sign=sign, either=either, last=last)


# Headers of files, the blanks between words do not count.
HEADERS = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR'
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("GPL-2.0-or-later", _header("program", "", "2", "program" + _WRITE + " USA.", ";", "; either")),
    ("GPL-3.0-or-later", _header("program", "", "3", "program" + _SEE)),
    ("LGPL-2.1-or-later", _header("library", "Lesser", "2.1", "library" + _WRITE + " USA", ";", "; either")),
    ("LGPL-3.0-or-later", _header("program", "Lesser", "3", "program" + _SEE)),
    ("AGPL-3.0-or-later", _header("program", "Affero", "3", "program" + _SEE)),
)


def _variants(text: str) -> set[str]:
    """A text as it is and with a line for each paragraph, as lines that begin with "(c)" count as claims
    of a copyright; both with and without a title of one short line, and with the usual reservation."""
    paragraphs = [p for p in re.split(r"\n\s*\n", text.strip()) if p.strip()]
    titled = len(paragraphs[0]) < 60 and "\n" not in paragraphs[0].strip()
    out = set()
    for start in (0, 1) if titled else (0,):
        kept = paragraphs[start:]
        for form in (kept, [" ".join(p.split()) for p in kept]):
            out.add("\n\n".join(form))
            claim = next((i for i, p in enumerate(form) if p.lower().startswith("copyright (c) <year>")), None)
            if claim is not None:
                out.add("\n\n".join([*form[: claim + 1], "All rights reserved.", *form[claim + 1 :]]))
    return out


def _texts() -> tuple[tuple[str, str], ...]:
    """The licences in full, a file of ``licence_texts`` each."""
    folder = Path(__file__).parent / "licence_texts"
    return tuple((f.stem, v) for f in sorted(folder.glob("*.txt")) for v in sorted(_variants(f.read_text("utf-8"))))


KNOWN = NOTICES + HEADERS + _texts()


def canonical_lines(text: Column) -> Column:
    """A text in canonical form, a line in each row of it; lines that claim a copyright are gone."""
    lowered = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    claimed = F.when(
        F.contains(lowered, F.lit("copyright")) | F.contains(lowered, F.lit("©")) | F.contains(lowered, F.lit("(c)")),
        F.regexp_replace(
            lowered, r"(?m)^[^\p{L}\p{N}\n©(]*(?:copyright[ \t]*(?:\(c\)|©|[0-9])|\(c\)|©)[^\n]*", ""
        ),
    ).otherwise(lowered)
    bare = F.regexp_replace(claimed, r"[^\p{L}\p{N}\n]+", " ")
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, bare)


def _line_digests(lines: Column) -> Column:
    return F.transform(
        F.filter(F.transform(F.split(lines, "\n", -1), lambda line: F.trim(line)), lambda line: line != ""),
        lambda line: F.sha2(line, 256),
    )


def _whole_digest(lines: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(lines, r"[ \n]+", " ")), 256)


def _whole_key(lines: Column) -> Column:
    """The digest by which whole texts are looked up: spellings of several words count across lines too."""
    joined = F.trim(F.regexp_replace(lines, r"[ \n]+", " "))
    several = [pair for pair in SPELLINGS if " " in pair[0]]
    return F.sha2(reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), several, joined), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``(digest, licence)`` of known texts; of texts that are equal in canonical form the first
    name in alphabetical order counts."""
    rows = spark.createDataFrame(list(known), "licence string, text string")
    return digests_of(rows)


def digests_of(rows: DataFrame) -> DataFrame:
    """``(digest, licence)`` of a table ``(licence, text)``."""
    return (
        rows.select("licence", _whole_key(canonical_lines(F.col("text"))).alias("digest"))
        .where(F.col("digest") != F.sha2(F.lit(""), 256))
        .groupBy("digest")
        .agg(F.min("licence").alias("licence"))
    )


def scanned(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, digest, licence, n_notices, licences)`` for every row of ``docs``.

    ``licence`` names the known text that equals the whole document, ``licences`` those that equal
    one of its lines, sorted and joined by commas, and ``n_notices`` counts such lines. Null, empty
    and blank texts have the digest of the empty text and no licence. Repeated rows repeat. A row
    without an id is looked up like any other. Other columns are not read.
    """
    forms = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    ).select("doc_id", F.xxhash64("text").alias("text_hash"), canonical_lines(F.col("text")).alias("lines"))
    # The second look at the texts is cheaper than a shuffle of all digests.
    notices = (
        forms.select("doc_id", "text_hash", F.posexplode(_line_digests(F.col("lines"))).alias("place", "digest"))
        .join(known, "digest")
        .select("doc_id", "text_hash", "place", "licence")
        .distinct()
        .groupBy("doc_id", "text_hash")
        .agg(
            F.count("*").alias("n"),
            F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("names"),
        )
        .withColumnsRenamed({"doc_id": "notice_id", "text_hash": "notice_hash"})
    )
    whole = forms.select("doc_id", "text_hash", _whole_digest(F.col("lines")).alias("digest"), _whole_key(F.col("lines")).alias("key"))
    looked_up = known.select(F.col("digest").alias("key"), "licence")
    same = F.col("doc_id").eqNullSafe(F.col("notice_id")) & (F.col("text_hash") == F.col("notice_hash"))
    return (
        whole.join(looked_up, "key", "left")
        .join(notices, same, "left")
        .select(
            "doc_id",
            "digest",
            "licence",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
            F.coalesce("names", F.lit("")).alias("licences"),
        )
    )
