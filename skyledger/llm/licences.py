"""Licence texts found by the digest of their canonical form.

Canonical form: compatibility of case, punctuation and spaces, without copyright lines and with
one spelling for each word that has several. A text is a known licence if its digest is known;
so is a line of it, which catches notices at the end or head of a document. Only digests are
joined, and the table of known licences has a fixed size, some thousand rows, whatever the size of the corpus.
"""

from __future__ import annotations

import itertools
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.shared import id_and_text

# Equivalent spellings and the one that stands for them, whole words in lower case.
SPELLINGS = [
    ("license", "licence"),
    ("licenses", "licences"),
    ("licensed", "licenced"),
    ("sublicense", "sublicence"),
    ("merchantibility", "merchantability"),
    ("noninfringement", "non infringement"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("http", "https"),
    ("per cent", "percent"),
    ("favor", "favour"),
    ("organization", "organisation"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("gnu gpl", "gnu general public licence"),
]

# Known licences and their public texts or notices.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
LICENCES = [
    ("MIT", "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_REST),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_REST),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
]

# The public BSD text; its clauses are numbered or not, and the last one is left out of BSD-2-Clause.
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the {own} nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission.",
)
_BSD_REST = (
    'THIS SOFTWARE IS PROVIDED BY THE {many} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE {one} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_OWNERS = [
    ("copyright holder", "COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"),
    ("copyright holder", "COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"),
    ("University", "REGENTS", "REGENTS"),
]

# Licences whose whole public text is a file of the package, and where an addition may begin that is left out.
FULL_TEXTS = [
    ("Apache-2.0", ["END OF TERMS AND CONDITIONS", "APPENDIX: How to apply"]),
    ("GPL-2.0", ["END OF TERMS AND CONDITIONS", "How to Apply These Terms"]),
    ("GPL-3.0", ["END OF TERMS AND CONDITIONS", "How to Apply These Terms"]),
    ("LGPL-2.1", ["END OF TERMS AND CONDITIONS", "How to Apply These Terms"]),
    ("LGPL-3.0", []),
    ("MPL-2.0", ["Exhibit A - Source", "Exhibit B - \"Incomp"]),
    ("CC0-1.0", []),
]
# Lines of the files that other editions have differently or, filled in, as a copyright line.
OTHER_LINES = [
    ("Copyright [yyyy] [name of copyright owner]", ""),
    ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "<https://fsf.org/>"),
]

# The Creative Commons family.
_CC_VERSIONS = [("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")]
_CC_CODES = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
_CC_WORDS = [
    {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"},
    {"BY": "Attribution", "SA": "Share-Alike", "NC": "Non-Commercial", "ND": "No-Derivatives"},
    {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivs"},
]
_CC_FRAMES = [
    "Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "This content is licensed under {}.",
    "This text is licensed under {}.", "This document is licensed under {}.", "Distributed under {}.",
]


def _bsd_texts() -> list[tuple[str, str]]:
    out = []
    for clauses, numbered, (own, many, one) in itertools.product((2, 3), (True, False), _BSD_OWNERS):
        points = [f"{k + 1}. {c}" if numbered else f"* {c}" for k, c in enumerate(_BSD_CLAUSES[:clauses])]
        text = "\n".join([_BSD_HEAD, *points, _BSD_REST]).format(own=own, many=many, one=one)
        titles = ("", f"BSD {clauses}-Clause License\n", f"The BSD {clauses}-Clause License\n")
        out += [(f"BSD-{clauses}-Clause", title + text) for title in titles]
    return out


def _file_texts() -> list[tuple[str, str]]:
    """The whole texts, also without their additions and with other editions' lines."""
    out = []
    for name, additions in FULL_TEXTS:
        text = resources.files("skyledger.llm").joinpath("licence_texts", f"{name}.txt").read_text("utf-8")
        for spelt in dict.fromkeys([text, *(text.replace(old, new) for old, new in OTHER_LINES)]):
            out += [(name, spelt), *((name, spelt[: spelt.index(a)]) for a in additions)]
            out += [(name, spelt.partition(a)[0] + a) for a in additions if a.startswith("END")]
    return out


def _cc_notices() -> list[tuple[str, str]]:
    out = []
    for code, (version, ported) in itertools.product(_CC_CODES, _CC_VERSIONS):
        name, parts = f"CC-{code}-{version}", code.split("-")
        link = f"https://creativecommons.org/licenses/{code.lower()}/{version}/"
        forms = [f"CC {code} {version}", f"Creative Commons {code} {version}"]
        for words in _CC_WORDS:
            long = "Creative Commons " + "-".join(words[p] for p in parts)
            forms += [f"{long} {version}", f"{long} {version} {ported}"]
        for form, article, last in itertools.product(forms, ("", "a ", "the "), ("", " License", " International License")):
            if last.startswith(" I") and (ported != "International" or form.endswith(ported)):
                continue
            out += [(name, frame.format(article + form + last)) for frame in _CC_FRAMES]
        out.append((name, f"SPDX-License-Identifier: CC-{code}-{version}"))
        for form, article in itertools.product(forms, ("a ", "the ")):
            view = f"This work is licensed under {article}{form} License. To view a copy of this license, visit {link}"
            letter = "or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."
            out += [(name, view), (name, f"{view} {letter}")]
    return out


def all_licences() -> list[tuple[str, str]]:
    """Every known licence with each of its texts and notices."""
    mit = LICENCES[0][1].partition("\n")[2]
    titled = [("MIT", mit), ("MIT", "The MIT License (MIT)\n" + mit), ("MIT", "The MIT License\n" + mit)]
    return list(dict.fromkeys([*LICENCES, *titled, *_bsd_texts(), *_file_texts(), *_cc_notices()]))

# A line that starts so, after marks, only says whose the text is.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright ([(]c[)]|©|[0-9]{4}|by )|©|[(]c[)] [0-9]{4}|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    """The canonical form of a text; empty for a text without letters and digits."""
    form = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    form = F.concat(F.lit(" "), F.trim(F.regexp_replace(form, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for spelling, one in SPELLINGS:
        form = F.replace(form, F.lit(f" {spelling} "), F.lit(f" {one} "))
    return F.trim(form)


def digest(text: Column) -> Column:
    """Hex SHA-256 of the canonical form."""
    return F.sha2(canonical(text), 256)


def known_licences(spark: SparkSession, licences: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, licence``: of equal forms the first name counts. A table in memory, of fixed size."""
    rows = all_licences() if licences is None else licences
    table = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "place int, licence string, text string")
    table = table.groupBy(digest(F.col("text")).alias("digest"), canonical(F.col("text")).alias("form"))
    return table.agg(F.min_by("licence", "place").alias("licence")).filter("form <> ''").select("digest", "licence")


def scan_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, scope, line, licence`` for every known licence: ``text`` as a whole, or ``line`` number (from 0).

    The whole text's digest covers it to the end; a line that is a licence by itself is found in
    any text. A text of one line that is a licence gives the row for the text alone. Null and
    empty texts have none; repeated rows give their rows as often.
    """
    known = known_licences(docs.sparkSession) if known is None else known
    rows = id_and_text(docs).filter("text <> ''")
    lines = F.transform(
        F.split("text", "\n"), lambda x, k: F.struct(F.lit("line").alias("scope"), k.alias("line"), x.alias("part"))
    )
    whole = F.struct(F.lit("text").alias("scope"), F.lit(-1).alias("line"), F.col("text").alias("part"))
    several = F.contains("text", F.lit("\n"))
    parts = F.concat(F.array(whole), F.when(several, lines).otherwise(F.slice(lines, 1, 0)))
    spread = rows.select("doc_id", F.explode(parts).alias("p")).select("doc_id", "p.scope", "p.line", digest(F.col("p.part")).alias("digest"))
    return spread.join(F.broadcast(known), "digest").select("doc_id", "scope", F.col("line").cast("long"), "licence")
