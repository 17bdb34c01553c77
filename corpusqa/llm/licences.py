"""Licence scan: canonical digests of entire texts, joined to those of known licences.

A text's canonical form has lower case, no lines that state a copyright, one spelling
for each word that licences spell in several ways, and no punctuation. Its SHA-256
is looked up in a table of known licences, which may be any size: the lookup is an
equality join. Texts looked up are each whole document and each of its lines, as
notices stand alone on a line. Only digests travel, never texts.

Cases: null and empty texts, and texts of copyright lines only, have the digest of
nothing, which no licence has; a notice of rights alone is kept as it is; several
licences of equal canonical text are all reported; repeated rows get equal results;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.llm.common import text_key

# -- fixed values ------------------------------------------------------------------

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Short licences: name, titles they go under, paragraphs.
TEXTS = [
    ("MIT", ["", "MIT License", "The MIT License", "The MIT License (MIT)"], [_MIT_GRANT]),
    ("ISC", ["", "ISC License", "The ISC License"], [_ISC_GRANT, _ISC_WARRANTY]),
    ("0BSD", ["", "BSD Zero Clause License", "Zero-Clause BSD"], ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", _ISC_WARRANTY]),
    ("BSD-2-Clause", ["", "BSD 2-Clause License"], [_BSD_OPENING, "1. " + _BSD_SOURCE, "2. " + _BSD_BINARY, _BSD_WARRANTY]),
    ("BSD-2-Clause", ["", "BSD 2-Clause License"], [_BSD_OPENING, "* " + _BSD_SOURCE, "* " + _BSD_BINARY, _BSD_WARRANTY]),
    ("BSD-3-Clause", ["", "BSD 3-Clause License"], [_BSD_OPENING, "1. " + _BSD_SOURCE, "2. " + _BSD_BINARY, "3. " + _BSD_NAMES, _BSD_WARRANTY]),
    ("BSD-3-Clause", ["", "BSD 3-Clause License"], [_BSD_OPENING, "* " + _BSD_SOURCE, "* " + _BSD_BINARY, "* " + _BSD_NAMES, _BSD_WARRANTY]),
]

#: Long licences: name, SHA-256 of the canonical form, and the part of the text that has it. The texts are those that
#: Debian ships in /usr/share/common-licenses; zlib and PSF are those shipped with numpy and typing_extensions.
DIGESTS = [
    ("Apache-2.0", "0d5838e6f6e5a374e58d608af5c01bc6a67cf18552dd7b346e5aef652b808ee9", "whole text"),
    ("Apache-2.0", "0933e9fdf25f8a4aced10e10246650350123e13b939182f69b5ec6730ce2d793", "up to the end of its terms"),
    ("Artistic-1.0-Perl", "66e644aafc5ff1de25be918be7e71d1d851bab015f750bc67c5b245e5f33ff39", "whole text"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651", "whole text, for the University"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", "whole text"),
    ("GFDL-1.2", "37db86be8f16e9b8dfb0d63e1698ad2e07d54f312494c1cb2dbdb4fa37487f0f", "whole text"),
    ("GFDL-1.3", "7befa86e5ee53162018d597eee81db6c727f3e64fab4641af93e19deab1807b4", "whole text"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", "whole text"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc", "up to the end of its terms"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1", "whole text"),
    ("GPL-2.0", "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999", "up to the end of its terms"),
    ("GPL-3.0", "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f", "whole text"),
    ("GPL-3.0", "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b", "up to the end of its terms"),
    ("LGPL-2.0", "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3", "whole text"),
    ("LGPL-2.0", "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c", "up to the end of its terms"),
    ("LGPL-2.1", "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345", "whole text"),
    ("LGPL-2.1", "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c", "up to the end of its terms"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", "whole text"),
    ("MPL-1.1", "fcb579371133afd771fed87cd5d8c6dc5648746c9945d4adf08ec5c79aba5c61", "whole text"),
    ("MPL-2.0", "522ffc6ac495c6e61524b4b97893c98f63d86e482e6a0878ba2b43f88f326aae", "whole text"),
    ("PSF-2.0", "1aff7c3dcd108b177a59e5a8dbcc1cc99ec321e1acadc6a8a6a7825735fa6b09", "whole text, with its history"),
    ("Zlib", "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a", "whole text, with its title"),
]

#: How notices name a licence, and its SPDX identifiers.
NAMES = [
    ("0BSD", ["the BSD Zero Clause License"], ["0BSD"]),
    ("Apache-2.0", ["the Apache License, Version 2.0", "the Apache License 2.0"], ["Apache-2.0"]),
    ("Artistic-1.0-Perl", ["the Artistic License"], ["Artistic-1.0-Perl"]),
    ("BSD-2-Clause", ["the BSD 2-Clause License"], ["BSD-2-Clause"]),
    ("BSD-3-Clause", ["the BSD 3-Clause License"], ["BSD-3-Clause"]),
    ("CC-BY-4.0", ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"], ["CC-BY-4.0"]),
    ("CC-BY-SA-4.0", ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"], ["CC-BY-SA-4.0"]),
    ("CC-BY-NC-4.0", ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"], ["CC-BY-NC-4.0"]),
    ("CC-BY-NC-SA-4.0", ["CC BY-NC-SA 4.0", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"], ["CC-BY-NC-SA-4.0"]),
    ("CC0-1.0", ["CC0 1.0"], ["CC0-1.0"]),
    ("GFDL-1.2", ["the GNU Free Documentation License, version 1.2"], ["GFDL-1.2", "GFDL-1.2-only", "GFDL-1.2-or-later"]),
    ("GFDL-1.3", ["the GNU Free Documentation License, version 1.3"], ["GFDL-1.3", "GFDL-1.3-only", "GFDL-1.3-or-later"]),
    ("GPL-1.0", ["the GNU General Public License, version 1"], ["GPL-1.0", "GPL-1.0-only", "GPL-1.0-or-later"]),
    ("GPL-2.0", ["the GNU General Public License, version 2"], ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"]),
    ("GPL-3.0", ["the GNU General Public License, version 3"], ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"]),
    ("ISC", ["the ISC License"], ["ISC"]),
    ("LGPL-2.0", ["the GNU Library General Public License, version 2"], ["LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later"]),
    ("LGPL-2.1", ["the GNU Lesser General Public License, version 2.1"], ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"]),
    ("LGPL-3.0", ["the GNU Lesser General Public License, version 3"], ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"]),
    ("MIT", ["the MIT License"], ["MIT"]),
    ("MPL-1.1", ["the Mozilla Public License, version 1.1"], ["MPL-1.1"]),
    ("MPL-2.0", ["the Mozilla Public License, version 2.0"], ["MPL-2.0"]),
    ("PSF-2.0", ["the Python Software Foundation License, version 2"], ["PSF-2.0"]),
    ("Zlib", ["the zlib License"], ["Zlib"]),
]
WORDINGS = ["Released under {}.", "Licensed under {}.", "Distributed under {}.", "This work is licensed under {}.", "This software is licensed under {}."]
SPDX = "SPDX-License-Identifier: {}"

#: Notices that stand alone.
NOTICES = [
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
]

#: A line that states a copyright.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
#: Patterns and what stands for them, in this order, on lower-case text.
SPELLINGS = [
    ("https", "http"),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("sub license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("v[.] ?(?=[0-9])", "version "),
]
RIGHTS = "all rights reserved"

# -- end of fixed values -------------------------------------------------------------

#: Known texts: name and text.
KNOWN = (
    [(name, "\n\n".join([title, "Copyright (c) <year> <copyright holders>", *parts])) for name, titles, parts in TEXTS for title in titles]
    + [(name, wording.format(called)) for name, calls, _ in NAMES for called in calls for wording in WORDINGS]
    + [(name, SPDX.format(i)) for name, _, ids in NAMES for i in ids]
    + NOTICES
)

_SQL_SPELLINGS = [(a.replace("(?=[0-9])", "([0-9])"), b + r"\1" if "(?=" in a else b) for a, b in SPELLINGS]


def canonical(text: Column) -> Column:
    """The form in which equal licences have equal texts."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    for pattern, spelling in SPELLINGS:
        if pattern.replace("-", "").replace(" ", "").isalpha():
            out = F.replace(out, F.lit(pattern), F.lit(spelling))
        else:
            out = F.regexp_replace(out, pattern, spelling)
    out = F.trim(F.regexp_replace(out, r"[^a-z0-9\x{80}-\x{10FFFF}]+", " "))
    bare = F.trim(F.regexp_replace(F.replace(out, F.lit(RIGHTS), F.lit(" ")), " +", " "))
    return F.when(out.contains(RIGHTS) & (bare != ""), bare).otherwise(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licences(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest, licences``: the names of each known canonical text; by default ``KNOWN`` and ``DIGESTS``."""
    texts = spark.createDataFrame(known or KNOWN, "licence string, text string").select(digest(F.col("text")).alias("digest"), "licence")
    if known is None:
        texts = texts.unionByName(spark.createDataFrame([(d, n) for n, d, _ in DIGESTS], "digest string, licence string"))
    return texts.groupBy("digest").agg(F.array_sort(F.collect_set("licence")).alias("licences"))


def scanned(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest, licences, notices``: licences of the whole text, and of its lines (sorted, or null)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("key"), digest(F.col(text)).alias("digest"))
    lines = docs.select(text_key(text).alias("key"), F.explode(F.split(F.col(text), "\n", -1)).alias("line"))
    found = (
        lines.select("key", digest(F.col("line")).alias("digest")).join(known, "digest")
        .select("key", F.explode("licences").alias("licence"))
        .groupBy("key").agg(F.array_sort(F.collect_set("licence")).alias("notices"))
    )
    return rows.join(known, "digest", "left").join(found, "key", "left").select("doc_id", "digest", "licences", "notices")


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', '', 'g')"
    for pattern, spelling in _SQL_SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{spelling}', 'g')"
    return f"trim(regexp_replace({out}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'))"


def scan_sql() -> str:
    """DuckDB SQL for the scan of ``documents`` against ``KNOWN`` and ``DIGESTS``, lists joined by commas."""
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in KNOWN)
    digests = ", ".join(f"('{name}', '{known}')" for name, known, _ in DIGESTS)

    def hashed(text: str, source: str, keep: str) -> str:
        return f"""SELECT {keep}, sha256(CASE WHEN c LIKE '%{RIGHTS}%' AND bare <> '' THEN bare ELSE c END) AS digest
          FROM (SELECT *, trim(regexp_replace(replace(c, '{RIGHTS}', ' '), ' +', ' ', 'g')) AS bare
                FROM (SELECT {keep}, {_sql_canonical(text)} AS c FROM {source}))"""

    return f"""
WITH known AS (SELECT DISTINCT licence, digest FROM ({hashed('text', f'(VALUES {values}) v(licence, text)', 'licence')})
  UNION VALUES {digests}),
lines AS ({hashed('line', "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)", 'doc_id')}),
notices AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
  FROM lines JOIN known USING (digest) GROUP BY doc_id),
whole AS ({hashed('text', 'documents', 'doc_id')}),
names AS (SELECT digest, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM known GROUP BY digest)
SELECT doc_id, digest, licences, notices FROM whole LEFT JOIN names USING (digest) LEFT JOIN notices USING (doc_id)"""
