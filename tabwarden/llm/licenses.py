"""Licence texts and notices, looked up by the digest of a canonical form.

The canonical form is lower case, without copyright lines, with equivalent spellings made one, and
with every run of anything but letters and digits as one space. The digest of an entire text is
hash-joined to the digests of known licences; the digest of every line that speaks of a
licence is looked up among the known one-line notices. Everything runs as DataFrame functions.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Entire texts. The public wording of short licences, without copyright lines.
LICENSES = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest
in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of
our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
}



def _shipped() -> list[tuple[str, str]]:
    """(licence, text) of the files of ``license_texts``: the public wording, one file for each, others of the same after a plus."""
    files = [f for f in resources.files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")]
    return [(f.name[:-4].partition("+")[0], f.read_text(encoding="utf-8").strip()) for f in sorted(files, key=lambda f: f.name[:-4])]


# Further wordings of licences that LICENSES already holds.
WORDINGS: list[tuple[str, str]] = []
for _name, _text in _shipped():
    if _name in LICENSES:
        WORDINGS.append((_name, _text))
    else:
        LICENSES[_name] = _text

# Title lines that stand above a text, or do not. Fixed values.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)", "0BSD"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License",
        "The Simplified BSD License", "FreeBSD License", "BSD License", "The BSD License", "BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License",
        "The New BSD License", "Modified BSD License", "Revised BSD License", "BSD License", "The BSD License", "BSD-3-Clause",
    ],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib License (Zlib)", "Zlib"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "BSL-1.0": ["Boost Software License"],
}

# One-line notices; each must speak of a licence in its canonical form.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "GPL-3.0-only": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}

# Spellings that mean the same. Fixed values, each on the left written as on the right.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "copyright owner": "copyright holder",
    "favour": "favor",
    "fulfil ": "fulfill ",
    "licence": "license",
    "licenced": "licensed",
    "noncommercial": "non commercial",
    "non infringement": "noninfringement",
    "organisation": "organization",
    "per cent": "percent",
    "recognise": "recognize",
    "sub license": "sublicense",
    "whilst": "while",
    "wilful": "willful",
}
# Tables of known digests up to this many rows are broadcast.
BROADCAST_ROWS = 100_000

# Where licences of the Free Software Foundation give its address; earlier prints have the one before.
FSF_ADDRESS = r"51 Franklin\s+St(?:reet)?,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA"
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*(?:\d{4}|\(c\)|©)[^\n]*$|^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for other, one in SPELLINGS.items():
        out = F.replace(out, F.lit(other), F.lit(one))
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def forms(name: str, text: str) -> list[str]:
    """A text as it is found in files: with any title line or none, with numbers or bullets, to the end of its
    terms or with the appendix after them, blank or filled in, and with either scheme of its links."""
    head, _, rest = text.partition("\n\n")
    body = rest if rest and "\n" not in head and head.lower().endswith("license") else text
    found = [text, body, *[f"{t}\n\n{body}" for t in TITLES.get(name, [])]]
    for change in (
        lambda t: re.sub(r"(?m)^[ \t]*\d\.[ \t]+", "", t) if name in TITLES else t,
        lambda t: re.sub(r"(END OF TERMS AND CONDITIONS).*", r"\1", t, flags=re.S),
        lambda t: re.sub(r"END OF TERMS AND CONDITIONS\s*\Z", "", t),
        # A line with a year in it is a copyright line and left out of the canonical form.
        lambda t: re.sub(r"(?m)^[ \t]*Copyright [\[{]yyyy[\]}] .*$", "", t),
        lambda t: re.sub(FSF_ADDRESS, "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", t),
        lambda t: t.replace("http://", "https://"),
        lambda t: t.replace("https://", "http://"),
    ):
        found = list(dict.fromkeys([*found, *map(change, found)]))
    return found


def known_licenses(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(license, digest) of entire texts in all their forms."""
    sources = [*LICENSES.items(), *WORDINGS] if texts is None else texts.items()
    rows = [(name, form) for name, text in sources for form in forms(name, text)]
    table = spark.createDataFrame(rows, "license string, text string")
    return table.select("license", digest(F.col("text")).alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def known_notices(spark: SparkSession, notices: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Digest of every notice and its licence."""
    rows = [(name, line) for name, lines in (NOTICES if notices is None else notices).items() for line in lines]
    table = spark.createDataFrame(rows, "license string, text string")
    found = table.select("license", "text", canonical(F.col("text")).alias("form"), digest(F.col("text")).alias("digest")).collect()
    for r in found:
        if "licens" not in r["form"]:
            raise ValueError(f"a notice must speak of a license: {r['text']}")
    return {r["digest"]: r["license"] for r in found}


def find_licenses(
    docs: DataFrame, texts: dict[str, str] | None = None, notices: dict[str, list[str]] | None = None
) -> DataFrame:
    """(doc_id, digest, license, notices, n_notices) of every row of ``docs`` (doc_id, text; other columns are
    ignored): the digest of the entire text, the licence it is, and the licences whose notices stand as lines in it.

    A null text counts as empty and is no licence. Rows are looked up one by one, so repeated ones
    and those without a doc_id change nothing. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    known = known_licenses(spark, texts).withColumnRenamed("digest", "known_digest")
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    lines = known_notices(spark, notices)
    table = F.create_map(*[F.lit(x) for pair in lines.items() for x in pair]) if lines else F.create_map().cast("map<string,string>")
    text = F.coalesce(F.col("text"), F.lit(""))
    candidates = F.when(text.rlike("(?i)licen[sc]"), F.filter(F.split(text, "\n"), lambda s: s.rlike("(?i)licen[sc]")))
    found = F.filter(F.transform(candidates, lambda s: F.try_element_at(table, digest(s))), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    rows = docs.select("doc_id", digest(text).alias("digest"), F.coalesce(found, none).alias("lines"))
    joined = rows.join(known, rows["digest"] == known["known_digest"], "left")
    return joined.select(
        "doc_id", "digest", "license", F.array_sort(F.array_distinct("lines")).alias("notices"), F.size("lines").cast("bigint").alias("n_notices")
    )
