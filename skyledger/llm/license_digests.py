"""License scans by canonical digest.

Texts of licenses and license notices vary in case, punctuation, line breaks, spelling and in whose copyright they
state. A canonical form takes these away, and its digest is looked up among the digests of known texts by a hash join. The
whole text of a document is looked up, and each of its lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lines that state a copyright and say nothing of the license.
COPYRIGHT = r"^[^0-9a-z]*((copyright|\(c\)|©)([^a-z].*)?|all rights reserved[^0-9a-z]*)$"
#: Equivalent spellings, each between single spaces, applied in order.
SPELLINGS = [
    (" licence ", " license "), (" licences ", " licenses "), (" licenced ", " licensed "), (" sub license ", " sublicense "), (" sublicence ", " sublicense "),
    (" ver ", " version "), (" v ", " version "), (" non commercial ", " noncommercial "), (" copyright holder ", " copyright owner "), (" copyright holders ", " copyright owners "),
    (" merchantibility ", " merchantability "), (" per cent ", " percent "), (" gpl ", " gnu general public license "), (" gnu gnu ", " gnu "), (" by nc ", " by noncommercial "),
]
#: All canonical forms of known texts contain one of these, so a text without them is not looked up.
TRACES = ("licen", "under", "permission", "warrant")

#: Names of licenses as notices give them, by identifier.
NAMES = {
    "MIT": ["the mit license", "the mit licence", "mit"], "Apache-2.0": ["the apache license, version 2.0", "the apache license 2.0", "apache 2.0"],
    "BSD-2-Clause": ["the bsd 2-clause license", "the simplified bsd license"], "BSD-3-Clause": ["the bsd 3-clause license", "the new bsd license", "the revised bsd license"],
    "ISC": ["the isc license"], "MPL-2.0": ["the mozilla public license, version 2.0", "the mozilla public license 2.0"],
    "Unlicense": ["the unlicense"], "Zlib": ["the zlib license"], "CC0-1.0": ["cc0 1.0", "cc0"], "EPL-2.0": ["the eclipse public license, version 2.0", "the eclipse public license 2.0"],
}
for _version in ("2", "3"):
    NAMES[f"GPL-{_version}.0"] = [f"the gnu general public license{sep}{_version}{zero}" for sep in (", version ", " v", " ") for zero in ("", ".0")]
    NAMES[f"LGPL-{_version}.0"] = [f"the gnu lesser general public license{sep}{_version}{zero}" for sep in (", version ", " v", " ") for zero in ("", ".0")]
NAMES["AGPL-3.0"] = [f"the gnu affero general public license{sep}3{zero}" for sep in (", version ", " v", " ") for zero in ("", ".0")]
for _terms in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version in ("2.0", "3.0", "4.0"):
        NAMES[f"CC-{_terms}-{_version}"] = [f"cc {_terms.lower()} {_version}", f"a cc {_terms.lower()} {_version} license", f"the cc {_terms.lower()} {_version} license"]
NOTICES = [
    "licensed under {}", "released under {}", "distributed under {}", "available under {}", "this work is licensed under {}", "this file is licensed under {}",
    "this project is licensed under {}", "this software is licensed under {}", "this software is released under {}", "this document is licensed under {}",
    "licensed under the terms of {}", "released under the terms of {}", "license: {}",
]
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)


def _bsd(clauses: int, numbered: bool) -> str:
    """The text of the BSD license with so many clauses, numbered or with signs before them."""
    listed = [f"{k}. {c}" if numbered else f"* {c}" for k, c in enumerate(_BSD[1 : 1 + clauses], 1)]
    return "\n".join([_BSD[0], *listed, _BSD[-1]])


#: Short licenses in full.
FULL = {
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause": _bsd(2, True),
    "BSD-3-Clause": _bsd(3, True),
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}
#: Other ways in which the same texts are set.
VARIANTS = [("BSD-2-Clause", _bsd(2, False)), ("BSD-3-Clause", _bsd(3, False)), ("Unlicense", FULL["Unlicense"] + " For more information, please refer to <https://unlicense.org/>"), ("Unlicense", FULL["Unlicense"] + " For more information, please refer to <http://unlicense.org/>")]
#: Titles of full texts, none among them.
TITLES = ["", "{} License\n", "The {} License\n", "The {} License ({})\n"]


def known_texts() -> list[tuple[str, str]]:
    """(license, text) of the notices that the names and forms above make, with and without a title of full texts."""
    out = [(i, form.format(name)) for i, names in NAMES.items() for name in names for form in NOTICES]
    out += [(i, f"SPDX-License-Identifier: {i}") for i in NAMES]
    return out + [(i, title.format(i, i) + text) for i, text in [*FULL.items(), *VARIANTS] for title in TITLES]


def canonical(text: Column) -> Column:
    """The canonical form of a text: small letters, no copyright lines, words by single spaces, one spelling."""
    low = F.translate(text, UPPER, LOWER)
    own = F.filter(F.split(low, "\n"), lambda line: ~line.rlike(COPYRIGHT))
    plain = F.regexp_replace(F.array_join(own, " "), MARKS, " ")
    spaced = F.regexp_replace(F.concat(F.lit(" "), F.trim(plain), F.lit(" ")), " v([0-9])", " v $1")
    for old, new in SPELLINGS:
        spaced = F.replace(spaced, F.lit(old), F.lit(new))
    return F.trim(spaced)


def digest(text: Column) -> Column:
    return F.md5(canonical(text))


def _may(text: Column) -> Column:
    """Whether a text can be a known one."""
    return reduce(Column.__or__, [F.lower(text).contains(t) for t in TRACES])


def texts_in(spark: SparkSession, folder: str) -> DataFrame:
    """(license, text) of the files in a folder: a license in full in each, named by the file without its last ending."""
    files = spark.read.text(folder, wholetext=True)
    return files.select(F.regexp_replace("_metadata.file_name", r"(?<=.)\.[A-Za-z]+$", "").alias("license"), F.col("value").alias("text"))


def registry(spark: SparkSession, texts: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """Digests of known texts with their license; a text that several licenses share goes to the first by name.

    ``texts`` are pairs or rows of license and text, such as those of ``texts_in``; without them, those of ``known_texts``.
    """
    rows = texts if isinstance(texts, DataFrame) else spark.createDataFrame(known_texts() if texts is None else texts, "license string, text string")
    rows = rows.select("license", digest(F.col("text")).alias("digest"), canonical(F.col("text")).alias("canonical"))
    lost = F.raise_error(F.concat(F.lit(f"a known text has none of {TRACES}: "), "canonical")).cast("string")
    rows = rows.withColumn("license", F.when(_may(F.col("canonical")), F.col("license")).otherwise(lost))
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, license (of the whole text, null if it is none), n_license_lines and licenses for every row of docs.

    licenses lists those of the whole text and of single lines, sorted, by commas, empty if there are none;
    n_license_lines counts lines that are a known notice as a whole. ``known`` is a registry, which Spark
    sends to every executor if it is below the broadcast threshold, and shuffles by digest beyond. Null and empty texts have no license. Rows that repeat a doc_id are each scanned by their own
    text; other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))
    some = own.filter(_may(F.col("text"))).dropDuplicates(["doc_id", "h"])
    lines = F.filter(F.split("text", "\n"), _may)
    units = some.select("doc_id", "h", F.struct(F.lit(True).alias("whole"), digest(F.col("text")).alias("digest")).alias("first"), F.transform(lines, lambda t: F.struct(F.lit(False).alias("whole"), digest(t).alias("digest"))).alias("rest"))
    units = units.select("doc_id", "h", F.inline(F.concat(F.array("first"), "rest")))
    hits = units.join(known, "digest").groupBy("doc_id", "h").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.count(F.when(~F.col("whole"), 1)).alias("n_license_lines"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
    )
    hits = hits.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    out = own.select("doc_id", "h").join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    return out.select("doc_id", "license", F.coalesce("n_license_lines", F.lit(0).cast("long")).alias("n_license_lines"), F.coalesce("licenses", F.lit("")).alias("licenses"))
