r"""License scans by canonical digests.

A text is brought to a canonical form: case is folded, lines that only state a copyright are
dropped, equivalent spellings become one, and everything but letters and digits is a single space.
The SHA-256 of an entire text in that form is looked up among the digests of known licences by a
hash join. The same is done for single lines against known one-line notices.

The canonical form is a chain of SQL expressions that Spark and DuckDB share (Java and RE2 regular
expressions agree on them). Every text is brought to that form; of lines, only such as hold the word
that all notices have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

#: Entire texts of known licences by SPDX identifier.
TEXTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _WARRANTY,
    "MIT-0": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\n" + _WARRANTY,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TAIL,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_TAIL,
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _BSD_TAIL,
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\nFor more information, please refer to <https://unlicense.org/>",
}
#: One-line notices.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "Licensed under the Apache License 2.0."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Licensed under the GPL version 3 license."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "Licensed under the BSD 2-Clause License."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
}
#: Every notice has this, as does any spelling of it.
NOTICE_WORDS = "licen[cs]"
#: Equivalent spellings (regular expression, replacement), applied to canonical text with single spaces.
SPELLINGS = (
    (r"\b(sub) ?(licen)[cs]", r"\1\2s"),
    (r"\b(licen)c(e|es|ed|ing)\b", r"\1s\2"),
    (r"\b(acknowledg)e(ments?)\b", r"\1\2"),
    (r"\b(organi|recogni|authori|reali|utili)s(ation|ations|e|es|ed|ing)\b", r"\1z\2"),
    (r"\b(merchant) (ability)\b", r"\1\2"),
    (r"\b(non) (commercial|infringement)\b", r"\1\2"),
    (r"\b(copyright) owner", r"\1 holder"),
    (r"\bhttps\b", r"http"),
)
_COPYRIGHT = r"(^|\n)[ \t*#/;-]*(copyright|\(c\)|©)[ \t]*(\(c\)|©|[0-9]|<|\[|by )[^\n]*"


def _quoted(x: str, spark: bool) -> str:
    x = x.replace("'", "''") if not spark else x.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{x}'"


def canonical_sql(text: str, spark: bool = True) -> str:
    """SQL of the canonical form of an SQL expression, for Spark or DuckDB."""

    def replace(x: str, pattern: str, to: str) -> str:
        to = to.replace("\\1", "$1").replace("\\2", "$2") if spark else to
        return f"regexp_replace({x}, {_quoted(pattern, spark)}, {_quoted(to, spark)}{'' if spark else ', ' + chr(39) + 'g' + chr(39)})"

    out = replace(f"lower({text})", _COPYRIGHT, r"\1")
    out = replace(out, r"[^\p{L}\p{N}]+", " ")
    for pattern, to in SPELLINGS:
        out = replace(out, pattern, to)
    return f"trim({out})"


def digest_sql(text: str, spark: bool = True) -> str:
    return f"sha2({canonical_sql(text)}, 256)" if spark else f"sha256({canonical_sql(text, False)})"


def catalog(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(digest, license_id) of known entire texts, each digest once."""
    rows = [(k, t) for k, t in (TEXTS if texts is None else texts).items()]
    raw = spark.createDataFrame(rows, "license_id string, text string")
    return raw.selectExpr(f"{digest_sql('text')} AS digest", "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, license_id, notice_ids) for every row of docs (doc_id, text).

    digest is that of the entire canonical text, null for a text that is null or has no letter or digit.
    license_id is the licence whose entire text this is, else null; notice_ids lists, in order and joined
    by commas, the licences of which a whole line is a known notice. known (digest, license_id) adds to
    the built-in licences; a digest of two licences stands for the one that comes first. The join has an
    unaggregated shuffle on both sides, if any, so that adaptive execution can split a text of very many
    documents; rows without a digest are spread. Other columns are not read.
    """
    spark = docs.sparkSession
    licences = catalog(spark)
    if known is not None:
        licences = licences.unionByName(known.select("digest", "license_id")).groupBy("digest").agg(F.min("license_id").alias("license_id"))
        licences = durable(licences)
    notices = spark.createDataFrame([(k, n) for k, v in NOTICES.items() for n in v], "license_id string, text string")
    pairs = {r.digest: r.license_id for r in notices.selectExpr(f"{digest_sql('text')} AS digest", "license_id").collect()}
    table = F.create_map(*(F.lit(x) for kv in sorted(pairs.items()) for x in kv))
    digest = f"nullif({digest_sql('text')}, sha2('', 256))"
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    line_digests = F.expr(f"transform(filter(split(text, '\\\\n'), l -> lower(l) rlike '{NOTICE_WORDS}'), l -> {digest_sql('l')})")
    marked = text.select(
        "doc_id",
        F.expr(digest).alias("digest"),
        F.when(F.lower("text").rlike(NOTICE_WORDS), line_digests).alias("lines"),
    )
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("lines", lambda d: table[d]), lambda x: x.isNotNull())))
    marked = marked.select("doc_id", "digest", F.coalesce(F.array_join(ids, ","), F.lit("")).alias("notice_ids"))
    key = F.coalesce("digest", F.concat(F.lit("none "), F.pmod(F.xxhash64("doc_id"), F.lit(10007))))
    return marked.withColumn("_key", key).join(licences.withColumnRenamed("digest", "_key"), "_key", "left").select("doc_id", "digest", "license_id", "notice_ids")


def oracle() -> str:
    """The same in DuckDB's SQL, over the table documents and the built-in licences."""
    texts = ", ".join(f"({_quoted(k, False)}, {_quoted(v, False)})" for k, v in TEXTS.items())
    notices = ", ".join(f"({_quoted(k, False)}, {_quoted(n, False)})" for k, v in NOTICES.items() for n in v)
    return f"""
WITH known AS (SELECT {digest_sql('text', False)} AS digest, min(id) AS license_id FROM (VALUES {texts}) t(id, text) GROUP BY 1),
notices AS (SELECT {digest_sql('text', False)} AS digest, min(id) AS notice_id FROM (VALUES {notices}) t(id, text) GROUP BY 1),
d AS (SELECT doc_id, text, nullif({digest_sql('text', False)}, sha256('')) AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d WHERE regexp_matches(lower(text), '{NOTICE_WORDS}')),
found AS (SELECT DISTINCT doc_id, notice_id FROM (SELECT doc_id, {digest_sql('line', False)} AS digest FROM lines WHERE regexp_matches(lower(line), '{NOTICE_WORDS}')) JOIN notices USING (digest)),
ids AS (SELECT doc_id, string_agg(notice_id, ',' ORDER BY notice_id) AS notice_ids FROM found GROUP BY 1)
SELECT d.doc_id, d.digest, known.license_id, coalesce(ids.notice_ids, '') AS notice_ids
FROM d LEFT JOIN known ON d.digest = known.digest LEFT JOIN ids ON d.doc_id = ids.doc_id
"""
