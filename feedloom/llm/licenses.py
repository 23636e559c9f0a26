r"""Licence scans: canonical digests of entire texts, hash-joined to the digests of known licences.

A unit is a whole document, one of its paragraphs (parts between blank lines), one of its lines, or a run of paragraphs as long as a known
text of several (so that a licence inside of a longer text is met; a run is probed where its first paragraph begins a known text). Its canonical form is lower
case (A-Z), without copyright lines, with one spelling of equivalent words and one space for any run of punctuation or white
space; its digest is the MD5 of that form. Units without letters have no digest. A unit that is the whole of its document counts as
'document' only, one that is the whole of its paragraph as 'paragraph' only. Null and empty texts give no row; repeated
rows give repeated results; any length of text is scanned whole. The registry has a fixed size and is broadcast.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import table

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_2 = f"{_BSD_CONDITIONS}\n\n{_BSD_DISCLAIMER}"
_BSD_3 = f"{_BSD_CONDITIONS}\n\n{_BSD_ENDORSE}\n\n{_BSD_DISCLAIMER}"
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSL = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_ZERO_BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")

#: Known licence texts and notices, each an entire text.
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"), ("MIT", "MIT License"),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("ISC", "Released under the ISC License."), ("ISC", "Licensed under the ISC License."), ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", _ZERO_BSD), ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("Apache-2.0", _APACHE_HEADER), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"), ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", _BSD_2), ("BSD-3-Clause", _BSD_3), ("Zlib", _ZLIB), ("Unlicense", _UNLICENSE), ("BSL-1.0", _BSL), ("GPL-3.0-or-later", _GPL_NOTICE), ("MPL-2.0", _MPL_NOTICE),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "Released under the BSD 2-Clause License."), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."), ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."), ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."), ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0."),
]

#: Equivalent spellings, in the order in which they are replaced (after lower case).
SPELLINGS = [("licence", "license"), ("licencing", "licensing"), ("sub-licens", "sublicens"), ("non-commercial", "noncommercial"), ("non-infring", "noninfring"), ("copyright owner", "copyright holder"), ("organisation", "organization"), ("favour", "favor"), ("whilst", "while"), ("https:", "http:")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line of a copyright statement; a wrapped line that merely begins with the word is none.
_COPYRIGHT = r"(^|\n)[ \t]*(copyright[ \t]*(\(c\)|©|[0-9<\[{])|\(c\)|©)[^\n]*"
#: Runs of ASCII punctuation and blanks but line ends, and typographic quotes and dashes.
_PUNCT = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F“”‘’–—©]+"


def canonical(text: str) -> str:
    """The canonical form of one unit."""
    text = re.sub(_COPYRIGHT, "\n", text.translate(str.maketrans(_UPPER, _LOWER)))
    for a, b in SPELLINGS:
        text = text.replace(a, b)
    return re.sub(r" *[\n ]+", " ", re.sub(_PUNCT, " ", text)).strip(" ")


def digest(text: str) -> str:
    return hashlib.md5(canonical(text).encode()).hexdigest()


def registry() -> list[tuple[str, str]]:
    """(digest, licence) of the known texts, each digest once."""
    return sorted({digest(text): name for name, text in reversed(KNOWN)}.items())


def _prepared(text: Column) -> Column:
    """Canonical but for line ends, which still part the units."""
    text = F.regexp_replace(F.translate(text, _UPPER, _LOWER), _COPYRIGHT, "\n")
    for a, b in SPELLINGS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.regexp_replace(text, _PUNCT, " ")


def _runs() -> tuple[list[str], list[int]]:
    """Digests of the first paragraphs of known texts of several, and how many paragraphs those have."""
    several = [text.split("\n\n") for _, text in KNOWN if "\n\n" in text]
    return sorted({digest(parts[0]) for parts in several}), sorted({len(parts) for parts in several})


def _beginnings() -> str:
    """The first three words of those first paragraphs, as a pattern over prepared texts."""
    words = {tuple(canonical(text.split("\n\n")[0]).split(" ")[:3]) for _, text in KNOWN if "\n\n" in text}
    return "|".join(sorted("[ \\n]+".join(w) for w in words))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per unit that is a known licence: id, unit ('document', 'paragraph', 'paragraphs' or 'line'), unit_no (of the first paragraph of a run), digest, license.

    One pass without a shuffle: the canonical text is made once, its units' digests are exploded and probed in a broadcast table of fixed size.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(registry(), "digest string, license string")
    firsts, counts = _runs()
    flat = lambda c: F.trim(F.regexp_replace(c, "[ \n]+", " "))
    md5 = lambda c: F.md5(c.cast("binary"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    text = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.explode(F.array(_prepared(F.col(text_col)))).alias("t"))  # made once
    many = F.instr("t", "\n") > 0
    text = text.select("id", "t", *(F.when(many, F.split("t", sep)).otherwise(none("string")).alias(name) for name, sep in (("paragraphs", "\n *\n"), ("lines", "\n"))))
    # Few texts have the words that a known text of several paragraphs begins with; only there are runs looked for.
    text = text.withColumn("ps", F.when(F.col("t").rlike(_beginnings()), F.transform("paragraphs", flat)).otherwise(none("string")))
    begins = F.filter(F.transform("ps", lambda p, i: F.when(md5(p).isin(*firsts), i)), lambda i: i.isNotNull())
    fits = lambda i, k: (i + k <= F.size("ps")) & ~((i == 0) & (k == F.size("ps")))
    run = lambda i, k: F.struct(i.cast("long").alias("no"), F.array_join(F.slice("ps", i + 1, k), " ").alias("part"))
    runs = F.flatten(F.transform(begins, lambda i: F.transform(F.filter(F.array(*map(F.lit, counts)), lambda k: fits(i, k)), lambda k: run(i, k))))
    text = text.withColumn("runs", F.when(F.size("ps") > 0, runs).otherwise(none("struct<no:bigint,part:string>")))
    parts = text.select("id", F.size("paragraphs").alias("np"), (F.size("paragraphs") + F.size("lines")).alias("nl"), F.col("runs.no").alias("nos"), F.posexplode(F.concat(F.array("t"), "paragraphs", "lines", F.col("runs.part"))).alias("at", "part"))
    at, np, nl = F.col("at"), F.col("np"), F.col("nl")
    unit = F.when(at == 0, "document").when(at <= np, "paragraph").when(at <= nl, "line").otherwise("paragraphs")
    unit_no = F.when(at == 0, 0).when(at <= np, at - 1).when(at <= nl, at - 1 - np).otherwise(F.get("nos", at - 1 - nl))
    found = parts.select(F.col("id").alias(id_col), unit.alias("unit"), unit_no.cast("long").alias("unit_no"), md5(F.when(at <= nl, flat(F.col("part"))).otherwise(F.col("part"))).alias("digest"))
    return found.join(F.broadcast(known), "digest").select(id_col, "unit", "unit_no", "digest", "license")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    known = ", ".join(f"('{d}', '{n}')" for d, n in registry())
    text = f"regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'), '{_COPYRIGHT}', chr(10), 'g')"
    for a, b in SPELLINGS:
        text = f"replace({text}, '{a}', '{b}')"
    text = f"regexp_replace({text}, '{_PUNCT}', ' ', 'g')"
    part = lambda unit, parts: f"SELECT doc_id, '{unit}' AS unit, unnest({parts}) AS part, generate_subscripts({parts}, 1) - 1 AS unit_no FROM t"
    firsts, counts = _runs()
    flat = lambda c: f"trim(regexp_replace({c}, '[ \\n]+', ' ', 'g'))"
    return f"""
WITH known(digest, license) AS (VALUES {known}),
t AS (SELECT doc_id, {text} AS t FROM documents),
u AS ({part("document", "[t]")} UNION ALL {part("paragraph", "regexp_split_to_array(t, chr(10) || ' *' || chr(10))")} WHERE contains(t, chr(10))
  UNION ALL {part("line", "string_split(t, chr(10))")} WHERE contains(t, chr(10))),
p AS (SELECT doc_id, list_transform(regexp_split_to_array(t, chr(10) || ' *' || chr(10)), lambda x: {flat("x")}) AS ps FROM t WHERE contains(t, chr(10))),
r AS (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p),
d AS (SELECT doc_id, unit, CAST(unit_no AS BIGINT) AS unit_no, md5({flat("part")}) AS digest FROM u
  UNION ALL SELECT doc_id, 'paragraphs', CAST(i - 1 AS BIGINT), md5(array_to_string(ps[i:i + k - 1], ' ')) FROM r, (SELECT unnest({counts}) AS k)
  WHERE i + k - 1 <= len(ps) AND NOT (i = 1 AND k = len(ps)) AND md5(ps[i]) IN ({", ".join(f"'{f}'" for f in firsts)}))
SELECT doc_id, unit, unit_no, digest, license FROM d JOIN known USING (digest)
"""


OP5_SQL = _sql()
