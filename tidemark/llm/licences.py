"""Licence lookup: canonical digests of whole texts, or of whole lines, joined to digests of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table_within
from tidemark.session import keep

# Titles and wordings of licences and notices, by SPDX identifier.
KNOWN = (
    ("Apache-2.0", "", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "", "Released under the MIT License."),
    ("MIT", "", "Licensed under the MIT License."),
    ("MIT", "MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0-only", "", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "", "Licensed under CC0 1.0."),
    ("ISC", "ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Unlicense", "", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Unlicense", "The Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"),
    ("0BSD", "BSD Zero Clause License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "BSD 2-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Zlib", "zlib License", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0-or-later", "", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0-only", "", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License."),
    ("GPL-3.0-only", "", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License."),
    ("AGPL-3.0-or-later", "", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0-only", "", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License."),
    ("LGPL-2.1-or-later", "", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
)

# Equivalent spellings, applied in this order to lower-case text with single spaces.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("organisation", "organization"),
    ("sublicence", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("merchantibility", "merchantability"),
    ("noncommercial", "non commercial"),
    ("whilst", "while"),
    ("favour", "favor"),
)

# Patterns that Java and RE2 read alike: what a copyright line says up to its end, and a line that only reserves rights.
COPYRIGHT = r"(?m)(copyright|\(c\)|©)[ \t]+(\(c\)|©|[0-9]{4}|<year>|\[year\])[^\n]*$|^[^0-9a-z\n]*all rights reserved[^0-9a-z\n]*$"
NOT_WORD = r"[^0-9a-z]+"
NOT_WORD_OR_LINE = r"[^0-9a-z\n]+"


def _spelled(text: Column) -> Column:
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _noticeless(text: Column) -> Column:
    """Lower case (A-Z), copyright clauses dropped, ``&`` as ``and``."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.replace(F.regexp_replace(lower, COPYRIGHT, " "), F.lit("&"), F.lit(" and "))


def canonical(text: Column) -> Column:
    """Lower case (A-Z), copyright clauses dropped, ``&`` as ``and``, other signs as one space, spellings unified."""
    return _spelled(F.trim(F.regexp_replace(_noticeless(text), NOT_WORD, " ")))


def canonical_lines(text: Column) -> Column:
    """``canonical`` of each line, by replacements in the whole text."""
    whole = _spelled(F.regexp_replace(_noticeless(text), NOT_WORD_OR_LINE, " "))
    return F.transform(F.split(whole, "\n"), lambda line: F.trim(line))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, licence, length): one row for each canonical wording, with its title and without; the first name wins."""
    rows = [(2 * i + bare, name, text if bare else f"{title}\n{text}") for i, (name, title, text) in enumerate(known) for bare in (0, 1)]
    return digests_of(spark.createDataFrame(rows, "at int, licence string, wording string"))


def digests_of(wordings: DataFrame) -> DataFrame:
    """``known_digests`` of a table (at, licence, wording) of any size."""
    rows = wordings.select("at", "licence", canonical(F.col("wording")).alias("words"))
    rows = rows.select("at", "licence", F.sha2("words", 256).alias("digest"), F.length("words").alias("length"))
    return rows.groupBy("digest", "length").agg(F.min_by("licence", "at").alias("licence")).where("length > 0").select("digest", "licence", "length")


def scan(docs: DataFrame, digests: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_licence, line_licences, digest) for every row.

    ``text_licence`` names the licence that the whole text is; ``line_licences`` lists, sorted and without repeats, the
    licences that whole lines of it are. A null text counts as empty; texts without a letter or digit have the digest of
    the empty string and no licence. Repeated rows stay. ``digests`` is from ``known_digests`` or ``digests_of``; it is
    broadcast while its values take 64 MB at most. Lines as long as no wording are not digested: none could be one.
    """
    listed = keep(digests.select("digest", "licence", "length"), "licences")
    lengths = sorted(r.length for r in listed.select("length").distinct().collect())  # different lengths of wordings
    listed = table_within(listed, 64)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.sha2(body, 256).alias("key"), F.sha2(canonical(body), 256).alias("digest"))
    fitting = F.array_distinct(F.filter(canonical_lines(body), lambda line: F.length(line).isin(lengths)))
    lines = docs.select(body.alias("body"), fitting.alias("lines")).where(F.size("lines") > 0)
    lines = lines.select(F.sha2("body", 256).alias("key"), F.explode("lines").alias("line")).select("key", F.sha2("line", 256).alias("digest"))
    named = lines.join(listed, "digest").groupBy("key").agg(F.array_sort(F.collect_set("licence")).alias("line_licences"))
    found = rows.join(listed.select("digest", F.col("licence").alias("text_licence")), "digest", "left").join(named, "key", "left")
    return found.select("doc_id", "text_licence", F.coalesce("line_licences", F.array().cast("array<string>")).alias("line_licences"), "digest")
