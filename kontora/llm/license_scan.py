"""Licence scans: cosine of TF-IDF vectors to templates, then inheritance.

Every block of a text that speaks of a licence is compared with the templates
by the cosine of sparse TF-IDF vectors.  The templates are few and fixed, so
their weights are literals of the plan and a document never leaves its row.

Files without a licence of their own inherit from the nearest ancestor
directory that has a licence file.  Paths are joined by directory: what each
directory inherits is worked out on distinct directories, from their ancestors,
before the files look it up.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import PRIVATE, let

#: Words that mark a line as speaking of a licence.
CUE = r"(?i)licen[sc]|copyright|spdx|warrant|permission|redistribut|rights\s+reserved|public\s+domain|creative\s+commons|\bcc0\b"
#: Least cosine, and base name of licence files.
LEAST, LICENSE_FILE = 0.5, r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
#: Whole texts of public licences, by SPDX identifier.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
)
MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT "
    "OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
FULL = (
    ("MIT", "MIT License " + MIT_GRANT + MIT_WARRANTY),
    ("BSD-2-Clause", BSD_GRANT + BSD_WARRANTY),
    ("BSD-3-Clause", BSD_GRANT + BSD_NAMES + BSD_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
     "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
     "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
     "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
     "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
     "claim that you wrote the original software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any "
     "source distribution."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
     "for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
     "General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
     "binary, for any purpose, commercial or non-commercial, and by any means."),
)
#: Short notices, and the whole texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0, Creative Commons Attribution-NoDerivatives."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0, Creative Commons Attribution-NonCommercial-ShareAlike."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0, Creative Commons Attribution-NonCommercial-NoDerivatives."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    *FULL,
)
#: Titles by their words; those with a version may be followed by more of the block.
TITLES = (
    ("GPL-3.0", "gnu general public license version 3"), ("GPL-2.0", "gnu general public license version 2"), ("LGPL-3.0", "gnu lesser general public license version 3"),
    ("AGPL-3.0", "gnu affero general public license version 3"), ("Apache-2.0", "apache license version 2 0"), ("MPL-2.0", "mozilla public license version 2 0"),
    ("CC-BY-4.0", "creative commons attribution 4 0 international"), ("CC-BY-SA-4.0", "creative commons attribution sharealike 4 0 international"), ("CC-BY-NC-4.0", "creative commons attribution noncommercial 4 0 international"), ("CC0-1.0", "cc0 1 0 universal"),
    ("MIT", "mit license"), ("BSD-3-Clause", "bsd 3 clause license"), ("ISC", "isc license"), ("GPL", "gnu general public license"), ("LGPL", "gnu lesser general public license"), ("AGPL", "gnu affero general public license"),
)
#: Titles without a version and the reservation count where nothing else is found.
UNVERSIONED, RESERVED = ("GPL", "LGPL", "AGPL"), "LicenseRef-All-Rights-Reserved"
RESERVATION = r"(?i)\ball\s+rights\s+reserved\b"
#: One SPDX identifier, or an expression of them, as it is written.
SPDX = r"(?i:spdx-license-identifier)\s*:[\x20\t(]*([A-Za-z0-9][A-Za-z0-9.+-]*(?:[\x20\t()]+(?:AND|OR|WITH)[\x20\t()]+[A-Za-z0-9][A-Za-z0-9.+-]*)*)"
_WORD = re.compile(r"[a-z0-9]+")


def _weights() -> tuple[dict[str, float], list[dict[str, float]]]:
    """Inverse document frequencies over the templates, and their unit vectors."""
    texts = [Counter(_WORD.findall(t.lower())) for _, t in TEMPLATES]
    df = Counter(w for t in texts for w in t)
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in df.items()}
    out = []
    for t in texts:
        v = {w: n * idf[w] for w, n in t.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({w: x / norm for w, x in v.items()})
    return idf, out


IDF, VECTORS = _weights()
#: Weight of a word that no template has.
UNSEEN = math.log(1 + len(TEMPLATES)) + 1


def _literal_map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) if not isinstance(x, list) else F.array(*map(F.lit, x)) for kv in sorted(values.items()) for x in kv))


#: Words of the templates: their weight in a block, then in each template.
TABLE = {w: [x, *(v.get(w, 0.0) for v in VECTORS)] for w, x in IDF.items()}


def counted(tokens: Column) -> Column:
    """array<struct<w, n>> of sorted tokens, by the places where a run of equal ones
    begins: in as many steps as there are tokens, however many are distinct."""

    def body(t: Column) -> Column:
        place = F.sequence(F.lit(0), F.size(t) - 1)
        first = F.filter(place, lambda i: (i == 0) | (F.get(t, i) != F.get(t, i - 1)))
        runs = lambda f: F.transform(f, lambda i, k: F.struct(F.get(t, i).alias("w"), (F.coalesce(F.get(f, k + 1), F.size(t)) - i).cast("double").alias("n")))
        return let(first, runs)

    none = F.array().cast("array<struct<w:string,n:double>>")
    return let(F.array_sort(tokens), lambda t: F.when(F.size(t) > 0, body(t)).otherwise(none))


def block_scores(block: Column) -> Column:
    """array<double>: the block's cosine with each template.

    Words of no template only add to the length of the block's vector, so the few
    template words alone are looked up.
    """
    tokens = F.regexp_extract_all(F.lower(block), F.lit("[a-z0-9]+"), F.lit(0))
    table, words = _literal_map(TABLE), sorted(TABLE)

    def scored(tf: Column) -> Column:
        known = F.transform(F.filter(tf, lambda x: x["w"].isin(words)), lambda x: F.struct(x["n"].alias("n"), F.element_at(table, x["w"]).alias("v")))
        strange = F.aggregate(tf, F.lit(0.0), lambda s, x: s + F.when(x["w"].isin(words), 0.0).otherwise(x["n"] * x["n"] * UNSEEN * UNSEEN))

        def cosine(y: Column) -> Column:
            squares = F.aggregate(y["known"], y["strange"], lambda s, x: s + F.pow(x["n"] * F.get(x["v"], 0), F.lit(2.0)))
            dots = F.transform(F.sequence(F.lit(1), F.lit(len(VECTORS))), lambda j: F.aggregate(y["known"], F.lit(0.0), lambda s, x: s + x["n"] * F.get(x["v"], 0) * F.get(x["v"], j)))
            return let(F.sqrt(squares), lambda n: F.transform(dots, lambda d: F.when(n > 0, d / n).otherwise(0.0)))

        return let(F.struct(known.alias("known"), strange.alias("strange")), cosine)

    return let(counted(tokens), scored)


def spdx_license(block: Column) -> Column:
    """The identifier a block declares, under the name of its template if it has one; or null."""
    names = {n.lower(): n for n, _ in TEMPLATES}
    names |= {k + end: n for k, n in list(names.items()) if "gpl" in k for end in ("-only", "-or-later", "+")}
    known = F.create_map(*(F.lit(x) for kv in sorted(names.items()) for x in kv))
    return let(F.regexp_extract(block, SPDX, 1), lambda x: F.when(x != "", F.coalesce(F.try_element_at(known, F.lower(x)), x)))


def title_license(block: Column) -> Column:
    """The licence whose title a block is or begins with, or null."""
    words = F.array_join(F.regexp_extract_all(F.lower(block), F.lit("[a-z0-9]+"), F.lit(0)), " ")
    pattern = lambda t: f"^(?:the )?{t}" + ("(?: |$)" if re.search("[0-9]( |$)", t) and "clause" not in t else "$")
    return let(words, lambda w: F.coalesce(*(F.when(w.rlike(pattern(t)), F.lit(n)) for n, t in TITLES)))


def own_license(text: Column) -> Column:
    """struct<score, license> of the best block of a whole text, or null.

    Blocks are the lines with a cue, the paragraphs with one, and the whole text,
    which a licence file may be.  A declared SPDX
    identifier or a title is certain (score 1); the rest goes by cosine.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(CUE))
    everything = F.array(whole)
    paragraphs = F.filter(F.split(whole, r"\n[\x20\t]*\n", -1), lambda x: x.rlike(CUE))
    names = F.array(*(F.lit(n) for n, _ in TEMPLATES))

    def entry(rank, score, license) -> Column:
        return F.struct(F.lit(rank).alias("rank") if isinstance(rank, int) else rank.alias("rank"), score.alias("score"), license.alias("license"))

    def judged(b: Column) -> Column:
        near = let(block_scores(b), lambda s: entry(2, F.array_max(s), F.element_at(names, F.array_position(s, F.array_max(s)).cast("int"))))
        sure = let(F.coalesce(spdx_license(b), title_license(b)), lambda n: F.when(n.isNotNull(), entry(F.when(n.isin(*UNVERSIONED), 1).otherwise(2), F.lit(1.0), n)))
        reserved = F.when(b.rlike(RESERVATION), entry(0, F.lit(1.0), F.lit(RESERVED)))
        return F.coalesce(sure, let(near, lambda x: F.when(x["score"] >= LEAST, x)), reserved)

    best = F.array_max(F.transform(F.array_distinct(F.concat(lines, paragraphs, everything)), judged))
    return F.when(whole.rlike(CUE), let(best, lambda x: F.when(x.isNotNull(), F.struct(x["score"].alias("score"), x["license"].alias("license")))))


def directory(path: Column) -> Column:
    """What precedes the last slash; the root is empty."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """A directory and those above it, with their depths; the root has depth 0."""

    def body(parts: Column) -> Column:
        depths = F.sequence(F.lit(1), F.size(parts))
        return F.concat(
            F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("up"))),
            F.transform(depths, lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("up"))),
        )

    root = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("up")))
    return F.when(path == "", root).otherwise(let(F.split(path, "/", -1), body))


def scan_licenses(docs: DataFrame, path: Column, text_col: str = "text") -> DataFrame:
    """``docs`` with ``path``, ``license``, ``score``, ``origin``, ``license_dir``.

    ``origin`` is ``own`` (found in the text), ``inherited`` (from the nearest
    ancestor directory with a licence file, ``license_dir``) or ``none``.  A
    directory with several licence files has the one of the best score, then of
    the least identifier.  Null paths are the root; null and empty texts have no
    licence of their own.  New columns replace input columns of the same name and
    repeated rows stay.  Whole texts are read, of any length, in steps that follow
    it; an empty table gives no rows.
    """
    made = ("path", "license", "score", "origin", "license_dir")
    own, place = PRIVATE + "own", PRIVATE + "dir"
    rest = [c for c in docs.columns if c not in made]
    base = docs.withColumn(PRIVATE + "path", F.coalesce(path, F.lit(""))).select(*(F.col(f"`{c}`") for c in rest), PRIVATE + "path")
    judged = base.withColumn(own, own_license(F.col(f"`{text_col}`"))).withColumn(place, directory(F.col(PRIVATE + "path")))
    files = judged.filter(F.col(PRIVATE + "path").rlike(LICENSE_FILE) & F.col(own).isNotNull())
    best = files.groupBy(F.col(place).alias("up")).agg(F.min(F.struct((-F.col(f"{own}.score")).alias("score"), F.col(f"{own}.license").alias("license"))).alias("x"))
    dirs = base.select(directory(F.col(PRIVATE + "path")).alias("dir")).distinct()
    above = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("a")).select("dir", "a.depth", "a.up")
    near = above.join(best, "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "x")).alias("n"))
    given = near.select("dir", F.col("n.up").alias("up"), (-F.col("n.x.score")).alias("up_score"), F.col("n.x.license").alias("up_license"))
    out = judged.join(given, F.col(place) == F.col("dir"), "left")
    has = F.col(own).isNotNull()
    return out.select(
        *(F.col(f"`{c}`") for c in rest),
        F.col(PRIVATE + "path").alias("path"),
        F.when(has, F.col(f"{own}.license")).otherwise(F.col("up_license")).alias("license"),
        F.when(has, F.col(f"{own}.score")).otherwise(F.col("up_score")).alias("score"),
        F.when(has, "own").when(F.col("up").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~has, F.col("up")).alias("license_dir"),
    )


def document_path(docs_id: Column, source: Column) -> Column:
    """A path for rows that have none: source, two levels of folders, a file.

    The first row of each folder of ids is its licence file.
    """
    name = F.when(docs_id % 50 == 0, F.concat(F.lit("LICENSE-"), docs_id.cast("string"))).otherwise(F.concat(docs_id.cast("string"), F.lit(".txt")))
    return F.concat_ws("/", F.coalesce(source, F.lit("unknown")), F.floor(docs_id / 10000).cast("string"), F.floor(docs_id / 100).cast("string"), name)


def op4_license_scans(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return scan_licenses(docs, document_path(F.col("doc_id"), F.col("source"))).drop("text", "source")
