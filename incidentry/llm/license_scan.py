"""License statements found by MinHash bands over text windows, in DataFrame functions only.

For a template of m shingles, a text is cut into windows of 2m shingles that
overlap by half, so that any run of m + 1 shingles lies within a window, and any
run of 2m within two neighbours. Each band is one minimum hash: a window that
holds 0.4 of the template has a Jaccard similarity of 0.4 / 2.6 or more with it, and
the two neighbours that hold 0.8 together miss all 48 bands with a probability below
1e-6. Around the windows that share a band with a template, every run of 2m shingles
that begins with one of the template's is verified by the exact share that it
contains, so what is found does not depend on where windows begin. Windows
without any shingle of a template have no band in common with one, so they are left out beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5
BANDS = 48
PERCENT = 80
SMALL_SHINGLES = 50_000  # of all templates; up to these the templates are broadcast, beyond Spark decides

# Short statements by which texts name their license.
STATEMENTS = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Use of this source code is governed by a BSD 2-Clause license.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

# License texts and the notices that files carry, without titles and names.
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_FREE_SOFTWARE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {license} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
    "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {license} for more details. You should have received a "
    "copy of the {license} along with this program. If not, see <https://www.gnu.org/licenses/>."
)
PASSAGES = {
    "AGPL-3.0-or-later-notice": _FREE_SOFTWARE.format(license="GNU Affero General Public License", version="3"),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.",
    "BSD-2-Clause-text": _REDISTRIBUTION + _BSD_WARRANTY,
    "BSD-3-Clause-text": _REDISTRIBUTION + _ENDORSEMENT + _BSD_WARRANTY,
    "CC0-1.0-notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and "
    "neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty. "
    "You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see "
    "<http://creativecommons.org/publicdomain/zero/1.0/>.",
    "GPL-2.0-or-later-notice": _FREE_SOFTWARE.format(license="GNU General Public License", version="2"),
    "GPL-3.0-or-later-notice": _FREE_SOFTWARE.format(license="GNU General Public License", version="3"),
    "ISC-text": STATEMENTS["ISC"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
    "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
    "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-3.0-or-later-notice": _FREE_SOFTWARE.format(license="GNU Lesser General Public License", version="3"),
    "MIT-text": STATEMENTS["MIT-notice"] + ", including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to "
    "do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in "
    "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
    "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
    "author or authors of this software dedicate any and all copyright interest in the software to the public domain. We "
    "make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend "
    "this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
    "under copyright law.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
    "be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
    "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
    "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
    "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
    "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
    "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
    "distribution.",
}
KNOWN = STATEMENTS | PASSAGES


def statements(spark: SparkSession) -> DataFrame:
    """Short statements, notices and license texts."""
    return spark.createDataFrame(sorted(KNOWN.items()), "license string, text string")


def _shingles(df: DataFrame, text: Column) -> DataFrame:
    """Append ``shingles``, hashes of all runs of five words (fewer words have none), and the row's number.

    The number also keeps Spark from moving later filters below this step, which
    would cut the text anew for each shingle.
    """
    n = F.size("hashes")
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    runs = F.transform(
        F.sequence(F.lit(0), n - WORDS),
        lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WORDS)]),
    )
    return (
        df.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w)))
        .withColumns(
            {
                "shingles": F.when(n >= WORDS, runs).otherwise(F.array().cast("array<bigint>")),
                "row": F.monotonically_increasing_id(),
            }
        )
        .drop("hashes")
    )


def _bands(shingles: Column) -> Column:
    """The least hash of the shingles under each band's hash function."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(BANDS)),
        lambda band: F.struct(
            band.alias("band"), F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, band))).alias("least")
        ),
    )


def scan_licenses(
    docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row (id, license, n_shared, n_shingles, first_word) per document and license found in it.

    ``templates`` (license, text) is a short list: its shingles are read into the
    plan. A license is found where any run of twice its shingles holds 80 of 100
    of its distinct ones. n_shared is the most that a run holds, and first_word
    the number of the first word of the earliest run that holds so many and begins with a
    shingle of the license. Templates of fewer than five words are never found, null and
    empty texts hold nothing, texts of any length are read whole, an empty table of either kind gives no row. Each row is a document of its own, also
    where ids are null or repeated.
    """
    known = _shingles(templates.select("license", "text"), F.coalesce("text", F.lit(""))).select(
        "license", F.array_distinct("shingles").alias("template")
    ).where(F.size("template") > 0).withColumn("m", F.size("template"))
    listed = known.select("license", "template", "m").collect()
    if not listed:
        return docs.select(F.col(id_col).alias("id")).limit(0).selectExpr(
            "id", "'' AS license", "0L AS n_shared", "0L AS n_shingles", "0L AS first_word"
        )
    hashes = sorted({s for row in listed for s in row["template"]})
    of_size: dict[int, set] = {}
    for row in listed:
        of_size.setdefault(row["m"], set()).update(row["template"])
    numbered = _shingles(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), F.col("text")
    )
    places = F.filter(F.transform("shingles", lambda s, i: F.when(s.isin(hashes), i)), lambda i: i.isNotNull())

    def own_places(m: int) -> Column:
        return F.filter("places", lambda i: F.get("shingles", i).isin(sorted(of_size[m])))

    windows = (
        numbered.select("row", "id", "shingles", places.alias("places"))
        .where(F.size("places") > 0)
        .select("row", "id", "shingles", F.inline(F.array(*[
            F.struct(F.lit(m).alias("m"), own_places(m).alias("hits")) for m in sorted(of_size)
        ])))
        .withColumn(
            "window",
            F.explode(
                F.array_distinct(
                    F.flatten(
                        F.transform("hits", lambda i: F.array(F.floor(i / F.col("m")), F.floor(i / F.col("m")) - 1))
                    )
                )
            ),
        )
        .where("window >= 0")
        # the window and m shingles on both sides
        .withColumn("start", (F.greatest(F.col("window") - 1, F.lit(0)) * F.col("m")).cast("int"))
        .select(
            "row", "id", "m", "window", "start",
            F.slice("shingles", F.col("start") + 1, ((F.col("window") + 3) * F.col("m") - F.col("start")).cast("int"))
            .alias("span"),
        )
    )
    content = F.array_distinct(
        F.slice("span", (F.col("window") * F.col("m") - F.col("start") + 1).cast("int"), 2 * F.col("m"))
    )
    signed = known.select("license", "template", "m", F.inline(_bands(F.col("template")))).collect()
    signed = docs.sparkSession.createDataFrame(
        signed, "license string, template array<bigint>, m int, band int, least bigint"
    )
    if sum(row["m"] for row in listed) <= SMALL_SHINGLES:  # some 16 MB with the bands
        signed = F.broadcast(signed)
    found = windows.withColumn("b", F.explode(_bands(content))).select(
        "row", "id", "m", "window", "start", "span", "b.band", "b.least"
    ).join(signed, ["m", "band", "least"])

    def enough(shared: Column) -> Column:
        return shared * 100 >= F.col("m") * PERCENT

    def shared(part: Column) -> Column:
        return F.size(F.array_intersect(part, "template")).cast("bigint")

    runs = F.filter(
        F.transform(
            "span",
            lambda s, i: F.when(
                F.array_contains("template", s),
                F.struct(
                    shared(F.slice("span", i + 1, 2 * F.col("m"))).alias("n_shared"),
                    (-(F.col("start") + i)).cast("bigint").alias("back"),  # the earliest is the largest
                ),
            ),
        ),
        lambda run: enough(run["n_shared"]),
    )
    return (
        found.where(enough(shared(F.col("span"))))
        .withColumn("best", F.array_max(runs))
        .where("best IS NOT NULL")
        .groupBy("row", "id", "license")
        .agg(F.max("best").alias("best"), F.max("m").cast("bigint").alias("n_shingles"))
        .select(
            "id", "license", F.col("best.n_shared").alias("n_shared"), "n_shingles", (-F.col("best.back")).alias("first_word")
        )
    )
