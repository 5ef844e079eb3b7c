"""Licence scan: texts compared with licence templates by the Dice coefficient over word bigrams.

Every line of a document, and the whole document, is normalised to lower-case letters and digits and
compared as a multiset of word bigrams. A template of b bigrams can reach a coefficient t only with texts
of t / (2 - t) * b to (2 - t) / t * b bigrams, so most texts meet few templates or none. Only DataFrame
functions are used. The bigrams of the templates, a fixed table, are the only thing sent to all tasks.

With `windows`, notices that are wrapped over lines or stand inside a longer line are found too: every stretch of
the document's words, across line breaks, that begins and ends with a bigram of the template is compared. No other
stretch has a higher coefficient than these, lines and whole documents included, so the best coefficient is that of the best
stretch. Only templates that a line or the document equals (coefficient 1) need no search.
A notice that holds another template, as the Apache notice does, then reports both.

Defined cases: null texts, and texts of fewer than two words, match nothing. A text that matches several
templates reports each; of equal coefficients the template first in the alphabet is the best. Rows with
equal ids are reported each. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertloom.operators.once import computed_once
from alertloom.session import settled, stored

# The least coefficient, in percent.
PERCENT = 85

# Public licence texts and notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."
    ),
    "BSD-3-Clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "CC-BY-NC-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "GPL-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public "
        "License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, "
        "Fifth Floor, Boston, MA 02110-1301 USA."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1 notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF '
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
        "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "Zlib text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def bigrams_of(text: str) -> Counter:
    words = words_of(text)
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def _normalised(text: Column) -> Column:
    """The words of a text; an array with one empty string if there are none."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def size_bounds(size: int, percent: int = PERCENT) -> tuple[int, int]:
    """The fewest and most bigrams of a text that can reach the coefficient with a template."""
    t = Fraction(percent, 100)
    low, high = t / (2 - t) * size, (2 - t) / t * size
    return -(-low.numerator // low.denominator), high.numerator // high.denominator


def telling_words(templates: dict[str, str], percent: int) -> list[str]:
    """Words of which each text that reaches the coefficient with a template has at least one.

    A text lacks at most `size - low` bigrams of a template, so words that touch more than those are enough.
    Words in few templates, and long ones, are taken first.
    """
    common = Counter(w for text in templates.values() for w in set(words_of(text)))
    out: set[str] = set()
    for text in templates.values():
        grams = bigrams_of(text)
        size = sum(grams.values())
        mine: set[str] = set()
        for word in sorted(set(words_of(text)), key=lambda w: (common[w], -len(w), w)):
            touched = sum(n for g, n in grams.items() if mine & set(g.split()))
            if touched > size - size_bounds(size, percent)[0]:
                break
            mine.add(word)
        out |= mine
    return sorted(out)


def template_bigrams(spark: SparkSession, templates: dict[str, str], percent: int) -> DataFrame:
    rows = []
    for name, text in templates.items():
        grams = bigrams_of(text)
        size = sum(grams.values())
        rows += [(name, g, n, size, *size_bounds(size, percent)) for g, n in grams.items()]
    return spark.createDataFrame(rows, "license string, bigram string, there int, size int, low int, high int")


def best_windows(met: DataFrame, most: list[int], percent: int) -> DataFrame:
    """Per row and license with a stretch of words that reaches the coefficient: the highest one.

    `met` has the places of the template's bigrams in each document, `most` how often templates have one. All places of one document and template
    are put into one array, which is never longer than the document.
    """
    order = Window.partitionBy("row", "license", "bigram").orderBy("place")
    # A bigram counts as often as the template has it: not if that many lie between it and the stretch's begin.
    back = F.coalesce(*[F.when(F.col("there") == k, F.lag("place", k).over(order)) for k in most], F.lit(-1))
    placed = met.repartition("row", "license").withColumn("back", back)
    listed = placed.groupBy("row", "license", "size", "low", "high").agg(F.collect_list(F.struct("place", "back")).alias("all"))
    listed = computed_once(listed.where(F.size("all") >= F.greatest("low", F.lit(1))), "at", F.array_sort("all")).drop("all")
    at, low = F.col("at"), F.greatest("low", F.lit(1))
    dense = F.filter(F.sequence(F.lit(0), F.size(at) - low), lambda i: at[i + low - 1]["place"] - at[i]["place"] < F.col("high"))

    def best_from(i: Column) -> Column:
        begin = at[i]["place"]

        def longer(so_far: Column, hit: Column) -> Column:
            both = so_far["both"] + F.when(hit["back"] < begin, 1).otherwise(0)
            total = hit["place"] - begin + 1 + F.col("size")
            dice = F.when(200 * both >= percent * total, 2 * both / total).otherwise(0.0)
            return F.struct(both.alias("both"), F.greatest(so_far["dice"], dice).alias("dice"))

        start = F.struct(F.lit(0).alias("both"), F.lit(0.0).alias("dice"))
        return F.aggregate(F.slice(at, i + 1, F.col("high")), start, longer, lambda x: x["dice"])

    return listed.select("row", "license", F.array_max(F.transform(dense, best_from)).alias("dice")).where("dice > 0")


def find_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT, windows: bool = False
) -> DataFrame:
    """Per document: doc_id, n_licenses, licenses (names, comma-joined), best_license, best_dice (6 places).

    What is not read from plain files is written once: rows are numbered and found again by number.
    """
    spark = docs.sparkSession
    docs = settled(docs.select("doc_id", "text"))
    bounds = sorted({size_bounds(sum(bigrams_of(t).values()), percent) for t in templates.values()})
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    whole_and_lines = F.concat(F.array("text"), F.split("text", "\n"))
    units = numbered.where("text is not null").select("row", F.posexplode(whole_and_lines).alias("unit", "part"))
    # Computed once: the bigrams below take the words apart one by one.
    words = computed_once(units, "words", _normalised(F.col("part"))).drop("part")
    n = F.size("words") - 1
    near = F.lit(False)
    for low, high in bounds:
        near = near | n.between(max(low, 1), high)
    fits = F.col("n").between(F.col("low"), F.col("high"))
    if windows:
        telling = F.array(*[F.lit(w) for w in telling_words(templates, percent)])
        near = near | ((F.col("unit") == 0) & (n >= 1) & F.arrays_overlap("words", telling))
    sized = words.where(near).withColumn("n", n)
    pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.concat_ws(" ", F.col("words")[i], F.col("words")[i + 1]))
    grams = sized.select("row", "unit", "n", F.posexplode(pairs).alias("place", "bigram"))
    known = F.broadcast(template_bigrams(spark, templates, percent))
    met = grams.join(known, "bigram").where(fits | (F.col("unit") == 0) if windows else fits)
    if windows:
        # Read twice below; only bigrams of templates are written, not the texts.
        met = stored(met)
    here = met.where(fits).groupBy("row", "unit", "n", "license", "size", "there", "bigram").agg(F.count("*").alias("here"))
    both = here.groupBy("row", "unit", "n", "license", "size").agg(F.sum(F.least("here", "there")).alias("both"))
    total = F.col("n") + F.col("size")
    hits = both.where(200 * F.col("both") >= percent * total).groupBy("row", "license")
    dice = hits.agg(F.max(2 * F.col("both") / total).alias("dice"))
    if windows:
        dice = stored(dice)
        most = sorted({n for t in templates.values() for n in bigrams_of(t).values()})
        # Lines that reach the coefficient may lie in stretches with a higher one; nothing is above 1.
        others = met.where("unit = 0").join(dice.where("dice = 1").select("row", "license"), ["row", "license"], "left_anti")
        dice = dice.unionByName(best_windows(others, most, percent)).groupBy("row", "license").agg(F.max("dice").alias("dice"))
    listed = stored(
        dice.groupBy("row").agg(
            F.count("*").alias("n_licenses"),
            F.concat_ws(",", F.array_sort(F.collect_list("license"))).alias("licenses"),
            F.min_by("license", F.struct((-F.col("dice")).alias("d"), "license")).alias("best_license"),
            F.round(F.max("dice"), 6).alias("best_dice"),
        )
    )
    joined = numbered.select("row", "doc_id").join(listed, "row", "left").drop("row")
    return joined.withColumns(
        {"n_licenses": F.coalesce("n_licenses", F.lit(0).cast("long")), "licenses": F.coalesce("licenses", F.lit(""))}
    )
