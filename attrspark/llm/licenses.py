"""Licence notices in documents, by MinHash bands over overlapping windows of words.

DataFrame functions only. A text becomes the sequence of its shingle hashes (five words,
lower case, letters and digits). Templates are put into classes of similar length; for a
class whose shortest template has W shingles the windows are all runs of W shingles, one
starting at every word. Minima and maxima of the hashes under two exclusive-or masks give
four bands of one row. Minima of all windows come from doubling: the minimum over 2k
shingles is the smaller of two over k, so a window costs a logarithmic number of steps.

A class takes templates with at most 4/3 of W shingles. Around a template that a text
contains there is thus a window made of its own shingles alone, with a Jaccard similarity
of at least 3/4: one window shares a band with probability at least 1 - (1/4)^4 > 0.996,
and 1 for templates of W shingles. With a fifth of its shingles missing it is still at
least 0.9. What the bands retrieve is checked exactly: the share of the template's
shingles in the text around the window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
LEAST_SHARE = 0.8
#: Templates up to this many are taken into the plan as constants; more are joined.
MOST_CONSTANTS = 5_000
_MASKS = [0, 0x5BE0CD19137E2179]

# Public notice texts by SPDX identifier.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("GPL-2.0", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-2.1", "the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]


def notices(spark: SparkSession) -> DataFrame:
    """The built-in templates: license, text."""
    return spark.createDataFrame(NOTICES, "license string, text string")


@dataclass(frozen=True)
class Lengths:
    """A class of template lengths, in shingles; its windows have the smallest."""

    least: int
    most: int


def classes_of(lengths: set[int]) -> list[Lengths]:
    """Classes from the longest down; each takes lengths of at least 3/4 of its longest."""
    out = []
    left = sorted(lengths, reverse=True)
    while left:
        taken = [n for n in left if 4 * n >= 3 * left[0]]
        out.append(Lengths(taken[-1], taken[0]))
        left = left[len(taken) :]
    return out


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column behind a generator, so that its many uses share one evaluation."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def shifted(array: Column, by: int) -> Column:
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def under(hashes: str, mask: int) -> Column:
    """The hashes in another order: exclusive-or with a mask."""
    return F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask))) if mask else F.col(hashes)


def with_shingles(df: DataFrame) -> DataFrame:
    """Add `_shingles`: the hashes of all runs of five words; of the whole text if shorter."""
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    df = once(df, "_words", words)
    n = F.size("_words")
    names = [f"w{i}" for i in range(SHINGLE)]
    runs = F.arrays_zip(*(F.slice("_words", i + 1, n - (SHINGLE - 1)).alias(w) for i, w in enumerate(names)))
    runs = F.transform(runs, lambda run: F.xxhash64(*(run[w] for w in names)))
    hashes = F.when(n >= SHINGLE, runs).when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", "_words")))).otherwise(F.array().cast("array<bigint>"))
    return once(df, "_shingles", hashes).drop("_words")


def with_bands(df: DataFrame, widths: list[int]) -> tuple[DataFrame, dict[tuple[int, int], str]]:
    """Add, per width and band, the values of all windows in order; returns their columns.

    Windows at the end of a text are shorter.
    """
    columns: dict[tuple[int, int], str] = {}
    steps = [1]
    while steps[-1] * 2 <= max(widths, default=1):
        steps.append(steps[-1] * 2)
    for m, mask in enumerate(_MASKS):
        df = once(df, f"_m{m}_1", under("_shingles", mask))
        for f, pick in enumerate((lambda x, y: F.least(x, y), lambda x, y: F.greatest(x, y))):
            level = {1: f"_m{m}_1"}
            for k in steps[:-1]:
                level[2 * k] = f"_m{m}_{f}_{2 * k}"
                df = once(df, level[2 * k], F.zip_with(level[k], shifted(F.col(level[k]), k), pick))
            for width in widths:
                k = max(s for s in steps if s <= width)
                name = level[k]
                if k < width:
                    name = f"_w{m}_{f}_{width}"
                    df = once(df, name, F.zip_with(level[k], shifted(F.col(level[k]), width - k), pick))
                columns[width, 2 * m + f] = name
    return df, columns


def license_matches(docs: DataFrame, templates: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """Licence templates contained in `docs(doc_id, text)`.

    One row per doc_id and template: license, template (its text's hash), share (the
    largest share of its shingles found), first_word (where a window that retrieved it
    first starts) and n_windows. Templates come as `templates(license, text)`; of fewer
    than five words the whole sequence is one shingle, which only a text of just these
    words has.

    Null, empty and short texts are handled as empty or one-shingle sequences; templates
    without words match nothing. Null doc_id is kept as null; repeated documents give one
    row with the windows of all of them. Other columns are ignored. No matches: no rows.
    """
    named = templates.where(F.col("text").isNotNull()).select("license", "text", F.xxhash64("text").alias("template"))
    shaped = with_shingles(named.distinct()).where(F.size("_shingles") > 0)
    shaped = shaped.select("license", "template", F.size("_shingles").alias("length"), "_shingles")
    sizes = classes_of({r.length for r in shaped.select("length").distinct().collect()})
    if not sizes:
        schema = "doc_id long, license string, template long, share double, first_word int, n_windows long"
        return docs.sparkSession.createDataFrame([], schema)
    masked = [under("_shingles", mask) for mask in _MASKS]
    least = F.coalesce(*(F.when(F.col("length").between(c.least, c.most), c.least) for c in sizes))
    shaped = shaped.select(
        "license",
        "template",
        F.array_distinct("_shingles").alias("wanted"),
        least.alias("width"),
        F.array(*(f(m) for m in masked for f in (F.array_min, F.array_max))).alias("bands"),
    )
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = with_shingles(narrow).drop("text").where(F.size("_shingles") > 0)
    few = shaped.limit(MOST_CONSTANTS + 1).count() <= MOST_CONSTANTS
    listed = shaped.select("width", "bands").collect() if few else []
    if few:
        # A window's band value is the hash of one of its shingles under the band's mask, so
        # only texts with such a shingle can have a window that retrieves a template.
        able = {value ^ _MASKS[band // 2] for r in listed for band, value in enumerate(r.bands)}
        found = found.where(F.arrays_overlap("_shingles", F.array(*map(F.lit, sorted(able)))))
    found, columns = with_bands(found, [c.least for c in sizes])
    constants: dict[tuple[int, int], Column] = {}
    if few:  # a text goes on only if some band of some class retrieves a template
        for width, band in columns:
            values = sorted({r.bands[band] for r in listed if r.width == width})
            constants[width, band] = F.array(*map(F.lit, values)).cast("array<bigint>")
        met = F.lit(False)
        for at, name in columns.items():
            met = met | F.arrays_overlap(name, constants[at])
        found = found.where(met)
    hits = []
    for (width, band), name in columns.items():
        spots = F.transform(name, lambda v, i: F.struct(F.lit(width).alias("width"), F.lit(band).alias("band"), i.alias("at"), v.alias("value")))
        hits.append(F.filter(spots, lambda s: F.array_contains(constants[width, band], s["value"])) if few else spots)
    spots = found.select("doc_id", "_shingles", F.explode(F.concat(*hits)).alias("spot")).select("doc_id", "_shingles", "spot.*")
    keys = shaped.select("license", "template", "wanted", "width", F.posexplode("bands").alias("band", "value"))
    pairs = spots.join(F.broadcast(keys) if few else keys, ["width", "band", "value"])
    begin = F.greatest(F.col("at") + 1 - F.size("wanted"), F.lit(0))
    around = F.slice("_shingles", begin + 1, F.size("wanted") * 2 + F.col("width"))
    share = F.size(F.array_intersect(around, F.col("wanted"))) / F.size("wanted")
    pairs = pairs.select("doc_id", "license", "template", "at", share.alias("share")).where(F.col("share") >= least_share)
    return pairs.groupBy("doc_id", "license", "template").agg(
        F.max("share").alias("share"), (F.min("at") + 1).alias("first_word"), F.count_distinct("at").alias("n_windows")
    )
