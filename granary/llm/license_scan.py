"""License scans by MinHash bands over overlapping windows, in DataFrame functions alone.

A template of n words is looked for in windows of n + s words, one every s words, so that some window holds
any copy of it whole. A window and a template that share a band's MinHash are a candidate; the number of
bands makes that nearly certain for every window that holds enough of the template. Candidates are
verified by the exact share of the template's shingles that the window holds.

A filter precedes that cannot lose a match: a text must contain one of the words without which no match is possible.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, CONTAINMENT, MISS = 5, 0.8, 1e-4
#: Templates of more characters are not broadcast.
TEMPLATE_CHARACTERS = 1 << 20
#: Short notices in common use.
TEMPLATES = {
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-no-endorsement": "may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
#: Whole licenses. Longer ones are loaded by templates_of().
TEXTS = {
    "bsd-2-clause-text": f"{BSD_START} {BSD_END}",
    "bsd-3-clause-text": f"{BSD_START} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {BSD_END}",
    "isc-text": TEMPLATES["isc-grant"] + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "mit-text": TEMPLATES["mit-grant"] + ', and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


def templates_of(spark: SparkSession, path: str) -> dict[str, str]:
    """Templates from a folder of whole license texts, by their files' names without suffix. The folder's size is the parameter's."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[A-Za-z]+)?$", 1).alias("name"), "value")
    found = {r["name"]: r["value"] for r in files.collect()}
    return {name: body for name, body in found.items() if re.search(r"[^\W_]", body)}


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column, size: Column) -> Column:
    """The hash of each run of `size` words, in order."""
    n = F.size(words) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.array_join(F.slice(words, i, size), " ")))).otherwise(F.array().cast("array<bigint>"))


def bands(hashes: Column, n: Column) -> Column:
    """The MinHash of a set of shingle hashes in each of n bands of one row."""
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, i))))


def shape(text: str) -> dict[str, int]:
    """How a template is looked for. Bands: 1 - (1 - J) ** bands >= 1 - MISS for the least Jaccard
    similarity J of the template and a window that holds CONTAINMENT of its shingles."""
    n = len([w for w in re.split(r"[\W_]+", text.lower()) if w])
    k = min(SHINGLE, n)
    m, step = n - k + 1, max(1, n // 4)
    low = math.ceil(CONTAINMENT * m)
    j = low / (m + (m + step) - low)
    return {"k": k, "m": m, "step": step, "n_bands": math.ceil(math.log(MISS) / math.log(1 - j)) if j < 1 else 1}


def needed_words(text: str) -> set[str]:
    """Words of which any text that holds CONTAINMENT of the shingles must contain one."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    k = min(SHINGLE, len(words))
    grams = [set(words[i : i + k]) for i in range(len(words) - k + 1)]
    out: set[str] = set()
    while sum(bool(g & out) for g in grams) <= (1 - CONTAINMENT) * len(grams):
        rest = [g for g in grams if not g & out]
        out.add(max(sorted({w for g in rest for w in g}), key=lambda w: (w in ("license", "licensed", "rights"), len(w), sum(w in g for g in rest))))
    return out


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """One row per template: its shape, shingles and bands. Its size is the parameter's."""
    rows = [F.struct(F.lit(name).alias("license"), F.lit(text).alias("text"), *[F.lit(v).alias(k) for k, v in shape(text).items()]) for name, text in sorted(templates.items())]
    t = spark.range(1).select(F.inline(F.array(*rows)))
    t = t.withColumn("own", F.array_distinct(shingles(tokens(F.col("text")), F.col("k"))))
    return t.withColumn("bands", bands(F.col("own"), F.col("n_bands"))).drop("text")


def scan_licenses(df: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, license, containment, first_word, n_matches of each template that a row's whole text holds: the best
    window's containment, the first word (from 0) of the first such window, and how many windows match.

    Null and empty texts hold none; null ids give rows like others; rows that are equal in id and text give a
    row each; an empty table gives an empty one. Other columns are not read.
    """
    templates = TEMPLATES | TEXTS if templates is None else templates
    spark = df.sparkSession
    known = template_table(spark, templates)
    least = sorted(set().union(*map(needed_words, templates.values())))
    low = F.lower(F.col("text"))
    may = F.lit(False)
    for w in [w for w in least if not any(o != w and o in w for o in least)]:  # a word that holds another is implied by it
        may = may | low.contains(w)
    sizes = sorted({shape(x)["k"] for x in templates.values()})
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(may)
    docs = docs.select("id", F.xxhash64("text").alias("of"), tokens(F.col("text")).alias("words"))
    docs = docs.select("id", "of", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), shingles(F.col("words"), F.lit(k)).alias("hashes")) for k in sizes])).alias("x")).select("id", "of", "x.k", "x.hashes")

    n_bands = {k: max(shape(x)["n_bands"] for x in templates.values() if shape(x)["k"] == k) for k in sizes}
    most = functools.reduce(lambda c, k: F.when(F.col("k") == k, F.lit(n_bands[k])).otherwise(c), sizes, F.lit(1))
    small = F.broadcast if sum(len(x) for x in templates.values()) <= TEMPLATE_CHARACTERS else (lambda t: t)
    one = docs.dropDuplicates(["id", "of", "k"])
    banded = one.where(F.size("hashes") > 0).withColumn("band", F.explode(F.sequence(F.lit(0), most - 1)))
    banded = banded.select("id", "of", "k", "band", F.transform("hashes", lambda h: F.xxhash64(h, F.col("band") + 1)).alias("values"))
    sought = small(known.select("license", "k", "m", "step", F.posexplode("bands").alias("band", "value")))
    met = banded.join(sought, ["k", "band"]).where(F.array_contains("values", F.col("value")))  # no window's MinHash is what the text has not
    starts = F.sequence(F.lit(0), F.expr("(size(values) - 1) div step").cast("int"))
    windows = F.filter(starts, lambda w: F.array_min(F.slice("values", w * F.col("step") + 1, F.col("m") + F.col("step"))) == F.col("value"))
    found = met.select("id", "of", "k", "license", F.explode(windows).alias("w")).distinct()
    found = found.groupBy("id", "of", "k").agg(F.collect_set(F.struct("license", "w")).alias("windows"))  # of one text
    joined = one.alias("d").join(found.alias("v"), F.col("d.id").eqNullSafe(F.col("v.id")) & (F.col("d.of") == F.col("v.of")) & (F.col("d.k") == F.col("v.k")))
    cut = joined.select("d.id", "d.of", "d.hashes", F.explode("v.windows").alias("x")).select("id", "of", "hashes", "x.license", "x.w")
    candidates = cut.join(small(known.select("license", "m", "step")), "license").select("id", "of", "license", "w", "step", F.slice("hashes", F.col("w") * F.col("step") + 1, F.col("m") + F.col("step")).alias("part"))
    verified = candidates.join(small(known.select("license", "own")), "license").withColumn("containment", F.size(F.array_intersect("own", "part")) / F.size("own")).where(F.col("containment") >= CONTAINMENT)
    found = verified.groupBy("id", "of", "license").agg(F.max("containment").alias("containment"), F.min(F.col("w") * F.col("step")).cast("long").alias("first_word"), F.count("*").alias("n_matches"))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(may).select("id", F.xxhash64("text").alias("of")).groupBy("id", "of").count()
    out = found.alias("f").join(rows.alias("r"), F.col("f.id").eqNullSafe(F.col("r.id")) & (F.col("f.of") == F.col("r.of")))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("r.count").cast("int")))).select(F.col("f.id").alias(id_col), "license", "containment", "first_word", "n_matches")
