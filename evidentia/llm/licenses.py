"""License scan: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies them.

Native: column expressions and joins with the (small) template tables.

Texts and templates are lower-cased runs of letters and digits, in shingles of
five words. Templates of up to C shingles (C a power of two, more than C / 2) are
looked up with windows of 2 C shingles at every C-th place, so a passage of
C shingles lies whole in one of them. A window that holds at least 0.8 of a
template's shingles has a Jaccard similarity of at least 0.19 with it, so one
of 64 bands of one MinHash value each agrees with a probability above
1 - 2e-6. A window without any shingle of any template agrees in no band; such
windows, and texts without any word of a set that meets every shingle, are left
out before MinHashes are computed. Each retrieved pair is
verified on the words: shared shingles / shingles of the template >= 0.8.
Where several templates match the same words, the best one can be kept alone.

Defined results: a null text counts as ''; texts and templates of fewer than five
words have no shingle and match nothing; repeated rows (same id and text) come
back once per template; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia.llm.common import id_text

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
#: Template bands (each with its template's shingles) to broadcast at most.
MOST_BANDS = 65536

_GNU = ("{it} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} General Public License "
        "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
_GNU_ONLY = ("{it} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} General Public License "
             "{version} as published by the Free Software Foundation.")
_NO_WARRANTY = ("{it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} General Public License for more details.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
          "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
          "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
         "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
         "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
         "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD3 = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
         "this software without specific prior written permission.")
#: Whole notices and standard file headers, beside the one-sentence notices.
_HEADERS = (
    *((f"{name}-{version}.0-or-later", _GNU.format(it=it, kind=kind, version=version).replace("  ", " "))
      for it, name, kind, versions in (("This program", "GPL", "", (2, 3)), ("This program", "AGPL", "Affero", (3,)), ("This library", "LGPL", "Lesser", (3,)))
      for version in versions),
    ("LGPL-2.1-or-later", _GNU.format(it="This library", kind="Lesser", version="2.1")),
    ("LGPL-2.0-or-later", _GNU.format(it="This library", kind="Library", version="2")),
    ("GPL-2.0-only", _GNU_ONLY.format(it="This program", kind="", version="version 2").replace("  ", " ")),
    ("GPL-3.0-only", _GNU_ONLY.format(it="This program", kind="", version="version 3").replace("  ", " ")),
    ("GPL", _NO_WARRANTY.format(it="This program", kind="").replace("  ", " ")),
    ("AGPL", _NO_WARRANTY.format(it="This program", kind="Affero")),
    ("LGPL", _NO_WARRANTY.format(it="This library", kind="Lesser")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with "
                   "this work for additional information regarding copyright ownership."),
    ("MIT", _MIT),
    ("MIT", _MIT + " " + _AS_IS),
    ("MIT", "This source code is licensed under the MIT license found in the LICENSE file in the root directory of this source tree."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("BSD-2-Clause", _BSD2),
    ("BSD-3-Clause", _BSD2 + _BSD3),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
                "http://www.boost.org/LICENSE_1_0.txt)"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely, subject to the following restrictions"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
                "https://www.eclipse.org/legal/epl-2.0"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

#: Common license notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *_HEADERS,
)


def words(text):
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _shingle_hashes(w):
    each = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[w[i + j] for j in range(SHINGLE)]))
    return F.when(F.size(w) >= SHINGLE, each).otherwise(F.expr("cast(array() as array<bigint>)"))


def _shingle_texts(w):
    each = F.transform(F.sequence(F.lit(1), F.size(w) - SHINGLE + 1), lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))
    return F.when(F.size(w) >= SHINGLE, F.array_distinct(each)).otherwise(F.expr("cast(array() as array<string>)"))


def _bands(hashes):
    """Array of (band, value): the MinHash of each band's function."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda b: F.struct(b.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))).alias("value")))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template_id, license, w (words), hashes, shingles, reach (the power of two C) of the templates
    with at least one shingle; ``templates``: (license, notice)."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    t = spark.createDataFrame(rows, "template_id int, license string, notice string").withColumn("w", words(F.col("notice")))
    t = t.withColumns({"hashes": _shingle_hashes(F.col("w")), "shingles": _shingle_texts(F.col("w"))}).filter(F.size("hashes") > 0)
    return t.withColumn("reach", F.expr("cast(power(2, ceil(log2(size(hashes)))) as int)")).drop("notice", "w")


def key_words(shingles: list[str]) -> list[str]:
    """A few words such that each shingle holds one of them (greedy; of equal cover, the longest word)."""
    open_, keys = [set(s.split()) for s in shingles], []
    while open_:
        n: dict[str, int] = {}
        for s in open_:
            for w in s:
                n[w] = n.get(w, 0) + 1
        keys.append(max(n, key=lambda w: (n[w], len(w), w)))
        open_ = [s for s in open_ if keys[-1] not in s]
    return keys


def _one_per_passage(found: DataFrame) -> DataFrame:
    """Of templates whose matches share half the matched shingles (of the smaller match), in one place of a text, the one with
    the greatest containment, then the most shared shingles, then the smallest id. ``found``: the verified
    windows. Matches are settled in islands, stretches of a text that no match crosses."""
    texts = F.transform(F.sequence(F.lit(1), F.size("w") - SHINGLE + 1), lambda i: F.array_join(F.slice("w", i, SHINGLE), " "))
    at = F.filter(F.transform(texts, lambda t, i: F.when(F.array_contains("shingles", t), F.col("start") + i)), lambda i: i.isNotNull())
    hits = found.dropDuplicates(["doc_id", "text_hash", "template_id", "start"]).withColumn("at", at)
    # the same passage in two windows is one match: its places are the same, or one window holds a part of it
    hits = hits.select("doc_id", "text_hash", "template_id", "license", "containment", "at", F.element_at("at", 1).alias("first"), F.element_at("at", -1).alias("last"))
    order = Window.partitionBy("doc_id", "text_hash").orderBy("first", "last", "template_id")
    hits = hits.withColumn("before", F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    hits = hits.withColumn("island", F.sum(F.when(F.col("first") <= F.col("before"), 0).otherwise(1)).over(order))
    match = F.struct((-F.col("containment")).alias("c"), (-F.size("at")).alias("n"), "template_id", "first", "license", "at")
    listed = hits.groupBy("doc_id", "text_hash", "island").agg(F.sort_array(F.collect_list(match)).alias("m"))

    def rival(x, y):
        return 2 * F.size(F.array_intersect(x["at"], y["at"])) >= F.least(F.size(x["at"]), F.size(y["at"]))

    kept = F.aggregate("m", F.slice("m", 1, 0), lambda kept, x: F.when(F.exists(kept, lambda y: rival(x, y)), kept).otherwise(F.concat(kept, F.array(x))))
    each = listed.select("doc_id", "text_hash", F.inline(kept))
    best = each.groupBy("doc_id", "text_hash", "template_id", "license").agg(
        (-F.min("c")).alias("containment"), F.min_by("first", F.struct("c", "first")).alias("start_word"), F.count(F.lit(1)).alias("n_passages"))
    return best.drop("text_hash")


def scan_licenses(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, id_col: str = "doc_id",
                  text_col: str = "text", one_per_passage: bool = False) -> DataFrame:
    """One row per document and template found: doc_id, template_id, license, containment (the
    best window's), start_word and n_windows (that match). Licences share much of their wording, so a passage may
    match several templates; with ``one_per_passage`` it counts for the best one only, start_word is its
    first shared shingle, and n_passages replaces n_windows."""
    spark = docs.sparkSession
    table = template_table(spark, templates)
    known = table.select("hashes", "shingles", "reach").collect()  # the parameter's own shingles
    shingles = sorted({h for r in known for h in r["hashes"]})
    rows, lower = id_text(docs, id_col, text_col), F.lower("text")
    # a text without any of these words has no shingle of a template
    some = F.lit(False)
    for word in key_words(sorted({x for r in known for x in r["shingles"]})):
        some = some | lower.contains(word)
    rows = rows.filter(some)
    d = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    d = d.withColumn("h", _shingle_hashes(F.col("w")))
    at = F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda i: F.col("h")[i].isin(shingles))
    d = d.withColumn("at", F.when(F.size("h") > 0, at).otherwise(F.expr("cast(array() as array<int>)")))

    def windows(reach: int):
        # window k covers the shingles k * reach ... k * reach + 2 * reach - 1
        mine = sorted({h for r in known if r["reach"] == reach for h in r["hashes"]})
        at = F.filter("at", lambda i: F.col("h")[i].isin(mine))
        k = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(F.floor(i / reach).cast("int") - 1, F.lit(0)), F.floor(i / reach).cast("int")))))
        return F.transform(k, lambda x: F.struct(F.lit(reach).alias("reach"), (x * reach).alias("start"),
                                                 F.slice("h", x * reach + 1, 2 * reach).alias("h"),
                                                 F.slice("w", x * reach + 1, 2 * reach + SHINGLE - 1).alias("w")))

    reaches = sorted({r["reach"] for r in known}) or [1]
    # a filter on the hits would move below the arrays and compute them anew for each of their elements
    d = d.select("doc_id", "text_hash", F.explode_outer(F.concat(*[windows(r) for r in reaches])).alias("window"))
    d = d.filter(F.col("window").isNotNull()).select("doc_id", "text_hash", "window.*")
    d = d.withColumn("b", F.explode(_bands(F.col("h")))).select("doc_id", "text_hash", "reach", "start", "w", "b.band", "b.value")
    t = table.withColumn("b", F.explode(_bands(F.col("hashes")))).select("template_id", "license", "shingles", "reach", "b.band", "b.value")
    # BANDS rows for each template of the parameter; beyond the bound Spark chooses the join
    found = d.join(F.broadcast(t) if len(templates) * BANDS <= MOST_BANDS else t, ["reach", "band", "value"])
    share = F.size(F.array_intersect(_shingle_texts(F.col("w")), "shingles")) / F.size("shingles")
    found = found.withColumn("containment", share).filter(F.col("containment") >= containment)
    if one_per_passage:
        return _one_per_passage(found)
    windows_of = found.groupBy("doc_id", "text_hash", "template_id", "license", "start").agg(F.max("containment").alias("containment"))
    best = windows_of.groupBy("doc_id", "text_hash", "template_id", "license").agg(
        F.max("containment").alias("containment"), F.max_by("start", F.struct("containment", -F.col("start"))).alias("start_word"),
        F.count(F.lit(1)).alias("n_windows"))
    return best.drop("text_hash")
