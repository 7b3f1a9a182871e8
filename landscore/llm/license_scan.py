"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.
DataFrame functions only.

Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` with A-Z in lower case, shingles are SHINGLE words (the whole sequence
of a template with fewer). A template of m shingles is looked for in windows of 2 c shingles at every c-th place, where c is
m rounded up to a power of two, so every place of c shingles in a row lies in some window. A template
matches a window if at least CONTAINED of its different shingles are in it.

A window's MinHash signature has BANDS bands of one row each. With 0.8 m shared shingles of at most 2 c + 0.2 m <= 4.2 m the
Jaccard similarity is 0.19 at least, so a match meets its template in some band with probability 1 - 0.81 ** 64 > 0.999998.
A window can meet a template in a band only if it holds the shingle that is the template's minimum there. So the bands are
looked up from the templates' side: these shingles, BANDS a template at most, find the windows by an equi-join on shingle
hashes, and only for them is the signature computed. No meeting of bands is lost by that.

Defined cases: null or empty texts match nothing and are returned with no templates; rows that repeat a doc_id are judged by
their own texts; a null doc_id is returned as null; templates without words never match, repeated ones count once; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key, sized, stage
from .decontaminate import words

SHINGLE, BANDS, CONTAINED, SEED = 5, 64, 0.8, 7
#: Short public licence notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(templates.items()), "template string, text string")


def shingle_hashes(w: Column, size: int = SHINGLE) -> Column:
    """Hashes of an array of words' shingles, in order; of fewer words the whole sequence; none for none."""
    at = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
    each = F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, F.lit(size)), " ")))
    return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<long>"))


def known_templates(templates: DataFrame) -> DataFrame:
    """template, shingles (distinct), c."""
    t = templates.select("template", shingle_hashes(words(F.col("text"))).alias("s")).where(F.size("s") > 0)
    t = t.withColumn("c", F.pow(2.0, F.ceil(F.log2(F.size("s")))).cast("int"))
    return t.select("template", F.array_distinct("s").alias("shingles"), "c").distinct()


def row_hash(j: Column, shingle: Column) -> Column:
    return F.xxhash64(F.lit(SEED), j, shingle)


def signature(shingles: Column) -> Column:
    """(band, value) of each band."""
    low = lambda j: F.array_min(F.transform(shingles, lambda x: row_hash(j, x)))
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.struct(j.alias("band"), low(j).alias("value")))


def template_bands(known: DataFrame) -> DataFrame:
    """template, c, band, value, and h: the shingle that has the band's value."""
    low = lambda j: F.array_min(F.transform("shingles", lambda x: F.struct(row_hash(j, x).alias("value"), x.alias("h"))))
    each = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.struct(j.alias("band"), low(j).alias("low")))
    return known.select("template", "c", F.explode(each).alias("b")).select("template", "c", "b.band", "b.low.value", "b.low.h")


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, templates (sorted names of those found); one row for each input row."""
    known = sized(stage(known_templates(templates), "templates"))
    theirs = sized(stage(template_bands(known), "template_bands"))
    wanted = sized(stage(theirs.select("c", "h").distinct(), "band_shingles"))
    did, rk = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select("doc_id", "text").select("doc_id", did.alias("did"), rk.alias("rk"), words(F.col("text")).alias("w"))
    #: Shingles as zipped, shifted arrays: one row a place, hashed in generated code.
    last = F.greatest(F.size("w") - SHINGLE + 1, F.lit(1))
    zipped = F.arrays_zip(*[F.slice("w", F.lit(k + 1), F.greatest(last, F.lit(0))).alias(f"w{k}") for k in range(SHINGLE)])
    places = keyed.where(F.size("w") > 0).select("did", "rk", F.posexplode(zipped).alias("pos", "z"))
    places = places.select("did", "rk", "pos", F.xxhash64(F.concat_ws(" ", *[f"z.w{k}" for k in range(SHINGLE)])).alias("h"))
    hits = places.join(wanted, "h").select("did", "rk", "c", F.floor(F.col("pos") / F.col("c")).cast("int").alias("i"))
    at = hits.select("did", "rk", "c", F.explode(F.array("i", F.col("i") - 1)).alias("i")).where("i >= 0").distinct()
    windows = stage(at.groupBy("did", "rk").agg(F.collect_list(F.struct("c", "i")).alias("windows")), "windows")
    cut = keyed.join(sized(windows), ["did", "rk"]).select("did", "rk", "w", F.explode("windows").alias("x")).select("did", "rk", "x.c", "x.i", F.slice("w", F.col("x.i") * F.col("x.c") + 1, 2 * F.col("x.c") + SHINGLE - 1).alias("w"))
    seen = stage(cut.where(F.size("w") > 0).select("did", "rk", "c", "i", F.array_distinct(shingle_hashes(F.col("w"))).alias("shingles")), "window_shingles")
    bands = seen.select("did", "rk", "c", "i", F.explode(signature(F.col("shingles"))).alias("b")).select("did", "rk", "c", "i", "b.band", "b.value")
    pairs = bands.join(theirs.drop("h"), ["c", "band", "value"]).select("did", "rk", "c", "i", "template").distinct()
    exact = pairs.join(seen, ["did", "rk", "c", "i"]).join(known.select("template", F.col("shingles").alias("t")), "template")
    exact = exact.where(F.size(F.array_intersect("shingles", "t")) >= CONTAINED * F.size("t"))
    per_doc = exact.groupBy("did", "rk").agg(F.array_sort(F.collect_set("template")).alias("templates"))
    rows = docs.select("doc_id", did.alias("did"), rk.alias("rk")).join(sized(stage(per_doc, "scanned")), ["did", "rk"], "left")
    return rows.select("doc_id", F.coalesce("templates", F.array().cast("array<string>")).alias("templates"))
