"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies.

Words are runs of letters and digits in lower case; a shingle is five of them.
For every length a template has, a document is cut into overlapping windows of
about that length, so that a whole occurrence of the template lies in one of
them.  A window and a template meet if one of ``BANDS`` bands of two MinHash
values agrees: where 0.8 of the template lies in the window their Jaccard
likeness is 0.6 or more, and they meet with a probability over 0.999999.  What
meets is verified by the exact share of the template's shingles in the window.

A MinHash value of a window can only equal a template's if the window holds a
shingle of some template, so only such windows are cut: this loses nothing, and
the cost of a document without license words is its shingle hashes.

Everything is column expressions; no text is shuffled.  Templates are at most
``MOST_TEMPLATES``, which bounds what is broadcast.  A null, empty or short text
has no match.  A document listed under one doc_id several times is scanned row by
row and reported once for each license.  An empty table gives no row.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellshift.llm.common import bound, text_or_empty

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 32, 2
MOST_TEMPLATES = 1000
MOST_BYTES = 1 << 20  # of all templates; their shingles and bands are broadcast, about 45 bytes a byte
#: Public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
}


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words, in order; none for fewer words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def hashes(w: Column) -> Column:
        at = F.when(F.size(w) >= WORDS, F.sequence(F.lit(0), F.size(w) - WORDS)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]))

    return bound(words, hashes)


def bands(window: Column) -> Column:
    """One value for each band of the MinHash signature of an array of hashes."""

    def band(w: Column, nth: Column) -> Column:
        def smallest(row: int) -> Column:
            return F.array_min(F.transform(w, lambda h: F.xxhash64(h, nth * ROWS + row)))

        return F.xxhash64(nth, *[smallest(row) for row in range(ROWS)])

    return bound(
        window, lambda w: F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda nth: band(w, nth))
    )


def geometry(length: int) -> tuple[int, int]:
    """Length and stride of the windows for templates of ``length`` shingles."""
    stride = max(1, length // 8)
    return (length + stride - 1, stride)


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """license, shingles (distinct), length; refuses more than ``MOST_TEMPLATES``, or long ones beyond ``MOST_BYTES``."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; at most {MOST_TEMPLATES}")
    size = sum(len(text.encode()) for text in templates.values())
    if size > MOST_BYTES:
        raise ValueError(f"templates of {size} bytes; at most {MOST_BYTES}")
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    return rows.select(
        "license", F.array_distinct(shingles(F.col("text"))).alias("template")
    ).select("license", "template", F.size("template").alias("length"))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, containment, first_word: one row for each license a document holds.

    containment is the largest share of the template's shingles in one window;
    first_word is the first word of the first window that has that share.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates).collect()  # bounded above
    short = sorted(r["license"] for r in known if not r["length"])
    if short:
        raise ValueError(f"templates of fewer than {WORDS} words: {short}")
    # the templates went through the same expression as the texts
    kept = spark.createDataFrame(known, "license string, template array<bigint>, length int")
    parts = sorted({h for r in known for h in r["template"]})
    lengths = sorted({r["length"] for r in known})

    hashed = docs.select("doc_id", shingles(text_or_empty("text")).alias("hashes"))

    def anchors(h: Column) -> Column:
        hits = F.filter(
            F.transform(h, lambda x, i: F.when(x.isin(parts), i)), lambda i: i.isNotNull()
        )
        return F.struct(h.alias("hashes"), hits.alias("at"))

    marked = hashed.select("doc_id", bound(F.col("hashes"), anchors).alias("m")).where("size(m.at) > 0")
    found = marked.select("doc_id", F.col("m.hashes").alias("hashes"), F.col("m.at").alias("at"))

    def starts(length: int) -> Column:
        size, stride = geometry(length)

        def covering(a: Column) -> Column:
            low = F.greatest(F.lit(0), F.ceil((a - size + 1) / stride)).cast("int")
            return F.sequence(low, F.floor(a / stride).cast("int"))

        numbers = F.array_distinct(F.flatten(F.transform("at", covering)))
        return F.transform(
            numbers,
            lambda k: F.struct(
                F.lit(length).alias("of_length"), (k * stride).alias("start"), F.lit(size).alias("size")
            ),
        )

    windows = found.select(
        "doc_id", "hashes", F.explode(F.concat(*[starts(n) for n in lengths])).alias("w")
    ).select(
        "doc_id",
        F.col("w.of_length").alias("of_length"),
        F.col("w.start").alias("start"),
        F.array_distinct(F.slice("hashes", F.col("w.start") + 1, F.col("w.size"))).alias("window"),
    )
    met = windows.select("*", F.explode(bands(F.col("window"))).alias("band"))
    listed = kept.select(
        "license", "template", "length", F.explode(bands(F.col("template"))).alias("their_band")
    )
    pairs = met.join(
        F.broadcast(listed),
        (F.col("band") == F.col("their_band")) & (F.col("of_length") == F.col("length")),
    )
    share = F.size(F.array_intersect("template", "window")) / F.col("length")
    return (
        pairs.withColumn("containment", share)
        .where(F.col("containment") >= LEAST)
        .groupBy("doc_id", "license")
        .agg(
            F.max("containment").alias("containment"),
            F.max_by(-F.col("start"), F.struct("containment", -F.col("start"))).alias("s"),
        )
        .select("doc_id", "license", "containment", (-F.col("s")).cast("long").alias("first_word"))
    )
