"""License scans: MinHash bands of overlapping windows retrieve license templates, exact shingle containment verifies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.contamination import plain_words
from ledgerloom.llm.identity import row_identity
from ledgerloom.llm.text import let, pick, positions
from ledgerloom.sources.scratch import stored

SHINGLE = 5
CONTAINMENT = 0.8
# A window that shares half its shingles with a template (Jaccard) has an equal band with probability
# 1 - (1 - 0.5 ** ROWS) ** BANDS = 0.999, one that shares 0.78, as the best placed window of a verbatim copy does,
# with 1 - 2e-10
BANDS, ROWS = 24, 2
# Template shingles that one pass over the documents looks for; a larger table of templates takes more passes
BLOCK = 200_000

# License notices as they stand in texts
TEMPLATES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "reserved": "All rights reserved.",
}


def template_table(spark: SparkSession) -> DataFrame:
    """The built-in templates as (license, text)."""
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def _shingles(words: Column, width: Column | int) -> Column:
    return F.transform(positions(1, F.size(words) - width + 1), lambda i: F.xxhash64(F.slice(words, i, width)))


def _bands(shingles: Column) -> Column:
    """(band, value) of a shingle set: ``BANDS`` hashes, each over ``ROWS`` minima under different hash functions."""
    mins = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)),
        lambda seed: F.array_min(F.transform(shingles, lambda h: F.xxhash64(seed, h))),
    )
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(b.alias("band"), F.xxhash64(F.slice(mins, b * ROWS + 1, ROWS)).alias("value")),
    )


def _templates(templates: DataFrame, shingle: int) -> DataFrame:
    """(license, width, shingles, m, step): a template's different shingles, and the windows it is looked for in."""
    split = templates.select("license", plain_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    sized = split.withColumn("width", F.least(F.lit(shingle), F.size("w")))
    cut = sized.select("license", "width", _shingles(F.col("w"), F.col("width")).alias("all"))
    m = F.size("all")
    return cut.select("license", "width", F.array_distinct("all").alias("shingles"), m.alias("m"),
                      F.greatest(F.lit(1), F.floor(m / 4).cast("int")).alias("step")).distinct()


def find(
    docs: DataFrame,
    templates: DataFrame | None = None,
    text: str = "text",
    key: str = "doc_id",
    containment: float = CONTAINMENT,
    shingle: int = SHINGLE,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, license, containment, start): the licenses in each document, one row per document and license.

    Windows have as many shingles as a template and overlap by three quarters. Only windows with a shingle of some
    template are signed, which loses none: an equal minimum is a shared shingle. Windows that share a MinHash band with
    a template are compared with it: ``containment`` is the share of the template's shingles (``shingle`` words, fewer
    for shorter templates) found in the window and one step around it, the best of a document's windows; ``start`` is
    where that window begins, in words from 0.

    Templates are a table of any size: their shingles are broadcast in blocks of about ``block``, one pass over the
    documents each, and windows that several passes find count once. The result does not depend on ``block``.

    Documents without a license have no row, so neither have null and empty texts; repeated rows count as one
    document, different texts under one key, or none, as several. Templates that are null or without words match nothing.
    """
    spark = docs.sparkSession
    known = _templates(templates if templates is not None else template_table(spark), shingle)
    known = stored(known, "license-templates")
    widths = sorted(r[0] for r in known.select("width").distinct().collect())
    narrow = pick(docs, doc_id=key, text=text)
    narrow = narrow.withColumn("doc_id", row_identity(F.col("doc_id"), F.col("text")))
    if not widths:
        return narrow.limit(0).select(F.col("doc_id.key").alias("doc_id"), F.lit("").alias("license"), F.lit(0.0).alias("containment"),
                                      F.lit(0).alias("start"))
    wanted = stored(known.select("width", "m", "step", F.explode("shingles").alias("h")).distinct(), "template-shingles")
    blocks = max(1, -(-wanted.count() // block))

    def windows(width: int, part: int) -> DataFrame:
        every = narrow.select("doc_id", let(plain_words(F.col("text")), lambda w: _shingles(w, width)).alias("all"))
        each = every.select("doc_id", "all", F.posexplode("all").alias("at", "h"))
        chosen = wanted.filter((F.col("width") == width) & (F.pmod(F.xxhash64("h", "m"), F.lit(blocks)) == part))
        met = each.join(F.broadcast(chosen), "h")
        first = F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("m") + 1) / F.col("step")).cast("int"))
        last = F.floor(F.col("at") / F.col("step")).cast("int")
        placed = met.select("doc_id", "all", "width", "m", "step", F.explode(F.sequence(first, last)).alias("k"))
        start = F.col("k") * F.col("step")
        before = F.least(start, F.col("step"))
        return placed.select(
            "doc_id", "width", "m", start.alias("start"),
            F.slice("all", start + 1, F.col("m")).alias("inside"),
            F.slice("all", start - before + 1, F.col("m") + before + F.col("step")).alias("around"),
        )

    passes = [windows(w, part) for w in widths for part in range(blocks)]
    signed = reduce(DataFrame.unionByName, passes).dropDuplicates(["doc_id", "width", "m", "start"])
    banded = signed.select("doc_id", "width", "m", "start", "around", F.inline(_bands(F.col("inside"))))
    targets = known.select("license", "width", "m", "shingles", F.inline(_bands(F.col("shingles"))))
    candidates = banded.join(F.broadcast(targets) if blocks == 1 else targets, ["width", "m", "band", "value"])
    shared = F.size(F.array_intersect("shingles", "around")) / F.size("shingles")
    judged = candidates.select("doc_id", "license", "start", shared.alias("containment")).filter(
        F.col("containment") >= containment
    )
    best = judged.groupBy("doc_id", "license").agg(
        F.max(F.struct("containment", (-F.col("start")).alias("back"))).alias("best")
    )
    return best.select(F.col("doc_id.key").alias("doc_id"), "license", "best.containment", (-F.col("best.back")).alias("start"))
