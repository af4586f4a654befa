"""Licence scans in SQL functions alone: TF-IDF cosine to templates, then inheritance by directory.

Every line of every text is a segment, and so are all runs of 2 to WRAPPED consecutive lines of at most
MAX_LINE characters each, as notices and the headings of licences are wrapped; the whole text of a file
named LICENSE, LICENCE, COPYING or NOTICE is one more. A segment has a licence if its cosine to one of the templates reaches the
threshold. Weights are 1 + ln(tf) times ln((N + 1) / (df + 1)) + 1, df counted over all documents;
words of no template count as if in no document. A text must hold, and a segment must, one of the
words without which no cosine can reach the threshold: the heaviest words of a template, taken until
the others' share of its length is under the threshold. So nothing above the threshold is lost.

A file without a licence of its own takes that of the nearest directory above it that holds a licence
file, found by joining the directories' ancestors with the licensed directories.

Edge cases: a very long text is cut into blocks of BLOCK lines that overlap, so that its runs are made block by
block; a longer line than MAX_LINE stands alone; null or empty texts have no licence of their own but inherit; a null source is the
directory ``_``; ties go to the smaller licence name; repeated rows give repeated rows; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooflight.llm.shared import written

THRESHOLD = 0.8
#: Lines that a wrapped notice may take, and characters that each of them may have.
WRAPPED, MAX_LINE = 6, 1000
#: Lines whose runs are made together.
BLOCK = 64
#: The notices looked for. Longer ones are the customary header paragraphs; whole licences are known by their headings.
TEMPLATES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)(\.[a-z]+)?$"
_TOKEN = "[^a-z0-9]+"


def words_of(text: str) -> list[str]:
    out = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return out.split()


def _tokens(text):
    return F.filter(F.split(F.lower(text), _TOKEN), lambda x: x != "")


def _blocks(text):
    """The lines of ``text`` in blocks, each with the lines that runs of its last ones reach into."""
    lines = F.split(text, "\n")
    cut = F.sequence(F.lit(0), ((F.size(lines) - 1) / BLOCK).cast("int"))
    return F.transform(cut, lambda b: F.slice(lines, b * BLOCK + 1, BLOCK + WRAPPED - 1))


def _runs(part, hit):
    """The runs of lines that begin in a block ``part`` and hold one of those that ``hit`` marks."""

    def wanted(s, k):
        wraps = F.forall(F.slice(part, s, k), lambda x: F.length(x) <= MAX_LINE)
        return F.exists(F.slice(hit, s, k), lambda x: x) & ((k == 1) | wraps)

    def begun(s):
        sizes = F.sequence(F.lit(1), F.least(F.lit(WRAPPED), F.size(part) - s + 1))
        return F.transform(F.filter(sizes, lambda k: wanted(s, k)), lambda k: F.array_join(F.slice(part, s, k), "\n"))

    return F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.size(part))), begun))


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, t in templates for w in words_of(t)})


def _weights(templates, n: int, df: dict) -> tuple[list, list, float]:
    """(term, template, licence, weight / length) rows; the words one of which is needed; the weight of other words."""

    def idf(w: str) -> float:
        return math.log((n + 1) / (df.get(w, 0) + 1)) + 1

    rows, needed = [], set()
    for k, (name, text) in enumerate(templates):
        w = {t: (1 + math.log(c)) * idf(t) for t, c in Counter(words_of(text)).items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        rows += [(t, k, name, x / length, idf(t)) for t, x in sorted(w.items())]
        left = 1.0
        for t, x in sorted(w.items(), key=lambda i: (-i[1], i[0])):
            if left < THRESHOLD**2 * 0.999:
                break
            needed.add(t)
            left -= (x / length) ** 2
    return rows, sorted(needed), idf("")


def own_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(path, licence, score): the best template of each file that has one. ``files``: path, text."""
    vocabulary = _vocabulary(templates)
    known = F.array(*[F.lit(w) for w in vocabulary])
    met = files.select(F.explode(F.array_intersect(_tokens("text"), known)).alias("term"))
    df = {r.term: r.n for r in met.groupBy("term").agg(F.count("*").alias("n")).collect()}
    rows, needed, other = _weights(templates, files.count(), df)
    spark = files.sparkSession
    table = F.broadcast(spark.createDataFrame(rows, "term string, template int, licence string, weight double, idf double"))
    idfs = F.broadcast(spark.createDataFrame(sorted({(t, i) for t, _, _, _, i in rows}), "term string, idf double"))
    any_of = "(?i)(?<![a-z0-9])(" + "|".join(needed) + ")(?![a-z0-9])"
    named = F.element_at(F.split("path", "/"), -1).rlike(_LICENCE_FILE)
    whole = F.when(named, F.array(F.array("text"))).otherwise(F.array().cast("array<array<string>>"))
    counted = written(
        files.where(F.col("text").rlike(any_of))
        .withColumn("uid", F.monotonically_increasing_id())
        .select("path", "uid", F.posexplode(F.concat(_blocks(F.col("text")), whole)).alias("block", "part"))
        .withColumn("hit", F.transform("part", lambda x: x.rlike(any_of)))
        .select("path", "uid", "block", F.posexplode(_runs(F.col("part"), F.col("hit"))).alias("at", "part"))
        .select("path", F.struct("uid", "block", "at").alias("segment"), F.explode(_tokens("part")).alias("term"))
        .groupBy("path", "segment", "term")
        .agg(F.count("*").alias("tf"))
        .join(idfs, "term", "left")
        .withColumn("x", (1 + F.log("tf")) * F.coalesce("idf", F.lit(other))),
        "segments",
    )
    length = counted.groupBy("path", "segment").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = counted.drop("idf").join(table, "term").groupBy("path", "segment", "template", "licence").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    scored = dots.join(length, ["path", "segment"]).withColumn("score", F.least(F.lit(1.0), F.round(F.col("dot") / F.col("length"), 9)))
    best = F.min(F.struct((-F.col("score")).alias("low"), "licence"))
    return scored.where(F.col("score") >= threshold).groupBy("path").agg(best.alias("b")).select("path", F.col("b.licence").alias("licence"), (-F.col("b.low")).alias("score"))


def _parent(path):
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def inherit(files: DataFrame, own: DataFrame) -> DataFrame:
    """(path, licence, score, licence_from): own licences, else those of the nearest licensed directory.

    ``files``: path (unique). licence_from is the file itself, the directory, or null.
    """
    held = own.where(F.element_at(F.split("path", "/"), -1).rlike(_LICENCE_FILE))
    granted = held.groupBy(_parent("path").alias("above")).agg(F.min("licence").alias("granted"))
    names = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(names, 1, k), "/").alias("above")))
    near = (
        files.select(_parent("path").alias("dir")).distinct()
        .select("dir", F.inline(ups))
        .join(granted, "above")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "above", "granted")).alias("n"))
        .select("dir", "n.above", "n.granted")
    )
    return (
        files.select("path").join(own, "path", "left").withColumn("dir", _parent("path")).join(near, "dir", "left")
        .select(
            "path",
            F.coalesce("licence", "granted").alias("licence"),
            "score",
            F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("above")).alias("licence_from"),
        )
    )


def scan_documents(docs: DataFrame, directory_size: int = 100) -> DataFrame:
    """One row per document: doc_id, path, licence, score, licence_from.

    A document is a file of the tree source/group/file, a group being ``directory_size`` ids; the
    first of a group is its LICENSE file. Rows that repeat an id share its path and the best licence of any.
    """
    group = F.floor(F.col("doc_id") / directory_size).cast("string")
    name = F.when(F.col("doc_id") % directory_size == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce(group, F.lit("_")), F.coalesce(name, F.lit("_.txt")))
    files = docs.select("doc_id", path.alias("path"), "text")
    own = written(own_licences(files), "licences")
    judged = inherit(files.select("path").distinct(), own)
    return files.select("doc_id", "path").join(judged, "path")
