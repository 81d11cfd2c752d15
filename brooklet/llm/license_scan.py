"""Licences of files: notices by TF-IDF cosine to templates, then the nearest licensed directory.

Every line of a file is a candidate notice, and the whole text a candidate licence file.
So is every run of as many words as a template has, for that template: a notice may be
wrapped over several lines or stand inside a longer one. Each is a sparse vector over its words, tf * idf, with document frequencies counted over
all files; a word of no template weighs as one that no file has. The cosine to the
templates (about thirty short texts) is computed only where it can reach the threshold:
of each template the heaviest words are taken until the rest has less than that share
of its length, and a text without any of these words cannot be similar enough. Almost
all prose is ruled out by that, without loss. Runs are looked at only in stretches of a text
whose words hold enough of the template's length, which is without loss as well.

A file that names no licence itself inherits that of the nearest directory above it which
holds a licence file: one whose whole text is similar to a template, or one named like
``LICENSE`` that has a notice. Distinct directories are resolved first, then joined.

All of it is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import written

THRESHOLD = 0.6
#: Words of a text that go together when a stretch of it is looked at.
CELL = 64
NAMES = "(?i)^(un)?licen[cs]e|^copying|^notice"

# Notices and licence beginnings in common use, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC0-1.0", "CC0 1.0 Universal. No Copyright."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

WORDS = "filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), x -> x <> '')"


def _template_words(spark) -> list[tuple[int, str, str, int]]:
    """template, license, word, tf of the built-in templates."""
    rows = [(i, name, text) for i, (name, text) in enumerate(TEMPLATES)]
    table = spark.createDataFrame(rows, "template int, license string, text string")
    words = table.select("template", "license", F.explode(F.expr(WORDS.format(text="text"))).alias("word"))
    return [tuple(r) for r in words.groupBy("template", "license", "word").count().orderBy("template", "word").collect()]


def _quoted(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


class Templates:
    """The templates weighed by the document frequencies of ``files`` (text)."""

    def __init__(self, files: DataFrame, threshold: float = THRESHOLD) -> None:
        spark, self.threshold = files.sparkSession, threshold
        words = _template_words(spark)
        vocabulary = sorted({w for _, _, w, _ in words})
        found = files.select(F.expr(f"array_intersect({WORDS.format(text='text')}, {_quoted(vocabulary)})").alias("w"))
        held = found.select(F.explode_outer(F.concat("w", F.array(F.lit("")))).alias("word"))  # "" counts the files
        frequency = dict(tuple(r) for r in held.groupBy("word").count().collect())
        n = frequency.get("", 0)
        idf = {w: 1 + math.log((n + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary}
        self.unknown = 1 + math.log(n + 1)
        weights: dict[int, dict[str, float]] = {}
        for template, _, word, tf in words:
            weights.setdefault(template, {})[word] = tf * idf[word]
        names = {template: name for template, name, _, _ in words}
        rows, telling, anchors, spans = [], set(), [], []
        size = dict.fromkeys(names, 0)
        for template, _, _, tf in words:
            size[template] += tf
        for template, vector in weights.items():
            length = sum(v * v for v in vector.values()) ** 0.5
            rows += [(template, names[template], w, v / length) for w, v in vector.items()]
            left = 1.0
            for word, v in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if left < threshold * threshold:
                    break
                telling.add(word)
                left -= (v / length) ** 2
            # Words with all but a quarter of what the threshold asks for; common words are in the rest.
            left, held = 1.0, []
            for word, v in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if left < threshold * threshold / 4:
                    break
                held.append((template, word, (v / length) ** 2))
                left -= held[-1][2]
            least = threshold * threshold - max(left, 0.0) - 1e-9
            anchors += [(*row, size[template], least) for row in held]
            spans.append((template, names[template], size[template], {w: v / length for w, v in vector.items()}, idf))
        # Both tables hold a row per word of a template: some hundred.
        self.weights = spark.createDataFrame(rows, "template int, license string, word string, weight double")
        self.idf = spark.createDataFrame(list(idf.items()), "word string, idf double")
        self.anchors = spark.createDataFrame(anchors, "template int, word string, square double, size int, least double")
        self.spans = spark.createDataFrame(
            spans, "template int, license string, size int, weights map<string,double>, idf map<string,double>"
        )
        self.telling = sorted(telling)

    def matches(self, texts: DataFrame) -> DataFrame:
        """unit, license, similarity: the best template of each text similar enough.

        ``texts``: unit (any type, a row each) and text.
        """
        words = texts.withColumn("words", F.expr(WORDS.format(text="text"))).drop("text")
        few = words.filter(F.expr(f"arrays_overlap(words, {_quoted(self.telling)})"))
        terms = few.select("unit", F.explode_outer("words").alias("word")).groupBy("unit", "word").agg(F.count("*").alias("tf"))
        terms = terms.join(F.broadcast(self.idf), "word", "left")
        terms = terms.withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(self.unknown)))
        terms = written(terms.select("unit", "word", "v"), "terms")
        length = terms.groupBy("unit").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
        dots = terms.join(F.broadcast(self.weights), "word").groupBy("unit", "template", "license")
        cosine = dots.agg(F.sum(F.col("v") * F.col("weight")).alias("dot")).join(length, "unit")
        cosine = cosine.withColumn("similarity", F.round(F.col("dot") / F.col("length"), 6))
        near = cosine.filter(F.col("similarity") >= self.threshold).groupBy("unit")
        # Of equally similar templates the first by name.
        best = near.agg(F.min(F.struct(-F.col("similarity"), "license")).alias("best"))
        return best.select("unit", F.col("best.license").alias("license"), (-F.col("best.col1")).alias("similarity"))

    def runs(self, texts: DataFrame) -> DataFrame:
        """unit, license, similarity: the best template among all runs of its number of words in each text.

        ``texts``: unit (any type, a row each) and text. A text is cut into blocks of a
        template's size; a run lies in two of them at most, so both together must hold
        words of ``least`` of the template's squared length, or more.
        """
        words = texts.select("unit", F.expr(WORDS.format(text="text")).alias("words"))
        words = words.filter(F.expr(f"arrays_overlap(words, {_quoted(self.telling)})"))
        held = words.select("unit", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
        held = held.join(F.broadcast(self.anchors), "word")
        block = F.explode(F.expr("array(int(at div size), int(at div size) - 1)")).alias("block")
        held = held.select("unit", "n", "template", "word", "square", "size", "least", block)
        held = held.filter("block >= 0 AND block * size + size <= n").distinct().groupBy("unit", "n", "template", "size", "block")
        held = held.agg(F.sum("square").alias("sum"), F.first("least").alias("least")).filter("sum >= least")
        spans = held.selectExpr("unit", "template", "size", "block * size AS low", "least(block * size + 2 * size - 1, n) AS high")
        # The words of a text come in cells; a stretch takes the few that it lies in, never the whole text.
        wanted = spans.withColumn("cell", F.explode(F.expr(f"sequence(low div {CELL}, (high - 1) div {CELL})")))
        cells = F.expr(f"transform(sequence(0, (size(words) - 1) div {CELL}), c -> slice(words, c * {CELL} + 1, {CELL}))")
        cells = words.select("unit", F.posexplode(cells).alias("cell", "part"))
        near = wanted.join(cells.withColumn("cell", F.col("cell").cast("long")), ["unit", "cell"])
        near = near.groupBy("unit", "template", "low", "high").agg(F.array_sort(F.collect_list(F.struct("cell", "part"))).alias("parts"))
        near = near.join(F.broadcast(self.spans), "template")
        last = F.expr("high - low - size").alias("last")
        stretch = F.expr(f"""transform(slice(flatten(parts.part), int(low % {CELL}) + 1, int(high - low)), x ->
            struct(x AS w, coalesce(idf[x], {self.unknown!r}D) AS idf, coalesce(weights[x], 0D) AS t))""")
        near = near.select("unit", "license", "size", last, stretch.alias("stretch"))
        # Of each run the dot product and the squared length.
        cosines = F.expr("""transform(transform(sequence(0, int(last)), s -> slice(stretch, s + 1, size)), run ->
            aggregate(
                transform(array_distinct(run), d -> struct(size(filter(run, y -> y.w = d.w)) * d.idf AS v, d.t AS t)),
                struct(0D AS dot, 0D AS sq),
                (sum, d) -> struct(sum.dot + d.v * d.t AS dot, sum.sq + d.v * d.v AS sq),
                sum -> sum.dot / sqrt(sum.sq)))""")
        near = near.select("unit", "license", F.round(F.array_max(cosines), 6).alias("similarity"))
        best = near.filter(F.col("similarity") >= self.threshold).groupBy("unit")
        best = best.agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("best"))
        return best.select("unit", F.col("best.license").alias("license"), (-F.col("best.s")).alias("similarity"))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """path, license, similarity, found, directory: one row per distinct path of ``files`` (path, text).

    ``found`` is ``file`` for a licence file, ``header`` for a file with a notice,
    ``inherited`` for one that takes over the licence of ``directory``, and null, as the
    licence, where none applies. Of several notices the most similar counts, then the
    first by name; so of several licence files of a directory. A run of words counts where
    no line and not the whole text is a notice, or where it is more similar to another
    licence than they are to theirs.

    A null text is an empty one. Rows of the same path are one file of all their lines.
    Rows without a path are left out. Very long texts, and any number of notices in one, are
    looked at whole. An empty table gives no row. Other columns are not looked at. Path parts are
    split at ``/``; files without one are in the top directory, the empty path.
    """
    rows = files.filter("path IS NOT NULL").select("path", F.coalesce("text", F.lit("")).alias("text"))
    templates = Templates(rows, threshold)
    word_test = F.expr(f"arrays_overlap({WORDS.format(text='text')}, {_quoted(templates.telling)})")
    few = written(rows.filter(word_test), "candidates")
    lines = few.select("path", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    lines = lines.select(F.struct("path", "line", F.xxhash64("text")).alias("unit"), "text").distinct()
    notices = templates.matches(lines).select("unit.path", "license", "similarity")
    whole = templates.matches(few.select(F.struct("path", F.xxhash64("text")).alias("unit"), "text").distinct())
    whole = whole.select("unit.path", "license", "similarity")
    found = notices.withColumn("whole", F.lit(False)).unionByName(whole.withColumn("whole", F.lit(True)))
    found = found.groupBy("path").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("best"), F.max("whole").alias("whole")
    )
    own = found.select(
        "path", F.col("best.license").alias("license"), (-F.col("best.s")).alias("similarity"), "whole"
    )
    runs = templates.runs(few.select(F.struct("path", F.xxhash64("text")).alias("unit"), "text").distinct())
    runs = runs.groupBy("unit.path").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("run"))
    own = own.join(runs, "path", "full")
    by_run = F.col("license").isNull() | ((F.col("run.license") != F.col("license")) & (-F.col("run.s") > F.col("similarity")))
    by_run = F.coalesce(by_run & F.col("run").isNotNull(), F.lit(False))
    own = written(
        own.select(
            "path",
            F.when(by_run, F.col("run.license")).otherwise(F.col("license")).alias("license"),
            F.when(by_run, -F.col("run.s")).otherwise(F.col("similarity")).alias("similarity"),
            F.coalesce("whole", F.lit(False)).alias("whole"),
        ),
        "own",
    )

    directory = F.expr("regexp_replace(path, '/?[^/]*$', '')")
    named = F.expr("regexp_extract(path, '[^/]*$', 0)").rlike(NAMES)
    licence_files = own.filter(F.col("whole") | named).groupBy(directory.alias("directory"))
    licensed = licence_files.agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license", "path")).alias("best"))
    licensed = written(licensed.select("directory", "best.license"), "licensed")
    paths = rows.select("path").distinct().withColumn("directory", directory)
    # Every directory with all above it: 'a/b' is under 'a/b', 'a' and ''.
    above = paths.select("directory").distinct().withColumn(
        "above", F.explode(F.expr("""transform(sequence(0, CASE WHEN directory = '' THEN 0
            ELSE size(split(directory, '/')) END), n -> array_join(slice(split(directory, '/'), 1, n), '/'))"""))
    )
    nearest = above.join(licensed.withColumnRenamed("directory", "above"), "above").groupBy("directory")
    nearest = nearest.agg(F.max(F.struct(F.length("above").alias("depth"), "above", "license")).alias("n"))
    nearest = written(
        nearest.select("directory", F.col("n.above").alias("from_dir"), F.col("n.license").alias("from_license")), "nearest"
    )
    out = written(paths.join(own, "path", "left"), "paths").join(nearest, "directory", "left")
    is_file = F.col("whole") | (F.col("license").isNotNull() & named)
    how = F.when(is_file, "file").when(F.col("license").isNotNull(), "header").when(F.col("from_license").isNotNull(), "inherited")
    return out.select(
        "path",
        F.coalesce("license", "from_license").alias("license"),
        "similarity",
        how.alias("found"),
        F.when(F.col("license").isNull(), F.col("from_dir")).alias("directory"),
    )
