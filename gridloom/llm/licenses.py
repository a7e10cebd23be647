"""License scans: sparse TF-IDF cosine to templates, and inheritance down the directory tree.

Three kinds of notices are taken of a whole text: windows of as many terms as a longer template has, wherever its first
two terms stand (so header blocks and licence files are held against full notices however they are wrapped); each
identifier of an SPDX expression; and single lines with a marker word, for titles and short notices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..tables import settle

#: Fixed values: (licence, its title, its SPDX identifier).
LICENCES = (
    ("AGPL", "GNU Affero General Public License", "AGPL-3.0"),
    ("Apache-2.0", "Apache License", "Apache-2.0"),
    ("BSD", "BSD License", "BSD-3-Clause"),
    ("CC-BY", "Creative Commons Attribution International License", "CC-BY-4.0"),
    ("CC-BY-NC", "Creative Commons Attribution NonCommercial International License", "CC-BY-NC-4.0"),
    ("GPL", "GNU General Public License", "GPL-3.0"),
    ("LGPL", "GNU Lesser General Public License", "LGPL-3.0"),
    ("MIT", "MIT License", "MIT"),
    ("MPL-2.0", "Mozilla Public License", "MPL-2.0"),
)
#: What short notices of any licence say about its title or identifier.
FORMS = ("{title}", "Licensed under the {title} version", "Released under the {title}", "Distributed under the {title}", "Licensed under the terms of the {title}", "under the terms of the {title} as published by", "SPDX-License-Identifier: {spdx}")
#: Fixed values: (licence, a notice of its own).
NOTICES = (
    ("BSD", "BSD Clause License"),
    ("BSD", "Redistribution and use in source and binary forms with or without modification are permitted"),
    ("CC-BY", "Licensed under CC BY"),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution International License CC BY"),
    ("CC-BY-NC", "Licensed under CC BY-NC"),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial International License CC BY-NC"),
    ("LGPL", "GNU Library General Public License"),
    ("MIT", "Permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("Proprietary", "All rights reserved"),
    ("Proprietary", "Copyright All rights reserved"),
    ("Proprietary", "All rights reserved unauthorized copying of this file is strictly prohibited"),
)
#: Fixed values: (licence, the beginning of its full notice or text).
TEXTS = (
    ("AGPL", "free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY", "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit"),
    ("CC-BY-NC", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit"),
    ("GPL", "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("LGPL", "free software: you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
)
#: (licence, notice): several of each licence; a notice is scored by the best of them.
TEMPLATES = tuple((licence, form.format(title=title, spdx=spdx)) for licence, title, spdx in LICENCES for form in FORMS) + NOTICES + TEXTS
#: Words that make a line part of a licence notice.
MARKERS = r"(?i)licen[sc]e|copyright|spdx|all rights reserved|redistribution|subject to the terms|permission is hereby granted"
#: Words that say nothing about a licence.
STOP = ("a", "an", "and", "any", "are", "as", "at", "be", "c", "file", "for", "in", "is", "it", "of", "on", "or", "see", "that", "the", "this", "to", "under", "with", "without", "you")
TERM = "[a-z]+(-[a-z]+)*"
LEAST = 0.6
#: What a window or an identifier must reach; templates of so many terms or more have windows.
LEAST_WHOLE, WINDOW_TERMS = 0.75, 8
#: An SPDX expression, its exceptions, what parts its identifiers, and what an identifier may end in.
SPDX, EXCEPTION, PARTS, SUFFIX = r"(?i)spdx-license-identifier:[ \t]*([^\r\n]*)", r"[ \t]+with[ \t]+[^ \t()]+", r"[ \t]+(?:or|and)[ \t]+|[()]", r"[ \t]*\*/$|-(?:only|or-later)$|\+$"


def _terms(text: str) -> F.Column:
    return F.filter(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), F.lit(0)), lambda x: ~x.isin(*STOP))


def template_weights(templates: DataFrame) -> DataFrame:
    """(licence, template, term, w): unit TF-IDF vectors of the templates (licence, notice); idf is over the templates, ln((1 + N) / (1 + df)) + 1."""
    each = ["licence", "template"]
    templates = templates.select("licence", F.col("notice").alias("template")).distinct()
    tf = templates.select(*each, F.explode(_terms("template")).alias("term")).groupBy(*each, "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((F.lit(1.0) + F.col("k")) / (F.lit(1.0) + F.col("df"))) + 1.0
    w = tf.join(df, "term").withColumn("k", F.lit(templates.count())).select(*each, "term", (F.col("tf") * idf).alias("w"))
    norm = w.groupBy(*each).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, each).select(*each, "term", (F.col("w") / F.col("norm")).alias("w"))


def _long_terms(notice: str) -> list[str]:
    return [m.group() for m in re.finditer(TERM, notice.lower()) if m.group() not in STOP]


def openings(templates: list[tuple[str, str]]) -> list[tuple[str, str, int]]:
    """(first term, second term, number of terms) of the templates that have windows."""
    longer = [x for _, notice in templates if len(x := _long_terms(notice)) >= WINDOW_TERMS]
    return sorted({(x[0], x[1], len(x)) for x in longer})


def windows(files: DataFrame, templates: DataFrame) -> DataFrame:
    """(file_id, notice): of each whole text, where a longer template's first two terms follow one another, as many terms as it has.

    The templates, a list that a user writes, are read by the driver.  Texts without a first term are left out before they
    come to Python; a text is searched for first terms, and only what follows one is cut into terms, window by window.
    """
    begins = openings([(r.licence, r.notice) for r in templates.select("licence", "notice").distinct().collect()])
    if not begins:
        return files.select("file_id", F.lit("").alias("notice")).limit(0)
    firsts = r"(?<![a-z])(?<![a-z]-)(?:" + "|".join(sorted({re.escape(x) for x, _, _ in begins})) + r")(?!-?[a-z])"
    id_type = files.schema["file_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, term, most = re.compile(firsts), re.compile(TERM), max(n for _, _, n in begins)

        def out(rows: list[int], found: list[str], batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], names=["file_id", "notice"])

        for batch in batches:
            rows, found = [], []
            for k, value in enumerate(batch.column(1)):
                text, seen = value.as_py(), set()
                for m in first.finditer(text):
                    ahead = list(islice((t for x in term.finditer(text, m.start()) if (t := x.group()) not in STOP), most))
                    for a, b, n in begins:
                        if ahead[:2] == [a, b] and (notice := " ".join(ahead[:n])) not in seen:
                            seen.add(notice)
                            rows.append(k)
                            found.append(notice)
                    if len(seen) > 10_000:  # a text of very many windows: those that come again are told apart later
                        yield out(rows, found, batch)
                        rows, found, seen = [], [], set()
            yield out(rows, found, batch)

    lower = F.lower("text")
    return files.select("file_id", lower.alias("text")).where(F.col("text").rlike(firsts)).mapInArrow(run, f"file_id {id_type}, notice string")


def identifiers(files: DataFrame) -> DataFrame:
    """(file_id, notice): each identifier of the SPDX expressions of the texts as a notice of its own; exceptions, versions and suffixes are left out."""
    said = F.regexp_extract_all("text", F.lit(SPDX), F.lit(1))
    parts = F.flatten(F.transform(said, lambda x: F.split(F.regexp_replace(F.lower(x), EXCEPTION, ""), PARTS)))
    clean = F.filter(F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), SUFFIX, ""), "[0-9]+", "")), lambda x: x != "")
    named = F.array_distinct(F.transform(clean, lambda x: F.concat(F.lit("spdx-license-identifier: "), x)))
    return files.where(F.col("text").rlike(SPDX)).select("file_id", F.explode(named).alias("notice"))


def classify(files: DataFrame, templates: DataFrame, least: float = LEAST, least_whole: float = LEAST_WHOLE) -> DataFrame:
    """(file_id, licence, score) of the files (file_id, text) with a licence notice that is like a template (licence, notice).

    Distinct notices are scored once however many files carry them: the greatest cosine of the notice's TF-IDF vector with
    those of a licence's templates, terms weighed by the templates' idf, stop words left out; ties go to the first name.
    A file has the licences of all its windows and SPDX identifiers at ``least_whole`` or above, parted by commas in the
    order of their names, with the best score.  Only where there are none, it has that of the best of its lines with a
    licence marker (digits out) at ``least`` or above.  The notices are written to a table, so that each kind reads the texts once.
    """
    lines = F.filter(F.split("text", r"\r\n|\n|\r"), lambda x: x.rlike(MARKERS))
    notice = F.array_distinct(F.transform(lines, lambda x: F.lower(F.trim(F.regexp_replace(x, "[0-9]+", "")))))
    by_line = files.where(F.col("text").rlike(MARKERS)).select("file_id", F.explode(notice).alias("notice"))
    noted = settle(by_line.withColumn("whole", F.lit(False)).union(windows(files, templates).union(identifiers(files)).withColumn("whole", F.lit(True))).withColumn("key", F.md5("notice")), "notices")  # long notices are known by key
    weights = template_weights(templates)
    distinct = noted.dropDuplicates(["key"]).select("key", "notice")
    idf = F.log((F.lit(1.0) + F.col("k")) / (F.lit(1.0) + F.coalesce("df", F.lit(0)))) + 1.0
    df = weights.groupBy("term").agg(F.count("*").alias("df"))
    tf = distinct.select("key", F.explode(_terms("notice")).alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    w = tf.join(df, "term", "left").withColumn("k", F.lit(templates.select("licence", "notice").distinct().count())).select("key", "term", (F.col("tf") * idf).alias("v"))
    length = w.groupBy("key").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    dot = w.join(weights, "term").groupBy("key", "licence", "template").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    score = F.round(F.col("dot") / F.col("length"), 4)
    near = dot.join(length, "key").select("key", "licence", score.alias("score")).where(F.col("score") >= min(least, least_whole))
    best = near.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("m"))
    like = noted.select("file_id", "key", "whole").join(best, "key").where(-F.col("m.s") >= F.when(F.col("whole"), least_whole).otherwise(least))
    whole = F.col("whole")
    of_file = like.groupBy("file_id").agg(F.collect_set(F.when(whole, F.col("m.licence"))).alias("stated"), F.min(F.when(whole, F.col("m"))).alias("best"), F.min(F.when(~whole, F.col("m"))).alias("line"))
    licence = F.when(F.size("stated") > 0, F.array_join(F.sort_array("stated"), ", ")).otherwise(F.col("line.licence"))
    return of_file.select("file_id", licence.alias("licence"), (-F.coalesce("best.s", "line.s")).alias("score"))


def scan(files: DataFrame, templates: DataFrame, least: float = LEAST) -> DataFrame:
    """(file_id, directory, own, score, licence, inherited_from) for every file (file_id, path, text).

    A file's own notices decide; else the licence of the nearest directory at or above its own that has a licence file
    (named LICENSE or COPYING, with any extension; of several in a directory the best score, then the first name, counts).
    Directories, not files, are matched to their ancestors, so a directory with a third of all files is matched once.
    A null path is a file without directory; null, empty and unmarked texts have no notice; repeated rows stay; rows that
    repeat a file_id share one notice.  Without files the result is empty.
    """
    own = classify(files, templates, least)
    name = F.substring_index("path", "/", -1)
    directory = F.when(F.col("path").isNull(), F.lit(None)).otherwise(F.expr("left(path, greatest(length(path) - length(substring_index(path, '/', -1)) - 1, 0))"))
    placed = files.select("file_id", directory.alias("directory"), name.rlike(r"(?i)^(licen[sc]e|copying)(\..*)?$").alias("is_licence"))
    found = placed.join(own, "file_id", "left")
    declared = found.where("is_licence and licence is not null and directory is not null").groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).getField("licence").alias("given")).withColumnRenamed("directory", "ancestor")
    steps = F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice("parts", 1, i), "/").alias("ancestor")))
    lines = found.select("directory").where("directory is not null").distinct().withColumn("parts", F.split("directory", "/"))
    climbed = lines.select("directory", F.inline(F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("ancestor"))), F.when(F.col("directory") != "", steps).otherwise(F.array().cast("array<struct<depth:int,ancestor:string>>")))))
    nearest = climbed.join(declared, "ancestor").groupBy("directory").agg(F.max(F.struct("depth", "ancestor", "given")).alias("m"))
    out = found.join(nearest, "directory", "left")
    return out.select("file_id", "directory", F.col("licence").alias("own"), "score", F.coalesce("licence", "m.given").alias("licence"), F.when(F.col("licence").isNull(), F.col("m.ancestor")).alias("inherited_from"))
