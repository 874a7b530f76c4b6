"""License scans: sparse TF-IDF cosine to templates, then inheritance by path.

* Passages. In every text, each line with a licensing word gives a header
  passage (the line) and a block (it and the ``BLOCK_LINES - 1`` lines after it,
  as notices are wrapped); the whole text of such a document is a third kind,
  which finds licence files. Equal passages are scored once: a notice that a
  third of all documents carry is one row, collapsed on the map side.
* Scores. Terms are lower-case words and version numbers. Weights are tf * idf
  with idf = ln(1 + N / df) over the distinct passages of all documents and the
  templates. The cosine is a join on the term with the template weights (a
  table of fixed size, so it is broadcast) and a grouped sum.
* Inheritance. A file without a licence of its own takes that of the nearest
  ancestor directory with a licence file. Only distinct directories are joined
  with their ancestors; files then join their directory, so a directory (or the
  root) that holds a third of all files is an ordinary skewed join, which
  adaptive execution splits.

Defined results: null and empty texts have no licence; ties go to the higher
cosine, then the smaller licence name, then the smaller path; a null path
inherits nothing; each input row gives a row; an empty table gives no rows.

Templates are the one-line notices, the standard notices of a file's head and,
from ``licences/``, whole licence files. That of AGPL-3.0 is GPL-3.0's text with
the paragraphs of its own; the CC-BY licences have one-line notices only.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import named, stage, table

THRESHOLD = 0.6
BLOCK_LINES = 8
CUE = r"(?i)licen[cs]|copyright|permission is|redistribut|public domain|spdx"

#: Wording of headers and notices, by SPDX name.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial "
                     "4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

#: The notice of the GNU licences: program or library, punctuation, licence, version.
NOTICE = ("This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {name}General "
          "Public License as published by the Free Software Foundation{mark} either version {version} of the License, or (at your "
          "option) any later version.")
WARRANTY = (" This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}General Public License for more "
            "details.")
for _licence, _what, _name, _version in (("GPL-2.0", "program", "", 2), ("GPL-3.0", "program", "", 3),
                                         ("LGPL-3.0", "library", "Lesser ", 3), ("LGPL-3.0", "program", "Lesser ", 3),
                                         ("AGPL-3.0", "program", "Affero ", 3)):
    _words = {"what": _what, "name": _name, "version": _version, "colon": ";" if _version == 2 else ":",
              "mark": ";" if _version == 2 else ","}
    TEMPLATES[_licence] += [NOTICE.format(**_words), (NOTICE + WARRANTY).format(**_words)]
for _licence in TEMPLATES:
    if (_file := resources.files(__package__) / "licences" / f"{_licence}.txt").is_file():
        TEMPLATES[_licence].append(_file.read_text("utf-8"))


def terms(text):
    """Lower-case words and version numbers of a text column."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:\.[0-9]+)*"), F.lit(0))


def passages(src: DataFrame) -> DataFrame:
    """``(id, row, kind, passage)`` of all texts with a licensing word."""
    cued = src.where(F.col("text").rlike(CUE)).withColumn("lines", F.split("text", "\r?\n"))
    at = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(CUE), i)), lambda i: i.isNotNull())
    each = F.concat(
        F.flatten(F.transform(at, lambda i: F.array(
            F.struct(F.lit("header").alias("kind"), F.get("lines", i).alias("passage")),
            F.struct(F.lit("block").alias("kind"), F.array_join(F.slice("lines", i + 1, BLOCK_LINES), " ").alias("passage"))))),
        F.array(F.struct(F.lit("file").alias("kind"), F.col("text").alias("passage"))))
    return cued.select("id", "row", F.explode(each).alias("p")).select("id", "row", "p.kind", terms(F.col("p.passage")).alias("words"))


def template_terms(spark: SparkSession) -> DataFrame:
    rows = [(f"{name}#{i}", name, text) for name, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "template string, licence string, text string").select(
        "template", "licence", terms(F.col("text")).alias("words"))


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.explode("words").alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def score(distinct: DataFrame, threshold: float) -> DataFrame:
    """``distinct(key, words)`` -> ``(key, licence, cosine)`` of the best template."""
    spark = distinct.sparkSession
    templates = template_terms(spark)
    tf = stage(_counts(distinct, "key"), "licence-terms")
    of_templates = _counts(templates, "template", "licence")
    n = distinct.count() + sum(map(len, TEMPLATES.values()))
    every = tf.select("term").unionByName(of_templates.select("term"))
    idf = stage(every.groupBy("term").agg(F.log(1 + F.lit(float(n)) / F.count(F.lit(1))).alias("idf")), "licence-idf")
    weigh = lambda df: df.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = weigh(tf).groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    t = weigh(of_templates)
    t = t.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template"))))
    t = t.select("term", "template", "licence", F.col("w").alias("tw"), F.col("idf"))
    dot = (tf.join(F.broadcast(t), "term").groupBy("key", "template", "licence")
           .agg(F.sum(F.col("tf") * F.col("idf") * F.col("tw")).alias("dot")))
    best = (dot.groupBy("key").agg(F.max(F.struct("dot")).alias("top"),
                                   F.collect_list(F.struct("dot", "licence")).alias("all"))
            .join(norm, "key"))
    # the smallest name among the templates of the highest score
    name = F.array_min(F.transform(F.filter("all", lambda x: x["dot"] == F.col("top.dot")), lambda x: x["licence"]))
    return (best.select("key", name.alias("licence"), (F.col("top.dot") / F.col("norm")).alias("cosine"))
            .where(F.col("cosine") >= threshold))


def scan_licences(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``(id, row, licence, cosine, kind)`` of the rows with a licence; ``row`` is a
    hash of the text and tells rows of one id apart."""
    src = named(docs, id=id_column, text=text).withColumn("row", F.xxhash64("text"))
    found = stage(passages(src).withColumn("key", F.sha2(F.concat_ws(" ", "words"), 256)), "licence-passages")
    scored = score(found.groupBy("key").agg(F.first("words").alias("words")), threshold)
    best = found.select("id", "row", "kind", "key").distinct().join(stage(scored, "licence-scores"), "key")
    order = F.array_min(F.collect_list(F.struct((-F.col("cosine")).alias("s"), "licence", "kind")))
    return best.groupBy("id", "row").agg(order.alias("o")).select(
        "id", "row", F.col("o.licence").alias("licence"), (-F.col("o.s")).alias("cosine"), F.col("o.kind").alias("kind"))


def directory(path):
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherit(files: DataFrame) -> DataFrame:
    """``files(id, path, licence, cosine, is_licence_file)`` -> with ``effective`` and
    ``inherited_from`` (a directory; null for an own licence or none)."""
    f = files.withColumn("dir", directory(F.col("path")))
    holds = stage(f.where("is_licence_file and licence is not null and path is not null").groupBy("dir").agg(
        F.min(F.struct((-F.col("cosine")).alias("s"), "licence", "path")).alias("m"))
        .select(F.col("dir").alias("holder"), F.col("m.licence").alias("given")), "licence-directories")
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    dirs = f.where("path is not null").select("dir").distinct()
    above = dirs.select("dir", F.explode(F.array_distinct(up)).alias("holder"))
    nearest = (above.join(holds, "holder").groupBy("dir")
               .agg(F.max(F.struct(F.length("holder").alias("n"), "holder", "given")).alias("m")))
    nearest = stage(nearest.select(F.col("dir").alias("_dir"), "m.holder", "m.given"), "licence-nearest")
    own = F.col("licence").isNotNull()
    j = f.join(nearest, (F.col("dir") == F.col("_dir")) & F.col("path").isNotNull(), "left")
    return j.select("id", "path", "licence", "cosine", "is_licence_file",
                    F.coalesce("licence", "given").alias("effective"),
                    F.when(~own, F.col("holder")).alias("inherited_from"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files of a tree. The table has no paths; they are derived
    from it: ``source/lang/<block of 64 ids>/<id>``, and every second document
    with a licence (by its length) is a licence file, a third of them each at
    the level of the source, the language and the block."""
    docs = table(spark, sf_dir, "documents")
    found = scan_licences(docs).select(F.col("id").alias("_id"), F.col("row").alias("_row"), "licence", "cosine", "kind")
    d = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("row"), F.length("text").alias("n"))
    j = d.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    is_file = F.col("licence").isNotNull() & (F.col("n") % 2 == 0)
    low = F.concat_ws("/", "source", "lang", F.concat(F.lit("b"), F.floor(F.col("doc_id") / 64).cast("string")))
    level = F.col("n") % 3
    where = F.when(is_file & (level == 0), F.col("source")).when(is_file & (level == 1), F.concat_ws("/", "source", "lang")).otherwise(low)
    files = j.select(F.col("doc_id").alias("id"), F.concat(where, F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
                     "licence", "cosine", is_file.alias("is_licence_file"))
    return inherit(files).select(F.col("id").alias("doc_id"), "path", F.col("licence").alias("own_licence"),
                                 F.round("cosine", 6).alias("cosine"), "is_licence_file", "effective", "inherited_from")


QUERIES = {"op10_license_scan": op10_license_scan}
ORACLE: dict[str, str] = {}
