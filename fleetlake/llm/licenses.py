"""License scans: sparse TF-IDF cosine to templates, inheritance by folders.

Every licence has several templates: short notices, SPDX identifiers, the
header for source files and the full text. Header units of a document are its
lines, its paragraphs and overlapping windows of ``WINDOWS`` terms (so a notice
inside a paragraph, or wrapped over lines, has a unit of about its own size);
the whole document is the unit of a licence file. A term weighs
(1 + ln count) times its inverse document frequency, which comes from all
documents; a unit has a template's licence where the cosine reaches the
threshold, and the best template decides. A document without a header of its
own inherits the licence of its nearest ancestor folder that has one, found by
a join of folder paths.

Only units that hold a heavy term of some template are weighed: the terms that
are not heavy (the most frequent ones) together have less than threshold^2 of a
template's squared length, so a unit without a heavy term stays below the
threshold (Cauchy-Schwarz) and nothing is lost. DataFrame operations only.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import text_or_empty, written

THRESHOLD = 0.6

#: (terms, stride) of the header windows; a stride divides its terms.
WINDOWS = ((5, 1), (8, 2), (12, 3), (20, 5))
#: Terms of a long text that are cut into windows at a time (any multiple of the strides).
CHUNK = 960

#: Says nothing about the terms of use where a document also has another notice.
GENERIC = "Proprietary"

# Customary short notices of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}

# The headers that the licences give for source files.
HEADERS = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation; either version 2 of the License, "
               "or (at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, "
               "or (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           'documentation files (the "Software"), to deal in the Software without restriction',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

# SPDX identifiers.
SPDX = {
    "Apache-2.0": ("Apache-2.0",),
    "BSD-3-Clause": ("BSD-3-Clause",),
    "CC-BY-4.0": ("CC-BY-4.0",),
    "CC-BY-NC-4.0": ("CC-BY-NC-4.0",),
    "GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "GPL-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "MIT": ("MIT",),
    "MPL-2.0": ("MPL-2.0",),
}

#: Files whose header speaks for their folder.
FOLDER_FILES = r"(?i)(?:^|/)(?:licen[cs]e|copying|notice|readme)[^/]*$"

NOT_TERM = "[^a-z0-9]+"
PARAGRAPH = r"\n[^a-z0-9\n]*\n"
_SPDX = r"spdx-license-identifier:[ \t]*([a-z0-9]+)" + r"[.-]?([a-z0-9]*)" * 4


def full_texts() -> dict[str, str]:
    """The licences' full texts, stored beside this module."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licence_texts")
    out = {}
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out[name.removesuffix(".txt")] = f.read()
    return out


def forms(templates: dict[str, str] | None = None) -> list[tuple[str, bool, str]]:
    """(license, whole, body) of all templates; ``whole`` ones are compared
    with whole documents only. ``templates`` replaces them by notices."""
    if templates is not None:
        return [(name, False, body) for name, body in sorted(templates.items())]
    notices = [*TEMPLATES.items(), *HEADERS.items(),
               *((name, f"SPDX-License-Identifier: {i}") for name, ids in SPDX.items() for i in ids)]
    return [(n, False, b) for n, b in sorted(notices)] + [(n, True, b) for n, b in sorted(full_texts().items())]


def plain(text: Column) -> Column:
    """Lower case, an SPDX identifier made one term (``spdxapache20``)."""
    return F.regexp_replace(F.lower(text), _SPDX, " spdx$1$2$3$4$5 ")


def terms(text: Column) -> Column:
    """Runs of ASCII letters and digits of a :func:`plain` text."""
    return F.filter(F.split(text, NOT_TERM), lambda t: t != "")


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df): the number of documents that hold a term."""
    words = docs.select(F.explode(F.array_distinct(terms(plain(text_or_empty(text))))).alias("term"))
    return words.groupBy("term").agg(F.count("*").alias("df"))


def idf(df: Column, n: Column) -> Column:
    return F.log((1 + n.cast("double")) / (1 + df.cast("double"))) + 1


def tf_idf(tf: Column, df: Column, n: Column) -> Column:
    return (1 + F.log(tf.cast("double"))) * idf(df, n)


def template_vectors(spark: SparkSession, freq: DataFrame, n_docs: DataFrame,
                     forms_: list[tuple[str, bool, str]]) -> DataFrame:
    """(form, whole, term, weight, length, _below) of the templates, as many
    rows as they have terms. ``_below``: squared weights of the terms at least
    as frequent among the documents as this one."""
    rows = spark.createDataFrame([(i, w, b) for i, (_, w, b) in enumerate(forms_)], "form int, whole boolean, body string")
    tf = (rows.select("form", "whole", F.explode(terms(plain(F.col("body")))).alias("term"))
          .groupBy("form", "whole", "term").agg(F.count("*").alias("tf")))
    # the broadcast side is the templates' own terms; frequencies stay spread
    found = freq.join(F.broadcast(tf.select("term").distinct()), "term")
    w = (tf.join(found, "term", "left").join(F.broadcast(n_docs))  # one row
         .select("form", "whole", "term", F.coalesce("df", F.lit(0)).alias("df"),
                 tf_idf(F.col("tf"), F.coalesce("df", F.lit(0)), F.col("n")).alias("weight")))
    all_ = Window.partitionBy("form")
    frequent_first = all_.orderBy(F.col("df").desc(), "term").rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("weight") * F.col("weight")
    return w.select("form", "whole", "term", "weight", F.sqrt(F.sum(square).over(all_)).alias("length"),
                    F.sum(square).over(frequent_first).alias("_below"))


def header_units(texts: DataFrame, heavy: list[str]) -> DataFrame:
    """(_doc, unit, terms) of the lines, paragraphs and windows of ``texts``
    (_doc, _text) that hold one of the ``heavy`` terms."""
    heavy_ = F.lit(heavy)

    def cut(pattern, kind):
        parts = texts.select("_doc", F.posexplode(F.split("_text", pattern)).alias("at", "body"))
        return parts.select("_doc", (F.col("at").cast("long") * 8 + kind).alias("unit"), terms(F.col("body")).alias("terms")
                            ).where(F.arrays_overlap("terms", heavy_))

    words = texts.select("_doc", terms(F.col("_text")).alias("w")).where(F.size("w") > 0)
    longest = max(m for m, _ in WINDOWS)
    chunks = words.select("_doc", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("w") - 1, F.lit(CHUNK)),
        lambda i: F.struct(i.alias("at"), F.slice("w", i + 1, F.lit(CHUNK + longest - 1)).alias("w")))).alias("c")).where(
            F.arrays_overlap("c.w", heavy_))

    def cuts(kind, m, stride):
        starts = F.sequence(F.lit(0), F.least(F.lit(CHUNK), F.size("c.w")) - 1, F.lit(stride))
        return F.transform(starts, lambda s: F.struct((F.col("c.at") + s).cast("long").alias("at"), F.lit(kind).alias("kind"),
                                                      F.slice("c.w", s + 1, F.lit(m)).alias("terms")))

    kinds = [cuts(k, m, stride) for k, (m, stride) in enumerate(WINDOWS)]
    windows = chunks.select("_doc", F.explode(F.filter(F.concat(*kinds), lambda x: F.arrays_overlap(x["terms"], heavy_))).alias("u")
                            ).select("_doc", (F.col("u.at") * 8 + 2 + F.col("u.kind")).alias("unit"), "u.terms")
    return cut("\n", 0).unionByName(cut(PARAGRAPH, 1)).unionByName(windows)


def folder_of(path: Column) -> Column:
    """The folder of a path without slashes at its ends ('' is the root)."""
    return F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), r"^/+|/+$", "")


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text: str = "text",
         templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, ``folder``, ``license`` (null: none found),
    ``origin`` ('header', 'inherited' or 'none'), ``similarity`` of the unit
    that decided and ``from_folder`` of an inherited licence.

    The best template of a document's header units decides (equal cosines: the
    licence's name); ``GENERIC`` counts only where no other licence reaches the
    threshold. A folder's licence is the best of the whole documents in it that
    reach the threshold and of the headers of its ``FOLDER_FILES``. ``templates``
    (license -> notice) replaces the templates of :func:`forms`. Null text:
    empty, no header. Null path: no folder, nothing inherited. Repeated rows
    are judged each. Templates without a term are never reached. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    made = forms(templates)
    freq = written(document_frequencies(docs, text), "frequencies")
    n_docs = written(docs.agg(F.count("*").alias("n")), "ndocs")
    vectors = written(template_vectors(spark, freq, n_docs, made), "templates")
    heavy = vectors.where(F.col("_below") >= F.lit(threshold ** 2 * (1 - 1e-9)) * F.col("length") ** 2)
    # as many terms as the templates have, at most; letters and digits only
    found = heavy.groupBy("term").agg(F.bool_or(~F.col("whole")).alias("notice")).collect()
    every, notice = sorted(r.term for r in found), sorted(r.term for r in found if r.notice)
    rows = docs.select(F.col(id_col).alias("_id"), folder_of(path).alias("_folder"),
                       F.coalesce(path.rlike(FOLDER_FILES), F.lit(False)).alias("_speaks"),
                       plain(text_or_empty(text)).alias("_text"))
    has = F.arrays_overlap(terms(F.col("_text")), F.lit(every)) if every else F.lit(False)
    # row ids are fixed by the write; texts stay behind where no term is heavy
    base = written(rows.select("_id", "_folder", "_speaks", F.when(has, F.col("_text")).alias("_text"))
                   .withColumn("_doc", F.monotonically_increasing_id()), "scanned")
    texts = base.where("_text IS NOT NULL").select("_doc", "_text")
    units = texts.select("_doc", F.lit(-1).cast("long").alias("unit"), terms(F.col("_text")).alias("terms"))
    if notice:
        units = units.unionByName(header_units(texts, notice))
    tf = (units.select("_doc", "unit", F.explode("terms").alias("term"))
          .groupBy("_doc", "unit", "term").agg(F.count("*").alias("tf")))
    weighed = (tf.join(freq, "term").join(F.broadcast(n_docs))  # one row
               .select("_doc", "unit", "term", tf_idf(F.col("tf"), F.col("df"), F.col("n")).alias("w")))
    # one aggregation per unit: its length, and one product per template
    by_term = (vectors.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("form", "weight"))).alias("m"))
               .select("term", F.array(*[F.coalesce(F.element_at("m", F.lit(i)), F.lit(0.0)) for i in range(len(made))]).alias("ts")))
    near = weighed.join(F.broadcast(by_term), "term", "left")
    dots = [F.sum(F.coalesce(F.col("w") * F.get("ts", F.lit(i)), F.lit(0.0))).alias(f"dot{i}") for i in range(len(made))]
    unit = near.groupBy("_doc", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"), *dots)
    lengths = {r.form: r.length for r in vectors.select("form", "length").distinct().collect()}

    def best_of(names):
        all_ = [F.struct(F.lit(int(made[i][0] == GENERIC)).alias("generic"),
                         (-(F.col(f"dot{i}") / (F.col("length") * F.lit(lengths[i])))).alias("s"),
                         F.lit(made[i][0]).alias("license")) for i in names]
        return F.array_min(F.filter(F.array(*all_), lambda x: x["s"] <= F.lit(-threshold)))

    if not lengths:
        raise ValueError("no template holds a term")
    notices = [i for i in lengths if not made[i][1]]
    b = F.when(F.col("unit") < 0, best_of(list(lengths)))
    if notices:
        b = b.otherwise(best_of(notices))
    best = unit.select("_doc", "unit", b.alias("b")).where("b IS NOT NULL")
    best = written(best.groupBy("_doc").agg(F.min(F.when(F.col("unit") >= 0, F.col("b"))).alias("h"),
                                            F.min(F.when(F.col("unit") < 0, F.col("b"))).alias("w")), "best")
    header = best.where("h IS NOT NULL").select("_doc", "h")
    speaks = F.when(F.col("_speaks") & F.col("h").isNotNull(), F.least(F.coalesce("w", "h"), F.col("h"))).otherwise(F.col("w"))
    files = (best.join(base.select("_doc", "_folder", "_speaks"), "_doc").withColumn("_f", speaks)
             .where("_folder IS NOT NULL AND _f IS NOT NULL").groupBy("_folder").agg(F.min("_f").alias("f")))
    files = written(files.withColumnRenamed("_folder", "_at"), "files")
    depth = F.when(F.col("_folder") == "", 0).otherwise(F.size(F.split("_folder", "/")))
    deepest = files.withColumnRenamed("_at", "_folder").agg(F.max(depth).alias("_most"))  # one row
    folders = base.select("_folder").where("_folder IS NOT NULL").distinct().join(F.broadcast(deepest))
    above = folders.select("_folder", F.explode(F.transform(
        F.sequence(F.lit(0), F.least(depth, F.col("_most"))),
        lambda i: F.struct(i.alias("depth"), F.when(i == 0, "").otherwise(
            F.array_join(F.slice(F.split("_folder", "/"), F.lit(1), F.greatest(i, F.lit(1))), "/")).alias("at")))).alias("a"))
    nearest = (above.select("_folder", "a.depth", F.col("a.at").alias("_at")).join(files, "_at")
               .groupBy("_folder").agg(F.max_by(F.struct("f", "_at"), "depth").alias("n")))
    nearest = written(nearest, "nearest")
    out = base.drop("_text", "_speaks").join(header, "_doc", "left").join(nearest, "_folder", "left")
    own, given = F.col("h").isNotNull(), F.col("n").isNotNull()
    return out.select(
        F.col("_id").alias(id_col), F.col("_folder").alias("folder"),
        F.coalesce("h.license", "n.f.license").alias("license"),
        F.when(own, "header").when(given, "inherited").otherwise("none").alias("origin"),
        F.round(-F.coalesce("h.s", "n.f.s"), 6).alias("similarity"),
        F.when(~own, F.col("n._at")).alias("from_folder"))


# ------------------------------------------------------- the driver's tables

def document_path(docs: DataFrame) -> Column:
    """Paths for documents, which have none: source, language, a project of
    1,024 neighbours by id and in it folders of 64. Every 16th id is a README
    of its project's folder, every 256th one of its language's."""
    i = F.col("doc_id")
    project = F.concat(F.lit("p"), F.expr("doc_id div 1024"))
    name = F.concat(i.cast("string"), F.lit(".txt"))
    readme = F.concat(F.lit("README-"), name)
    inside = F.when(i % 256 == 0, readme).when(i % 16 == 0, F.concat_ws("/", project, readme)).otherwise(
        F.concat_ws("/", project, F.concat(F.lit("d"), F.expr("doc_id div 64")), name))
    return F.concat_ws("/", F.col("source"), F.col("lang"), inside)
