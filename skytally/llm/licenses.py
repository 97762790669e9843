"""Licence scans: lines against templates by sparse TF-IDF cosine, then inheritance down the directory tree.

A file is cut into lines. Terms are lower-cased runs of letters and digits, weighted by ``(1 + ln tf) * ln(1 + N / df)``
with document frequencies over all lines, counted for all terms in one pass. A line's licence is the template with the greatest cosine, ``COSINE`` at least. A line can only
reach that if it shares one of a template's heaviest terms: those without which the rest of its
vector is shorter than ``COSINE``. Lines without such a term are never compared, and lines of one text are compared once.

A file's own licence is that of its best line. A licence file (by name, or the index of a directory, whose path
ends in a slash) that has one gives it to its directory. A file without its own inherits from the nearest
directory above it that has one: distinct directories are joined with their ancestors first, so a
directory with a third of all files is one row there.

Broadcast are templates and their terms, bounded by the list given, and the document frequencies of the ``HOT_TERMS`` most
frequent terms at most; the others' are joined by a shuffle. A null or empty text has no lines, a null
path no directories. Equal scores go to the first template by name, several licence files of a directory to the best score,
then the first name. Repeated rows and repeated ids are files of their own, found by their path and text. Other columns are kept by
:func:`scanned`.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import saved

COSINE = 0.7
HOT_TERMS = 1 << 16
# Customary notices and the openings of licence texts.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}
LICENCE_FILE = r"(?i)(?:^|/)(?:licen[cs]e|copying|copyright|notice|unlicense)(?:[.-][^/]*)?$"


def _terms(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def _vectors(df: dict[str, int], n: int, templates: dict) -> tuple[list[tuple[str, str, float]], list[str]]:
    """(template, term, weight over the template's norm) rows, and terms one of which any matching line has."""
    rows, needed = [], set()
    for name, texts in templates.items():
        for i, text in enumerate(texts):
            weight = {t: (1 + math.log(c)) * math.log(1 + n / max(1, df.get(t, 0))) for t, c in Counter(_terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in weight.values())) or 1.0
            rows += [(f"{name}\t{i}", t, w / norm) for t, w in sorted(weight.items())]
            left = norm * norm
            for t, w in sorted(weight.items(), key=lambda x: (-x[1], x[0])):
                if math.sqrt(max(left, 0)) / norm < COSINE - 1e-9:
                    break
                needed.add(t)
                left -= w * w
    return rows, sorted(needed)


def _weighted(each: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """``line, term, w`` of ``each`` (line, term, tf), whose terms are all in ``counts`` (term, df, grade)."""
    least, total = 0, 0
    for grade, size in sorted(counts.groupBy("grade").count().collect(), reverse=True):  # 8 * 63 rows at most
        if total + size > HOT_TERMS:
            least = grade + 1
            break
        total += size
    frequent = F.broadcast(counts.filter(F.col("grade") >= least).select("term", "df"))
    rare = counts.filter(F.col("grade") < least).select("term", "df")
    known = each.join(frequent, "term").unionByName(each.join(frequent, "term", "left_anti").join(rare, "term"))
    idf = F.log(1 + F.lit(float(n)) / F.col("df"))
    return known.select("line", "term", ((1 + F.log(F.col("tf").cast("double"))) * idf).alias("w"))


def matched(files: DataFrame, text: str, templates: dict = TEMPLATES) -> DataFrame:
    """``line, license, score`` for each distinct line that matches a template."""
    cut = files.select(F.explode(lines(F.col(text))).alias("line")).withColumn("terms", terms(F.col("line")))
    vocabulary = sorted({t for texts in templates.values() for x in texts for t in _terms(x)})
    counted = cut.select(F.explode(F.concat(F.array_distinct("terms"), F.array(F.lit("")))).alias("term"))
    counts = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    counts = saved(counts.withColumn("grade", F.floor(8 * F.log2(F.col("df").cast("double"))).cast("int")), "terms")
    # a row for each term of the templates, and one for all lines
    df = dict(counts.filter(F.col("term").isin([*vocabulary, ""])).select("term", "df").collect())
    n = df.pop("", 0)
    rows, needed = _vectors(df, n, templates)
    near = cut.filter(F.arrays_overlap("terms", F.array(*[F.lit(t) for t in needed]))).select("line", "terms").distinct()
    each = near.select("line", F.explode("terms").alias("term")).groupBy("line", "term").agg(F.count(F.lit(1)).alias("tf"))
    each = saved(_weighted(saved(each, "each"), counts.filter("term <> ''"), n), "weights")
    norms = each.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    vectors = files.sparkSession.createDataFrame(rows, "template string, term string, tw double")
    dots = each.join(F.broadcast(vectors), "term").groupBy("line", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = dots.join(norms, "line").withColumn("score", F.col("dot") / F.col("norm")).filter(F.col("score") >= COSINE)
    best = F.min(F.struct((-F.col("score")).alias("s"), F.split("template", "\t")[0].alias("license"))).alias("best")
    return scored.groupBy("line").agg(best).select("line", "best.license", (-F.col("best.s")).alias("score"))


def scanned(files: DataFrame, path: str = "path", text: str = "text", templates: dict = TEMPLATES) -> DataFrame:
    """``files`` with ``license``, ``origin`` (own or inherited), ``license_score`` and ``license_from``, the directory inherited from."""
    marks = saved(matched(files, text, templates), "lines")
    hits = files.select(F.col(path).alias("p"), F.explode(lines(F.col(text))).alias("line"), F.xxhash64(text).alias("t")).join(marks, "line")
    best = F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best")
    own = hits.groupBy("p", "t").agg(best).select("p", "t", F.col("best.license").alias("own"), (-F.col("best.s")).alias("score"))
    own = saved(own, "own")
    directory = lambda c: F.regexp_replace(c, "[^/]*$", "")
    givers = own.filter(F.col("p").isNotNull() & (F.regexp_like("p", F.lit(LICENCE_FILE)) | F.col("p").endswith("/")))
    given = givers.groupBy(directory(F.col("p")).alias("d")).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("own").alias("license"))).alias("best"))
    given = given.select("d", F.col("best.license").alias("inherited"))
    below = files.select(directory(F.col(path)).alias("own_dir")).filter("own_dir <> ''").distinct()
    parts = F.split(F.rtrim(F.col("own_dir"), F.lit("/")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
    nearest = (
        below.withColumn("d", F.explode(above)).join(given, "d").groupBy("own_dir")
        .agg(F.max_by(F.struct("d", "inherited"), F.length("d")).alias("near"))
        .select(F.col("own_dir").alias("__dir"), F.col("near.d").alias("__from"), F.col("near.inherited").alias("__inherited"))
    )
    own = own.select(F.col("p").alias("__p"), F.col("t").alias("__t"), F.col("own").alias("__own"), F.col("score").alias("__score"))
    found = files.join(own, F.col(path).eqNullSafe(F.col("__p")) & (F.xxhash64(text) == F.col("__t")), "left")
    found = found.join(nearest, directory(F.col(path)) == F.col("__dir"), "left")
    origin = F.when(F.col("__own").isNotNull(), "own").when(F.col("__inherited").isNotNull(), "inherited")
    return found.select(
        *files.columns, F.coalesce("__own", "__inherited").alias("license"), origin.alias("origin"), F.col("__score").alias("license_score"),
        F.when(F.col("__own").isNull(), F.col("__from")).alias("license_from"),
    )


def page_text(html: Column) -> Column:
    """Visible text of a page, a line for each run between tags."""
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*+>.*?</\1>|<!--.*?-->", "\n")
    shown = F.regexp_replace(shown, "<[^>]*+>", "\n")
    return F.replace(F.replace(F.replace(shown, F.lit("&nbsp;"), F.lit(" ")), F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))


def op5(pages: DataFrame) -> DataFrame:
    """The licence of every page, with the host and path of its address as the path."""
    path = F.regexp_replace(F.regexp_replace("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), "[?#].*$", "")
    files = pages.select("page_id", path.alias("path"), page_text(F.col("html")).alias("text"))
    return scanned(files).select("page_id", "path", "license", "origin", F.round("license_score", 9).alias("score"), "license_from")
