"""Licences of files: TF-IDF cosine of their headers to templates, and inheritance from the nearest directory above."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorespark.session import materialize

THRESHOLD = 0.6
TOKEN = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
CUE = r"(?i)licen[cs]|copyright|spdx|public domain|permission is hereby|creative commons|all rights reserved|warrant"
LICENCE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice|unlicense)[^/]*$"

# The wording of common notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain under the CC0 1.0 Universal dedication."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def template_vectors(templates=TEMPLATES) -> tuple[list[tuple[int, str, str, float]], dict[str, float], float]:
    """(template, licence, token, weight) of unit length, the idf of every template token, and that of any other token."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = [Counter(re.findall(TOKEN, text.translate(lower))) for _, text in templates]
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in df.items()}
    rows = []
    for k, ((licence, _), c) in enumerate(zip(templates, counts, strict=True)):
        weights = {t: (1 + math.log(n)) * idf[t] for t, n in c.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(k, licence, t, w / length) for t, w in weights.items()]
    return rows, idf, math.log(1 + len(templates)) + 1


def passages(text: Column) -> Column:
    """The whole text, its paragraphs and its lines, as far as they have a word that licences have."""
    cued = lambda parts: F.filter(parts, lambda p: F.regexp_like(p, F.lit(CUE)))
    return F.array_distinct(F.concat(cued(F.array(text)), cued(F.split(text, r"\n[ \t\r]*\n")), cued(F.split(text, "\n"))))


def passage_licences(spark: SparkSession, texts: DataFrame, *, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """(key, licence, cosine) of the distinct passages (key, passage) that are close enough to a template; ties go to the first name."""
    rows, idf, other = template_vectors(templates)
    vectors = spark.createDataFrame(rows, "template int, licence string, token string, weight double")
    known = spark.createDataFrame(list(idf.items()), "token string, idf double")
    tokens = texts.select("key", F.explode(F.regexp_extract_all(ascii_lower(F.col("passage")), F.lit(f"({TOKEN})"), F.lit(1))).alias("token"))
    counted = tokens.groupBy("key", "token").count()
    weighed = counted.join(F.broadcast(known), "token", "left").select(
        "key", "token", ((1 + F.log("count")) * F.coalesce("idf", F.lit(other))).alias("w")
    )
    # One row per token of all templates: the table is a constant of this module.
    per_token = vectors.groupBy("token").agg(F.collect_list(F.struct("template", "licence", "weight")).alias("of"))
    both = weighed.join(F.broadcast(per_token), "token", "left")
    lengths = both.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = both.select("key", "w", F.explode("of").alias("t")).groupBy("key", "t.template", "t.licence").agg(F.sum(F.col("w") * F.col("t.weight")).alias("dot"))
    scored = dots.join(lengths, "key").select("key", "licence", F.round(F.col("dot") / F.col("length"), 6).alias("cosine")).where(F.col("cosine") >= threshold)
    best = scored.groupBy("key").agg(F.max("cosine").alias("top"))
    return scored.join(best, "key").where("cosine = top").groupBy("key").agg(F.min("licence").alias("licence"), F.first("cosine").alias("cosine"))


def file_licences(
    files: DataFrame,
    *,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    is_notice: Column | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, licence, cosine, how, directory) of every row of ``files``; runs jobs while it is built.

    A file's own licence is the closest template of any of its passages.  A file
    that is a notice (by default one named so, or one whose whole text matches)
    gives its licence to its directory; of several the closest counts, then the
    first name.  A file without a licence of its own inherits that of the nearest
    directory above it that has one.  how is own, inherited or none.

    Passages repeat in very many files, so distinct ones are scored once.
    Directories are joined to their ancestors before files are: a directory of
    very many files is one row until the last join.

    Null and empty texts have no licence of their own, a null path has no directory; a null
    id stays; repeated rows each get a row; other columns are not read; no rows give none.
    """
    spark = files.sparkSession
    path = F.col(path_col)
    folder = F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))
    notice = F.coalesce(is_notice if is_notice is not None else F.regexp_like(path, F.lit(LICENCE_NAMES)), F.lit(False))
    rows = files.select(F.col(id_col).alias("id"), path.alias("path"), folder.alias("folder"), notice.alias("notice"), F.col(text_col).alias("text"))
    rows = rows.withColumn("passages", F.when(F.regexp_like("text", F.lit(CUE)), passages(F.col("text"))).otherwise(F.array().cast("array<string>")))
    whole = F.sha2("text", 256)
    slim = rows.select(
        "id", "folder", "notice", F.monotonically_increasing_id().alias("row"), "passages", F.when(F.size("passages") > 0, whole).alias("whole")
    )
    slim = materialize(slim, "files")
    found = slim.select("row", "folder", "notice", "whole", F.explode("passages").alias("passage")).withColumn("key", F.sha2("passage", 256))
    distinct = found.groupBy("key").agg(F.first("passage").alias("passage"))
    scores = materialize(passage_licences(spark, distinct, threshold=threshold), "passages")
    hits = found.drop("passage").join(scores, "key")
    rank = F.struct(-F.col("cosine"), F.col("licence"))
    own = hits.groupBy("row").agg(
        F.min(rank).alias("best"), F.first("folder").alias("folder"), F.max(F.col("notice") | (F.col("whole") == F.col("key"))).alias("notice")
    )
    own = materialize(own.select("row", "folder", "notice", F.col("best.licence").alias("licence"), (-F.col("best.col1")).alias("cosine")), "own")
    of_folder = own.where("notice AND folder IS NOT NULL").groupBy("folder").agg(F.min(rank).alias("best"))
    of_folder = of_folder.select(F.col("folder").alias("directory"), F.col("best.licence").alias("inherited"), (-F.col("best.col1")).alias("by"))
    folders = slim.select("folder").where("folder IS NOT NULL").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    above = F.array_distinct(F.when(F.col("folder") == "", F.array(F.lit(""))).otherwise(above))
    steps = folders.select("folder", F.posexplode(above).alias("depth", "directory"))
    nearest = steps.join(of_folder, "directory").groupBy("folder").agg(F.max(F.struct("depth", "directory", "inherited", "by")).alias("n"))
    nearest = materialize(nearest.select("folder", "n.directory", "n.inherited", "n.by"), "inherited")
    placed = slim.select("id", "row", "folder").join(own.select("row", "licence", "cosine"), "row", "left").join(nearest, "folder", "left")
    mine = F.col("licence").isNotNull()
    return placed.select(
        F.col("id").alias(id_col),
        F.coalesce("licence", "inherited").alias("licence"),
        F.when(mine, F.col("cosine")).otherwise(F.col("by")).alias("cosine"),
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("how"),
        F.when(~mine, F.col("directory")).alias("directory"),
    )
