"""Licence scan by TF-IDF cosine and nearest-ancestor inheritance (operator 5).

Lines that speak of licensing are a file's notices. Each is a sparse TF-IDF vector of its own,
compared with templates by cosine; a file without a notice of its own takes the licence of
its nearest ancestor folder that has a licence file. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.session import materialize

#: Customary one-line notices, identifiers and opening lines of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("Proprietary", "All rights reserved"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT-0", "SPDX-License-Identifier: MIT-0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, license ISC"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("Zlib", "SPDX-License-Identifier: Zlib"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
)
NOTICE = r"(?i)licen[cs]e|spdx-|all rights reserved|permission is hereby granted|redistribution and use"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"


def _terms(text) -> F.Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def _templates(spark: SparkSession) -> DataFrame:
    """(template, licence, term, tf): a constant of the program, hence safe to broadcast."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(name).alias("licence"), F.lit(text).alias("text"))
        for i, (name, text) in enumerate(TEMPLATES)
    ])
    flat = spark.range(1).select(F.inline(rows))
    return flat.select("template", "licence", F.explode(_terms(F.col("text"))).alias("term")).groupBy(
        "template", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))


def notice_licences(files: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every licence that a file's notices name: `files` (path, text, ...) -> (path, licence, score).

    Every line of the whole text is looked at; a notice may stand anywhere, and each is scored by itself, so that
    neither prose about licences nor a second notice weakens one. Document frequencies count all notices. A
    licence has the score of its best notice and template, if that reaches `threshold`. Null texts, and
    texts without such a line, have no notice. Rows that share a path are one file with all their lines.

    The lines are few and narrow. They are written once: what follows reads them, and no text again.
    """
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(NOTICE))
    found = files.where(F.col("path").isNotNull()).select("path", F.explode(F.array_distinct(lines)).alias("notice")).distinct()
    notice = F.xxhash64("path", "notice").alias("line")
    tf = materialize(found.select("path", notice, F.explode(_terms(F.col("notice"))).alias("term")).groupBy("path", "line", "term").agg(
        F.count(F.lit(1)).alias("tf")), "licence-terms")
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = tf.select(F.count_distinct("line").alias("n")).scalar()

    def weigh(frame: DataFrame) -> DataFrame:
        """Terms of templates without any notice have df 0."""
        return frame.join(df, "term", "left").select(
            *frame.columns, (F.col("tf") * (F.log((1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0)).alias("w"))

    weighed, model = weigh(tf), weigh(_templates(files.sparkSession))
    norm = weighed.groupBy("path", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    model_norm = model.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("model_norm"))
    postings = model.join(model_norm, "template").select(
        "term", "template", "licence", (F.col("w") / F.col("model_norm")).alias("model_w"))
    # A row per term of a template: a constant of the program.
    dots = weighed.join(F.broadcast(postings), "term").groupBy("path", "line", "template", "licence").agg(
        F.sum(F.col("w") * F.col("model_w")).alias("dot"))
    scored = dots.join(norm, ["path", "line"]).select("path", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    return scored.groupBy("path", "licence").agg(F.max("score").alias("score")).where(F.col("score") >= threshold)


def notices(files: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Own licences per file: (path, own_licence, own_score, own_licences). The best is the own one, equal scores go to
    the first by name; `own_licences` lists all by name. A file is as many rows in here as it names licences, a
    number that the templates bound."""
    return notice_licences(files, threshold).groupBy("path").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b"), F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("own_licences"),
    ).select("path", F.col("b.licence").alias("own_licence"), (-F.col("b.s")).alias("own_score"), "own_licences")


def folder_of(path) -> F.Column:
    """The folder of a path; a path without a slash lies in the root ''."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherit(files: DataFrame, own: DataFrame) -> DataFrame:
    """Resolve each file's licence: `files` (path, is_licence_file), `own` from `notices`.

    Returns (path, own_licence, own_score, own_licences, licence, via, licence_folder) with via 'own',
    'inherited' or 'none'. The licence of a folder is that of its licence files, the first path winning.
    Ancestors are joined per folder, not per file: a folder is one row however many files it
    holds, and its ancestors are as many as its depth. Rows with a null path have no licence.
    """
    known = files.select("path", F.coalesce("is_licence_file", F.lit(False)).alias("is_licence_file"))
    with_own = known.where(F.col("path").isNotNull()).join(own, "path", "left").withColumn("folder", folder_of(F.col("path")))
    granted = with_own.where(F.col("is_licence_file") & F.col("own_licence").isNotNull()).groupBy("folder").agg(
        F.min(F.struct("path", "own_licence")).alias("g")).select(
            F.col("folder").alias("ancestor"), F.col("g.own_licence").alias("granted"))
    folders = with_own.select("folder").distinct()
    parts = F.split("folder", "/")
    climbs = folders.select("folder", F.explode(F.concat(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")),
        F.array(F.lit("")),
    )).alias("ancestor")).distinct()
    nearest = climbs.join(granted, "ancestor").groupBy("folder").agg(
        F.max(F.struct(F.length("ancestor").alias("depth"), "ancestor", "granted")).alias("n")).select(
            "folder", F.col("n.granted").alias("granted"), F.col("n.ancestor").alias("ancestor"))
    out = with_own.join(nearest, "folder", "left")
    mine = F.col("own_licence").isNotNull()
    resolved = out.select(
        "path", "own_licence", "own_score", "own_licences", F.coalesce("own_licence", "granted").alias("licence"),
        F.when(mine, "own").when(F.col("granted").isNotNull(), "inherited").otherwise("none").alias("via"),
        F.when(~mine, F.col("ancestor")).alias("licence_folder"))
    lost = known.where(F.col("path").isNull()).select(
        "path", F.lit(None).cast("string").alias("own_licence"), F.lit(None).cast("double").alias("own_score"),
        F.lit(None).cast("string").alias("own_licences"), F.lit(None).cast("string").alias("licence"), F.lit("none").alias("via"),
        F.lit(None).cast("string").alias("licence_folder"))
    return resolved.unionByName(lost)


def document_tree(docs: DataFrame) -> DataFrame:
    """Documents as files (doc_id, path, is_licence_file, text).

    A source is a repository; ids in groups of three digits are its folders (12345 of src1 is
    src1/12/345). A document that opens with a notice is a licence file of its folder.
    """
    groups = F.regexp_replace(F.col("doc_id").cast("string"), r"(?<=\d)(?=(?:\d{3})+$)", "/")
    first = F.split(F.coalesce("text", F.lit("")), "\n", 2)[0]
    return docs.select(
        "doc_id", F.concat_ws("/", F.coalesce("source", F.lit("unknown")), groups).alias("path"),
        first.rlike(NOTICE).alias("is_licence_file"), "text")


def scan_documents(docs: DataFrame) -> DataFrame:
    """The query's form: one row per file of `document_tree`, with its doc_id. Rows that share id and source are one file."""
    files = document_tree(docs)
    own = materialize(notices(files), "licence-notices")
    marks = files.groupBy("doc_id", "path").agg(F.max("is_licence_file").alias("is_licence_file"))
    ids = files.select("doc_id", "path").distinct()
    return ids.join(inherit(marks, own), "path", "left")


_LINES = " UNION ALL ".join(f"SELECT {i} AS template, '{n}' AS licence, '{t}' AS text" for i, (n, t) in enumerate(TEMPLATES))
#: DuckDB form of the registered query.
SQL = rf"""
WITH f AS (SELECT doc_id, text, coalesce(source, 'unknown') || '/' || CASE
      WHEN doc_id >= 1000000 THEN (doc_id // 1000000) || '/' || lpad(CAST(doc_id // 1000 % 1000 AS VARCHAR), 3, '0') || '/' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0')
      WHEN doc_id >= 1000 THEN (doc_id // 1000) || '/' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0')
      ELSE CAST(doc_id AS VARCHAR) END AS path,
      regexp_matches(split_part(coalesce(text, ''), chr(10), 1), '{NOTICE}') AS is_licence_file FROM documents),
l AS (SELECT DISTINCT path, unnest(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{NOTICE}'))) AS notice FROM f),
tf AS (SELECT path, notice, term, count(*) AS tf FROM (SELECT path, notice, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM l) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT path, notice FROM tf)),
t AS ({_LINES}),
tt AS (SELECT template, licence, term, count(*) AS tf FROM (SELECT template, licence, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM t) GROUP BY ALL),
w AS (SELECT path, notice, tf.term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w FROM tf JOIN df USING (term), n),
m AS (SELECT template, licence, tt.term, tf * (ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0) AS w FROM tt LEFT JOIN df USING (term), n),
wn AS (SELECT path, notice, sqrt(sum(w * w)) AS norm FROM w GROUP BY path, notice),
mn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM m GROUP BY template),
s AS (SELECT w.path, m.licence, round(sum(w.w * m.w / mn.norm) / any_value(wn.norm), 6) AS score
      FROM w JOIN m USING (term) JOIN mn USING (template) JOIN wn USING (path, notice) GROUP BY w.path, w.notice, m.template, m.licence),
x AS (SELECT path, licence, max(score) AS score FROM s GROUP BY path, licence HAVING max(score) >= 0.5),
o AS (SELECT path, arg_min(licence, (-score, licence)) AS own_licence, max(score) AS own_score, string_agg(licence, ',' ORDER BY licence) AS own_licences
      FROM x GROUP BY path),
a AS (SELECT f.doc_id, f.path, f.is_licence_file, own_licence, own_score, own_licences, regexp_extract(f.path, '^(.*)/[^/]*$', 1) AS folder FROM f LEFT JOIN o USING (path)),
g AS (SELECT folder, arg_min(own_licence, path) AS granted FROM a WHERE is_licence_file AND own_licence IS NOT NULL GROUP BY folder),
c AS (SELECT x.folder, arg_max(g.granted, length(g.folder)) AS granted, arg_max(g.folder, length(g.folder)) AS anc
      FROM (SELECT DISTINCT folder FROM a) x JOIN g ON x.folder = g.folder OR starts_with(x.folder, g.folder || '/') GROUP BY x.folder)
SELECT doc_id, path, own_licence, own_score, own_licences, coalesce(own_licence, granted) AS licence,
  CASE WHEN own_licence IS NOT NULL THEN 'own' WHEN granted IS NOT NULL THEN 'inherited' ELSE 'none' END AS via,
  CASE WHEN own_licence IS NULL THEN anc END AS licence_folder
FROM a LEFT JOIN c USING (folder)
"""
