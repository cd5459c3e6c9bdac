"""Licence scans: TF-IDF cosine to templates, then inheritance from ancestor directories.

1. Candidates. A line of a text that holds a cue of licence wording (CUES), by
   itself and joined with the line before it, after it and both, is a header
   candidate. A licence file (named LICENSE, LICENCE, COPYING, NOTICE or
   UNLICENSE, with any ending) also gives its first one, two and three lines as
   titles and its whole text. Equal candidates are one vector, so a line that a
   third of all files share is matched once.
2. Match. Candidates and templates of their kind are sparse TF-IDF vectors, joined
   on terms and summed to cosines. Document frequencies of all template terms are
   counted over all files; a term that no template has counts as rare as the
   rarest template term, so wording that fits no template lowers the cosine.
   A whole text at MIN_WHOLE or more decides; else the best header or title at
   MIN_COSINE or more is the file's licence. Where the conditions of two clauses
   are found in headers and the third one too, it is BSD-3-Clause.
3. Inheritance. A licence file sets the licence of its directory. Files without
   a licence of their own take that of the nearest ancestor directory that has
   one, by joins of every directory's ancestor paths.

Only DataFrame functions. Null texts have no header, null paths inherit
nothing; ties go to the first template id; a directory with several licence
files takes the best cosine. Rows repeated in full stay repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, text_key

MIN_COSINE = 0.6
MIN_WHOLE = 0.8
#: A text without any of these has no licence header.
CUES = ("licen", "copyright", "spdx", "warrant", "public domain", "all rights reserved", "redistribut", "unlicense",
        "hereby granted", "endorse or promote", "free software")
LICENCE_FILE = r"(?i)^(un)?licen[sc]e|^copying|^notice"

#: Wording of licence headers (fixed values).
TEMPLATES = (
    ("AGPL-3.0", "licensed under the gnu affero general public license version 3"),
    ("AGPL-3.0", "this work is licensed under the gnu affero general public license, version 3"),
    ("Apache-2.0", "licensed under the apache license, version 2.0"),
    ("Apache-2.0", "licensed under the apache license, version 2.0 you may not use this file except in compliance with the license"),
    ("Apache-2.0", "spdx-license-identifier apache-2.0"),
    ("BSD-2-Clause", "licensed under the bsd 2-clause license"),
    ("BSD-3-Clause", "licensed under the bsd 3-clause license"),
    ("BSD-3-Clause", "use of this source code is governed by a bsd-style license that can be found in the license file"),
    ("BSD-2-Clause", "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC-BY-4.0", "licensed under cc by 4.0"),
    ("CC-BY-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("CC-BY-SA-4.0", "licensed under cc by-sa 4.0"),
    ("CC-BY-SA-4.0", "this work is licensed under a creative commons attribution-sharealike 4.0 international license"),
    ("CC-BY-NC-4.0", "licensed under cc by-nc 4.0"),
    ("CC-BY-NC-4.0", "this work is licensed under a creative commons attribution-noncommercial 4.0 international license"),
    ("CC-BY-ND-4.0", "licensed under cc by-nd 4.0"),
    ("CC0-1.0", "released under cc0 1.0 universal public domain dedication"),
    ("EPL-2.0", "this program is made available under the terms of the eclipse public license 2.0"),
    ("GPL-2.0", "this work is licensed under the gnu general public license, version 2"),
    ("GPL-3.0", "this work is licensed under the gnu general public license, version 3"),
    ("GPL-3.0", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license version 3"),
    ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license"),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license"),
    ("ISC", "released under the isc license"),
    ("LGPL-3.0", "this work is licensed under the gnu lesser general public license, version 3"),
    ("MIT", "released under the mit license"),
    ("MIT", "licensed under the mit license"),
    ("MIT", "spdx-license-identifier mit"),
    ("MIT", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "this source code form is subject to the terms of the mozilla public license, v. 2.0"),
    ("Proprietary", "copyright all rights reserved"),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
)
#: First lines of licence files (fixed values).
TITLES = (
    ("AGPL-3.0", "gnu affero general public license version 3, 19 november 2007"),
    ("Apache-2.0", "apache license version 2.0, january 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "bsd 2-clause license"),
    ("BSD-3-Clause", "bsd 3-clause license"),
    ("CC-BY-4.0", "creative commons attribution 4.0 international public license"),
    ("CC-BY-SA-4.0", "creative commons attribution-sharealike 4.0 international public license"),
    ("CC0-1.0", "creative commons legal code cc0 1.0 universal"),
    ("EPL-2.0", "eclipse public license - v 2.0"),
    ("GPL-2.0", "gnu general public license version 2, june 1991"),
    ("GPL-3.0", "gnu general public license version 3, 29 june 2007"),
    ("ISC", "isc license"),
    ("LGPL-2.1", "gnu lesser general public license version 2.1, february 1999"),
    ("LGPL-3.0", "gnu lesser general public license version 3, 29 june 2007"),
    ("MIT", "mit license"),
    ("MIT", "the mit license (mit)"),
    ("MPL-2.0", "mozilla public license version 2.0"),
)
_MIT_GRANT = (
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the software), to deal in the software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit "
    "persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the software. ")
_MIT_WARRANTY = (
    "the software is provided as is, without warranty of any kind, express or implied, including but not limited to the "
    "warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall the authors or "
    "copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or "
    "otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.")
_BSD_TWO = (
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_BSD_THIRD = (
    "3. neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_WARRANTY = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties, "
    "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed. in no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, "
    "special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or "
    "services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, "
    "whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use "
    "of this software, even if advised of the possibility of such damage.")
#: Whole texts of the short licences (fixed values).
WHOLE = (
    ("BSD-2-Clause", _BSD_TWO + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THIRD + _BSD_WARRANTY),
    ("ISC", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. the software "
            "is provided as is and the author disclaims all warranties with regard to this software including all implied "
            "warranties of merchantability and fitness. in no event shall the author be liable for any special, direct, "
            "indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether "
            "in an action of contract, negligence or other tortious action, arising out of or in connection with the use or "
            "performance of this software."),
    ("MIT", _MIT_GRANT + _MIT_WARRANTY),
    ("Unlicense", "this is free and unencumbered software released into the public domain. anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means. in jurisdictions that recognize "
                  "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
                  "software to the public domain. we make this dedication for the benefit of the public at large and to the "
                  "detriment of our heirs and successors. we intend this dedication to be an overt act of relinquishment in "
                  "perpetuity of all present and future rights to this software under copyright law. " + _MIT_WARRANTY),
)
#: What lies between terms: all but letters, digits, and one '.' or '-' between two of them.
#: A split without repeated groups: Java matches those by recursion, as deep as the text is long.
_BETWEEN = "[^a-z0-9.-]+|[.-]+(?![a-z0-9])|(?<![a-z0-9])[.-]+"


def _terms(text) -> F.Column:
    return F.filter(F.split(F.lower(text), _BETWEEN), lambda t: t != "")


def _templates(spark: SparkSession) -> DataFrame:
    every = [(kind, i, t) for kind, known in (("header", TEMPLATES), ("title", TITLES), ("whole", WHOLE)) for i, t in known]
    return spark.createDataFrame([(k, *x) for k, x in enumerate(every)], "template int, kind string, license string, text string")


def _weights(rows: DataFrame, idf: DataFrame, rare: float, key: str) -> DataFrame:
    """key, kind, term, w (unit length) of the rows' texts; terms that idf lacks weigh ``rare``."""
    tf = rows.select(key, "kind", F.explode(_terms("text")).alias("term")).groupBy(key, "kind", "term").agg(F.count("*").alias("tf"))
    w = tf.join(F.broadcast(idf), "term", "left").select(
        key, "kind", "term", (F.col("tf") * F.coalesce("idf", F.lit(rare))).alias("w"))
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, key).select(key, "kind", "term", (F.col("w") / F.col("norm")).alias("w"))


def _idf(files: DataFrame, templates: DataFrame) -> DataFrame:
    """term, idf of every template term, from its document frequency over all files."""
    vocabulary = sorted({r.term for r in templates.select(F.explode(_terms("text")).alias("term")).collect()})  # fixed size
    known = F.array(*[F.lit(t) for t in vocabulary])
    found = files.select(F.explode(F.array_intersect(F.split(F.lower("text"), "[^a-z0-9.-]+|[.-]+(?![a-z0-9])"), known)).alias("term"))
    df = found.groupBy("term").agg(F.count("*").alias("df"))
    every = files.sparkSession.createDataFrame([(t,) for t in vocabulary], "term string")
    n = files.count()
    return every.join(df, "term", "left").select(
        "term", (F.log(F.lit(n + 1.0) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf"))


def _segments(files: DataFrame) -> DataFrame:
    """doc_id, text_key, kind, text of all candidates."""
    cue = " OR ".join(f"contains(low, '{c}')" for c in CUES)
    low = files.select("doc_id", "text_key", "licence_file", F.lower("text").alias("low"))
    lines = F.split("low", "\n")
    some = low.filter(cue).select("doc_id", "text_key", lines.alias("lines"))
    around = some.select("doc_id", "text_key", F.explode(F.arrays_zip(
        F.col("lines").alias("low"), F.concat(F.array(F.lit(None).cast("string")), F.slice("lines", F.lit(1), F.size("lines") - 1)).alias("before"),
        F.slice("lines", 2, F.size("lines")).alias("after"))).alias("p")).select(
        "doc_id", "text_key", "p.low", "p.before", "p.after").filter(cue)
    headers = around.select("doc_id", "text_key", F.lit("header").alias("kind"), F.explode(F.array(*[
        F.trim(F.concat_ws(" ", *c)) for c in (["low"], ["low", "after"], ["before", "low"], ["before", "low", "after"])])).alias("text"))
    full = F.filter(lines, lambda x: F.trim(x) != "")
    whole = low.filter("licence_file AND low <> ''").select("doc_id", "text_key", F.explode(F.concat(
        F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda k: F.struct(
            F.lit("title").alias("kind"), F.array_join(F.slice(full, F.lit(1), k), " ").alias("text"))),
        F.array(F.struct(F.lit("whole").alias("kind"), F.col("low").alias("text"))))).alias("s"))
    return headers.union(whole.select("doc_id", "text_key", "s.kind", "s.text")).distinct()


def matches(files: DataFrame) -> DataFrame:
    """doc_id, text_key, license, cosine of each file that matches a template.

    files: doc_id, text_key, text, licence_file (whether its name is that of a licence file).
    """
    spark = files.sparkSession
    templates = _templates(spark)
    idf = saved(_idf(files, templates), "license-idf")
    rare = idf.agg(F.max("idf")).first()[0]
    segments = saved(_segments(files).withColumn("segment", F.xxhash64("kind", "text")), "license-segments")
    unique = segments.select("segment", "kind", "text").distinct()
    own = _weights(unique, idf, rare, "segment")
    known = _weights(templates, idf, rare, "template").withColumnRenamed("w", "v")
    scores = own.join(F.broadcast(known), ["kind", "term"]).groupBy("segment", "template").agg(
        F.sum(F.col("w") * F.col("v")).alias("cosine")).join(F.broadcast(templates.select("template", "kind", "license")), "template")
    least = F.when(F.col("kind") == "whole", F.lit(MIN_WHOLE)).otherwise(F.lit(MIN_COSINE))
    best = scores.filter(F.col("cosine") >= least).groupBy("segment").agg(F.min(F.struct(
        (F.col("kind") != "whole").alias("part"), (-F.round("cosine", 9)).alias("c"), "license")).alias("b"))
    found = segments.select("doc_id", "text_key", "segment").join(best, "segment").groupBy("doc_id", "text_key").agg(
        F.min("b").alias("b"), F.max((F.col("b.license") == "BSD-3-Clause") & F.col("b.part")).alias("third"))
    return found.select(
        "doc_id", "text_key", F.when(F.col("third") & F.col("b.part") & (F.col("b.license") == "BSD-2-Clause"), "BSD-3-Clause").otherwise(
            F.col("b.license")).alias("license"), (-F.col("b.c")).alias("cosine"))


def licenses(files: DataFrame) -> DataFrame:
    """doc_id, path, license, cosine, via ('header', 'directory' or null) and from_dir of each row.

    files: doc_id, path, text. Directories are the path's parts before the last, '/' at its start or doubled counts for nothing.
    """
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"),
                        F.col("text").cast("string").alias("text")).withColumn("text_key", text_key()).withColumn(
        "base", F.try_element_at(parts, F.lit(-1)))
    by_name = F.coalesce(F.col("base").rlike(LICENCE_FILE), F.lit(False))
    matched = saved(matches(rows.select("doc_id", "text_key", "text", by_name.alias("licence_file"))), "license-headers").withColumnsRenamed(
        {"doc_id": "m_id", "text_key": "m_key"})
    named = rows.select("doc_id", "text_key", "path", F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), "/").alias("dir"),
                        "base")
    own = saved(named.join(matched, named["doc_id"].eqNullSafe(matched["m_id"]) & (named["text_key"] == matched["m_key"]),
                           "left").select("doc_id", "path", "dir", "base", "license", "cosine"), "license-own")
    set_by = own.filter(F.col("base").rlike(LICENCE_FILE) & F.col("license").isNotNull()).groupBy("dir").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")).select(
        F.col("dir").alias("from_dir"), F.col("b.license").alias("dir_license"))
    dirs = own.filter("license IS NULL AND path IS NOT NULL").select("dir").distinct()
    steps = F.filter(F.split("dir", "/"), lambda x: x != "")
    ancestors = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(steps, F.lit(1), k), "/").alias("from_dir")))).alias("a")).select("dir", "a.*")
    nearest = ancestors.join(set_by, "from_dir").groupBy("dir").agg(
        F.max(F.struct("depth", "from_dir", "dir_license")).alias("n")).select(
        F.col("dir").alias("in_dir"), F.col("n.from_dir").alias("from_dir"), F.col("n.dir_license").alias("dir_license"))
    return own.join(nearest, (own["dir"] == nearest["in_dir"]) & own["license"].isNull(), "left").select(
        "doc_id", "path", F.coalesce("license", "dir_license").alias("license"), "cosine",
        F.when(F.col("license").isNotNull(), "header").when(F.col("dir_license").isNotNull(), "directory").alias("via"),
        F.when(F.col("license").isNull(), F.col("from_dir")).alias("from_dir"))
