"""Operator 3: licence scans by sparse TF-IDF cosine and directory inheritance.

Units are the lines of files (headers) and whole licence files.  A unit and each
licence template are vectors of ``(1 + ln tf) * idf`` over lower-case terms (runs of
letters and digits), idf counted over all files for every term, also for those that
no template has and that count in a unit's length only.  A unit takes the template
of the largest cosine, if that is ``LEAST`` or more.

Only units that may reach that are joined: for each template its rarest terms are
taken until the others hold too little of its length to reach ``LEAST`` without
them, and a unit needs one of these key terms.  Unit terms are then joined with the
template terms (sparse product) and summed.

A directory's licence is the best one of the licence files in it.  A file without a
licence of its own takes that of its nearest ancestor directory: the distinct
directories (not files) are joined with the licensed ones on each ancestor's path,
the deepest stays, and files are joined to their directory.

DataFrame operations only.  Document frequencies are one aggregation over the terms
of all files, staged, and joined with the units' terms by term.  What the driver sees
is those of template terms and the templates, both bounded by the templates.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

LEAST = 0.6
#: Notices by licence.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
_SPLIT = r"[^\p{L}\p{N}]+"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda t: t != "")


def _template_vectors(templates, df: dict[str, int], total: int):
    """``(licence, term, weight / length)`` rows, and key terms."""
    idf = lambda n: math.log((total + 1) / (n + 1)) + 1
    weights: dict[str, dict[str, float]] = defaultdict(dict)
    for name, text in templates:
        for term, tf in Counter(re.findall(r"[^\W_]+", text.lower())).items():
            weights[name][term] = (1 + math.log(tf)) * idf(df.get(term, 0))
    rows, keys = [], set()
    for name, w in weights.items():
        length = math.sqrt(sum(x * x for x in w.values()))
        rows += [(name, term, x / length) for term, x in w.items()]
        rest = 1.0
        for term, x in sorted(w.items(), key=lambda kv: (-kv[1], kv[0])):
            if rest < LEAST * LEAST:
                break
            keys.add(term)
            rest -= (x / length) ** 2
    return rows, sorted(keys)


def _literal_rows(spark, rows, names) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names, strict=True))) for row in rows))))


def scan(files: DataFrame, templates=TEMPLATES, license_file: Column | None = None) -> DataFrame:
    """``(path, license, score, inherited, inherited_from)`` for every distinct path
    of ``files`` (columns ``path`` and ``text``; others are ignored): the licence
    of the file's own units and its cosine, and, where it has none, the licence of
    the nearest ancestor directory that has one.  ``license_file`` says which rows
    are licence files (default: by name).  Null paths are files of no name in the
    root, null texts are empty, rows with one path are one file."""
    spark = files.sparkSession
    license_file = F.col("path").rlike(LICENSE_FILE) if license_file is None else license_file
    base = files.select(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = sorted({t for _, text in templates for t in re.findall(r"[^\W_]+", text.lower())})
    present = base.select(F.explode(F.concat(F.array_distinct(_terms(F.col("text"))), F.array(F.lit("")))).alias("term"))
    counts = stage(present.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "document-frequencies")
    df = {r["term"]: r["n"] for r in counts.where(F.col("term").isin("", *known)).collect()}  # template terms, and all files under ""
    total = df.pop("", 0)
    vectors, keys = _template_vectors(templates, df, total)
    may = F.array(*map(F.lit, keys))

    named = license_file.alias("is_license")
    lines = F.filter(F.split("text", "\n"), lambda line: F.arrays_overlap(F.split(F.lower(line), _SPLIT), may))
    marked = base.select("path", "text", named).select(
        "path", "is_license", F.when(F.col("is_license"), F.concat(lines, F.array("text"))).otherwise(lines).alias("units"))
    units = marked.select("path", "is_license", F.posexplode("units").alias("unit", "line")).withColumn("unit", F.xxhash64("unit", "line"))
    tf = stage(units.select("path", "unit", "is_license", F.explode(_terms(F.col("line"))).alias("term"))
               .groupBy("path", "unit", "is_license", "term").agg((1 + F.log(F.count(F.lit(1)).cast("double"))).alias("tf")), "unit-terms")
    # every unit term is a term of some file, so the joins keep all of them
    idf = (counts.join(tf.select("term").distinct(), "term", "left_semi")
           .select("term", (F.log(F.lit(total + 1.0) / (F.col("n") + 1)) + 1).alias("idf"), F.col("term").isin(known).alias("known")))
    templates_df = _literal_rows(spark, vectors, ("license", "term", "t"))
    weighted = stage(tf.join(idf, "term").select("path", "unit", "is_license", "term", (F.col("tf") * F.col("idf")).alias("w"), "known"), "unit-weights")
    lengths = weighted.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = (weighted.where("known").join(templates_df, "term").groupBy("path", "unit", "is_license", "license").agg(F.sum(F.col("w") * F.col("t")).alias("dot")))
    scored = (dots.join(lengths, ["path", "unit"]).withColumn("score", F.round(F.least(F.col("dot") / F.col("length"), F.lit(1.0)), 9)).where(F.col("score") >= LEAST))
    # the largest score, then the first name
    best = F.min(F.struct((-F.col("score")).alias("s"), "license"))
    own = stage(scored.groupBy("path").agg(best.alias("b"), F.max("is_license").alias("is_license"))
                .select("path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), "is_license"), "own")

    directory = F.regexp_replace("path", r"/?[^/]*$", "").alias("dir")
    licensed = (own.where("is_license").select(directory, "license", "score")
                .groupBy("dir").agg(best.alias("b")).select(F.col("dir").alias("ancestor"), F.col("b.license").alias("inherited")))
    paths = base.select("path").distinct().select("path", directory)
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    nearest = (paths.select("dir").distinct().select("dir", F.posexplode(F.array_distinct(ancestors)).alias("depth", "ancestor"))
               .join(licensed, "ancestor").groupBy("dir")
               .agg(F.max_by(F.struct("inherited", F.col("ancestor").alias("inherited_from")), "depth").alias("a")).select("dir", "a.*"))
    return (paths.join(own.select("path", "license", "score"), "path", "left").join(nearest, "dir", "left")
            .select("path", "license", "score", F.when(F.col("license").isNull(), F.col("inherited")).alias("inherited"),
                    F.when(F.col("license").isNull(), F.col("inherited_from")).alias("inherited_from")))


def document_licenses(docs: DataFrame) -> DataFrame:
    """``(doc_id, path, license, score, inherited, inherited_from)`` of all documents
    as files ``source/lang/thousand/doc_id``.  They have no names, so a short
    document (400 characters at most) with a licence line is its directory's
    licence file.  Rows with a null id are left out."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")),
                       F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    files = docs.where("doc_id IS NOT NULL").select(path.alias("path"), "text")
    found = scan(files, license_file=F.length("text") <= 400)
    return found.select(F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"), "path", "license", "score", "inherited", "inherited_from")
