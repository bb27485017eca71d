"""Licence scan, with DataFrame functions only: statements in files by sparse TF-IDF cosine to templates, and licence files
that hold for the directories below them.

A line's vector has the squared inverse document frequency of each of its terms; terms that no template has count with the
largest one.  A template's heavy terms are its rarest ones, chosen so that the others together have too little weight to
reach the threshold: a line without a heavy term of any template can't match and is passed over.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import materialize, ready, tidy

#: Statements by which licences are declared (fixed wordings), by SPDX id.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("GPL-2.0", "This program is free software under the terms of the GNU General Public License as published by the Free Software Foundation, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Cosine that a line needs; share of a file's words (percent) in matching lines that makes it a licence file by content.
THRESHOLD, LICENCE_SHARE = 0.7, 50
#: Names of licence files.
_NAMED = r"(?i)(^|/)(licen[sc]e|copying|unlicense)([._-][^/]*)?$"


def _terms(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(text), r"[^a-z0-9]+"), ""))


def _literal(values: list, kind: str) -> Column:
    return F.split(F.lit("\n".join(map(str, values))), "\n").cast(f"array<{kind}>")


@tidy
def scan(files: DataFrame, id_col: str, path_col: str, text_col: str, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``files``: (id, path, licence, score, origin, licence_path).

    ``path`` has directories divided by "/".  A file's own licence is that of the template most similar to one of its lines,
    if the cosine is ``threshold`` at least (ties: the first id in alphabetical order); origin is "own" then.  Other files
    inherit ("inherited") from the nearest directory above them, their own first, with a licence file: one that is named
    like one, or half of whose words are in matching lines; of several in a directory the best match counts (ties: the
    first path).  Without either, licence is null and origin "none".  Null and empty texts match nothing, a null path has no
    directory, so it neither gives nor inherits; ids may be null and rows may repeat.  Texts are read whole; other
    columns are not looked at.
    """
    ready(files.sparkSession)
    of = [set(re.findall(r"[a-z0-9]+", text.lower())) for _, text in templates]
    vocabulary = sorted(set().union(*of))
    src = files.select(F.col(id_col).cast("long").alias("id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text"))
    seen = src.select(F.explode_outer(F.array_intersect(_terms(F.col("text")), _literal(vocabulary, "string"))).alias("term"))
    counts = {r.term: r.n for r in seen.groupBy("term").agg(F.count("*").alias("n")).collect()}  # a row for each term of the templates
    n = src.count()
    weight = {t: math.log(1 + (n + 1) / (counts.get(t, 0) + 1)) ** 2 for t in vocabulary}
    top = math.log(2 + n) ** 2
    heavy: set[str] = set()
    for terms in of:
        mass, total = 0.0, sum(weight[t] for t in terms)
        for t in sorted(terms, key=lambda t: (weight[t], t)):
            mass += weight[t]
            if mass >= threshold**2 * total:
                heavy.add(t)

    weights = _literal([weight[t] for t in vocabulary], "double")
    words = _literal(vocabulary, "string")

    def sum_of(terms: Column) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + F.get(weights, F.array_position(words, t).cast("int") - 1))

    def best_of(line: Column) -> Column:
        """Of one line: the best template as a struct (minus the cosine, licence, words of the line)."""
        terms = _terms(line)
        inside = F.array_intersect(terms, words)
        norm = F.sqrt(sum_of(inside) + top * (F.size(terms) - F.size(inside)))
        n_words = F.size(F.array_remove(F.split(line, r"\s+"), ""))
        each = [F.struct((-sum_of(F.array_intersect(terms, _literal(sorted(own), "string"))) / (norm * math.sqrt(sum(weight[t] for t in own)))).alias("minus"),
                         F.lit(name).alias("licence"), n_words.alias("words")) for (name, _), own in zip(templates, of, strict=True)]
        return F.array_min(F.array(*each))

    may = F.arrays_overlap(_terms(F.col("text")), _literal(sorted(heavy), "string"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.arrays_overlap(_terms(x), _literal(sorted(heavy), "string")))
    matches = F.when(may, F.filter(F.transform(lines, best_of), lambda m: m["minus"] <= -threshold))
    total = F.size(F.array_remove(F.split("text", r"\s+"), ""))
    found = src.withColumn("m", matches).select("id", "path", F.array_min("m").alias("best"), F.aggregate("m", F.lit(0), lambda a, m: a + m["words"]).alias("covered"), total.alias("total"))
    is_file = F.col("path").rlike(_NAMED) | (100 * F.col("covered") >= LICENCE_SHARE * F.col("total"))
    directory = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    found = materialize(found.select("id", "path", directory.alias("dir"), F.col("best.licence").alias("own"), (-F.col("best.minus")).alias("score"), (F.col("best").isNotNull() & is_file).alias("gives")), "own")
    givers = found.where("gives and dir is not null").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("minus"), "path", "own")).alias("g"))
    # every directory once, with the directories above it: far fewer rows than files
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    dirs = found.where("own is null and dir is not null").select("dir").distinct()
    ladder = dirs.select("dir", F.posexplode_outer(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(above)).alias("depth", "up"))
    near = ladder.join(givers.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max_by(F.col("g"), F.col("depth")).alias("g"))
    out = found.join(near, "dir", "left")
    inherits = F.col("own").isNull() & F.col("g").isNotNull()
    return out.select(
        "id", "path",
        F.coalesce("own", F.col("g.own")).alias("licence"),
        F.when(inherits, -F.col("g.minus")).otherwise(F.col("score")).alias("score"),
        F.when(F.col("own").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(F.col("own").isNotNull(), F.col("path")).when(inherits, F.col("g.path")).alias("licence_path"),
    )
