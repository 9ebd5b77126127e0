"""Licences of files: sparse TF-IDF cosine of lines and licence files to templates, inherited from the nearest directory.

Every line is a possible header. Word weights are term counts times inverse document frequency over all files; words
outside the templates have the largest weight there is. Lines that can reach the least cosine hold one of a few anchor
words of a template (its heaviest ones, without which the cosine stays below), so only those are taken apart.
A file without a licence of its own takes that of a licence file in its directory or the nearest one above.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.shared import prepare, small, stored

# Usual short notices of public licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
]
LEAST_COSINE = 0.75
LICENCE_FILE = "(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
_BREAK = "[^a-z0-9]+"


def _words(text: str) -> list[str]:
    return [w for w in re.split(_BREAK, text.lower()) if w]


def _tokens(column: str):
    return F.filter(F.split(F.lower(column), _BREAK), lambda w: w != "")


def weights(files: DataFrame, templates: list[tuple[str, str]]) -> tuple[dict[str, float], float]:
    """Inverse document frequency over files of the templates' words, and of a word that no file has."""
    vocabulary = sorted({w for _, text in templates for w in _words(text)})
    found = files.select(F.explode(F.array_intersect(_tokens("text"), F.array(*map(F.lit, vocabulary)))).alias("word"))
    df = {r[0]: r[1] for r in found.groupBy("word").count().collect()}  # at most one row per template word
    n = files.count()
    return {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary}, math.log(1 + n) + 1


def anchors(templates: list[tuple[str, str]], idf: dict[str, float], least: float) -> list[str]:
    """Words of which every unit with at least that cosine to a template has one."""
    out: set[str] = set()
    for _, text in templates:
        words = _words(text)
        squares = {w: (words.count(w) * idf[w]) ** 2 for w in set(words)}
        rest = total = sum(squares.values())
        for w in sorted(squares, key=lambda w: (-squares[w], w)):
            if math.sqrt(max(rest, 0) / total) < least:
                break
            out.add(w)
            rest -= squares[w]
    return sorted(out)


def own_licences(files: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST_COSINE) -> DataFrame:
    """(doc_id, own, score): the best template of the lines of a file, or of the whole text of a licence file.

    files: doc_id, path, text. Files without a unit of at least that cosine are absent. Equal cosines: first name.
    """
    spark = prepare(files.sparkSession)
    templates = TEMPLATES if templates is None else templates
    files = files.select("doc_id", "path", "text").filter("text is not null")
    idf, rarest = weights(files, templates)
    words, norms = [], []
    for i, (name, text) in enumerate(templates):
        tokens = _words(text)
        norm = math.sqrt(sum((tokens.count(w) * idf[w]) ** 2 for w in set(tokens)))
        words += [(w, i, tokens.count(w) * idf[w] * idf[w] / norm) for w in set(tokens)]
        norms.append((i, name))
    # One row per word of a template: a constant of the call.
    rows = [F.struct(F.lit(w).alias("word"), F.lit(i).alias("template"), F.lit(x).alias("weight")) for w, i, x in words]
    table = F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))
    names = F.create_map(*[F.lit(x) for pair in norms for x in pair])
    idfs = F.create_map(*[F.lit(x) for pair in idf.items() for x in pair])

    some = "(^|[^a-z0-9])(" + "|".join(anchors(templates, idf, least)) + ")([^a-z0-9]|$)"
    units = files.filter(F.lower("text").rlike(some))
    whole = F.when(F.substring_index("path", "/", -1).rlike(LICENCE_FILE), F.array("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.lower(x).rlike(some))
    units = units.select("doc_id", F.posexplode(F.concat(lines, F.coalesce(whole, F.array().cast("array<string>")))).alias("unit", "line"))
    tokens = units.select("doc_id", "unit", F.explode(_tokens("line")).alias("word"))
    tokens = tokens.groupBy("doc_id", "unit", "word").count()
    tokens = tokens.withColumn("idf", F.coalesce(idfs[F.col("word")], F.lit(rarest)))
    square = tokens.groupBy("doc_id", "unit").agg(F.sqrt(F.sum(F.pow(F.col("count") * F.col("idf"), 2))).alias("norm"))
    dots = tokens.join(table, "word").groupBy("doc_id", "unit", "template").agg(F.sum(F.col("count") * F.col("weight")).alias("dot"))
    scores = dots.join(square, ["doc_id", "unit"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9))
    scores = scores.filter(F.col("score") >= least).withColumn("own", names[F.col("template")])
    best = scores.groupBy("doc_id").agg(F.min(F.struct((-F.col("score")).alias("less"), "own")).alias("best"))
    return best.select("doc_id", "best.own", (-F.col("best.less")).alias("score"))


def _folder(path: str):
    """The directory of a path, with the slash; '' at the top."""
    return F.regexp_extract(path, "^(.*/)[^/]*$", 1)


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST_COSINE) -> DataFrame:
    """(doc_id, path, own, score, licence, inherited_from) of every file (doc_id, path, text).

    inherited_from is the directory whose licence file decides, null if the file's own does. Several licence files of a
    directory: the highest score, then the first name. A null path is a file in a directory of its own; null and empty
    texts have no own licence. Directories are resolved once each, so a large directory is one row of the path join.
    """
    prepare(files.sparkSession)
    files = files.select("doc_id", "path", "text")
    own = stored(own_licences(files, templates, least), "licences")
    rows = files.select("doc_id", "path").join(small(own), "doc_id", "left").withColumn("folder", _folder("path"))
    rows = stored(rows, "files")
    given = rows.filter("own is not null").filter(F.substring_index("path", "/", -1).rlike(LICENCE_FILE))
    given = given.groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("less"), "own")).alias("best"))
    given = stored(given.select(F.col("folder").alias("above"), F.col("best.own").alias("licence")), "licence_folders")
    parts = F.split("folder", "/")
    steps = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    folders = rows.filter("own is null and folder is not null").select("folder").distinct()
    chains = folders.select("folder", F.explode(F.array_distinct(F.transform(
        steps, lambda s: F.when(s == "", F.when(F.col("folder").startswith("/"), "/").otherwise("")).otherwise(
            F.concat(s, F.lit("/")))))).alias("above"))
    chains = chains.unionByName(folders.filter("startswith(folder, '/')").select("folder", F.lit("").alias("above")))
    near = chains.join(small(given), "above").groupBy("folder").agg(
        F.max_by(F.struct("above", "licence"), F.length("above")).alias("near"))
    near = stored(near, "inherited")
    rows = rows.join(small(near), "folder", "left")
    mine = F.col("own").isNotNull()
    return rows.select("doc_id", "path", "own", "score", F.coalesce("own", "near.licence").alias("licence"),
                       F.when(~mine, F.col("near.above")).alias("inherited_from"))
