"""Licences of files: headers and texts against templates, then inheritance from the nearest directory.

Lines are compared with sentences that declare a licence; paragraphs, comments and whole files, their
lines joined, with the notices and full texts of licences; both by the cosine of TF-IDF vectors. SPDX
tags are read as they stand. A file's own licence is the best of these. A file that is named as a
licence file, or is nothing but one, licenses its directory and all below it. A file without a
licence of its own gets that of its nearest ancestor directory which has one. DataFrame functions
only.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeloom.llm.common import whole_text
from storeloom.session import cut_lineage

#: Licences and sentences by which files declare them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU "
                "General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
]
#: Terms that say nothing of a licence, alone or together.
_PLAIN = {"a", "and", "any", "are", "by", "is", "it", "january", "of", "or", "the", "this", "to", "under",
          "with", "without", "you", "can", "in"}
_GNU = ("This program is free software{stop} you can redistribute it and/or modify it under the terms of the "
        "GNU {kind}General Public License as published by the Free Software Foundation, either version "
        "{version} of the License, or (at your option) any later version.")
_NO_WARRANTY = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
                "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
                "See the GNU {kind}General Public License for more details. You should have received a copy "
                "of the GNU {kind}General Public License along with this program. If not, see "
                "<https://www.gnu.org/licenses/>.")
_APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
           "in compliance with the License. You may obtain a copy of the License at "
           "http://www.apache.org/licenses/LICENSE-2.0")
_MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
#: Notices that files carry, first paragraph alone and with what follows it, and full texts.
TEXTS = [
    *[(name, text.format(stop=";" if version < "3" else ":", kind=kind, version=version))
      for name, kind, version in (
          ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"),
          ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))
      for text in (_GNU, _GNU + _NO_WARRANTY)],
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + " Unless required by applicable law or agreed to in writing, software distributed "
                   "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                   "ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MPL-2.0", _MPL),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions:"),
    *[(path.stem, path.read_text(encoding="utf-8"))
      for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))],
]
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Words of lines that go with a licence and are none.
NOTICE = r"(?i)\b(?:copyright|spdx)\b"
_TOLD = {x for _, t in TEMPLATES for x in re.findall(TERM, t.lower())
         if x not in _PLAIN and re.search("[a-z]", x)} | {"copyright", "spdx"}
#: A line without any term of the templates but plain ones and numbers declares no licence. The terms
#: are grouped by their first letter, so that most words are passed over at once.
CUE = r"(?i)\b(?:" + "|".join(
    first + "(?:" + "|".join(re.escape(x[1:]) for x in sorted(_TOLD, key=lambda x: (-len(x), x)) if x[0] == first)
    + ")" for first in sorted({x[0] for x in _TOLD})) + r")\b"
#: Words that texts and templates have in common whatever they say; not compared.
FUNCTION_WORDS = (
    "a about above after all also am an and any are as at be been before being below between both but by can "
    "cannot could did do does doing done down during each either else every few for from further get had has have "
    "having he her here hers him his how i if in into is it its itself just made make may me might more most must "
    "my neither no nor not now of off on once one only or other others our ours out over own per same shall she "
    "should so some such than that the their theirs them then there these they this those through to too under "
    "until up upon us very was we were what when where whether which while who whom whose why will with within "
    "without would yes yet you your yours").split()
_ID = r"\(*[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?\)*"
SPDX = rf"(?i)\bSPDX-License-Identifier:[ \t]*({_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_ID})*)"
#: Lines of comments by their first characters, and comments by both ends.
COMMENT = r"(?i)^\s*(?:[#*;%!']|//|/\*|--|\(\*|\.\\\"|::|\{-|(?:dnl|rem|@rem)\b)"
ENCLOSED = r"/\*[\s\S]*?\*/|<!--[\s\S]*?-->|\"{3}[\s\S]*?\"{3}|'{3}[\s\S]*?'{3}"
FILE_NAME = r"(?i)^(?:licen[cs]e|copying|notice)(?:\.[a-z]+)?$"
LEAST = 0.6
#: A file that is this close to a text is nothing but a licence.
WHOLE = 0.9


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _weights(lines: DataFrame, idf: DataFrame, unknown: float, by: list[str], damped: bool) -> DataFrame:
    """TF-IDF weight of each term of each line; damped ones leave out function words and grow with the
    logarithm of the count, so that a few words of a long text do not outweigh all others."""
    each = lines.select(*by, F.explode(terms(F.col("line"))).alias("term"))
    if damped:
        each = each.where(~F.col("term").isin(FUNCTION_WORDS))
    counted = each.groupBy(*by, "term").agg(F.count("*").alias("tf"))
    often = 1 + F.log("tf") if damped else F.col("tf")
    return counted.join(F.broadcast(idf), "term", "left").withColumn(
        "weight", often * F.coalesce("idf", F.lit(unknown)))


def _model(spark: SparkSession, templates: list[tuple[str, str]],
           damped: bool) -> tuple[DataFrame, DataFrame, float]:
    """Unit vectors of the templates, and the weights of known and unknown terms."""
    listed = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)],
                                   "template int, license string, line string")
    term_of = listed.select("template", F.explode(F.array_distinct(terms(F.col("line")))).alias("term"))
    if damped:
        term_of = term_of.where(~F.col("term").isin(FUNCTION_WORDS))
    idf = term_of.groupBy("term").agg(
        (F.log((1 + len(templates)) / (1 + F.count("*"))) + 1).alias("idf"))
    unknown = math.log(1 + len(templates)) + 1
    model = _weights(listed, idf, unknown, ["template", "license"], damped)
    norms = model.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("_norm"))
    return model.join(F.broadcast(norms), "template").select(
        "template", "license", "term", (F.col("weight") / F.col("_norm")).alias("unit")), idf, unknown


def line_matches(lines: DataFrame, templates: list[tuple[str, str]], by: list[str],
                 damped: bool = False) -> DataFrame:
    """Best template and cosine of each line: ``by``, ``license``, ``score``. The templates are a
    parameter, so their terms are few enough to broadcast; equal cosines go to the first template."""
    model, idf, unknown = _model(lines.sparkSession, templates, damped)
    own = _weights(lines, idf, unknown, by, damped)
    size = own.groupBy(*by).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("_size"))
    dots = own.join(F.broadcast(model), "term").groupBy(*by, "template", "license").agg(
        F.sum(F.col("weight") * F.col("unit")).alias("_dot"))
    # Sums of doubles depend on the order of rows in their last digits.
    score = F.round(F.col("_dot") / F.col("_size"), 9)
    best = Window.partitionBy(*by).orderBy(F.desc("score"), "template")
    return (dots.join(size, by).withColumn("score", score)
            .withColumn("_at", F.row_number().over(best)).where("_at = 1")
            .select(*by, "license", "score"))


def text_matches(files: DataFrame, text: str, texts: list[tuple[str, str]], least: float) -> DataFrame:
    """Best score of each distinct text with a part that reaches ``least``: its digest ``_key``, struct
    ``_text`` (score, license) and whether the whole of it is a licence (``_all``).

    A part reaches ``least`` only if the template's terms that it has hold ``least ** 2`` of the
    template's squared length, and the whole text has all terms of its parts. Of a template's terms the
    commonest, up to half of that bound, are not even looked up: the others must hold the other half.
    """
    body = files.select(whole_text(text).alias("_body")).withColumn("_key", F.sha2("_body", 256))
    half = least * least / 2
    mass = F.col("unit") ** 2
    heaviest = Window.partitionBy("template").orderBy(F.desc("unit"), "term")
    heavy = _model(files.sparkSession, texts, True)[0].withColumn("mass", mass).withColumn(
        "_before", F.sum("mass").over(heaviest) - F.col("mass")).where(
        F.col("_before") < 1 - half).select("template", "term", "mass")
    # The bound is a little lower than it is, for the last digits of sums.
    keys = cut_lineage(
        body.withColumn("_id", F.monotonically_increasing_id())
        .select("_id", "_key", F.explode(F.array_distinct(terms(F.col("_body")))).alias("term"))
        .join(F.broadcast(heavy), "term").groupBy("_id", "_key", "template").agg(F.sum("mass").alias("_mass"))
        .where(F.col("_mass") >= half - 1e-9).select("_key").distinct())
    may = body.join(keys, "_key", "left_semi").groupBy("_key").agg(F.min("_body").alias("_body"))
    lines = F.split("_body", "\n")
    bare = F.transform(lines, lambda x: F.regexp_replace(x, r"^[^\p{L}\p{N}]+", ""))
    marked = F.transform(lines, lambda x: F.when(x.rlike(COMMENT), x).otherwise(""))
    parts = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.col("_body").alias("line"))),
        F.transform(F.array_distinct(F.filter(F.concat(
            F.split(F.array_join(bare, "\n"), "\n{2,}"), F.split(F.array_join(marked, "\n"), "\n{2,}"),
            F.regexp_extract_all("_body", F.lit(ENCLOSED), F.lit(0))), lambda x: x != "")),
            lambda x: F.struct(F.lit(False).alias("whole"), x.alias("line"))))
    units = may.select("_key", F.posexplode(parts).alias("_part", "_unit")).select(
        "_key", "_part", "_unit.line")
    found = line_matches(units, texts, ["_key", "_part"], damped=True).where(F.col("score") >= least)
    return found.groupBy("_key").agg(
        F.max(F.struct("score", "license")).alias("_text"),
        F.max((F.col("_part") == 0) & (F.col("score") >= WHOLE)).alias("_all"))


def scan(files: DataFrame, id_col: str = "doc_id", path: str = "path", text: str = "text",
         templates: list[tuple[str, str]] | None = None, least: float = LEAST,
         texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per row of ``files``: ``doc_id, path, own_license, score, license, origin``.

    ``own_license`` is that of the file's best line, paragraph, comment or whole text with a cosine of at
    least ``least``, or of its SPDX tag (score 1, the expression as it stands; the tag goes first),
    ``license`` that or the one inherited from directory ``origin``. Null texts and paths count as empty
    ones; a directory with several licence files has that of the best score, then the smallest path and
    licence. Repeated rows are scanned alike; an empty table gives no rows. Very long texts are scanned
    whole. Other columns are not read, whatever their names. Cosines are rounded to nine digits.
    """
    templates = TEMPLATES if templates is None else templates
    texts = TEXTS if texts is None else texts
    body = F.split(whole_text(text), "\n")
    cue = F.array_distinct(F.filter(body, lambda x: x.rlike(CUE)))
    name = F.element_at(F.split(F.coalesce(F.col(path), F.lit("")), "/"), -1)
    rows = cut_lineage(files.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(path), F.lit("")).alias("path"),
        cue.alias("_lines"), F.sha2(whole_text(text), 256).alias("_key"),
        F.regexp_extract(whole_text(text), SPDX, 1).alias("_tag"),
        name.rlike(FILE_NAME).alias("_file"),
        (F.size(F.filter(body, lambda x: F.trim(x) != "")) == F.size(cue)).alias("_only"),
        F.size(F.filter(cue, lambda x: x.rlike(NOTICE))).alias("_notices")).withColumn("_row", F.monotonically_increasing_id()))
    # Equal lines are compared once, and so are equal texts.
    where = rows.select("_row", F.explode("_lines").alias("line"))
    matched = line_matches(where.select("line").distinct(), templates, ["line"]).where(
        F.col("score") >= least)
    own = (where.join(matched, "line").groupBy("_row").agg(
        F.max(F.struct("score", "license")).alias("_line"), F.count("*").alias("_n")))
    tag = F.when(F.col("_tag") != "", F.struct(F.lit(1.0).alias("score"), F.col("_tag").alias("license")))
    named = rows.join(own, "_row", "left").join(
        text_matches(files, text, texts, least), "_key", "left").withColumn(
        "_best", F.coalesce(tag, F.greatest("_line", "_text"))).select(
        "_row", "doc_id", "path", (F.col("_file") | F.coalesce("_all", F.lit(False)) | (
            F.col("_only") & (F.coalesce("_n", F.lit(0)) + F.col("_notices") >= F.size("_lines")))).alias("_file"),
        F.col("_best.license").alias("own_license"), F.col("_best.score").alias("score"),
        F.regexp_extract("path", r"^([\s\S]*)/", 1).alias("_dir"))
    granted = (named.where("_file and own_license is not null").groupBy(F.col("_dir").alias("origin"))
               .agg(F.min(F.struct(-F.col("score"), "path", "own_license")).alias("_grant"))
               .select("origin", F.col("_grant.own_license").alias("_inherited")))
    parts = F.split("_dir", "/")
    chain = F.transform(F.sequence(F.lit(0), F.size(parts)),
                        lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    above = (named.select("_dir").distinct()
             .select("_dir", F.posexplode(F.array_distinct(chain)).alias("_depth", "_above"))
             .join(granted, F.col("_above") == F.col("origin"))
             .groupBy("_dir").agg(F.max(F.struct("_depth", "origin", "_inherited")).alias("_from")))
    inherits = F.col("own_license").isNull()
    return named.join(above, "_dir", "left").select(
        "doc_id", "path", "own_license", "score",
        F.coalesce("own_license", "_from._inherited").alias("license"),
        F.when(inherits, F.col("_from.origin")).alias("origin"))


def paths_of(docs: DataFrame) -> DataFrame:
    """Documents with a path: source, language, a folder for each 64 ids, whose first is its licence file."""
    name = F.when(F.col("doc_id") % 64 == 0, F.lit("LICENSE")).otherwise(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select("doc_id", "text", F.concat_ws(
        "/", "source", "lang", F.floor(F.col("doc_id") / 64).cast("string"), name).alias("path"))
