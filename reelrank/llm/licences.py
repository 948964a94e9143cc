"""Licence scan: sparse TF-IDF cosine of header lines and licence files to templates, then inheritance by directory.

All on DataFrame functions.  The texts are read once; what follows reads a
written table of the paths and of the texts with a marker.  Units of a text are compared with templates:

- lines with a marker word (licence files: all lines with a word), with
  ``TEMPLATES``;
- spans of words in paragraphs with a marker (licence files: all paragraphs),
  however these are broken into lines, with ``NOTICES``: a span lies as a
  notice would, of its length, round a word that anchors it (``ANCHORS``), so a
  notice is found inside longer lines and over several lines;
- SPDX identifiers, which name the licence (cosine 1; of an expression, the
  first).

So a scan keeps few rows, and a file's units meet no other file's.  Terms are
weighted by their inverse document frequency among the templates (unknown
terms weigh most, so a unit that shares only common words stays far away).  A
unit's terms, and then its products with all templates, are summed by unit: two
small shuffles on keys that no file dominates.  A template counts only where
the unit has its decisive terms (``DECISIVE``: versions, Creative Commons
kinds).  A unit that denies a licence (``not released under``) counts for none.
The file's licence is the template of the largest cosine, if that is at least
``least``; of equal ones the first by name, but a licence whose text holds that
of another wins where both are found (``CONTAINS``).

A directory's licence is the one of its licence files (the largest cosine,
then the first path).  Files without a licence of their own take it from the
nearest ancestor directory that has one.  That join runs on distinct
directories, each with its ancestors, not on files; files then join their
directory, and AQE splits a directory that holds a third of all files.

Templates, weights and places of anchors are literal tables (checked: at most
``MAX_TERMS`` terms), the only broadcasts.

Defined results: a null or empty text has no licence of its own; a null path
is the empty path, in the root directory; rows with one path are one file, of
all their lines, and each row has its result row; an empty table gives no
rows; of other columns only those in ``keep`` are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.tables import stored

LEAST = 0.6
MAX_TERMS = 5000
TERM = r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]"
MARKERS = r"(?i)licen[cs]e|copyright|copyleft|public domain|spdx|redistribut|warrant"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|unlicense)[^/]*$"

# Notices by which works name their licence, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                  "compliance with the License.",
    "Apache-2.0 (short)": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause (text)": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                           "provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License. CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright to the public domain. CC0 1.0 Universal",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 (notice)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT (text)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the Software), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved. Unauthorized copying of this file is strictly prohibited. Proprietary and confidential.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Further notices and titles of licence texts, for spans of words.
NOTICES = TEMPLATES | {
    "AGPL-3.0 (title)": "GNU Affero General Public License Version 3, 19 November 2007",
    "Apache-2.0 (title)": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
                          "REPRODUCTION, AND DISTRIBUTION",
    "BSD-3-Clause (text)": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                           "promote products derived from this software without specific prior written permission.",
    "BSL-1.0 (title)": "Boost Software License - Version 1.0 - August 17th, 2003",
    "BSL-1.0 (text)": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
                      "and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, "
                      "execute, and transmit the Software",
    "CC0-1.0 (title)": "Creative Commons Legal Code CC0 1.0 Universal",
    "GPL-2.0 (notice)": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation; either version 2 of the License",
    "GPL-2.0 (title)": "GNU General Public License Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    "GPL-3.0 (title)": "GNU General Public License Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "LGPL-2.1 (notice)": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                         "General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    "LGPL-2.1 (title)": "GNU Lesser General Public License Version 2.1, February 1999",
    "LGPL-3.0 (title)": "GNU Lesser General Public License Version 3, 29 June 2007",
    "MIT (title)": "The MIT License (MIT)",
    "MIT (under)": "Licensed under the MIT License.",
    "MPL-2.0 (title)": "Mozilla Public License Version 2.0",
}
#: Words in spans that a notice can be laid round: markers, and first words of notices without one.
ANCHORS = MARKERS + "|^(permission|unencumbered|gnu)$"
#: For templates of these licences, one term of each group must be in the unit, as versions and kinds weigh little.
DECISIVE = {
    "AGPL-3.0": (("3", "3.0", "v3", "v3.0"), ("affero", "agpl")),
    "Apache-2.0": (("2.0", "2", "v2", "v2.0"), ("apache",)),
    "BSL-1.0": (("boost", "organization"),),
    "CC-BY-4.0": (("4.0",), ("by", "attribution")),
    "CC-BY-NC-4.0": (("4.0",), ("by-nc", "noncommercial")),
    "CC-BY-SA-4.0": (("4.0",), ("by-sa", "sharealike")),
    "GPL-2.0": (("2", "2.0", "v2", "v2.0"), ("gnu", "gpl")),
    "GPL-3.0": (("3", "3.0", "v3", "v3.0"), ("gnu", "gpl")),
    "LGPL-2.1": (("2.1", "v2.1"), ("lesser", "lgpl")),
    "LGPL-3.0": (("3", "3.0", "v3", "v3.0"), ("lesser", "lgpl")),
    "MIT": (("mit", "charge"),),
    "MPL-2.0": (("2.0", "2", "v2", "v2.0"), ("mozilla", "mpl")),
}
#: Licences whose text holds that of another: a file with both has the first.
CONTAINS = {"BSD-3-Clause": "BSD-2-Clause"}
#: A unit that says so names a licence only to deny it.
NEGATED = r"(?i)(^|[^a-z])(not|never|nor|neither|isn.t|wasn.t)\s+([a-z]+\s+){0,2}(licen[cs]ed|released|covered|governed|available|distributed|dedicated)([^a-z]|$)"
_AHEAD = 4  # words before a span that can deny it
SPDX = r"(?i)spdx-licen[cs]e-identifier:[\s(]*([a-z0-9][a-z0-9.+-]*)"


def plain_name(name: str) -> str:
    """A template's licence."""
    return re.sub(r" \(.*\)$", "", name)


def weights(templates: dict[str, str] | None = None) -> tuple[dict[str, tuple[float, list[float]]], float]:
    """For each term its inverse document frequency and its weight in each template (by name, of length one); and the
    frequency weight of unknown terms."""
    texts = [Counter(re.findall(TERM, t.lower())) for _, t in sorted((templates or TEMPLATES).items())]
    df = Counter(x for t in texts for x in t)
    idf = {x: math.log((1 + len(texts)) / (1 + n)) + 1 for x, n in df.items()}
    norms = [math.sqrt(sum((n * idf[x]) ** 2 for x, n in t.items())) for t in texts]
    if len(idf) > MAX_TERMS:
        raise ValueError(f"templates have {len(idf)} terms, more than {MAX_TERMS}")
    return {x: (w, [t[x] * w / norm for t, norm in zip(texts, norms)]) for x, w in sorted(idf.items())}, math.log(1 + len(texts)) + 1


def _scored(units: DataFrame, templates: dict[str, str], least: float) -> DataFrame:
    """``path, cosine, licence`` of the units (``path, unit``) that are like a template."""
    spark, names = units.sparkSession, sorted(templates)
    known, unknown = weights(templates)
    table = spark.createDataFrame([(x, w, v) for x, (w, v) in known.items()], "term string, idf double, in_template array<double>")
    terms = (units.select("path", "unit", F.explode(F.regexp_extract_all(F.lower("unit"), F.lit(f"({TERM})"), 1)).alias("term"))
             .groupBy("path", "unit", "term").agg(F.count("*").alias("tf")))
    weighed = terms.join(F.broadcast(table), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    dots = [F.sum(F.coalesce(F.col("in_template")[i], F.lit(0.0)) * F.col("w")) / F.sqrt(F.sum(F.col("w") * F.col("w")))
            for i in range(len(names))]
    groups = sorted({g for x in names for g in DECISIVE.get(plain_name(x), ())})
    scored = weighed.groupBy("path", "unit").agg(F.array(*[F.round(d, 9) for d in dots]).alias("cosines"), F.array(
        *[F.max(F.col("term").isin(*g)) for g in groups]).alias("has"))
    allowed = [[F.col("has")[groups.index(g)] for g in DECISIVE.get(plain_name(x), ())] for x in names]
    scored = scored.select("path", F.array(*[
        F.when(reduce(Column.__and__, of), F.col("cosines")[i]).otherwise(0.0) if of else F.col("cosines")[i]
        for i, of in enumerate(allowed)]).alias("cosines"))
    return scored.select("path", F.array_max("cosines").alias("cosine"), F.element_at(
        F.lit(names), F.array_position("cosines", F.array_max("cosines")).cast("int")).alias("licence")).where(F.col("cosine") >= least)


def _places(templates: dict[str, str]) -> list[tuple[str, int, int]]:
    """``(anchor, words before it, words)``: how templates lie round the words that can anchor them."""
    out = set()
    for t in templates.values():
        words = re.findall(TERM, t.lower())
        at = [i for i, x in enumerate(words) if re.search(ANCHORS, x)]
        out |= {(words[i], i, len(words)) for i in {*at[:2], *at[-1:]}}
    return sorted(out)


def _spans(marked: DataFrame, templates: dict[str, str]) -> DataFrame:
    """``path, unit``: the words of paragraphs where a template may lie; a paragraph ends at a line without words."""
    table = marked.sparkSession.createDataFrame(_places(templates), "anchor string, ahead int, n int")
    paragraphs = F.split("text", r"\n(?:[^A-Za-z0-9\n]*\n)+")
    wanted = lambda x: x.rlike(MARKERS) | F.col("path").rlike(LICENCE_FILE)
    words = (marked.select("path", F.explode(F.filter(paragraphs, wanted)).alias("p"))
             .select("path", F.regexp_extract_all(F.lower("p"), F.lit(f"({TERM})"), 1).alias("words")))
    found = F.filter(F.transform("words", lambda x, i: F.struct(i.alias("at"), x.alias("anchor"))), lambda x: x["anchor"].rlike(ANCHORS))
    # a window wide enough for every template goes along with each anchor, not the whole paragraph
    wide = max(n for _, _, n in _places(templates))
    first = lambda at: F.greatest(at - wide, F.lit(0))
    windows = words.select("path", F.explode(F.transform(found, lambda x: F.struct(
        x["anchor"].alias("anchor"), (x["at"] - first(x["at"])).alias("at"),
        F.slice("words", first(x["at"]) + 1, F.lit(2 * wide + 1)).alias("words")))).alias("a")).select("path", "a.*")
    start = F.greatest(F.col("at") - F.col("ahead"), F.lit(0))
    end = F.col("at") - F.col("ahead") + F.col("n")
    said = F.greatest(start - _AHEAD, F.lit(0))
    joined = lambda a, b: F.array_join(F.slice("words", a + 1, b - a), " ")
    return (windows.join(F.broadcast(table), "anchor").where(~joined(said, end).rlike(NEGATED))
            .select("path", joined(start, end).alias("unit")).distinct())


def own_licences(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST,
                 templates: dict[str, str] | None = None) -> DataFrame:
    """``path, licence, cosine`` of the files with a licence of their own."""
    marked = files.select(F.coalesce(F.col(path), F.lit("")).alias("path"), F.col(text).alias("text")).where(
        F.col("text").rlike(MARKERS) | F.col("path").rlike(LICENCE_FILE))
    wanted = lambda x: x.rlike(MARKERS) | (F.col("path").rlike(LICENCE_FILE) & x.rlike("[A-Za-z0-9]"))
    lines = (marked.select("path", F.explode(F.filter(F.split("text", "\n"), wanted)).alias("unit"))
             .where(~F.col("unit").rlike(NEGATED)).distinct())
    named = marked.select("path", F.explode(F.regexp_extract_all("text", F.lit(SPDX), 1)).alias("id")).distinct()
    ids = {x.lower(): x for x in map(plain_name, templates or NOTICES)}
    plain = F.regexp_replace("id", r"(?i)(-only|-or-later|\+|[.+-]+)$", "")
    spdx = named.select("path", F.lit(1.0).alias("cosine"), F.coalesce(
        *[F.when(F.lower(plain) == x, F.lit(name)) for x, name in sorted(ids.items())], plain).alias("licence"))
    best = (_scored(lines, templates or TEMPLATES, least).unionByName(_scored(_spans(marked, templates or NOTICES), templates or NOTICES, least))
            .unionByName(spdx))
    best = best.withColumn("licence", F.regexp_replace("licence", r" \(.*\)$", ""))
    whole = {part: F.max(F.when(F.col("licence") == name, F.col("cosine"))) for name, part in CONTAINS.items()}
    best = best.groupBy("path").agg(F.min(F.struct((-F.col("cosine")).alias("order"), "licence")).alias("m"),
                                    *[x.alias(f"whole_{part}") for part, x in whole.items()])
    licence, cosine = F.col("m.licence"), -F.col("m.order")
    for name, part in CONTAINS.items():
        both = (licence == part) & F.col(f"`whole_{part}`").isNotNull()
        licence, cosine = F.when(both, F.lit(name)).otherwise(licence), F.when(both, F.col(f"`whole_{part}`")).otherwise(cosine)
    return best.select("path", licence.alias("licence"), cosine.alias("cosine"))


def directory(path: Column) -> Column:
    """The directory of a path; the root is the empty one."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """``(folder, depth)`` of a directory, its ancestors and the root."""
    parts = F.filter(F.split(folder, "/"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        F.array_join(F.slice(parts, F.lit(1), n), "/").alias("folder"), n.alias("depth")))


def scan(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST,
         templates: dict[str, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and ``path, own, cosine, inherited, from_dir, licence``: one row for every row of ``files``."""
    # one pass over the texts: paths, and the texts of the few files that may name a licence
    at, t = F.coalesce(F.col(path), F.lit("")), F.col(text)
    files = stored(files.select(*[F.col(f"`{c}`") for c in keep], at.alias("path"), F.when(
        t.rlike(MARKERS) | at.rlike(LICENCE_FILE), t).alias("licence_text")), "licence-files")
    paths = files.select(*[F.col(f"`{c}`") for c in keep], "path")
    own = own_licences(files.where("licence_text IS NOT NULL"), "path", "licence_text", least, templates)
    given = (own.where(F.col("path").rlike(LICENCE_FILE))
             .groupBy(directory(F.col("path")).alias("folder"))
             .agg(F.min(F.struct((-F.col("cosine")).alias("order"), "path", "licence")).alias("m"))
             .select("folder", F.col("m.licence").alias("given")))
    folders = paths.select(directory(F.col("path")).alias("dir")).distinct()
    nearest = (folders.select("dir", F.explode(ancestors(F.col("dir"))).alias("a")).select("dir", "a.folder", "a.depth")
               .join(given, "folder").groupBy("dir").agg(F.max(F.struct("depth", "folder", "given")).alias("m"))
               .select("dir", F.col("m.folder").alias("from_dir"), F.col("m.given").alias("given")))
    joined = (paths.join(own, "path", "left").withColumn("dir", directory(F.col("path"))).join(nearest, "dir", "left"))
    missing = F.col("licence").isNull()
    return joined.select(
        *keep, "path", F.col("licence").alias("own"), "cosine", F.when(missing, F.col("given")).alias("inherited"),
        F.when(missing, F.col("from_dir")).alias("from_dir"), F.coalesce("licence", "given").alias("licence"))


def documents_as_files(docs: DataFrame) -> DataFrame:
    """``doc_id, path, text``: documents as a tree of files, ``source/language/doc_id-digest.txt``.

    The digest (of the text) tells rows of one id apart; a row without an id is named ``none``.  A document of under 60
    words that has a licence marker is a licence file of its directory, ``LICENSE-doc_id-digest``.
    """
    t = F.coalesce("text", F.lit(""))
    short = (F.size(F.split(F.trim(t), r"\s+")) < 60) & t.rlike(MARKERS)
    own = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.substring(F.md5(t.cast("binary")), 1, 12))
    name = F.when(short, F.concat(F.lit("LICENSE-"), own)).otherwise(F.concat(own, F.lit(".txt")))
    return docs.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), name).alias("path"), "text")
