"""License scans: TF-IDF cosine of text units to templates, then inheritance along directories.

Units of a text are its lines, every run of consecutive lines with at most ``RUN`` terms, its paragraphs,
its leading comment and the whole text; comment marks are no terms, and lines without terms part
paragraphs but not runs. Units are term vectors weighted by inverse document frequency over all
files and the templates. The terms that a unit needs at least one of to reach the threshold follow from
the weights (``needed``), and a bound on the cosine drops most units before their norms are computed; both
drop only units that cannot match. A file takes the best template at or above the threshold; versions and
families of one licence have templates of their own, whose differing words decide. A licence named by its
standard identifier is taken at its word. Files named like
licence files speak for their directory; a file without a licence of its own inherits from the nearest
ancestor directory that has one, found by joining directory paths.

DataFrame functions only.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import stored

# Headers and opening sentences of public licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    ),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose is hereby granted"),
)
# The clause that makes a two-clause licence a three-clause one, and identifiers by their
# usual spelling without what tells later versions.
THIRD_CLAUSE = (r"(?s)\bneither the names?\W+of\b", "BSD-2-Clause", "BSD-3-Clause")
IDENTIFIERS = (
    "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause",
    "MPL-2.0", "ISC", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
)
IDENTIFIED = r"spdx-license-identifier:[ \t]*\(?([a-z0-9.-]+)"
TERM = r"[a-z0-9]+(\.[0-9]+)*"
THRESHOLD = 0.7
#: Comment marks that would read as terms, and lines that belong to a leading comment.
WORD_MARK = r"(?m)^[ \t]*(?:rem|dnl)\b"
COMMENT = r"^\s*(?:$|//|/\*|\*|#|--|;|%|!|\"|'|<!--|\(\*|\{-|\.\.|rem\b|dnl\b)"
BLOCK_COMMENT = r"(?s)\A\s*(?:/\*.*?\*/|<!--.*?-->|\"{3}.*?\"{3}|'{3}.*?'{3}|\(\*.*?\*\)|\{-.*?-\})"
LICENCE_FILE = r"(?i)(^|/)(?:un)?(licen[cs]e|copying|notice)([._-][^/]*)?$"


def terms(text: str) -> list[str]:
    return [m[0] for m in re.finditer(TERM, text.lower())]


COUNTS = tuple(Counter(terms(text)) for _, text in TEMPLATES)
#: Terms of a run of lines at most: twice those of the longest template.
RUN = 2 * max(c.total() for c in COUNTS)


def inverse(n: float | Column, k: float | Column, log=math.log) -> float | Column:
    """Inverse document frequency of a term in k of n documents, 1 at least."""
    return log((1 + n) / (1 + k)) + 1


def needed(idf: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a unit needs one at least: what is left of a template without its heaviest terms has
    less than ``threshold`` of its norm, so by Cauchy-Schwarz a unit without them stays below it."""
    found = set()
    for count in COUNTS:
        mass = {t: (f * idf[t]) ** 2 for t, f in count.items()}
        light, limit = 0.0, (threshold - 1e-6) ** 2 * sum(mass.values())
        for t in sorted(mass, key=lambda t: (mass[t], t)):
            light += mass[t]
            if light >= limit:
                found.add(t)
    return sorted(found)


TEMPLATE_TYPE = "array<struct<license: string, vec: array<struct<term: string, weight: double, idf: double>>>>"


def any_of(found: list[str]) -> str:
    """A pattern that every text with one of these terms matches: no letter stands before a term, none and no
    digit behind it; a letter may follow the last digit of a term with points."""
    plain, dotted = ("|".join(re.escape(t) for t in found if ("." in t) == d) for d in (False, True))
    parts = [f"(?:{x}){end}" for x, end in ((plain, "(?![a-z0-9])"), (dotted, "(?![0-9])")) if x]
    return f"(?<![a-z])(?:{'|'.join(parts)})"


def template_vectors(idf: dict[str, float]) -> Column:
    """The templates as one literal: license and, per term, its weight in the unit vector and its idf."""
    cells = []
    for (name, _), count in zip(TEMPLATES, COUNTS):
        norm = math.sqrt(sum((f * idf[t]) ** 2 for t, f in count.items()))
        vec = [{"term": t, "weight": f * idf[t] * idf[t] / norm, "idf": idf[t]} for t, f in sorted(count.items())]
        cells.append({"license": name, "vec": vec})
    return F.from_json(F.lit(json.dumps(cells)), TEMPLATE_TYPE)


def all_terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def identified(texts: DataFrame) -> DataFrame:
    """(path, license, score, whole) of the files of lower-case ``texts`` whose lines name a known licence by
    its identifier; the first name, if several."""
    tag = F.regexp_extract("text", IDENTIFIED, 1)
    tag = F.regexp_replace(tag, r"(-only|-or-later|\+)$|\.$", "")
    names = F.create_map(*[F.lit(x) for name in IDENTIFIERS for x in (name.lower(), name)])
    named = texts.where(F.contains("text", F.lit("spdx-license-identifier:"))).select("path", names[tag].alias("license"))
    return named.where("license is not null").groupBy("path").agg(
        F.min("license").alias("license"), F.lit(1.0).alias("score"), F.lit(False).alias("whole")
    )


def units(texts: DataFrame, anchors: Column) -> DataFrame:
    """(path, third, whole, terms): units of lower-case ``texts`` (path, text) that hold one of ``anchors``.

    Split texts are columns of their own, so that no step cuts a text again for each line of it.
    """
    holds = lambda ts: F.arrays_overlap(ts, anchors)
    bare = F.regexp_replace(F.regexp_replace("text", r"\r\n?", "\n"), WORD_MARK, "")
    texts = texts.withColumns(
        {"bare": F.regexp_replace(bare, r"(?m)^[^a-z0-9\n]+$", ""), "third": F.col("text").rlike(THIRD_CLAUSE[0])}
    )
    lines = F.filter(F.transform(F.split("bare", "\n"), all_terms), lambda ts: F.size(ts) > 0)
    texts = texts.withColumns({"lines": lines, "raw": F.split("text", r"\r\n?|\n")})
    code = F.array_position(F.transform("raw", lambda x: ~x.rlike(COMMENT)), True)
    texts = texts.withColumns({"held": F.transform("lines", holds), "code": code.cast("int")})
    lead = F.slice("raw", 1, F.when(F.col("code") > 0, F.col("code") - 1).otherwise(F.size("raw")))
    leads = (F.array_join(lead, "\n"), F.regexp_extract("text", BLOCK_COMMENT, 0))
    lead = F.array(*(all_terms(F.regexp_replace(x, WORD_MARK, "")) for x in leads))
    paragraphs = F.transform(F.split("bare", "\n{2,}"), all_terms)
    near = F.filter(F.sequence(F.lit(1), F.size("held")), lambda k: F.array_contains(F.slice("held", k, RUN), True))
    near = F.when(F.size("held") > 0, near).otherwise(F.expr("CAST(array() AS array<int>)"))
    # shorter lines and paragraphs are runs
    given = F.concat(F.filter(F.concat("lines", paragraphs), lambda ts: F.size(ts) > RUN), lead)
    texts = texts.select("path", "text", "third", "lines", near.alias("near"), given.alias("given"))
    start = F.expr("named_struct('now', CAST(array() AS array<string>), 'out', CAST(array() AS array<array<string>>), 'open', true)")

    def longer(state: Column, line: Column) -> Column:
        now = F.concat(state["now"], line)
        fits = state["open"] & (F.size(state["now"]) + F.size(line) <= RUN)
        more = F.struct(now.alias("now"), F.concat(state["out"], F.array(now)).alias("out"), F.lit(True).alias("open"))
        over = F.struct(state["now"].alias("now"), state["out"].alias("out"), F.lit(False).alias("open"))
        return F.when(fits, more).otherwise(over)

    grow = lambda k: F.aggregate(F.slice("lines", k, RUN), start, longer, lambda s: F.filter(s["out"], holds))
    every = F.concat(F.array(all_terms(F.col("text"))), "given", F.flatten(F.transform("near", grow)))
    found = texts.select("path", "third", F.posexplode(every).alias("at", "terms"))
    return found.where(holds(F.col("terms"))).select("path", "third", (F.col("at") == 0).alias("whole"), "terms")


def likely(ts: Column, threshold: float, templates: Column) -> Column:
    """(license, dot) of the templates that a unit may match. The dot product is exact; the norm is bounded
    from below: idf is 1 at least, and a term's squared count is its count at least."""
    times = lambda e: F.size(ts) - F.size(F.array_remove(ts, e["term"]))
    zero = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("square"), F.lit(0).alias("n"))

    def add(s: Column, e: Column) -> Column:
        return F.struct(
            (s["dot"] + e["f"] * e["weight"]).alias("dot"),
            (s["square"] + F.pow(e["f"] * e["idf"], F.lit(2.0))).alias("square"),
            (s["n"] + e["f"]).alias("n"),
        )

    def one(t: Column) -> Column:
        counted = F.transform(t["vec"], lambda e: F.struct(times(e).alias("f"), e["weight"].alias("weight"), e["idf"].alias("idf")))
        return F.aggregate(
            counted,
            zero,
            add,
            lambda s: F.struct(t["license"].alias("license"), s["dot"].alias("dot"), (s["square"] + F.size(ts) - s["n"]).alias("least")),
        )

    floor = (threshold - 1e-6) ** 2
    return F.filter(F.transform(templates, one), lambda m: (m["dot"] > 0) & (m["dot"] * m["dot"] >= floor * m["least"]))


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(path, license, score, whole) of the files (path, text) that have a licence statement.

    One row per path; score is the cosine rounded to 6 digits, ties go to the first name; whole says that
    the whole text matches too. Rows of one path are one file, but each row counts in the document
    frequencies; NULL paths are one file as well. NULL or empty texts have no units.
    """
    texts = files.select("path", F.lower("text").alias("text"))
    known = sorted({t for c in COUNTS for t in c})
    common = F.array(*map(F.lit, known))
    met = texts.select(F.explode(F.concat(F.array_intersect(all_terms(F.coalesce("text", F.lit(""))), common), F.array(F.lit("")))).alias("term"))
    seen = {r["term"]: r["count"] for r in met.groupBy("term").count().collect()}
    n = seen.get("", 0) + len(TEMPLATES)
    inside = Counter(t for c in COUNTS for t in c)
    idf = {t: inverse(n, inside[t] + seen.get(t, 0)) for t in known}
    must = needed(idf, threshold)
    anchors = F.array(*map(F.lit, must))
    some = texts.where(F.col("text").rlike(any_of(must)))
    maybe = likely(F.col("terms"), threshold, template_vectors(idf)).alias("likely")
    # the number beside it keeps the filter from computing the matches twice
    each = units(some, anchors).select("path", "third", "whole", "terms", maybe, F.monotonically_increasing_id().alias("unit"))
    each = stored(each.where(F.size("likely") > 0), "units")
    tf = each.select("unit", F.explode("terms").alias("term")).groupBy("unit", "term").agg(F.count(F.lit(1)).alias("f"))
    wanted = stored(each.select(F.explode("terms").alias("term")).distinct(), "terms")
    # counted before the join: a task sends each of its terms once, and no plan depends on the number wanted
    words = texts.select(F.explode(F.array_distinct(all_terms(F.col("text")))).alias("term"))
    words = words.groupBy("term").agg(F.count(F.lit(1)).alias("k")).hint("merge").join(wanted, "term")
    given = files.sparkSession.sql(values_sql(sorted(inside.items()), "term, inside"))
    df = words.join(given, "term", "left")
    weighed = df.select("term", inverse(F.lit(n), F.col("k") + F.coalesce("inside", F.lit(0)), F.log).alias("idf"))
    square = F.pow(F.col("f") * F.col("idf"), F.lit(2.0))
    norms = tf.join(weighed, "term").groupBy("unit").agg(F.sqrt(F.sum(square)).alias("norm"))
    matches = each.select("unit", "path", "third", "whole", F.inline("likely")).join(norms, "unit")
    license = F.when(F.col("third") & (F.col("license") == THIRD_CLAUSE[1]), THIRD_CLAUSE[2]).otherwise(F.col("license"))
    scored = matches.select("path", "whole", license.alias("license"), F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    scored = scored.where(F.col("score") >= threshold)
    # highest score first, then the first name
    first = F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("first")
    scored = scored.unionByName(identified(texts))
    return scored.groupBy("path").agg(first, F.max("whole").alias("whole")).select(
        "path", "first.license", (-F.col("first.minus")).alias("score"), "whole"
    )


def values_sql(rows: list[tuple], names: str) -> str:
    """A relation of literals in SQL that Spark and DuckDB read alike."""
    cell = lambda v: f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({names})"


def directory(path: Column) -> Column:
    """Directory of a path: all before the last slash, or the empty string."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherit(files: DataFrame, threshold: float = THRESHOLD, licence_file: str = LICENCE_FILE) -> DataFrame:
    """Columns of ``files`` (path, text, others) but text, with own_license, own_score, license, inherited_from.

    ``license`` is the file's own or else that of the nearest ancestor directory with a licence file;
    inherited_from is that directory, NULL if own or none. If a directory has several licence files, the
    highest score counts, then the first name. A file with NULL path has its own licence at most. No row
    is dropped; repeated rows are answered alike; columns named like a result are replaced.
    """
    added = ["own_license", "own_score", "license", "inherited_from"]
    files = files.drop(*added)
    own = scan(files.select("path", "text"), threshold).select(
        F.col("path").alias("scan__own_path"), F.col("license").alias("own_license"), F.col("score").alias("own_score")
    )
    speaking = own.where(F.col("scan__own_path").rlike(licence_file)).withColumn("scan__speaks", directory(F.col("scan__own_path")))
    order = Window.partitionBy("scan__speaks").orderBy(F.desc("own_score"), "own_license")
    speaking = speaking.withColumn("k", F.row_number().over(order)).where("k = 1")
    speaking = speaking.select("scan__speaks", F.col("own_license").alias("scan__given"))
    rest = files.drop("text")
    dirs = rest.select(directory(F.col("path")).alias("dir")).where("dir is not null").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    ancestors = dirs.select("dir", F.posexplode(F.array_distinct(above)).alias("level", "scan__ancestor"))
    met = ancestors.join(speaking, F.col("scan__ancestor") == F.col("scan__speaks"))
    nearest = met.groupBy("dir").agg(F.max(F.struct("level", "scan__ancestor", "scan__given")).alias("n"))
    nearest = nearest.select(F.col("dir").alias("scan__of_dir"), F.col("n.scan__ancestor").alias("scan__ancestor"), "n.scan__given")
    rows = rest.join(own, F.col("path").eqNullSafe(F.col("scan__own_path")), "left").drop("scan__own_path")
    rows = rows.join(nearest, directory(F.col("path")) == F.col("scan__of_dir"), "left")
    lacks = F.col("own_license").isNull()
    return rows.select(
        *rest.columns,
        "own_license",
        "own_score",
        F.coalesce("own_license", "scan__given").alias("license"),
        F.when(lacks, F.col("scan__ancestor")).alias("inherited_from"),
    )
