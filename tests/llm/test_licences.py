"""Licence scan against plain cosines of every run of lines, and families told by their own words."""

import math
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from martwright.llm import licences

STYLES = {
    "hash": lambda h: "\n".join(f"# {x}" for x in h),
    "slash": lambda h: "\n".join(f"// {x}" for x in h),
    "star": lambda h: "/*\n" + "\n".join(f" * {x}" for x in h) + "\n */",
    "rem": lambda h: "\r\n".join(f"REM {x}" for x in h),
}
CODE = "\n".join(f"value{i} = compute(alpha{i}, beta{i % 7})" for i in range(30))


def brute_best(files: dict[str, str]) -> dict[str, tuple]:
    """path -> (license, score) by the cosine of every run of lines and the whole text to every template."""
    bags = {p: Counter(licences.terms(t)) for p, t in files.items()}
    n = len(files) + len(licences.TEMPLATES)
    k = Counter(t for b in [*bags.values(), *licences.COUNTS] for t in b)
    idf = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in k.items()}
    norm = lambda b: math.sqrt(sum((f * idf[t]) ** 2 for t, f in b.items()))
    templates = [(name, b, norm(b)) for (name, _), b in zip(licences.TEMPLATES, licences.COUNTS)]
    out = {}
    for path, text in files.items():
        lines = [licences.terms(x.replace("REM ", " ")) for x in text.replace("\r\n", "\n").split("\n")]
        lines = [x for x in lines if x]
        found = [bags[path]]
        for i in range(len(lines)):
            run: Counter = Counter()
            for line in lines[i:]:
                run.update(line)
                if run.total() > licences.RUN:
                    break
                found.append(Counter(run))
        best = min(
            ((-round(sum(f * b[t] * idf[t] ** 2 for t, f in u.items() if t in b) / norm(u) / size, 6), name)
             for u in found if u for name, b, size in templates),
            default=None,
        )
        if best and -best[0] >= licences.THRESHOLD:
            out[path] = (best[1], -best[0])
    return out


def test_every_template_in_four_comment_styles(spark):
    files = {}
    for i, (name, text) in enumerate(licences.TEMPLATES):
        for style, wrap in STYLES.items():
            files[f"{i}/{style}.txt"] = wrap(textwrap.wrap(text, 60)) + "\n" + CODE
    files |= {"code.txt": CODE, "half.txt": "# Permission is hereby granted to use alpha1 and value2 in any software\n" + CODE}
    df = spark.createDataFrame(list(files.items()), "path string, text string")
    got = {r["path"]: (r["license"], r["score"]) for r in licences.scan(df).collect()}
    want = brute_best(files)
    assert got.keys() == want.keys()
    for path, (name, score) in want.items():
        assert math.isclose(got[path][1], score, abs_tol=2e-6), path
        assert got[path][0] == name, path
        assert path == "half.txt" or got[path][0] == licences.TEMPLATES[int(path.split("/")[0])][0], path


GNU = """This {what} is free software{a} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{b} either version {v} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
BSD = """Copyright (c) 2019, Some Authors
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
{third}
THIS SOFTWARE IS PROVIDED "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse products.
"""
FAMILIES = {
    "GPL-2.0": GNU.format(what="program", a=";", b=";", kind="", v="2"),
    "GPL-3.0": GNU.format(what="program", a=":", b=",", kind="", v="3"),
    "LGPL-2.1": GNU.format(what="library", a=";", b=";", kind="Lesser ", v="2.1"),
    "LGPL-3.0": GNU.format(what="library", a=":", b=",", kind="Lesser ", v="3"),
    "AGPL-3.0": GNU.format(what="program", a=":", b=",", kind="Affero ", v="3"),
    "BSD-2-Clause": BSD.format(third=""),
    "BSD-3-Clause": BSD.format(third=THIRD),
}


def test_families_identifiers_and_file_names(spark):
    rows = [(f"{n}/license.txt", text) for n, text in FAMILIES.items()]
    rows += [(f"{n}/src/deep/x.py", CODE) for n in FAMILIES]
    rows += [(f"wrapped/{n}.c", STYLES["star"](text.split("\n")) + "\n" + CODE) for n, text in FAMILIES.items()]
    tags = {"MIT": "MIT", "GPL-2.0-only": "GPL-2.0", "Apache-2.0": "Apache-2.0", "AGPL-3.0-or-later": "AGPL-3.0", "GPL-2.0+": "GPL-2.0"}
    rows += [(f"tag/{t}.c", f"// SPDX-License-Identifier: {t}\n{CODE}") for t in tags]
    rows += [("tag/unknown.c", f"# SPDX-License-Identifier: Zlib-acknowledgement\n{CODE}")]
    rows += [("c/index.js", "// Released under the MIT License.\n"), ("c/other.js", CODE), ("d/Copying", FAMILIES["GPL-3.0"]), ("d/a.py", CODE)]
    clash = ["given", "ancestor", "of_dir", "own_path", "third", "unit", "terms", "level", "speaks", "dir", "n"]
    df = spark.createDataFrame(rows, "path string, text string").withColumns({c: F.lit("clash") for c in clash})
    found = licences.inherit(df)
    got = {r["path"]: r for r in found.collect()}
    for n in FAMILIES:
        assert got[f"{n}/license.txt"]["license"] == n
        assert (got[f"{n}/src/deep/x.py"]["license"], got[f"{n}/src/deep/x.py"]["inherited_from"]) == (n, n)
        assert got[f"wrapped/{n}.c"]["own_license"] == n
    assert {t: got[f"tag/{t}.c"]["license"] for t in tags} == tags
    assert got["tag/unknown.c"]["license"] is None
    assert got["c/index.js"]["license"] == "MIT" and got["c/other.js"]["license"] is None
    assert got["d/a.py"]["license"] == "GPL-3.0"
    assert all(r[c] == "clash" for r in got.values() for c in clash)
