import math
import re
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from storeloom.llm import licenses
from tests.conftest import SMALL


def cosines(line):
    n = len(licenses.TEMPLATES)
    term = lambda t: re.findall(licenses.TERM, t.lower())
    df = Counter(x for _, t in licenses.TEMPLATES for x in set(term(t)))
    idf = lambda x: math.log((1 + n) / (1 + df[x])) + 1
    vector = lambda t: {x: c * idf(x) for x, c in Counter(term(t)).items()}
    v = vector(line)
    out = []
    for name, t in licenses.TEMPLATES:
        w = vector(t)
        dot = sum(v[x] * w.get(x, 0) for x in v)
        size = math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in w.values()))
        out.append((round(dot / size, 9) if size else 0.0, name))
    return max(out, key=lambda s: s[0])


def plain(files):
    own, grants, rows = {}, {}, []
    for k, (i, path, text) in enumerate(files):
        lines = (text or "").split("\n")
        cues = [x for x in lines if re.search(licenses.CUE, x)]
        found = [s for s in map(cosines, cues) if s[0] >= licenses.LEAST]
        own[k] = max(found) if found else None
        path = path or ""
        where, _, name = path.rpartition("/")
        whole = len([x for x in lines if x.strip(" ")]) == len(set(cues))
        if own[k] and (re.search(licenses.FILE_NAME, name) or whole):
            grants.setdefault(where, []).append((-own[k][0], path, own[k][1]))
        rows.append((i, path, where))
    out = []
    for k, (i, path, where) in enumerate(rows):
        parts = where.split("/")
        chain = ["/".join(parts[:d]) for d in range(len(parts), -1, -1)]
        origin = next((c for c in chain if c in grants), None)
        inherited = min(grants[origin])[2] if origin is not None else None
        score, name = own[k] or (None, None)
        out.append((i, path, name, score, name or inherited, origin if name is None else None))
    return Counter(out)


def test_against_plain(spark):
    docs = licenses.paths_of(spark.read.parquet(f"{SMALL.replace('sf0.001', 'sf0.01')}/documents.parquet"))
    # More licence files than the table has: every folder's first document declares one.
    names = F.array(*[F.lit(t) for _, t in licenses.TEMPLATES])
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 128 == 0, F.concat_ws(
        "\n", names[(F.col("doc_id") / 128).cast("int") % 14], "text")).otherwise(F.col("text")))
    files = [(r.doc_id, r.path, r.text) for r in docs.collect()]
    want = plain(files)
    assert Counter(map(tuple, licenses.scan(docs).collect())) == want
    assert sum(x[2] is not None for x in want) > 20 and sum(x[5] is not None for x in want) > 5


def test_awkward_paths(spark):
    mit, gpl = "Released under the MIT License.", "Licensed under the GNU General Public License, version 3."
    files = [(1, "LICENSE", mit), (2, "a/b/c/x.py", "print"), (3, "a/LICENSE.txt", gpl), (4, "a/COPYING", mit),
             (5, None, None), (6, "", ""), (7, "z/x.py", "# copyright nobody"), (8, "z/only", mit + "\n"),
             (9, "z/q/r", "x"), (9, "z/q/r", "x"), (None, "a/b", "# " + gpl + "\ncode " * 50)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string").withColumn("license", F.lit("x"))
    got = licenses.scan(df).collect()
    assert Counter(map(tuple, got)) == plain(files)
    by = {r.doc_id: (r.license, r.origin) for r in got}
    assert by[2][1] == "a" and by[9] == ("MIT", "z") and by[7] == ("MIT", "z") and by[5] == ("MIT", "")
    assert licenses.scan(df.limit(0)).count() == 0


def test_native(spark, docs):
    plan = licenses.scan(licenses.paths_of(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


GNU = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""


def test_wrapped_headers_and_tags(spark):
    text = {n: t for n, t in licenses.TEXTS if t.count("\n") > 5}
    mark = lambda t, m: "\n".join(f"{m} {x}".rstrip() for x in t.split("\n"))
    code = "\n" + "\n".join(f"value_{i} = compute(value_{i - 1}, other[{i}])" for i in range(300))
    holder = "Copyright (c) 2021 Ada Example and others\n\n"
    narrow = lambda t: "\n".join(textwrap.wrap(t, 32))
    files = [
        ("BSD-3-Clause", mark(holder + text["BSD-3-Clause"], "#") + code),
        ("BSD-2-Clause", "/*\n" + mark(holder + text["BSD-2-Clause"], " *") + "\n */" + code),
        ("MIT", mark(holder + text["MIT"], "//") + code), ("MIT", "/*\n" + holder + text["MIT"] + "*/" + code),
        ("GPL-3.0", mark(holder + GNU, "#") + code), ("GPL-3.0", mark(narrow(GNU), "--") + code),
        ("GPL-2.0", mark(GNU.replace("version 3", "version 2"), "#") + code),
        ("LGPL-2.1", mark(GNU.replace("version 3", "version 2.1").replace("GNU ", "GNU Lesser "), "#") + code),
        ("AGPL-3.0", mark(GNU.replace("GNU ", "GNU Affero "), "#") + code),
        ("MPL-2.0", "/* " + MPL + " */" + code), ("MPL-2.0", mark(narrow(MPL), ";") + code),
        ("MIT", "# SPDX-License-Identifier: MIT\n" + code), ("Apache-2.0", "/* SPDX-License-Identifier: Apache-2.0 */"),
        ("MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)",
         "<!-- SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0) -->" + code),
        (None, code), (None, "January 2004\n\nby\n\nthe source of the program is in the files" + code)]
    df = spark.createDataFrame([(i, f"d{i}/x.py", t) for i, (_, t) in enumerate(files)],
                               "doc_id long, path string, text string")
    got = {r.doc_id: r.own_license for r in licenses.scan(df).collect()}
    assert got == {i: n for i, (n, _) in enumerate(files)}


def test_full_texts(spark):
    text = [(n, t) for n, t in licenses.TEXTS if t.count("\n") > 5]
    assert len(text) == 15
    files = [(2 * i, f"{n}/about", "Copyright 2020 Somebody Else\n\n" + t) for i, (n, t) in enumerate(text)]
    files += [(2 * i + 1, f"{n}/src/x", "print") for i, (n, _) in enumerate(text)]
    got = {r.doc_id: r.license for r in licenses.scan(
        spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got == {2 * i + k: n for i, (n, _) in enumerate(text) for k in (0, 1)}
