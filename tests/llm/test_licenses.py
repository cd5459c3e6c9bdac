"""Cosines against a plain computation; inheritance against a walk up the path."""

import math
import re
import textwrap
from collections import Counter

import pytest

from daybook.llm import licenses as lic


def files():
    mit, apache = "Released under the MIT License.", "// Licensed under the Apache License, Version 2.0.\nmore words here"
    return [
        (1, "a/LICENSE", mit), (2, "a/x.py", "no licence words, none"), (3, "a/b/c/y.py", "code only"),
        (4, "a/b/LICENSE.txt", apache), (5, "a/b/z.py", None), (6, "a/own.py", "# this work is licensed under the GNU\n# general public license, version 3\nx"),
        (7, "top.py", "nothing"), (8, "q/r.py", ""), (9, None, mit), (10, None, None), (None, "a/b/n.py", "text"),
        (11, "a/b2/w.py", "license of poetry and licensed pigeons in warrant of kings"), (2, "a/x.py", "no licence words, none"),
        (12, "q/copying", "Copyright"), (13, "a/long.py", "word " * 100_000 + "\n" + mit), (14, "/abs/LICENSE", mit), (15, "/abs/d/e.py", "x"),
    ]


def plain_matches(rows):
    term = lambda t: re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower())
    every = {"header": lic.TEMPLATES, "title": lic.TITLES, "whole": lic.WHOLE}
    vocab = {w for known in every.values() for _, t in known for w in term(t)}
    df = Counter(w for _, _, t in rows if t for w in vocab & {x for x in re.split(r"[^a-z0-9.-]+|[.-]+(?![a-z0-9])", t.lower())})
    idf = {w: math.log((len(rows) + 1) / (df[w] + 1)) + 1 for w in vocab}
    rare = max(idf.values())

    def vec(t):
        v = {w: n * idf.get(w, rare) for w, n in Counter(term(t)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if v else {}
    vectors = {kind: [(name, vec(t)) for name, t in known] for kind, known in every.items()}
    out = {}
    for i, path, t in rows:
        low = (t or "").lower()
        lines = low.split("\n")
        tried = []
        for k, line in enumerate(lines):
            if any(c in line for c in lic.CUES):
                tried += [("header", " ".join(lines[a:b])) for a in (max(k - 1, 0), k) for b in (k + 1, k + 2)]
        if path and re.search(lic.LICENCE_FILE, path.split("/")[-1]):
            full = [x for x in lines if x.strip()]
            tried += [("title", " ".join(full[:k])) for k in (1, 2, 3)] + [("whole", low)]
        hits = []
        for kind, s in tried:
            v = vec(s)
            scored = [(round(sum(x * w.get(y, 0) for y, x in v.items()), 9), name) for name, w in vectors[kind]]
            hits += [(kind != "whole", -c, name) for c, name in scored if c >= (lic.MIN_WHOLE if kind == "whole" else lic.MIN_COSINE)]
        if hits:
            part, c, name = min(hits)
            third = any(p and n == "BSD-3-Clause" for p, _, n in hits)
            out[i] = (-c, "BSD-3-Clause" if part and third and name == "BSD-2-Clause" else name)
    return out


def wrap(text, start=""):
    return "\n".join(start + x for x in textwrap.wrap(text, 70))


WHOLE = dict(lic.WHOLE)
APACHE = "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions."
GPL2 = ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.\n"
        " Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n"
        "  The licenses for most software are designed to take away your\nfreedom to share and change it.  By contrast, the GNU General Public\n"
        "License is intended to guarantee your freedom to share and change free\nsoftware. Some other software is covered by\nthe GNU Lesser General Public License instead.")
GPL_NOTE = ("# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
            "# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.\n")


def test_whole_files(spark):
    """Licence files as they are found, and the same wording at the top of sources."""
    cases = [("mit/LICENSE", "Copyright (c) 2020 Someone\n\n" + wrap(WHOLE["MIT"].capitalize()), "MIT"), ("apache/LICENSE", APACHE, "Apache-2.0"),
             ("bsd2/LICENSE.txt", "Copyright 2011 The Some Authors. All rights reserved.\n" + wrap(WHOLE["BSD-2-Clause"]), "BSD-2-Clause"),
             ("bsd3/LICENCE", "Copyright 2011 The Some Authors. All rights reserved.\n" + wrap(WHOLE["BSD-3-Clause"]), "BSD-3-Clause"),
             ("gpl/COPYING", GPL2, "GPL-2.0"), ("isc/license.md", "Copyright 1999 me\n" + wrap(WHOLE["ISC"]), "ISC"),
             ("un/UNLICENSE", wrap(WHOLE["Unlicense"]), "Unlicense"), ("src/mit.c", wrap(WHOLE["MIT"], " * ") + "\nint x;", "MIT"),
             ("src/bsd2.c", wrap(WHOLE["BSD-2-Clause"], "// ") + "\nint x;", "BSD-2-Clause"), ("src/gpl.py", GPL_NOTE + "x = 1", "GPL-2.0"),
             ("src/bsd3.c", wrap(WHOLE["BSD-3-Clause"], "// ") + "\nint x;", "BSD-3-Clause"), ("none/notice", "Notice to all: the shop closes at five.", None)]
    rows = [(k, p, t) for k, (p, t, _) in enumerate(cases)] + [(100 + k, f"dir{k}/x.py", f"code of file {k} and the rest of it") for k in range(40)]
    want = plain_matches(rows)
    got = {r.doc_id: r for r in lic.licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert {k: got[k].license for k in range(len(cases))} == {k: x for k, (_, _, x) in enumerate(cases)}
    assert {k: r.license for k, r in got.items() if r.via == "header"} == {k: n for k, (_, n) in want.items()}


def test_scan(spark):
    rows = files()
    df = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, path string, text string, license string, cosine double")
    got = lic.licenses(df.repartition(3)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    want = plain_matches(rows)
    by = {r.doc_id: r for r in got}
    assert {i for i, r in by.items() if r.via == "header"} == set(want)
    for i, (c, name) in want.items():
        assert by[i].license == name and by[i].cosine == pytest.approx(c, abs=1e-6)
    assert want[1][1] == "MIT" and want[4][1] == "Apache-2.0" and want[6][1] == "GPL-3.0"
    inherited = {2: ("MIT", "a"), 3: ("Apache-2.0", "a/b"), 5: ("Apache-2.0", "a/b"), None: ("Apache-2.0", "a/b"),
                 15: ("MIT", "abs")}
    for i, x in inherited.items():
        assert (by[i].license, by[i].from_dir.strip("/")) == x and by[i].via == "directory"
    for i in (7, 8, 10):
        assert by[i].license is None and by[i].via is None


def test_terms(spark):
    """As the plain pattern finds them, also where points and dashes meet, and in a text of 100,000 dotted parts."""
    texts = ["a.b-c", "a..b", "-a.", "a.-b", ".", "", "GPL-3.0, (v2.0)", "x--y..z-", "ä.b é-", "...a", "a\nb.c\n.d", "license " + "a." * 100_000 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.t for r in df.select("k", lic._terms("text").alias("t")).collect()}
    assert got == {k: re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower()) for k, t in enumerate(texts)}
    dotted = spark.createDataFrame([(1, "a/b.py", texts[-1]), (2, "a/LICENSE", "released under the mit license")], "doc_id long, path string, text string")
    assert {r.doc_id: (r.license, r.via) for r in lic.licenses(dotted).collect()} == {1: ("MIT", "directory"), 2: ("MIT", "header")}


def test_empty(spark):
    assert lic.licenses(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0
