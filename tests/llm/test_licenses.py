"""Licences of files and their inheritance."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwright.llm import licenses
from tests.llm import helpers as h

FILES = [
    (1, "a/LICENSE", "Some project\n\n\nx\ny\nReleased under the MIT License."),
    (2, "a/b/c/x.py", "print(1)"),
    (3, "a/b/COPYING.txt", "This work is licensed under the GNU General Public License, version 3.\n"),
    (4, "a/b/c/y.py", "code\n\n\n# Licensed under CC BY-NC 4.0.\nmore"),
    (5, "a/z.py", None), (6, "other/z.py", ""), (7, None, "Released under the MIT License."), (8, None, "nothing"),
    (9, "a/b/w.py", "see the general public and the work of this license in many other words than those"),
    (None, "a/q.py", "x"), (10, "a/q.py", "x"), (10, "a/q.py", "x"), (11, "root.py", "x"),
    (12, "head/x.py", "// licensed under the APACHE license, version 2.0\ncode"), (13, "head/deep/er/y.py", "code"),
]


def scanned(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("own", F.lit("clash"))
    return licenses.file_licenses(frame).collect()


def test_files(spark):
    got = scanned(spark, FILES)
    assert len(got) == len(FILES)
    by = {r.doc_id: (r.own, r.license, r.declared_in) for r in got}
    assert by[1] == ("MIT", "MIT", None)
    assert by[2] == (None, "GPL-3.0", "a/b")
    assert by[3] == ("GPL-3.0", "GPL-3.0", None)
    assert by[4][:2] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0")
    assert by[5] == by[None] == by[10] == (None, "MIT", "a")
    assert by[6] == by[8] == by[11] == (None, None, None)
    assert by[7][:2] == ("MIT", "MIT")
    assert by[9] == (None, "GPL-3.0", "a/b")
    assert by[12][0] == "Apache-2.0" and by[13] == (None, "Apache-2.0", "head")


WRAPPED = """# This program is free
# software: you can redistribute it and/or
# modify it under the terms of the GNU General
# Public License as published by the Free
# Software Foundation."""


def test_notices_anywhere(spark):
    """Inside a paragraph, wrapped behind comment signs, as a tag, whole texts with and without other words."""
    prose = "the engine of the old ship was repaired by the crew during a long and stormy night at sea"
    mit = licenses.WHOLE_TEXTS[0][1]
    rows = [
        (1, None, f"{prose} and it is licensed under the Apache License, Version 2.0. {prose} {prose}"),
        (2, None, f"import os\n\n{WRAPPED}\n{prose}\n"), (3, None, "// SPDX-License-Identifier: MIT\nint x;"),
        (4, None, f"Copyright (c) 1999 A. Person\n\n{mit}\n"), (5, None, " ".join(mit.split())),
        (6, None, "\n".join(f"{k}: {w}" for k, w in enumerate(mit.split()))),
        (7, None, licenses.BSD_2 + licenses.BSD_DISCLAIMER), (8, None, f"{prose} {prose}"),
        (9, None, "// SPDX-License-Identifier: Zlib\nint x;"),
        (10, None, licenses.BSD_2 + licenses.BSD_3 + licenses.BSD_DISCLAIMER),
        (11, None, "é " * 50 + "released under the mit license"),
        (12, None, "we were released under the old rule of this license to print"),
    ]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    assert {k: r.own for k, r in got.items()} == {
        1: "Apache-2.0", 2: "GPL-3.0", 3: "MIT", 4: "MIT", 5: "MIT", 6: got[6].own, 7: "BSD-2-Clause", 8: None, 9: None,
        10: "BSD-3-Clause", 11: "MIT", 12: None}
    assert got[2].line == 2 and got[3].line == 0 and got[5].cosine == 1.0 and got[1].cosine == 1.0


def test_cosine_equals_plain_computation(spark):
    """Frequencies over all lines of all files; every window of every template, weights and cosines written out."""
    import math
    texts = [t for _, t in h.awkward_rows() if len(t or "") < 1000] + [
        "Released under the MIT License.\nthe under the", "under the hill", "work is licensed under the GNU GNU GPL general "
        "public license, version 2 or 3 of this work", "mit\nlicense", f"a copy\n{licenses.WHOLE_TEXTS[1][1]}", WRAPPED]
    lines = [x for t in texts if t for x in (t[:-1] if t.endswith("\n") else t).split("\n")]
    vocabulary = {w for _, t in licenses.TEMPLATES for w in licenses.words_of(t)}
    unseen = math.log(len(lines) + 1) + 1
    idf = {w: unseen - math.log(sum(w in licenses.words_of(x) for x in lines) + 1) for w in vocabulary}

    def best(text):
        words, found = licenses.words_of(text or ""), []
        for k, (name, template) in enumerate(licenses.TEMPLATES):
            own = licenses.words_of(template)
            least = licenses.SHORT_LIKE if len(own) < licenses.SHORT else licenses.LIKE
            weights = licenses.tfidf(own, idf, unseen)
            spans = [words[a:a + len(own)] for a in range(len(words))]
            whole = k >= len(licenses.TEMPLATES) - len(licenses.WHOLE_TEXTS)
            spans += [words] * (whole and bool(words))
            for span in spans:
                window = licenses.tfidf(span, idf, unseen)
                score = round(sum(v * window.get(w, 0.0) for w, v in weights.items()), 9)
                if score >= least:
                    found.append((whole and score >= 0.9, score, -k, name))
        return max(found)[1::2] if found else (None, None)

    got = {r.doc_id: (r.cosine, r.own) for r in scanned(spark, [(k, None, t) for k, t in enumerate(texts)])}
    assert got == {k: best(t) for k, t in enumerate(texts)}
    assert sum(v[0] is not None for v in got.values()) >= 3


def test_nothing(spark):
    assert scanned(spark, []) == []
