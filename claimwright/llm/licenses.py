"""Licences of files: sparse TF-IDF cosine of headers and licence files to templates, and inheritance from directories.

A template is a notice, the first sentence of a licence, or a whole licence text. A window as long as a template, in
words, slides over a file's whole text and across its line breaks, so a notice is found inside a paragraph, wrapped or
behind comment signs. Whole licence texts are compared with the whole file as well. Weights are tf-idf, with document
frequencies of the templates' words counted over all lines of all files; other words count as unseen ones. A cheap bound,
never below the cosine, picks the windows that are compared exactly. A window that adds nothing by beginning at a word of
no weight is not looked at. The best cosine at or above LIKE (SHORT_LIKE for templates below SHORT words, where a single
word tells licences apart) gives a file's own licence; of equal ones the first template, then the first place. A whole
licence text at or above WHOLE_LIKE comes before notices, since licences share sentences.

A file declares a licence for its directory if it is named like a licence file or has its licence in its header, the
first HEADER lines. A file without a licence of its own has the one declared by the nearest directory above it:
directories are joined with their ancestors, not files, and a file then meets its directory once.

Defined cases: null and empty texts have no licence of their own but inherit; a null path has no directory; of several
declarations of a directory the one with the highest cosine holds, then the last by name; ids may be null or repeated,
each row comes back once; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import Rolling, buffer_of, chunks, stored, word_spans

LIKE = 0.7
#: Words of a template below which its least cosine is SHORT_LIKE.
SHORT, SHORT_LIKE = 10, 0.85
WHOLE_LIKE = 0.9
HEADER = 3
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)(\..*)?$"

# Notices, first sentences of licence files and tags.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this "
                "work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
                   "REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "ISC", "MIT",
        "MPL-2.0")),
]

# The disclaimers and whole texts of short licences.
MIT_DISCLAIMER = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_DISCLAIMER = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
BSD_3 = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
WHOLE_TEXTS = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
     + MIT_DISCLAIMER),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
     + ISC_DISCLAIMER),
    ("BSD-3-Clause", BSD_2 + BSD_3 + BSD_DISCLAIMER),
    ("BSD-2-Clause", BSD_2 + BSD_DISCLAIMER),
]
TEMPLATES += WHOLE_TEXTS

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
APART = np.ones(256, bool)
APART[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


class Words:
    """Words of many texts, as places in a sorted vocabulary of hashes."""

    def __init__(self, vocabulary: list[bytes]):
        self.lane = Rolling(0)
        data, offsets = buffer_of(pa.array(vocabulary, pa.binary()))
        hashes = self.lane.ranges(self.lane.prefix(data), offsets[:-1], offsets[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Of each word its place in the vocabulary or -1, its start and its end; the bytes and where texts begin."""
        data, offsets = buffer_of(texts)
        lowered = LOWER[data]
        starts, ends = word_spans(lowered, offsets, APART)
        hashes = self.lane.ranges(self.lane.prefix(lowered), starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        place = np.where(self.hashes[at] == hashes, self.order[at], -1)
        return place, starts, ends, data, offsets


def line_begins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    begins = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    return begins[begins < len(data)]


def tfidf(words: list[bytes], idf: dict[bytes, float], unseen: float) -> dict[bytes, float]:
    weights = {w: n * idf.get(w, unseen) for w, n in Counter(words).items()}
    norm = sum(v * v for v in weights.values()) ** 0.5
    return {w: v / norm for w, v in weights.items()}


def cosine(words: list[bytes], template: dict[bytes, float], idf: dict[bytes, float], unseen: float) -> float:
    weights = tfidf(words, idf, unseen)
    return round(sum(v * weights.get(w, 0.0) for w, v in template.items()), 9)


def is_whole_text(k: int) -> bool:
    return k >= len(TEMPLATES) - len(WHOLE_TEXTS)


def ranked(k: int, score: float) -> float:
    """What matches of templates are ordered by."""
    return score + (is_whole_text(k) and score >= WHOLE_LIKE)


def scan(files: DataFrame, *, like: float = LIKE) -> DataFrame:
    """The files' columns but the text, with own (licence), cosine, line (number from 0) where the best window begins and
    whether the whole file is what was compared (0 is then its line)."""
    vocabulary = sorted({w for _, t in TEMPLATES for w in words_of(t)})
    context = files.sparkSession.sparkContext

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = Words(vocabulary), np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            for part in chunks(batch):
                place, starts, _, data, offsets = words.of(part.column("text"))
                begins = line_begins(data, offsets)
                known = place >= 0
                line = np.searchsorted(begins, starts[known], side="right") - 1
                pairs = np.unique(line * len(vocabulary) + place[known])
                counts[:-1] += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
                counts[-1] += len(begins)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], names=["word", "n"])

    counted = (files.select("text").mapInArrow(frequencies, "word long, n long").groupBy("word").agg(F.sum("n"))
               .collect())  # one row for each word of the templates
    counts = {r[0]: r[1] for r in counted}
    total = counts.get(len(vocabulary), 0)
    unseen = float(np.log(total + 1)) + 1
    idf = {w: unseen - float(np.log(counts.get(k, 0) + 1)) for k, w in enumerate(vocabulary)}
    fixed = context.broadcast((idf, unseen))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (idf, unseen) = Words(vocabulary), fixed.value
        split = [words_of(t) for _, t in TEMPLATES]
        weights = [tfidf(t, idf, unseen) for t in split]
        least = [max(like, SHORT_LIKE) if len(t) < SHORT else like for t in split]
        value = np.array([idf[w] for w in vocabulary] + [unseen])
        matrix = np.array([[t.get(w, 0.0) for w in vocabulary] for t in weights]) * value[:-1]
        for batch in batches:
            for part in chunks(batch):
                place, starts, ends, data, offsets = words.of(part.column("text"))
                best: list[tuple | None] = [None] * part.num_rows
                bounds = np.searchsorted(starts, offsets)  # each text's first word
                owner = np.searchsorted(offsets, starts, side="right") - 1
                squares = np.concatenate([[0.0], np.cumsum(value[place] ** 2)])
                known = np.flatnonzero(place >= 0)
                begins = line_begins(data, offsets)

                def compare(k: int, first: np.ndarray, last: np.ndarray, dots: np.ndarray, whole: bool) -> None:
                    """Windows of template k, best bounds first, exactly where they can be better than what is known."""
                    # Not below the cosine: equal words count by themselves in the norm.
                    bound = dots / np.sqrt(np.maximum(squares[last] - squares[first], 1e-12))
                    some = np.flatnonzero(bound >= least[k] - 1e-6)
                    for i in some[np.argsort(-bound[some], kind="stable")].tolist():
                        a, b = int(first[i]), int(last[i])
                        row = int(owner[a])
                        if best[row] is not None and ranked(k, float(bound[i]) + 1e-6) < best[row][5]:
                            continue
                        score = cosine(words_of(data[starts[a]:ends[b - 1]].tobytes().decode()), weights[k], idf, unseen)
                        line = 0 if whole else int(np.searchsorted(begins, starts[a], side="right") - 1
                                                   - np.searchsorted(begins, offsets[row]))
                        rank = ranked(k, score)
                        if score >= least[k] and (best[row] is None or (-rank, k, line) <
                                                  (-best[row][5], best[row][4], best[row][2])):
                            best[row] = (TEMPLATES[k][0], score, line, whole, k, rank)

                for k, own in enumerate(split):
                    gains = matrix[k, place[known]]
                    some = gains > 0
                    at, sums = known[some], np.concatenate([[0.0], np.cumsum(gains[some])])
                    if not len(at):
                        continue
                    last = np.minimum(at + len(own), bounds[owner[at] + 1])
                    dots = sums[np.searchsorted(at, last)] - sums[:-1]
                    compare(k, at, last, dots, False)
                    if is_whole_text(k):
                        rows = np.unique(owner[at])
                        first, last = bounds[rows], bounds[rows + 1]
                        dots = sums[np.searchsorted(at, last)] - sums[np.searchsorted(at, first)]
                        compare(k, first, last, dots, True)
                out = {c: part.column(c) for c in others}
                for i, (name, kind) in enumerate((("own", pa.string()), ("cosine", pa.float64()), ("line", pa.int64()),
                                                  ("whole", pa.bool_()))):
                    out[name] = pa.array([b and b[i] for b in best], kind)
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    others = [c for c in files.columns if c != "text"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema if f.name != "text")
    return files.mapInArrow(match, f"{kinds}, own string, cosine double, line long, whole boolean")


def inherit(scanned: DataFrame) -> DataFrame:
    """With `license` (own or inherited) and `declared_in` (the directory it comes from)."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    scanned = scanned.withColumn("folder", F.when(F.col("path").isNotNull(), folder))
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(FILE_NAMES)
    declared = (scanned.where(F.col("own").isNotNull() & F.col("folder").isNotNull() & (named | (F.col("line") < HEADER)))
                .groupBy("folder").agg(F.max(F.struct("cosine", "own")).alias("top"))
                .select(F.col("folder").alias("above"), F.col("top.own").alias("declared")))
    folders = scanned.where(F.col("folder").isNotNull()).select("folder").distinct()
    parts = F.split("folder", "/")
    ancestors = folders.select("folder", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
            k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("above")))).alias("a"))
    nearest = (ancestors.select("folder", "a.depth", "a.above").join(declared, "above")
               .groupBy("folder").agg(F.max(F.struct("depth", "above", "declared")).alias("near"))
               .select("folder", "near.above", "near.declared"))
    inherited = F.col("own").isNull() & F.col("declared").isNotNull()
    return (scanned.join(nearest, "folder", "left")
            .withColumn("license", F.coalesce("own", "declared"))
            .withColumn("declared_in", F.when(inherited, F.col("above"))).drop("folder", "above", "declared"))


def file_licenses(files: DataFrame) -> DataFrame:
    """doc_id, path, own, cosine, line, whole, license, declared_in for every row of (doc_id, path, text)."""
    files = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return inherit(stored(scan(files), "scanned"))


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files: a source is a tree of folders of 1000 and of 50 neighbouring ids."""
    return docs.select("doc_id", "text", F.concat_ws(
        "/", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 50),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))
