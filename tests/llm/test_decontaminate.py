"""Benchmark passages against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from claimwright.llm import decontaminate
from tests.llm import helpers as h

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, "Seven old wizards mix strange potions in a deep, dark cave under the hill."), (2, "x"), (3, None),
         (4, "..."), (None, "doucement dans le jardin"), (5, "seven old wizards mix strange potions in a deep dark cave"),
         (5, "la pluie"), (6, "aaa bbb")]


def lower(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return WORD.findall((text or "").translate(table))


def brute(rows, items):
    wanted = {}
    for item, text in items:
        own = lower(text)
        if own:
            for w in h.windows(own, min(10, len(own))):
                wanted.setdefault(w, set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        own, hit, found = lower(text), set(), set()
        for n in {len(w) for w in wanted}:
            for k, w in enumerate(h.windows(own, n)):
                if w in wanted:
                    hit |= set(range(k, k + n))
                    found |= wanted[w]
        out.append((doc_id, len(own), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def check(spark, rows, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(h.documents(spark, rows, extra="items"), benchmark)
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got.collect()) == Counter(brute(rows, items))


def test_awkward_rows(spark):
    check(spark, h.awkward_rows(), ITEMS)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    check(spark, h.awkward_rows(), ITEMS)


def test_empty_tables(spark):
    check(spark, [], ITEMS)
    check(spark, h.awkward_rows(), [])


def test_plan_has_no_python(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(h.documents(spark, h.awkward_rows()), benchmark)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
