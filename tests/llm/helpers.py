"""Small tables and brute-force versions of the operators."""

from __future__ import annotations

import itertools
import re

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

FIRST = ("the quick brown fox jumps over the lazy dog while seven old wizards mix strange potions in a deep dark "
         "cave under the hill and nobody ever comes to look for them because the path is long and hard to find")
SECOND = ("un petit chat noir dort sur le toit de la maison pendant que la pluie tombe doucement dans le jardin et "
          "que les enfants jouent avec des billes devant la porte de la cuisine sans faire de bruit")


def documents(spark: SparkSession, rows: list[tuple], extra: str = "") -> DataFrame:
    """Documents of (doc_id, text) or whole rows; with `extra`, a further column of that name."""
    whole = [r if len(r) == 5 else (*r, "en", "src0", len(r[1] or "")) for r in rows]
    out = spark.createDataFrame(whole, DOCUMENTS)
    if extra:
        from pyspark.sql import functions as F
        out = out.withColumn(extra, F.lit("x"))
    return out


def awkward_rows() -> list[tuple]:
    """Nulls, empty, blank and very long texts, ties, repeated rows, a repeated id and odd characters."""
    long_text = " ".join(f"w{k % 977} {FIRST}" for k in range(300))
    return [
        (1, FIRST), (2, None), (3, ""), (4, " \t\n "), (5, FIRST), (5, FIRST), (6, SECOND), (6, FIRST + " " + SECOND),
        (None, FIRST), (None, None), (7, long_text), (8, "x"), (9, "a" * 3000), (10, "ÀÉ ß 日本語 😀 \x00 end"),
        (11, "mail a.b+c@mail.example.com now +1 (988) 555-2485 or 42.144.35.254 card 4111 1111 1111 1111 end"),
        (12, FIRST.replace("wizards", "witches")), (13, SECOND.upper()),
    ]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def windows(items: list, n: int) -> list[tuple]:
    return [tuple(items[k:k + n]) for k in range(len(items) - n + 1)]


def components(nodes: list, links: list[tuple]) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def pairs(items):
    return itertools.combinations(items, 2)


@pytest.fixture
def nothing(spark):
    return documents(spark, [])
