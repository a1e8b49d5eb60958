"""Language of texts by Bayesian fusion of four kinds of evidence.

- The text: likelihood under byte-trigram models, one for each language of any labelled row, fitted on a bounded sample
  of each language's different texts.
- The declared language and the address suffix: how often each goes with each language, over all rows.
- The host: its share of languages, smoothed towards that of its suffix, and that towards all rows.

Counts come from grouped aggregation of the texts' own most likely languages over all rows, so no evidence is counted
for a row by itself alone. A text that is less likely under every language than under a model of no language, or has no
letters, is `und`; it is not kept.

Defined cases: null and empty texts are `und`; missing declarations, addresses and hosts give no evidence; null ids stay
null; every row comes back once; extra columns are ignored; without any labelled row all texts are `und`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.llm.common import buffer_of, chunks, stored

#: Labelled texts that the text models are fitted on, shared out evenly, but with room for so many of each language.
SAMPLE_ROWS, LANGUAGE_ROWS = 2000, 500
#: Bits a byte costs under the model of no language, and its prior probability: a short text is no proof against one.
NO_LANGUAGE_BITS, NO_LANGUAGE_PRIOR = 6.5, 1e-6
#: Trigrams of a text are not independent: their evidence counts for less.
TEMPER = 0.1
#: Rows of the parent that a host's or suffix's prior weighs.
STRENGTH = 20.0
SMOOTH = 0.5
#: Count added to each of the 256 continuations of two bytes.
SPREAD = 0.02
UND = "und"


def symbols(data: np.ndarray) -> np.ndarray:
    """Bytes with letters in lower case and every other ASCII character as a space."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    return table[data]


def trigrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 16-bit code of each byte with the two before it, and of the two alone."""
    x = np.concatenate([np.full(2, 32, np.uint8), data]).astype(np.uint32)
    pair = x[:-2] * np.uint32(256) + x[1:-1]
    code = ((pair * np.uint32(2654435761)) ^ (x[2:] * np.uint32(40503 * 65536 + 1))) * np.uint32(2246822519)
    return (code >> np.uint32(16)).astype(np.int64), pair.astype(np.int64)


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each language of the batches: counts of codes and of byte pairs, and a code's byte pair."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in chunks(batch):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                code, pair = trigrams(symbols(np.frombuffer(text.encode(), np.uint8)))
                own = held.setdefault(lang, np.zeros((3, 65536), np.int64))
                np.add.at(own[0], code, 1)
                np.add.at(own[1], pair, 1)
                np.maximum.at(own[2], code, pair)
    yield pa.RecordBatch.from_arrays(
        [pa.array(held.keys(), pa.string()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
        names=["lang", "counts"])


def fit(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages of a small table (lang, text), and the log-probability of each trigram code given the two bytes
    before it in each language. What reaches the driver are three tables of 65,536 counts for each language."""
    counts: dict[str, np.ndarray] = {}
    for r in sample.repartition("lang").mapInArrow(count_trigrams, "lang string, counts binary").collect():
        counts[r.lang] = np.frombuffer(r.counts, np.int64).reshape(3, 65536)
    tables = []
    for name in sorted(counts):
        codes, pairs, pair_of = counts[name]
        unseen = codes.sum() / 2000
        context = np.where(codes > 0, pairs[pair_of], unseen) + 256 * SPREAD
        tables.append(np.minimum(np.log(codes + SPREAD) - np.log(context), 0))
    return sorted(counts), np.array(tables, np.float32).T.copy() if tables else np.zeros((65536, 0), np.float32)


def text_scores(rows: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """The rows without text, with `letters` (bytes of letters) and `scores` (log-likelihood by language)."""
    model = rows.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value
        for batch in batches:
            for part in chunks(batch):
                data, offsets = buffer_of(part.column("text"))
                data = symbols(data)
                codes, scores = trigrams(data)[0], np.zeros((len(offsets) - 1, weights.shape[1]))
                sums = np.zeros(len(data) + 1)
                for k in range(weights.shape[1]):  # one language at a time: memory does not grow with their number
                    np.cumsum(weights[:, k][codes], out=sums[1:], dtype=np.float64)
                    scores[:, k] = sums[offsets[1:]] - sums[offsets[:-1]]
                letters = np.concatenate([[0], np.cumsum(data != 32)])
                out = {c: part.column(c) for c in others}
                out["letters"] = pa.array(np.diff(letters[offsets]))
                out["bytes"] = pa.array(np.diff(offsets))
                out["scores"] = pa.array(list(scores), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    others = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(score, f"{kinds}, letters long, bytes long, scores array<double>")


def address_parts(url: str) -> tuple[Column, Column]:
    """Host and suffix (its last label) of an address."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    host = F.when(host != "", host)
    return host, F.regexp_extract(host, r"([^.]+)$", 1)


def markup_language(html: str) -> Column:
    """The language that a page declares, without its region."""
    found = F.lower(F.regexp_extract(F.col(html), r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(found != "", found)


def sampled(labelled: DataFrame) -> DataFrame:
    """A bounded number of different texts (lang, text) of every language there is, those of the smallest hashes.

    Hashes are drawn first, and no task sends on more of a language than are drawn; texts are only read for drawn ones."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL") \
        .select("lang", "text", F.xxhash64("text").alias("hash"))
    room = max(SAMPLE_ROWS // max(labelled.select("lang").distinct().count(), 1), LANGUAGE_ROWS)
    drawn = (labelled.select("lang", "hash").distinct()
             .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash")))
             .where(F.col("place") <= room).drop("place"))
    return labelled.join(F.broadcast(drawn), ["lang", "hash"]).dropDuplicates(["lang", "hash"]).select("lang", "text")


def identify(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, lang, probability, declared, text_lang, kept for rows (doc_id, text, declared, suffix, host).

    `labelled` (text, lang) is sampled by language and a hash of the text for the text models; every language in it can
    be an answer."""
    names, table = fit(sampled(labelled))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       *(F.col(c).cast("string").alias(c) for c in ("declared", "suffix", "host")))
    scored = text_scores(rows, names, table)
    if not names:
        return scored.select("doc_id", F.lit(UND).alias("lang"), F.lit(0.0).alias("probability"), "declared",
                             F.lit(UND).alias("text_lang"), F.lit(False).alias("kept"))
    score = {n: F.col("scores")[k] for k, n in enumerate(names)}
    best = F.array_max("scores")
    text_lang = F.lit(names[-1])
    for n in reversed(names[:-1]):
        text_lang = F.when(score[n] == best, n).otherwise(text_lang)
    none = -NO_LANGUAGE_BITS * np.log(2) * F.col("bytes") + float(np.log(NO_LANGUAGE_PRIOR))
    worded = (F.col("letters") > 0) & (best > none)
    scored = stored(scored.withColumn("text_lang", F.when(worded, text_lang).otherwise(UND)), "scores")

    known = scored.where(F.col("text_lang") != UND)
    counts = [F.count_if(F.col("text_lang") == n).cast("double").alias(f"c{k}") for k, n in enumerate(names)]
    everything = known.agg(*counts).first()
    total = sum(x or 0 for x in everything)
    base = [((x or 0) + 1) / (total + len(names)) for x in everything]

    def shares(frame: DataFrame, parents: list[Column], prefix: str) -> list[Column]:
        n = sum((F.coalesce(F.col(f"{prefix}{k}"), F.lit(0.0)) for k in range(len(names))), F.lit(0.0))
        return [(F.coalesce(F.col(f"{prefix}{k}"), F.lit(0.0)) + STRENGTH * p) / (n + STRENGTH)
                for k, p in enumerate(parents)]

    def counted(key: str, prefix: str) -> DataFrame:
        by = known.where(F.col(key).isNotNull()).groupBy(key).agg(*counts)
        return by.select(key, *(F.col(f"c{k}").alias(f"{prefix}{k}") for k in range(len(names))))

    joined = scored
    for key, prefix in (("declared", "d"), ("suffix", "s"), ("host", "h")):
        joined = joined.join(counted(key, prefix), key, "left")
    # P(declared | language), up to a factor that is the same for all languages.
    likely = [F.when(F.col("declared").isNull(), 0.0)
              .otherwise(F.log((F.coalesce(F.col(f"d{k}"), F.lit(0.0)) + SMOOTH) / (float(everything[k] or 0) + 1.0)))
              for k in range(len(names))]
    prior = shares(joined, shares(joined, [F.lit(float(b)) for b in base], "s"), "h")
    joined = joined.withColumns({f"e{k}": TEMPER * F.col("scores")[k] + likely[k] + F.log(prior[k])
                                 for k in range(len(names))})
    top = F.greatest(*(F.col(f"e{k}") for k in range(len(names)))) if len(names) > 1 else F.col("e0")
    lang = F.lit(names[-1])
    for k in reversed(range(len(names) - 1)):
        lang = F.when(F.col(f"e{k}") == top, names[k]).otherwise(lang)
    sure = 1 / sum((F.exp(F.col(f"e{k}") - top) for k in range(len(names))), F.lit(0.0))
    kept = F.col("text_lang") != UND
    return joined.select("doc_id", F.when(kept, lang).otherwise(UND).alias("lang"),
                         F.when(kept, sure).otherwise(0.0).alias("probability"), "declared", "text_lang",
                         kept.alias("kept"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents declare a language in `lang` and have their source as host."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").alias("declared"),
                       F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))


def page_evidence(pages: DataFrame) -> DataFrame:
    host, suffix = address_parts("url")
    text = F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->", " "), "<[^>]*>", " ")
    return pages.select(F.col("page_id").alias("doc_id"), text.alias("text"), markup_language("html").alias("declared"),
                        suffix.alias("suffix"), host.alias("host"))
