"""Benchmark passages in documents: a prefix-filtered set join on word shingles, in DataFrame operations only.

An item's window (10 consecutive words; a shorter item is one window) is a set of shingles of three words. A document
that holds the window holds all of its shingles, so by the prefix principle one shingle is necessary: the rarest over
the documents is joined. The document's length and the shingle's place in the window bound where the window may begin,
and what is left is verified word for word: the shingles that cover the window must stand at their places.

Documents are read once. Their shingles meet the items' distinct shingles; what remains (`matches`) is stored, and
rarity, candidates and verification come from it. Items' tables are broadcast up to BROADCAST_ROWS rows and joined by
shuffle beyond that.

Defined cases: null and empty texts have no words; items without words are ignored; a null item id is the empty name;
repeated items count once by id; each row of `docs` comes back once, also without an id; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.llm.common import order_id, stored

WINDOW = 10
SHINGLE = 3
#: Rows of an items' table that is broadcast; a row has some ten words at most, so this is about 20 MB.
BROADCAST_ROWS = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands for the document itself among its shingles: no shingle has an empty word.
WHOLE = " " * (SHINGLE - 1)


def words(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def limited(frame: DataFrame) -> DataFrame:
    """Marked for broadcast if it is small."""
    small = frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(frame) if small else frame


def item_windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(passage, length) of each different window, and (passage, item) for the items that have it."""
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                         words("text").alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    each = (named.withColumn("length", length)
            .withColumn("first", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)))
            .select("item", "length", F.array_join(F.slice("words", F.col("first"), F.col("length")), " ")
                    .alias("passage")).distinct())
    return each.select("passage", "length").distinct(), each.select("passage", "item")


def shingles(passages: DataFrame) -> DataFrame:
    """passage, length, size, offset, token: the shingles of each window; short ones have shorter shingles."""
    split = passages.withColumn("words", F.split("passage", " ")).withColumn("size", F.least("length", F.lit(SHINGLE)))
    return (split.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size"))))
            .select("passage", "length", "size", "offset",
                    F.array_join(F.slice("words", F.col("offset") + 1, F.col("size")), " ").alias("token")))


def document_shingles(docs: DataFrame, size: int) -> DataFrame:
    """id, copy, doc_id, n_words, place, token: the shingles of one size, and a row for the document itself."""
    columns = [f"w{k}" for k in range(size)]
    shifted = [F.slice("words", k + 1, F.greatest(F.size("words") - size + 1, F.lit(0))).alias(c)
               for k, c in enumerate(columns)]
    whole = F.array(F.struct(*(F.lit("").alias(c) for c in columns)))
    rows = F.concat(whole, F.arrays_zip(*shifted)) if size == SHINGLE else F.arrays_zip(*shifted)
    first = 1 if size == SHINGLE else 0
    return (docs.select("id", "copy", "doc_id", F.size("words").alias("n_words"), F.posexplode(rows))
            .select("id", "copy", "doc_id", "n_words", (F.col("pos") - first).alias("place"),
                    F.concat_ws(" ", *(F.col("col")[c] for c in columns)).alias("token")))


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items for every row of (doc_id, text)."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("id"),
                        F.xxhash64(F.col("text").cast("string")).alias("copy"), words("text").alias("words"))
    passages, owners = (stored(x, "passages") for x in item_windows(items, window))
    tokens = stored(shingles(passages), "tokens")
    sizes = {SHINGLE, *(r.size for r in tokens.select("size").distinct().collect())}
    wanted = limited(tokens.select("token").union(docs.sparkSession.createDataFrame([(WHOLE,)], "token string"))
                     .distinct())
    occurring = None
    for size in sorted(sizes):
        part = document_shingles(keyed, size).join(wanted, "token")
        occurring = part if occurring is None else occurring.unionByName(part)
    matches = stored(occurring, "matches")
    hits = matches.where(F.col("token") != WHOLE).select("id", "copy", "n_words", "place", "token")

    rarity = hits.groupBy("token").agg(F.count(F.lit(1)).alias("rows"))
    prefix = (limited(tokens).join(rarity, "token")
              .groupBy("passage", "length", "size").agg(F.min(F.struct("rows", "token", "offset")).alias("rarest"))
              .select("passage", "length", "size", "rarest.token", "rarest.offset"))
    begin = F.col("place") - F.col("offset")
    candidates = (hits.join(limited(prefix), "token").withColumn("begin", begin)
                  .where((F.col("begin") >= 0) & (F.col("begin") + F.col("length") <= F.col("n_words")))
                  .select("id", "copy", "begin", "passage", "length").distinct())
    # The shingles that cover a window: every SHINGLE-th and the last.
    last = F.col("length") - F.col("size")
    cover = tokens.where((F.col("offset") % SHINGLE == 0) | (F.col("offset") == last))
    needed = cover.groupBy("passage").agg(F.count(F.lit(1)).alias("needed"))
    cover = cover.join(needed, "passage").select("passage", "offset", "token", "needed")
    found = (candidates.join(limited(cover), "passage").withColumn("place", F.col("begin") + F.col("offset"))
             .join(hits.select("id", "copy", "place", "token").distinct(), ["id", "copy", "place", "token"])
             .groupBy("id", "copy", "begin", "length", "passage", "needed").agg(F.count(F.lit(1)).alias("n"))
             .where("n = needed").select("id", "copy", "begin", "length", "passage"))
    occurrences = stored(found, "occurrences")

    in_order = Window.partitionBy("id", "copy").orderBy("begin", "length").rowsBetween(
        Window.unboundedPreceding, -1)
    end = F.col("begin") + F.col("length")
    covered = F.coalesce(F.max(end).over(in_order), F.lit(0))
    hit_words = (occurrences.select("id", "copy", "begin", "length").distinct()
                 .withColumn("new", F.greatest(end - F.greatest("begin", covered), F.lit(0)))
                 .groupBy("id", "copy").agg(F.sum("new").alias("n_hit")))
    hit_items = (occurrences.select("id", "copy", "passage").distinct().join(limited(owners), "passage")
                 .groupBy("id", "copy").agg(F.array_sort(F.collect_set("item")).alias("items")))
    names = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return (matches.where(F.col("token") == WHOLE).select("id", "copy", "doc_id", "n_words")
            .join(hit_words.join(hit_items, ["id", "copy"]), ["id", "copy"], "left")
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(names).cast("long").alias("n_items"),
                    F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated"), names.alias("items")))
