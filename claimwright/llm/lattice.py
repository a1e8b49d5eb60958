"""Likelihood of texts under a subword lattice: all segmentations into the pieces of an existing vocabulary count.

A word's probability is the sum over its segmentations of the product of their pieces' probabilities, by a forward
recursion in log space over its bytes; a document's is the product over its words and its end, since a piece never
crosses the space before a word. Pieces begin with weights from the scores that the vocabulary gives them (its ranks,
by Zipf's law), and one pass of expected counts over the different words of the training documents fits them to the
corpus. The probabilities of all words, new ones included, and of the end sum to one. A-Z are lower-cased first.

`score` is that marginal alone. `word_score` adds one arc to the lattice for a word that training documents have, with
the probability of its count; segmentations then share the part of new words (their number over that of tokens and
different tokens). It too is a distribution over all words and the end.

Words are counted over all training documents; each different word is scored once, and the words of documents meet their
counts and scores in a join. The most frequent words, a bounded number, go to every task instead, so what is shuffled
are the rarer words only.

Defined cases: a null or empty text is its end alone; null ids hash as no text does and train nothing (`held_out` is
null); every row comes back once, rows that share an id too; extra columns are ignored; with no training row at all the
counts are 0 and pieces have the vocabulary's weights.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import CHUNK_BYTES, chunks, stored, with_copy

#: Rows whose id's checksum leaves this remainder are held out.
FOLDS, HELD_OUT = 7, 2
#: Words of more bytes are taken one by one, byte by byte: their memory and time grow with their length only.
LONG = 256
#: Words that go to every task, at most.
FREQUENT = 150_000
#: Rank added in Zipf's law, and expected count added to each piece.
OFFSET, ADDED = 10.0, 0.01
WORDS_AT_ONCE = 20_000
#: Probability of the end where nothing was learnt.
NEW_END = 0.002
LOG10 = np.log(10.0)


# --- the lattice ------------------------------------------------------------------------------------------------

def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, a space for the mark of a word's beginning, and first log-weights from the stored scores.
    All bytes are pieces, so every word has a segmentation."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    weights: dict[bytes, float] = {}
    for k in range(model.get_piece_size()):
        if model.is_control(k) or model.is_unknown(k):
            continue
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            name, rank = bytes([int(piece[3:5], 16)]), float(model.get_piece_size())
        else:
            name, rank = piece.replace("▁", " ").encode(), -model.get_score(k)
        if b" " in name[1:]:  # crosses words
            continue
        weights[name] = weights.get(name, 0.0) + 1 / (OFFSET + rank)
    for b in range(256):
        weights.setdefault(bytes([b]), 1 / (OFFSET + model.get_piece_size()))
    names = sorted(weights)
    values = np.log(np.array([weights[n] for n in names]))
    return names, values - np.logaddexp.reduce(values)


class Lattice:
    """Pieces found in words and recursions over them, for many words at a time."""

    def __init__(self, pieces: list[bytes]):
        self.longest = max(map(len, pieces))
        self.index = {p: k for k, p in enumerate(pieces)}
        self.beginnings = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
        self.size = len(pieces)
        self.follow: np.ndarray | None = None

    def found(self, word: bytes, a: int) -> Iterator[tuple[int, int]]:
        """(end place, piece) of the pieces that begin at a place."""
        for b in range(a + 1, min(len(word), a + self.longest) + 1):
            part = word[a:b]
            if part not in self.beginnings:
                return
            k = self.index.get(part)
            if k is not None:
                yield b, k

    def long_forward(self, word: bytes, logs: list[float]) -> array:
        """`forward` of one long word."""
        out = array("d", [-math.inf]) * (len(word) + 1)
        out[0] = 0.0
        for a in range(len(word)):
            here = out[a]
            if here == -math.inf:
                continue
            for b, k in self.found(word, a):
                step, there = here + logs[k], out[b]
                top, low = (step, there) if step > there else (there, step)
                out[b] = top + math.log1p(math.exp(low - top))
        return out

    def long_expected(self, word: bytes, logs: list[float], total: np.ndarray) -> None:
        """Adds the expected uses of each piece in one long word."""
        alpha = self.long_forward(word, logs)
        beta = array("d", [-math.inf]) * (len(word) + 1)
        beta[-1], whole = 0.0, alpha[-1]
        for a in range(len(word) - 1, -1, -1):
            for b, k in self.found(word, a):
                step, here = beta[b] + logs[k], beta[a]
                top, low = (step, here) if step > here else (here, step)
                if top > -math.inf:
                    beta[a] = top + math.log1p(math.exp(low - top))
                    if alpha[a] > -math.inf:
                        total[k] += math.exp(alpha[a] + step - whole)

    def steps(self) -> None:
        """What `arcs` goes by: the beginnings as nodes, 0 the empty one, with each node's follower for each byte, or 0,
        and the piece that a node is, or -1."""
        names = sorted(self.beginnings, key=lambda p: (len(p), p))
        number = {p: k + 1 for k, p in enumerate(names)} | {b"": 0}
        table = np.zeros((len(number), 256), np.uint16 if len(number) < 2**16 else np.int32)
        table[[number[p[:-1]] for p in names], [p[-1] for p in names]] = np.arange(1, len(number))
        self.follow = table.ravel()
        self.piece = np.array([-1, *(self.index.get(p, -1) for p in names)], np.int32)

    def arcs(self, words: list[bytes]) -> np.ndarray:
        """(end place, piece length, word): the piece that ends there, or -1. Words have one length."""
        length = len(words[0])
        if self.follow is None:
            self.steps()
        out = np.full((length + 1, min(self.longest, length) + 1, len(words)), -1, np.int32)
        text = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length).T.copy()
        for a in range(length):  # all words at once: the beginnings that go on, byte by byte
            row, node = np.arange(len(words)), np.zeros(len(words), np.int64)
            for b in range(a, min(length, a + self.longest)):
                node = self.follow[node * 256 + text[b][row]].astype(np.int64)
                row, node = row[node > 0], node[node > 0]
                if not len(row):
                    break
                out[b + 1, b + 1 - a, row] = self.piece[node]
        return out

    def forward(self, arcs: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Log-sums (place, word) over all ways to reach each place."""
        if self.plain(arcs, logs):
            with np.errstate(divide="ignore"):  # places that no piece ends at
                return np.log(self.sums(arcs, np.append(np.exp(logs), 0.0)))
        padded = np.append(logs, -np.inf)
        out = np.full((arcs.shape[0], arcs.shape[2]), -np.inf)
        out[0] = 0
        for b in range(1, len(out)):
            steps = [out[b - n] + padded[arcs[b, n]] for n in range(1, min(b, arcs.shape[1] - 1) + 1)]
            top = np.maximum.reduce(steps)
            out[b] = top + np.log(sum(np.exp(s - top) for s in steps))
        return out

    def plain(self, arcs: np.ndarray, logs: np.ndarray) -> bool:
        """Whether no product of weights along a word is too small for a number: then no logarithms are needed."""
        return len(arcs) * -float(logs.min()) < 600

    def sums(self, arcs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """`forward` of weights themselves, the last of which is that of no piece."""
        out = np.zeros((arcs.shape[0], arcs.shape[2]))
        out[0] = 1
        for b in range(1, len(out)):
            for n in range(1, min(b, arcs.shape[1] - 1) + 1):
                out[b] += out[b - n] * weights[arcs[b, n]]
        return out

    def expected(self, arcs: np.ndarray, logs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over the words, each as often as counted."""
        if self.plain(arcs, logs):
            weights = np.append(np.exp(logs), 0.0)
            alpha, beta = self.sums(arcs, weights), np.zeros((arcs.shape[0], arcs.shape[2]))
            uses = np.zeros(arcs.shape)
            beta[-1] = counts / alpha[-1]
            for b in range(len(alpha) - 1, 0, -1):
                for n in range(1, min(b, arcs.shape[1] - 1) + 1):
                    step = weights[arcs[b, n]] * beta[b]
                    beta[b - n] += step
                    uses[b, n] = alpha[b - n] * step
            return np.bincount(arcs.ravel() + 1, uses.ravel(), self.size + 1)[1:]
        padded = np.append(logs, -np.inf)
        alpha = self.forward(arcs, logs)
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0
        last = len(alpha) - 1
        for a in range(last - 1, -1, -1):
            steps = [beta[a + n] + padded[arcs[a + n, n]] for n in range(1, min(last - a, arcs.shape[1] - 1) + 1)]
            top = np.maximum.reduce(steps)
            beta[a] = top + np.log(sum(np.exp(s - top) for s in steps))
        out = np.zeros(self.size)
        for b in range(1, len(alpha)):
            for n in range(1, min(b, arcs.shape[1] - 1) + 1):
                weight = np.exp(alpha[b - n] + padded[arcs[b, n]] + beta[b] - alpha[-1]) * counts
                here = arcs[b, n] >= 0
                if here.any():
                    np.add.at(out, arcs[b, n][here], weight[here])
        return out


def grouped(words: list[bytes]) -> Iterator[np.ndarray]:
    """Places of words of one length, as many as the recursions take at once; long words come one by one."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        size = max(1, WORDS_AT_ONCE * 8 // int(lengths[order[a]] + 1)) if lengths[order[a]] <= LONG else 1
        for k in range(a, b, size):
            yield order[k:min(b, k + size)]


def word_weights(names: list[bytes], uses: np.ndarray) -> tuple[np.ndarray, float]:
    """Log-probabilities of pieces that make words of all strings sum to one: a piece that begins a word, then others,
    each after going on; and the log-probability of ending behind a piece."""
    begins = np.array([n[:1] == b" " for n in names])
    stop = uses[begins].sum() / uses.sum()
    logs = np.log(uses) - np.where(begins, np.log(uses[begins].sum()), np.log(uses[~begins].sum()) - np.log1p(-stop))
    return logs, float(np.log(stop))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined until the recursions have enough words, of bounded length, to take at once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= WORDS_AT_ONCE or sum(b.nbytes for b in held) >= CHUNK_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def spaced(words: list[bytes]) -> list[bytes]:
    return [b" " + w for w in words]


# --- the corpus -------------------------------------------------------------------------------------------------

def held_out(doc_id: int | None) -> bool | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n): each different word of all documents and how often training documents have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other = Counter(), set()

        def rows():
            words = [*train, *other.difference(train)]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([train.get(w, 0) for w in words], pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for part in chunks(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    words = text.encode().lower().split()
                    if held_out(doc_id) is False:
                        train.update(words)
                    else:
                        other.update(words)
                if len(train) + len(other) > 400_000:
                    yield rows()
                    train, other = Counter(), set()
        if train or other:
            yield rows()

    return docs.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def score_texts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, word_score for every row of
    (doc_id, text)."""
    docs, _ = with_copy(docs)
    context = docs.sparkSession.sparkContext
    words = stored(count_words(docs), "words")
    train_docs = docs.select("doc_id").where(
        F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) != HELD_OUT).count()
    in_words, different = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    tokens, types = in_words + train_docs, different + (train_docs > 0)

    names, first = vocabulary(vocabulary_path)
    pieces = context.broadcast((names, first))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, logs = Lattice(pieces.value[0]), pieces.value[1]
        total = np.zeros(lattice.size)
        for batch in gathered(batches):
            own = spaced(batch.column("word").to_pylist())
            for some in grouped(own):
                if len(own[some[0]]) > LONG:
                    lattice.long_expected(own[some[0]], logs.tolist(), total)
                else:
                    total += lattice.expected(lattice.arcs([own[k] for k in some]), logs, np.ones(len(some)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

    uses = np.full(len(names), ADDED)
    seen = words.where("n > 0").mapInArrow(expect, "piece long, uses double").groupBy("piece").agg(F.sum("uses"))
    for piece, n in seen.collect():  # at most one row for each piece of the vocabulary
        uses[piece] += n
    fitted = context.broadcast((names, word_weights(names, uses if different else np.exp(first))))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, (own_logs, stop) = Lattice(fitted.value[0]), fitted.value[1]
        for batch in gathered(batches):
            own = spaced(batch.column("word").to_pylist())
            out = np.zeros(len(own))
            for some in grouped(own):
                out[some] = stop + (lattice.long_forward(own[some[0]], own_logs.tolist())[-1]
                                    if len(own[some[0]]) > LONG
                                    else lattice.forward(lattice.arcs([own[k] for k in some]), own_logs)[-1])
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(out / LOG10)],
                                             names=["word", "n", "log"])

    # N + 1 * (V + 1); of a word, what it adds to the base score is log10(n + 1) - share.
    share = float(np.log10(tokens + types + 1))
    lattice_log = words.mapInArrow(weigh, "word binary, n long, log double")
    # The word as one arc, by its count, beside its segmentations, by the share of new words.
    new = float(different) / (tokens + types) if different else 1.0
    mixed = F.when((F.col("n") > 0) & (F.lit(float(different)) > 0),
                   F.log10(F.col("n") + float(different) * F.pow(F.lit(10.0), "log")) - float(np.log10(tokens + types or 1))
                   ).otherwise(F.col("log") + float(np.log10(new)))
    end = train_docs / tokens if train_docs and in_words else NEW_END  # a token is the end, or else a word
    scored = stored(lattice_log.select("word", "n", (F.col("log") + float(np.log10(1 - end))).alias("log"),
                                       mixed.alias("mixed")), "scored")
    top = scored.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    common = context.broadcast({bytes(w): (n > 0, float(np.log10(n + 1)) - share, g, m) for w, n, g, m in top})
    pieces.destroy()
    fitted.destroy()
    end_base, end_known, end_log = float(np.log10(train_docs + 1)) - share, train_docs > 0, float(np.log10(end))
    end_mixed = float(np.log10(train_docs / (tokens + types) if train_docs else NEW_END))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the end and frequent words give each document, under a name that no word has, and its rarer words."""
        known = common.value
        for batch in batches:
            for part in chunks(batch):
                out: list[tuple] = []
                for doc_id, id_, copy, text in zip(*(part.column(c).to_pylist()
                                                     for c in ("doc_id", "id", "copy", "text"))):
                    n, hits, base, log, mixed = 1, int(end_known), end_base, end_log, end_mixed
                    for word, times in Counter(text.encode().lower().split()).items():
                        n += times
                        found = known.get(word)
                        if found is None:
                            out.append((None, id_, copy, word, times, None, None, None, None, None))
                        else:
                            hits += times * found[0]
                            base += times * found[1]
                            log += times * found[2]
                            mixed += times * found[3]
                    out.append((doc_id, id_, copy, b" %d %d" % (id_, copy), 0, n, hits, base, log, mixed))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
                     pa.float64(), pa.float64(), pa.float64()))],
                    names=["doc_id", "id", "copy", "word", "times", "tokens", "known", "base", "log", "mixed"])

    parts = docs.mapInArrow(split, "doc_id long, id long, copy long, word binary, times long, tokens long, known long, "
                                   "base double, log double, mixed double")
    met = parts.join(scored.select("word", "n", F.col("log").alias("word_log"), F.col("mixed").alias("word_mixed")),
                     "word", "left")
    rare = F.col("tokens").isNull()
    sums = met.groupBy("id", "copy").agg(
        F.max("doc_id").alias("doc_id"), F.count("tokens").alias("rows"), F.sum("tokens").alias("tokens"),
        F.sum(F.when(rare, F.when(F.col("n") > 0, F.col("times")).otherwise(0)).otherwise(F.col("known")))
        .alias("known"),
        F.sum(F.when(rare, F.col("times") * (F.log10(F.col("n") + 1) - share)).otherwise(F.col("base"))).alias("base"),
        F.sum(F.when(rare, F.col("times") * F.col("word_log")).otherwise(F.col("log"))).alias("log"),
        F.sum(F.when(rare, F.col("times") * F.col("word_mixed")).otherwise(F.col("mixed"))).alias("mixed"))
    each = sums.withColumn("of", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return each.select(
        "doc_id", (fold == HELD_OUT).alias("held_out"), (F.col("tokens") / F.col("rows")).cast("long").alias("n_tokens"),
        (F.col("known") / F.col("rows")).cast("long").alias("n_known"), F.lit(int(tokens)).cast("long")
        .alias("train_tokens"), (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("log") / F.col("rows")).alias("score"), (F.col("mixed") / F.col("rows")).alias("word_score"))
