"""Language, personal data, likelihood and fingerprints."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimwright.llm import editprint, language, lattice, pii
from tests.llm import helpers as h

PIECES = public_tokenizers.path("piece_bpe_32k.model")
FRENCH, ENGLISH = h.SECOND, h.FIRST


# --- language ---------------------------------------------------------------------------------------------------

def labelled_rows(n=40):
    rng = random.Random(1)
    out = []
    for k in range(n):
        base = ENGLISH if k % 2 == 0 else FRENCH
        own = base.split()
        rng.shuffle(own)
        out.append((k, " ".join(own[:25]), "en" if k % 2 == 0 else "fr", f"host{k % 2}", 0))
    return out


def test_language(spark):
    rows = labelled_rows() + [
        (100, "the dog and the hill", None, "host0", 0), (101, "le chat et la maison", None, None, 0),
        (102, "xqzj vwkx jjqz qxzw zzkq " * 6, None, "host0", 0), (103, None, "fr", "host1", 0), (104, "", None, None, 0),
        (105, "123 456 !!", None, "host0", 0), (None, "the lazy dog jumps over the fox", "en", "host0", 0)]
    docs = h.documents(spark, rows, extra="probability")
    got = {r.doc_id: r for r in language.identify(language.document_evidence(docs), docs.select("text", "lang")).collect()}
    assert len(got) == len(rows)
    for doc_id, _, lang, _, _ in rows[:40]:
        assert (got[doc_id].lang, got[doc_id].kept) == (lang, True)
    assert got[100].lang == "en" and got[101].lang == "fr" and got[None].lang == "en"
    for doc_id in (102, 103, 104, 105):
        assert (got[doc_id].lang, got[doc_id].kept) == ("und", False)


def test_rare_languages_are_answered(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.sample((ENGLISH, FRENCH)[k % 2].split(), 8)), ("en", "fr")[k % 2], f"host{k % 3}", 0)
            for k in range(30_000)]
    rare = "zaku mipo zuru kavi pozu wiku rami zoka piwu kuza vomi zapu".split()
    rows += [(40_000 + k, " ".join(rng.sample(rare, 12)), "za", "host0", 0) for k in range(4)]
    rows += [(50_000 + k, "ghlor thwyn ghwrth lynth rhygl thlwr ghynt", "gh", "host0", 0) for k in range(3)]
    docs = h.documents(spark, rows)
    sample = Counter(r.lang for r in language.sampled(docs.select("text", "lang")).collect())
    assert sample == {"en": language.LANGUAGE_ROWS, "fr": language.LANGUAGE_ROWS, "za": 4, "gh": 1}
    got = language.identify(language.document_evidence(docs), docs.select("text", "lang")) \
        .where("doc_id >= 40000").collect()
    assert {r.doc_id: (r.lang, r.kept) for r in got} == {r[0]: (r[2], True) for r in rows[30_000:]}


def test_host_and_declaration_decide_where_the_text_does_not(spark):
    rows = labelled_rows(60)
    docs = h.documents(spark, [(k, t, la, s, n) for k, t, la, s, n in rows] + [(200, "la", "fr", "host1", 0),
                                                                               (201, "la", "en", "host0", 0)])
    got = {r.doc_id: r.lang for r in language.identify(language.document_evidence(docs),
                                                       docs.select("text", "lang")).collect()}
    assert got[200] == "fr"


def test_language_without_labels_and_rows(spark):
    docs = h.documents(spark, [(1, "text", None, None, 0)])
    got = language.identify(language.document_evidence(docs), docs.select("text", "lang")).collect()
    assert [(r.lang, r.kept) for r in got] == [("und", False)]
    none = h.documents(spark, [])
    assert language.identify(language.document_evidence(none), none.select("text", "lang")).collect() == []


def test_markup_and_address(spark):
    row = spark.createDataFrame([("https://a.b.example.fr:80/x", '<!DOCTYPE html><HTML class="x" lang="fr-CA">'),
                                 (None, "<p>"), ("nonsense", None)], "url string, html string")
    host, suffix = language.address_parts("url")
    got = row.select(host, suffix, language.markup_language("html")).collect()
    assert [tuple(r) for r in got] == [("a.b.example.fr", "fr", "fr"), (None, None, None), (None, None, None)]


# --- personal data ----------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, name in enumerate(pii.KINDS):
        for m in re.finditer(PATTERNS[name], text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits),
                    "phone": lambda: 9 <= len(digits) <= 15}[name]()
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_patterns_equal_plain_search():
    rng = random.Random(3)
    alphabet = ["a", "b.c", "@", ".", "-", "+", "(", ")", " ", "1", "22", "255", "4111 1111 1111 1111", "é", "😀", "x@y.z",
                "1.2.3.4", "0001", "+1 988 555 2485"]
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 14)))
        assert pii.pattern_spans(text) == brute_spans(text), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+" * 100_000, "1 " * 100_000):
        pii.pattern_spans(text)


def entity_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = rng.choices(ENGLISH.split(), k=30)
        words.insert(rng.randrange(30), rng.choice([
            f"u{rng.randrange(99)}.x@mail{rng.randrange(9)}.example.com",
            ".".join(str(rng.randrange(256)) for _ in range(4)),
            f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}", f"in {rng.randrange(1900, 2030)}"]))
        out.append((k, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def weights(spark):
    return pii.train(h.documents(spark, entity_rows(150, 1)))


def found_and_wanted(texts_and_spans, weights):
    """Right spans, wanted ones and found ones beyond those of the patterns."""
    found = pii.tagger_spans([t for t, _ in texts_and_spans], weights)
    right = wanted = given = 0
    for (text, spans), more in zip(texts_and_spans, found):
        base = set(pii.pattern_spans(text))
        mine, own = set(pii.joined_spans(sorted(base), more)) - base, set(spans) - base
        right, wanted, given = right + len(mine & own), wanted + len(own), given + len(mine)
    return right, wanted, given


def test_tagger_finds_held_out_spans(weights):
    texts = [t for _, t in entity_rows(60, 2)]
    wanted = [set(pii.pattern_spans(t)) for t in texts]
    found = [set(s) for s in pii.tagger_spans(texts, weights)]
    hits = sum(len(a & b) for a, b in zip(wanted, found))
    assert hits >= 0.8 * sum(map(len, wanted)) and hits >= 0.8 * sum(map(len, found))


def test_tagger_finds_what_the_patterns_miss(weights, monkeypatch):
    held_out = [pii.example(t, random.Random(k)) for k, t in entity_rows(60, 3)]
    right, wanted, given = found_and_wanted(held_out, weights)
    assert wanted > 100 and right >= 0.8 * wanted and right >= 0.95 * given
    monkeypatch.setattr(pii, "FORMS", {
        "at": [" <at> ", "( at )"], "dot": [" <dot> ", "{dot}"], "ip": [" / ", "{.}"], "card": ["|", " . "],
        "phone": ["1 (###) ###-####", "(###)###.####", "00# ### ### ####"]})  # none of them was seen
    unseen = [pii.example(t, random.Random(k)) for k, t in entity_rows(60, 4)]
    right, wanted, given = found_and_wanted(unseen, weights)
    assert wanted > 100 and right >= 0.4 * wanted and right >= 0.7 * given


def test_plain_numbers_are_left_alone(weights):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(ENGLISH.split(), k=8) + [pii.digits_in(rng.choice(pii.PLAIN), rng)]
                      + rng.choices(ENGLISH.split(), k=8)) for _ in range(200)]
    assert sum(map(bool, pii.tagger_spans(texts, weights))) <= 4


def test_long_stretches_are_decoded_in_parts(weights, monkeypatch):
    texts = [" ".join(pii.example(t, random.Random(k))[0] for k, t in entity_rows(30, 6)), "", "5", "at 7 (at) x"]
    whole = pii.tagger_spans(texts, weights)
    monkeypatch.setattr(pii, "LONG", 3)
    monkeypatch.setattr(pii, "DECODED_AT_ONCE", 500)
    parts = pii.tagger_spans(texts, weights)
    assert len(whole[0]) > 50 and len(set(whole[0]) ^ set(parts[0])) <= 2 and whole[1:] == parts[1:]


def test_decoding_side_by_side_is_decoding_alone():
    rng = np.random.default_rng(2)
    w = {"begin": rng.normal(size=pii.TAGS), "move": rng.normal(size=(pii.TAGS, pii.TAGS))}
    scores = [3 * rng.normal(size=(n, pii.TAGS)) for n in (9, 7, 7, 4, 1)]
    assert pii.decode(scores, w) == [pii.decode([s], w)[0] for s in scores]
    short = scores[3]
    ways = {s: w["begin"][s[0]] + sum(short[t, x] for t, x in enumerate(s)) + sum(w["move"][a, b] for a, b in zip(s, s[1:]))
            for s in itertools.product(range(pii.TAGS), repeat=4)}
    best = max(ways, key=ways.get)
    total = np.logaddexp.reduce(list(ways.values()))
    sure = [np.logaddexp.reduce([v for s, v in ways.items() if s[t] == best[t]]) - total >= np.log(pii.SURE) for t in range(4)]
    covered = {t for a, b, _ in pii.decode([short], w)[0] for t in range(a, b)}
    assert covered <= {t for t in range(4) if best[t] and sure[t]}


def test_crf_sums_over_all_sequences():
    rng = np.random.default_rng(0)
    scores, begin, move = rng.normal(size=(4, 1, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    total, marginal, moves = pii.forward_backward(scores, begin, move)
    weight = {}
    for s in itertools.product(range(3), repeat=4):
        weight[s] = math.exp(begin[s[0]] + sum(scores[t, 0, x] for t, x in enumerate(s))
                             + sum(move[a, b] for a, b in zip(s, s[1:])))
    z = sum(weight.values())
    assert math.isclose(total[0], math.log(z))
    assert math.isclose(marginal[2, 0, 1], sum(v for s, v in weight.items() if s[2] == 1) / z)
    assert math.isclose(moves[0, 2], sum(v * sum(p == (0, 2) for p in zip(s, s[1:])) for s, v in weight.items()) / z)


def test_lstm_gradient():
    rng = np.random.default_rng(0)
    x, g = rng.normal(size=(5, 2, pii.EMBEDDING)), rng.normal(size=(5, 2, pii.HIDDEN))
    w, b = rng.normal(size=(pii.EMBEDDING + pii.HIDDEN, 4 * pii.HIDDEN)) * 0.3, np.zeros(4 * pii.HIDDEN)
    _, kept = pii.lstm(x, w, b)
    dx, dw, _ = pii.lstm_back(g, kept, w)
    for array, grad, at in ((w, dw, (3, 7)), (w, dw, (20, 50)), (x, dx, (1, 0, 4))):
        old = array[at]
        values = []
        for step in (1e-5, -1e-5):
            array[at] = old + step
            values.append((pii.lstm(x, w, b)[0] * g).sum())
        array[at] = old
        assert math.isclose((values[0] - values[1]) / 2e-5, grad[at], rel_tol=1e-4, abs_tol=1e-7)


def test_windows_are_joined():
    text = "x" * 40 + " 1 " + "y" * 30 + " 2 " + "z" * 200 + " 3"
    assert pii.stretches(text) == [(0, 3), (7, 2)]
    assert pii.redacted("a b@c.d e 1.2.3.4", [(2, 7, 0), (10, 17, 1)]) == "a <EMAIL> e <IP>"


def test_find(spark):
    rows = h.awkward_rows() + [(100 + k, t) for k, t in entity_rows(40, 5)]
    got = pii.find(h.documents(spark, rows, extra="spans"), redact=True).collect()
    expected = Counter()
    for doc_id, text in rows:
        base = brute_spans(text or "")
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        expected[(doc_id, *(sum(s[2] == k for s in base) for k in range(4)),
                  hashlib.sha256(written.encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in got) == expected
    assert pii.find(h.documents(spark, [(1, "no data here"), (2, None)])).count() == 2
    assert pii.find(h.documents(spark, [])).collect() == []
    kept = pii.redact(h.documents(spark, rows)).where("doc_id = 11").first()
    assert "<EMAIL>" in kept.text and "4111" not in kept.text and kept.source == "src0"


# --- likelihood -------------------------------------------------------------------------------------------------

def test_forward_sums_over_all_segmentations():
    pieces = [b" ", b"a", b"b", b" a", b"ab", b"ba", b" ab", b"aba"]
    logs = np.log(np.arange(1, 9) / 36)
    grid = lattice.Lattice(pieces)
    p = dict(zip(pieces, np.exp(logs)))

    def total(word, uses=None):
        if not word:
            return 1.0
        return sum(p[word[:n]] * total(word[n:]) for n in range(1, len(word) + 1) if word[:n] in p)

    words = [b" abab", b" abba", b" baba"]
    arcs = grid.arcs(words)
    assert np.allclose(np.exp(grid.forward(arcs, logs)[-1]), [total(w) for w in words])
    counts = np.array([2.0, 1.0, 3.0])
    expected = grid.expected(arcs, logs, counts)
    lengths = np.array([len(x) for x in pieces])
    assert math.isclose(float(expected @ lengths), float(counts @ [len(w) for w in words]))


def test_vocabulary_covers_all_bytes():
    names, logs = lattice.vocabulary(PIECES)
    assert {bytes([b]) for b in range(256)} <= set(names) and math.isclose(np.exp(logs).sum(), 1)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def trains(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def brute_base(rows):
    counts, docs = Counter(), 0
    for doc_id, text in rows:
        if trains(doc_id):
            counts.update(h.words(lowered(text)))
            docs += 1
    if docs:
        counts["\n"] = docs
    n, v = sum(counts.values()), len(counts)
    out = Counter()
    for doc_id, text in rows:
        own = [*h.words(lowered(text)), "\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        held = None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7 == 2
        out[(doc_id, held, len(own), sum(counts[w] > 0 for w in own), n, round(base, 5))] += 1
    return out


def test_lattice_of_many_words_at_once():
    """Pieces found in all words at once are those found word by word; sums of weights are those of logarithms; words
    come together from small batches, in order."""
    names, logs = lattice.vocabulary(PIECES)
    grid = lattice.Lattice(names)
    rng = random.Random(7)
    words = [b" " + bytes(rng.choices(b"aeinrst\xc3\xa9", k=9)) for _ in range(40)]
    arcs = grid.arcs(words)
    assert {(b, n, j): int(k) for (b, n, j), k in np.ndenumerate(arcs) if k >= 0} == {
        (b, b - a, j): k for j, w in enumerate(words) for a in range(10) for b, k in grid.found(w, a)}
    whole = grid.forward(arcs, logs)
    assert np.allclose(whole.T, [grid.long_forward(w, logs.tolist()) for w in words], rtol=1e-12)
    uses, total = grid.expected(arcs, logs, np.ones(40)), np.zeros(grid.size)
    for w in words:
        grid.long_expected(w, logs.tolist(), total)
    assert np.allclose(uses, total, rtol=1e-9)
    tiny = logs - 60.0  # too small for numbers: by logarithms
    assert grid.plain(arcs, logs) and not grid.plain(arcs, tiny)
    assert np.allclose(grid.forward(arcs, tiny).T, [grid.long_forward(w, tiny.tolist()) for w in words], rtol=1e-12)
    batches = [pa.record_batch({"word": [b"%d" % k for k in range(i, i + 3)]}) for i in range(0, 30, 3)]
    assert [b.num_rows for b in lattice.gathered(iter(batches))] == [30]


@pytest.mark.parametrize("frequent", [lattice.FREQUENT, 3])
@pytest.mark.parametrize("rows", [h.awkward_rows(), [], [(None, "a b")]], ids=["awkward", "empty", "untrained"])
def test_scores(spark, rows, frequent, monkeypatch):
    monkeypatch.setattr(lattice, "FREQUENT", frequent)
    got = lattice.score_texts(h.documents(spark, rows, extra="score"), PIECES).collect()
    mine = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got)
    assert mine == brute_base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_of_words_sum_to_less_than_one(spark):
    rows = [(k, "aa ab ba bb ab") for k in range(20)]
    probe = ["aa", "ab", "ba", "bb", "a", "b", "aab", "abab", "zz"]
    held = [k for k in range(1000, 3000) if zlib.crc32(str(k).encode()) % 7 == 2][:len(probe) + 1]
    rows += [(held[0], "")] + list(zip(held[1:], probe))
    found = lattice.score_texts(h.documents(spark, rows), PIECES).collect()
    for column, least in (("word_score", 0.5), ("score", 0.05)):
        got = {r.doc_id: r[column] for r in found}
        end = got[held[0]]
        assert least < sum(10 ** (got[k] - end) for k in held[1:]) + 10**end <= 1 + 1e-9


def segmentations(word, names):
    """All ways to cut a word into pieces."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in names:
            for rest in segmentations(word[n:], names):
                yield (word[:n], *rest)


def brute_scores(rows):
    """The marginal of every text, by listing all segmentations of its words."""
    names, first = lattice.vocabulary(PIECES)
    weight = dict(zip(names, np.exp(first)))
    train = [h.words(lowered(text)) for doc_id, text in rows if trains(doc_id)]
    uses = dict.fromkeys(names, lattice.ADDED)
    for word in {w for words in train for w in words}:
        ways = list(segmentations(b" " + word.encode(), weight))
        each = [math.prod(weight[p] for p in way) for way in ways]
        for way, p in zip(ways, each):
            for piece in way:
                uses[piece] += p / sum(each)
    begins = sum(n for p, n in uses.items() if p[:1] == b" ")
    whole = sum(uses.values())
    stop = begins / whole

    def of(piece):  # first piece of a word, or a later one after going on
        return uses[piece] / begins if piece[:1] == b" " else uses[piece] / (whole - begins) * (1 - stop)

    end = len(train) / (sum(map(len, train)) + len(train))
    out = {}
    for doc_id, text in rows:
        total = math.log10(end)
        for word in h.words(lowered(text)):
            p = sum(math.prod(map(of, way)) for way in segmentations(b" " + word.encode(), weight))
            total += math.log10(p * stop * (1 - end))
        out[doc_id] = total
    return out


def test_score_is_the_marginal_of_all_segmentations(spark):
    rows = [(k, f"The cat, {'Sat on' * (k % 3)} a mat {chr(97 + k)}ing ß日") for k in range(12)]
    rows += [(12, "unseen Words qzx"), (13, None), (14, " ")]
    want = brute_scores(rows)
    got = {r.doc_id: r.score for r in lattice.score_texts(h.documents(spark, rows), PIECES).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_long_words_one_by_one():
    names, logs = lattice.vocabulary(PIECES)
    grid = lattice.Lattice(names)
    word = b" " + b"theantidis\xc3\xa9stablishment" * 8
    arcs = grid.arcs([word])
    assert np.allclose(grid.long_forward(word, logs.tolist()), grid.forward(arcs, logs)[:, 0])
    uses = np.zeros(grid.size)
    grid.long_expected(word, logs.tolist(), uses)
    assert np.allclose(uses, grid.expected(arcs, logs, np.ones(1)))


def test_a_word_of_a_million_bytes(spark):
    rows = [(0, "a b c"), (1, "x" * 1_000_001), (9, "ab" * 500_000)]
    got = {r.doc_id: r for r in lattice.score_texts(h.documents(spark, rows), PIECES).collect()}
    assert got[1].n_tokens == 2 and got[1].score < -1000 and math.isfinite(got[9].score)


# --- fingerprints -----------------------------------------------------------------------------------------------

def test_fingerprints_compare(spark):
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefgh ", k=3000))
    near = text[:700] + "XY" + text[700:2000] + text[2003:]
    far = "".join(rng.choices("abcdefgh ", k=3000))
    longer = text + far[:1300]
    a, b, c, d = editprint.fingerprints([text, near, far, longer])
    assert editprint.fingerprints([text]) == [a]
    assert editprint.likeness(a, a) == 1 and editprint.likeness(a, b) > 0.8 and editprint.likeness(a, c) < 0.35
    assert 0.55 < editprint.likeness(a, d) < 0.85
    assert editprint.likeness("", "") == 1 and editprint.likeness(a, "") == 0
    assert editprint.fingerprints(["", "x", "x"])[0] == "" and len(set(editprint.fingerprints(["x", "x"]))) == 1


@pytest.mark.parametrize("size", [30_000, 300_000])
def test_a_prefix_costs_once(size):
    found = []
    for seed in range(9):
        text = "".join(random.Random(seed).choices("abcdefghijklmnop ", k=size))
        found.append(editprint.likeness(*editprint.fingerprints([text, "0123456789" + text])))
    assert sorted(found)[4] >= 0.9 and sum(f >= editprint.LIKE for f in found) >= 7


@pytest.mark.parametrize("block, side", [(editprint.BLOCK, editprint.SIDE), (7, 2), (64, 1), (50, 100)])
def test_walks_begin_once(block, side, monkeypatch):
    monkeypatch.setattr(editprint, "BLOCK", block)
    monkeypatch.setattr(editprint, "SIDE", side)
    rng = random.Random(6)
    texts = ["".join(rng.choices("abc é日", k=n)) for n in (0, 1, 5, 31, 32, 33, 100, 700, 0, 5000, 3, 64)]
    hashes = editprint.mixed(np.arange(256, dtype=np.uint64), 41).astype(np.uint32).tolist()
    marks = editprint.mixed(np.arange(10_000, dtype=np.uint64), 42).astype(np.uint32).tolist()
    for text, mark in zip(texts, editprint.fingerprints(texts)):
        at, written = 0, ""
        for step in range(2 * len(text)):
            point, own = ord(text[at]), marks[step] | 1
            code = hashes[point & 255] ^ ((point >> 8) * 0x9E3779B1 & 0xFFFFFFFF)
            value = (code + own) * own % 2**32
            written += f"{value >> 28:x}"
            at = min(at + (value >> 15 & 1), len(text) - 1)
        gap = max(0, int(math.log2(max(2 * len(text), 1) / editprint.SAMPLES)))
        assert mark == (f"{gap:02x}" + written[(1 << gap) - 1::1 << gap] if text else "")


@pytest.mark.parametrize("size", [editprint.BUCKET_BYTES, 3000])
def test_edits(spark, size, monkeypatch):
    monkeypatch.setattr(editprint, "BUCKET_BYTES", size)
    rows = [(k * 3, f"{k} " + " ".join(random.Random(k).choices(ENGLISH.split(), k=k * 7 % 90))) for k in range(40)]
    rows += [(1000, None), (1001, ""), (1002, "ab"), (None, "é😀" * 50)]
    got = {r.doc_id: r for r in editprint.with_edits(h.documents(spark, rows, extra="near_next")).collect()}
    in_order = sorted(rows, key=lambda r: -(2**63 if r[0] is None else r[0]))
    assert len(got) == len(rows)
    for (doc_id, text), (_, after) in zip(in_order, in_order[1:] + in_order[:1]):
        text, after = text or "", after or ""
        n = len(text) // 3
        edited = text[:len(text) - n] + after[:n]
        x, y, z = editprint.fingerprints([text, edited, after])
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (x, y)
        assert (r.near_edited, r.near_next) == (editprint.likeness(x, y), editprint.likeness(x, z))


def test_edits_of_awkward_rows(spark):
    rows = h.awkward_rows()
    got = editprint.with_edits(h.documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((i, len(t or "")) for i, t in rows)
    assert editprint.with_edits(h.documents(spark, [])).collect() == []
    one = editprint.with_edits(h.documents(spark, [(1, "abcdef")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(1, 1.0)]


def test_near_pairs(spark):
    rng = random.Random(8)
    base = "".join(rng.choices("abcdefgh ", k=2500))
    texts = [base, base, base[:1200] + "q" + base[1201:], "".join(rng.choices("abcdefgh ", k=2500))]
    prints = editprint.fingerprint(h.documents(spark, list(enumerate(texts))))
    got = {(r.a, r.b) for r in editprint.near_pairs(prints).collect()}
    assert got == {(0, 1), (0, 2)}
