"""Substring, byte-string and set dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.llm import jaccard, lpf, sketch, substring
from claimwright.llm.common import NO_ID
from claimwright.llm.graph import components as spark_components
from tests.llm import helpers as h


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def random_docs(seed: int, n: int = 60) -> list[tuple]:
    """Copies, near copies and shared passages over a small vocabulary."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in ("on", "ti", "er", "é")]
    passage = " ".join(rng.choices(vocabulary, k=45))
    out: list[tuple] = []
    for k in range(n):
        kind = rng.random()
        text = " ".join(rng.choices(vocabulary, k=rng.randint(1, 120)))
        if out and kind < 0.25:
            text = rng.choice(out)[1]
        elif out and kind < 0.5:
            own = rng.choice(out)[1].split(" ")
            own[rng.randrange(len(own))] = "changed"
            text = " ".join(own)
        elif kind < 0.65:
            text = f"{text} {passage}\n{text}"
        out.append((k, text))
    return out


def brute_substring(rows, n=13):
    firsts = {}
    for doc_id, text in rows:
        key = NO_ID if doc_id is None else doc_id
        for w in h.windows(h.words(text), n):
            firsts[w] = min(firsts.get(w, NO_ID), key)
    out = []
    for doc_id, text in rows:
        key, own = NO_ID if doc_id is None else doc_id, h.words(text)
        gone = {k + j for k, w in enumerate(h.windows(own, n)) if firsts[w] < key for j in range(n)}
        kept = [w for k, w in enumerate(own) if k not in gone]
        out.append((doc_id, len(own), len(own) - len(kept), sha(" ".join(kept).encode())))
    return out


def brute_bytes(rows, n=200):
    once = {(doc_id, text or "") for doc_id, text in rows}
    seen = Counter(w for _, text in once for w in (text.encode()[k:k + n] for k in range(len(text.encode()) - n + 1)))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - n + 1):
            if seen[data[k:k + n]] > 1:
                covered[k:k + n] = b"\1" * n
        kept = bytes(b for b, c in zip(data, covered) if not c)
        out.append((doc_id, len(data), sum(covered), len([x for x in bytes(covered).split(b"\0") if x]), sha(kept)))
    return out


def brute_jaccard(rows, shingle=4, like=(85, 100)):
    sets = []
    for _, text in rows:
        own = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
               for w in h.words(text)]
        sets.append(set(h.windows(own, shingle)) if len(own) >= shingle else {tuple(own)} if own else set())
    links = [(a, b) for a, b in h.pairs(range(len(rows)))
             if sets[a] and like[1] * len(sets[a] & sets[b]) >= like[0] * len(sets[a] | sets[b])]
    groups = defaultdict(list)
    roots = h.components(list(range(len(rows))), links)
    for k, (doc_id, _) in enumerate(rows):
        groups[roots[k]].append(NO_ID if doc_id is None else doc_id)
    return [(doc_id, len(sets[k]), None if (m := min(groups[roots[k]])) == NO_ID else m)
            for k, (doc_id, _) in enumerate(rows)]


def same(frame, columns, expected):
    got = Counter(tuple(r[c] for c in columns) for r in frame.collect())
    assert got == Counter(expected)


CASES = {"awkward": h.awkward_rows(), "random": random_docs(3), "empty": []}


@pytest.mark.parametrize("case", CASES)
def test_substring(spark, case):
    rows = CASES[case]
    got = substring.remove_repeats(h.documents(spark, rows, extra="n_words"))
    same(got, ["doc_id", "n_words", "n_removed", "kept_sha256"], brute_substring(rows))
    assert all(sha(r.kept.encode()) == r.kept_sha256 for r in got.collect())


def test_substring_with_a_full_sketch(spark, monkeypatch):
    """A sketch far too small lets all windows pass and loses none."""
    monkeypatch.setattr(sketch, "BLOCK_BITS", 8)
    rows = random_docs(4)
    got = substring.remove_repeats(h.documents(spark, rows), max_bits=512, texts=False)
    same(got, ["doc_id", "n_words", "n_removed", "kept_sha256"], brute_substring(rows))


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("group", [lpf.GROUP, 2, 1])
def test_bytes(spark, case, group, monkeypatch):
    """With GROUP 2 larger groups are split by sides, with GROUP 1 all are, and what is left is counted by hash."""
    monkeypatch.setattr(lpf, "GROUP", group)
    rows = CASES[case]
    got = lpf.remove_repeated_bytes(h.documents(spark, rows, extra="spans"))
    same(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute_bytes(rows))


def test_previous_smaller():
    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.int64), np.arange(9), np.arange(9)[::-1], *(rng.permutation(n) for n in range(1, 40))):
        got = lpf.previous_smaller(values).tolist()
        assert got == [max((j for j in range(k) if values[j] < v), default=-1) for k, v in enumerate(values)]


@pytest.mark.parametrize("depth", [1, 3, 7, 23])
@pytest.mark.parametrize("some", [False, True])
def test_longest_previous_factors(depth, some):
    """Lengths of factors against comparing each place with every earlier one."""
    rng = random.Random(depth)
    for _ in range(25):
        texts = ["".join(rng.choices("ab", k=rng.randint(0, 30))) for _ in range(6)]
        texts += [texts[0], "ab" * 14]
        groups = sorted(rng.randrange(3) for _ in texts)
        symbols = np.concatenate([np.frombuffer((t + "\0").encode(), np.uint8).astype(np.int64) for t in texts])
        group = np.concatenate([np.full(len(t) + 1, g) for t, g in zip(texts, groups)])
        places = np.array([k for k in range(len(symbols)) if not some or rng.random() < 0.5], np.int64)
        lengths, source = lpf.longest_previous_factors(symbols, group, depth, places if some else None)
        tails = [t[k:][:depth] for t in texts for k in range(len(t) + 1)]

        def common(x, y):
            return next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))

        for k, place in enumerate(places):
            earlier = [(common(tails[place], tails[j]), j) for j in places[:k] if group[j] == group[place]]
            longest = max((n for n, _ in earlier), default=0)
            assert lengths[k] == longest
            assert (longest, source[k]) in earlier if longest else source[k] == -1
            if longest == depth:
                assert source[k] == max(j for n, j in earlier if n == depth)


@pytest.mark.parametrize("depth", [3, 23, 101])
def test_whole_factors(depth):
    """Without shorter ones, factors of the whole depth are the same; fewer rounds of sorting than doublings rank them."""
    rng = random.Random(depth)
    texts = [t for _, t in random_docs(depth, 12)] * 2
    symbols = np.concatenate([np.frombuffer((t + "\0").encode(), np.uint8).astype(np.int64) for t in texts])
    group = np.concatenate([np.full(len(t.encode()) + 1, k // 5) for k, t in enumerate(texts)])
    places = np.flatnonzero(np.array([rng.random() < 0.5 for _ in symbols]))
    lengths, source = lpf.longest_previous_factors(symbols, group, depth, places)
    whole, at = lpf.longest_previous_factors(symbols, group, depth, places, shorter=False)
    assert (whole == np.where(lengths == depth, depth, 0)).all() and (whole > 0).any()
    assert (at == np.where(lengths == depth, source, -1)).all()
    assert [n for n, _ in lpf.suffix_ranks(symbols, group, 101)] == [5, 15, 45, 101]


@pytest.mark.parametrize("depth", [3, 11])
def test_whole_factors_stand_together(depth, monkeypatch):
    """Equal strings of the whole depth are neighbours in the suffix order: no search for smaller values is made."""
    monkeypatch.setattr(lpf, "previous_smaller", None)
    rng = random.Random(depth)
    for _ in range(20):
        texts = ["".join(rng.choices("ab", k=rng.randint(0, 20))) for _ in range(6)] + ["ab" * 9]
        texts.append(texts[0])
        groups = [k // 3 for k in range(len(texts))]
        symbols = np.concatenate([np.frombuffer((t + "\0").encode(), np.uint8).astype(np.int64) for t in texts])
        group = np.concatenate([np.full(len(t) + 1, g) for t, g in zip(texts, groups)])
        places = np.array([k for k in range(len(symbols)) if rng.random() < 0.7], np.int64)
        lengths, source = lpf.longest_previous_factors(symbols, group, depth, places, shorter=False)
        data = symbols.tobytes()
        whole = {p: (group[p], data[8 * p:8 * (p + depth)]) for p in places
                 if p + depth <= len(symbols) and symbols[p:p + depth].all()}
        for k, place in enumerate(places):
            earlier = [p for p in places[:k] if place in whole and whole.get(p) == whole[place]]
            assert (lengths[k], source[k]) == ((depth, earlier[-1]) if earlier else (0, -1))


def test_later_copies():
    """The first occurrence of each string stays, every later one goes."""
    rng = random.Random(6)
    base = [chr(97 + rng.randrange(26)) for _ in range(200)]
    texts = ["".join(base[:120]), "x" + "".join(base[60:160]) + "y", "zz" * 30, "short", ""]
    n = 20
    seen, expected = {}, []
    for text in texts:
        covered = bytearray(len(text))
        for k in range(len(text) - n + 1):
            if text[k:k + n] in seen:
                covered[k:k + n] = b"\1" * n
            seen[text[k:k + n]] = True
        expected.append(bytes(covered))
    got = [bytearray(len(t)) for t in texts]
    for own, spans in zip(got, lpf.later_copies(texts, n)):
        for a, b in spans:
            own[a:b] = b"\1" * (b - a)
    assert [bytes(g) for g in got] == expected


@pytest.mark.parametrize("case", CASES)
def test_jaccard(spark, case):
    rows = CASES[case]
    got = jaccard.similar_groups(h.documents(spark, rows, extra="component_id"))
    same(got, ["doc_id", "n_shingles", "component_id"], brute_jaccard(rows))


def test_jaccard_of_many_near_copies(spark):
    """One large group of near copies and a chain whose ends are unlike."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(80):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    chain = [f"c{k}" for k in range(150)]
    rows += [(1000 + k, " ".join(chain[k * 8:k * 8 + 90])) for k in range(8)]
    got = jaccard.similar_groups(h.documents(spark, rows), shingle=5, like=(80, 100))
    same(got, ["doc_id", "n_shingles", "component_id"], brute_jaccard(rows, 5, (80, 100)))


def test_each_order_removes_candidates(spark):
    """Pairs that share prefix shingles under one, two and three orders: fewer each time, and no link is lost."""
    rng = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(40):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(8)}"
        rows.append((k, " ".join(own)))
    docs = h.documents(spark, rows).select("doc_id", F.col("doc_id").alias("id"), "text")
    sets = {r.doc_id: r for r in jaccard.prefix_sets(docs).collect()}
    texts = dict(rows)
    alike = {(a, b) for a, b in h.pairs(sorted(texts))
             if len({c for _, _, c in brute_jaccard([(a, texts[a]), (b, texts[b])])}) == 1}
    left, counts = set(h.pairs(sorted(texts))), []
    for p in ("p0", "p1", "p2"):
        left = {(a, b) for a, b in left if set(sets[a][p] or ()) & set(sets[b][p] or ())}
        counts.append(len(left))
    assert alike <= left and len(alike) > 5
    assert counts[0] > counts[1] > counts[2]


def test_few_pairs_of_near_misses_are_compared(spark):
    """A group whose members are each a little too far from the others: what they share is common, and the comparison
    begins at rarer shingles. No link is lost."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(70):
        own = list(base)
        for place in rng.sample(range(0, 300, 5), 8 if k % 7 else 2):
            own[place] = f"x{rng.randrange(3)}"
        rows.append((k, " ".join(own)))
    docs = h.documents(spark, rows).select("doc_id", F.col("doc_id").alias("id"), "text")
    sets = jaccard.prefix_sets(docs).where("p0 IS NOT NULL")
    found = {r.node: r for r in sets.collect()}
    roots = spark.createDataFrame([], "node binary, root binary")
    pairs = {(r.a, r.b) for r in jaccard.pairs_across(sets, roots, jaccard.LIKE).collect()}
    texts = {r.node: dict(rows)[r.doc_id] for r in found.values()}
    names = sorted(found)
    alike = {(a, b) for a, b in h.pairs(names)
             if len({c for _, _, c in brute_jaccard([(0, texts[a]), (1, texts[b])])}) == 1}
    sharing = {(a, b) for a, b in h.pairs(names) if set(found[a].p0) & set(found[b].p0)}
    assert alike <= pairs and len(alike) > 20
    assert len(pairs) < len(sharing) / 10


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    got = {r.node: r.root for r in spark_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == h.components(nodes, [(a, b) for a, b in links if a != b])


def test_sketch_loses_no_repeated_key(spark):
    keys = np.random.default_rng(1).integers(0, 3000, 5000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "k long").repartition(5)
    bits, flags = sketch.merged_flags(frame, sketch.key_column("k"), 10)
    values, counts = np.unique(keys, return_counts=True)
    assert sketch.flagged(values[counts > 1].view(np.uint64), bits, flags).all()
    some = np.sort(np.random.default_rng(2).integers(0, 2**18, 4000))
    assert (sketch.unpacked(sketch.packed(some)) == some).all()


def test_listed_shingles_that_one_node_has_are_left_out(spark):
    """Members of lists that are in a sketch come with their places; those of one list only mostly do not."""
    rng = random.Random(8)
    rows = [(k, [rng.randrange(40) if rng.random() < 0.3 else 1000 * k + j for j in range(rng.randint(0, 30))])
            for k in range(50)]
    frame = spark.createDataFrame(rows, "node long, p array<long>").repartition(3)
    counts = Counter(t for _, tokens in rows for t in tokens)

    def keys(batch):
        yield np.array([t for tokens in batch.column("p").to_pylist() for t in tokens], np.int64).view(np.uint64)

    flags = spark.sparkContext.broadcast(sketch.merged_flags(frame, keys, 10))
    got = {(r.token, r.place, r.node) for r in jaccard.flagged_lists(frame, "p", flags).collect()}
    whole = {(t, j, k) for k, tokens in rows for j, t in enumerate(tokens)}
    assert {x for x in whole if counts[x[0]] > 1} <= got <= whole
    assert len(got) < len(whole) / 2


def test_names_and_marks_stay_out_of_lists(spark, monkeypatch):
    """What is stored for each listed shingle is numbers only, and of equal sets one is sent to be compared."""
    kept, real = defaultdict(list), jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda frame, name: kept[name].append(real(frame, name)) or kept[name][-1])
    sent, merge = [], jaccard.merged_flags

    def recorded(frame, keys_of, *rest, **options):
        if {"name", "id"} == set(frame.columns):
            sent.append(frame.count())
        return merge(frame, keys_of, *rest, **options)

    monkeypatch.setattr(jaccard, "merged_flags", recorded)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(base if k % 3 else base[:60] + [f"x{k}"] + base[61:])) for k in range(60)]
    same(jaccard.similar_groups(h.documents(spark, rows)), ["doc_id", "n_shingles", "component_id"], brute_jaccard(rows))
    assert [set(dict(f.dtypes).values()) for f in kept["lists"]] == [{"bigint"}]
    assert dict(kept["nodes"][0].dtypes)["node"] == "bigint"
    assert max(sent) <= kept["nodes"][0].count() == 21
