"""Pieces, plan and packing."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimwright.llm import packing
from tests.llm import helpers as h

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_tokens_equal_the_tokenizer():
    full = Tokenizer.from_file(PATH)
    full.encode_special_tokens = True
    own = packing.Tokens(PATH)
    odd = ["", " ", "a", " a", "a ", "a  b", "x\n\n y", "don't  's 's", "naïve 日本 語", "<|endoftext|> a", "tab\t a\n b",
           "1 2 ١٢", "\x1c a\x1cb \x85 c", "\xa0 x\xa0\xa0y"]
    rng = random.Random(5)
    alphabet = "ab1 \n\t'.-é\x85\xa0ß\x00\x1f"
    odd += ["".join(rng.choices(alphabet, k=40)) for _ in range(200)]
    for text in odd + [t or "" for _, t in h.awkward_rows()]:
        assert np.frombuffer(own.of(text), "<u4").tolist() == full.encode(text, add_special_tokens=False).ids


def test_tokens_equal_the_tokenizer_as_loaded():
    full = Tokenizer.from_file(PATH)
    own = packing.Tokens(PATH, added=True)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "é<|endoftext|><|endoftext|> 日", "<|endoftext|", "no token",
             "a" + " " * 1_000_000 + "x", "a" + "\n" * 1_000_000 + "x"]
    texts += ["a" + c * n + "x" for c in " \n\x85\xa0" for n in (packing.LONG_RUN - 1, packing.LONG_RUN)]
    for text in texts:
        assert np.frombuffer(own.of(text), "<u4").tolist() == full.encode(text, add_special_tokens=False).ids


def test_pieces_of_added_tokens_and_long_runs(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "a" + " " * 1_000_000 + "x")]
    got = {(r.doc_id, r.piece): r for r in packing.pieces(h.documents(spark, rows), PATH, ids=True).collect()}
    full = Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        own = [got[k] for k in sorted(got) if k[0] == doc_id]
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist()
        assert ids == full.encode(text, add_special_tokens=False).ids + [packing.END]


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece(seed):
    rng = random.Random(seed)
    histogram = Counter(min(2048, int(rng.lognormvariate(5.5, 1.3)) + 1) for _ in range(3000))
    groups = packing.plan(dict(histogram))
    assert all(sum(g) <= 2048 for g, _ in groups)
    used = Counter()
    for g, n in groups:
        for length in g:
            used[length] += n
    assert used == histogram
    least = -(-sum(k * v for k, v in histogram.items()) // 2048)
    assert sum(n for _, n in groups) <= 1.01 * least + 2


def test_plan_of_hard_histograms():
    assert packing.plan({}) == []
    assert sum(n for _, n in packing.plan({2048: 7})) == 7
    assert sum(n for _, n in packing.plan({1025: 9})) == 9
    assert sum(n for _, n in packing.plan({1: 5000})) == 3


def test_least_squares():
    rng = np.random.default_rng(0)
    for _ in range(10):
        a = rng.random((8, 15))
        x = packing.nonnegative_least_squares(a, rng.random(8) * 5)
        assert (x >= 0).all()
    a = np.array([[1.0, 0], [0, 1]])
    assert np.allclose(packing.nonnegative_least_squares(a, np.array([2.0, -1])), [2, 0])


@pytest.mark.parametrize("bucket", [packing.ROWS_PER_BUCKET, 2])
def test_pack(spark, bucket, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_BUCKET", bucket)
    rows = h.awkward_rows()
    got = packing.pack(packing.pieces(h.documents(spark, rows, extra="length"), PATH, ids=True)).collect()
    full = Tokenizer.from_file(PATH)
    expected = Counter()
    for doc_id, text in rows:
        ids = full.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 if len(ids) > 2048 and len(ids) % 2048 else min(2048, len(ids))
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            data = np.array(ids[a:b], "<u4").tobytes()
            expected[(doc_id, k, a, b - a, zlib.crc32(data), data)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == expected
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_pack_nothing(spark):
    assert packing.pack(packing.pieces(h.documents(spark, []), PATH)).collect() == []
