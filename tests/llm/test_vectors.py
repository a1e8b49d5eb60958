"""Whitening and hard negatives against brute force, on awkward vectors."""

import math

import numpy as np
import pytest

from claimwright.llm import negatives, vectors, whitening

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def random_rows(n=130, width=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * 0.3
    x[:, 0] *= 4
    return [(i, [float(v) for v in row], i % 3) for i, row in enumerate(x)]


def awkward_rows(width=6):
    nan, inf = float("nan"), float("inf")
    return [
        *random_rows(40, width),
        (100, None, 1), (101, [0.1, None], 1), (102, [nan] * width, 0), (103, [inf] + [0.0] * (width - 1), 0),
        (104, [], 2), (105, [0.5, -0.25], 1), (200, [1.0] * width, None), (None, [0.4] * width, 1),
        (0, [0.7] * width, 0), (0, [0.7] * width, 0), (300, [0.7] * width, 0), (7, [0.7] * width, 2),
        (301, [0.5] * width, 2), (302, [0.5] * width, 2), (303, [0.5] * width, 1),
    ]


def taking_part(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def whole(rows, scale):
    kept = taking_part(rows)
    width = max((len(r[1]) for r in kept), default=0)
    return kept, [[math.floor(scale * float(np.float32(c))) for c in r[1]] + [0] * (width - len(r[1])) for r in kept]


def embeddings(spark, rows, parts=3):
    return spark.createDataFrame(rows, EMBEDDINGS).repartition(parts)


# --- the spectrum -----------------------------------------------------------------------------------------


def scatter(x):
    away = x - x.mean(0)
    return away.T @ away


@pytest.mark.parametrize("n, width, step", [(300, 24, 1.0), (10, 24, 1.0), (200, 5, 50.0), (60, 1, 1.0)])
def test_spectrum_equals_decomposition(n, width, step):
    rng = np.random.default_rng(n)
    x = np.floor(rng.normal(size=(n, width)) * 20 / step) * step
    x[5:9] = x[4]
    first, second = whitening.Spectrum(width), whitening.Spectrum(width)
    for row in x[:n // 2]:
        first.add(row)
    rows, counts = np.unique(x[n // 2:], axis=0, return_counts=True)
    for row, count in zip(rows, counts):
        second.add(row, int(count))
    first.merge(second)
    first.merge(whitening.Spectrum(width))
    m = scatter(x)
    k = len(first.values)
    assert first.n == n and np.allclose(first.mean, x.mean(0), rtol=1e-12, atol=1e-12)
    assert np.abs(first.vectors * first.values @ first.vectors.T - m).max() < 1e-11 * np.abs(m).max()
    assert np.abs(first.vectors.T @ first.vectors - np.eye(k)).max() < 1e-12


def test_rank_one_with_equal_eigenvalues_and_untouched_components():
    rng = np.random.default_rng(0)
    vectors_ = np.linalg.qr(rng.normal(size=(8, 8)))[0]
    values = np.array([0.0, 0.0, 1.0, 1.0, 1.0, 2.0, 5.0, 5.0])
    z = np.array([0.0, 0.0, 0.5, -1.0, 0.0, 0.0, 1e-30, 2.0])
    got, turned = whitening.rank_one(values, vectors_, z, 3.0)
    v = vectors_ @ z
    want = vectors_ * values @ vectors_.T + 3.0 * np.outer(v, v)
    assert np.allclose(turned * got @ turned.T, want, atol=1e-13)
    assert (np.diff(got) >= 0).all()


def test_secular_roots_lie_between_the_poles():
    d, z = np.array([1.0, 1.0 + 1e-9, 2.0, 1e6]), np.array([1e-5, 1.0, 1e-3, 2.0])
    roots, delta = whitening.secular_roots(d, z, 0.5)
    want = np.linalg.eigvalsh(np.diag(d) + 0.5 * np.outer(z, z))
    assert np.allclose(roots, want, rtol=1e-12)
    assert (roots[:-1] >= d[:-1]).all() and (roots[:-1] <= d[1:]).all()
    assert np.allclose(delta, d - roots[:, None], atol=1e-9)


def check_whitening(rows, got, components):
    kept, x = whole(rows, 64)
    x = np.array(x, dtype=float)
    n, width = x.shape
    covariance = scatter(x) / n
    values, turn = np.linalg.eigh(covariance)
    values, turn = values[::-1], turn[:, ::-1]
    components = min(components, width)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert len(got) == n * components
    whole_x = (x + whitening.OFFSET).astype(np.int64).astype(object)
    sums = whole_x.sum(0)
    ids = [r[0] for r in kept]
    for k in range(components):
        own = sorted([(-1 if r["vec_id"] is None else r["vec_id"], r["deviation"], r["whitened"]) for r in got
                      if r["component"] == k + 1], key=lambda t: t[:2])
        deviations = [int(((n * row - sums)**2).sum()) for row in whole_x]
        assert [t[:2] for t in own] == sorted((-1 if i is None else i, s) for i, s in zip(ids, deviations))
        if values[k] < 1e-9 * values[0]:
            assert all(t[2] is None for t in own)
            continue
        want = sorted(zip([-1 if i is None else i for i in ids], deviations,
                          (x - x.mean(0)) @ turn[:, k] / np.sqrt(values[k])), key=lambda t: t[:2])
        mine, theirs = np.array([t[2] for t in own]), np.array([t[2] for t in want])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8
        explained = [r["explained"] for r in got if r["component"] == k + 1]
        assert np.allclose(explained, values[k] / covariance.trace(), rtol=1e-9)
    assert {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("rows", [random_rows(), awkward_rows()])
def test_whitening_equals_brute_force(spark, rows):
    check_whitening(rows, whitening.whiten(embeddings(spark, rows)).collect(), 32)


def test_whitening_of_leading_components_only(spark, monkeypatch):
    """A spectrum that keeps few pairs, and many parts to combine: residuals bring the rest."""
    monkeypatch.setattr(whitening, "RANK", 5)
    monkeypatch.setattr(whitening, "SPARE", 1)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows = random_rows(400, 12, seed=8)
    rows = [(i, [c * (1 + 12 - k) for k, c in enumerate(v)], label) for i, v, label in rows]
    got = whitening.whiten(embeddings(spark, rows, 7), components=3).collect()
    check_whitening(rows, got, 3)


def test_whitening_without_variance(spark):
    rows = [(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)]
    got = whitening.whiten(embeddings(spark, rows)).collect()
    assert len(got) == 4
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in got} == {(None, None, None, 0)}
    flat = [(i, [0.5, float(i)], 0) for i in range(4)]
    second = [r for r in whitening.whiten(embeddings(spark, flat)).collect() if r["component"] == 2]
    assert {(r["whitened"], r["explained"]) for r in second} == {(None, 0.0)}


def test_whitening_of_very_large_entries(spark):
    rows = [(1, [3e38, 0.0], 0), (2, [-3e38, 1.0], 0), (3, [0.0, 2.0], 0)]
    got = whitening.whiten(embeddings(spark, rows)).collect()
    assert len(got) == 6 and {r["deviation"] for r in got if r["vec_id"] == 1} == {None}


def test_empty_and_extra_columns(spark):
    nothing = spark.createDataFrame([], EMBEDDINGS)
    assert whitening.whiten(nothing).collect() == [] == negatives.hard_negatives(nothing).collect()
    only_bad = spark.createDataFrame([(100, None, 1)], EMBEDDINGS)
    assert whitening.whiten(only_bad).collect() == [] == negatives.hard_negatives(only_bad).collect()
    from pyspark.sql import functions as F
    rows = embeddings(spark, random_rows()).withColumns({"n": F.lit("x"), "row": F.lit(1), "cells": F.lit(2.0)})
    assert whitening.whiten(rows).count() == 130 * 6
    assert negatives.hard_negatives(rows).columns[0] == "anchor_id"


# --- hard negatives -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [(1, 1, 1), (5, 64, 300), (33, 17, 47), (64, 64, 64), (40, 0, 40), (70, 35, 1)])
def test_strassen_equals_the_product(sizes):
    rng = np.random.default_rng(sum(sizes))
    a = rng.integers(-2**40, 2**40, (sizes[0], sizes[1]))
    b = rng.integers(-2**20, 2**20, (sizes[1], sizes[2]))
    assert (negatives.strassen(a, b, leaf=4) == a @ b).all()


def brute_negatives(rows, every, positives=5, count=10):
    kept, x = whole([r for r in rows if r[2] is not None], 256)
    x = np.array(x, dtype=object)
    scores = x @ x.T
    out = []
    big = float("inf")
    for a, anchor in enumerate(kept):
        if anchor[0] is None or anchor[0] % every:
            continue
        order = sorted((b for b in range(len(kept)) if b != a),
                       key=lambda b: (-scores[a, b], big if kept[b][0] is None else kept[b][0], b))
        for p in [b for b in order if kept[b][2] == anchor[2]][:positives]:
            least, most = 30 * scores[a, p], 90 * scores[a, p]
            far = [b for b in order if kept[b][2] != anchor[2] and least <= 100 * scores[a, b] <= most][:count]
            out += [(anchor[0], kept[p][0], k + 1, kept[b][0], scores[a, p], scores[a, b]) for k, b in enumerate(far)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows, every", [(random_rows(), 10), (awkward_rows(), 100), (awkward_rows(), 1),
                                         (random_rows(90, 3, 5) + random_rows(90, 3, 5), 30)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, rows, every):
    monkeypatch.setattr(negatives, "ANCHORS", 9)  # several groups of anchors
    monkeypatch.setattr(vectors, "TILE_BYTES", 700)  # many tiles
    got = negatives.hard_negatives(embeddings(spark, rows), every=every).collect()
    assert sorted(map(tuple, got), key=repr) == brute_negatives(rows, every)


def test_a_hot_vector_and_a_hot_label(spark):
    rows = [(i, [0.5, 0.5], 0) for i in range(300)] + [(1000 + i, [0.3, 0.4 + i / 100], 1) for i in range(40)]
    got = negatives.hard_negatives(embeddings(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_negatives(rows, 100)
