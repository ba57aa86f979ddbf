"""Codes by trie and clusters by approximation cells against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm import trie_codes, vafile, whole

ROW = "vec_id long, embedding array<float>, label string, row int, x int, cluster int, code string"


def some_vectors(size, n=60):
    rng = np.random.default_rng(size)
    vectors = [[float(np.float32(v)) for v in np.round(rng.standard_normal(size) / 4, 1)] for _ in range(n)]
    vectors += [vectors[3], vectors[3], [0.0] * size, [-0.001] * size]
    odd = [None, [], [1.0] * (size + 1), [None] + [1.0] * (size - 1), [float("nan")] + [1.0] * (size - 1), [float("-inf")] * size]
    return [(i % 50 if i != 7 else None, v) for i, v in enumerate(vectors + odd)]


def kept(rows, size, scale):
    """(id, whole numbers) of the vectors that take part, in the order of ids, nulls last."""
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    return sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def assigned(x, book):
    d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def improved(x, book, rounds):
    book = book.copy()
    for _ in range(rounds):
        best, _ = assigned(x, book)
        for e in np.unique(best):
            book[e] = [sum(c) // int((best == e).sum()) for c in x[best == e].T.tolist()]
    return book


def frame(spark, rows):
    return spark.createDataFrame([(i, v, str(len(v or [])), 1, 2, 3, "c") for i, v in rows], ROW).repartition(3)


def test_nearest_walks_like_brute_force():
    rng = np.random.default_rng(1)
    for spread, leaves in ((3, 512), (40, 512), (2**28, 512), (3, 4)):
        parts = np.unique(rng.integers(-spread, spread, (700, 4)), axis=0)
        entries = rng.integers(-spread, spread, (9, 4))
        entries[5] = entries[2]
        trie_codes.LEAVES, before = leaves, trie_codes.LEAVES
        try:
            entry, distance = trie_codes.nearest(parts, entries)
        finally:
            trie_codes.LEAVES = before
        best, least = assigned(parts, entries)
        assert entry.tolist() == best.tolist() and distance.tolist() == least.tolist()


@pytest.mark.parametrize("entries", [8, 256])
def test_codes(spark, entries):
    rows = some_vectors(8)
    coded, books = trie_codes.vector_codes(frame(spark, rows), keep=["label"], entries=entries)
    ordered = kept(rows, 8, 1024)
    x = np.array([v for _, v in ordered])
    code, error = [], 0
    for p in range(4):
        own = x[:, 2 * p : 2 * p + 2]
        book = improved(own, own[:entries], 4)
        assert books[p].tolist() == book.tolist()
        best, least = assigned(own, book)
        code.append(best)
        error = error + least
    expected = sorted(zip([i for i, _ in ordered], np.array(code).T.tolist(), error.tolist()), key=repr)
    assert sorted(((r.row.vec_id, r.code, r.error) for r in coded.collect()), key=repr) == expected
    assert {r.row.label for r in coded.collect()} == {"8"}


def test_clusters(spark):
    rows = some_vectors(6)
    ordered = kept(rows, 6, 64)
    start = sorted(ordered, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:5]
    x = np.array([v for _, v in ordered])
    book = improved(x, np.array([v for _, v in start]), 3)
    best, least = assigned(x, book)
    for bits in (1, 3, 8):
        out, centroids = vafile.cluster(frame(spark, rows), size=6, k=5, bits=bits)
        assert centroids.tolist() == book.tolist()
        got = sorted(((r.vec_id, r.cluster, r.distance) for r in out.collect()), key=repr)
        assert got == sorted(zip([i for i, _ in ordered], best.tolist(), least.tolist()), key=repr)
    sums = {r.cluster: (r.cluster_inertia, r.inertia) for r in vafile.with_inertia(out).collect()}
    assert sums == {c: (int(least[best == c].sum()), int(least.sum())) for c in set(best.tolist())}


def test_cells_bound_the_distance():
    rng = np.random.default_rng(2)
    x = rng.integers(-40, 40, (300, 5))
    centroids = rng.integers(-40, 40, (4, 5))
    bounds = np.sort(np.concatenate([[x.min(axis=0)], np.quantile(x, [0.3, 0.3, 0.7], axis=0, method="lower"), [x.max(axis=0)]]), axis=0).T
    least, most = vafile._tables(bounds, centroids)
    cells = np.stack([np.searchsorted(bounds[d, 1:-1], x[:, d], side="right") for d in range(5)], axis=1)
    low, high = (sum(t[d][cells[:, d]] for d in range(5)) for t in (least, most))
    exact = ((x[:, None, :] - centroids) ** 2).sum(axis=2)
    assert (low <= exact).all() and (exact <= high).all()


def test_few_and_no_vectors(spark):
    nothing = frame(spark, [])
    coded, books = trie_codes.vector_codes(nothing)
    out, centroids = vafile.cluster(nothing)
    assert coded.count() == 0 and books == [] and vafile.with_inertia(out).count() == 0 and len(centroids) == 0
    same = frame(spark, [(1, [0.5] * 64)] * 3)
    assert {(tuple(r.code), r.error) for r in trie_codes.vector_codes(same)[0].collect()} == {((0, 0, 0, 0), 0)}
    assert [(r.cluster, r.distance) for r in vafile.cluster(same)[0].collect()] == [(0, 0)] * 3


def test_huge_components_are_held(spark):
    df = spark.createDataFrame([(1, [1e300, -1e300, 0.5, 0.0])], "id long, v array<double>")
    most = whole.largest(4)
    assert df.select(whole.whole(F.col("v"), 1024, 4)).first()[0] == [most, -most, 512, 0] and 4 * (2 * most) ** 2 < 2**63
