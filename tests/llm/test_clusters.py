"""Large clusters of distinct fingerprints: buckets cut along further bits, held against all pairs."""

import numpy as np
import pytest

from tallymill.llm import simhash
from tallymill.llm.components import local_roots


def clustered(rng):
    """Fingerprints close to each other in their last or first bits, lone ones, and two at distance 3 from a cluster."""
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    prints = [base[0] ^ np.uint64(v) for v in rng.integers(0, 1 << 12, 900)]
    prints += [base[1] ^ (np.uint64(v) << np.uint64(52)) for v in rng.integers(0, 1 << 12, 500)]
    prints += [base[2] ^ (np.uint64(v) << np.uint64(28)) for v in rng.integers(0, 1 << 9, 200)]
    prints += [p ^ np.uint64(7 << 40) for p in prints[:5]] + list(rng.integers(0, 1 << 63, 50, dtype=np.uint64))
    return np.unique(np.array(prints, np.uint64))


def brute_roots(prints):
    """Root of every fingerprint by comparing all pairs, roots being the smallest signed value."""
    signed = np.sort(prints.view(np.int64))
    a, b = np.nonzero(np.bitwise_count(signed[:, None].view(np.uint64) ^ signed.view(np.uint64)) <= simhash.RADIUS)
    root = local_roots(len(signed), a, b)
    sizes = np.bincount(root, minlength=len(signed))
    return {int(signed[i]): int(signed[r]) for i, r in enumerate(root) if sizes[r] > 1}


@pytest.mark.parametrize("gathered, variants", [(1 << 18, 8_000_000), (60, 8_000_000), (60, 400_000)])
def test_clusters_against_all_pairs(spark, monkeypatch, gathered, variants):
    monkeypatch.setattr(simhash, "GATHERED", gathered)
    monkeypatch.setattr(simhash, "VARIANTS", variants)
    prints = clustered(np.random.default_rng(11))
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    got = {r.node: r.root for r in simhash.linked_prints(df).collect()}
    assert got == brute_roots(prints)


def test_large_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GATHERED", 500)
    prints = clustered(np.random.default_rng(12))
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    sizes = simhash._in_buckets(df, simhash.LEAST_BITS).groupBy("bucket", "bits").count().collect()
    assert max(r["count"] for r in sizes) <= 500 < max(np.bincount((prints >> np.uint64(56)).astype(int)))
    assert {r.bits for r in sizes} > {simhash.LEAST_BITS}


def test_a_forest_is_made_of_the_given_links():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 30))
        a, b = rng.integers(0, n, (2, int(rng.integers(0, 60))))
        x, y = simhash._forest(n, a, b)
        root = local_roots(n, a, b)
        assert local_roots(n, x, y).tolist() == root.tolist() and len(x) == n - len(set(root.tolist()))
        assert set(zip(x.tolist(), y.tolist())) <= set(zip(a.tolist(), b.tolist()))
