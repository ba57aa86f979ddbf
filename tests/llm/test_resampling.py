"""Importance resampling: counts, weights, noise and cut against brute force."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm import resampling

DOC = "doc_id long, text string, kept string, n_grams int, id int"
M = 2**64


def grams(text):
    """Buckets of words and word pairs, one by one."""
    words = [zlib.crc32(w) for w in (text or "").encode().lower().split()]
    single = [w * 0x94D049BB133111EB % M for w in words]
    pairs = [(a * 0x9E3779B97F4A7C15 + b * 0xBF58476D1CE4E5B9) % M for a, b in zip(words, words[1:])]
    return [(x >> 40) % resampling.BUCKETS for x in single + pairs]


def some_rows():
    rng = np.random.default_rng(3)
    good, bad = [f"fine{i}" for i in range(40)], [f"junk{i}" for i in range(40)]
    texts = [" ".join(rng.choice(good if i % 2 else bad, int(rng.integers(1, 60)))) for i in range(80)]
    texts += [None, "", " \n", "One", texts[5], texts[5], "x " * 3000]
    return [(i if i != 11 else None, t) for i, t in enumerate(texts)] + [(5, texts[5]), (7, "another text under an id that is there")]


@pytest.mark.parametrize("temperature", [1.0, 4.0])
def test_weights_and_draw(spark, monkeypatch, temperature):
    rows = some_rows()
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], DOC).repartition(4)
    targets = {i for i, _ in rows if i is not None and i < 60 and i % 2}
    ids = spark.createDataFrame([(i,) for i in [*targets, *targets, None, 999]], "id long")
    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in targets:
            target.update(grams(t))
    n_raw, n_target = sum(raw.values()) + resampling.PRIOR * resampling.BUCKETS, sum(target.values())

    def weight(text):
        share = lambda g: resampling.BACKGROUND + (1 - resampling.BACKGROUND) * (target[g] / n_target) / ((raw[g] + resampling.PRIOR) / n_raw)
        return sum(math.log(share(g)) for g in grams(text))

    noise = {r.id: r.g for r in spark.createDataFrame([(i,) for i in {i for i, _ in rows}], "id long").select("id", resampling.gumbel(F.col("id")).alias("g")).collect()}
    got = sorted(((r.doc_id, r.n_grams, r.log_weight, r.gumbel_key, r.kept) for r in resampling.resample(df, ids, temperature=temperature).collect()), key=repr)
    expected = sorted(((i, len(grams(t)), weight(t), weight(t) / temperature + noise[i]) for i, t in rows), key=repr)
    keys = sorted((math.floor(e[3] * 2**20) for e in expected), reverse=True)
    cut = keys[round(resampling.KEEP * len(keys)) - 1]
    by_key = sorted(expected, key=lambda e: (repr(e[0]), e[1], e[3]))
    for g, e in zip(sorted(got, key=lambda g: (repr(g[0]), g[1], g[3])), by_key):
        assert g[:2] == e[:2] and g[2] == pytest.approx(e[2], abs=1e-9) and g[3] == pytest.approx(e[3], abs=1e-9)
        assert g[4] == (math.floor(g[3] * 2**20) >= cut)


def test_noise_is_gumbel(spark):
    g = np.array([r.g for r in spark.range(20000).select(resampling.gumbel(F.col("id")).alias("g")).collect()])
    assert abs(g.mean() - 0.5772) < 0.03 and abs(g.std() - math.pi / math.sqrt(6)) < 0.03


def test_draw_is_in_proportion_to_weights():
    """Gumbel top-1 over many draws of the noise takes each item as often as its weight says."""
    weights = np.array([1.0, 2.0, 5.0])
    rng = np.random.default_rng(0)
    wins = (np.log(weights) - np.log(-np.log(rng.random((40000, 3))))).argmax(axis=1)
    assert np.allclose(np.bincount(wins) / 40000, weights / 8, atol=0.01)


def test_no_targets_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", "", 0, 0), (2, None, "", 0, 0)], DOC)
    none = spark.createDataFrame([], "id long")
    assert {r.log_weight for r in resampling.resample(df, none).collect()} == {0.0}
    assert resampling.resample(df.limit(0), none).count() == 0


def test_kth_largest(spark):
    values = [3, 3, -5, 10**15, 7, 7, 7, -(10**15)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [resampling.kth_largest(df, "v", k) for k in range(1, 9)] == sorted(values, reverse=True)
    assert resampling.kth_largest(df, "v", 0) is None
