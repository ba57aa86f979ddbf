"""Top-k of finite vectors of any size, with exact scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm import topk


def top(vectors, asked, k=10):
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}
    found = []
    for q in asked:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return found


@pytest.mark.parametrize("rows", [60, 8192])
def test_large_vectors_take_part(spark, monkeypatch, rows):
    monkeypatch.setattr(topk, "ROWS", rows)
    monkeypatch.setattr(topk, "STEP", 16)
    rng = np.random.default_rng(6)
    sizes = 10.0 ** rng.choice([-1, 0, 3, 3.3, 5, 6], 200)
    vectors = {i: [float(x) for x in v] for i, v in enumerate(rng.standard_normal((200, 12)) * sizes[:, None])}
    vectors[20], vectors[21] = [1e6 + 1 / 1024] + vectors[20][1:], [1e6] + vectors[20][1:]
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(got) == top(vectors, range(0, 200, 20))


def test_scores_around_the_largest_longs(spark):
    vectors = {0: [2.0**21, 1.0], 1: [2.0**21, 0.5], 2: [2.0**21, 0.25], 3: [-1e300, 0.0], 4: [1.0, 1.0], 5: [-(2.0**18), 0.0]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0, k=4).collect()]
    assert sorted(got) == top(vectors, [0], 4)
    with pytest.raises(Exception, match="no bigint"):
        topk.top_k(df, F.col("vec_id") == 3, k=5).collect()
