"""Centroid clustering on a vector approximation file.

Every vector is kept twice: whole, in a table bucketed by row number, and as a cell of few bits per
dimension. Each round bounds the distances to all centroids from the cells by lookup tables.
A vector for which one centroid's largest distance is below the least distance of all others is
decided; only others are fetched whole. So are vectors that change their centroid, for the exact sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymill.llm.tables import bucketed_table
from tallymill.llm.whole import finite, whole
from tallymill.session import written_table

BITS = 4
#: Vectors compared at once.
STEP = 1024


def _cell_bounds(rows: DataFrame, size: int, bits: int) -> np.ndarray:
    """First value of every cell per dimension and, last, the largest value: cells of about equally many rows."""
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    each = lambda i: F.get("x", i)
    wide = [F.concat(F.array(F.min(each(i))), F.percentile_approx(each(i), cuts, 1000), F.array(F.max(each(i)))) for i in range(size)]
    found = rows.agg(F.array(*wide)).first()[0]
    return np.maximum.accumulate(np.array(found, np.int64), axis=1)


def _cells(bounds: np.ndarray):
    """Adds the cells of a vector, a byte per dimension (a file codec packs their few bits)."""

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
            cells = np.empty(x.shape, np.uint8)
            for d in range(x.shape[1]):
                cells[:, d] = np.searchsorted(bounds[d, 1:-1], x[:, d], side="right")
            data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(cells)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), data], ["row", "cells"])

    return run


def _tables(bounds: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared difference of (dimension, cell, centroid); an empty cell counts as its first value."""
    first = bounds[:, :-1]
    last = np.maximum(first, bounds[:, 1:] - 1)
    last[:, -1] = bounds[:, -1]
    below, above = first[:, :, None] - centroids.T[:, None, :], centroids.T[:, None, :] - last[:, :, None]
    return np.maximum(np.maximum(below, above), 0) ** 2, np.maximum(np.abs(below), np.abs(above)) ** 2


def _bounded(bounds: np.ndarray, centroids: np.ndarray):
    """(row, cells, before, cluster, open): ``open`` lists the centroids that may be the nearest where several may be."""

    def run(batches):
        least, most = _tables(bounds, centroids)
        size, cells_each = least.shape[:2]
        least, most = least.reshape(size * cells_each, -1), most.reshape(size * cells_each, -1)
        for batch in batches:
            cells = np.frombuffer(b"".join(c.as_py() for c in batch.column("cells")), np.uint8).reshape(-1, size)
            cluster, open_ = np.empty(len(cells), np.int32), []
            for at in range(0, len(cells), STEP):
                where = cells[at : at + STEP] + np.arange(size) * cells_each
                low = np.zeros((len(where), len(centroids)), np.int64)
                high = np.zeros_like(low)
                for d in range(size):
                    low += least[where[:, d]]
                    high += most[where[:, d]]
                may = low <= high.min(axis=1)[:, None]
                cluster[at : at + STEP] = may.argmax(axis=1)
                open_ += [np.flatnonzero(m).astype(np.int32) if n > 1 else None for m, n in zip(may, may.sum(axis=1))]
            arrays = [batch.column("row"), batch.column("cells"), batch.column("cluster"), pa.array(cluster), pa.array(open_, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "cells", "before", "cluster", "open"])

    return run


def _decided(centroids: np.ndarray):
    """(row, cells, before, cluster, x): the nearest of the open centroids; ``x`` only where the cluster is new."""

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1).astype(np.int64)
            cluster = batch.column("cluster").to_numpy().copy()
            may = np.zeros((len(x), len(centroids)), bool)
            lists = batch.column("open")
            several = lists.is_valid().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.flatnonzero(several), lists.drop_null().value_lengths().to_numpy())
            may[rows, lists.drop_null().flatten().to_numpy()] = True
            best = np.full(len(x), np.iinfo(np.int64).max)
            for c, centroid in enumerate(centroids):
                asked = np.flatnonzero(may[:, c])
                distance = ((x[asked] - centroid) ** 2).sum(axis=1)
                nearer = distance < best[asked]
                best[asked[nearer]], cluster[asked[nearer]] = distance[nearer], c
            before = batch.column("before")
            same = (before.is_valid().to_numpy(zero_copy_only=False)) & (before.fill_null(-1).to_numpy() == cluster)
            moved = pa.array([None if s else v for s, v in zip(same, x.astype(np.int32))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("cells"), before, pa.array(cluster), moved], ["row", "cells", "before", "cluster", "x"])

    return run


def cluster(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    size: int = 64,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    bits: int = BITS,
    salt: str = "1:",
) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) per kept vector, the final centroids).

    Kept are vectors of exactly ``size`` finite components, which become ``floor(scale * x)``. Centroids
    start as the vectors whose ids have the smallest SHA-256 of ``salt`` and id; repeated ids go by
    their vectors, null ids come last. Each round assigns vectors to the nearest centroid, ties to the
    smaller number, and makes a centroid with vectors the floor of their mean; then they are assigned
    once more. With fewer vectors than ``k`` there are fewer centroids. Repeated rows count each. An
    empty table gives no rows and no centroids. Components too large for exact squared distances are
    held at the largest that is not. Other columns of ``df`` are not looked at.
    """
    kept = df.where(finite(F.col(vector_column)) & (F.size(vector_column) == size))
    rows = kept.select(F.col(id_column).alias("id"), whole(F.col(vector_column), scale, size).alias("x"))
    vectors = bucketed_table(rows.withColumn("row", F.monotonically_increasing_id()), "row", "vectors")
    hashed = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    start = vectors.orderBy(F.asc_nulls_last(hashed), "x").select("x").limit(k).collect()
    if not start:
        return vectors.select(F.col("id").alias(id_column), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.empty((0, size), np.int64)
    centroids = np.array([r.x for r in start], np.int64)
    bounds = _cell_bounds(vectors, size, bits)
    state = vectors.select("row", "x").mapInArrow(_cells(bounds), "row long, cells binary")
    state = written_table(state.withColumn("cluster", F.lit(None).cast("int")), "cells")
    n, sums = np.zeros(len(centroids), object), np.zeros(centroids.shape, object)
    for last in [False] * rounds + [True]:
        told = state.select("row", "cells", "cluster").mapInArrow(
            _bounded(bounds, centroids), "row long, cells binary, before int, cluster int, open array<int>"
        )
        told = written_table(told, "bounded")
        wanted = F.col("open").isNotNull() if last else F.col("open").isNotNull() | ~F.col("before").eqNullSafe(F.col("cluster"))
        fetched = told.where(wanted).join(vectors.select("row", "x"), "row")
        fetched = fetched.mapInArrow(_decided(centroids), "row long, cells binary, before int, cluster int, x array<int>")
        state = told.where(~wanted).select("row", "cells", "before", "cluster", F.lit(None).cast("array<int>").alias("x")).unionByName(fetched)
        state = written_table(state, "clusters")
        if last:
            break
        both = F.array(
            F.struct(F.col("cluster").alias("c"), F.lit(1).cast("long").alias("sign"), "x"),
            F.struct(F.col("before").alias("c"), F.lit(-1).cast("long").alias("sign"), "x"),
        )
        moved = state.where("x is not null").select(F.inline(both)).where("c is not null")
        totals = [F.sum("sign").alias("n"), *[F.sum(F.col("sign") * F.get("x", i)).alias(f"s{i}") for i in range(size)]]
        for r in moved.groupBy("c").agg(*totals).collect():
            n[r.c] += r.n
            sums[r.c] += [r[f"s{i}"] for i in range(size)]
        for c in np.flatnonzero(n):
            centroids[c] = [int(s) // int(n[c]) for s in sums[c]]
    final = F.array(*[F.array(*[F.lit(int(v)) for v in c]) for c in centroids])
    apart = F.zip_with("x", F.get(final, F.col("cluster")), lambda a, b: (a.cast("long") - b) * (a.cast("long") - b))
    distance = F.aggregate(apart, F.lit(0).cast("long"), lambda s, v: s + v)
    out = vectors.join(state.select("row", "cluster"), "row")
    return out.select(F.col("id").alias(id_column), "cluster", distance.alias("distance")), centroids


def with_inertia(clustered: DataFrame) -> DataFrame:
    """Adds ``cluster_inertia`` and ``inertia``, the distances summed over a vector's cluster and over all; null beyond a long."""
    clustered = written_table(clustered, "clustered")
    sums = clustered.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    fits = lambda v: F.lit(int(v) if v < 2**63 else None).cast("long")
    own = F.coalesce(*[F.when(F.col("cluster") == r.cluster, fits(r.s)) for r in sums], F.lit(None).cast("long"))
    return clustered.withColumns({"cluster_inertia": own, "inertia": fits(sum(r.s for r in sums))})
