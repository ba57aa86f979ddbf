"""Short codes for vectors: the nearest codebook entry of each of their parts.

Distinct parts are counted, sorted and cut into ranges. Each task walks the trie of its range
depth-first, one component per level: the distances of a common prefix to all entries are added up once for
all parts that begin with it. A leaf takes the nearest entry and adds its part, as often as it
occurs, to the entry's sum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymill.llm.whole import finite, whole
from tallymill.session import written_table

#: Leaves that are walked together.
LEAVES = 512


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row of ``parts``, which are sorted and differ; ties go to the lower entry."""
    m, width = parts.shape
    most = int(max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)))
    kind = np.int32 if 4 * width * most * most < 2**31 else np.int64
    columns = np.ascontiguousarray(entries.T.astype(kind))
    parts = parts.astype(kind)
    shared = np.zeros(m, np.int64)  # components shared with the part before
    shared[1:] = np.argmax(parts[1:] != parts[:-1], axis=1)
    path = [np.zeros(len(entries), kind)] * (width + 1)  # distances along the way to the last leaf
    entry, distance = np.empty(m, np.int64), np.empty(m, np.int64)
    for at in range(0, m, LEAVES):
        own, common = parts[at : at + LEAVES], shared[at : at + LEAVES]
        node, known = np.zeros(len(own), np.int64), path[0][None, :]
        for depth in range(width):
            begins = common <= depth
            old = not begins[0]
            begins[0] = True
            first = np.flatnonzero(begins)
            grown = columns[depth] - own[first, depth][:, None]
            grown *= grown
            grown += known[node[first]]
            if old:
                grown[0] = path[depth + 1]
            node, known = np.cumsum(begins) - 1, grown
            path[depth + 1] = grown[-1]
        entry[at : at + LEAVES] = known.argmin(axis=1)
        distance[at : at + LEAVES] = known.min(axis=1)
    return entry, distance


def whole_rows(df: DataFrame, vector_column: str, keep: list[str], order: list, parts: int, scale: int) -> DataFrame:
    """(keep as struct ``row``, x): the finite vectors as whole numbers, written.

    All have the size of the first one by ``order`` whose size is a multiple of ``parts``.
    """
    kept = df.where(finite(F.col(vector_column)) & (F.size(vector_column) % parts == 0))
    first = kept.orderBy(*order, vector_column).select(F.size(vector_column)).first()
    size = first[0] if first else parts
    x = whole(F.col(vector_column), scale, size).alias("x")
    return written_table(kept.where(F.size(vector_column) == size).select(F.struct(*keep).alias("row"), x), "whole-vectors")


def _sums(codebooks: list[np.ndarray]):
    """(position, entry, n, sums) of a task's distinct parts."""
    k, width = codebooks[0].shape

    def run(batches):
        n = np.zeros((len(codebooks), k), np.int64)
        sums = np.zeros((len(codebooks), k, width), np.int64)
        for batch in batches:
            position = batch.column("position").to_numpy()
            part = batch.column("part").flatten().to_numpy().reshape(-1, width).astype(np.int64)
            weight = batch.column("n").to_numpy()
            for p in np.unique(position):
                own = position == p
                entry, _ = nearest(part[own], codebooks[p])
                np.add.at(n[p], entry, weight[own])
                np.add.at(sums[p], entry, part[own] * weight[own][:, None])
        p, entry = np.nonzero(n)
        flat = pa.array(sums[p, entry].ravel())
        ends = pa.array(np.arange(len(p) + 1, dtype=np.int32) * width)
        yield pa.record_batch({"position": p.astype(np.int32), "entry": entry.astype(np.int32), "n": n[p, entry], "sums": pa.ListArray.from_arrays(ends, flat)})

    return run


def fit(rows: DataFrame, order: list, parts: int = 4, entries: int = 256, rounds: int = 4) -> list[np.ndarray]:
    """One codebook per part position, from the rows of :func:`whole_rows`.

    Codebooks begin with the parts of the first vectors by ``order``, equal places by the vector.
    In each round every part goes to its nearest entry, and an entry becomes the floor of the mean of its
    parts; entries without parts stay. Only codebooks and their sums reach the driver.
    """
    first = np.array([r.x for r in rows.orderBy(*order, "x").select("x").limit(entries).collect()], np.int64)
    if not len(first):
        return []
    width = first.shape[1] // parts
    codebooks = [first[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    each = F.array(*[F.struct(F.lit(p).alias("position"), F.slice("x", p * width + 1, width).alias("part")) for p in range(parts)])
    distinct = rows.select(F.inline(each)).groupBy("position", "part").agg(F.count("*").alias("n"))
    distinct = written_table(distinct.orderBy("position", "part"), "distinct-parts")
    totals = [F.sum("n").alias("n"), *[F.sum(F.get("sums", i)).alias(f"s{i}") for i in range(width)]]
    for _ in range(rounds):
        sums = distinct.mapInArrow(_sums(codebooks), "position int, entry int, n long, sums array<long>")
        for r in sums.groupBy("position", "entry").agg(*totals).collect():
            codebooks[r.position][r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return codebooks


def encode(rows: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(row, code, error): the nearest entry of each part and the squared distances summed over parts."""
    if not codebooks:
        return rows.select("row", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))
    width = codebooks[0].shape[1]

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
            code, error = np.empty((len(x), len(codebooks)), np.int32), np.zeros(len(x), np.int64)
            for p, entries in enumerate(codebooks):
                part, back = np.unique(x[:, p * width : (p + 1) * width], axis=0, return_inverse=True)
                entry, distance = nearest(part, entries)
                code[:, p] = entry[back.ravel()]
                error += distance[back.ravel()]
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(codebooks))
            codes = pa.ListArray.from_arrays(ends, pa.array(code.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), codes, pa.array(error)], ["row", "code", "error"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, code array<int>, error long")


def vector_codes(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    keep: list[str] | None = None,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, list[np.ndarray]]:
    """((row, code, error) per kept vector, the final codebooks); ``row`` holds the id and the ``keep`` columns.

    Components become ``floor(scale * x)``. Vectors that are null, empty or hold null or non-finite
    components are dropped, as are those of another size than the first kept one or of a size that
    ``parts`` does not divide. Codebooks start from the smallest ids, nulls last, repeated ids
    by their vectors; with fewer vectors they have fewer entries, and repeated vectors are repeated
    entries, of which the first is used. Repeated rows are coded each. An empty table gives no rows and
    no codebooks. Components too large for exact squared distances are held at the largest that is not.
    """
    order = [F.asc_nulls_last(id_column)]
    rows = whole_rows(df, vector_column, list(dict.fromkeys([id_column, *(keep or [])])), order, parts, scale)
    codebooks = fit(rows, [F.asc_nulls_last(F.col("row").getField(id_column))], parts, entries, rounds)
    return encode(rows, codebooks), codebooks
