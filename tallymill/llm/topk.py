"""Exact top-k inner products, pruned by multi-resolution segment statistics.

The squared distance of two vectors is at least that of their segment means and deviations, so
an inner product is at most ``sum(n * mean * mean' + n * dev * dev')`` over segments of n components.
Bounds are taken from one segment to many; what no bound rules out is scored exactly.
"""

from __future__ import annotations

from itertools import product
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tallymill.session import written_table

#: Rows of a block of vectors and of a block of queries: every vector is sent once per block of queries, every query
#: once per block of vectors. Within a task so many queries and vectors are bounded at once.
ROWS = 32768
QUERIES = 32768
ASKED = 1024
STEP = 512
LEVELS = (1, 4, 16)
SCALE = 1024
#: Sums of products are exact in doubles below the first, and in 64-bit integers below the second.
DOUBLES, LONGS = 2.0**52, 2.0**62
#: Norms that classes of vectors end at: products within the first are exact in doubles, within the second in longs.
CLASSES = (2.0**26, 2.0**31)


def whole_numbers(column: str = "embedding", scale: int = SCALE):
    """floor(scale * x) of the components, as whole numbers in doubles; null if the vector takes no part.

    Null and empty vectors take none, nor do those with null or non-finite components. Beyond 2^53 doubles
    are whole anyway, so nothing is rounded; what is no double after scaling (over 1.7e305) is an error.
    """
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def whole(x):
        scaled = x.cast("double") * scale
        small = F.when(F.abs(scaled) < 2.0**53, scaled)
        large = F.when(F.abs(scaled) < float("inf"), scaled).otherwise(F.raise_error(F.lit("a scaled component is no double")).cast("double"))
        return F.when(small.isNotNull(), F.floor(small).cast("double")).otherwise(large)

    return F.when(F.col(column).isNotNull() & (F.size(column) > 0) & ~bad, F.transform(column, whole))


def _statistics(x: np.ndarray) -> list[np.ndarray]:
    """Per level, segment means and deviations scaled so that their inner product bounds that of the vectors."""
    found = []
    for parts in LEVELS:
        segments = np.array_split(x, min(parts, x.shape[1]), axis=1)
        means = [s.mean(axis=1) * np.sqrt(s.shape[1]) for s in segments]
        devs = [s.std(axis=1) * np.sqrt(s.shape[1]) for s in segments]
        found.append(np.stack(means + devs, axis=1))
    return found


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], int)
    return np.lexsort((ids, -scores))[:k]


def _open(bound: np.ndarray, floor: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether a bound, rounding allowed for, does not rule out a score of ``floor``; ``size`` is the product of the norms."""
    return ~(bound < floor - 1 - 1e-9 * size)


def _products(a: np.ndarray, b: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products of a[rows] and b[columns]: all at once where many are wanted, else one by one."""
    if a.dtype == object:
        return np.array([sum(map(mul, a[i], b[j])) for i, j in zip(rows, columns)], object)
    if len(rows) * 16 > len(a) * len(b) and a.dtype == float:
        return (a @ b.T)[rows, columns]
    parts = [slice(at, at + STEP * STEP) for at in range(0, len(rows), STEP * STEP)]
    return np.concatenate([np.empty(0, a.dtype), *(np.einsum("ij,ij->i", a[rows[p]], b[columns[p]]) for p in parts)])


def _exact(x: np.ndarray, most: float) -> np.ndarray:
    """Whole numbers in a type in which sums of products up to ``most`` are exact."""
    if most < DOUBLES:
        return x
    if most < LONGS:
        return x.astype(np.int64)
    whole = np.empty(x.shape, object)
    whole.ravel()[:] = [int(v) for v in x.ravel()]
    return whole


def _search(q_ids, q, x_ids, x, k: int):
    """(query, vector, score) of the k best of x for each row of q, ``ASKED`` queries at a time."""
    with np.errstate(over="ignore", invalid="ignore"):
        x_stats, x_norms = _statistics(x), _norms(x)
    for at in range(0, len(q), ASKED):
        yield _search_some(q_ids[at : at + ASKED], q[at : at + ASKED], x_ids, x, x_stats, x_norms, k)


def _search_some(q_ids, q, x_ids, x, x_stats, x_norms, k: int):
    """The same for some queries; scores are exact integers in doubles, longs or objects.

    The sum of the absolute products of two vectors is at most the product of their norms, which picks the type.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        q_stats, q_norms = _statistics(q), _norms(q)
        q, x = (_exact(m, q_norms.max() * x_norms.max()) for m in (q, x))
        top_ids = [np.empty(0, np.int64)] * len(q)
        top = [np.empty(0, q.dtype)] * len(q)
        floor = np.full(len(q), -np.inf)
        for at in range(0, len(x), STEP):
            part = slice(at, at + STEP)
            bound = q_stats[0] @ x_stats[0][part].T
            rows, columns = np.nonzero(_open(bound, floor[:, None], np.outer(q_norms, x_norms[part])))
            for a, b in zip(q_stats[1:], x_stats[1:]):
                keep = _open(_products(a, b[part], rows, columns), floor[rows], q_norms[rows] * x_norms[part][columns])
                rows, columns = rows[keep], columns[keep]
            scores = _products(q, x[part], rows, columns)
            keep = (scores >= floor[rows]).astype(bool) & (x_ids[part][columns] != q_ids[rows])
            rows, columns, scores = rows[keep], columns[keep], scores[keep]
            for i, low, high in zip(*_runs(rows)):
                ids = np.r_[top_ids[i], x_ids[part][columns[low:high]]]
                found = np.r_[top[i], scores[low:high]]
                best = _best(ids, found, k)
                top_ids[i], top[i] = ids[best], found[best]
                if len(best) == k:
                    floor[i] = _below(found[best[-1]])
    sizes = [len(t) for t in top]
    return np.repeat(q_ids, sizes), np.concatenate([np.empty(0, np.int64), *top_ids]), np.concatenate([np.empty(0, q.dtype), *top])


def _below(score) -> float:
    """A double that is not above a whole number."""
    try:
        return np.nextafter(float(score), -np.inf) if abs(score) >= DOUBLES else float(score)
    except OverflowError:  # beyond all doubles
        return np.finfo(float).max if score > 0 else -np.inf


def _by_size(x: np.ndarray) -> list[np.ndarray]:
    """Row numbers by class of norm, so that a few large vectors leave the others to fast arithmetic."""
    with np.errstate(over="ignore"):
        size = np.searchsorted(CLASSES, _norms(x), side="right")
    return [rows for rows in (np.flatnonzero(size == c) for c in range(len(CLASSES) + 1)) if len(rows)]


def _as_longs(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores as longs, and 1 or -1 for those that are above or below all longs."""
    if scores.dtype != object:
        return scores.astype(np.int64), np.zeros(len(scores), np.int32)
    beyond = np.array([(s > 2**63 - 1) - (s < -(2**63)) for s in scores], np.int32)
    return np.array([0 if b else s for s, b in zip(scores, beyond)], np.int64), beyond


def _runs(rows: np.ndarray):
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, int)
    return rows[starts], starts, np.r_[starts[1:], len(rows)]


def top_k(vectors: DataFrame, is_query, k: int = 10, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products of each query.

    ``is_query`` is a condition on the rows of ``vectors``. A query's candidates are all rows with
    another id and as many components; ties go to the smaller id, and a query with fewer
    candidates gets them all. Rows with a null id or a vector that ``whole_numbers`` leaves out
    take no part. Scores are exact; one of the result that is no bigint is an error. Repeated ids are searched once per distinct row. Blocks of queries meet blocks
    of vectors, each pair in a group of bounded size.
    """
    rows = vectors.select(F.col(id_column).alias("id"), whole_numbers(column, scale).alias("x"), F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = rows.where("id is not null and x is not null").withColumn("dim", F.size("x"))
    rows = written_table(rows, "vectors")
    n, queries = rows.agg(F.count("*"), F.count_if("query")).first()
    slots, parts = -(-n // ROWS) or 1, -(-queries // QUERIES) or 1
    spread = F.xxhash64("id", "x")
    data = rows.withColumn("slot", F.pmod(spread, F.lit(slots))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = rows.where("query").distinct().withColumn("part", F.pmod(spread, F.lit(parts)).cast("int"))
    asked = asked.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))

    def meet(q: pa.Table, x: pa.Table) -> pa.Table:
        found = ([], [], [], [])
        for dim in set(q["dim"].to_pylist()):
            a, b = (t.filter(pc.equal(t["dim"], dim)) for t in (q, x))
            matrix = lambda t: t["x"].combine_chunks().flatten().to_numpy().reshape(-1, dim).astype(float)
            if len(a) and len(b):
                q_ids, q_all, x_ids, x_all = a["id"].to_numpy(), matrix(a), b["id"].to_numpy(), matrix(b)
                for i, j in product(_by_size(q_all), _by_size(x_all)):
                    for query_ids, vec_ids, scores in _search(q_ids[i], q_all[i], x_ids[j], x_all[j], k):
                        for out, part in zip(found, (query_ids, vec_ids, *_as_longs(scores))):
                            out.append(part)
        joined = [np.concatenate([np.empty(0, t), *part]).astype(t) for t, part in zip((np.int64, np.int64, np.int64, np.int32), found)]
        return pa.table(dict(zip(("query_id", "vec_id", "score", "beyond"), joined)))

    left, right = (t.select("id", "x", "dim", "part", "slot").groupBy("part", "slot") for t in (asked, data))
    best = left.cogroup(right).applyInArrow(meet, "query_id long, vec_id long, score long, beyond int")
    order = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    fits = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score of the result is no bigint")).cast("long"))
    return best.select("query_id", "rank", "vec_id", fits.alias("score"))
