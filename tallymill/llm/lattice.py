"""Near-duplicate vectors by E8 lattice hashing.

A table projects a vector to a few random 8-dimensional spaces and takes the nearest point of
the E8 lattice in each; the points name a cell. A vector lies in its own cell and asks there
and in neighbouring ones. Vectors that meet are compared by cosine. Equal vectors are one
node; cells and components with very many vectors are cut into blocks, and pairs of blocks
are separate groups.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallymill.llm.components import components, local_roots
from tallymill.session import written_table

THRESHOLD = 0.95
#: Tables, 8-dimensional spaces per table, neighbouring cells asked per space, and the scale of a unit vector.
TABLES = 4
SPACES = 2
PROBES = 3
SCALE = 1.5
SEED = 7
#: Vectors of a block of a cell or component, and pairs compared at once.
BLOCK = 2048
PAIRS = 60_000


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    off = y[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest points of E8: integers with an even sum, or those moved by a half in every component."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    closer = ((y - half) ** 2).sum(axis=1) < ((y - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def shortest_e8() -> np.ndarray:
    """The 240 shortest vectors of E8, by their definition."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-1, 1), repeat=2):
            found.append([a if k == i else b if k == j else 0 for k in range(8)])
    found += [[s / 2 for s in signs] for signs in product((-1, 1), repeat=8) if sum(signs) % 4 == 0]
    return np.array(found, float)


class Cells:
    """Cells of unit vectors of one dimension, the same in every task."""

    def __init__(self, dim: int):
        rng = np.random.default_rng([SEED, dim])
        wide = max(dim, 8)
        self.spaces = [
            np.linalg.qr(rng.standard_normal((wide, 8)))[0][:dim] * np.sqrt(wide / 8) * SCALE for _ in range(TABLES * SPACES)
        ]
        self.short = shortest_e8()
        self.mix = rng.integers(1, 1 << 62, (TABLES, SPACES * 8 + 1), dtype=np.int64) | 1

    def _name(self, table: int, points: np.ndarray) -> np.ndarray:
        """A hash of doubled lattice points; equal cells have equal names."""
        doubled = np.rint(2 * points).astype(np.int64)
        with np.errstate(over="ignore"):
            h = np.full(len(doubled), self.mix[table, -1])
            for c in range(doubled.shape[1]):
                h = (h ^ (doubled[:, c] * self.mix[table, c])) * np.int64(-7046029254386353131)
                h ^= h >> np.int64(29)
        return h

    def of(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own cells, cells asked): a column per table, and per table and neighbour; own cells are asked first."""
        own, asked = [], []
        for table in range(TABLES):
            at = [unit @ self.spaces[table * SPACES + s] for s in range(SPACES)]
            points = [nearest_e8(y) for y in at]
            own.append(self._name(table, np.hstack(points)))
            asked.append(own[-1])
            for s in range(SPACES):
                toward = (at[s] - points[s]) @ self.short.T
                for p in np.argsort(-toward, axis=1, kind="stable")[:, :PROBES].T:
                    moved = points.copy()
                    moved[s] = points[s] + self.short[p]
                    asked.append(self._name(table, np.hstack(moved)))
        return np.stack(own, axis=1), np.stack(asked, axis=1)


def _units(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    matrix = flat.reshape(len(vectors), -1)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True, initial=0)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def usable(column: str = "embedding") -> Column:
    """Whether a vector takes part: not null, not zero, every component there and finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def _spread(with_x: bool):
    """Rows (cell, asks, node, x) of the vectors; without x only the cells."""

    def rows(batches):
        tables: dict[int, Cells] = {}
        for batch in batches:
            nodes, vectors = batch.column("node").to_numpy(), batch.column("x")
            dims = vectors.value_lengths().to_numpy()
            for dim in np.unique(dims):
                chosen = np.flatnonzero(dims == dim)
                part = vectors.take(pa.array(chosen))
                cells = tables.setdefault(int(dim), Cells(int(dim)))
                for asks, names in zip((False, True), cells.of(_units(part))):
                    for column in names.T:
                        yield pa.record_batch(
                            {"cell": column, "asks": pa.array(np.full(len(part), asks)), "node": nodes[chosen]}
                            | ({"x": part} if with_x else {})
                        )

    return rows


def _blocked(rows: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """Rows sorted by (key, i, j): askers of block i meet the others of block j.

    ``sizes`` has (key, blocks) of the keys that need more than one block.
    """
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.join(sizes, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.when(F.col("asks"), F.col("mine")).otherwise(F.col("other")))
    rows = rows.withColumn("j", F.when(F.col("asks"), F.col("other")).otherwise(F.col("mine")))
    rows = rows.drop("blocks", "mine", "other").repartition(key, "i", "j")
    return rows.sortWithinPartitions(key, "i", "j", F.size("x"), "asks")


def _groups(batches, key: str):
    """Record batches that hold whole groups, from batches in the order of the groups."""
    names = (key, "i", "j")
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        last = tuple(batch.column(c)[-1].as_py() for c in names)
        same = np.ones(len(batch), bool)
        for c, v in zip(names, last):
            same &= batch.column(c).to_numpy() == v
        cut = len(batch) - int(np.argmin(same[::-1])) if not same.all() else 0
        if held and (cut or tuple(held[-1].column(c)[-1].as_py() for c in names) != last):
            whole = pa.Table.from_batches([*held, batch.slice(0, cut)])
            yield whole
            held = [batch.slice(cut)]
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _met(table: pa.Table, key: str):
    """(asker, other) row numbers of a table of whole groups whose vectors link, a part at a time."""
    vectors = table["x"].combine_chunks()
    dims = vectors.value_lengths().to_numpy()
    names = np.stack([table[c].to_numpy() for c in (key, "i", "j")] + [dims])
    asks, nodes = table["asks"].to_numpy(zero_copy_only=False), table["node"].to_numpy()
    starts = np.flatnonzero(np.r_[True, (names[:, 1:] != names[:, :-1]).any(axis=0)])
    ends = np.r_[starts[1:], len(table)]
    askers = np.add.reduceat(asks.astype(np.int64), starts)
    middle = ends - askers
    others = middle - starts
    unit: dict[int, np.ndarray] = {}
    place = np.zeros(len(table), np.int64)
    for dim in np.unique(dims):
        chosen = np.flatnonzero(dims == dim)
        unit[dim], place[chosen] = _units(vectors.take(pa.array(chosen))), np.arange(len(chosen))
    pairs = askers * others
    small = np.flatnonzero((pairs > 0) & (pairs <= PAIRS))
    part = np.cumsum(pairs[small]) // PAIRS
    for number in np.unique(part):
        for dim in unit:
            runs = small[(part == number) & (dims[starts[small]] == dim)]
            if len(runs):
                n = pairs[runs]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                width = np.repeat(others[runs], n)
                a = np.repeat(middle[runs], n) + within // width
                b = np.repeat(starts[runs], n) + within % width
                close = np.einsum("ij,ij->i", unit[dim][place[a]], unit[dim][place[b]]) >= THRESHOLD
                close &= nodes[a] != nodes[b]
                yield a[close], b[close]
    for r in np.flatnonzero(pairs > PAIRS):
        x = unit[dims[starts[r]]]
        b = np.arange(starts[r], middle[r])
        for at in range(middle[r], ends[r], 256):
            a = np.arange(at, min(at + 256, ends[r]))
            i, j = np.nonzero((x[place[a]] @ x[place[b]].T >= THRESHOLD) & (nodes[a][:, None] != nodes[b]))
            yield a[i], b[j]


def _forest(batches):
    for table in _groups(batches, "cell"):
        nodes, where = np.unique(table["node"].to_numpy(), return_inverse=True)
        root = np.arange(len(nodes))
        for a, b in _met(table, "cell"):
            root = local_roots(len(nodes), np.r_[where[a], np.arange(len(nodes))], np.r_[where[b], root])
        child = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.record_batch({"a": nodes[root[child]], "b": nodes[child]})


def _counts(batches):
    for table in _groups(batches, "root"):
        nodes, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        links = np.zeros(len(nodes), np.int64)
        for a, b in _met(table, "root"):
            np.add.at(links, a, copies[b])
        asks = np.flatnonzero(table["asks"].to_numpy(zero_copy_only=False))
        yield pa.record_batch({"node": nodes[asks], "links": links[asks]})


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors with a cosine of ``THRESHOLD`` or more link. Links are found where vectors meet in a
    cell; then all links inside a component are counted, so ``n_links`` misses no link of
    vectors that some chain of found links joins. Equal vectors are one node with a number of
    copies. A vector that takes no part (see ``usable``) has no links and is its own component,
    as is one without a partner. Different vectors with one id stay different rows: each has the links
    and the component of its own vector. Rows with a null id link with nothing and have
    a null component and are not kept. Vectors of other lengths do not link. Repeated rows
    count as copies. An empty table gives no rows. Other columns are not looked at.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(column).alias("x"))
    fit = usable("x") & F.col("id").isNotNull()
    rows = written_table(rows.select("id", F.when(fit, F.col("x")).alias("x")), "vectors")
    nodes = rows.where("x is not null").groupBy("x").agg(F.min("id").cast("long").alias("first"), F.count("*").alias("copies"))
    nodes = written_table(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    cells = nodes.select("node", "x").mapInArrow(_spread(False), "cell long, asks boolean, node long")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
    sizes = written_table(sizes.where(F.col("n") > BLOCK).select("cell", F.ceil(F.col("n") / BLOCK).alias("blocks")), "hot-cells")
    kind = nodes.schema["x"].dataType.simpleString()
    met = nodes.select("node", "x").mapInArrow(_spread(True), f"cell long, asks boolean, node long, x {kind}")
    links = _blocked(met, "cell", sizes).mapInArrow(_forest, "a long, b long")
    roots = components(links, "vectors")
    linked = nodes.drop("first").join(roots, "node")
    sizes = roots.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    sizes = sizes.select("root", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    both = linked.withColumn("asks", F.explode(F.array(F.lit(False), F.lit(True))))
    counts = _blocked(both, "root", sizes).mapInArrow(_counts, "node long, links long")
    counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
    least = nodes.select("node", "first").join(roots, "node").groupBy("root").agg(F.min("first").alias("least"))
    named = roots.join(least, "root").select("node", "least")
    found = nodes.join(named, "node", "left").join(counts, "node", "left")
    found = found.select("x", F.coalesce("least", "first").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = F.coalesce("component_id", F.col("id").cast("long"))
    result = rows.join(found, "x", "left").select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"))
    return result.select(F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
