"""Near-duplicate documents by SimHash, matched with meet-in-the-middle ball hashing.

Two 64-bit fingerprints at distance 3 or less meet at a variant within distance 1 of one and 2
of the other. Neighbours at distance 3 differ in parity, so fingerprints with an odd number of
set bits emit all variants within distance 2 and those with an even number all within 1; pairs
at distance 2 meet half-way, at distance 1 from both. Variants are shuffled by their leading
bits: a fingerprint is sent once to each bucket in which it has variants, and the variants of
a bucket are spelled out and sorted inside the task. A bucket with too many fingerprints, such as
one with a large cluster of near copies, is cut along further bits before it is gathered.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallymill.llm.components import components, local_roots
from tallymill.session import written_table

BITS = 64
RADIUS = 3
SEED = 42
#: Fingerprints whose own leading bits name a bucket, on average; sets the number of bits.
HOME = 4096
LEAST_BITS = 8
#: Variants a task holds at once; a bucket with more is cut along further bits.
VARIANTS = 8_000_000
#: Fingerprints that one task gathers as a bucket; a bucket with more is cut by ``DEEPER`` more of the leading bits, again
#: and again up to ``MOST_BITS``, where at most 2^8 values and their neighbours are left in it.
GATHERED = 1 << 18
DEEPER = 8
MOST_BITS = 56
_PIECE = 1 << 16


def fingerprint_of(data: bytes | None, width: int) -> int:
    """Fingerprint of one text: a bit is set if over half of the shingle hashes have it; 0 without words."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _PIECE):
        bits = np.unpackbits(hashes[at : at + _PIECE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, width: int = 3) -> Column:
    """64-bit SimHash of a text column as a signed long.

    Lower-cases A-Z, cuts at ASCII white space and hashes runs of ``width`` words (all words of
    a shorter text) with XXH64. Null and empty texts give 0.
    """

    @F.arrow_udf("long")
    def prints(data: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_of(x.as_py(), width) for x in data), np.uint64, len(data))
        return pa.array(found.view(np.int64))

    return prints(text.cast("binary"))


def _parity(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x) & 1


def _masks(low: int, most: int) -> np.ndarray:
    """Masks of up to ``most`` of the ``low`` lowest bits."""
    found = [sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(low), k)]
    return np.array(found, np.uint64)


def _buckets(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into prints, bucket) for every bucket of ``bits`` leading bits that holds variants."""
    home = prints >> np.uint64(BITS - bits)
    reach = 1 + _parity(prints)
    masks = _masks(bits, 2)
    size = np.bitwise_count(masks)
    index, bucket = [], []
    for mask, k in zip(masks, size):
        chosen = np.flatnonzero(reach >= k)
        index.append(chosen)
        bucket.append(home[chosen] ^ mask)
    return np.concatenate(index), np.concatenate(bucket)


def _deeper(prints: np.ndarray, bucket: np.ndarray, bits: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into prints, bucket) for every part, by ``more`` further bits, of each print's bucket that holds variants of it."""
    low = BITS - bits - more
    left = 1 + _parity(prints) - np.bitwise_count((prints >> np.uint64(BITS - bits)) ^ bucket)
    home = (prints >> np.uint64(low)) & np.uint64((1 << more) - 1)
    masks = _masks(more, 2)
    index, parts = [], []
    for mask, k in zip(masks, np.bitwise_count(masks)):
        chosen = np.flatnonzero(left.astype(np.int8) >= k)
        index.append(chosen)
        parts.append((bucket[chosen] << np.uint64(more)) | (home[chosen] ^ mask))
    return np.concatenate(index), np.concatenate(parts)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than n of the links (a, b) that join what all of them join.

    Each round, every component takes its first link to another one, so there are no cycles and about log n rounds.
    """
    chosen, at, u, v = np.empty(0, int), np.arange(len(a)), a, b
    while True:
        apart = u != v
        at, u, v = at[apart], u[apart], v[apart]
        if not len(at):
            return a[chosen], b[chosen]
        first = np.full(n, len(at))
        np.minimum.at(first, u, np.arange(len(at)))
        np.minimum.at(first, v, np.arange(len(at)))
        new = np.unique(first[first < len(at)])
        chosen = np.concatenate([chosen, at[new]])
        root = local_roots(n, u[new], v[new])
        u, v = root[u], root[v]


def _met(prints: np.ndarray, bucket: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as index pairs, of the links of prints that share a variant whose leading ``bits`` bits are ``bucket``.

    All prints that meet at a variant within distance 1 of one of them are linked to that one,
    so each variant gives a star, not all pairs; every link is verified. A bucket with very many variants
    is worked off in halves, of which only the forests are kept.
    """
    used = np.bitwise_count((prints >> np.uint64(BITS - bits)) ^ np.uint64(bucket))
    reach = 1 + _parity(prints)
    low = BITS - bits
    per = {0: 1, 1: 1 + low, 2: 1 + low + low * (low - 1) // 2}
    left = reach.astype(int) - used
    if sum(per[k] * int((left == k).sum()) for k in per) > VARIANTS and low > 2:
        near = np.flatnonzero(left >= 0)
        parts = [_met(prints[near], 2 * bucket + b, bits + 1) for b in (0, 1)]
        return _forest(len(prints), *(near[np.concatenate(x)] for x in zip(*parts)))
    index, variant, away = [], [], []
    home_bits = np.uint64(bucket) << np.uint64(low)
    rest = np.uint64((1 << low) - 1)
    for k in per:
        chosen = np.flatnonzero(left == k)
        if len(chosen):
            masks = _masks(low, k)
            variant.append((home_bits | (prints[chosen] & rest))[:, None] ^ masks)
            away.append(used[chosen][:, None] + np.bitwise_count(masks))
            index.append(np.broadcast_to(chosen[:, None], (len(chosen), len(masks))))
    if not index:
        return np.empty(0, int), np.empty(0, int)
    index, variant, away = (np.concatenate([x.ravel() for x in part]) for part in (index, variant, away))
    order = np.argsort(variant)
    same = variant[order[1:]] == variant[order[:-1]]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    order = order[shared]
    order = order[np.lexsort((index[order], away[order] > 1, variant[order]))]
    if not len(order):
        return np.empty(0, int), np.empty(0, int)
    first = np.r_[True, variant[order[1:]] != variant[order[:-1]]]
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    linked = ~first & (away[head] <= 1)
    pairs = np.unique(index[head[linked]] * len(prints) + index[order[linked]])
    a, b = pairs // len(prints), pairs % len(prints)
    close = np.bitwise_count(prints[a] ^ prints[b]) <= RADIUS
    return _forest(len(prints), a[close], b[close])


def _links_of_bucket(table: pa.Table) -> pa.Table:
    """Stars that join what the verified links of one bucket join; joined over all buckets, they settle in fewer rounds than chains."""
    bucket, bits = table["bucket"][0].as_py(), table["bits"][0].as_py()
    prints = np.unique(table["fp"].to_numpy().view(np.uint64))
    root = local_roots(len(prints), *_met(prints, bucket, bits))
    child = np.flatnonzero(root != np.arange(len(prints)))
    signed = prints.view(np.int64)
    return pa.table({"a": signed[root[child]], "b": signed[child]})


_SENT = "bucket long, bits int, fp long"


def _sent(bucket: np.ndarray, bits: int, prints: np.ndarray) -> pa.RecordBatch:
    columns = {"bucket": bucket.astype(np.int64), "bits": np.full(len(bucket), bits, np.int32), "fp": prints.view(np.int64)}
    return pa.record_batch(columns)


def _in_buckets(distinct: DataFrame, bits: int) -> DataFrame:
    """(bucket, bits, fp): every fingerprint in each bucket that holds variants of it, none with many more than ``GATHERED``.

    Buckets are counted, with partial counts before the shuffle; the rows of those with too many are sent
    on to their parts by further bits. The list of large buckets has at most a row per ``GATHERED`` rows, and its measured
    size decides on the joins.
    """

    def spread(batches):
        for batch in batches:
            own = batch.column("fp").to_numpy().view(np.uint64)
            index, bucket = _buckets(own, bits)
            yield _sent(bucket, bits, own[index])

    def cut(depth: int, more: int):
        def run(batches):
            for batch in batches:
                own, bucket = (batch.column(c).to_numpy().view(np.uint64) for c in ("fp", "bucket"))
                index, parts = _deeper(own, bucket, depth, more)
                yield _sent(parts, depth + more, own[index])

        return run

    done, level, depth = [], distinct.mapInArrow(spread, _SENT), bits
    while depth < MOST_BITS:
        large = level.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > GATHERED).select("bucket")
        large = written_table(large, "large-buckets")
        if large.isEmpty():
            break
        level = written_table(level, "buckets")
        more = min(DEEPER, MOST_BITS - depth)
        done.append(level.join(large, "bucket", "left_anti").select("bucket", "bits", "fp"))
        parts = level.join(large, "bucket", "left_semi").select("bucket", "bits", "fp")
        level, depth = parts.mapInArrow(cut(depth, more), _SENT), depth + more
    for part in done:
        level = level.unionByName(part)
    return level


def linked_prints(prints: DataFrame) -> DataFrame:
    """(node, root) of the fingerprints (column fp) that link with another one at distance 3 or less."""
    distinct = written_table(prints.select("fp").where("fp is not null").distinct(), "fingerprints")
    n = distinct.count()
    bits = max(LEAST_BITS, int(np.ceil(np.log2(max(n, 1) / HOME))))
    links = _in_buckets(distinct, bits).groupBy("bucket", "bits").applyInArrow(_links_of_bucket, "a long, b long")
    return components(links, "simhash")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` and ``component_id``, the smallest id reachable.

    Documents link at 3 or fewer differing fingerprint bits. Rows with equal fingerprints, such
    as exact copies and all texts without words, are one node however many they are; nothing is
    expanded into pairs. A null id takes no part in the minimum and still gets its row. An
    empty table gives no rows. Other columns of ``docs`` are not looked at.
    """
    rows = docs.select(F.col(id_column).alias("id"), fingerprint(F.col(text_column), width).alias("fp"))
    rows = written_table(rows, "simhash-rows")
    roots = linked_prints(rows)
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(groups, "root").select("fp", "component_id")
    return rows.join(by_print, "fp", "left").select(F.col("id").alias(id_column), "fp", "component_id")
