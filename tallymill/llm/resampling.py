"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Both models are counts of hashed words and word pairs, one of good documents and one of all; the target
model is interpolated with the raw one. A document's log weight is the sum over its n-grams of the
log ratio. Adding Gumbel noise and taking the highest k draws k documents without replacement in
proportion to their weights.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallymill.session import written_table

#: Buckets of hashed n-grams, pseudo-counts of a bucket in the raw model, share of the raw model in the target
#: model, and good documents that the target model is fitted on.
BUCKETS = 1 << 16
PRIOR = 1.0
BACKGROUND = 0.8
TARGETS = 20_000
KEEP = 0.75
SEED = 11
CACHE = 500_000
#: Words of a text whose n-grams are hashed at once.
PIECE = 1 << 18


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = zlib.crc32(word)
        if len(word) <= 64:
            self[word] = h
        return h


_hashes = _Hashes()


def _buckets(text: bytes | None):
    """Buckets of the words and word pairs of a text, a piece at a time."""
    words, hashes = (text or b"").lower().split(), _hashes
    for at in range(0, len(words), PIECE):
        one = np.fromiter(map(hashes.__getitem__, words[at : at + PIECE + 1]), np.uint64)
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xBF58476D1CE4E5B9)
        single = one[:PIECE] * np.uint64(0x94D049BB133111EB)
        yield (np.concatenate([single, two]) >> np.uint64(40)).astype(np.int64) % BUCKETS


def _log_weight(text: bytes | None, ratio: np.ndarray) -> tuple[float, int]:
    total, n = 0.0, 0
    for part in _buckets(text):
        total, n = total + float(ratio[part].sum()), n + len(part)
    return total, n


def fit(docs: DataFrame, target_ids: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> np.ndarray:
    """Log ratio of target to raw probability of every bucket.

    The raw model counts all of ``docs``. The target model counts the documents in ``target_ids``
    (column id), or the ``TARGETS`` of them that come first by hash, if they are more. Each task
    adds up its counts before they are shuffled; the model has ``BUCKETS`` numbers at any size. Without
    target documents all ratios are 0.
    """
    ids = target_ids.select("id").where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(TARGETS)
    wanted = docs.sparkSession.sparkContext.broadcast({row.id for row in ids.collect()})

    def count(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in _buckets(text.as_py()):
                    counts = np.bincount(part, minlength=BUCKETS) if len(part) > 4096 else None
                    for into in (raw, target) if doc_id in wanted.value else (raw,):
                        if counts is None:
                            np.add.at(into, part, 1)
                        else:
                            into += counts
        used = np.flatnonzero(raw)
        yield pa.record_batch({"bucket": used, "raw": raw[used], "target": target[used]})

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    counts = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for bucket, r, t in counts.collect():
        raw[bucket], target[bucket] = r, t
    wanted.destroy()
    return log_ratio(raw, target)


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of the interpolated target probability over the raw one, per bucket, from counts."""
    if not target.sum():
        return np.zeros(len(raw))
    common = (raw + PRIOR) / (raw.sum() + PRIOR * len(raw))
    return np.log(BACKGROUND + (1 - BACKGROUND) * target / target.sum() / common)


def weigh(text: Column, ratio: np.ndarray, spark) -> Column:
    """struct(log_weight, n_grams) of a text column; null and empty texts have 0 and 0."""
    model = spark.sparkContext.broadcast(ratio)

    def scores(texts: pa.Array) -> pa.Array:
        found = [_log_weight(t.as_py(), model.value) for t in texts]
        weights, sizes = zip(*found) if found else ((), ())
        return pa.StructArray.from_arrays([pa.array(weights, pa.float64()), pa.array(sizes, pa.int64())], ["log_weight", "n_grams"])

    return F.arrow_udf(scores, "log_weight double, n_grams long")(text.cast("binary"))


def gumbel(doc_id: Column) -> Column:
    """Gumbel noise that depends on the id alone; null ids share one value."""
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(SEED)), 12)
    return -F.log(-F.log((bits + 0.5) / float(1 << 52)))


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, by counting ever finer ranges; never more than 2^16 counts at once."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None or k < 1:
        return None
    while low < high:
        shift = max(0, (high - low).bit_length() - 16)
        inside = rows.where(F.col(column).between(low, high))
        counts = dict(inside.groupBy(F.shiftright(F.col(column) - low, shift).alias("b")).count().collect())
        for b in sorted(counts, reverse=True):
            if k <= counts[b]:
                break
            k -= counts[b]
        low, high = low + (b << shift), min(high, low + ((b + 1) << shift) - 1)
    return low


def resample(
    docs: DataFrame,
    target_ids: DataFrame,
    keep: float = KEEP,
    id_column: str = "doc_id",
    text_column: str = "text",
    temperature: float = 1.0,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``log_weight``, ``n_grams``, ``gumbel_key`` and ``kept``.

    ``log_weight`` is the sum of the log ratios of the document's n-grams, its importance weight. Kept are the share
    ``keep`` of the rows whose key, log weight over ``temperature`` plus noise, is highest; at 1 that is a draw in
    proportion to the weights. Noise depends on the id: ties at the cut, such as repeated rows, stay
    together, and rows with a null id share theirs. Null and empty texts weigh 0. An empty table gives no
    rows; other columns of ``docs`` are not looked at.
    """
    ratio = fit(docs, target_ids, id_column, text_column)
    weight = weigh(F.col(text_column), ratio, docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), weight.alias("w"))
    key = F.col("w.log_weight") / temperature + gumbel(F.col("id"))
    rows = rows.select("id", "w.log_weight", "w.n_grams", key.alias("gumbel_key"))
    rows = written_table(rows.withColumn("place", F.floor(F.col("gumbel_key") * (1 << 20))), "weights")
    cut = kth_largest(rows, "place", round(keep * rows.count()))
    kept = F.lit(False) if cut is None else F.col("place") >= cut
    return rows.select(F.col("id").alias(id_column), "log_weight", "n_grams", "gumbel_key", kept.alias("kept"))
