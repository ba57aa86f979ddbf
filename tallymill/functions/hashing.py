"""Shingles, 32-bit hashes and the universal hash family behind MinHash."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The first prime above 2^32 - 1, and the largest 32-bit value.
PRIME = 4294967311
MAX_HASH = 4294967295
# Pieces of documents whose minima a Python worker holds at once.
ROWS = 512


def hash32(text: Column, method: str = "crc32") -> Column:
    """Unsigned 32-bit hash of the UTF-8 text as bigint."""
    if method == "crc32":
        return F.crc32(text)
    if method == "md5":
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method: {method}")


def shingle_hashes(words: Column, size: int = 3, method: str = "crc32") -> Column:
    """Hashes of all runs of ``size`` consecutive words joined by a blank, duplicates included.

    Shifted copies of the array are zipped, so the lambda does not refer back to ``words``:
    such a reference would tokenise the text again for every position.
    """
    starts = F.greatest(F.size(words) - (size - 1), F.lit(0))
    shifted = [F.slice(words, shift + 1, starts).alias(f"w{shift}") for shift in range(size)]
    return F.transform(
        F.arrays_zip(*shifted), lambda run: hash32(F.concat_ws(" ", *[run[f"w{i}"] for i in range(size)]), method)
    )


def coefficients(count: int, seed: int) -> list[tuple[int, int]]:
    """``count`` reproducible pairs (a, b), each drawn from [0, MAX_HASH)."""
    draw = random.Random(seed)
    return [(draw.randrange(MAX_HASH), draw.randrange(MAX_HASH)) for _ in range(count)]


def coefficient_table(spark: SparkSession, count: int, seed: int) -> DataFrame:
    """The pairs of :func:`coefficients` as rows, so that signatures can be reproduced elsewhere."""
    rows = [(index, a, b) for index, (a, b) in enumerate(coefficients(count, seed))]
    return spark.createDataFrame(rows, "hash_idx int, a bigint, b bigint")


def shingle_batches(size: int, method: str, piece: int, marks: str):
    """A ``mapInArrow`` function from (id, lower-cased text) to (id, piece number, shingle hashes).

    The words are those of ``text.with_plain_words`` and the hashes those of :func:`shingle_hashes`: words between runs
    of ASCII whitespace, their ``marks`` deleted afterwards. The hashes of a document come in pieces of at most ``piece``,
    and a batch goes on as soon as it holds some 100,000 of them.
    """
    if method not in ("crc32", "md5"):
        raise ValueError(f"unknown hash method: {method}")

    def run(batches):
        import hashlib
        import zlib

        import numpy as np
        import pyarrow as pa

        values_at_once, deleted = 1 << 17, marks.encode()
        hashed = zlib.crc32 if method == "crc32" else lambda run: int.from_bytes(hashlib.md5(run).digest()[:4], "big")

        def shingles(text):
            words = text.split() if text else []
            words = b" ".join(words).translate(None, deleted).split(b" ") if words else words
            return [hashed(b" ".join(run)) for run in zip(*[words[i:] for i in range(size)])]

        for batch in batches:
            rows, numbers, ends, values = [], [], [0], []

            def pieces():
                lists = pa.ListArray.from_arrays(np.array(ends, np.int32), np.array(values, np.int64))
                ids = batch.column(0).take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays([ids, pa.array(numbers, pa.int32()), lists], [batch.schema.names[0], "piece", "shingles"])

            for row, text in enumerate(batch.column(1)):
                found = shingles(text.as_py())
                for number, at in enumerate(range(0, max(len(found), 1), piece)):
                    rows.append(row)
                    numbers.append(number)
                    values += found[at : at + piece]
                    ends.append(len(values))
                    if len(values) >= values_at_once:
                        yield pieces()
                        rows, numbers, ends, values = [], [], [0], []
            if rows:
                yield pieces()

    return run


def signature_batches(pairs: list[tuple[int, int]], prime: int = PRIME, rows_at_once: int = ROWS):
    """A ``mapInArrow`` function from (id, piece number, shingle hashes) to (id, signature).

    The pieces of a document follow each other, numbered from 0; their minima are merged
    across batches, so a batch never has to hold a whole document. With 32-bit inputs
    a * x + b stays below 2^64, exact in unsigned arithmetic. A document without
    shingles gets 0 everywhere. A batch is worked off in slices of ``rows_at_once`` pieces and its hashes are
    read where they lie, so beside the batch itself a worker holds the minima of one slice.

    All helpers are nested, so that the function travels to the workers by value and they need
    nothing but numpy and pyarrow.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        none = np.uint64(2**64 - 1)
        values_at_once = 16384
        modulus = np.uint64(prime)
        functions = [(np.uint64(a), np.uint64(b)) for a, b in pairs]
        buffers = np.empty((2, values_at_once), np.uint64)

        def remainders(hashes, a, b):
            """(a * hashes + b) % prime, by a division that numpy vectorises."""
            room = buffers if len(hashes) <= values_at_once else np.empty((2, len(hashes)), np.uint64)
            value, quotient = room[:, : len(hashes)]
            np.multiply(hashes, a, out=value)
            np.add(value, b, out=value)
            np.floor_divide(value, modulus, out=quotient)
            np.multiply(quotient, modulus, out=quotient)
            return np.subtract(value, quotient, out=value)

        def piece_minima(lists):
            offsets = lists.offsets.to_numpy()
            hashes = lists.values.to_numpy().view(np.uint64)
            minima = np.full((len(lists), len(functions)), none, dtype=np.uint64)
            filled = np.flatnonzero(np.diff(offsets))
            starts = offsets[filled]
            begin = 0
            while begin < len(filled):
                end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + values_at_once)) - 1)
                low, high = starts[begin], offsets[filled[end - 1] + 1]
                for index, (a, b) in enumerate(functions):
                    minima[filled[begin:end], index] = np.minimum.reduceat(remainders(hashes[low:high], a, b), starts[begin:end] - low)
                begin = end
            return minima

        def finished(ids, minima):
            signatures = np.where(minima == none, 0, minima).astype(np.int64)
            width = len(functions)
            offsets = np.arange(0, len(ids) * width + 1, width, dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(offsets, signatures.ravel())], [id_name, "signature"]
            )

        last_id, last = None, None
        for batch in (whole.slice(at, rows_at_once) for whole in batches for at in range(0, len(whole), rows_at_once)):
            id_name = batch.schema.names[0]
            minima = piece_minima(batch.column(2))
            heads = np.flatnonzero(batch.column(1).to_numpy() == 0)
            continued = heads[0] if len(heads) else len(minima)
            if continued:
                last = np.minimum(last, minima[:continued].min(axis=0))
            if len(heads):
                if last is not None:
                    yield finished(last_id, last[None, :])
                merged = np.minimum.reduceat(minima, heads, axis=0)
                ids = batch.column(0).take(pa.array(heads))
                if len(heads) > 1:
                    yield finished(ids[:-1], merged[:-1])
                last_id, last = ids[-1:], merged[-1]
        if last is not None:
            yield finished(last_id, last[None, :])

    return run
