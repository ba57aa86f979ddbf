"""Shingle sets and MinHash signatures of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tallymill.functions.hashing import coefficients, shingle_batches, shingle_hashes, signature_batches
from tallymill.functions.text import SENTENCE_MARKS, lowered_bytes, with_plain_words
from tallymill.session import written_table

# Most shingles of a document hashed by all functions in one piece.
PIECE = 16384


def shingle_sets(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, method: str = "crc32") -> DataFrame:
    """(doc_id, shingles): the distinct hashed word shingles of each document, without a shuffle."""
    return _hashed(df, doc_id, text, size, method).select(doc_id, F.array_distinct("shingles").alias("shingles"))


def doc_shingles(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, method: str = "crc32") -> DataFrame:
    """(doc_id, shingle) of :func:`shingle_sets`, one row per element."""
    sets = shingle_sets(df, doc_id, text, size, method)
    return sets.select(doc_id, F.explode_outer("shingles").alias("shingle")).where(F.col("shingle").isNotNull())


def shingle_doc_matrix(shingles: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(shingle, doc_id, present): the non-zero cells of the shingle x document matrix."""
    return shingles.select("shingle", doc_id, F.lit(1).alias("present"))


def shingle_doc_columns(matrix: DataFrame, doc_ids: list, doc_id: str = "doc_id") -> DataFrame:
    """The rows of the matrix as wide 0/1 columns, for an explicit list of documents."""
    names = [str(d) for d in doc_ids]
    wide = matrix.where(F.col(doc_id).isin(doc_ids)).groupBy("shingle").pivot(doc_id, doc_ids).agg(F.max("present"))
    return wide.fillna(0, subset=names)


def minhash_arrays(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    num_hashes: int = 256,
    seed: int = 1,
    size: int = 3,
    method: str = "crc32",
) -> DataFrame:
    """(doc_id, signature): the least hash value of a document under each of the functions.

    Nothing is shuffled, because a signature needs its own document only. Texts are lower-cased by
    Spark and go as Arrow batches to a task that hashes the shingles, in pieces of limited size, and runs
    a numpy loop over the functions. Shingles hashed by Spark's array functions give the same values, but
    took most of the time of a signature, and their Arrow batches were larger than the texts. As Spark
    expressions the same minima take one aggregation row per shingle and block of functions, and the
    shuffle of all signatures.
    """
    hashed = shingle_batches(size, method, PIECE, SENTENCE_MARKS)
    signed = signature_batches(coefficients(num_hashes, seed))
    schema = T.StructType([df.schema[doc_id], T.StructField("signature", T.ArrayType(T.LongType()))])
    return df.select(doc_id, lowered_bytes(F.col(text)).alias("text")).mapInArrow(lambda batches: signed(hashed(batches)), schema)


def minhash_signatures(df: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """(doc_id, hash_idx, minhash): :func:`minhash_arrays` with one row per function."""
    return minhash_arrays(df, doc_id, **options).select(doc_id, F.posexplode("signature").alias("hash_idx", "minhash"))


def signature_pieces(signatures: DataFrame, doc_id: str = "doc_id", block: int = 4096, ordered: bool = False) -> DataFrame:
    """(row, first, values): the matrix of functions x documents, in pieces of rows.

    ``signatures`` are those of :func:`minhash_arrays`. Documents go by id over all tasks, and each block of
    them is turned from columns into rows within its task: row i holds the values of function i, row -1 the ids.
    ``first`` is the place of the piece's first document among all, from the number of documents in the
    blocks before. Only pieces leave a task, and only their sizes are counted through. Ids have to be numbers.

    Ordering looks at its input twice, first for the ranges of ids. Where the documents were put in order of ids
    before they were signed, ``ordered`` leaves it out, so that every signature is made once.
    """
    rows = signatures.select(doc_id, "signature").where(F.col(doc_id).isNotNull())
    rows = rows if ordered else written_table(rows, "signatures").orderBy(doc_id)
    blocks = written_table(_blocks_of_rows(rows, block), "signature-pieces")
    sizes = blocks.where("row = -1").select("block", F.size("values").cast("long").alias("n"))
    before = F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    places = sizes.select("block", F.coalesce(before, F.lit(0)).alias("first"))
    # One row for each block of thousands of documents, so the pieces need not move to meet it.
    return blocks.join(F.broadcast(places), "block").select("row", "first", "values")


def _blocks_of_rows(ordered: DataFrame, block: int) -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number, ids, values = TaskContext.get().partitionId() << 32, [], []

        def turned():
            matrix = np.concatenate([np.concatenate(ids)[None, :], np.concatenate(values).T])
            ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
            rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(matrix).ravel()))
            return pa.record_batch(
                {"block": np.full(len(matrix), number), "row": np.arange(-1, len(matrix) - 1, dtype=np.int32), "values": rows}
            )

        held = 0
        for batch in batches:
            for at in range(0, len(batch), block):
                part = batch.slice(at, block)
                ids.append(part.column(0).to_numpy().astype(np.int64))
                values.append(part.column(1).flatten().to_numpy().reshape(len(part), -1))
                held += len(part)
                if held >= block:
                    yield turned()
                    number, ids, values, held = number + 1, [], [], 0
        if held:
            yield turned()

    return ordered.mapInArrow(run, "block long, row int, values array<long>")


def matrix_cells(pieces: DataFrame) -> DataFrame:
    """(hash_idx, position, doc_id, minhash) of a signature matrix in pieces: ids and values of a place side by side."""
    ids = pieces.where("row = -1").select("first", F.col("values").alias("ids"))
    both = pieces.where("row >= 0").join(ids, "first")
    cells = both.select(F.col("row").alias("hash_idx"), "first", "ids", F.posexplode("values").alias("at", "minhash"))
    return cells.select("hash_idx", (F.col("first") + F.col("at")).alias("position"), F.get("ids", "at").alias("doc_id"), "minhash")


def _hashed(df: DataFrame, doc_id: str, text: str, size: int, method: str) -> DataFrame:
    words = with_plain_words(df, text, [doc_id])
    return words.select(doc_id, shingle_hashes(F.col("words"), size, method).alias("shingles"))
