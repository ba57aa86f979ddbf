import random
import zlib

from tallymill.functions import hashing
from tallymill.operators import shingles


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def brute_shingles(text, size=3):
    words = [w.lower().replace(",", "").replace(".", "") for w in (text or "").split()]
    return {zlib.crc32(" ".join(words[i : i + size]).encode()) for i in range(len(words) - size + 1)}


TEXTS = ["a b c d", "A b, c. a B c", "a b", "", None, "Über  den\tWolken ... muss die Freiheit"]


def test_known_hash(spark, rows):
    assert rows(shingles.doc_shingles(docs(spark, "a b c"))) == [(0, 3358461392)]


def test_shingles_against_brute_force(spark, rows):
    expected = [(i, h) for i, t in enumerate(TEXTS) for h in brute_shingles(t)]
    assert rows(shingles.doc_shingles(docs(spark, *TEXTS))) == sorted(expected, key=repr)
    for size in (1, 2, 5):
        got = rows(shingles.doc_shingles(docs(spark, *TEXTS), size=size))
        assert got == sorted([(i, h) for i, t in enumerate(TEXTS) for h in brute_shingles(t, size)], key=repr)


def test_short_documents_have_empty_sets(spark):
    sets = {r.doc_id: r.shingles for r in shingles.shingle_sets(docs(spark, "a b", "a b c a b c")).collect()}
    assert sets[0] == [] and len(sets[1]) == 3


def test_matrix_holds_ones(spark, rows):
    matrix = shingles.shingle_doc_matrix(shingles.doc_shingles(docs(spark, "a b c", "a b c d")))
    assert {r.present for r in matrix.collect()} == {1}
    wide = shingles.shingle_doc_columns(matrix, [0, 1])
    abc, bcd = zlib.crc32(b"a b c"), zlib.crc32(b"b c d")
    assert rows(wide) == sorted([(abc, 1, 1), (bcd, 0, 1)], key=repr)


def signatures(texts, count, seed):
    pairs = hashing.coefficients(count, seed)
    return [
        (doc, index, min(((a * x + b) % hashing.PRIME for x in brute_shingles(text)), default=0))
        for doc, text in enumerate(texts)
        for index, (a, b) in enumerate(pairs)
    ]


def test_hash_function_is_exact_at_the_limits():
    import pyarrow as pa

    draw = random.Random(5)
    top = 2**32 - 1
    pairs = [(draw.randrange(top), draw.randrange(top)) for _ in range(20)] + [(top, top)]
    values = [draw.randrange(2**32) for _ in range(50)] + [top]
    rows = pa.RecordBatch.from_pydict(
        {"id": list(range(51)), "piece": pa.array([0] * 51, pa.int32()), "shingles": pa.array([[v] for v in values], pa.list_(pa.int64()))}
    )
    (first, last) = hashing.signature_batches(pairs)([rows])
    got = first.column(1).to_pylist() + last.column(1).to_pylist()
    assert got == [[(a * x + b) % hashing.PRIME for a, b in pairs] for x in values]
    assert got[-1][-1] == 240


def test_signatures_against_brute_force(spark, rows):
    for count in (5, 19):
        got = rows(shingles.minhash_signatures(docs(spark, *TEXTS), num_hashes=count, seed=3))
        assert got == sorted(signatures(TEXTS, count, 3), key=repr)


def test_documents_are_merged_from_pieces_and_batches(spark, rows, monkeypatch):
    texts = [" ".join(f"w{(i * i + n) % 41}" for i in range(n * 7 % 60)) for n in range(40)]
    monkeypatch.setattr(shingles, "PIECE", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = rows(shingles.minhash_signatures(docs(spark, *texts).coalesce(2), num_hashes=4, seed=3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(signatures(texts, 4, 3), key=repr)


def test_signatures_need_no_shuffle(spark):
    plan = shingles.minhash_signatures(docs(spark, "a b c"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_equal_texts_have_equal_signatures_and_overlap_shows(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join(words), " ".join(words[:150] + ["x"] * 50)]
    by_doc = {r.doc_id: r.signature for r in shingles.minhash_arrays(docs(spark, *texts)).collect()}
    assert len(by_doc[0]) == 256 and by_doc[0] == by_doc[1]
    left, right = brute_shingles(texts[0]), brute_shingles(texts[2])
    jaccard = len(left & right) / len(left | right)
    equal = sum(a == b for a, b in zip(by_doc[0], by_doc[2])) / 256
    assert abs(equal - jaccard) < 0.12


def test_published_coefficients(spark, rows):
    table = hashing.coefficient_table(spark, 4, seed=9)
    assert rows(table) == [(i, a, b) for i, (a, b) in enumerate(hashing.coefficients(4, 9))]


def test_signatures_are_those_of_the_shingles_that_spark_hashes(spark, rows):
    texts = ["a\x0bb\fc d \x1c e", " . , .", "x.", "\t\n", "A B\r\nC Ä,Ö Σ. d", "a . b , c", "a b c " * 40]
    for size, method in ((1, "crc32"), (3, "crc32"), (2, "md5")):
        hashes = {i: [] for i in range(len(texts))}
        for r in shingles.doc_shingles(docs(spark, *texts), size=size, method=method).collect():
            hashes[r.doc_id].append(r.shingle)
        pairs = hashing.coefficients(6, 1)
        expected = [(d, k, min(((a * x + b) % hashing.PRIME for x in h), default=0)) for d, h in hashes.items() for k, (a, b) in enumerate(pairs)]
        assert rows(shingles.minhash_signatures(docs(spark, *texts), num_hashes=6, size=size, method=method)) == sorted(expected, key=repr)


def test_signatures_expand_no_shingles_in_spark(spark):
    plan = shingles.minhash_arrays(docs(spark, "a b c"))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "transform(" not in plan


def test_signing_a_batch_takes_little_beside_it():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    n, each = 10_000, 100
    lists = pa.ListArray.from_arrays(np.arange(0, n * each + 1, each, dtype=np.int32), np.arange(n * each))
    batch = pa.record_batch([pa.array(np.arange(n)), pa.array(np.zeros(n, np.int32)), lists], ["id", "piece", "shingles"])
    tracemalloc.start()
    try:
        signed = sum(len(b) for b in hashing.signature_batches(hashing.coefficients(256, 1))([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert signed == n and peak < 12e6


def test_signatures_are_made_once_for_a_matrix(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    arrays = shingles.minhash_arrays(docs(spark, *[f"a b c{i}" for i in range(60)]), num_hashes=3)
    shingles.signature_pieces(arrays.mapInArrow(counted, arrays.schema)).collect()
    assert made.value == 60
