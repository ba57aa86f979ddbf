"""Text outputs.

Sorted outputs are written by all tasks from range partitions; their part files in name
order are the sorted whole. Single files are joined from such parts, byte by byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymill.session import remove_folder, shared_folder, written_table


#: CSV in which every text comes back as it was: all fields quoted, no white space trimmed.
QUOTED = {"quoteAll": True, "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: First cell of a matrix file; words consist of letters and white space only.
CORNER = "word_word"
#: Places of a matrix row in one file, some ten MB of text.
FILE_PLACES = 1 << 20


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",") -> None:
    """A directory of CSV part files, replacing what was there."""
    df.write.mode("overwrite").csv(path, header=header, sep=sep)


def write_sorted(df: DataFrame, path: str, order: list, header: bool = False, sep: str = ",") -> None:
    """CSV part files whose concatenation in name order is sorted by ``order``."""
    write_csv(df.orderBy(*order), path, header, sep)


def write_word_counts(counts: DataFrame, path: str, quoted: bool = False) -> None:
    """``word count`` lines, most frequent first; ``quoted`` keeps line breaks inside of words."""
    rows = counts.select("word", "n").orderBy(F.desc("n"), F.asc("word"))
    rows.write.mode("overwrite").csv(path, sep=" ", **(QUOTED if quoted else {}))


def write_per_key(df: DataFrame, path: str, keys: list[str], order: list[Column], sep: str = " ", quoted: bool = False) -> None:
    """One folder ``key=value`` per key, written by a single job; ``quoted`` keeps line breaks inside of words.

    Rows are range-partitioned by the keys and the order together, so a hot key is cut
    into several sorted files instead of filling one task.
    """
    options = QUOTED if quoted else {}
    df.orderBy(*keys, *order).write.mode("overwrite").partitionBy(*keys).csv(path, sep=sep, **options)


def join_files(spark: SparkSession, path: str, pieces: list[tuple[str, int]]) -> None:
    """One file ``path`` from (file, bytes to leave out at its end), in this order.

    The bytes go through a buffer of fixed size and are neither parsed nor sorted.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    try:
        for name, left_out in pieces:
            source = jvm.org.apache.hadoop.fs.Path(name)
            files = source.getFileSystem(conf)
            size = files.getFileStatus(source).getLen() - left_out
            stream = files.open(source)
            jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, 0, size)
            stream.close()
    finally:
        out.close()


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The part files of a folder that hold something, in name order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(path) if files.exists(path) else []
    return sorted(f.getPath().toString() for f in found if f.getPath().getName().startswith("part-") and f.getLen())


def write_single(df: DataFrame, path: str, order: list, header: bool = False, sep: str = ",", max_rows: int | None = None) -> None:
    """A folder with one sorted file, replacing what was there.

    The rows are written as sorted parts by all tasks, and the parts are joined as they are; no task
    sorts or holds the whole. Only a caller that gives ``max_rows`` has results above it refused.
    """
    spark = df.sparkSession
    if max_rows is not None:
        df = written_table(df, "single-file")
        if df.limit(max_rows + 1).count() > max_rows:
            raise ValueError(f"more than {max_rows} rows: use write_sorted")
    parts = shared_folder(spark, "sorted-parts")
    write_sorted(df, f"{parts}/rows", order, sep=sep)
    if header:
        names = F.to_csv(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)]), {"sep": sep})
        spark.range(1).select(names).coalesce(1).write.text(f"{parts}/header")
    pieces = [f for part in (["header", "rows"] if header else ["rows"]) for f in part_files(spark, f"{parts}/{part}")]
    remove_folder(spark, path)
    join_files(spark, f"{path}/part-00000.csv", [(f, 0) for f in pieces])
    remove_folder(spark, parts)


def write_single_text(df: DataFrame, path: str, value: str, order: list) -> None:
    """A folder with one text file of the values in ``order``, each with a line end, joined from sorted parts."""
    parts = shared_folder(df.sparkSession, "text-parts")
    df.orderBy(*order).select(value).write.text(parts)
    remove_folder(df.sparkSession, path)
    join_files(df.sparkSession, f"{path}/part-00000.txt", [(f, 0) for f in part_files(df.sparkSession, parts)])
    remove_folder(df.sparkSession, parts)


def write_lines(df: DataFrame, path: str, keys: list[str], value: str, order: list, lines: list[tuple]) -> None:
    """One text file with a line for each of ``lines`` (tuples of key values, in this order), replacing what was there.

    A line holds the values of its key in ``order``, separated by commas, and ends with a line end. The
    values of a line are written by many tasks, range-partitioned by key and order, so a line may be
    longer than a task could hold; then the files of all lines are joined, each without its last
    comma. A key without values gives an empty line; keys that are not listed are left out.
    """
    spark = df.sparkSession
    parts = shared_folder(spark, "line-parts")
    rows = df.orderBy(*keys, *order).select(*keys, F.col(value).cast("string").alias("value")).where("value is not null")
    rows.write.partitionBy(*keys).option("lineSep", ",").text(f"{parts}/values")
    spark.range(1).select(F.lit("")).coalesce(1).write.text(f"{parts}/end")
    (end,) = part_files(spark, f"{parts}/end")
    pieces = []
    for line in lines:
        own = part_files(spark, f"{parts}/values/" + "/".join(f"{k}={v}" for k, v in zip(keys, line)))
        pieces += [(f, 1 if f == own[-1] else 0) for f in own] + [(end, 0)]
    remove_folder(spark, path)
    join_files(spark, f"{path}/part-00000.txt", pieces)
    remove_folder(spark, parts)


def write_joined_lines(df: DataFrame, path: str, keys: list[str], value: str, order: list) -> None:
    """One folder per key whose files, in name order, hold one comma-separated line.

    The comma is the record separator of the writer (so one follows the last value too)
    and a line of any length is written by many tasks. ``write_lines`` makes whole lines of it.
    """
    rows = df.orderBy(*keys, *order).select(*keys, F.col(value).cast("string").alias("value"))
    rows.write.mode("overwrite").partitionBy(*keys).option("lineSep", ",").text(path)


def write_signature_rows(signatures: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """The signature matrix, one line per hash function with the documents in id order."""
    write_joined_lines(signatures, path, ["hash_idx"], "minhash", [doc_id])


def write_matrix_pieces(pieces: DataFrame, path: str) -> None:
    """The matrix of ``shingles.signature_pieces``: one folder ``row=<name>``, a text line for each piece.

    A line holds the place of its first document and the values, separated by commas. The pieces of a row
    that lie in the same ``FILE_PLACES`` places go to one file, so the number of files grows with the values and
    not with tasks times rows.
    """
    line = F.concat_ws(",", F.col("first").cast("string"), F.array_join(F.col("values").cast("array<string>"), ","))
    together = pieces.repartition("row", F.floor(F.col("first") / FILE_PLACES))
    together.select("row", line.alias("value")).write.mode("overwrite").partitionBy("row").text(path)


def read_matrix_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(row, first, values) as written by :func:`write_matrix_pieces`."""
    lines = spark.read.schema("value string, row int").text(path)
    # The place is cut off before the values are split: joins look at it first, line by line.
    first = F.substring_index("value", ",", 1)
    rest = F.split(F.substring(F.col("value"), F.length(first) + 2, F.length("value")), ",")
    return lines.select("row", first.cast("bigint").alias("first"), rest.cast("array<bigint>").alias("values"))


def write_matrices(matrices: DataFrame, headers: DataFrame, path: str, keys: list[str], size: int) -> None:
    """One folder per key with a CSV of its matrix: a line of words behind ``CORNER``, then a line per word, all quoted.

    Headers and rows are written by one job; line ends inside a word stay within its quotes.
    """
    names = ["word", *[f"n{i}" for i in range(1, size + 1)]]
    head = headers.select(*keys, F.lit(0).alias("rank"), F.lit(CORNER).alias("word"), *[F.col(f"w{i}").alias(f"n{i}") for i in range(1, size + 1)])
    body = matrices.select(*keys, "rank", "word", *[F.col(n).cast("string") for n in names[1:]])
    rows = head.unionByName(body).orderBy(*keys, "rank").select(*keys, *names)
    rows.write.mode("overwrite").partitionBy(*keys).csv(path, **QUOTED)


def write_links(links: DataFrame, path: str) -> None:
    """The links of a node, one line of out-links and one of in-links."""
    write_joined_lines(links, path, ["direction"], "neighbour", ["neighbour"])


def write_link_lines(links: DataFrame, path: str) -> None:
    """The links of a node as a text of two whole lines: out-links, then in-links."""
    write_lines(links, path, ["direction"], "neighbour", ["neighbour"], [("out",), ("in",)])
