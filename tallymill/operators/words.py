"""Word frequencies and word co-occurrence.

Texts are cleaned with ``letters_only`` and cut at single blanks, so the empty word
counts like any other. ``explode_outer`` is used throughout: plain ``explode`` makes
the optimizer add a size check that cleans every text a second time. Where null texts
must vanish they are filtered before, which reaches the file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallymill.functions.text import space_words
from tallymill.operators.ranking import top_per_group
from tallymill.session import written_table

def texts_as_cases(df: DataFrame, texts: list[str], keep: list[str]) -> DataFrame:
    """One row per text column: (``keep``..., case, text). One scan serves all cases."""
    cases = F.array(*[F.struct(F.lit(t).alias("case"), F.col(t).alias("text")) for t in texts])
    return df.select(*keep, F.inline(cases))


def word_count_total(df: DataFrame, text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """(keys..., word, n), most frequent first. A null text counts as one null word."""
    keys = keys or []
    words = df.select(*keys, F.explode_outer(space_words(F.col(text))).alias("word"))
    return words.groupBy(*keys, "word").agg(F.count("*").alias("n")).orderBy(*keys, F.desc("n"), "word")


def word_count_by(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., word, n) of all rows whose keys and text are present, unsorted."""
    present = [F.col(c).isNotNull() for c in [*keys, text]]
    for condition in present:
        df = df.where(condition)
    words = df.select(*keys, F.explode_outer(space_words(F.col(text))).alias("word"))
    return words.groupBy(*keys, "word").agg(F.count("*").alias("n"))


def word_count_by_day(df: DataFrame, day: str = "day", text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """(keys..., day, word, n) ordered by day and frequency; rows without a day are left out."""
    keys = [*(keys or []), day]
    return word_count_by(df, keys, text).orderBy(*keys, F.desc("n"), "word")


def word_count_by_topic(
    df: DataFrame, topics: list[str], topic: str = "topic", text: str = "text", keys: list[str] | None = None
) -> DataFrame:
    """(keys..., topic, word, n) of the given topics, ordered by topic and frequency."""
    keys = [*(keys or []), topic]
    chosen = df.where(F.col(topic).isin(topics))
    return word_count_by(chosen, keys, text).orderBy(*keys, F.desc("n"), "word")


def top_words_by_topic(
    df: DataFrame,
    topics: list[str],
    k: int = 100,
    topic: str = "topic",
    text: str = "text",
    keys: list[str] | None = None,
) -> DataFrame:
    """(keys..., topic, word, n, rank) of the k most frequent words; equal counts go by word."""
    keys = [*(keys or []), topic]
    counts = word_count_by(df.where(F.col(topic).isin(topics)), keys, text)
    return top_per_group(counts, keys, [F.desc("n"), F.asc("word")], k, tie_break="word")


def cooccurrence_cells(df: DataFrame, vocabulary: DataFrame, doc_id: str, keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., rank_a, word_a, rank_b, word_b, n): pairs of occurrences in the same document.

    A word found m times and another found n times in one document add m * n, a word
    with itself m * m. ``vocabulary`` holds (keys..., word, rank); its words are the only ones
    counted, which also bounds the pairs of a document. It is written, so that its measured size
    decides on the join, with a number for every word of every key, in the order of ranks. Each document is reduced to
    (number, count) before pairing, and a word is paired with those of its own or a higher number only; words and keys come
    back, and the mirror image is added, once the cells are finished.
    """
    known = vocabulary.select(*keys, "word", "rank").where(F.col("word").isNotNull())
    known = known.groupBy(*keys, "rank", "word").agg(F.count("*").alias("copies")).orderBy(*keys, "rank", "word")
    known = written_table(known.withColumn("number", F.monotonically_increasing_id()), "vocabulary-words")
    # The first number of a key stands for the key.
    known = written_table(known.withColumn("key", F.min("number").over(Window.partitionBy(*keys))), "vocabulary")
    tokens = df.where(F.col(text).isNotNull()).select(
        *keys, doc_id, F.explode_outer(space_words(F.col(text))).alias("word")
    )
    found = tokens.join(known, [*keys, "word"]).groupBy("key", F.col(doc_id).alias("doc"), "number").agg(F.sum("copies").alias("m"))
    by_document = found.groupBy("key", "doc").agg(F.sort_array(F.collect_list(F.struct("number", "m"))).alias("found"))

    left = by_document.select("found", F.posexplode("found").alias("at", "a"))
    rest = F.slice("found", F.col("at") + 1, F.size("found") - F.col("at"))
    both = left.select("a", F.explode(rest).alias("b"))
    numbered = both.groupBy(F.col("a.number").alias("number_a"), F.col("b.number").alias("number_b"))
    cells = numbered.agg(F.sum(F.col("a.m") * F.col("b.m")).alias("n"))
    names = {s: [F.col("number").alias(f"number_{s}"), F.col("rank").alias(f"rank_{s}"), F.col("word").alias(f"word_{s}")] for s in ("a", "b")}
    cells = cells.join(known.select(*keys, *names["a"]), "number_a").join(known.select(*names["b"]), "number_b")

    def cell(one: str, other: str):
        sides = [F.col(f"{name}_{side}").alias(f"{name}_{to}") for side, to in ((one, "a"), (other, "b")) for name in ("rank", "word")]
        return F.struct(*sides)

    sides = F.when(F.col("rank_a") == F.col("rank_b"), F.array(cell("a", "b"))).otherwise(F.array(cell("a", "b"), cell("b", "a")))
    return cells.select(*keys, F.inline(sides), "n")


def cooccurrence(df: DataFrame, vocabulary: DataFrame, doc_id: str, keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., word_a, word_b, n) of :func:`cooccurrence_cells`."""
    return cooccurrence_cells(df, vocabulary, doc_id, keys, text).select(*keys, "word_a", "word_b", "n")


def cooccurrence_matrix(cells: DataFrame, words: list[str]) -> DataFrame:
    """One row per ``word`` and one column per entry of ``words``, zero where nothing was counted.

    The column list is an argument, so the pivot runs without a job of its own.
    """
    listed = cells.where(F.col("word_a").isin(words) & F.col("word_b").isin(words))
    wide = listed.groupBy(F.col("word_a").alias("word")).pivot("word_b", words).agg(F.sum("n"))
    return wide.fillna(0, subset=words)


def cooccurrence_matrices(cells: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys..., rank, word, n1, ..., n<size>): the matrix of every key, row by row, from one pivot.

    Columns go by rank, so no column name has to be learned from the data; the words that they stand for are
    the rows of :func:`matrix_headers`. Zero where nothing was counted; a key with fewer words
    has zeros in the columns beyond them.
    """
    ranks = list(range(1, size + 1))
    rows = cells.groupBy(*keys, F.col("rank_a").alias("rank"), F.col("word_a").alias("word"))
    wide = rows.pivot("rank_b", ranks).agg(F.sum("n"))
    return wide.select(*keys, "rank", "word", *[F.coalesce(F.col(str(r)), F.lit(0)).alias(f"n{r}") for r in ranks])


def matrix_headers(vocabulary: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys..., w1, ..., w<size>): the words behind the columns of every key's matrix; null beyond its last word."""
    wide = vocabulary.groupBy(*keys).pivot("rank", list(range(1, size + 1))).agg(F.min("word"))
    return wide.select(*keys, *[F.col(str(r)).alias(f"w{r}") for r in range(1, size + 1)])
