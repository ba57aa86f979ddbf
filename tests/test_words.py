import datetime
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymill.functions import text
from tallymill.operators import words
from tallymill.operators.ranking import top_per_group


def texts(spark, *values):
    return spark.createDataFrame([(i, v, "t") for i, v in enumerate(values)], "doc_id int, text string, topic string")


def test_total_keeps_empty_words_and_deletes_other_characters(spark, rows):
    counts = words.word_count_total(texts(spark, "It's  A-b"))
    assert rows(counts) == [("", 1), ("ab", 1), ("its", 1)]


def test_accents_vanish_and_line_breaks_stay(spark, rows):
    assert rows(words.word_count_total(texts(spark, "été a\nb"))) == [("a\nb", 1), ("t", 1)]


def test_null_text_is_one_null_word_in_the_total_only(spark, rows):
    df = texts(spark, None, "a")
    assert rows(words.word_count_total(df)) == sorted([(None, 1), ("a", 1)], key=repr)
    assert rows(words.word_count_by_topic(df, ["t"])) == [("t", "a", 1)]


def test_most_frequent_first(spark):
    df = words.word_count_total(texts(spark, "b a b c"))
    assert [tuple(r) for r in df.collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_by_day_skips_missing_days(spark, rows):
    day = datetime.date(2015, 11, 2)
    df = spark.createDataFrame([(day, "a a"), (None, "b")], "day date, text string")
    assert rows(words.word_count_by_day(df)) == [(day, "a", 2)]


def test_only_the_given_topics(spark, rows):
    df = spark.createDataFrame([("x", "a"), ("y", "b")], "topic string, text string")
    assert rows(words.word_count_by_topic(df, ["y"])) == [("y", "b", 1)]


def test_cases_share_one_scan(spark, rows):
    df = spark.createDataFrame([("x", "a", "a b")], "topic string, Title string, Headline string")
    cases = words.texts_as_cases(df, ["Title", "Headline"], ["topic"])
    expected = [("Headline", "x", "a", 1), ("Headline", "x", "b", 1), ("Title", "x", "a", 1)]
    assert rows(words.word_count_by_topic(cases, ["x"], keys=["case"])) == expected


def test_text_is_cleaned_once(spark, tmp_path):
    path = str(tmp_path / "t")
    texts(spark, "a").write.parquet(path)
    plan = words.word_count_by_topic(spark.read.parquet(path), ["t"])._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("regexp_replace") == 1


def test_top_words_break_ties_by_word(spark):
    top = words.top_words_by_topic(texts(spark, "c b a a"), ["t"], k=2).orderBy("rank").collect()
    assert [(r.word, r.n, r["rank"]) for r in top] == [("a", 2, 1), ("b", 1, 2)]


@pytest.mark.parametrize("levels", [(), (4,), (12, 4, 2)])
def test_top_rows_by_merging_levels(spark, levels):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.concat(F.lit("w"), "id").alias("word"), (F.col("id") % 7).alias("n"))
    got = top_per_group(df, ["g"], [F.desc("n"), F.asc("word")], 20, "word", levels).collect()
    for g in (0, 1):
        expected = [w for _, w in sorted((-r.n, r.word) for r in df.where(f"g = {g}").collect())[:20]]
        assert [r.word for r in sorted((r for r in got if r.g == g), key=lambda r: r["rank"])] == expected


def test_large_k_ranks_in_two_steps_with_the_same_result(spark, rows):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.concat(F.lit("w"), "id").alias("word"), (F.col("id") % 97).alias("n"))
    order = [F.desc("n"), F.asc("word")]
    two_steps = rows(top_per_group(df, ["g"], order, 1001, "word"), "g", "word", "rank")
    plain = sorted(((r.g, -r.n, r.word) for r in df.collect()))
    expected = []
    for g in (0, 1):
        expected += [(g, word, i) for i, (_, _, word) in enumerate([p for p in plain if p[0] == g][:1001], 1)]
    assert two_steps == sorted(expected, key=repr)


def brute_pairs(docs, vocabulary):
    counts = Counter()
    for words_ in docs:
        kept = [w for w in words_.split(" ") if w in vocabulary]
        counts.update((a, b) for a in kept for b in kept)
    return counts


def vocabulary(spark, *listed):
    return spark.createDataFrame([("t", w, i) for i, w in enumerate(listed, 1)], "topic string, word string, rank int")


def test_cooccurrence_counts_occurrence_pairs(spark, rows):
    cells = words.cooccurrence(texts(spark, "a a b", "a c"), vocabulary(spark, "a", "b", "c"), "doc_id", ["topic"])
    expected = [("a", "a", 5), ("a", "b", 2), ("a", "c", 1), ("b", "a", 2), ("b", "b", 1), ("c", "a", 1), ("c", "c", 1)]
    assert rows(cells, "word_a", "word_b", "n") == expected


def test_cooccurrence_against_brute_force_with_and_without_broadcast(spark, rows):
    docs = ["x y  x z", "y y y q", "z", "", "x z z y x x", None]
    listed = ["x", "y", "z", ""]
    expected = brute_pairs([d for d in docs if d is not None], set(listed))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    for bound in (before, "-1"):
        spark.conf.set(setting, bound)
        try:
            cells = words.cooccurrence(texts(spark, *docs), vocabulary(spark, *listed), "doc_id", ["topic"]).collect()
        finally:
            spark.conf.set(setting, before)
        assert {(r.word_a, r.word_b): r.n for r in cells} == dict(expected)


def test_matrices_of_several_keys_go_by_rank(spark):
    df = spark.createDataFrame([(1, "t", "a a b"), (2, "u", "b c"), (3, "u", "c"), (4, "u", None)], "doc_id int, topic string, text string")
    top = words.top_words_by_topic(df, ["t", "u"], 3)
    cells = words.cooccurrence_cells(df, top, "doc_id", ["topic"])
    got = {(r.topic, r["rank"]): (r.word, r.n1, r.n2, r.n3) for r in words.cooccurrence_matrices(cells, ["topic"], 3).collect()}
    assert got == {("t", 1): ("a", 4, 2, 0), ("t", 2): ("b", 2, 1, 0), ("u", 1): ("c", 2, 1, 0), ("u", 2): ("b", 1, 1, 0)}
    headers = {r.topic: (r.w1, r.w2, r.w3) for r in words.matrix_headers(top, ["topic"], 3).collect()}
    assert headers == {"t": ("a", "b", None), "u": ("c", "b", None)}


def test_matrix_is_square_with_zeros(spark, rows):
    cells = words.cooccurrence(texts(spark, "a a b", "a c"), vocabulary(spark, "a", "b", "c"), "doc_id", ["topic"])
    assert rows(words.cooccurrence_matrix(cells, ["a", "b", "c"])) == [("a", 5, 2, 1), ("b", 2, 1, 0), ("c", 1, 0, 1)]


def test_plain_words_keep_places_of_removed_marks(spark):
    df = spark.createDataFrame([(" A.b,\t... C \n",), ("  ",), (None,)], "text string")
    got = [r.words for r in text.with_plain_words(df, "text", []).collect()]
    assert got == [["ab", "", "c"], [], []]


def test_pairs_are_counted_by_number(spark, rows):
    df = spark.createDataFrame([(1, "t", "a a b"), (1, "t", "b c"), (None, "t", "a c"), (2, "u", "a b"), (3, None, "a b")], "doc_id int, topic string, text string")
    top = spark.createDataFrame([("t", "a", 1), ("t", "b", 2), ("t", "c", 2), ("u", "a", 1), ("u", "b", 2), ("u", "b", 2), (None, "a", 1)], "topic string, word string, rank int")
    cells = words.cooccurrence_cells(df, top, "doc_id", ["topic"])
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(([^)]*)\)", plan)[0].split(", ")) == 3  # two numbers, and that of partitions
    expected = [("t", "a", "a", 5), ("t", "a", "b", 4), ("t", "b", "a", 4), ("t", "a", "c", 3), ("t", "c", "a", 3), ("t", "b", "b", 4), ("t", "b", "c", 2), ("t", "c", "c", 2)]
    expected += [("u", "a", "a", 1), ("u", "a", "b", 2), ("u", "b", "a", 2), ("u", "b", "b", 4)]
    assert rows(cells, "topic", "word_a", "word_b", "n") == sorted(expected, key=repr)
