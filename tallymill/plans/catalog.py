"""Every operator as a query on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators import columns, demand, forest, links, popularity, scores, shingles, similarity, words
from tallymill.plans import files, tables
from tallymill.session import written_table
from tallymill.sources import corpus

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the queries.
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TOP_WORDS = 100
MATRIX_TOPIC = "en"
MATRIX_WORDS = ["the", "of", "and", "to", "a", "in", "is", "that"]
HASHES = 256
SEED = 1
TARGET = 1
SLICE_DAY = "2024-01-15"
SLICE_ZONE = 14
SLICE_HOUR = 10


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def column_summary(spark, sf):
    return columns.column_summary(tables.load(spark, sf, "lineitem"), MEASURES)


def column_moments(spark, sf):
    return _rounded(columns.column_moments(tables.load(spark, sf, "lineitem"), MEASURES), "mean", "std")


def minmax_normalize(spark, sf):
    scaled = columns.minmax_normalize(tables.load(spark, sf, "lineitem"), MEASURES, ["l_orderkey", "l_linenumber"])
    return _rounded(scaled, *[f"{m}_norm" for m in MEASURES])


def word_count_total(spark, sf):
    return words.word_count_total(tables.documents(spark, sf))


def word_count_by_day(spark, sf):
    return words.word_count_by_day(tables.documents(spark, sf))


def word_count_by_topic(spark, sf):
    return words.word_count_by_topic(tables.documents(spark, sf), tables.TOPICS)


def popularity_hourly(spark, sf, stride=1):
    keys = ["entity", "block"]
    ticks = popularity.ticks_from_rows(tables.tick_rows(spark, sf), keys, "slot", "value")
    hours = popularity.hourly_means(ticks, keys, stride)
    return _rounded(popularity.as_rows(hours, keys, "hours", "avg_hour"), "avg_hour")


def popularity_daily(spark, sf, stride=1):
    keys = ["entity", "block"]
    ticks = popularity.ticks_from_rows(tables.tick_rows(spark, sf), keys, "slot", "value")
    separate = stride > 1
    hours = popularity.hourly_means(ticks, keys, popularity.TICKS_PER_HOUR if separate else 1)
    days = popularity.daily_means(hours, keys, stride, popularity.HOURS if separate else popularity.SLIDING_HOURS)
    return _rounded(popularity.as_rows(days, keys, "days", "avg_day"), "avg_day")


def popularity_hourly_disjoint(spark, sf):
    return popularity_hourly(spark, sf, popularity.TICKS_PER_HOUR)


def popularity_daily_disjoint(spark, sf):
    return popularity_daily(spark, sf, popularity.HOURS_PER_DAY)


def sentiment_by_topic(spark, sf):
    return _rounded(scores.sentiment_by_topic(tables.scores(spark, sf), ["quality", "toxic"]), "sum", "mean")


def top_words_by_topic(spark, sf):
    return words.top_words_by_topic(tables.documents(spark, sf), tables.TOPICS, TOP_WORDS)


def cooccurrence(spark, sf):
    docs = tables.documents(spark, sf)
    top = words.top_words_by_topic(docs, tables.TOPICS, TOP_WORDS)
    return words.cooccurrence(docs, top, "doc_id", ["topic"])


def cooccurrence_matrix(spark, sf):
    listed = spark.createDataFrame([(MATRIX_TOPIC, w, i) for i, w in enumerate(MATRIX_WORDS, 1)], "topic string, word string, rank int")
    cells = words.cooccurrence(tables.documents(spark, sf), listed, "doc_id", ["topic"])
    return words.cooccurrence_matrix(cells, MATRIX_WORDS)


def cooccurrence_matrices(spark, sf):
    """The matrix of the top words of every case and topic: a row per word, a column per rank."""
    cases = tables.cases(spark, sf)
    top = written_table(words.top_words_by_topic(cases, tables.TOPICS, TOP_WORDS, keys=["case"]), "top-words")
    cells = words.cooccurrence_cells(cases, top, "doc_id", ["case", "topic"])
    return words.cooccurrence_matrices(cells, ["case", "topic"], TOP_WORDS)


def cooccurrence_headers(spark, sf):
    """The words behind the columns of these matrices."""
    top = words.top_words_by_topic(tables.cases(spark, sf), tables.TOPICS, TOP_WORDS, keys=["case"])
    return words.matrix_headers(top, ["case", "topic"], TOP_WORDS)


def doc_shingles(spark, sf):
    return shingles.doc_shingles(tables.documents(spark, sf))


def doc_shingles_md5(spark, sf):
    return shingles.doc_shingles(tables.documents(spark, sf), method="md5")


def shingle_doc_matrix(spark, sf):
    return shingles.shingle_doc_matrix(doc_shingles(spark, sf))


def minhash_signatures(spark, sf):
    return shingles.minhash_signatures(tables.documents(spark, sf), num_hashes=HASHES, seed=SEED)


def corpus_documents(spark, sf):
    pages = tables.load_spread(spark, sf, "pages", "page_id", "html")
    found = corpus.corpus_documents(pages, "html", ["page_id"], record_tag="html", body_tag="title")
    return found.select("page_id", "position", "body", F.array_join("words", " ").alias("words"), F.size("words").alias("n_words"))


def average_rating(spark, sf):
    lines = tables.load(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    rated = scores.average_rating(lines, tables.load(spark, sf, "part"), "p_partkey", "l_quantity", "p_name")
    return _rounded(rated, "average")


def user_similarity(spark, sf):
    return _rounded(similarity.user_similarity(tables.ratings(spark, sf), TARGET, "user", "item", "rating"), "similarity", digits=9)


def item_similarity(spark, sf):
    return _rounded(similarity.item_similarity(tables.ratings(spark, sf), TARGET, "user", "item", "rating"), "similarity", digits=9)


def out_degree(spark, sf):
    return links.out_degree(tables.edges(spark, sf))


def in_degree(spark, sf):
    return links.in_degree(tables.edges(spark, sf))


def node_links(spark, sf):
    return links.node_links(tables.edges(spark, sf), TARGET)


def graph_nodes(spark, sf):
    return links.graph_nodes(tables.edges(spark, sf))


def rides_per_day(spark, sf):
    return demand.rides_per_day(tables.rides(spark, sf))


def daily_hires_in_february(spark, sf):
    return demand.daily_hires(tables.order_hires(spark, sf), month=2)


def rides_per_month(spark, sf):
    return _rounded(demand.rides_per_month(tables.order_hires(spark, sf)), "per_day")


def weekday_profile(spark, sf):
    return _rounded(demand.weekday_profile(tables.hires(spark, sf)), "mean_hires")


def weekday_profile_by_zone(spark, sf):
    return _rounded(demand.weekday_profile(tables.hires(spark, sf), by_zone=True), "mean_hires")


def hour_profile(spark, sf):
    return _rounded(demand.hour_profile(tables.hires(spark, sf)), "mean_hires")


def hour_profile_by_zone(spark, sf):
    return _rounded(demand.hour_profile(tables.hires(spark, sf), by_zone=True), "mean_hires")


def rides_per_zone(spark, sf):
    return demand.rides_per_zone(tables.rides(spark, sf))


def zone_bounds(spark, sf):
    p = tables.points(spark, sf)
    return demand.zone_bounds(
        p.select("zone", F.col("x").alias("left"), F.col("x").alias("right"), F.col("y").alias("bottom"), F.col("y").alias("top"))
    )


def ride_totals(spark, sf):
    return _rounded(demand.ride_totals(tables.hires(spark, sf)), "per_day", "per_hour", "per_zone_hour")


def profile_forecast(spark, sf):
    return demand.profile_forecast(*tables.hire_split(spark, sf))


def date_slice_profile(spark, sf):
    return demand.date_slice_profile(tables.hires(spark, sf), SLICE_DAY, SLICE_ZONE, SLICE_HOUR)


def forest_forecast(spark, sf):
    train, test = tables.hire_split(spark, sf)
    return forest.forest_forecast(forest.fit_forest(train, seed=SEED), test)


def forest_rmse(spark, sf):
    train, _ = tables.hire_split(spark, sf)
    return forest.forest_rmse(forest.fit_forest(train, seed=SEED), train)


def forest_scores(spark, sf):
    """Error of the forest on its training rows and on the later rows."""
    train, later = tables.hire_split(spark, sf)
    return forest.forest_scores(forest.fit_forest(train, seed=SEED), train, later)


def forest_features(spark, sf):
    """The features of all rows as the trees see them."""
    train, test = tables.hire_split(spark, sf)
    rows = forest.indexed_features(test, forest.category_index(train))
    names = [F.get("features", i).alias(f"{c}_index") for i, c in enumerate(forest.FEATURES)]
    return rows.select("test_id", "weekday", "month", *names)


def profile_rmse(spark, sf):
    return _rounded(demand.profile_rmse(*tables.hire_split(spark, sf)), "rmse")


def zone_points(spark, sf):
    return demand.zone_points(tables.points(spark, sf), zone=5)


def queries() -> dict[str, Query]:
    operators = [
        column_summary, column_moments, minmax_normalize,
        word_count_total, word_count_by_day, word_count_by_topic,
        popularity_hourly, popularity_hourly_disjoint, popularity_daily, popularity_daily_disjoint,
        sentiment_by_topic, top_words_by_topic, cooccurrence, cooccurrence_matrix,
        cooccurrence_matrices, cooccurrence_headers,
        doc_shingles, doc_shingles_md5, shingle_doc_matrix, minhash_signatures, corpus_documents,
        average_rating, user_similarity, item_similarity,
        out_degree, in_degree, node_links, graph_nodes,
        rides_per_day, daily_hires_in_february, rides_per_month,
        weekday_profile, weekday_profile_by_zone, hour_profile, hour_profile_by_zone,
        rides_per_zone, zone_bounds, ride_totals, profile_forecast, date_slice_profile,
        forest_forecast, forest_rmse, forest_scores, forest_features, profile_rmse, zone_points,
    ]
    return {q.__name__: q for q in [*operators, *files.QUERIES]}
