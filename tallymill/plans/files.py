"""Readers and writers as queries: test tables are written in a file format and analysed from there.

The files go to a fresh folder below the shared folder of the session. They are written
when the query is built, like a checkpoint, and read lazily.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymill.functions.hashing import coefficient_table
from tallymill.operators import columns, demand, forest, links, popularity, scores, shingles, similarity, words
from tallymill.plans import tables
from tallymill.session import shared_folder, written_table
from tallymill.sinks import writers
from tallymill.sources import corpus, delimited, quoted, schemas

# Fixed values of the file formats.
EDGE_COMMENTS = ["# Directed graph", "# One link per line", "# FromNodeId\tToNodeId"]


def power_file_summary(spark, sf) -> DataFrame:
    """Semicolon file with header (written as CSV directory), summary of the four measures."""
    path = shared_folder(spark, "power")
    measures = ["Global_active_power", "Global_reactive_power", "Voltage", "Global_intensity"]
    source = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = tables.load(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "d/M/yyyy").alias("Date"),
        F.lit("00:00:00").alias("Time"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(m) for c, m in zip(source, measures)],
        *[F.lit("?").alias(f"Sub_metering_{i}") for i in (1, 2, 3)],
    )
    writers.write_csv(lines, path, header=True, sep=";")
    return columns.column_summary(delimited.read_power(spark, path), [*measures, "Sub_metering_1"])


def news_file_word_counts(spark, sf) -> DataFrame:
    """Quoted CSV of the documents, each on one line; words per case and topic."""
    path = shared_folder(spark, "news")
    docs = tables.documents(spark, sf)
    line = F.regexp_replace("text", r"\s+", " ")
    news = docs.select(
        F.col("doc_id").alias("IDLink"),
        line.alias("Title"),
        F.concat(F.lit('He said: "'), line, F.lit('", twice')).alias("Headline"),
        F.lit("").alias("Source"),
        F.col("topic").alias("Topic"),
        F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("PublishDate"),
        *[F.lit(0.5).alias(c) for c in ("SentimentTitle", "SentimentHeadline", "Facebook", "GooglePlus", "LinkedIn")],
    )
    news.write.csv(path, header=True, quote='"', escape='"', quoteAll=True, emptyValue="")
    cases = words.texts_as_cases(delimited.read_news(spark, path), ["Title", "Headline"], ["Topic"])
    return words.word_count_by_topic(cases, tables.TOPICS, "Topic", keys=["case"])


def feedback_files_hourly(spark, sf) -> DataFrame:
    """One CSV per platform with 144 tick columns, read by one glob; sliding hourly means."""
    folder = shared_folder(spark, "feedback")
    keys = ["entity", "block"]
    ticks = written_table(popularity.ticks_from_rows(tables.tick_rows(spark, sf), keys, "slot", "value"), "ticks")
    wide = popularity.as_columns(ticks, keys, "ticks", "TS", popularity.TICKS)
    kinds = ticks.select("entity").distinct().agg(F.sort_array(F.collect_list("entity")).alias("kinds")).scalar()
    item = F.col("block") * 10 + F.array_position(kinds, F.col("entity"))
    names = [f"TS{i}" for i in range(1, popularity.TICKS + 1)]
    for number, platform in enumerate(schemas.PLATFORMS):
        part = wide.where(F.col("block") % len(schemas.PLATFORMS) == number)
        writers.write_csv(part.select(item.cast("double").alias("IDLink"), *names), f"{folder}/{platform}_Events.csv", header=True)
    keys = ["platform", "IDLink"]
    series = popularity.ticks_from_columns(delimited.read_feedback(spark, folder), keys, names)
    hours = popularity.as_rows(popularity.hourly_means(series, keys), keys, "hours", "avg_hour")
    return hours.select("platform", F.col("IDLink").cast("int").alias("item"), "slot", F.round("avg_hour", 6).alias("avg_hour"))


def movie_files_average_rating(spark, sf) -> DataFrame:
    """Movies and ratings separated by ``::``, average rating per title."""
    folder = shared_folder(spark, "movies")
    parts = tables.load(spark, sf, "part")
    lines = tables.load(spark, sf, "lineitem")
    movie = F.concat_ws("::", "p_partkey", F.concat("p_name", F.lit(", The (1995)")), F.concat_ws("|", "p_type", "p_brand"))
    rating = F.concat_ws("::", "l_suppkey", "l_partkey", F.col("l_quantity").cast("int"), F.lit(978300760))
    parts.select(movie).write.text(f"{folder}/movies.dat")
    lines.select(rating).write.text(f"{folder}/ratings.dat")
    movies = delimited.read_movies(spark, f"{folder}/movies.dat")
    ratings = delimited.read_ratings(spark, f"{folder}/ratings.dat")
    genres = movies.select("MovieID", F.concat_ws(": ", "Title", F.array_join("Genre", "+")).alias("Title"))
    rated = scores.average_rating(ratings, genres, "MovieID", "Rating", "Title")
    return rated.select("MovieID", "Title", F.round("average", 6).alias("average"))


def user_file_ages(spark, sf) -> DataFrame:
    """Users separated by ``::`` as they are read back."""
    path = shared_folder(spark, "users")
    people = tables.load(spark, sf, "customer")
    # Every other occupation would not fit a byte and has to come back all the same.
    occupation = F.col("c_nationkey") + F.col("c_custkey") % 2 * 200
    user = F.concat_ws("::", "c_custkey", F.substring("c_mktsegment", 1, 1), "c_nationkey", occupation, F.col("c_custkey") + 10000)
    people.select(user).write.text(path)
    users = delimited.read_users(spark, path)
    return users.select("UserID", "Gender", F.col("Age").cast("int").alias("Age"), F.col("Occupation").cast("int").alias("Occupation"), F.col("Zip-code").alias("zip"))


def edge_file_degrees(spark, sf) -> DataFrame:
    """Tab-separated edges behind comment lines; distinct targets per source."""
    path = shared_folder(spark, "edges")
    spark.createDataFrame([(line,) for line in EDGE_COMMENTS], "value string").coalesce(1).write.text(path)
    tables.edges(spark, sf).write.mode("append").csv(path, sep="\t")
    return links.out_degree(delimited.read_edges(spark, path))


def hire_files_forecast(spark, sf) -> DataFrame:
    """Hire counts for training and test as CSV; forecast by profile."""
    folder = shared_folder(spark, "hires")
    train, test = tables.hire_split(spark, sf)
    columns_ = [F.col("zone").alias("Zone_ID"), F.col("day").alias("Date"), F.col("hour").alias("Hour_slot"), F.col("hires").alias("Hire_count")]
    writers.write_csv(train.select(*columns_), f"{folder}/train", header=True)
    writers.write_csv(test.select(F.col("test_id").alias("Test_ID"), *columns_), f"{folder}/test", header=True)
    return demand.profile_forecast(delimited.read_hires(spark, f"{folder}/train"), delimited.read_hire_tests(spark, f"{folder}/test"))


def hire_files_forest(spark, sf) -> DataFrame:
    """Hire counts for training and test as CSV; forecast by a random forest, written as one sorted file and read back."""
    folder = shared_folder(spark, "forest-hires")
    train, test = tables.hire_split(spark, sf)
    columns_ = [F.col("zone").alias("Zone_ID"), F.col("day").alias("Date"), F.col("hour").alias("Hour_slot"), F.col("hires").alias("Hire_count")]
    writers.write_csv(train.select(*columns_), f"{folder}/train", header=True)
    writers.write_csv(test.select(F.col("test_id").alias("Test_ID"), *columns_), f"{folder}/test", header=True)
    model = forest.fit_forest(delimited.read_hires(spark, f"{folder}/train"))
    told = forest.forest_forecast(model, delimited.read_hire_tests(spark, f"{folder}/test"))
    writers.write_single(told, f"{folder}/forecast", ["test_id"])
    return spark.read.schema(told.schema).csv(f"{folder}/forecast")


def gps_file_rides(spark, sf) -> DataFrame:
    """Ride starts with a text timestamp; rides per zone and day."""
    path = shared_folder(spark, "gps")
    starts = tables.load(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("Datetime"),
        F.col("value").alias("Longitude_X"),
        F.lit(0.0).alias("Latitude_Y"),
        (F.col("user_id") % tables.ZONES + 1).alias("Zone_ID"),
    )
    writers.write_csv(starts, path, header=True)
    gps = delimited.read_gps(spark, path)
    return gps.groupBy("zone", "day").agg(
        F.count("*").alias("n"), F.count("moment").alias("n_parsed"), F.max(F.hour("moment")).alias("last_hour")
    )


def zone_file_bounds(spark, sf) -> DataFrame:
    """Zone rectangles as CSV; bounds per zone and of all zones."""
    path = shared_folder(spark, "zones")
    p = tables.points(spark, sf)
    boxes = p.select(F.col("zone").alias("Zone_ID"), F.col("x").alias("left"), F.col("y").alias("top"), F.col("x").alias("right"), F.col("y").alias("bottom"))
    writers.write_csv(boxes, path, header=True)
    return demand.zone_bounds(delimited.read_zones(spark, path))


def article_files_documents(spark, sf) -> DataFrame:
    """Tagged article files of any size, cut at the closing tag; text and words of every article."""
    path = shared_folder(spark, "articles")
    text = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    article = F.concat(F.lit('<REUTERS ID="'), "doc_id", F.lit('"><TEXT><BODY>'), text, F.lit("</BODY></TEXT></REUTERS>"))
    tables.documents(spark, sf).select(article).write.text(path)
    articles = corpus.read_large_corpus(spark, path, closing_tag="</REUTERS>")
    return articles.select("body", F.array_join("words", " ").alias("words"))


def word_files_by_topic(spark, sf) -> DataFrame:
    """``word count`` files in one folder per topic, read back."""
    path = shared_folder(spark, "words")
    counts = words.word_count_by(tables.documents(spark, sf).where(F.col("topic").isin(tables.TOPICS)), ["topic"])
    # Words with a line break inside would need quoting rules of their own when read back.
    counts = counts.select("topic", F.regexp_replace("word", r"\s", "~").alias("word"), "n")
    writers.write_per_key(counts, path, ["topic"], [F.desc("n"), F.asc("word")])
    return spark.read.schema("word string, n bigint, topic string").csv(path, sep=" ", emptyValue="").select(
        "topic", F.coalesce("word", F.lit("")).alias("word"), "n"
    )


def word_count_file(spark, sf) -> DataFrame:
    """``word count`` lines of all documents, quoted so that line breaks stay inside of words, read back."""
    path = shared_folder(spark, "word-counts")
    writers.write_word_counts(words.word_count_total(tables.documents(spark, sf)), path, quoted=True)
    return quoted.read_quoted(spark, path, "word string, n bigint", header=False, sep=" ")


def signature_coefficients(spark, sf) -> DataFrame:
    """The coefficients of every hash function next to the least of its minima over all documents with shingles."""
    arrays = shingles.minhash_signatures(tables.documents(spark, sf), num_hashes=256)
    least = arrays.groupBy("hash_idx").agg(F.min("minhash").alias("least"), F.count_if(F.col("minhash") == 0).alias("zeros"))
    return least.join(coefficient_table(spark, 256, 1), "hash_idx")


def top_word_file(spark, sf) -> DataFrame:
    """Top words as one sorted file with a header line, read back."""
    path = shared_folder(spark, "top")
    top = words.top_words_by_topic(tables.documents(spark, sf), tables.TOPICS)
    writers.write_single(top.select("topic", "rank", "n", "word"), path, ["topic", "rank"], header=True)
    back = spark.read.schema("topic string, rank int, n bigint, word string").csv(path, header=True)
    return back.withColumn("word", F.coalesce("word", F.lit("")))


def degree_files_sorted(spark, sf) -> DataFrame:
    """In-degrees as sorted part files, read back."""
    path = shared_folder(spark, "degrees")
    writers.write_sorted(links.in_degree(tables.edges(spark, sf)), path, [F.desc("degree"), "dst"])
    return spark.read.schema("dst bigint, degree bigint").csv(path)


def signature_files(spark, sf) -> DataFrame:
    """The signature matrix as one line per hash function, read back value by value."""
    path = shared_folder(spark, "signatures")
    arrays = written_table(shingles.minhash_arrays(tables.documents(spark, sf), num_hashes=16), "signature-arrays")
    writers.write_signature_rows(arrays.select("doc_id", F.posexplode("signature").alias("hash_idx", "minhash")), path)
    cells = spark.read.schema("value string, hash_idx int").option("lineSep", ",").text(path)
    return cells.select("hash_idx", F.col("value").cast("bigint").alias("minhash"))


def link_files(spark, sf) -> DataFrame:
    """The links of one node as two comma-separated lines, read back value by value."""
    path = shared_folder(spark, "links")
    writers.write_links(links.node_links(tables.edges(spark, sf), 1), path)
    back = spark.read.schema("value string, direction string").option("lineSep", ",").text(path)
    return back.select("direction", F.col("value").cast("bigint").alias("neighbour"))


def news_file_texts(spark, sf) -> DataFrame:
    """Quoted CSV of the documents as they are, read back from several splits: every text, byte for byte."""
    path = shared_folder(spark, "news-texts")
    docs = tables.documents(spark, sf)
    news = docs.select(
        F.col("doc_id").alias("IDLink"),
        F.substring_index("text", "\n", 1).alias("Title"),
        F.col("text").alias("Headline"),
        F.lit("").alias("Source"),
        F.col("topic").alias("Topic"),
        F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("PublishDate"),
        *[F.lit(0.5).alias(c) for c in ("SentimentTitle", "SentimentHeadline", "Facebook", "GooglePlus", "LinkedIn")],
    )
    news.write.csv(path, header=True, **writers.QUOTED)
    read = delimited.read_news_with_breaks(spark, path)
    return read.select(F.col("IDLink").alias("doc_id"), "Title", "Headline", "Source", "Topic", F.to_date("PublishDate").alias("day"))


def word_files_by_case_and_day(spark, sf) -> DataFrame:
    """Words of every case and day as quoted files in a folder per case and day, read back as they were."""
    path = shared_folder(spark, "case-day-words")
    docs = tables.documents(spark, sf)
    cases = words.texts_as_cases(docs.select("day", F.substring_index("text", "\n", 1).alias("Title"), F.col("text").alias("Headline")), ["Title", "Headline"], ["day"])
    counts = words.word_count_by(cases, ["case", "day"])
    writers.write_per_key(counts, path, ["case", "day"], [F.desc("n"), F.asc("word")], quoted=True)
    back = quoted.read_quoted(spark, path, "word string, n bigint", header=False, sep=" ", keys=["case", "day"])
    return back.select("case", F.col("day").cast("date").alias("day"), "word", "n")


def word_files_by_case_and_topic(spark, sf) -> DataFrame:
    """Words of every case and topic as quoted files in a folder per case and topic, read back as they were."""
    path = shared_folder(spark, "case-topic-words")
    counts = words.word_count_by(tables.cases(spark, sf).where(F.col("topic").isin(tables.TOPICS)), ["case", "topic"])
    writers.write_per_key(counts, path, ["case", "topic"], [F.desc("n"), F.asc("word")], quoted=True)
    back = quoted.read_quoted(spark, path, "word string, n bigint", header=False, sep=" ", keys=["case", "topic"])
    return back.select("case", "topic", "word", "n")


def _article_file(spark, sf, name: str) -> DataFrame:
    """The documents as tagged articles in one file, in the order of ids, read back from splits."""
    path = shared_folder(spark, name)
    text = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    article = F.concat(F.lit('<REUTERS ID="'), "doc_id", F.lit('"><TEXT><BODY>'), text, F.lit("</BODY></TEXT></REUTERS>"))
    writers.write_single_text(tables.documents(spark, sf).select("doc_id", article.alias("article")), path, "article", ["doc_id"])
    return corpus.read_large_corpus(spark, path, closing_tag="</REUTERS>")


def article_file_ids(spark, sf) -> DataFrame:
    """Articles in one file in the order of ids, read back with the place of each in the file."""
    articles = _article_file(spark, sf, "numbered-articles")
    return articles.select("position", "body")


def article_file_signatures(spark, sf) -> DataFrame:
    """The signatures by all 256 functions of the articles of a file, named by their place in it."""
    articles = _article_file(spark, sf, "signed-articles").select(F.col("position").alias("doc_id"), F.col("body").alias("text"))
    found = shingles.minhash_signatures(articles, num_hashes=256)
    return found.select("hash_idx", F.col("doc_id").alias("position"), "minhash")


def matrix_files(spark, sf) -> DataFrame:
    """The matrices of all cases and topics as quoted files with a line of words, read back cell by cell."""
    path = shared_folder(spark, "matrices")
    keys = ["case", "topic"]
    cases = tables.cases(spark, sf)
    top = written_table(words.top_words_by_topic(cases, tables.TOPICS, keys=["case"]), "top-words")
    cells = words.cooccurrence_cells(cases, top, "doc_id", keys)
    writers.write_matrices(words.cooccurrence_matrices(cells, keys, 100), words.matrix_headers(top, keys, 100), path, keys, 100)
    names = [f"n{i}" for i in range(1, 101)]
    back = quoted.read_quoted(spark, path, ", ".join(f"{c} string" for c in ["word", *names]), header=False, keys=keys)
    head = back.where(F.col("word") == writers.CORNER).select(*keys, F.array(*names).alias("words"))
    body = back.where(F.col("word") != writers.CORNER).select(*keys, F.col("word").alias("word_a"), F.array(*names).alias("counts"))
    each = F.inline(F.arrays_zip(F.col("words").alias("word_b"), F.col("counts").cast("array<bigint>").alias("n")))
    return body.join(head, keys).select(*keys, "word_a", each).where("n > 0")


def signature_matrix_files(spark, sf) -> DataFrame:
    """The matrix of all 256 functions x documents as files of row pieces, read back with ids and places."""
    path = shared_folder(spark, "signature-matrix")
    arrays = shingles.minhash_arrays(tables.documents(spark, sf).select("doc_id", "text").orderBy("doc_id"), num_hashes=256)
    writers.write_matrix_pieces(shingles.signature_pieces(arrays, ordered=True), path)
    return shingles.matrix_cells(writers.read_matrix_pieces(spark, path))


def wide_average_files(spark, sf) -> DataFrame:
    """Files with a column for every hourly and every daily average, with header, read back row by row."""
    folder = shared_folder(spark, "averages")
    keys = ["entity", "block"]
    ticks = popularity.ticks_from_rows(tables.tick_rows(spark, sf), keys, "slot", "value")
    hours = written_table(popularity.hourly_means(ticks, keys), "hours")
    days = popularity.daily_means(hours, keys)
    kinds = {"hour": (hours, "hours", popularity.SLIDING_HOURS), "day": (days, "days", popularity.SLIDING_HOURS - popularity.HOURS_PER_DAY + 1)}
    found = []
    for kind, (series, values, count) in kinds.items():
        names = [f"avg_{kind}{i}" for i in range(1, count + 1)]
        writers.write_csv(popularity.as_columns(series, keys, values, f"avg_{kind}", count), f"{folder}/{kind}", header=True)
        columns_ = ", ".join(["entity string", "block int", *(f"{n} double" for n in names)])
        wide = delimited.read_delimited(spark, f"{folder}/{kind}", columns_, header=True)
        rows = popularity.as_rows(wide.select(*keys, F.array(*names).alias("values")), keys, "values", "average")
        found.append(rows.select(F.lit(kind).alias("kind"), *keys, "slot", F.round("average", 6).alias("average")))
    return found[0].unionByName(found[1])


def link_lines(spark, sf) -> DataFrame:
    """The links of one node as a text of two whole lines, read back line by line."""
    path = shared_folder(spark, "link-lines")
    writers.write_link_lines(links.node_links(tables.edges(spark, sf), 1), path)
    return spark.read.text(path)


def edge_file_in_degrees(spark, sf) -> DataFrame:
    """Distinct sources per target of a tab-separated edge file."""
    path = shared_folder(spark, "edges-in")
    spark.createDataFrame([(line,) for line in EDGE_COMMENTS], "value string").coalesce(1).write.text(path)
    tables.edges(spark, sf).write.mode("append").csv(path, sep="\t")
    return links.in_degree(delimited.read_edges(spark, path))


def edge_file_links(spark, sf) -> DataFrame:
    """Links of one node of a tab-separated edge file."""
    path = shared_folder(spark, "edges-of-node")
    spark.createDataFrame([(line,) for line in EDGE_COMMENTS], "value string").coalesce(1).write.text(path)
    tables.edges(spark, sf).write.mode("append").csv(path, sep="\t")
    return links.node_links(delimited.read_edges(spark, path), 1)


def _rating_file(spark, sf, name: str) -> DataFrame:
    path = shared_folder(spark, name)
    rating = F.concat_ws("::", "user", "item", F.col("rating").cast("int"), F.lit(978300760))
    tables.ratings(spark, sf).select(rating).write.text(path)
    return delimited.read_ratings(spark, path)


def rating_file_user_similarity(spark, sf) -> DataFrame:
    """Similarity of all users to one user, from a ratings file separated by ``::``."""
    found = similarity.user_similarity(_rating_file(spark, sf, "user-ratings"), 1, "UserID", "MovieID", "Rating")
    return found.select(F.col("UserID").alias("user"), F.round("similarity", 9).alias("similarity"))


def rating_file_item_similarity(spark, sf) -> DataFrame:
    """Similarity of all items to one item, from a ratings file separated by ``::``."""
    found = similarity.item_similarity(_rating_file(spark, sf, "item-ratings"), 1, "UserID", "MovieID", "Rating")
    return found.select(F.col("MovieID").alias("item"), F.round("similarity", 9).alias("similarity"))


QUERIES = [
    power_file_summary, news_file_word_counts, feedback_files_hourly, movie_files_average_rating, user_file_ages,
    edge_file_degrees, hire_files_forecast, gps_file_rides, zone_file_bounds, article_files_documents,
    word_files_by_topic, top_word_file, degree_files_sorted, signature_files, link_files,
    news_file_texts, word_files_by_case_and_day, article_file_ids, matrix_files, signature_matrix_files,
    word_files_by_case_and_topic, article_file_signatures, hire_files_forest,
    word_count_file, signature_coefficients, wide_average_files, link_lines, edge_file_in_degrees, edge_file_links, rating_file_user_similarity, rating_file_item_similarity,
]
