import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymill.operators import links, scores, words
from tallymill.sinks import writers
from tallymill.sources import corpus, delimited


def joined(folder):
    """The part files of a folder put together in name order."""
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def put(folder, name, text):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_power_question_marks_become_null(spark, tmp_path):
    header = "Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;Sub_metering_1;Sub_metering_2;Sub_metering_3\n"
    path = put(tmp_path / "p", "power.txt", header + "1/1/2007;00:00:00;4.0;0.1;240.5;?;;1;2\n1/1/2007;00:01:00;?;0.2;x;1;1;1;2\n")
    first, second = delimited.read_power(spark, path).collect()
    assert first.Global_active_power == 4.0 and first.Global_intensity is None and first.Sub_metering_1 is None
    assert second.Global_active_power is None and second.Voltage is None and second.Sub_metering_3 == 2.0


def test_news_quotes(spark, tmp_path):
    header = "IDLink,Title,Headline,Source,Topic,PublishDate,SentimentTitle,SentimentHeadline,Facebook,GooglePlus,LinkedIn\n"
    path = put(tmp_path / "n", "news.csv", header + '7,"He said ""no"", twice",Plain,S,obama,2016-01-02 03:04:05,0.1,-0.2,5,-1,0\n8,t,h,s,economy,,0,0,0,0,0\n')
    first, second = delimited.read_news(spark, path).collect()
    assert first.Title == 'He said "no", twice' and first.PublishDate == datetime.datetime(2016, 1, 2, 3, 4, 5)
    assert second.PublishDate is None and second.Topic == "economy"


def test_feedback_glob_and_platform(spark, tmp_path):
    for name in ("Facebook_Economy", "Facebook_Obama", "LinkedIn_Obama", "Other_Obama"):
        put(tmp_path / "f", f"{name}.csv", "IDLink,TS1,TS2,TS3\n1,3,,9\n")
    df = delimited.read_feedback(spark, str(tmp_path / "f"), ticks=3)
    got = sorted((r.platform, r.TS1, r.TS2) for r in df.collect())
    assert got == [("Facebook", 3.0, None), ("Facebook", 3.0, None), ("LinkedIn", 3.0, None)]


def test_double_colon_files(spark, tmp_path, rows):
    movies = put(tmp_path / "m", "movies.dat", "1::Toy Story, The (1995)::Animation|Comedy\n2::\"Odd\" one::Drama\n")
    ratings = put(tmp_path / "r", "ratings.dat", "1::1::4::978300760\n2::1::5::978300761\n1::2::3::978300762\n")
    users = put(tmp_path / "u", "users.dat", "1::F::25::10::48067\n")
    read = delimited.read_movies(spark, movies)
    assert [(r.Title, r.Genre) for r in read.orderBy("MovieID").collect()] == [
        ("Toy Story, The (1995)", ["Animation", "Comedy"]), ('"Odd" one', ["Drama"]),
    ]
    rated = scores.average_rating(delimited.read_ratings(spark, ratings), read, "MovieID", "Rating", "Title")
    assert [(r.MovieID, r.average) for r in rated.collect()] == [(1, 4.5), (2, 3.0)]
    assert tuple(delimited.read_users(spark, users).first()) == (1, "F", 25, 10, 48067)


def test_edges_keep_the_first_line(spark, tmp_path, rows):
    path = put(tmp_path / "e", "edges.txt", "# a\n# b\n# FromNodeId\tToNodeId\n0\t1\n0\t1\n0\t2\n3\t0\n")
    assert rows(delimited.read_edges(spark, path)) == [(0, 1), (0, 1), (0, 2), (3, 0)]


def test_hires_gps_and_zones(spark, tmp_path):
    train = put(tmp_path / "a", "x.csv", "Zone_ID,Date,Hour_slot,Hire_count\n1,2016-02-01,8,300\n300,2016-02-01,8,1\n")
    test = put(tmp_path / "b", "x.csv", "Test_ID,Zone_ID,Date,Hour_slot,Hire_count\n5,1,2016-02-02,9,\n")
    gps = put(tmp_path / "c", "x.csv", "Datetime,Longitude_X,Latitude_Y,Zone_ID\n2016-02-01 08:15:30.123,1.5,2.5,4\nnonsense,1,1,4\n")
    zones = put(tmp_path / "d", "x.csv", "Zone_ID,left,top,right,bottom\n1,0,9,5,4\n")
    day = datetime.date(2016, 2, 1)
    assert {tuple(r) for r in delimited.read_hires(spark, train).collect()} == {(1, day, 8, 300), (300, day, 8, 1)}
    assert tuple(delimited.read_hire_tests(spark, test).first()) == (5, 1, datetime.date(2016, 2, 2), 9, None)
    good, bad = delimited.read_gps(spark, gps).collect()
    assert tuple(good) == (datetime.datetime(2016, 2, 1, 8, 15, 30), "2016-02-01", 1.5, 2.5, 4)
    assert bad.moment is None and bad.zone == 4
    assert delimited.read_zones(spark, zones).first().asDict() == {"zone": 1, "left": 0.0, "top": 9.0, "right": 5.0, "bottom": 4.0}


ARTICLES = (
    '<!DOCTYPE x>\n<REUTERS ID="1"><TEXT><TITLE>t</TITLE><BODY>First, line.\n &lt;b&gt; &amp;lt; end</BODY></TEXT></REUTERS>\n'
    '<REUTERS ID="2"><TEXT>no text tag</TEXT></REUTERS>\n'
    '<reuters ID="3"><body>lower <i>cut</i></body></reuters>\n<REUTERS ID="4"><BODY></BODY></REUTERS>\n'
)


def test_corpus_of_small_files(spark, tmp_path):
    path = put(tmp_path / "c", "one.sgm", ARTICLES)
    put(tmp_path / "c", "two.sgm", '<REUTERS ID="9"><BODY>other</BODY></REUTERS>')
    docs = corpus.read_corpus(spark, path).orderBy("file", "position").collect()
    assert [(d.file, d.position, d.words) for d in docs] == [
        ("one.sgm", 0, ["first", "line", "<b>", "&lt;", "end"]),
        ("one.sgm", 1, []), ("one.sgm", 2, ["lower"]), ("one.sgm", 3, []), ("two.sgm", 0, ["other"]),
    ]


def test_corpus_of_large_files_is_split_between_records(spark, tmp_path):
    text = "".join(f'<REUTERS ID="{i}"><BODY>article {i} {"x" * (i % 50)}</BODY></REUTERS>\n' for i in range(2000))
    path = put(tmp_path / "c", "big.sgm", "<!DOCTYPE x>\n" + text)
    small_splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        docs = corpus.read_large_corpus(spark, path, closing_tag="</REUTERS>")
        assert docs.rdd.getNumPartitions() > 4
        got = docs.orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small_splits)
    assert [d.words[:2] for d in got] == [["article", str(i)] for i in range(2000)]
    assert len({d.position for d in got}) == 2000


def test_sorted_parts_join_to_the_sorted_whole(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    writers.write_sorted(df, str(tmp_path / "s"), ["v"])
    assert joined(tmp_path / "s") == "".join(f"{i}\n" for i in range(1000))


def test_word_count_lines(spark, tmp_path):
    df = spark.createDataFrame([("a b a",)], "text string")
    writers.write_word_counts(words.word_count_total(df), str(tmp_path / "w"))
    assert joined(tmp_path / "w") == "a 2\nb 1\n"


def test_one_folder_per_key_even_if_one_key_is_hot(spark, tmp_path):
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.concat(F.lit("w"), "id").alias("word"), F.col("id").alias("n"))
    cold = spark.range(10).select(F.lit("cold").alias("k"), F.concat(F.lit("w"), "id").alias("word"), F.col("id").alias("n"))
    writers.write_per_key(hot.union(cold).repartition(8), str(tmp_path / "k"), ["k"], [F.desc("n")])
    lines = joined(tmp_path / "k" / "k=hot").splitlines()
    assert lines == [f"w{i} {i}" for i in reversed(range(3000))]
    assert len(joined(tmp_path / "k" / "k=cold").splitlines()) == 10


def test_single_file_with_header_and_limit(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, w string").repartition(4)
    writers.write_single(df, str(tmp_path / "o"), ["n"], header=True)
    assert joined(tmp_path / "o") == "n,w\n1,a\n2,b\n" and len(list((tmp_path / "o").glob("part-*"))) == 1
    with pytest.raises(ValueError):
        writers.write_single(df, str(tmp_path / "x"), ["n"], max_rows=1)


def test_signature_rows(spark, tmp_path):
    df = spark.createDataFrame([(2, 0, 5), (1, 0, 7), (1, 1, 8), (2, 1, 9)], "doc_id int, hash_idx int, minhash bigint")
    writers.write_signature_rows(df, str(tmp_path / "m"))
    assert joined(tmp_path / "m" / "hash_idx=0") == "7,5," and joined(tmp_path / "m" / "hash_idx=1") == "8,9,"


def test_link_lines(spark, tmp_path):
    edges = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (3, 0)], "src int, dst int")
    writers.write_links(links.node_links(edges, 0), str(tmp_path / "l"))
    assert joined(tmp_path / "l" / "direction=out") == "1,1,2," and joined(tmp_path / "l" / "direction=in") == "3,"


def test_large_ids_and_counts_survive(spark, tmp_path):
    edges = tmp_path / "edges.txt"
    edges.write_text("# comment\n3000000000\t1\n3000000001\t1\n")
    assert sorted(r[0] for r in delimited.read_edges(spark, str(edges)).collect()) == [3000000000, 3000000001]
    train = tmp_path / "train.csv"
    train.write_text("Zone_ID,Date,Hour_slot,Hire_count\n300,2016-02-01,8,40000\n")
    row = delimited.read_hires(spark, str(train)).first()
    assert (row.zone, row.hires) == (300, 40000)


def test_records_without_closing_tag_are_kept(spark, tmp_path):
    path = tmp_path / "open"
    path.mkdir()
    (path / "a.sgm").write_text(
        "<REUTERS><BODY>one</BODY></REUTERS><reuters><body>two</body></reuters>"
        "<REUTERS><BODY>three</BODY><REUTERS><BODY>four</BODY>"
    )
    small = corpus.read_corpus(spark, str(path)).orderBy("position")
    large = corpus.read_large_corpus(spark, str(path), closing_tag="</REUTERS>").orderBy("position")
    assert [r.body for r in small.collect()] == [r.body for r in large.collect()] == ["one", "two", "three", "four"]


def in_splits(spark, size, build):
    setting = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in setting}
    for k, v in setting.items():
        spark.conf.set(k, v)
    try:
        return build().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_record_ids_do_not_depend_on_the_splits(spark, tmp_path):
    for name, n in (("a.sgm", 300), ("b.sgm", 7)):
        text = "".join(f'<REUTERS ID="{i}"><BODY>{name} {i}</BODY>{"</REUTERS>" if i % 5 else ""}\n' for i in range(n))
        put(tmp_path / "c", name, "<!DOCTYPE x>\n" + text)
    read = lambda: corpus.read_large_corpus(spark, str(tmp_path / "c"), closing_tag="</REUTERS>")
    expected = [(name, i, f"{name} {i}") for name, n in (("a.sgm", 300), ("b.sgm", 7)) for i in range(n)]
    for size in ("128m", "4k", "700b"):
        assert sorted((r.file, r.position, r.body.strip()) for r in in_splits(spark, size, read)) == expected


def test_whole_lines_without_trailing_commas(spark, tmp_path):
    edges = spark.range(5000).select(F.lit(0).alias("src"), F.col("id").alias("dst")).union(spark.range(3, 4).select("id", F.lit(0)))
    writers.write_link_lines(links.node_links(edges, 0), str(tmp_path / "l"))
    assert joined(tmp_path / "l") == ",".join(map(str, sorted([*range(5000)]))) + "\n0,3\n"
    empty = links.node_links(edges, 77_777)
    writers.write_link_lines(empty, str(tmp_path / "l"))
    assert joined(tmp_path / "l") == "\n\n"


def test_single_file_is_joined_from_sorted_parts(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 'a,"b').otherwise("c").alias("odd, name"))
    writers.write_single(df.repartition(7), str(tmp_path / "o"), [F.desc("id")], header=True)
    (part,) = (tmp_path / "o").glob("part-*")
    lines = part.read_text().splitlines()
    assert lines[0] == 'id,"odd, name"' and [int(line.split(",")[0]) for line in lines[1:]] == list(range(999, -1, -1))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "o"), header=True, escape="\\", schema="id bigint, x string").limit(1).collect()] == [(999, 'a,"b')]
    writers.write_single(df.limit(0), str(tmp_path / "o"), ["id"], header=True)
    assert joined(tmp_path / "o") == 'id,"odd, name"\n'


def test_signature_matrix_in_pieces(spark):
    from tallymill.operators import shingles

    df = spark.createDataFrame([(i * 3, f"w{i} x y z w{i % 5}") for i in range(101)] + [(None, "a b c")], "doc_id bigint, text string")
    arrays = shingles.minhash_arrays(df, num_hashes=7)
    ordered = sorted((r for r in arrays.collect() if r.doc_id is not None), key=lambda r: r.doc_id)
    expected = sorted((h, at, r.doc_id, r.signature[h]) for at, r in enumerate(ordered) for h in range(7))
    for block in (4096, 10):
        cells = shingles.matrix_cells(shingles.signature_pieces(arrays, block=block))
        assert sorted(tuple(r) for r in cells.collect()) == expected


def test_matrix_files_have_a_line_of_words(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "a a  b"), (2, "u", "c")], "doc_id int, topic string, text string")
    top = words.top_words_by_topic(df, ["t", "u"], 3)
    matrices = words.cooccurrence_matrices(words.cooccurrence_cells(df, top, "doc_id", ["topic"]), ["topic"], 3)
    writers.write_matrices(matrices, words.matrix_headers(top, ["topic"], 3), str(tmp_path / "m"), ["topic"], 3)
    assert joined(tmp_path / "m" / "topic=t") == '"word_word","a","","b"\n"a","4","2","2"\n"","2","1","1"\n"b","2","1","1"\n'
    assert joined(tmp_path / "m" / "topic=u").splitlines()[1] == '"c","1","0","0"'


def test_matrix_pieces_fill_few_files(spark, tmp_path):
    from tallymill.operators import shingles

    df = spark.createDataFrame([(i, f"w{i} x y z w{i % 5}") for i in range(300)], "doc_id bigint, text string").repartition(6)
    arrays = shingles.minhash_arrays(df.orderBy("doc_id"), num_hashes=4)
    pieces = shingles.signature_pieces(arrays, block=10, ordered=True).repartition(6)
    writers.write_matrix_pieces(pieces, str(tmp_path / "m"))
    assert all(len([*(tmp_path / "m" / f"row={i}").glob("part-*")]) == 1 for i in range(-1, 4))
    cells = shingles.matrix_cells(writers.read_matrix_pieces(spark, str(tmp_path / "m")))
    found = sorted((r.position, r.doc_id, r.hash_idx, r.minhash) for r in cells.collect())
    assert found == sorted((r.doc_id, r.doc_id, i, v) for r in arrays.collect() for i, v in enumerate(r.signature))


def test_bodies_of_a_large_corpus_are_not_shuffled(spark, tmp_path):
    put(tmp_path / "c", "a.sgm", "".join(f"<REUTERS><BODY>{i}</BODY></REUTERS>" for i in range(20)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = corpus.read_large_corpus(spark, str(tmp_path / "c"), closing_tag="</REUTERS>")
        assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
