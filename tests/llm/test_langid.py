"""The sample behind a language's dictionary."""

from tallymill.llm import langid


def test_every_sampled_text_is_in_the_dictionary(spark):
    rows = [("en", f"word{i} " + "abcdefghi " * (3 if i % 4 else 300)) for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    learned = langid.fit(docs)["en"]
    lines = learned.split(b"\n")
    assert len(lines) == langid.SAMPLE_TEXTS and len(learned) <= langid.DICTIONARY_BYTES and all(x.startswith(b"word") for x in lines)


def test_shares():
    assert langid._shared_out([b"a" * 9, b"b", b"c" * 9], 15) == b"aaaaaa\nb\ncccccc"
    assert langid._shared_out([b"ab", b"c"], 100) == b"ab\nc"
