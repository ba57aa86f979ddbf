"""The single-file writer takes results of any size."""

from tallymill.sinks import writers


def test_more_than_a_million_rows(spark, tmp_path):
    writers.write_single(spark.range(1_000_001), str(tmp_path / "o"), ["id"])
    (part,) = (tmp_path / "o").glob("part-*")
    assert sum(1 for _ in part.open()) == 1_000_001
