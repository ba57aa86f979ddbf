"""Quoted CSV with line breaks, read from splits of several sizes."""

import random

import pytest

from tallymill.sources import quoted

SCHEMA = "id bigint, a string, b string"


def field(value):
    return '""' if value == "" else '"' + value.replace('"', '""') + '"'


def some_rows(seed, n):
    draw = random.Random(seed)
    marks = ['"', "\n", ",", "x", "long " * 30, "\r\n", '""', "é", " ", "\\"]
    text = lambda: "".join(draw.choice(marks) for _ in range(draw.randrange(6)))
    return [(i, text(), text()) for i in range(n)]


@pytest.mark.parametrize("split", ["128m", "1k", "90b", "16b"])
def test_texts_come_back_byte_for_byte(spark, tmp_path, split):
    rows = some_rows(1, 120) + [(120, "\n" * 500 + '"', "after a long one"), (121, "", "")]
    for part, own in enumerate((rows[:100], rows[100:])):
        lines = [",".join([str(i), field(a), field(b)]) + "\n" for i, a, b in own]
        with open(tmp_path / f"part{part}.csv", "w", newline="", encoding="utf-8") as out:
            out.write('id,"a\nbroken header",b\n\n' + "".join(lines))
    setting, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(setting, split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = [tuple(r) for r in quoted.read_quoted(spark, str(tmp_path), SCHEMA).collect()]
    finally:
        spark.conf.set(setting, before)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    assert sorted(got) == rows


def test_fields_without_quotes_and_an_open_quote(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,x,\n2,,"y\nz"\nbad,"",t\n3,"never\n4,closed')
    got = [tuple(r) for r in quoted.read_quoted(spark, str(tmp_path), SCHEMA, header=False).collect()]
    assert (1, "x", None) in got and (2, None, "y\nz") in got and (None, "", "t") in got and len(got) == 4


def test_no_file_rows_and_keys_of_folders(spark, tmp_path):
    (tmp_path / "k=p" / "l=1").mkdir(parents=True)
    (tmp_path / "k=p" / "l=1" / "part.csv").write_text('1,"a\nb",c\n')
    (tmp_path / "k=q" / "l=2").mkdir(parents=True)
    (tmp_path / "k=q" / "l=2" / "part.csv").write_text("")
    got = [tuple(r) for r in quoted.read_quoted(spark, str(tmp_path), SCHEMA, header=False, keys=["k", "l"]).collect()]
    assert got == [("p", "1", 1, "a\nb", "c")]
