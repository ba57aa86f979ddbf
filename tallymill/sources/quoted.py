"""Quoted CSV with line breaks inside fields, read from splits of a file.

A line break ends a record only outside quotes. Whether a split begins inside quotes is told by the
number of quotes in all splits before it, so these are counted per split and added up; then each
split is cut for itself, and only records of several lines are put together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallymill.session import written_table

#: Stands for an empty quoted field while a record is parsed; a control character that texts do not consist of.
_EMPTY = "\u0001"


def _lines(spark: SparkSession, path, quote: str, keys: list[str]) -> DataFrame:
    """(file, split, n, value, quotes): the lines of all files; n grows within a split."""
    lines = spark.read.text(path, lineSep="\n")
    file = F.struct(F.col("_metadata.file_path").alias("path"), *[F.col(k).cast("string").alias(k) for k in keys])
    lines = lines.select(file.alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return lines.withColumns({"n": F.monotonically_increasing_id(), "quotes": quotes})


def quoted_records(spark: SparkSession, path, quote: str = '"', keys: list[str] | None = None) -> DataFrame:
    """(file, split, n, record): one row per record, which may hold line breaks between quotes.

    ``file`` holds the path and, from folders named ``key=value``, the ``keys``. (split, n) orders the records of a file. Empty lines between records are left out; a quote
    that is never closed makes one record of all that follows in its file. The lines are
    shuffled by split, never by file, and written once with the numbers of their records.
    """
    lines = _lines(spark, path, quote, keys or [])
    own, splits = ["file", "split"], Window.partitionBy("file").orderBy("split")
    earlier = splits.rowsBetween(Window.unboundedPreceding, -1)
    counted = written_table(lines.groupBy(*own).agg(F.sum("quotes").alias("quotes")), "split-quotes")
    entering = counted.select(*own, F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("entering"))

    inside = Window.partitionBy(*own).orderBy("n")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = ((F.col("entering") + before) % 2 == 0).cast("long")
    numbered = lines.join(entering, own).withColumn("begins", begins)
    number = F.sum("begins").over(inside).alias("number")
    numbered = numbered.select(*own, "n", number, "begins", "value", (F.col("quotes") % 2).alias("odd"))
    numbered = written_table(numbered, "numbered-lines")

    # A line that begins a record and has an even number of quotes is the whole of it.
    alone = (F.col("begins") == 1) & (F.col("odd") == 0)
    whole = numbered.where(alone).select(*own, "n", F.col("value").alias("record"))
    line = F.struct("split", "n", "value").alias("line")
    inner = numbered.where(~alone & (F.col("number") > 0)).select("file", F.struct("split", "number").alias("key"), line)
    # The head of a split goes on with the last record of the last split before it in which one begins.
    last = numbered.groupBy(*own).agg(F.max("number").alias("number"))
    begun = F.last(F.when(F.col("number") > 0, F.struct("split", "number")), ignorenulls=True).over(earlier)
    heads = numbered.where("number = 0").join(last.select(*own, begun.alias("key")), own).select("file", "key", line)
    several = inner.unionByName(heads).groupBy("file", "key").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    first = F.col("lines").getItem(0)
    joined = F.array_join(F.transform("lines", lambda x: x.value), "\n").alias("record")
    records = whole.unionByName(several.select("file", first.split.alias("split"), first.n.alias("n"), joined))
    return records.where("record <> ''")


def read_quoted(
    spark: SparkSession, path, schema: str, header: bool = True, sep: str = ",", quote: str = '"', keys: list[str] | None = None
) -> DataFrame:
    """The rows of quoted CSV files of any size, with quotes doubled and line breaks kept inside quoted fields.

    With a header the first record of every file is left out. An empty quoted field is an empty text, an empty
    field without quotes null, as are values that do not fit their type. ``keys`` are columns from
    the names of folders, as texts.
    """
    keys = keys or []
    records = quoted_records(spark, path, quote, keys)
    if header:
        first = records.groupBy("file").agg(F.min(F.struct("split", "n")).alias("first")).select("file", "first.*")
        records = records.join(first, ["file", "split", "n"], "left_anti")
    options = {"sep": sep, "quote": quote, "escape": quote, "emptyValue": _EMPTY}
    row = records.select(*[F.col("file").getField(k).alias(k) for k in keys], F.from_csv("record", schema, options).alias("row"))
    row = row.select(*keys, "row.*")
    texts = [f.name for f in row.schema.fields if f.dataType.simpleString() == "string" and f.name not in keys]
    return row.withColumns({t: F.when(F.col(t) == _EMPTY, "").otherwise(F.col(t)) for t in texts})
