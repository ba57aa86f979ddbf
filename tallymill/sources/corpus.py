"""Tagged article files: records between tags, with the text in an inner tag.

Subset of markup understood: a record goes from its opening tag to its closing tag, the next
opening tag or the end, tag names go in any case and may carry attributes, the text of a record is what stands between its first text tag and
the next tag, and the five predefined entities are decoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallymill.functions.text import with_plain_words
from tallymill.session import written_table
from tallymill.sources import schemas

# Predefined entities, the ampersand last so that nothing is decoded twice.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def records(df: DataFrame, text: str, keep: list[str], record_tag: str = schemas.RECORD_TAG) -> DataFrame:
    """(keep..., position, record): every tagged record of a text, numbered from 0."""
    pattern = rf"(?is)<{record_tag}\b[^>]*>(.*?)(?=</{record_tag}\s*>|<{record_tag}\b|\z)"
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    return df.select(*keep, F.posexplode_outer(found).alias("position", "record")).where(F.col("position").isNotNull())


def body_text(record: Column, body_tag: str = schemas.BODY_TAG) -> Column:
    """Text after the first body tag up to the next tag; empty if there is no such tag."""
    text = F.regexp_extract(record, rf"(?is)<{body_tag}\b[^>]*>([^<]*)", 1)
    for entity, mark in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(mark))
    return text


def corpus_documents(
    df: DataFrame, text: str, keep: list[str], record_tag: str = schemas.RECORD_TAG, body_tag: str = schemas.BODY_TAG
) -> DataFrame:
    """(keep..., position, body, words) of every record; a record without body has no words."""
    bodies = records(df, text, keep, record_tag).select(*keep, "position", body_text(F.col("record"), body_tag).alias("body"))
    return with_plain_words(bodies, "body", [*keep, "position", "body"])


def read_corpus(spark: SparkSession, path, record_tag: str = schemas.RECORD_TAG, body_tag: str = schemas.BODY_TAG) -> DataFrame:
    """(file, position, body, words) of a folder of small files, one task row per file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return corpus_documents(files, "value", ["file"], record_tag, body_tag)


def read_large_corpus(spark: SparkSession, path, closing_tag: str, body_tag: str = schemas.BODY_TAG) -> DataFrame:
    """(file, position, body, words) of files of any size, cut at the exact closing tag.

    A file is split over tasks between records; a piece holds several records where closing
    tags are missing or written otherwise, and all of them are returned. ``position`` counts the
    records of a file from 0, however it was split: records are numbered within their split, and the
    numbers of records in the splits before are added, a table of one row per split, which goes to the
    records. The records are written once, so that both counts speak of the same reading.
    """
    pieces = spark.read.text(path, lineSep=closing_tag).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )
    own = ["file", "split"]
    found = records(pieces, "value", own, closing_tag.strip("</>")).drop("position")
    found = written_table(found.withColumn("n", F.monotonically_increasing_id()), "records")
    # Numbers run on within a split, as one task reads it from end to end.
    splits = found.groupBy(*own).agg(F.min("n").alias("least"), F.count("*").alias("records"))
    before = F.sum("records").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    shift = splits.select(*own, (F.coalesce(before, F.lit(0)) - F.col("least")).alias("shift"))
    bodies = found.join(F.broadcast(shift), own).select("file", (F.col("n") + F.col("shift")).alias("position"), body_text(F.col("record"), body_tag).alias("body"))
    return with_plain_words(bodies, "body", ["file", "position", "body"])
