"""Text cleaning and tokenising, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# What counts as noise in a text.
NOT_LETTER_OR_SPACE = r"[^a-z\s]"
SENTENCE_MARKS = ",."


def letters_only(text: Column) -> Column:
    """Lower-case and delete (not blank out) everything but a-z and whitespace."""
    return F.regexp_replace(F.lower(text), NOT_LETTER_OR_SPACE, "")


def space_words(text: Column) -> Column:
    """Words between single spaces; two spaces in a row enclose an empty word."""
    return F.split(letters_only(text), " ")


def _settled(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def lowered_bytes(text: Column) -> Column:
    """The lower-cased text as bytes; null becomes empty."""
    return F.lower(F.coalesce(text, F.lit(""))).cast("binary")


def with_plain_words(df: DataFrame, text: str, keep: list[str], name: str = "words") -> DataFrame:
    """(keep..., name): the words between runs of ASCII whitespace, lower-cased, without commas and full stops.

    A word made of such marks only becomes the empty word but keeps its place, so the
    marks go after the whitespace has been settled. Null or blank text has no words.
    The settled text is a column of its own: it is used twice and costs a regular expression.
    """
    settled = df.select(*keep, _settled(F.col(text)).alias("settled"))
    words = F.split(F.translate("settled", SENTENCE_MARKS, ""), " ")
    present = F.when(F.col("settled") != "", words).otherwise(F.array().cast("array<string>"))
    return settled.select(*keep, present.alias(name))
