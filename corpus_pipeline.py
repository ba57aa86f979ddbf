"""From documents to packed sequences: language ID, near-dedup, pseudonyms, mixing and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallymill.llm import langid, mixing, packing, pii, queries, simhash
from tallymill.session import written_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.

    Dictionaries are learned from the labelled documents that are not held out. Rejected are texts
    that are null or have no letter, and those for which two languages are too close to tell. Every row is
    judged for itself by its text: repeated rows stay or go together, ids are not looked at but to hold rows out. Without
    any labelled document no language is known and all are rejected. An empty table stays empty.
    """
    learned = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    whole = docs.select(F.struct("*").alias("row"))
    told = whole.withColumn("p", langid.identify(F.col("row.text"), learned))
    return told.where(~F.col("p.rejected")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: the one with the smallest id.

    Fingerprints of 3-word shingles link at 3 or fewer differing bits. Texts that are null or have no
    words are one group. Of rows with the same id and fingerprint, equal ones included, the first by
    the hash of the row stays; null ids come last. An empty table stays empty.
    """
    rows = docs.select(F.struct("*").alias("row"))
    keys = ["none", "id", "h"]
    name = [F.col("row.doc_id").isNull().alias("none"), F.coalesce("row.doc_id", F.lit(0)).alias("id"), F.xxhash64("row").alias("h")]
    found = simhash.near_duplicates(rows.select(F.struct(*name).alias("name"), F.col("row.text").alias("text")), "name", "text")
    chosen = found.where("name = component_id").select("name.*").distinct()
    return rows.select("row", *name).join(chosen, keys, "left_semi").dropDuplicates(keys).select("row.*")


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; ``n_chars`` is counted anew where the text changed.

    Every row stays, null and empty texts as they are; repeated rows get the same pseudonyms. An empty table stays empty.
    """
    whole = docs.select(F.struct("*").alias("row"), pii.pseudonymise(F.col("text"), queries.PSEUDONYM_KEY).alias("p"))
    changed = F.size("p.found") > 0
    n_chars = F.when(changed, F.length("p.text")).otherwise(F.col("row.n_chars"))
    row = F.col("row").withField("text", F.col("p.text")).withField("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return whole.select(row.alias("row")).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in the order of its slots, each as often as the mix starts on it.

    A document of which the mix takes some words in a turn is there for that turn, whole, at the first
    of its slots: a source exceeds its target by part of one document. Those it takes no word of go. Rows that agree
    in id, source and size, repeated rows included, are exchangeable, and are paired off in the order of
    their hash. An empty table stays empty.
    """
    used = mixing.Mix(docs).uses()

    def name(doc_id, source, size):
        columns = [(F.col(doc_id), 0), (F.col(source), "")]
        nulls = [c.isNull().alias(f"none{i}") for i, (c, _) in enumerate(columns)]
        return [*nulls, *(F.coalesce(c, F.lit(v)).alias(f"key{i}") for i, (c, v) in enumerate(columns)), size.alias("size")]

    keys = ["none0", "none1", "key0", "key1", "size"]
    used = used.select(*name("id", "source", F.col("size")), "uses")
    used = used.groupBy(*keys).agg(F.sort_array(F.collect_list("uses")).alias("uses"))
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", *name("row.doc_id", "row.source", mixing.words(F.col("row.text"))), F.xxhash64("row").alias("h"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("h")))
    starts = rows.join(used, keys).select("row", "h", F.explode(F.get("uses", F.col("place") - 1)).alias("start"))
    return starts.orderBy("start", "h").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 2,048 ids.

    A null text is an empty one, which has the closing id only. Each of repeated rows has pieces of its own, under the
    same id; so have rows with a null id. An empty table gives no pieces.
    """
    return packing.pack(docs, queries.WORD_BPE)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("pseudonyms", pseudonyms), ("mixing", mix), ("packing", pack)]

#: SQL has no language models, Feistel rounds or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each on what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
