"""The test tables and the inputs of the analyses derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values of the queries.
TOPICS = ["de", "en", "es", "fr"]
ZONES = 25
FIRST_DAY = "2024-01-01"
TRAIN_DAYS = 23
BLOCK_DAYS = 2


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_spread(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table for work that is heavy per row, on at least as many partitions as there are cores.

    Fewer splits than cores means a small input (a split has a size limit) that would
    leave cores idle; a large one is left as the scan cuts it.
    """
    df = load(spark, folder, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text, topic, day): the language stands for the topic, the day goes by the id."""
    df = load_spread(spark, folder, "documents", "doc_id", "text", "lang")
    day = F.date_add(F.lit("2015-11-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return df.select("doc_id", "text", F.col("lang").alias("topic"), day.alias("day"))


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, topic, case, text): the first line of a document is its title, the whole text its headline."""
    docs = documents(spark, folder)
    both = F.array(
        F.struct(F.lit("Title").alias("case"), F.substring_index("text", "\n", 1).alias("text")),
        F.struct(F.lit("Headline").alias("case"), F.col("text")),
    )
    return docs.select("doc_id", "topic", F.inline(both))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """(topic, quality, toxic) of the labelled documents."""
    topics = load(spark, folder, "documents").select("doc_id", F.col("lang").alias("topic"))
    return topics.join(load(spark, folder, "labels"), "doc_id")


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """(zone, day, hour): every event is a ride, the user id picks the zone."""
    zone = (F.col("user_id") % ZONES + 1).cast("int")
    return load(spark, folder, "events").select(
        zone.alias("zone"), F.to_date("ts").alias("day"), F.hour("ts").alias("hour")
    )


def hires(spark: SparkSession, folder: str) -> DataFrame:
    """(zone, day, hour, hires): rides of a zone in one hour."""
    return rides(spark, folder).groupBy("zone", "day", "hour").agg(F.count("*").alias("hires"))


def hire_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Training rows of the first days, and the later rows with a running test_id."""
    rows = hires(spark, folder)
    first = F.lit(FIRST_DAY).cast("date")
    border = F.date_add(first, TRAIN_DAYS)
    number = (F.date_diff("day", first) * 24 + F.col("hour")) * ZONES + F.col("zone")
    return rows.where(F.col("day") < border), rows.where(F.col("day") >= border).withColumn("test_id", number)


def order_hires(spark: SparkSession, folder: str) -> DataFrame:
    """(day, hires): orders per order date."""
    orders = load(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    return orders.groupBy("day").agg(F.count("*").alias("hires"))


def tick_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(entity, block, slot, value): event values in the 20-minute slots of two-day blocks."""
    ts = F.col("ts")
    age = F.date_diff(F.to_date(ts), F.lit(FIRST_DAY).cast("date"))
    minute = (age % BLOCK_DAYS) * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return load(spark, folder, "events").select(
        F.col("event_type").alias("entity"),
        F.floor(age / BLOCK_DAYS).cast("int").alias("block"),
        (F.floor(minute / 20) + 1).cast("int").alias("slot"),
        "value",
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """(user, item, rating): customers rate parts by the ordered quantity."""
    orders = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"))
    lines = load(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), F.col("l_quantity").alias("rating"))
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """(src, dst): links from parts to suppliers."""
    return load(spark, folder, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def points(spark: SparkSession, folder: str) -> DataFrame:
    """(zone, x, y): the first two components of the embeddings, the label as zone."""
    return load(spark, folder, "embeddings").select(
        F.col("label").alias("zone"), F.get("embedding", 0).alias("x"), F.get("embedding", 1).alias("y")
    )
