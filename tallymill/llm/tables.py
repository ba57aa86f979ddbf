"""Written tables that are laid out by a key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallymill.session import shared_folder


def bucketed_table(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of ``key`` and read it from there.

    Grouping or joining the table by ``key`` moves only the other side. There are as many buckets
    as ``spark.sql.shuffle.partitions`` says, so that setting has to suit the data.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("path", shared_folder(spark, name)).option("compression", "zstd")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)
