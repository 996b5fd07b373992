"""The two line-delimited JSON feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schemas import PRODUCT_FEED, REVIEW_FEED


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review feed under its fixed schema; compressed files are recognised by their suffix."""
    return _read(spark, path, REVIEW_FEED)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product feed under its fixed schema."""
    return _read(spark, path, PRODUCT_FEED)


#: Columns of a feed read with its faulty lines: the line as it is and its file, NULL for a line without faults.
LINE, FILE = "_line", "_file"

#: Layout of the faulty lines of a run.
QUARANTINE = "feed STRING, reason STRING, file STRING, line STRING"


def read_with_faults(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """A feed like the readers above, and with LINE and FILE where a line can't be read or has values of wrong types."""
    raw = spark.read.json(
        path, schema=f"{layout}, {LINE} STRING", mode="PERMISSIVE", columnNameOfCorruptRecord=LINE
    )
    return raw.withColumn(FILE, F.when(F.col(LINE).isNotNull(), F.col("_metadata.file_path")))


def faults(parsed: DataFrame, feed: str) -> DataFrame:
    """The faulty lines of a stored result of :func:`read_with_faults`, with the reason."""
    unreadable = F.get_json_object(LINE, "$").isNull()
    return parsed.where(F.col(LINE).isNotNull()).select(
        F.lit(feed).alias("feed"),
        F.when(unreadable, "unreadable").otherwise("wrong types").alias("reason"),
        F.col(FILE).alias("file"),
        F.col(LINE).alias("line"),
    )


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Permissive read: a field of the wrong type is NULL and an unreadable line is all NULL.

    All-NULL rows have no product key, so cleaning drops them.
    """
    return spark.read.json(path, schema=schema, mode="PERMISSIVE")


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files below some folders, from their listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def write_feed(frame: DataFrame, path: str) -> None:
    """Write rows as gzip'd JSON Lines, the form the readers expect."""
    frame.write.json(path, mode="overwrite", compression="gzip")


def spread(feed: DataFrame) -> DataFrame:
    """Spread a feed that Spark can't split inside its files (.gz, .deflate, .lz4, .snappy ...).

    Such a file is read by one task, which would then also hash and sort everything in it. The
    rebalance hint moves the parsed rows to partitions sized at run time, at the price of a shuffle:
    worth it where files are fewer than cores or of very different sizes.
    """
    return feed.hint("rebalance")
