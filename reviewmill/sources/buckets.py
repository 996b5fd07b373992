"""Bucketed tables in the catalog: what is bucketed alike by a key joins and groups by it without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from reviewmill.sources.tables import quoted, text_literal


def create_database(spark: SparkSession, database: str, location: str) -> None:
    """The database, with its entries' default place; an existing one stays as it is."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {text_literal(location)}")


def write_bucketed(
    frame: DataFrame, entry: str, path: str, keys: Sequence[str], buckets: int, mode: str = "overwrite", codec: str = "snappy"
) -> None:
    """Store rows as a table in buckets of some keys, sorted by them, or append them to one. entry: quoted name.

    Rows are dealt like the buckets first, by the same hash, so each task writes the one file of
    one bucket. A frame that comes from equally bucketed tables is dealt already and isn't shuffled.
    """
    dealt = frame.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).option("compression", codec).mode(mode).saveAsTable(entry)


def drop_table(spark: SparkSession, entry: str) -> None:
    """Remove a catalog entry; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {entry}")


def set_property(spark: SparkSession, entry: str, name: str, value: object) -> None:
    spark.sql(f"ALTER TABLE {entry} SET TBLPROPERTIES ({text_literal(name)} = {text_literal(str(value))})")


def get_property(spark: SparkSession, entry: str, name: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {entry} ({text_literal(name)})").first()["value"]
