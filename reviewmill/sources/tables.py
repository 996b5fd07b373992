"""Stored tables: Parquet folders, optionally partitioned, and their catalog entries."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schemas import TABLES
from reviewmill.sources import publication

#: What tables are joined and grouped by: the columns whose distinct values and widths the planner should know.
KEY_COLUMNS = ("product_asin", "review_id", "brand", "review_month")
#: Tables with a row for each review, written by the tasks that have just read, deduplicated or joined them.
_SHUFFLED = ("reviews", "review_product")
#: Their codec: half of their bytes are ids, 64 hexadecimal digits, which Snappy leaves as they are and zstd packs to 32 bytes.
_REVIEW_CODEC = "zstd"


def write_parquet(
    frame: DataFrame,
    path: str,
    partition_columns: Sequence[str] | None = None,
    rebalance: bool = True,
    row_group_bytes: int | None = None,
    codec: str = "snappy",
) -> None:
    """Replace a Parquet folder, Snappy-compressed unless another codec is given.

    Partitioned output is rebalanced by the partition columns first. Otherwise every task would
    open a file per year; with the hint small partitions are merged and a year with a large share
    of the rows is split over several tasks. ``rebalance=False`` saves that shuffle for rows that come
    straight from one, or from the feed: its tasks have enough rows for a file of each year.

    row_group_bytes: smaller row groups than Parquet's, for readers that are to split a file further.
    """
    if partition_columns and rebalance:
        frame = frame.hint("rebalance", *partition_columns)
    writer = frame.write.option("parquet.block.size", str(row_group_bytes)) if row_group_bytes else frame.write
    writer.parquet(
        path,
        mode="overwrite",
        partitionBy=list(partition_columns or []),
        compression=codec,
    )


def table_path(root: str, name: str) -> str:
    """Folder of a stored table below the folder of its run (see ``publication.root_of``)."""
    return f"{root.rstrip('/')}/{TABLES[name].folder}"


def write_table(frame: DataFrame, base: str, name: str) -> None:
    """Store a table below the base folder in its fixed column order: tables with a row for each review with zstd, others with Snappy."""
    table = TABLES[name]
    path, rebalance = table_path(base, name), name not in _SHUFFLED
    write_parquet(frame.select(table.names), path, table.partition, rebalance, codec="snappy" if rebalance else _REVIEW_CODEC)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A stored table under its fixed schema, so no file is opened to infer it.

    base: a lake, of which the current publication is read, or a folder of tables without one.
    """
    return _read(spark, publication.root_of(spark, base), name)


def read_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All six stored tables of a lake, of one and the same publication."""
    root = publication.root_of(spark, base)
    return {name: _read(spark, root, name) for name in TABLES}


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name].columns).parquet(table_path(root, name))


def register_tables(spark: SparkSession, base: str, database: str, statistics: bool = True) -> None:
    """Make the six stored tables of a lake queryable by name, with figures for the planner.

    Each name is a view of an external table of its own for each publication, kept in a second database (``DATABASE__stored``).
    The table is complete, partitions and figures included, before the view is replaced, and views are replaced in place, so
    readers find a table at every moment. The six follow one after another: a query that joins two of them meanwhile
    may see two publications. Tables of publications that have gone are dropped last; files stay untouched. To be repeated after each run.

    statistics: count rows, and analyse the key columns (one pass over these columns alone), which the planner follows
    where ``spark.sql.cbo.enabled`` is set.
    """
    root, lake = publication.root_of(spark, base), base.rstrip("/")
    named, stored = quoted(database), quoted(f"{database}__stored")
    for which, folder in ((named, "catalog"), (stored, "catalog_stored")):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {which} LOCATION {text_literal(f'{lake}/{folder}')}")
    for name, table in TABLES.items():
        entry = f"{stored}.{quoted(_entry(name, root))}"
        layout = f"PARTITIONED BY ({', '.join(table.partition)})" if table.partition else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {entry} ({table.columns}) USING parquet {layout} "
            f"LOCATION {text_literal(table_path(root, name))}"
        )
        if table.partition:
            spark.sql(f"MSCK REPAIR TABLE {entry} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {entry}")
        if statistics:
            keys = [c for c in KEY_COLUMNS if c in table.names]
            spark.sql(f"ANALYZE TABLE {entry} COMPUTE STATISTICS" + (f" FOR COLUMNS {', '.join(keys)}" if keys else ""))
    for name in TABLES:
        view = f"{named}.{name}"
        if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
            spark.sql(f"DROP TABLE {view}")  # an entry of the earlier layout, once
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {stored}.{quoted(_entry(name, root))}")
    roots = {root, *(old.root for old in publication.history(spark, base))}
    known = {_entry(name, one).lower() for name in TABLES for one in roots}
    for entry in spark.sql(f"SHOW TABLES IN {stored}").collect():
        if not entry["isTemporary"] and entry["tableName"].lower() not in known:
            spark.sql(f"DROP TABLE IF EXISTS {stored}.{quoted(entry['tableName'])}")


def _entry(name: str, root: str) -> str:
    """The catalog's name of a table of one publication."""
    return f"{name}_{hashlib.sha256(root.encode()).hexdigest()[:16]}"


def use_database(spark: SparkSession, database: str) -> None:
    """Resolve plain table names in this database from now on."""
    spark.sql(f"USE {quoted(database)}")


def tables_present(spark: SparkSession, database: str) -> DataFrame:
    """The six expected table names and whether the database lists them."""
    found = [(name, spark.catalog.tableExists(f"{quoted(database)}.{name}")) for name in TABLES]
    rows = [F.struct(F.lit(n).alias("table_name"), F.lit(p).alias("is_present")) for n, p in found]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def quoted(name: str) -> str:
    """A name for SQL, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """A SQL string with quotes and backslashes escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
