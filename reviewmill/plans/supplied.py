"""The supplied tables as the two raw feeds.

Every row of ``lineitem`` and ``documents`` becomes a review, every row of ``part`` and
``supplier`` a product, so the work grows with the tables. Column values are mapped so that every
cleaning rule has something to do; the mapping is described in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.cleaning import LAST_EPOCH_MS

MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000


SUPPLIED = ("lineitem", "documents", "part", "supplier")


def supplied_path(sf_dir: str, name: str) -> str:
    """Location of one of the supplied Parquet tables."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def supplied(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied Parquet tables."""
    return spark.read.parquet(supplied_path(sf_dir, name))


def _with_copies(frame: DataFrame, has_copy: Column) -> DataFrame:
    """Each row once, and once more with ``is_copy`` set where the condition holds."""
    versions = F.when(has_copy, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    return frame.withColumn("is_copy", F.explode(versions))


def _text(*parts: Column | str) -> Column:
    """Concatenation of columns and literal strings."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review feed: one short review per order line, one long review per document."""
    line = F.col("l_linenumber")
    copy = F.col("is_copy")
    shipped_ms = F.unix_date(F.to_date("l_shipdate")).cast("long") * F.lit(MS_PER_DAY)
    lines = _with_copies(
        supplied(spark, sf_dir, "lineitem"), (F.col("l_quantity") == 50) & (line == 1)
    ).select(
        F.when(copy, 5.0)
        .when(F.col("l_discount") == 0.06, 4.1)
        .when(F.col("l_discount") == 0.07, 3.9)
        .when((F.col("l_discount") == 0.08) & (line == 4), 4.0005)
        .otherwise(line + F.when(F.col("l_discount") == 0.05, 0.5).otherwise(0.0))
        .alias("rating"),
        F.when(F.col("l_tax") > 0, _text("order ", F.col("l_orderkey")))
        .when(copy, "")
        .alias("title"),
        _text(F.col("l_returnflag"), F.col("l_linestatus")).alias("text"),
        _text(F.when(copy, "W").otherwise("V"), F.col("l_partkey")).alias("asin"),
        F.when(copy, _text("P", F.col("l_partkey")))
        .when((line == 3) & (F.col("l_tax") == 0.08), "  ")
        .when(line != 2, _text(" P", F.col("l_partkey"), " "))
        .alias("parent_asin"),
        _text("U", F.col("l_suppkey")).alias("user_id"),
        F.when(F.col("l_discount") == 0, 0)
        .when(F.col("l_discount") == 0.01, None)
        .when((F.col("l_discount") == 0.02) & (line == 6), -1)
        .when((F.col("l_discount") == 0.02) & (line == 7), LAST_EPOCH_MS + 1)
        .when(copy, shipped_ms)
        .otherwise(shipped_ms + (F.col("l_quantity") * 10).cast("long"))
        .alias("timestamp"),
        F.when(copy, True)
        .when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "A")
        .alias("verified_purchase"),
        F.when(copy, 99)
        .otherwise(F.col("l_quantity").cast("long") - 10)
        .cast("long")
        .alias("helpful_vote"),
    )
    documents = supplied(spark, sf_dir, "documents").select(
        F.least(F.lit(6.0), F.floor(F.col("n_chars") / 1000) * 0.5 + 1).alias("rating"),
        F.lit(None).cast("string").alias("title"),
        "text",
        F.col("source").alias("asin"),
        _text("D-", F.col("lang")).alias("parent_asin"),
        F.lit(None).cast("string").alias("user_id"),
        (F.col("n_chars") * F.lit(MS_PER_HOUR)).alias("timestamp"),
        F.lit(None).cast("boolean").alias("verified_purchase"),
        F.lit(None).cast("long").alias("helpful_vote"),
    )
    return lines.unionByName(documents)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product feed: one product per part, and one nobody reviews per supplier."""
    size = F.col("p_size")
    copy = F.col("is_copy")
    parts = _with_copies(supplied(spark, sf_dir, "part"), size.isin(3, 20)).select(
        _text(F.when(copy, "P").otherwise(" P"), F.col("p_partkey")).alias("parent_asin"),
        F.when(copy, "dup").when(size != 50, F.col("p_name")).alias("title"),
        F.when(copy, F.col("p_brand"))
        .when(size == 8, "   ")
        .when(size != 7, _text(" ", F.col("p_brand")))
        .alias("store"),
        F.col("p_type").alias("main_category"),
        F.when(copy, "$1.00")
        .when(size == 9, "from 12.99")
        .when(size == 10, None)
        .when(size == 11, "999999999.00")
        .when(size == 12, "-3.00")
        .when(size == 24, "12d")
        .when(size == 26, "1.0f")
        .when(size == 28, "1e3")
        .when(size == 30, " 7.5 ")
        .when(size == 33, "NaN")
        .when(size == 35, "Infinity")
        .when(size == 37, "12.999")
        .when(size == 39, "")
        .when(size == 41, "12.99\n")
        .when(size == 49, "$1,225.00")
        .otherwise(_text("$", (size * size * 0.5).cast("decimal(10,2)")))
        .alias("price"),
        F.when(copy, 4.0).otherwise(size / 10.0).alias("average_rating"),
        F.when(copy, 1).otherwise(size - 5).cast("long").alias("rating_number"),
    )
    suppliers = supplied(spark, sf_dir, "supplier").select(
        F.when(F.col("s_nationkey") == 0, "   ")
        .when(F.col("s_acctbal") >= 0, _text("S", F.col("s_suppkey")))
        .alias("parent_asin"),
        F.col("s_name").alias("title"),
        F.lit("Own stock").alias("store"),
        F.lit(None).cast("string").alias("main_category"),
        _text(F.col("s_acctbal").cast("decimal(10,2)")).alias("price"),
        F.lit(None).cast("double").alias("average_rating"),
        F.col("s_nationkey").cast("long").alias("rating_number"),
    )
    return parts.unionByName(suppliers)


def odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that don't fit the review feed's schema: for each supplier one that breaks off, and one
    with values of wrong types and an undeclared field."""
    key = _text(F.col("s_suppkey"))
    broken = F.concat(F.lit('{"rating": 5.0, "parent_asin": "S'), key)
    typed = F.concat(
        F.lit('{"rating": "5.0", "parent_asin": "S'),
        key,
        F.lit('", "asin": 7, "text": "typed", "user_id": "U'),
        key,
        F.lit('", "helpful_vote": "3", "verified_purchase": "true", "timestamp": 1.7e12, "more": {"a": [1]}}'),
    )
    return supplied(spark, sf_dir, "supplier").select(F.explode(F.array(broken, typed)).alias("value"))
