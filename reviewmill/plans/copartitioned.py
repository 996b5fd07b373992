"""Reviews and products stored in the same buckets by product, so that joins and totals by product need no shuffle.

Both are shuffled by product once, when the layout is written, instead of in each query that joins or
groups them. A product with more reviews than a bucket's mean share would make its bucket a task
that no skew join can split, as a bucketed read has no shuffle to split. Its reviews are therefore dealt to
as many slices as it has shares, each in a bucket of its own, and its product row is stored once for each
slice. There are fewer such products than buckets, by their definition, and fewer than twice as many slices.

Joins go by product and slice. Totals by product and slice need no shuffle either; those of sliced products
are then added up, a row for each slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators import joins, summaries
from reviewmill.schemas import TABLES
from reviewmill.sources import buckets as store
from reviewmill.sources.tables import quoted

#: The slice of a row, and how many its product has.
SLICE, SLICES = "product_slice", "product_slices"
KEYS = ("product_asin", SLICE)
REVIEWS, PRODUCTS = "reviews_by_product", "products_by_product"
_HOT = "sliced_products"


def _entry(database: str, name: str) -> str:
    return f"{quoted(database)}.{quoted(name)}"


def hot_products(reviews: DataFrame, buckets: int) -> DataFrame:
    """(product_asin, slices) of products with more than the mean rows of a bucket; fewer than buckets of them."""
    counts = reviews.groupBy("product_asin").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    shares = F.col("n") * F.lit(buckets) / F.col("total")
    return counts.join(F.broadcast(total)).where(shares > 1).select("product_asin", F.ceil(shares).cast("int").alias(SLICES))


def write_layout(
    spark: SparkSession, database: str, folder: str, reviews: DataFrame, products: DataFrame, buckets: int
) -> None:
    """Store both tables in buckets below a folder, under their names in the database, replacing earlier ones.

    buckets: as many as a shuffle of the reviews would have partitions (``session.partitions_for``).
    reviews is read twice, once for its products' counts, so pass a stored table. Ids that are digests are left out of the shuffle
    and computed again behind it, as in ``joins.enrich_reviews``.
    """
    store.create_database(spark, database, f"{folder}/catalog")
    hot_path = f"{folder}/{_HOT}"
    # A rebalance of the few rows found, not coalesce(1), which would count all products in one task.
    hot_products(reviews, buckets).hint("rebalance").write.parquet(hot_path, mode="overwrite")
    hot = spark.read.schema(f"product_asin STRING, {SLICES} INT").parquet(hot_path)

    def sliced(frame: DataFrame) -> DataFrame:
        found = frame.join(F.broadcast(hot), "product_asin", "left")  # fewer rows than buckets
        return found.fillna(1, SLICES)

    dealt = F.pmod(F.xxhash64("review_id"), F.col(SLICES)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.col(SLICES) - 1))
    narrow = joins.without_digests(sliced(reviews).withColumn(SLICE, dealt))
    for name, rows in (
        (REVIEWS, joins.with_digests(narrow.repartition(buckets, *KEYS))),
        (PRODUCTS, sliced(products).withColumn(SLICE, copies)),
    ):
        store.write_bucketed(rows, _entry(database, name), f"{folder}/{name}", KEYS, buckets, codec="zstd")
        store.set_property(spark, _entry(database, name), _HOT, hot.count())


def enriched(spark: SparkSession, database: str) -> DataFrame:
    """Every review with its product's attributes, like ``joins.enrich_reviews``, without a shuffle."""
    reviews, products = (spark.table(_entry(database, name)) for name in (REVIEWS, PRODUCTS))
    joined = reviews.drop(SLICES).join(products.drop(SLICES), list(KEYS), "left")
    return joined.select(TABLES["review_product"].names)


def _by_slice(spark: SparkSession, database: str) -> DataFrame:
    """Measures per product and slice, without a shuffle."""
    reviews = spark.table(_entry(database, REVIEWS))
    return reviews.groupBy(*KEYS, SLICES).agg(*summaries.measures())


def _has_hot(spark: SparkSession, database: str) -> bool:
    return int(store.get_property(spark, _entry(database, REVIEWS), _HOT)) > 0


def product_stats(spark: SparkSession, database: str) -> DataFrame:
    """Measures per product, like ``summaries.product_stats``; only rows of sliced products, one a slice, are shuffled."""
    found = _by_slice(spark, database)
    whole = found.where(F.col(SLICES) == 1).drop(*KEYS[1:], SLICES)
    if not _has_hot(spark, database):
        return whole
    return whole.unionByName(summaries.product_stats_from(found.where(F.col(SLICES) > 1)))


def product_rollup(spark: SparkSession, database: str) -> DataFrame:
    """Products and their review measures, like ``summaries.product_rollup``, shuffled like :func:`product_stats`."""
    found, products = _by_slice(spark, database), spark.table(_entry(database, PRODUCTS))
    whole = summaries.product_rollup(
        products.where(F.col(SLICES) == 1).drop(SLICES), found.where(F.col(SLICES) == 1), KEYS
    ).drop(SLICE)
    if not _has_hot(spark, database):
        return whole
    listed = products.where((F.col(SLICES) > 1) & (F.col(SLICE) == 0)).drop(SLICE, SLICES)
    totals = summaries.product_stats_from(found.where(F.col(SLICES) > 1))
    return whole.unionByName(summaries.product_rollup(listed, totals))
