"""Pre-aggregated tables, all folded from the same additive measures of the reviews.

The batch job stores the measures per product and month once; product, brand and monthly figures
are roll-ups of that grain, so the reviews are scanned and shuffled once, sums are combined before
the shuffle, and a month's distinct products are simply its number of grain rows. A query that needs
product figures only takes them from the reviews directly, which saves the shuffle by month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import cleaning as rule

STARS = range(1, 6)
PRODUCT_MEASURES = [
    "review_count",
    "rated_review_count",
    "rating_sum",
    "verified_review_count",
    "helpful_vote_count",
]
STAR_MEASURES = [f"rating_{star}_count" for star in STARS]


def measures() -> list[Column]:
    """All additive measures of a group of reviews.

    Counts rows instead of ids: the id is never NULL and is the widest incompressible column.
    """
    return [
        F.count(F.lit(1)).alias("review_count"),
        F.count("rating").alias("rated_review_count"),
        F.sum(rule.exact(F.col("rating"))).alias("rating_sum"),
        F.count_if("is_verified_purchase").alias("verified_review_count"),
        F.sum("helpful_vote_count").alias("helpful_vote_count"),
        *[
            F.count_if(F.col("rating") == star).alias(name)
            for star, name in zip(STARS, STAR_MEASURES)
        ],
    ]


def review_measures() -> list[Column]:
    """The measures of a single review, whose sums are those of :func:`measures`."""
    rating = F.col("rating")
    return [
        F.lit(1).cast("long").alias("review_count"),
        rating.isNotNull().cast("long").alias("rated_review_count"),
        rule.exact(rating).alias("rating_sum"),
        F.coalesce("is_verified_purchase", F.lit(False)).cast("long").alias("verified_review_count"),
        "helpful_vote_count",
        *[
            F.coalesce(rating == star, F.lit(False)).cast("long").alias(name)
            for star, name in zip(STARS, STAR_MEASURES)
        ],
    ]


def _totals(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def product_month_stats(reviews: DataFrame) -> DataFrame:
    """Measures per product and month."""
    return reviews.groupBy("product_asin", "review_year", "review_month").agg(*measures())


def product_stats(reviews: DataFrame) -> DataFrame:
    """Measures per product, from the reviews."""
    return reviews.groupBy("product_asin").agg(*measures())


def product_stats_from(grain: DataFrame) -> DataFrame:
    """Measures per product, from the stored grain."""
    return grain.groupBy("product_asin").agg(*_totals(*PRODUCT_MEASURES, *STAR_MEASURES))


def product_review_stats(stats: DataFrame) -> DataFrame:
    """Review figures of every reviewed product."""
    return stats.select(
        "product_asin",
        "review_count",
        "rated_review_count",
        rule.mean(F.col("rating_sum"), F.col("rated_review_count"), 3).alias(
            "average_review_rating"
        ),
        "verified_review_count",
        (F.col("review_count") - F.col("verified_review_count")).alias(
            "non_verified_review_count"
        ),
        "helpful_vote_count",
    )


def product_rollup(
    products: DataFrame, stats: DataFrame, keys: Sequence[str] = ("product_asin",)
) -> DataFrame:
    """Full outer join of products and their review measures, one row per known product key.

    Both sides have unique keys, so no key is hot here however skewed the reviews are.
    keys: the columns that make up the key on both sides. ``is_listed`` tells whether the product feed has the key. Keeps the exact rating sum, so
    brands can be averaged over reviews instead of over rounded product means.
    """
    listed = products.withColumn("is_listed", F.lit(True))
    reviewed = stats.select(*keys, *PRODUCT_MEASURES)
    counts = [name for name in PRODUCT_MEASURES if name != "rating_sum"]
    return (
        listed.join(reviewed, on=list(keys), how="full")
        .withColumn("brand", rule.known_brand(F.col("brand")))
        .fillna(False, "is_listed")
        .fillna(0, counts)
    )


def product_summary(rollup: DataFrame) -> DataFrame:
    """Attributes and review figures of every product, reviewed or listed or both."""
    return rollup.select(
        "product_asin",
        "product_title",
        "brand",
        "main_category",
        "price",
        "metadata_average_rating",
        "metadata_review_count",
        "review_count",
        "rated_review_count",
        rule.mean(F.col("rating_sum"), F.col("rated_review_count"), 3).alias(
            "average_review_rating"
        ),
        "verified_review_count",
        (F.col("review_count") - F.col("verified_review_count")).alias(
            "non_verified_review_count"
        ),
        "helpful_vote_count",
    )


def brand_product_stats(products: DataFrame) -> DataFrame:
    """Number of products and average price per brand. products: one row for each key, as cleaning leaves them."""
    return products.groupBy("brand").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.round(F.avg("price"), 2).alias("average_product_price"),
    )


def brand_review_stats(rollup: DataFrame) -> DataFrame:
    """Review figures per brand; reviews without a product count under the unknown brand."""
    reviewed = rollup.where(F.col("review_count") > 0)
    return (
        reviewed.groupBy("brand")
        .agg(
            *_totals("review_count", "rated_review_count", "rating_sum", "verified_review_count")
        )
        .select(
            "brand",
            "review_count",
            "rated_review_count",
            rule.mean(F.col("rating_sum"), F.col("rated_review_count"), 3).alias(
                "average_review_rating"
            ),
            "verified_review_count",
        )
    )


def brand_summary(rollup: DataFrame) -> DataFrame:
    """Product figures and review figures of every brand, in one aggregation.

    Equal to the full outer join of :func:`brand_product_stats` and :func:`brand_review_stats`:
    the roll-up already holds both sides of that join at product level, so grouping it gives the
    union of the brands, zero counts where a side is missing, and NULL averages there.
    """
    return (
        rollup.groupBy("brand")
        .agg(
            F.count_if("is_listed").alias("product_count"),
            F.round(F.avg("price"), 2).alias("average_product_price"),
            *_totals("review_count", "rated_review_count", "rating_sum", "verified_review_count"),
        )
        .select(
            "brand",
            "product_count",
            "average_product_price",
            "review_count",
            "rated_review_count",
            rule.mean(F.col("rating_sum"), F.col("rated_review_count"), 3).alias(
                "average_review_rating"
            ),
            "verified_review_count",
        )
    )


def monthly_summary(grain: DataFrame) -> DataFrame:
    """Volume, rating, star, verification and product figures per month."""
    totals = grain.groupBy("review_year", "review_month").agg(
        *_totals(*PRODUCT_MEASURES, *STAR_MEASURES),
        F.count(F.lit(1)).alias("reviewed_product_count"),
    )
    return totals.select(
        "review_year",
        "review_month",
        "review_count",
        "rated_review_count",
        F.round("rating_sum", 3).cast("double").alias("rating_sum"),
        rule.mean(F.col("rating_sum"), F.col("rated_review_count"), 3).alias("average_rating"),
        *STAR_MEASURES,
        "verified_review_count",
        (F.col("review_count") - F.col("verified_review_count")).alias(
            "non_verified_review_count"
        ),
        "reviewed_product_count",
    )
