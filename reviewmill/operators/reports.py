"""Analysis reports over the stored tables.

Each takes the table it reads and returns a small frame. Defaults are the standard report's
values. Where a ranking could tie, the key decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions import cleaning as rule
from reviewmill.functions import display
from reviewmill.operators.summaries import STAR_MEASURES, STARS


# How reports name purchase types and trend series.
PURCHASE_TYPES = {"verified": "Verified", "other": "Non-verified"}
TREND_SERIES = {"review_count": "Monthly reviews", "rolling_reviews": "3-month average"}


def overall_metrics(monthly: DataFrame, digits: int | None = 2) -> DataFrame:
    """Total and rated reviews and the mean rating; zero counts and a NULL mean on no data."""
    totals = monthly.agg(
        F.coalesce(F.sum("review_count"), F.lit(0)).alias("total_reviews"),
        F.coalesce(F.sum("rated_review_count"), F.lit(0)).alias("rated_reviews"),
        F.sum(F.col("rating_sum").cast("decimal(18,3)")).alias("_rating_sum"),
    )
    average = rule.mean(F.col("_rating_sum"), F.col("rated_reviews"), digits)
    return totals.select("total_reviews", "rated_reviews", average.alias("average_rating"))


def total_products(products: DataFrame) -> DataFrame:
    """Number of curated products."""
    return products.agg(F.count(F.lit(1)).alias("total_products"))


def _as_rows(totals: DataFrame, *rows: Column) -> DataFrame:
    """One output row per struct, all from the same single row of totals."""
    return totals.select(F.inline(F.array(*rows)))


def rating_share(monthly: DataFrame) -> DataFrame:
    """Reviews per star and their share of all whole-star ratings, 0 when there are none.

    Five sums in one pass, then turned into rows: the table is scanned once, and the total is
    at hand in the same row.
    """
    totals = monthly.agg(*[F.sum(name).alias(name) for name in STAR_MEASURES])
    total = sum((F.coalesce(F.col(name), F.lit(0)) for name in STAR_MEASURES), F.lit(0))
    return _as_rows(
        totals,
        *[
            F.struct(
                F.lit(star).alias("rating"),
                F.col(name).alias("review_count"),
                F.coalesce(F.try_divide(F.col(name), total), F.lit(0.0)).alias("review_share"),
            )
            for star, name in zip(STARS, STAR_MEASURES)
        ],
    ).orderBy("rating")


def rating_distribution(monthly: DataFrame) -> DataFrame:
    """Reviews per star."""
    return rating_share(monthly).select("rating", "review_count")


def verification_split(monthly: DataFrame) -> DataFrame:
    """Reviews of verified and of other purchases, larger group first."""
    totals = monthly.agg(
        F.sum("verified_review_count").alias("verified"),
        F.sum("non_verified_review_count").alias("other"),
    )
    return _as_rows(
        totals,
        *[
            F.struct(F.lit(label).alias("purchase_type"), F.col(name).alias("review_count"))
            for name, label in PURCHASE_TYPES.items()
        ],
    ).orderBy(F.desc("review_count"), "purchase_type")


def top_products(summary: DataFrame, n: int = 20) -> DataFrame:
    """Most reviewed products."""
    return (
        summary.where(F.col("review_count") > 0)
        .select("product_asin", "product_title", "brand", "review_count", "average_review_rating")
        .orderBy(F.desc("review_count"), "product_asin")
        .limit(n)
    )


def labelled_top_products(summary: DataFrame, n: int = 10) -> DataFrame:
    """Most reviewed products with a short display name."""
    label = display.product_label(F.col("product_title"), F.col("product_asin"))
    return top_products(summary, n).withColumn("product_label", label)


def top_brands(brands: DataFrame, n: int = 30, min_reviews: int = 10) -> DataFrame:
    """Most reviewed brands with enough reviews to compare."""
    return (
        brands.where(F.col("review_count") >= min_reviews)
        .select(
            "brand",
            "product_count",
            "review_count",
            "average_review_rating",
            "average_product_price",
        )
        .orderBy(F.desc("review_count"), "brand")
        .limit(n)
    )


def brand_performance(brands: DataFrame, n: int = 12, min_reviews: int = 10) -> DataFrame:
    """Most reviewed named brands that have a rating."""
    named = brands.where(
        F.col("average_review_rating").isNotNull() & (F.col("brand") != rule.UNKNOWN_BRAND)
    )
    return top_brands(named, n, min_reviews).drop("average_product_price")


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Monthly figures in time order, without the unknown month."""
    return (
        monthly.where(F.col("review_year") != rule.UNKNOWN_YEAR)
        .select("review_month", "review_count", "average_rating", "reviewed_product_count")
        .orderBy("review_month")
    )


def monthly_rolling(monthly: DataFrame, rows: int = 3) -> DataFrame:
    """Monthly volume with its trailing mean over the last ``rows`` listed months.

    Months without reviews are not filled in. The ordered window has no partition: its input is
    the monthly table, whose size is bounded by the calendar, not by the data.
    """
    trailing = Window.orderBy("month").rowsBetween(1 - rows, Window.currentRow)
    return (
        monthly.where(F.col("review_year") != rule.UNKNOWN_YEAR)
        .withColumn("month", F.try_to_date("review_month", "yyyy-MM"))
        .where(F.col("month").isNotNull())
        .select(
            "month",
            "review_count",
            F.avg("review_count").over(trailing).alias("rolling_reviews"),
        )
        .orderBy("month")
    )


def monthly_trend_long(monthly: DataFrame) -> DataFrame:
    """Volume and trailing mean as one (month, series, reviews) frame."""
    series = [F.col(name).cast("double").alias(label) for name, label in TREND_SERIES.items()]
    wide = monthly_rolling(monthly).select("month", *series)
    return wide.unpivot("month", list(TREND_SERIES.values()), "series", "reviews")


def _comparable(summary: DataFrame, min_reviews: int) -> DataFrame:
    """Priced and rated products with enough reviews to compare."""
    return summary.where(
        F.col("price").isNotNull()
        & F.col("average_review_rating").isNotNull()
        & (F.col("review_count") >= min_reviews)
    )


def price_vs_rating(summary: DataFrame, n: int = 1000, min_reviews: int = 5) -> DataFrame:
    """Price and mean rating of the most reviewed products."""
    return (
        _comparable(summary, min_reviews)
        .select(
            "product_asin",
            "product_title",
            "brand",
            F.col("price").cast("double").alias("price"),
            "average_review_rating",
            "review_count",
        )
        .orderBy(F.desc("review_count"), "product_asin")
        .limit(n)
    )


def price_bands(summary: DataFrame, min_reviews: int = 5) -> DataFrame:
    """Products, reviews and mean of the product means per price band.

    The means are summed as exact decimals (they have three digits), so the result does not
    depend on the order in which tasks finish.
    """
    priced = _comparable(summary, min_reviews).where(F.col("price") >= 0)
    return (
        priced.groupBy(display.price_band_order(F.col("price")).alias("price_band_order"))
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("review_count").alias("review_count"),
            F.sum(F.col("average_review_rating").cast("decimal(4,3)")).alias("_means"),
        )
        .select(
            display.price_band_label(F.col("price_band_order")).alias("price_band"),
            "price_band_order",
            "product_count",
            "review_count",
            (F.col("_means").cast("double") / F.col("product_count")).alias("average_rating"),
        )
        .orderBy("price_band_order")
    )


def top_by_metadata(summary: DataFrame, n: int = 20) -> DataFrame:
    """Products with the largest review count in the product feed."""
    return (
        summary.select(
            "product_asin",
            "product_title",
            "brand",
            "metadata_review_count",
            "metadata_average_rating",
        )
        .orderBy(F.desc_nulls_last("metadata_review_count"), "product_asin")
        .limit(n)
    )


def detail_by_year(
    review_product: DataFrame, year: int = 2023, n: int = 100, order: str | None = None
) -> DataFrame:
    """Some reviews of one year; the filter selects whole partitions of the stored table.

    Without an order any rows of the year may come, and the scan stops at the first ``n``; with
    one, the whole year is ranked.
    """
    rows = review_product.where(F.col("review_year") == year)
    if order:
        rows = rows.orderBy(order)
    return rows.select(
        "review_month", "rating", "is_verified_purchase", "product_title", "brand"
    ).limit(n)
