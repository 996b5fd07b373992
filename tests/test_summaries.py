"""Joins and the three summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMALL
from helpers import final_plan, plan, products, reviews, rows
from reviewmill.operators import cleaning, joins, summaries
from reviewmill.plans.supplied import raw_products, raw_reviews
from reviewmill.schemas import TABLES
from reviewmill.sources.tables import read_table, write_table


def both(spark, review_rows, product_rows):
    return (
        cleaning.clean_reviews(reviews(spark, *review_rows)),
        cleaning.clean_products(products(spark, *product_rows)),
    )


def rollup(spark, review_rows, product_rows):
    cleaned, listed = both(spark, review_rows, product_rows)
    return summaries.product_rollup(listed, summaries.product_stats(cleaned))


MIXED_REVIEWS = [
    {"user_id": "a", "rating": 5.0, "helpful_vote": 2},
    {"user_id": "b", "rating": 4.5, "verified_purchase": None},
    {"user_id": "c", "rating": 9.0},
    {"user_id": "a", "parent_asin": "GONE", "rating": 1.0, "timestamp": 0},
]
MIXED_PRODUCTS = [{}, {"parent_asin": "P2", "store": None, "price": None}]


def test_enrich_keeps_unmatched_reviews(spark):
    cleaned, listed = both(spark, MIXED_REVIEWS, MIXED_PRODUCTS)
    enriched = joins.enrich_reviews(cleaned, listed)
    assert enriched.count() == 4
    assert set(enriched.columns) == set(TABLES["review_product"].names)
    assert enriched.columns[0] == "product_asin"
    assert rows(enriched.where("brand IS NULL"), "product_asin") == [("GONE",)]


def test_product_summary(spark):
    summary = summaries.product_summary(rollup(spark, MIXED_REVIEWS, MIXED_PRODUCTS))
    assert summary.columns == TABLES["product_summary"].names
    got = rows(
        summary,
        "product_asin",
        "brand",
        "metadata_review_count",
        "review_count",
        "rated_review_count",
        "average_review_rating",
        "verified_review_count",
        "non_verified_review_count",
        "helpful_vote_count",
    )
    assert got == [
        ("GONE", "Unknown", None, 1, 1, 1.0, 1, 0, 0),
        ("P1", "b", 3, 3, 2, 4.75, 2, 1, 2),
        ("P2", "Unknown", 3, 0, 0, None, 0, 0, 0),
    ]


def test_brand_summary(spark):
    summary = summaries.brand_summary(rollup(spark, MIXED_REVIEWS, MIXED_PRODUCTS))
    assert summary.columns == TABLES["brand_summary"].names
    assert dict(summary.dtypes)["average_product_price"] == "decimal(11,2)"
    got = [(r[0], r[1], r[2] and float(r[2]), *r[3:]) for r in rows(summary)]
    assert got == [("Unknown", 1, None, 1, 1, 1.0, 1), ("b", 1, 10.0, 3, 2, 4.75, 2)]


def test_unknown_brand_without_products(spark):
    summary = summaries.brand_summary(rollup(spark, MIXED_REVIEWS, MIXED_PRODUCTS[:1]))
    assert rows(summary.where("brand = 'Unknown'"), "product_count") == [(0,)]


def test_brand_summary_is_the_full_join_of_its_halves(spark):
    cleaned = cleaning.clean_reviews(raw_reviews(spark, SMALL))
    listed = cleaning.clean_products(raw_products(spark, SMALL))
    joined = summaries.product_rollup(listed, summaries.product_stats(cleaned))
    halves = (
        summaries.brand_product_stats(listed)
        .join(summaries.brand_review_stats(joined), "brand", "full")
        .fillna(
            0, ["product_count", "review_count", "rated_review_count", "verified_review_count"]
        )
    )
    assert rows(summaries.brand_summary(joined)) == rows(halves)


def test_monthly_summary(spark):
    cleaned, _ = both(spark, MIXED_REVIEWS, MIXED_PRODUCTS)
    monthly = summaries.monthly_summary(summaries.product_month_stats(cleaned))
    assert set(monthly.columns) == set(TABLES["monthly_review_summary"].names)
    assert rows(monthly) == [
        (0, "unknown", 1, 1, 1.0, 1.0, 1, 0, 0, 0, 0, 1, 0, 1),
        (2023, "2023-11", 3, 2, 9.5, 4.75, 0, 0, 0, 0, 1, 2, 1, 1),
    ]


def test_product_figures_agree_from_reviews_and_from_the_grain(spark):
    cleaned = cleaning.clean_reviews(raw_reviews(spark, SMALL))
    direct = summaries.product_stats(cleaned)
    rolled = summaries.product_stats_from(summaries.product_month_stats(cleaned))
    assert direct.columns == rolled.columns
    assert rows(direct) == rows(rolled)


def test_month_without_ratings_has_no_average(spark):
    cleaned, _ = both(spark, [{"rating": None}], [{}])
    monthly = summaries.monthly_summary(summaries.product_month_stats(cleaned))
    assert rows(monthly, "rating_sum", "average_rating") == [(None, None)]


def test_the_grain_reads_no_wide_column(spark, tmp_path):
    write_table(cleaning.clean_reviews(reviews(spark, {})), str(tmp_path), "reviews")
    text = plan(summaries.product_month_stats(read_table(spark, str(tmp_path), "reviews")))
    scan = text[text.index("ReadSchema") :]
    assert "review_text" not in scan and "review_id" not in scan


def test_hot_product_is_split_in_the_join(spark, settings, tmp_path):
    """Two thirds of the reviews are of one product and no side is small enough to broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    key = F.sha2(F.col("id").cast("string"), 256)
    numbered = spark.range(0, 30000, 1, 8).withColumn("key", key)
    product = F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.left("key", F.lit(4)))
    hot = numbered.select("key", product.alias("product_asin"))
    listed = hot.select("product_asin").distinct()
    listed = listed.withColumn("brand", F.left("product_asin", F.lit(1)))
    for name, frame in (("hot", hot), ("listed", listed)):
        frame.write.parquet(f"{tmp_path}/{name}")
    joined = joins.enrich_reviews(
        spark.read.parquet(f"{tmp_path}/hot"), spark.read.parquet(f"{tmp_path}/listed")
    )
    assert joined.where("brand = 'H'").count() == 20000
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert "SortMergeJoin(skew=true)" in final_plan(joined.hint("rebalance", "brand"))
