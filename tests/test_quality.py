"""Checks must notice what they check."""

from __future__ import annotations

from helpers import rows
from reviewmill.operators import quality
from test_reports import month, table


def good(spark):
    review = {"review_id": "r1", "product_asin": "P1", "rating": 5.0, "review_year": 2020}
    return (
        table(spark, "reviews", review),
        table(spark, "products", {"product_asin": "P1", "product_title": "t"}),
        table(spark, "review_product", {**review, "product_title": "t"}),
        table(spark, "monthly_review_summary", month("2020-01", 1)),
    )


def bad(spark):
    return (
        table(
            spark,
            "reviews",
            {"review_id": "r1", "product_asin": "P1", "rating": 5.5, "helpful_vote_count": -1},
            {"review_id": "r1", "product_asin": " ", "rating": 0.5},
            {"review_id": "r2", "product_asin": None},
        ),
        table(
            spark,
            "products",
            {"product_asin": "P1", "metadata_review_count": -1},
            {"product_asin": "P1"},
            {"product_asin": ""},
        ),
        table(spark, "review_product", {"product_title": "t"}, {}, {}),
        table(spark, "monthly_review_summary", month("2020-01", 5)),
    )


def test_report_passes_on_good_tables(spark):
    report = quality.quality_report(*good(spark))
    assert quality.failures(report).count() == 0
    assert dict(rows(report, "check_name", "observed"))["rows_in_year_2020"] == 1.0
    assert report.where("passed").count() == 9


def test_report_fails_every_check_on_bad_tables(spark):
    report = quality.quality_report(*bad(spark))
    observed = dict(rows(quality.failures(report), "check_name", "observed"))
    assert observed == {
        "missing_keys_reviews": 2.0,
        "missing_keys_products": 1.0,
        "duplicate_review_ids": 1.0,
        "duplicate_product_ids": 1.0,
        "invalid_ratings": 2.0,
        "invalid_helpful_votes": 1.0,
        "invalid_metadata_counts": 1.0,
        "monthly_total_difference": 2.0,
    }
    informational = dict(rows(report.where("expected IS NULL"), "check_name", "observed"))
    assert informational["unmatched_reviews"] == 2.0
    assert informational["unmatched_percent"] == 66.67


def test_single_checks(spark):
    reviews, products, enriched, monthly = bad(spark)
    keyed = {"reviews": reviews, "products": products}
    assert rows(quality.row_counts(keyed)) == [("products", 3), ("reviews", 3)]
    assert rows(quality.missing_keys(keyed)) == [("products", 1), ("reviews", 2)]
    assert rows(quality.duplicate_ids(reviews, products)) == [("products", 1), ("reviews", 1)]
    assert rows(quality.invalid_review_values(reviews)) == [(2, 1)]
    assert rows(quality.invalid_product_values(products)) == [(0, 1)]
    assert rows(quality.unmatched_reviews(enriched)) == [(3, 2, 66.67)]
    assert rows(quality.unmatched_reviews(enriched.limit(0))) == [(0, 0, None)]
    assert rows(quality.year_partitions(reviews)) == [(0, 3)]
    assert rows(quality.reconciliation(reviews, monthly)) == [(3, 5)]
