"""Reports on hand-made tables."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from helpers import plan, rows
from reviewmill.operators import reports
from reviewmill.schemas import TABLES


def table(spark, name, *given):
    """A stored table's layout with the given values, NULL or 0 elsewhere."""
    empty = spark.createDataFrame([], TABLES[name].columns)
    zero = {"bigint": 0, "int": 0}
    full = [
        tuple(row.get(column, zero.get(kind)) for column, kind in empty.dtypes) for row in given
    ]
    return spark.createDataFrame(full, TABLES[name].columns)


def month(label, count, **more):
    return {
        "review_year": 0 if label == "unknown" else int(label[:4]),
        "review_month": label,
        "review_count": count,
        **more,
    }


@pytest.fixture(scope="module")
def monthly(spark):
    return table(
        spark,
        "monthly_review_summary",
        month("2020-01", 10, rated_review_count=4, rating_sum=13.5, rating_5_count=2,
              rating_1_count=1, verified_review_count=3, non_verified_review_count=7),
        month("2020-02", 20, verified_review_count=1, non_verified_review_count=19),
        month("2020-06", 60, rated_review_count=1, rating_sum=5.0, rating_5_count=1),
        month("2020-07", 1),
        month("unknown", 5),
    )


def test_overall_metrics(spark, monthly):
    assert rows(reports.overall_metrics(monthly)) == [(96, 5, 3.7)]
    assert rows(reports.overall_metrics(monthly.limit(0))) == [(0, 0, None)]
    assert rows(reports.overall_metrics(monthly, digits=None))[0][2] == pytest.approx(18.5 / 5)


def test_rating_share_divides_by_whole_star_ratings(spark, monthly):
    assert rows(reports.rating_share(monthly)) == [
        (1, 1, 0.25),
        (2, 0, 0.0),
        (3, 0, 0.0),
        (4, 0, 0.0),
        (5, 3, 0.75),
    ]
    assert {r[2] for r in rows(reports.rating_share(monthly.limit(0)))} == {0.0}
    unrated = table(spark, "monthly_review_summary", month("2020-01", 3))
    assert {r[2] for r in rows(reports.rating_share(unrated))} == {0.0}


def test_rating_distribution_scans_once(spark, monthly, tmp_path):
    monthly.write.parquet(f"{tmp_path}/m")
    stored = spark.read.parquet(f"{tmp_path}/m")
    report = reports.rating_distribution(stored)
    assert plan(report).count("FileScan") == 1
    assert rows(report) == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 3)]


def test_verification_split_larger_first(monthly):
    got = [tuple(r) for r in reports.verification_split(monthly).collect()]
    assert got == [("Non-verified", 26), ("Verified", 4)]


def test_rolling_mean_counts_rows_not_calendar_months(monthly):
    got = rows(reports.monthly_rolling(monthly))
    assert [(str(m), c, round(mean, 6)) for m, c, mean in got] == [
        ("2020-01-01", 10, 10.0),
        ("2020-02-01", 20, 15.0),
        ("2020-06-01", 60, 30.0),
        ("2020-07-01", 1, 27.0),
    ]


def test_trend_long(monthly):
    got = rows(reports.monthly_trend_long(monthly))
    assert len(got) == 8
    assert (datetime.date(2020, 2, 1), "3-month average", 15.0) in got
    assert (datetime.date(2020, 2, 1), "Monthly reviews", 20.0) in got


def test_trend_leaves_out_the_unknown_month(monthly):
    got = [r.review_month for r in reports.monthly_trend(monthly).collect()]
    assert got == ["2020-01", "2020-02", "2020-06", "2020-07"]


@pytest.fixture(scope="module")
def summary(spark):
    return table(
        spark,
        "product_summary",
        *[
            {
                "product_asin": f"P{i}",
                "review_count": n,
                "price": p and Decimal(p),
                "average_review_rating": a,
                "metadata_review_count": m,
                "product_title": f"title {i}",
                "brand": "b",
            }
            for i, (n, p, a, m) in enumerate(
                [(9, 10, 4.0, None), (9, 30, 2.0, 7), (5, 20, 5.0, 9), (4, 20, 1.0, 8),
                 (0, 20, None, 1), (7, None, 3.0, 2)]
            )
        ],
    )


def test_top_products_breaks_ties_by_key(summary):
    got = [r.product_asin for r in reports.top_products(summary, 3).collect()]
    assert got == ["P0", "P1", "P5"]
    assert reports.top_products(summary).count() == 5
    assert "TakeOrderedAndProject" in plan(reports.top_products(summary))
    labelled = reports.labelled_top_products(summary, 1).first()
    assert labelled.product_label == "title 0 · P0"


def test_price_reports_need_price_rating_and_five_reviews(summary):
    points = reports.price_vs_rating(summary).collect()
    assert [r.product_asin for r in points] == ["P0", "P1", "P2"]
    got = [tuple(r) for r in reports.price_bands(summary).collect()]
    assert got == [("$0–24", 1, 2, 14, 4.5), ("$25–49", 2, 1, 9, 2.0)]


def test_top_by_metadata_puts_missing_counts_last(summary):
    got = [r.product_asin for r in reports.top_by_metadata(summary).collect()]
    assert got == ["P2", "P3", "P1", "P5", "P4", "P0"]


def test_brand_rankings(spark):
    brands = table(
        spark,
        "brand_summary",
        {"brand": "Unknown", "review_count": 99, "average_review_rating": 3.0},
        {"brand": "unrated", "review_count": 50},
        {"brand": "y", "review_count": 10, "average_review_rating": 4.0},
        {"brand": "x", "review_count": 10, "average_review_rating": 2.0},
        {"brand": "few", "review_count": 9, "average_review_rating": 5.0},
    )
    top = reports.top_brands(brands).collect()
    assert [r.brand for r in top] == ["Unknown", "unrated", "x", "y"]
    assert [r.brand for r in reports.brand_performance(brands).collect()] == ["x", "y"]
    assert "average_product_price" not in reports.brand_performance(brands).columns


def test_detail_by_year(spark, tmp_path):
    rows_in = [
        {"review_id": str(i), "review_year": 2022 + i % 2, "rating": float(i % 5)} for i in range(9)
    ]
    frame = table(spark, "review_product", *rows_in)
    frame.write.partitionBy("review_year").parquet(f"{tmp_path}/rp")
    stored = spark.read.schema(frame.schema).parquet(f"{tmp_path}/rp")
    any_rows = reports.detail_by_year(stored, n=3)
    assert any_rows.count() == 3
    assert "PartitionFilters: [isnotnull(review_year" in plan(any_rows)
    ordered = reports.detail_by_year(stored, 2023, 2, order="review_id").collect()
    assert [r.rating for r in ordered] == [1.0, 3.0]
