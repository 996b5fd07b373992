"""Cleaning and deduplication of both feeds."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

from helpers import PRODUCT, REVIEW, plan, products, reviews, rows
from reviewmill.operators import cleaning
from reviewmill.schemas import TABLES


def test_review_layout(spark):
    cleaned = cleaning.clean_reviews(reviews(spark, {}))
    assert cleaned.columns == TABLES["reviews"].names
    assert dict(cleaned.dtypes)["review_year"] == "int"
    row = cleaned.first()
    assert row.review_month == "2023-11" and row.review_year == 2023
    assert row.review_timestamp.microsecond == 0


def test_blank_key_is_dropped_and_null_key_falls_back(spark):
    raw = reviews(
        spark,
        {"parent_asin": " P1 "},
        {"parent_asin": "  "},
        {"parent_asin": None, "asin": "V"},
        {"parent_asin": None, "asin": None},
    )
    assert rows(cleaning.clean_reviews(raw), "product_asin") == [("P1",), ("V",)]


def test_copies_merge_across_null_and_empty_and_within_a_second(spark):
    raw = reviews(
        spark,
        {"title": None, "timestamp": 1_700_000_000_001, "verified_purchase": False},
        {"title": "", "timestamp": 1_700_000_000_999, "helpful_vote": 4},
        {"title": "", "timestamp": 1_700_000_001_000},
    )
    assert rows(cleaning.clean_reviews(raw), "review_title", "helpful_vote_count") == [
        ("", 0),
        ("", 4),
    ]


def _review_order(row):
    """The survivor order spelled out on whole strings, NULL last."""

    def last(value):
        return (value is None, value if value is not None else "")

    return (
        not row["is_verified_purchase"],
        -row["helpful_vote_count"],
        row["rating"] is None,
        -(row["rating"] or 0.0),
        last(row["variant_asin"]),
        row["product_asin"],
        last(row["user_id"]),
        last(row["review_title"]),
        last(row["review_text"]),
    )


def test_survivor_matches_whole_string_order(spark):
    """Short strings full of separators, so that different splits of one content collide."""
    words = [None, "", "|", "||", "|||", "a", "a||", "||a", "a||b"]
    rng = random.Random(7)
    raw = reviews(
        spark,
        *[
            {
                "parent_asin": rng.choice(["a", "a||", "a||b", "|"]),
                "user_id": rng.choice(words),
                "title": rng.choice(words),
                "text": rng.choice(words),
                "timestamp": rng.choice([None, 0]),
                "asin": rng.choice([None, "V1", "V2"]),
                "rating": rng.choice([None, 3.0, 5.0]),
                "verified_purchase": rng.choice([True, False]),
                "helpful_vote": rng.choice([0, 1]),
            }
            for _ in range(6000)
        ],
    )
    keyed = cleaning.keyed_reviews(raw)
    everything = [row.asDict() for row in keyed.collect()]
    groups = {}
    for row in everything:
        groups.setdefault(row["review_id"], []).append(row)
    kinds = {(r["user_id"], r["review_title"], r["review_text"]) for r in everything}
    assert len(groups) < len(kinds) * 4  # collisions do occur
    expected = {key: min(group, key=_review_order) for key, group in groups.items()}
    got = {row["review_id"]: row.asDict() for row in cleaning.dedup_reviews(keyed).collect()}
    assert got == expected


def test_dedup_does_not_depend_on_input_order_or_partitioning(spark, settings):
    base = [
        {"helpful_vote": v, "asin": a, "text": t, "user_id": u}
        for v, a, t, u in itertools.product([1, 2], ["A", "B"], [None, "", "x"], [None, "", "u"])
    ]
    seen = []
    for seed, partitions in ((1, "1"), (2, "3"), (3, "8")):
        settings(spark__sql__shuffle__partitions=partitions)
        shuffled = random.Random(seed).sample(base, len(base))
        raw = reviews(spark, *shuffled).repartition(seed)
        seen.append(rows(cleaning.clean_reviews(raw)))
    assert seen[0] == seen[1] == seen[2]


def test_product_rules_and_survivor(spark):
    raw = products(
        spark,
        {"parent_asin": " P1 ", "rating_number": 5, "title": "few"},
        {"rating_number": 9, "title": "many"},
        {"rating_number": 9, "title": "many, cheap", "price": "1"},
        {"parent_asin": "  "},
        {"parent_asin": None},
        {
            "parent_asin": "P2",
            "store": " ",
            "price": "?",
            "average_rating": 0.5,
            "rating_number": -1,
        },
    )
    got = rows(cleaning.clean_products(raw), "product_asin", "product_title", "brand", "price")
    assert [r[:3] for r in got] == [("P1", "many, cheap", "b"), ("P2", "t", "Unknown")]
    unusable = cleaning.clean_products(raw).where("product_asin = 'P2'").first()
    assert unusable.price is None and unusable.metadata_average_rating is None
    assert unusable.metadata_review_count == 0


def _third(hot, other):
    """The hot value for a third of 3000 numbered rows, one value each for the rest."""
    return F.when(F.col("id") < 1000, hot).otherwise(other)


def _cut_before_the_shuffle(frame):
    final, partial = plan(frame).split("Exchange hashpartitioning")
    return "row_number(), 1, Final" in final and "row_number(), 1, Partial" in partial


def test_a_third_of_all_reviews_are_copies(spark):
    """Every task passes on one row of the hot id."""
    number = F.col("id").cast("string")
    raw = spark.range(0, 3000, 1, 6).select(
        *[
            _third("same", number).alias(name) if name == "text" else F.lit(value).alias(name)
            for name, value in REVIEW.items()
        ]
    )
    cleaned = cleaning.clean_reviews(raw)
    assert cleaned.count() == 2001
    assert _cut_before_the_shuffle(cleaned)


def test_a_third_of_all_products_are_copies(spark):
    number = F.col("id").cast("string")
    raw = spark.range(0, 3000, 1, 6).select(
        *[
            _third("P", number).alias(name) if name == "parent_asin" else F.lit(value).alias(name)
            for name, value in PRODUCT.items()
        ]
    )
    cleaned = cleaning.clean_products(raw)
    assert cleaned.count() == 2001
    assert _cut_before_the_shuffle(cleaned)


def test_texts_stay_out_of_the_shuffle_when_not_read(spark):
    narrow = cleaning.clean_reviews(reviews(spark, {})).select("product_asin", "rating")
    below_window, above_scan = plan(narrow).split("Exchange hashpartitioning")
    assert "review_text" not in below_window and "review_title" not in below_window
    assert "sha2" in above_scan
