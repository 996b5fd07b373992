from __future__ import annotations

import io
from contextlib import redirect_stdout

from reviewmill.schemas import PRODUCT_FEED, REVIEW_FEED

REVIEW = {
    "rating": 5.0,
    "title": "t",
    "text": "x",
    "asin": "A1",
    "parent_asin": "P1",
    "user_id": "u",
    "timestamp": 1_700_000_000_123,
    "verified_purchase": True,
    "helpful_vote": 0,
}

PRODUCT = {
    "parent_asin": "P1",
    "title": "t",
    "store": "b",
    "main_category": "c",
    "price": "$10.00",
    "average_rating": 4.0,
    "rating_number": 3,
}


def reviews(spark, *rows):
    """Raw reviews that differ from the standard one as given."""
    return _frame(spark, REVIEW, REVIEW_FEED, rows)


def products(spark, *rows):
    """Raw products that differ from the standard one as given."""
    return _frame(spark, PRODUCT, PRODUCT_FEED, rows)


def _frame(spark, standard, schema, rows):
    full = [tuple({**standard, **row}.values()) for row in rows]
    return spark.createDataFrame(full, schema)


def rows(frame, *columns):
    """Rows as tuples, sorted."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in picked.collect()), key=str)


def plan(frame, mode="simple"):
    """Physical plan as text."""
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


def final_plan(frame):
    """Physical plan after adaptive execution has run it."""
    frame.collect()
    return plan(frame)
