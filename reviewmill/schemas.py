"""Fixed table layouts: the two input feeds and the six stored tables."""

from __future__ import annotations

import re
from typing import NamedTuple

# Field names and types of the two JSON Lines feeds. Reading under an explicit
# schema avoids an inference pass and drops every undeclared field.
REVIEW_FEED = """
    rating DOUBLE, title STRING, text STRING, asin STRING, parent_asin STRING, user_id STRING,
    timestamp BIGINT, verified_purchase BOOLEAN, helpful_vote BIGINT
"""

PRODUCT_FEED = """
    parent_asin STRING, title STRING, store STRING, main_category STRING, price STRING,
    average_rating DOUBLE, rating_number BIGINT
"""


class Table(NamedTuple):
    """Where a stored table lives below the base folder, and what it holds."""

    folder: str
    columns: str
    partition: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return re.findall(r"(\w+) [A-Z]", self.columns)


_BY_YEAR = ("review_year",)

_REVIEW = """
    variant_asin STRING, user_id STRING, rating DOUBLE, review_title STRING, review_text STRING,
    review_timestamp TIMESTAMP, review_month STRING, is_verified_purchase BOOLEAN,
    helpful_vote_count BIGINT
"""

_PRODUCT = """
    product_title STRING, brand STRING, main_category STRING, price DECIMAL(10,2),
    metadata_average_rating DOUBLE, metadata_review_count BIGINT
"""

_STARS = ", ".join(f"rating_{star}_count BIGINT" for star in range(1, 6))

# Table names, folders and column order of the stored tables. Partition columns
# come last because that is where the Parquet reader puts them.
TABLES = {
    "reviews": Table(
        "curated/reviews",
        f"review_id STRING, product_asin STRING, {_REVIEW}, review_year INT",
        _BY_YEAR,
    ),
    "products": Table("curated/products", f"product_asin STRING, {_PRODUCT}"),
    "review_product": Table(
        "curated/review_product",
        f"product_asin STRING, review_id STRING, {_REVIEW}, {_PRODUCT}, review_year INT",
        _BY_YEAR,
    ),
    "product_summary": Table(
        "analytics/product_summary",
        f"""product_asin STRING, {_PRODUCT}, review_count BIGINT, rated_review_count BIGINT,
        average_review_rating DOUBLE, verified_review_count BIGINT,
        non_verified_review_count BIGINT, helpful_vote_count BIGINT""",
    ),
    "brand_summary": Table(
        "analytics/brand_summary",
        """brand STRING, product_count BIGINT, average_product_price DECIMAL(11,2),
        review_count BIGINT, rated_review_count BIGINT, average_review_rating DOUBLE,
        verified_review_count BIGINT""",
    ),
    "monthly_review_summary": Table(
        "analytics/monthly_review_summary",
        f"""review_month STRING, review_count BIGINT, rated_review_count BIGINT,
        rating_sum DOUBLE, average_rating DOUBLE, {_STARS}, verified_review_count BIGINT,
        non_verified_review_count BIGINT, reviewed_product_count BIGINT, review_year INT""",
        _BY_YEAR,
    ),
}
