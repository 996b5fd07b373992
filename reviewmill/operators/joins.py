"""Reviews with product attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import cleaning as rule

_CONTENT = ("product_asin", "user_id", "review_timestamp", "review_title", "review_text")
_IS_DIGEST = "_is_digest"


def enrich_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Every review with its product's attributes; reviews without a product keep NULLs.

    No broadcast hint: Spark broadcasts the products only when their measured size allows, and
    otherwise sort-merges. A product with a huge share of the reviews is then split by the
    adaptive skew join, which can split the left side of a left join. That needs a plain shuffle
    right below each side, so pass stored tables (or other frames that are not already
    partitioned by product) rather than the products straight from their deduplication.

    A review id that is the digest of its row, as cleaning makes it, isn't carried through the join but computed
    again behind it: 64 characters that no codec packs are half of what would be shuffled. Any other id is carried.
    """
    kinds = dict(reviews.dtypes)
    clash = set(kinds) & set(products.columns) != {"product_asin"}
    if clash or not {"review_id", *_CONTENT} <= set(kinds) or kinds["review_timestamp"] != "timestamp":
        return reviews.join(products, on="product_asin", how="left")
    return with_digests(without_digests(reviews).join(products, on="product_asin", how="left"))


def _digest() -> Column:
    """What cleaning makes the id from a curated review."""
    second = F.unix_seconds("review_timestamp")
    return rule.content_id(*[rule.utc_time(second).text if name == "review_timestamp" else F.col(name) for name in _CONTENT])


def without_digests(reviews: DataFrame) -> DataFrame:
    """Curated reviews to be shuffled: ids that are the digest of their row are left out, for :func:`with_digests` behind the shuffle."""
    review_id = F.col("review_id")
    is_digest = review_id.eqNullSafe(_digest())
    return reviews.withColumns({_IS_DIGEST: is_digest, "review_id": F.when(~is_digest, review_id)})


def with_digests(carried: DataFrame) -> DataFrame:
    """The result of :func:`without_digests` with all ids again."""
    return carried.withColumn("review_id", F.when(F.col(_IS_DIGEST), _digest()).otherwise(F.col("review_id"))).drop(_IS_DIGEST)
