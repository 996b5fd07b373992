"""Data-quality checks over the stored tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import cleaning as rule

CURATED = ("reviews", "products", "review_product")
KEYED = ("reviews", "products")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    return _union(
        [
            frame.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, frame in tables.items()
        ]
    )


def missing_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table without a usable product key."""
    return _union(
        [
            frame.agg(_missing_key().alias("missing_product_ids")).select(
                F.lit(name).alias("table_name"), "missing_product_ids"
            )
            for name, frame in tables.items()
        ]
    )


def duplicate_ids(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Rows beyond the first of each id, per table."""
    return _union(
        [
            _surplus(frame, key, "duplicate_count").select(
                F.lit(name).alias("table_name"), "duplicate_count"
            )
            for name, frame, key in (
                ("reviews", reviews, "review_id"),
                ("products", products, "product_asin"),
            )
        ]
    )


def invalid_review_values(reviews: DataFrame) -> DataFrame:
    """Ratings and votes outside their range."""
    return reviews.agg(
        _bad_rating().alias("invalid_ratings"),
        F.count_if(F.col("helpful_vote_count") < 0).alias("invalid_helpful_votes"),
    )


def invalid_product_values(products: DataFrame) -> DataFrame:
    """Prices and feed counts outside their range."""
    return products.agg(
        F.count_if(F.col("price") < 0).alias("invalid_prices"),
        F.count_if(F.col("metadata_review_count") < 0).alias("invalid_review_counts"),
    )


def unmatched_reviews(review_product: DataFrame) -> DataFrame:
    """Reviews that show no product title, as a count and a percentage.

    A matched product whose title is missing counts as unmatched, too.
    """
    totals = review_product.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.isnull("product_title")).alias("unmatched_reviews"),
    )
    percent = F.try_divide(F.lit(100.0) * F.col("unmatched_reviews"), F.col("total_reviews"))
    return totals.withColumn("unmatched_percent", F.round(percent, 2))


def year_partitions(reviews: DataFrame) -> DataFrame:
    """Rows of each year partition; year 0 holds the reviews of unknown time."""
    return (
        reviews.groupBy("review_year")
        .agg(F.count(F.lit(1)).alias("review_count"))
        .orderBy("review_year")
    )


def reconciliation(reviews: DataFrame, monthly: DataFrame) -> DataFrame:
    """Curated reviews next to the total of the monthly table, which must be equal."""
    monthly_total = monthly.agg(F.sum("review_count")).scalar()
    return reviews.agg(F.count(F.lit(1)).alias("curated_reviews")).select(
        "curated_reviews", monthly_total.alias("monthly_summary_reviews")
    )


def _missing_key() -> Column:
    return F.count_if(~rule.is_present(F.col("product_asin")))


def _surplus(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Rows beyond the first of each id, in one row; those without an id all count.

    Where no two ids share a 64-bit hash they are all different, and only hashes are shuffled. Otherwise whole ids are compared;
    content ids travel as the bytes their hex text stands for.
    """
    hashes = frame.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key)).agg(F.count(F.lit(1)).alias("n"))
    shared = hashes.agg(F.coalesce(F.max("n") > 1, F.lit(False))).scalar()
    digest = F.col(key).rlike("^[0-9a-f]{64}$")
    of = F.when(digest, F.unhex(key)).otherwise(F.encode(key, "utf-8"))
    compared = frame.where(shared).agg(F.countDistinct(of)).scalar()
    totals = frame.agg(F.count(F.lit(1)).alias("n_rows"), F.count(key).alias("n_ids"))
    return totals.select((F.col("n_rows") - F.when(shared, compared).otherwise(F.col("n_ids"))).alias(name))


def _bad_rating() -> Column:
    low, high = rule.RATING_RANGE
    return F.count_if((F.col("rating") < low) | (F.col("rating") > high))


def _facts(frame: DataFrame, **measures: Column) -> DataFrame:
    """All measures of one table in one pass, as (check_name, observed) rows."""
    names = list(measures)
    totals = frame.agg(*[measures[name].cast("double").alias(name) for name in names])
    return totals.unpivot([], names, "check_name", "observed")


def _duplicates(frame: DataFrame, key: str, name: str) -> DataFrame:
    """The surplus rows of a table as a fact."""
    found = _surplus(frame, key, "observed")
    return found.select(F.lit(name).alias("check_name"), F.col("observed").cast("double").alias("observed"))


def _review_facts(reviews: DataFrame) -> DataFrame:
    """The review table's measures per year, as facts to be added up; zero facts for an empty table."""
    measures = {
        "rows_reviews": F.count(F.lit(1)),
        "missing_keys_reviews": _missing_key(),
        "invalid_ratings": _bad_rating(),
        "invalid_helpful_votes": F.count_if(F.col("helpful_vote_count") < 0),
    }
    by_year = reviews.groupBy("review_year").agg(*[m.alias(name) for name, m in measures.items()])

    def fact(name: Column | str, value: Column) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return F.struct(name.alias("check_name"), value.cast("double").alias("observed"))

    rows = F.col("rows_reviews")
    facts = [fact(name, F.col(name)) for name in measures]
    facts.append(fact("monthly_total_difference", -rows))
    facts.append(fact(F.concat(F.lit("rows_in_year_"), F.col("review_year").cast("string")), rows))
    zeros = reviews.sparkSession.range(1, numPartitions=1)
    return by_year.select(F.inline(F.array(*facts))).unionByName(
        zeros.select(F.inline(F.array(*[fact(name, F.lit(0)) for name in measures])))
    )


def quality_report(
    reviews: DataFrame, products: DataFrame, review_product: DataFrame, monthly: DataFrame
) -> DataFrame:
    """All checks as (check_name, observed, expected, passed), one row per check.

    Checks without an expectation are informational and have NULL in the last two columns. Each
    table is aggregated once for all its checks (reviews by year, so that the years' rows come from
    the same pass), but for the distinct ids: those need a shuffle, which would have to carry the
    other measures along. The reconciliation row adds up the monthly total and the negated review
    count, so it must be zero.
    """
    rows = F.count(F.lit(1))
    no_title = F.count_if(F.isnull("product_title"))
    facts = [
        _review_facts(reviews),
        _facts(
            products,
            rows_products=rows,
            missing_keys_products=_missing_key(),
            invalid_prices=F.count_if(F.col("price") < 0),
            invalid_metadata_counts=F.count_if(F.col("metadata_review_count") < 0),
        ),
        _facts(
            review_product,
            rows_review_product=rows,
            unmatched_reviews=no_title,
            unmatched_percent=F.round(F.try_divide(F.lit(100.0) * no_title, rows), 2),
        ),
        _duplicates(reviews, "review_id", "duplicate_review_ids"),
        _duplicates(products, "product_asin", "duplicate_product_ids"),
        _facts(monthly, monthly_total_difference=F.coalesce(F.sum("review_count"), F.lit(0))),
    ]
    informational = F.col("check_name").startswith("rows_") | F.col("check_name").startswith(
        "unmatched_"
    )
    return (
        _union(facts)
        .groupBy("check_name")
        .agg(F.sum("observed").alias("observed"))
        .withColumn("expected", F.when(~informational, F.lit(0.0)))
        .withColumn("passed", F.col("observed") == F.col("expected"))
        .orderBy("check_name")
    )


def failures(report: DataFrame) -> DataFrame:
    """Checks of a report that did not meet their expectation."""
    return report.where(~F.col("passed"))


class AuditFailed(RuntimeError):
    """Expectations that staged tables did not meet, with what was observed."""

    def __init__(self, failed: Mapping[str, float]):
        self.failed = dict(failed)
        super().__init__(", ".join(f"{name}: {value:g}" for name, value in sorted(self.failed.items())))


def audit(report: DataFrame, limits: Mapping[str, float] | None = None) -> dict[str, float]:
    """What each check of a report has observed; raises if one misses its expectation.

    limits: the most that is allowed of named checks, in place of their expectation. Years come and go,
    so only their checks may be absent from the report; then nothing of them has been observed. The report has a
    row for each check and year, which is what the driver gets.
    """
    limits = limits or {}
    rows = {row.check_name: row for row in report.collect()}
    unknown = [name for name in limits if name not in rows and not name.startswith("rows_in_year_")]
    if unknown:
        raise ValueError(f"no such check: {', '.join(sorted(unknown))}")
    observed = {name: row.observed for name, row in rows.items()}
    # A share of no rows at all is NULL, and within every limit.
    over = {name: value for name, value in observed.items() if name in limits and value is not None and value > limits[name]}
    missed = {name: row.observed for name, row in rows.items() if row.passed is False and name not in limits}
    if over or missed:
        raise AuditFailed({**over, **missed})
    return observed
