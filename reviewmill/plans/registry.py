"""Every operator as a query over a folder of supplied tables.

Operators run lazily from the raw feeds. Reports and checks read stored tables, as they would
after a batch job; the tables they need are written once per application and input folder, to the
cluster's shared folder.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions import cleaning as rule
from reviewmill.functions import display
from reviewmill.operators import cleaning, joins, quality, reports, summaries
from reviewmill.plans import copartitioned
from reviewmill.plans.batch import ReviewLake, read_quarantine, read_report, run_batch
from reviewmill.plans.supplied import (
    SUPPLIED,
    odd_lines,
    raw_products,
    raw_reviews,
    supplied_path,
)
from reviewmill.plans.upkeep import Upkeep
from reviewmill.schemas import TABLES
from reviewmill.sources import feeds, publication, tables
from reviewmill.sources.session import INITIAL_PARTITIONS, own_session, partitions_for, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

#: Bytes of the feeds for each stored byte of the supplied tables, at most.
GROWTH = 6.0

_lakes: dict[tuple[str, str], ReviewLake] = {}
_jobs: dict[tuple[str, str], ReviewLake] = {}
_written: set[str] = set()
_lakes_lock = threading.Lock()
_job_locks: dict[tuple[str, str], threading.Lock] = defaultdict(threading.Lock)
_written_lock = threading.Lock()


def lake(spark: SparkSession, sf_dir: str) -> ReviewLake:
    """Stored tables of an input folder, shared by all queries of this application.

    Each lake has a session of its own, whose shuffles start with partitions for this folder's size;
    the caller's session stays as it is. Nothing is written before a query asks for a table.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lakes_lock:
        if key not in _lakes:
            paths = [supplied_path(sf_dir, name) for name in SUPPLIED]
            needed = partitions_for(feeds.stored_bytes(spark, *paths), GROWTH)
            least = int(spark.conf.get("spark.sql.shuffle.partitions"))
            own = own_session(spark, max(needed, least), GROWTH)
            _lakes[key] = ReviewLake(
                own,
                raw_reviews(own, sf_dir),
                raw_products(own, sf_dir),
                scratch_folder(spark, "lake"),
                reread=lambda session: raw_reviews(session, sf_dir),
            )
        return _lakes[key]


def _once(path: str, write: Callable[[str], None]) -> str:
    """The folder, written by the first call."""
    with _written_lock:
        if path not in _written:
            write(path)
            _written.add(path)
    return path


def job(spark: SparkSession, sf_dir: str) -> ReviewLake:
    """The six tables of the batch job itself, run on the feeds as gzip'd JSON Lines.

    The review feed also holds lines that break off, and values of wrong types.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    source = lake(spark, sf_dir)
    with _lakes_lock:
        mine = _job_locks[key]
    with mine:  # one run for each folder, while other folders' queries go on
        if key not in _jobs:
            reviews, products = f"{source.base}/job/reviews", f"{source.base}/job/products"
            feeds.write_feed(source.raw_reviews, reviews)
            odd_lines(source.spark, sf_dir).write.text(reviews + "-odd", compression="gzip")
            feeds.write_feed(source.raw_products, products)
            both = f"{source.base}/job/{{reviews,reviews-odd}}"
            _jobs[key] = run_batch(source.spark, both, products, f"{source.base}/job/lake", spread=True)
        return _jobs[key]


def job_base(spark: SparkSession, sf_dir: str) -> str:
    """The lake in which the batch job has published its tables."""
    job(spark, sf_dir)
    return f"{lake(spark, sf_dir).base}/job/lake"


def _plain(frame: DataFrame) -> DataFrame:
    """Instants and dates as text, decimals as doubles: forms every engine prints alike."""
    plain: dict[str, Column] = {}
    for name, kind in frame.dtypes:
        if kind == "timestamp":
            plain[name] = rule.utc_time(F.unix_seconds(name)).text
        elif kind == "date":
            plain[name] = F.col(name).cast("string")
        elif kind.startswith("decimal"):
            plain[name] = F.col(name).cast("double")
    return frame.withColumns(plain) if plain else frame


Feed = Callable[[ReviewLake], DataFrame]


def _reviews(source: ReviewLake) -> DataFrame:
    return source.raw_reviews


def _products(source: ReviewLake) -> DataFrame:
    return source.raw_products


def _reviews_with_key(source: ReviewLake) -> DataFrame:
    return source.raw_reviews.withColumn(
        "product_asin", rule.product_key(F.col("parent_asin"), F.col("asin"))
    )


def _rule(feed: Feed, columns: Callable[[], dict[str, Column]]) -> Query:
    """A rule over a whole feed, as the number of rows of every (input, output) pair."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        named = [column.alias(name) for name, column in columns().items()]
        pairs = feed(lake(spark, sf_dir)).groupBy(*named)
        return _plain(pairs.agg(F.count(F.lit(1)).alias("n")))

    return query


def _operator(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """An operator over both raw feeds."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = lake(spark, sf_dir)
        return _plain(build(source.raw_reviews, source.raw_products))

    return query


def _stored(build: Callable[..., DataFrame], *names: str) -> Query:
    """A report or check over stored tables."""
    return lambda spark, sf_dir: _plain(
        build(*[lake(spark, sf_dir).table(name) for name in names])
    )


def _stats(reviews: DataFrame) -> DataFrame:
    return summaries.product_stats(cleaning.clean_reviews(reviews))


def _rollup(reviews: DataFrame, products: DataFrame) -> DataFrame:
    return summaries.product_rollup(cleaning.clean_products(products), _stats(reviews))


def _monthly(reviews: DataFrame) -> DataFrame:
    grain = summaries.product_month_stats(cleaning.clean_reviews(reviews))
    return summaries.monthly_summary(grain)


RULES: dict[str, Query] = {
    "resolve_product_key": _rule(
        _reviews_with_key,
        lambda: {name: F.col(name) for name in ("parent_asin", "asin", "product_asin")},
    ),
    "drop_missing_key": _rule(
        lambda source: _reviews_with_key(source).where(rule.is_present(F.col("product_asin"))),
        lambda: {"product_asin": F.col("product_asin")},
    ),
    "valid_rating": _rule(
        _reviews,
        lambda: {"raw_rating": F.col("rating"), "rating": rule.valid_rating(F.col("rating"))},
    ),
    "non_negative_count": _rule(
        _reviews,
        lambda: {
            "helpful_vote": F.col("helpful_vote"),
            "helpful_vote_count": rule.non_negative_long(F.col("helpful_vote")),
        },
    ),
    "epoch_ms_to_timestamp": _rule(
        _reviews,
        lambda: {
            "epoch_ms": F.col("timestamp"),
            "review_timestamp": rule.utc_time(rule.epoch_seconds(F.col("timestamp"))).instant,
        },
    ),
    "default_false_flag": _rule(
        _reviews,
        lambda: {
            "verified_purchase": F.col("verified_purchase"),
            "is_verified_purchase": rule.flag(F.col("verified_purchase")),
        },
    ),
    "year_month_sentinels": _rule(
        _reviews,
        lambda: {
            "review_year": rule.utc_time(rule.epoch_seconds(F.col("timestamp"))).year,
            "review_month": rule.utc_time(rule.epoch_seconds(F.col("timestamp"))).month,
        },
    ),
    "stable_review_id": _rule(
        lambda source: cleaning.keyed_reviews(source.raw_reviews),
        lambda: {"review_id": F.col("review_id")},
    ),
    "parse_price": _rule(
        _products,
        lambda: {"price_text": F.col("price"), "price": rule.price(F.col("price"))},
    ),
    "normalize_brand": _rule(
        _products, lambda: {"store": F.col("store"), "brand": rule.brand(F.col("store"))}
    ),
    "coerce_numeric": _rule(
        lambda source: display.coerce_numeric(
            source.raw_products, ["price", "rating_number", "absent"]
        ),
        lambda: {"price": F.col("price"), "rating_number": F.col("rating_number")},
    ),
}

OPERATORS: dict[str, Query] = {
    "clean_reviews": _operator(lambda reviews, _: cleaning.clean_reviews(reviews)),
    "clean_products": _operator(lambda _, products: cleaning.clean_products(products)),
    "dedup_reviews": _operator(
        lambda reviews, _: cleaning.dedup_reviews(cleaning.keyed_reviews(reviews)).select(
            "review_id", "variant_asin", "rating", "is_verified_purchase", "helpful_vote_count"
        )
    ),
    "dedup_products": _operator(
        lambda _, products: cleaning.dedup_products(cleaning.keyed_products(products)).select(
            "product_asin", "product_title", "price", "metadata_review_count"
        )
    ),
    "enrich_reviews": _stored(joins.enrich_reviews, "reviews", "products"),
    "product_review_stats": _operator(
        lambda reviews, _: summaries.product_review_stats(_stats(reviews))
    ),
    "product_summary": _operator(
        lambda reviews, products: summaries.product_summary(_rollup(reviews, products))
    ),
    "brand_product_stats": _operator(
        lambda _, products: summaries.brand_product_stats(cleaning.clean_products(products))
    ),
    "brand_review_stats": _operator(
        lambda reviews, products: summaries.brand_review_stats(_rollup(reviews, products))
    ),
    "brand_summary": _operator(
        lambda reviews, products: summaries.brand_summary(_rollup(reviews, products))
    ),
    "monthly_summary": _operator(lambda reviews, _: _monthly(reviews)),
}

_MONTHLY = "monthly_review_summary"

REPORTS: dict[str, Query] = {
    "overall_metrics": _stored(reports.overall_metrics, _MONTHLY),
    "total_products": _stored(reports.total_products, "products"),
    "rating_distribution": _stored(reports.rating_distribution, _MONTHLY),
    "rating_share": _stored(reports.rating_share, _MONTHLY),
    "verification_split": _stored(reports.verification_split, _MONTHLY),
    "top_products": _stored(reports.top_products, "product_summary"),
    "product_label": _stored(reports.labelled_top_products, "product_summary"),
    "top_brands": _stored(reports.top_brands, "brand_summary"),
    "brand_performance": _stored(reports.brand_performance, "brand_summary"),
    "monthly_trend": _stored(reports.monthly_trend, _MONTHLY),
    "monthly_rolling": _stored(reports.monthly_rolling, _MONTHLY),
    "monthly_trend_long": _stored(reports.monthly_trend_long, _MONTHLY),
    "price_vs_rating": _stored(reports.price_vs_rating, "product_summary"),
    "price_bands": _stored(reports.price_bands, "product_summary"),
    "top_by_metadata": _stored(reports.top_by_metadata, "product_summary"),
    # The supplied order lines end in 2001, so a year they do reach stands in for the default.
    "detail_by_year": _stored(
        lambda frame: reports.detail_by_year(frame, 1998, order="review_id"), "review_product"
    ),
}


def _check_domains(reviews: DataFrame, products: DataFrame) -> DataFrame:
    counts = [quality.invalid_review_values(reviews), quality.invalid_product_values(products)]
    rows = [frame.unpivot([], frame.columns, "measure", "invalid") for frame in counts]
    return rows[0].unionByName(rows[1])


def _by_name(check: Callable[[dict[str, DataFrame]], DataFrame], names: tuple[str, ...]) -> Query:
    return _stored(lambda *frames: check(dict(zip(names, frames))), *names)


CHECKS: dict[str, Query] = {
    "check_row_counts": _by_name(quality.row_counts, quality.CURATED),
    "check_missing_keys": _by_name(quality.missing_keys, quality.KEYED),
    "check_duplicates": _stored(quality.duplicate_ids, "reviews", "products"),
    "check_domains": _stored(_check_domains, "reviews", "products"),
    "check_unmatched": _stored(quality.unmatched_reviews, "review_product"),
    "check_year_partitions": _stored(quality.year_partitions, "reviews"),
    "check_reconciliation": _stored(quality.reconciliation, "reviews", _MONTHLY),
    "quality_report": _stored(
        quality.quality_report, "reviews", "products", "review_product", _MONTHLY
    ),
}


def _scan(feed: Feed, read: Callable[[SparkSession, str], DataFrame]) -> Query:
    """A feed written as gzip'd JSON Lines and read back under its schema."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = lake(spark, sf_dir)
        path = f"{source.base}/feeds/{feed.__name__}"
        return read(source.spark, _once(path, lambda path: feeds.write_feed(feed(source), path)))

    return query


def _sink(name: str, build: Feed) -> Query:
    """A stored table written to a folder of its own and read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = lake(spark, sf_dir)
        path = f"{source.base}/sinks/{name}"
        base = _once(path, lambda path: tables.write_table(build(source), path, name))
        return _plain(tables.read_table(source.spark, base, name))

    return query


def _batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six tables of one run."""
    stored = lake(spark, sf_dir).build()
    return quality.row_counts({name: stored.table(name) for name in TABLES})


def _registered(spark: SparkSession, sf_dir: str) -> str:
    """Database with the six tables of an input folder."""
    source = lake(spark, sf_dir).build()
    database = "reviewmill_" + source.base.rsplit("-", 1)[-1]
    _once(f"catalog {database}", lambda _: tables.register_tables(source.spark, source.base, database))
    return database


def _catalog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table when read by its registered name."""
    database, own = _registered(spark, sf_dir), lake(spark, sf_dir).spark
    return quality.row_counts({name: own.table(f"{database}.{name}") for name in TABLES})


def _check_tables_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presence and size of every expected table."""
    database, own = _registered(spark, sf_dir), lake(spark, sf_dir).spark
    sizes = quality.row_counts({name: own.table(f"{database}.{name}") for name in TABLES})
    return tables.tables_present(own, database).join(sizes, "table_name", "left")


def _use_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months and reviews of each known year, by plain table name after the database was chosen."""
    own = own_session(spark)
    tables.use_database(own, _registered(spark, sf_dir))
    return own.sql(
        "SELECT review_year, count(*) AS months, sum(review_count) AS review_count "
        "FROM monthly_review_summary WHERE review_year <> '0' GROUP BY review_year"
    )


def _utc_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of each month by the stored instants, in a session under the library's settings."""
    reviews = lake(spark, sf_dir).table("reviews")
    month = F.date_format("review_timestamp", "yyyy-MM").alias("review_month")
    return reviews.groupBy(month).agg(F.count(F.lit(1)).alias("review_count"))


def _detail_unordered(frame: DataFrame) -> DataFrame:
    """Rows of each year in an unordered detail report."""
    year = F.left("review_month", F.lit(4)).alias("review_year")
    return reports.detail_by_year(frame, 1998).groupBy(year).agg(F.count(F.lit(1)).alias("n"))


#: Buckets of the registered queries' layouts, at least.
_BUCKETS = 8


def _buckets(source: ReviewLake) -> int:
    """As many buckets as the lake's shuffles start with partitions."""
    return max(_BUCKETS, int(source.spark.conf.get(INITIAL_PARTITIONS)))


def _copartitioned(build: Callable[[SparkSession, str], DataFrame]) -> Query:
    """A query over the reviews and products of an input folder in their common buckets."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = lake(spark, sf_dir)
        database = "reviewmill_buckets_" + source.base.rsplit("-", 1)[-1]
        _once(
            f"{source.base}/copartitioned",
            lambda path: copartitioned.write_layout(
                source.spark, database, path, source.table("reviews"), source.table("products"), _buckets(source)
            ),
        )
        return _plain(build(source.spark, database))

    return query


def _kept(build: Callable[[Upkeep, ReviewLake], DataFrame]) -> Query:
    """A query over the grain after two merges: the feed's rows in three parts, by a digest of their text and key."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = lake(spark, sf_dir)
        path = f"{source.base}/upkeep"
        kept = Upkeep(source.spark, path, "reviewmill_upkeep_" + source.base.rsplit("-", 1)[-1], _buckets(source))

        def merge(_: str) -> None:
            part = F.pmod(F.xxhash64("text", "asin", "timestamp"), F.lit(3))
            for k in range(3):
                kept.add(source.raw_reviews.where(part == k))

        _once(path, merge)
        return _plain(build(kept, source))

    return query


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the batch job's tables as readers of its lake find them, and as its manifest states them."""
    base = job_base(spark, sf_dir)
    found = quality.row_counts(tables.read_tables(spark, base))
    stated = publication.current(spark, base).rows
    case = F.create_map(*[F.lit(x) for pair in stated.items() for x in pair])
    return found.withColumn("stated_rows", case[F.col("table_name")])


def _batch(name: str) -> Query:
    """A whole table of the batch job."""
    return lambda spark, sf_dir: _plain(job(spark, sf_dir).table(name))


STORAGE: dict[str, Query] = {
    "scan_reviews_jsonl": _scan(_reviews, feeds.read_reviews),
    "scan_products_jsonl": _scan(_products, feeds.read_products),
    "sink_parquet_roundtrip": _sink(
        "products", lambda source: cleaning.clean_products(source.raw_products)
    ),
    "sink_partitioned_roundtrip": _sink(
        "reviews", lambda source: source.cleaned_reviews()
    ),
    "batch_row_counts": _batch_row_counts,
    "catalog_register": _catalog_register,
    "check_tables_present": _check_tables_present,
    "use_database": _use_database,
    "utc_session": _utc_session,
    "detail_unordered": _stored(_detail_unordered, "review_product"),
    "batch_product_summary": _batch("product_summary"),
    "batch_brand_summary": _batch("brand_summary"),
    "batch_monthly_summary": _batch("monthly_review_summary"),
    "batch_review_product": _batch("review_product"),
    "copartitioned_enrich": _copartitioned(copartitioned.enriched),
    "copartitioned_product_stats": _copartitioned(
        lambda spark, database: summaries.product_review_stats(copartitioned.product_stats(spark, database))
    ),
    "copartitioned_product_summary": _copartitioned(
        lambda spark, database: summaries.product_summary(copartitioned.product_rollup(spark, database))
    ),
    "upkeep_product_summary": _kept(
        lambda kept, source: summaries.product_summary(kept.rollup(source.table("products")))
    ),
    "upkeep_brand_summary": _kept(
        lambda kept, source: summaries.brand_summary(kept.rollup(source.table("products")))
    ),
    "upkeep_monthly_summary": _kept(lambda kept, _: summaries.monthly_summary(kept.grain())),
    "published_tables": _published,
    "audit_report": lambda spark, sf_dir: read_report(spark, job_base(spark, sf_dir)),
    "quarantined_lines": lambda spark, sf_dir: read_quarantine(spark, job_base(spark, sf_dir)).drop("file"),
}

QUERIES: dict[str, Query] = {**RULES, **OPERATORS, **REPORTS, **CHECKS, **STORAGE}
