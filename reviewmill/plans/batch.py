"""The batch job: two feeds in, six stored tables out."""

from __future__ import annotations

import logging
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from reviewmill.functions import cleaning as rule
from reviewmill.operators import cleaning, joins, quality, summaries
from reviewmill.schemas import PRODUCT_FEED, REVIEW_FEED, TABLES
from reviewmill.sources import feeds, publication, tables
from reviewmill.sources.files import remove_folder
from reviewmill.sources.publication import Publication
from reviewmill.sources.session import narrow_session, own_session

log = logging.getLogger(__name__)

#: Row groups of parsed rows: small, as one file may come from a whole feed file that couldn't be split.
_ROW_GROUP = 16 * 1024 * 1024
_FEEDS = {"reviews": REVIEW_FEED, "products": PRODUCT_FEED}
#: Hashes of repeated ids that are broadcast, at most (about 60 bytes each in memory).
_BROADCAST_HASHES = 1 << 21


class ReviewLake:
    """The stored tables of one run, each written once on first use and read back.

    Reading back is the stage barrier: the raw text is parsed, hashed and deduplicated once, and
    everything after that starts from column-pruned Parquet on shared storage, which also means
    that a lost executor never sends a later stage back to the raw feed. Two narrow intermediate
    results are stored the same way, below the base folder: the product-month grain and the product
    roll-up, from which all three summaries come. The feeds' session is the lake's: its number of
    starting partitions holds for everything here.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw_reviews: DataFrame,
        raw_products: DataFrame,
        base: str,
        salts: int | None = None,
        reread: Callable[[SparkSession], DataFrame] | None = None,
    ):
        """reread: reads the raw reviews in the given session, where they are stored so that they can well be read more than
        once. Then only reviews with repeated ids are shuffled.
        """
        self.spark = spark
        self.base = base.rstrip("/")
        self.raw_reviews = raw_reviews
        self.raw_products = raw_products
        self._stages = f"{self.base}/_stages-{uuid.uuid4().hex}"
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "reviews": self.cleaned_reviews,
            "products": lambda: cleaning.clean_products(
                self._observed("products", raw_products, "parent_asin")
            ),
            "review_product": lambda: joins.enrich_reviews(
                self.table("reviews"), self.table("products")
            ),
            "product_summary": lambda: summaries.product_summary(self._rollup()),
            "brand_summary": lambda: summaries.brand_summary(self._rollup()),
            "monthly_review_summary": lambda: summaries.monthly_summary(self._grain()),
        }
        self._salts, self._reread = salts, reread
        self._stored: dict[str, DataFrame] = {}
        self._writing = defaultdict(threading.Lock)
        self.seen: dict[str, Observation] = {}
        self.published: Publication | None = None

    def table(self, name: str) -> DataFrame:
        """A stored table, written now if this run has not done so yet."""
        with self._writing[name]:
            if name not in self._stored:
                frame = self._builders[name]()
                log.info("writing %s", tables.table_path(self.base, name))
                tables.write_table(frame, self.base, name)
                self._stored[name] = tables.read_table(self.spark, self.base, name)
            return self._stored[name]

    def build(self, cleaned: Callable[[], None] | None = None) -> ReviewLake:
        """Write all six tables.

        cleaned: called when reviews and products are written, from when on the raw feeds aren't read any more.

        Tables that do not depend on each other are submitted together, so that the last tasks of
        one write do not leave the cluster idle. The caller's job group applies to all of them.
        The stages go when this ends, also when a write fails.
        """
        from_feeds = ["reviews", "products"]
        derived = [name for name in TABLES if name not in from_feeds]
        try:
            _together(self.spark, self.table, from_feeds)
            if cleaned:
                cleaned()
            _together(self.spark, self.table, derived)
        finally:
            self.drop_stages()
        return self

    def drop_stages(self) -> None:
        """Delete the intermediate results; they are made again if a table still needs them."""
        for name in set(self._stored) - set(TABLES):
            del self._stored[name]
        remove_folder(self.spark, self._stages)

    def cleaned_reviews(self) -> DataFrame:
        """The curated reviews, to be written: from the raw feed, of which only rows with repeated ids are shuffled where it can be reread."""
        observed = self._observed("reviews", self.raw_reviews, "parent_asin", "asin")
        repeated = self._repeated(self._reread) if self._reread else None
        if repeated is None or repeated.count() > _BROADCAST_HASHES:
            return cleaning.clean_reviews(observed, self._salts)
        return cleaning.clean_reviews(observed, self._salts, repeated, again=self.raw_reviews)

    def _repeated(self, reread: Callable[[SparkSession], DataFrame]) -> DataFrame:
        """The stored hashes of repeated review ids, counted in small partitions: each row of theirs is one of many in memory."""
        session = narrow_session(self.spark)
        path = f"{self._stages}/repeated_ids-{uuid.uuid4().hex}"
        frame = cleaning.repeated_ids(reread(session))
        tables.write_parquet(frame, path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _grain(self) -> DataFrame:
        return self._stage(
            "product_month_stats", lambda: summaries.product_month_stats(self.table("reviews"))
        )

    def _rollup(self) -> DataFrame:
        return self._stage(
            "product_rollup",
            lambda: summaries.product_rollup(
                self.table("products"), summaries.product_stats_from(self._grain())
            ),
        )

    def _stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self._writing[name]:
            if name not in self._stored:
                path = f"{self._stages}/{name}"
                frame = make()
                tables.write_parquet(frame, path, codec="zstd")
                self._stored[name] = self.spark.read.schema(frame.schema).parquet(path)
            return self._stored[name]

    def _observed(self, name: str, raw: DataFrame, *ids: str) -> DataFrame:
        """The raw feed, counting lines and lines without a key while the table is written.

        Such lines (which include unreadable ones) are dropped by the cleaning; the counts cost no
        extra pass. They go to the log only, since a recomputed task may count twice.
        """
        key = rule.product_key(*[F.col(column) for column in ids])
        self.seen[name] = Observation(f"raw {name}")
        return raw.observe(
            self.seen[name],
            F.count(F.lit(1)).alias("lines"),
            F.count_if(~rule.is_present(key)).alias("without_key"),
        )


def _together(spark: SparkSession, call: Callable, arguments: list) -> None:
    """Calls that submit jobs of their own, at once, under the caller's job group."""
    with ThreadPoolExecutor(len(arguments)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(call), x) for x in arguments]:
            done.result()


def quarantine_path(root: str) -> str:
    """Folder of a run's faulty lines."""
    return f"{root}/quarantine"


def report_path(root: str) -> str:
    """Folder of a run's quality report."""
    return f"{root}/quality"


def read_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """The faulty lines of the current publication's feeds: feed, reason, file, line."""
    return spark.read.schema(feeds.QUARANTINE).parquet(quarantine_path(publication.root_of(spark, base)))


def read_report(spark: SparkSession, base: str) -> DataFrame:
    """The quality report that the current publication has passed."""
    layout = "check_name STRING, observed DOUBLE, expected DOUBLE, passed BOOLEAN"
    return spark.read.schema(layout).parquet(report_path(publication.root_of(spark, base)))


def _stored_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parsed rows of a feed, with LINE and FILE of faulty lines."""
    columns = f"{_FEEDS[name]}, {feeds.LINE} STRING, {feeds.FILE} STRING"
    return spark.read.schema(columns).parquet(f"{root}/_parsed/{name}")


def _parsed(spark: SparkSession, paths: Mapping[str, str], root: str) -> dict[str, DataFrame]:
    """Both feeds as stored rows, their faulty lines in quarantine: each feed is read and parsed once.

    The stored rows are columnar and can be split at their small row groups, whatever the feed's files were
    like, so what follows has even tasks.
    """
    _together(
        spark,
        lambda name: tables.write_parquet(
            feeds.read_with_faults(spark, paths[name], _FEEDS[name]),
            f"{root}/_parsed/{name}",
            row_group_bytes=_ROW_GROUP,
            codec="zstd",
        ),
        list(_FEEDS),
    )
    rows = {name: _stored_rows(spark, root, name) for name in _FEEDS}
    found = feeds.faults(rows["reviews"], "reviews").unionByName(feeds.faults(rows["products"], "products"))
    tables.write_parquet(found.hint("rebalance"), quarantine_path(root))
    return {name: frame.drop(feeds.LINE, feeds.FILE) for name, frame in rows.items()}


def _audited(lake: ReviewLake, limits: Mapping[str, float] | None) -> dict[str, int]:
    """The rows of each table, once the quality report is stored and passed."""
    checked = [lake.table(t) for t in ("reviews", "products", "review_product", "monthly_review_summary")]
    path = report_path(lake.base)
    tables.write_parquet(quality.quality_report(*checked).coalesce(1), path)
    quality.audit(lake.spark.read.parquet(path), limits)
    counts = quality.row_counts({name: lake.table(name) for name in TABLES})
    return {row.table_name: row.row_count for row in counts.collect()}


def run_batch(
    spark: SparkSession,
    reviews_path: str,
    products_path: str,
    base: str,
    partitions: int | None = None,
    spread: bool = False,
    salts: int | None = None,
    limits: Mapping[str, float] | None = None,
    keep: int = 2,
    quarantine: bool = True,
) -> ReviewLake:
    """Read both feeds, write the six tables to a folder of this run's own, audit them, and publish them in ``base``.

    Write, audit, publish: until the last step readers of ``base`` see the publication before, and if
    any step fails they go on seeing it and this run's folder goes. An expectation that isn't met raises
    :class:`quality.AuditFailed`, which names the checks. Runs in a session of its own; the caller's keeps
    its settings.

    partitions: how many partitions shuffles start with (see ``session.partitions_for``), the
    session's number if not given.
    spread: move parsed rows to even partitions, for feeds in few or uneven files that can't be split. With
        quarantine the parsed rows are stored so that they can be split, and no shuffle is needed for this.
    salts: see ``operators.cleaning.keep_first``.
    limits: the most that is allowed of named checks (see ``operators.quality.audit``).
    keep: how many publications stay, this one included.
    quarantine: keep faulty lines (:func:`read_quarantine`); parsed rows are then stored first.
    """
    base = base.rstrip("/")
    own = own_session(spark, partitions)
    root = publication.new_run(base)
    try:
        if quarantine:
            parsed = _parsed(own, {"reviews": reviews_path, "products": products_path}, root)
            raw = [parsed["reviews"], parsed["products"]]
        else:
            raw = [feeds.read_reviews(own, reviews_path), feeds.read_products(own, products_path)]
        # Stored rows can be split, so they need no shuffle to be spread.
        reviews, products = map(feeds.spread, raw) if spread and not quarantine else raw
        reread = (lambda session: _stored_rows(session, root, "reviews").drop(feeds.LINE, feeds.FILE)) if quarantine else None
        # The parsed rows go before the derived tables take their place.
        lake = ReviewLake(own, reviews, products, root, salts, reread).build(lambda: remove_folder(own, f"{root}/_parsed"))
        rows = _audited(lake, limits)
        lake.published = publication.publish(own, base, root, rows)
    except BaseException:
        remove_folder(own, root)
        raise
    for name, seen in lake.seen.items():
        log.info("%s: %s", name, seen.get)
    log.info("published %s as number %d of %s", root, lake.published.version, base)
    publication.vacuum(own, base, keep)
    return lake
