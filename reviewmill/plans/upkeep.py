"""Upkeep of the additive grain: new review files are merged in without reading the old ones again.

Two tables are kept, in generations. ``grain`` is ``product_month_stats``, from which all summaries are
rolled up. ``seen`` has a narrow row for each review id, in buckets of the id: what the review has added to the
grain, and its place in the order in which one of several copies survives.

A delta is cleaned like a full feed, so it has one row for each of its ids. It meets ``seen`` by id, and only the
delta is shuffled, into the buckets. Ids not seen before are added to the grain. Where an id was seen, the survivor of a full
run is the better of the two rows: if that is the new one, the old one's measures are taken off and the new one's
added, otherwise nothing changes. An id fixes its product and time, so both always concern the same
row of the grain. Base plus deltas, in any order, so give what one run over all files gives.

A generation becomes the current one by its manifest (``sources.publication``), like the tables of the batch job. A delta
that has built on a generation which is no longer current fails, and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions import cleaning as rule
from reviewmill.operators import cleaning, summaries
from reviewmill.sources import buckets as store
from reviewmill.sources import publication, tables
from reviewmill.sources.files import remove_folder
from reviewmill.sources.tables import quoted

_MEASURED = ("product_asin", "review_year", "review_month", "rating", "is_verified_purchase", "helpful_vote_count")
#: One column for each rule of the order of survivors; the least row survives.
_PLACE = "place"
#: A delta's surviving rows, kept in the buckets of ``seen`` while they are merged, so that they are shuffled once.
_CHANGED = "changed"


def _place() -> Column:
    """The place of a review among copies of its id, as in ``cleaning.dedup_reviews``: smaller survives."""
    rating, variant = F.col("rating"), F.col("variant_asin")

    def nulls_last(column: Column, name: str) -> list[Column]:
        return [column.isNull().alias(f"no_{name}"), column.alias(name)]

    return F.struct(
        (~F.col("is_verified_purchase")).alias("unverified"),
        (-F.col("helpful_vote_count")).alias("votes"),
        *nulls_last(-rating, "rating"),
        *nulls_last(variant, "variant"),
        F.length("product_asin").alias("product"),
        *nulls_last(F.length("user_id"), "user"),
        *nulls_last(F.length("review_title"), "title"),
        F.isnull("review_text").alias("no_text"),
    )


def _narrow(raw: DataFrame) -> DataFrame:
    """What ``seen`` holds of a feed's reviews. The id as its bytes.

    Only id, product, second and place are shuffled: users, titles and texts count by their lengths alone, and the place has the other measures.
    """
    keyed = cleaning.keyed_reviews(raw).withColumn(_PLACE, _place())
    packed = keyed.select(F.unhex("review_id").alias("review_id"), "product_asin", "review_second", _PLACE)
    unique = cleaning.keep_first(packed, "review_id", [F.asc(_PLACE)])
    time = rule.utc_time(F.col("review_second"))
    measured = {
        "review_year": time.year,
        "review_month": time.month,
        "rating": -F.col(f"{_PLACE}.rating"),
        "is_verified_purchase": ~F.col(f"{_PLACE}.unverified"),
        "helpful_vote_count": -F.col(f"{_PLACE}.votes"),
    }
    return unique.withColumns(measured).select("review_id", *_MEASURED, _PLACE)


class Upkeep:
    """The kept tables of a lake. base: their folder; database: where the buckets of ``seen`` have their entries."""

    def __init__(self, spark: SparkSession, base: str, database: str, buckets: int):
        self.spark, self.base, self.database, self.buckets = spark, base.rstrip("/"), database, buckets

    def _entry(self, root: str) -> str:
        return self._named("seen", root)

    def _named(self, name: str, root: str) -> str:
        generation = root.rsplit("-", 1)[-1]
        return f"{quoted(self.database)}.{quoted(f'{name}_{generation}')}"

    def _seen(self, root: str) -> DataFrame:
        """The rows of a generation, under a new entry if this application's catalog hasn't got it yet."""
        entry = self._entry(root)
        store.create_database(self.spark, self.database, f"{self.base}/catalog")
        if not self.spark.catalog.tableExists(entry):
            layout = self.spark.read.parquet(f"{root}/seen").schema
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in layout)
            self.spark.sql(
                f"CREATE TABLE {entry} ({columns}) USING parquet CLUSTERED BY (review_id) SORTED BY (review_id) "
                f"INTO {self.buckets} BUCKETS LOCATION {tables.text_literal(root + '/seen')}"
            )
        rows = self.spark.table(entry)
        if dict(rows.dtypes)["review_id"] == "string":  # a generation of the earlier layout, once
            rows = rows.withColumn("review_id", F.unhex("review_id"))
        return rows

    def grain(self) -> DataFrame:
        """Measures per product and month of all reviews so far."""
        return self.spark.read.parquet(f"{publication.root_of(self.spark, self.base)}/grain")

    def rollup(self, products: DataFrame) -> DataFrame:
        """Products with their measures, for the summaries by product and brand."""
        return summaries.product_rollup(products, summaries.product_stats_from(self.grain()))

    def add(self, raw_reviews: DataFrame, keep: int = 2) -> publication.Publication:
        """Merge a feed of reviews in, the first one into nothing. keep: how many generations stay."""
        current = publication.current(self.spark, self.base)
        root = publication.new_run(self.base)
        try:
            rows = self._first(raw_reviews, root) if current is None else self._merge(raw_reviews, current.root, root)
            done = publication.publish(self.spark, self.base, root, rows, after=current.version if current else 0)
        except BaseException:
            self._remove(root)
            raise
        for old in publication.history(self.spark, self.base)[max(1, keep) :]:
            store.drop_table(self.spark, self._entry(old.root))
        publication.vacuum(self.spark, self.base, keep)
        return done

    def _remove(self, root: str) -> None:
        for name in ("seen", _CHANGED):
            store.drop_table(self.spark, self._named(name, root))
        remove_folder(self.spark, root)

    def _write_seen(self, rows: DataFrame, root: str, mode: str = "overwrite", name: str = "seen") -> DataFrame:
        """Rows in the buckets of ``seen``."""
        entry = self._named(name, root)
        store.create_database(self.spark, self.database, f"{self.base}/catalog")
        store.write_bucketed(rows, entry, f"{root}/{name}", ["review_id"], self.buckets, mode, codec="zstd")
        return self.spark.table(entry)

    def _first(self, raw: DataFrame, root: str) -> dict[str, int]:
        seen = self._write_seen(_narrow(raw), root)
        tables.write_parquet(summaries.product_month_stats(seen), f"{root}/grain")
        return {"seen": seen.count(), "changed": seen.count()}

    def changes(self, delta: DataFrame, before: str) -> DataFrame:
        """The delta's rows that survive, with the row of ``seen`` that each replaces as ``old`` (NULL for a new id).

        A join in the buckets of ``seen``: only the delta is shuffled.
        """
        old = self._seen(before).select("review_id", F.struct(*_MEASURED, _PLACE).alias("old"))
        found = delta.join(old, "review_id", "left")
        return found.where(F.col("old").isNull() | (F.col(_PLACE) < F.col(f"old.{_PLACE}")))

    def _merge(self, raw: DataFrame, before: str, root: str) -> dict[str, int]:
        changed = self._write_seen(self.changes(_narrow(raw), before), root, name=_CHANGED)
        self._write_seen(self._replaced(changed, before), root)
        self._write_seen(changed.where("old IS NULL").drop("old"), root, "append")
        keys = ("product_asin", "review_year", "review_month")
        names = [*summaries.PRODUCT_MEASURES, *summaries.STAR_MEASURES]
        added = changed.select(*keys, *summaries.review_measures())
        taken = changed.where("old IS NOT NULL").select("old.*").select(*keys, *summaries.review_measures())
        minus = taken.withColumns({name: -F.col(name) for name in names})
        grain = self.spark.read.parquet(f"{before}/grain")
        # Rows are added up with the grain at once, so they are shuffled once.
        merged = grain.unionByName(added).unionByName(minus).groupBy(*keys)
        tables.write_parquet(merged.agg(*[F.sum(name).cast(grain.schema[name].dataType).alias(name) for name in names]), f"{root}/grain")
        rows = {"seen": self.spark.table(self._entry(root)).count(), "changed": changed.count()}
        store.drop_table(self.spark, self._named(_CHANGED, root))
        remove_folder(self.spark, f"{root}/{_CHANGED}")
        return rows

    def _replaced(self, changed: DataFrame, before: str) -> DataFrame:
        """``seen`` with the rows that were replaced: a join in its buckets, from which it is written again without a shuffle."""
        new = changed.where("old IS NOT NULL").select("review_id", F.struct(*_MEASURED, _PLACE).alias("new"))
        old = self._seen(before).select("review_id", F.struct(*_MEASURED, _PLACE).alias("old"))
        row = F.coalesce("new", "old").alias("row")
        return old.join(new, "review_id", "left").select("review_id", row).select("review_id", "row.*")
