"""Raw feeds to curated rows, one row per key, with a repeatable choice of survivor."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions import cleaning as rule
from reviewmill.schemas import TABLES


#: Up to so many rows of one key may reach a reducer in one level.
ONE_LEVEL = 256


def salts_for(frame: DataFrame) -> int:
    """How many groups a hot key is dealt to on the level before the last, from the tasks that read the frame.

    Known when the query is planned: nothing runs. Where a shuffle comes before, its number of partitions counts.
    """
    planned = frame._jdf.queryExecution().executedPlan()
    if planned.nodeName() == "AdaptiveSparkPlan":  # asking for its partitions would run its shuffles
        conf = frame.sparkSession.conf
        shuffled = conf.get("spark.sql.shuffle.partitions")
        tasks = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffled))
    else:
        tasks = planned.execute().getNumPartitions()
    return 1 if tasks <= ONE_LEVEL else math.isqrt(tasks - 1) + 1


def keep_first(frame: DataFrame, key: str, order: list[Column], salts: int | None = None) -> DataFrame:
    """Keep the first row of every key under a total order.

    ``row_number() = 1`` plans a group limit below the shuffle, so each task sends at most one
    row per key: a key that holds a third of all rows costs one row per task, not one huge group.
    With very many tasks that is still a large group for one reducer. ``salts`` above 1 puts a
    level before it, where tasks are dealt to that many groups per key: no reducer then gets more
    than tasks / salts rows of a key on the first level, or ``salts`` on the second. The price is
    a second shuffle. Unless given, it is the square root of the tasks where there are more than
    ONE_LEVEL of them, and 1 otherwise.
    """
    salts = salts_for(frame) if salts is None else salts

    def first(rows: DataFrame, *group: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")

    if salts > 1:
        salted = frame.withColumn("_salt", F.spark_partition_id() % salts)
        frame = first(salted, key, "_salt").drop("_salt")
    return first(frame, key)


def keyed_reviews(raw: DataFrame) -> DataFrame:
    """Typed reviews that have a product key, with their content id; copies still included.

    Time is carried as whole epoch seconds; :func:`file_reviews` turns it into its stored forms
    after the shuffle.
    """
    typed = raw.select(
        rule.product_key(F.col("parent_asin"), F.col("asin")).alias("product_asin"),
        F.col("asin").alias("variant_asin"),
        "user_id",
        rule.valid_rating(F.col("rating")).alias("rating"),
        F.col("title").alias("review_title"),
        F.col("text").alias("review_text"),
        rule.epoch_seconds(F.col("timestamp")).alias("review_second"),
        rule.flag(F.col("verified_purchase")).alias("is_verified_purchase"),
        rule.non_negative_long(F.col("helpful_vote")).alias("helpful_vote_count"),
    ).where(rule.has_text(F.col("product_asin")))
    review_id = rule.content_id(
        F.col("product_asin"),
        F.col("user_id"),
        rule.utc_time(F.col("review_second")).text,
        F.col("review_title"),
        F.col("review_text"),
    )
    return typed.withColumn("review_id", review_id)


def dedup_reviews(keyed: DataFrame, salts: int | None = None) -> DataFrame:
    """One row per review id: verified first, then most votes, best rating, then by content.

    Copies of one id have the same joined content, so where two of their key, user or title
    strings differ, one is a prefix of the other and comparing lengths orders them exactly as
    comparing the strings would; their texts can then differ only in NULL against empty. Ordering
    by lengths keeps title and text out of the shuffle for every consumer that does not read them.
    """
    return keep_first(
        keyed,
        "review_id",
        [
            F.desc("is_verified_purchase"),
            F.desc("helpful_vote_count"),
            F.desc_nulls_last("rating"),
            F.asc_nulls_last("variant_asin"),
            F.length("product_asin").asc(),
            F.length("user_id").asc_nulls_last(),
            F.length("review_title").asc_nulls_last(),
            F.isnull("review_text").asc(),
        ],
        salts,
    )


def file_reviews(reviews: DataFrame, *also: str) -> DataFrame:
    """Curated review layout: stored time, month and the year to partition by; and other columns on request."""
    time = rule.utc_time(F.col("review_second"))
    timed = {"review_timestamp": time.instant, "review_month": time.month, "review_year": time.year}
    return reviews.withColumns(timed).select(*TABLES["reviews"].names, *also)


def clean_reviews(
    raw: DataFrame, salts: int | None = None, repeated: DataFrame | None = None, again: DataFrame | None = None
) -> DataFrame:
    """Curated reviews from the raw feed: one shuffle, by review id (two where tasks are many).

    The id goes through the shuffle as its 32 bytes, half of its text.

    repeated: the stored result of :func:`repeated_ids` on the same rows, small enough to be broadcast. A review whose hash
    isn't in it is the only one of its id and isn't shuffled. The others are compared by their whole ids.
    again: the same rows without the raw feed's observation, for the second time they are read then.
    """
    keyed = keyed_reviews(raw)
    if repeated is None:
        return file_reviews(_unique(keyed, salts))
    other, repeated = keyed if again is None else keyed_reviews(again), F.broadcast(repeated)
    single = keyed.withColumn(ID_HASH, _id_hash()).join(repeated, ID_HASH, "left_anti").drop(ID_HASH)
    several = other.withColumn(ID_HASH, _id_hash()).join(repeated, ID_HASH, "left_semi").drop(ID_HASH)
    return file_reviews(single.unionByName(_unique(several, salts)))


def _unique(keyed: DataFrame, salts: int | None) -> DataFrame:
    unique = dedup_reviews(keyed.withColumn("review_id", F.unhex("review_id")), salts)
    return unique.withColumn("review_id", F.lower(F.hex("review_id")))


#: 64 bits of a review id.
ID_HASH = "_id_hash"


def _id_hash() -> Column:
    return F.xxhash64("review_id")


def repeated_ids(raw: DataFrame) -> DataFrame:
    """The hashes that more than one review of the raw feed has: those of all repeated ids, and of ids that share one by chance.

    One shuffle, of eight bytes and a count a review; an id that a task has many times passes it once.
    """
    hashes = keyed_reviews(raw).groupBy(_id_hash().alias(ID_HASH)).agg(F.count(F.lit(1)).alias("n"))
    return hashes.where(F.col("n") > 1).select(ID_HASH)


def keyed_products(raw: DataFrame) -> DataFrame:
    """Typed products that have a key; copies still included."""
    return raw.select(
        rule.product_key(F.col("parent_asin")).alias("product_asin"),
        F.col("title").alias("product_title"),
        rule.brand(F.col("store")).alias("brand"),
        "main_category",
        rule.price(F.col("price")).alias("price"),
        rule.valid_rating(F.col("average_rating")).alias("metadata_average_rating"),
        rule.non_negative_long(F.col("rating_number")).alias("metadata_review_count"),
    ).where(rule.has_text(F.col("product_asin")))


def dedup_products(keyed: DataFrame) -> DataFrame:
    """One row per product: most reviewed first, then best rated, cheapest, then by name."""
    return keep_first(
        keyed,
        "product_asin",
        [
            F.desc("metadata_review_count"),
            F.desc_nulls_last("metadata_average_rating"),
            F.asc_nulls_last("price"),
            F.asc("brand"),
            F.asc_nulls_last("product_title"),
            F.asc_nulls_last("main_category"),
        ],
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """Curated products from the raw feed: one shuffle, by product key."""
    return dedup_products(keyed_products(raw))
