"""What keeps a task's memory, and what is shuffled and written, in proportion to the input."""

from __future__ import annotations

import os

import pytest
from helpers import PRODUCT, REVIEW, plan, products, reviews, rows
from pyspark.sql import functions as F

from reviewmill.operators import cleaning, joins, quality, summaries
from reviewmill.plans import batch, copartitioned, registry, upkeep
from reviewmill.schemas import TABLES
from reviewmill.sources import buckets, feeds, tables
from reviewmill.sources.session import PARTITION_BYTES, READ_BYTES, SHUFFLES_GO, narrow_session, own_session

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_products_are_not_counted_in_one_task(spark, tmp_path, monkeypatch):
    own = own_session(spark)
    raw = reviews(own, *[{"user_id": f"u{i}", "parent_asin": f"P{i % 3 if i < 90 else 7}"} for i in range(300)])
    listed = cleaning.clean_products(products(own, {"parent_asin": "P7"}, {"parent_asin": "P1"}))
    kind = type(raw)
    coalesce = kind.coalesce
    seen = []
    monkeypatch.setattr(kind, "coalesce", lambda frame, n: seen.append(n) or coalesce(frame, n))
    copartitioned.write_layout(own, "growth_buckets", f"{tmp_path}/l", cleaning.clean_reviews(raw), listed, buckets=4)
    assert not seen
    found = own.read.parquet(f"{tmp_path}/l/sliced_products")
    assert rows(found) == [("P7", 3)]


def test_reviews_are_written_by_the_tasks_that_have_them(spark, tmp_path, monkeypatch):
    asked = []
    write = tables.write_parquet

    def spy(frame, path, *args, **kwargs):
        write(frame, path, *args, **kwargs)
        asked.append(path.rsplit("/", 1)[-1])

    hints = []
    kind = type(spark.range(1))
    hint = kind.hint
    monkeypatch.setattr(tables, "write_parquet", spy)
    monkeypatch.setattr(kind, "hint", lambda frame, name, *columns: hints.append((name, columns)) or hint(frame, name, *columns))
    raw = [reviews(spark, REVIEW, {"timestamp": None}, {"timestamp": 1}), products(spark, PRODUCT)]
    lake = batch.ReviewLake(own_session(spark), *raw, str(tmp_path))
    assert lake.table("reviews").count() == lake.table("review_product").count() == 3
    assert lake.table("reviews").select("review_year").distinct().count() == 3
    assert {"reviews", "review_product"} <= set(asked) and not hints


def test_stored_rows_are_not_spread_again(spark, tmp_path, monkeypatch):
    feeds.write_feed(reviews(spark, REVIEW), f"{tmp_path}/r")
    feeds.write_feed(products(spark, PRODUCT), f"{tmp_path}/p")
    spread, calls = feeds.spread, []
    monkeypatch.setattr(feeds, "spread", lambda feed: calls.append(feed) or spread(feed))
    for quarantine, expected in ((True, 0), (False, 2)):
        calls.clear()
        lake = batch.run_batch(spark, f"{tmp_path}/r", f"{tmp_path}/p", f"{tmp_path}/l{quarantine}", spread=True, quarantine=quarantine)
        assert len(calls) == expected and lake.table("reviews").count() == 1


def test_small_row_groups_split_a_file(spark, tmp_path):
    frame = spark.range(0, 200_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    parts = {}
    own = own_session(spark, growth=128.0)
    for size in (None, 1 << 20):
        tables.write_parquet(frame, f"{tmp_path}/{size}", row_group_bytes=size)
        read = own.read.parquet(f"{tmp_path}/{size}")
        parts[size] = read.where("key is not null").groupBy(F.spark_partition_id()).count().count()
        assert read.count() == 200_000
    assert parts[None] == 1 < parts[1 << 20]


def test_tasks_read_what_turns_into_one_shuffle_partition(spark, settings):
    assert own_session(spark, growth=6.0).conf.get(READ_BYTES) == str(int(PARTITION_BYTES / 6))
    settings(**{READ_BYTES.replace(".", "__"): "1m"})
    assert own_session(spark, growth=6.0).conf.get(READ_BYTES) == str(1 << 20)  # the caller's smaller one stays


@pytest.mark.parametrize("wanted", [["review_id"], ["product_asin"]])
def test_ids_are_shuffled_as_bytes(spark, wanted):
    raw = reviews(spark, REVIEW, {"user_id": "v"}, REVIEW)
    cleaned = cleaning.clean_reviews(raw).select(*wanted)
    assert "unhex(" in plan(cleaned).split("Exchange hashpartitioning")[1]
    assert rows(cleaned) == rows(cleaning.keyed_reviews(raw).distinct().select(*wanted))


def copies(spark):
    many = [{"user_id": f"u{i % 40}", "helpful_vote": i, "asin": "A" if i % 3 else None} for i in range(60)]
    return reviews(spark, REVIEW, *many, {"parent_asin": None, "asin": None}, {"text": None}, {"text": ""})


def test_only_reviews_with_repeated_ids_are_shuffled(spark, tmp_path):
    raw = copies(spark)
    plain = cleaning.clean_reviews(raw)
    keyed = cleaning.keyed_reviews(raw)
    often = keyed.groupBy("review_id").count().where("count > 1").select(F.xxhash64("review_id"))
    hashes = cleaning.repeated_ids(raw)
    assert rows(hashes) == rows(often) and 0 < hashes.count() < plain.count()
    tables.write_parquet(hashes, f"{tmp_path}/h")
    found = cleaning.clean_reviews(raw, repeated=spark.read.parquet(f"{tmp_path}/h"))
    assert rows(found) == rows(plain)
    shown = plan(cleaning.clean_reviews(raw, repeated=spark.read.parquet(f"{tmp_path}/h")))
    assert shown.count("Exchange hashpartitioning") == 1 and "LeftAnti" in shown
    # An id that shares its hash by chance is compared by itself.
    everything = keyed.select(F.xxhash64("review_id").alias(cleaning.ID_HASH)).distinct()
    assert rows(cleaning.clean_reviews(raw, repeated=everything)) == rows(plain)


@pytest.mark.parametrize("most", [1 << 21, 0])
def test_a_lake_of_stored_feeds_has_the_same_reviews(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(batch, "_BROADCAST_HASHES", most)
    path, read = f"{tmp_path}/raw", []
    copies(spark).write.parquet(path)

    def reread(session):
        read.append(session)
        return session.read.parquet(path)

    own = own_session(spark)
    listed = products(own, PRODUCT)
    lake = batch.ReviewLake(own, own.read.parquet(path), listed, f"{tmp_path}/l", reread=reread)
    assert rows(lake.table("reviews")) == rows(cleaning.clean_reviews(copies(spark)))
    assert len(read) == 1 and lake.seen["reviews"].get["lines"] == copies(spark).count()
    assert lake.seen["reviews"].get["without_key"] == 1


def test_digest_ids_are_not_shuffled_for_the_join(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    listed = cleaning.clean_products(products(spark, PRODUCT, {"parent_asin": "P2"}))
    digests = cleaning.clean_reviews(copies(spark))
    odd = F.when(F.col("user_id") == "u1", None).when(F.col("user_id") == "u2", "my id").otherwise(F.col("review_id"))
    for curated in (digests, digests.withColumn("review_id", odd), digests.withColumn("review_timestamp", F.lit(None).cast("timestamp"))):
        plain = curated.join(listed, "product_asin", "left")
        found = joins.enrich_reviews(curated, listed)
        assert found.dtypes == plain.dtypes and rows(found) == rows(plain)
        assert "sha2(" in plan(found).split("SortMergeJoin")[0]
    narrow = digests.select("review_id", "product_asin")
    assert rows(joins.enrich_reviews(narrow, listed)) == rows(narrow.join(listed, "product_asin", "left"))


def test_years_are_written_without_a_sort(spark, tmp_path):
    own = own_session(spark)
    assert int(own.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    assert own.conf.get(ADVISORY) == "64m" and int(narrow_session(own).conf.get(ADVISORY)) == PARTITION_BYTES // 8
    frame = own.range(0, 300, 1, 1).select("id", (F.col("id") % 100).cast("int").alias("review_year"))  # more years than writers
    tables.write_parquet(frame, f"{tmp_path}/t", ["review_year"], rebalance=False)
    assert rows(own.read.parquet(f"{tmp_path}/t")) == rows(frame)


def test_upkeep_shuffles_ids_and_places_alone(spark, tmp_path):
    raw = copies(spark)
    narrow = upkeep._narrow(raw)
    above, below = plan(narrow).split("Exchange hashpartitioning")
    assert dict(narrow.dtypes)["review_id"] == "binary"
    assert "review_title" not in above and "[place#" in below and "_w0" not in below
    curated = cleaning.clean_reviews(raw)
    names = [name for name in narrow.columns if name not in ("review_id", "place")]
    assert rows(narrow.select(F.lower(F.hex("review_id")), *names)) == rows(curated.select("review_id", *names))
    assert rows(curated.groupBy().agg(*summaries.measures())) == rows(
        curated.select(*summaries.review_measures()).groupBy().agg(*[F.sum(name) for name in summaries.PRODUCT_MEASURES + summaries.STAR_MEASURES])
    )


def test_a_generation_with_ids_as_text_is_still_read(spark, tmp_path, monkeypatch):
    own, narrow = own_session(spark), upkeep._narrow
    kept = upkeep.Upkeep(own, str(tmp_path), "growth_text_ids", buckets=4)
    monkeypatch.setattr(upkeep, "_narrow", lambda raw: narrow(raw).withColumn("review_id", F.lower(F.hex("review_id"))))
    first = kept.add(copies(own))
    monkeypatch.undo()
    again = kept.add(copies(own))
    assert again.rows == {"seen": first.rows["seen"], "changed": 0}
    later = kept.add(reviews(own, {"user_id": "new"}))
    assert later.rows == {"seen": first.rows["seen"] + 1, "changed": 1}
    assert not [name for name in os.listdir(later.root) if "changed" in name]


def test_review_tables_are_packed_with_zstd(spark, tmp_path):
    raw = [reviews(spark, REVIEW, {"user_id": "v"}), products(spark, PRODUCT)]
    lake = batch.ReviewLake(own_session(spark), *raw, str(tmp_path)).build()
    ends = {name: {f.split(".", 1)[1].removeprefix("c000.") for _, _, files in os.walk(tables.table_path(lake.base, name)) for f in files if f.endswith(".parquet")} for name in TABLES}
    assert ends.pop("reviews") == ends.pop("review_product") == {"zstd.parquet"}
    assert set.union(*ends.values()) == {"snappy.parquet"}


def test_shuffle_files_go_with_their_query(spark):
    own = own_session(spark)
    assert own.conf.get(SHUFFLES_GO) == "true" and spark.conf.get(SHUFFLES_GO, "false") == "false"
    frame = cleaning.clean_reviews(reviews(own, REVIEW, {"user_id": "v"}, REVIEW))
    assert rows(frame) == rows(frame) and len(rows(frame)) == 2  # computed again where it is asked for again


def test_the_sink_shuffles_only_reviews_with_repeated_ids(spark, tmp_path, monkeypatch):
    copies(spark).write.parquet(f"{tmp_path}/raw")
    own = own_session(spark)

    def read(session):
        return session.read.parquet(f"{tmp_path}/raw")

    lake = batch.ReviewLake(own, read(own), products(own, PRODUCT), f"{tmp_path}/l", reread=read)
    monkeypatch.setattr(registry, "lake", lambda *_: lake)
    written, write = [], tables.write_table
    monkeypatch.setattr(tables, "write_table", lambda frame, *where: written.append(plan(frame)) or write(frame, *where))
    found = registry.STORAGE["sink_partitioned_roundtrip"](spark, "unused")
    assert rows(found.drop("review_timestamp")) == rows(cleaning.clean_reviews(copies(spark)).drop("review_timestamp").select(found.drop("review_timestamp").columns))
    assert "LeftAnti" in written[0] and written[0].count("Exchange hashpartitioning") == 1


def test_parsed_rows_go_before_derived_tables_are_written(spark, tmp_path, monkeypatch):
    feeds.write_feed(reviews(spark, REVIEW), f"{tmp_path}/r")
    feeds.write_feed(products(spark, PRODUCT), f"{tmp_path}/p")
    seen, enrich = [], joins.enrich_reviews

    def spy(*given):
        seen.extend(name for folder in os.scandir(f"{tmp_path}/l/runs") for name in os.listdir(folder))
        return enrich(*given)

    monkeypatch.setattr(joins, "enrich_reviews", spy)
    batch.run_batch(spark, f"{tmp_path}/r", f"{tmp_path}/p", f"{tmp_path}/l")
    assert "curated" in seen and "_parsed" not in seen


def test_ids_are_counted_by_hashes(spark):
    listed = products(spark, PRODUCT).select(F.col("parent_asin").alias("product_asin"))
    digest = F.sha2("id", 256)
    for ids in ([], ["a", "b"], ["a", "b", "a", "a"], [None, "a"], [None, None, "a", "a"], ["", None]):
        given = spark.createDataFrame([(x,) for x in ids], "id string")
        for frame in (given.select(F.col("id").alias("review_id")), given.select(digest.alias("review_id"))):
            found = quality.duplicate_ids(frame, listed)
            assert rows(found) == [("products", 0), ("reviews", len(ids) - len(set(ids) - {None}))]
    shown = plan(quality.duplicate_ids(frame, listed))
    assert "xxhash64(" in shown and "ubquery" in shown


def test_buckets_are_written_without_shuffling_digests(spark, tmp_path, monkeypatch):
    own = own_session(spark)
    listed = cleaning.clean_products(products(own, PRODUCT, {"parent_asin": "P2"}))
    curated = cleaning.clean_reviews(copies(own))
    odd = F.when(F.col("user_id") == "u1", None).when(F.col("user_id") == "u2", "my id").otherwise(F.col("review_id"))
    shown, write = {}, buckets.write_bucketed

    def spy(frame, entry, path, *args, **kwargs):
        write(frame, entry, path, *args, **kwargs)
        shown[path.rsplit("/", 1)[-1]] = plan(frame)

    monkeypatch.setattr(buckets, "write_bucketed", spy)
    for i, given in enumerate((curated, curated.withColumn("review_id", odd))):
        given.write.parquet(f"{tmp_path}/{i}")
        stored = own.read.parquet(f"{tmp_path}/{i}")
        copartitioned.write_layout(own, f"growth_digests_{i}", f"{tmp_path}/l{i}", stored, listed, buckets=4)
        found = copartitioned.enriched(own, f"growth_digests_{i}")
        assert rows(found) == rows(stored.join(listed, "product_asin", "left").select(found.columns))
        above, below = shown[copartitioned.REVIEWS].split("Exchange hashpartitioning", 1)
        assert "sha2(" in above and "_is_digest" in below
        assert all(".zstd." in f for f in os.listdir(f"{tmp_path}/l{i}/{copartitioned.REVIEWS}") if f.endswith(".parquet") and not f.startswith("."))
