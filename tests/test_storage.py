"""Feeds, stored tables, catalog and the batch job."""

from __future__ import annotations

import gzip
import json
import logging
import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from helpers import PRODUCT, REVIEW, plan, rows
from reviewmill.operators import cleaning, joins, summaries
from reviewmill import __main__ as command
from reviewmill.plans import batch, registry
from reviewmill.plans.supplied import raw_products, raw_reviews
from reviewmill.schemas import TABLES
from reviewmill.sources import feeds, publication, session, tables


def write_lines(folder, *lines):
    folder.mkdir()
    with gzip.open(folder / "part.jsonl.gz", "wt", encoding="utf-8") as out:
        for line in lines:
            out.write(line if isinstance(line, str) else json.dumps(line))
            out.write("\n")
    return str(folder)


def test_wrong_types_are_null_and_broken_lines_vanish(spark, tmp_path):
    path = write_lines(
        tmp_path / "r",
        REVIEW,
        {**REVIEW, "rating": "5.0", "helpful_vote": "3", "verified_purchase": "true"},
        {**REVIEW, "timestamp": 1.7e12, "rating": "NaN", "extra": {"deep": [1]}},
        '{"rating": 5.0, "parent_asin": ',
        "",
    )
    raw = feeds.read_reviews(spark, path)
    got = raw.collect()
    assert [r.rating for r in got][:2] == [5.0, None]
    assert got[1].helpful_vote is None and got[1].verified_purchase is None
    assert got[2].timestamp is None and got[2].rating != got[2].rating
    assert "extra" not in raw.columns
    # The first two lines are one review; the third has no usable time and so another id.
    assert rows(cleaning.clean_reviews(raw), "review_year") == [(0,), (2023,)]


def test_number_prices_stay_readable(spark, tmp_path):
    path = write_lines(tmp_path / "p", PRODUCT, '{"parent_asin": "P2", "price": 12.90}')
    cleaned = cleaning.clean_products(feeds.read_products(spark, path))
    assert [(k, str(p)) for k, p in rows(cleaned, "product_asin", "price")] == [
        ("P1", "10.00"),
        ("P2", "12.90"),
    ]


@pytest.mark.parametrize("codec", ["gzip", "deflate", "lz4", "snappy", "none"])
def test_feeds_are_spread_on_request_whatever_their_codec(spark, tmp_path, codec):
    path = str(tmp_path / "r")
    try:
        spark.createDataFrame([(json.dumps(REVIEW),)], "value STRING").write.text(path, compression=codec)
    except Exception as error:  # some builds lack native codecs
        if "native" not in str(error).lower():
            raise
        pytest.skip(f"no native {codec} here")
    raw = feeds.read_reviews(spark, path)
    assert "REBALANCE" not in plan(raw)
    assert "REBALANCE_PARTITIONS" in plan(feeds.spread(raw))
    assert feeds.spread(raw).count() == 1


def test_partitioned_write_merges_small_tasks(spark, tmp_path):
    frame = spark.range(0, 8000, 1, 40).select("id", (F.col("id") % 4).cast("int").alias("year"))
    tables.write_parquet(frame, f"{tmp_path}/t", ["year"])
    for year in range(4):
        folder = tmp_path / "t" / f"year={year}"
        assert len([n for n in os.listdir(folder) if n.endswith(".snappy.parquet")]) == 1
    tables.write_parquet(frame.limit(1), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1


def test_a_large_partition_is_split_over_tasks(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB")
    frame = spark.range(0, 20000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("key"), F.lit(2020).alias("year")
    )
    tables.write_parquet(frame, f"{tmp_path}/t", ["year"])
    files = [n for n in os.listdir(tmp_path / "t" / "year=2020") if n.endswith(".parquet")]
    assert len(files) > 4
    assert spark.read.parquet(f"{tmp_path}/t").count() == 20000


@pytest.fixture(scope="module")
def feed_paths(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("feeds")
    feeds.write_feed(raw_reviews(spark, SMALL), f"{base}/reviews")
    feeds.write_feed(raw_products(spark, SMALL), f"{base}/products")
    return f"{base}/reviews", f"{base}/products"


@pytest.fixture(scope="module")
def lake(spark, feed_paths, tmp_path_factory):
    return batch.run_batch(spark, *feed_paths, str(tmp_path_factory.mktemp("lake")))


def test_batch_writes_six_tables_in_their_layout(spark, lake):
    for name, table in TABLES.items():
        stored = spark.read.parquet(tables.table_path(lake.base, name))
        assert stored.columns == table.names
        assert stored.count() == lake.table(name).count() > 0
        assert stored.dtypes == lake.table(name).dtypes
    folders = os.listdir(f"{lake.base}/curated/reviews")
    assert "review_year=0" in folders and "review_year=1998" in folders


def test_batch_counts_lines_without_an_extra_pass(lake, spark, feed_paths):
    seen = lake.seen["reviews"].get
    assert seen["lines"] == spark.read.text(feed_paths[0]).count()
    assert 0 < seen["without_key"] < seen["lines"]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_batch_repeats_exactly(spark, settings, lake, feed_paths, tmp_path, partitions):
    settings(
        spark__sql__shuffle__partitions=str(partitions), spark__sql__session__timeZone="Asia/Tokyo"
    )
    again = batch.run_batch(spark, *feed_paths, str(tmp_path), partitions, spread=partitions > 1)
    for name in TABLES:
        assert rows(again.table(name)) == rows(lake.table(name))


def test_averages_of_awkward_ratings_do_not_depend_on_partitions(spark):
    ratings = spark.range(2000).select(
        F.lit("p").alias("product_asin"), F.lit(2020).alias("review_year"), F.lit("m").alias("review_month"),
        F.when(F.col("id") < 1000, 4.1).when(F.col("id") < 1990, 3.9).otherwise(4.0).alias("rating"),
        F.lit(True).alias("is_verified_purchase"), F.lit(0).alias("helpful_vote_count"),
    )
    for n in range(1, 7):
        grain = summaries.product_month_stats(ratings.repartition(n))
        assert [r.average_rating for r in summaries.monthly_summary(grain).collect()] == [4.001]
        stats = summaries.product_review_stats(summaries.product_stats_from(grain))
        assert [r.average_review_rating for r in stats.collect()] == [4.001]


def test_a_second_run_replaces_the_first(spark, lake, feed_paths, tmp_path):
    few = write_lines(tmp_path / "few", REVIEW)
    base = str(tmp_path / "base")
    batch.run_batch(spark, *feed_paths, base)
    batch.run_batch(spark, few, feed_paths[1], base)
    assert tables.read_table(spark, base, "reviews").count() == 1
    current = publication.root_of(spark, base)
    assert os.listdir(f"{current}/curated/reviews").count("review_year=1998") == 0


def test_catalog(spark, lake):
    before = spark.catalog.currentDatabase()
    assert tables.tables_present(spark, "default").where("is_present").count() == 0
    tables.register_tables(spark, lake.base, "shop")
    tables.register_tables(spark, lake.base, "shop")
    assert tables.tables_present(spark, "shop").where("is_present").count() == 6
    tables.use_database(spark, "shop")
    try:
        by_name = spark.sql(
            "SELECT review_month, sum(review_count) AS n FROM monthly_review_summary "
            "WHERE review_year <> '0' GROUP BY ALL ORDER BY review_month"
        )
        assert by_name.count() == lake.table("monthly_review_summary").count() - 1
        detail = spark.sql(
            "SELECT rating, brand FROM review_product WHERE review_year = '1998' LIMIT 100"
        )
        assert detail.count() == 100
        assert "PartitionFilters: [isnotnull(review_year" in plan(detail)
        ranked = spark.sql(
            "SELECT brand FROM brand_summary WHERE review_count >= 10 "
            "ORDER BY review_count DESC LIMIT 30"
        )
        assert ranked.count() > 0
        missing = spark.sql(
            "SELECT 'reviews' AS t, count(*) AS n FROM reviews WHERE trim(product_asin) = '' "
            "UNION ALL SELECT 'products', count(*) FROM products WHERE product_asin IS NULL"
        )
        assert rows(missing, "n") == [(0,), (0,)]
    finally:
        tables.use_database(spark, before)


def test_tables_are_written_once_per_application(spark):
    first = registry.lake(spark, SMALL)
    assert registry.lake(spark, SMALL) is first
    path = tables.table_path(first.base, "products")
    first.table("products")
    stamp = os.stat(f"{path}/_SUCCESS").st_mtime_ns
    registry.QUERIES["total_products"](spark, SMALL)
    assert os.stat(f"{path}/_SUCCESS").st_mtime_ns == stamp


def test_scratch_lies_in_the_shared_folder(spark, settings):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (session.scratch_folder(spark, "x") for _ in range(2))
    assert first.startswith(shared) and first != second


def test_shuffles_grow_with_the_input():
    assert session.partitions_for(1) == 1
    assert session.partitions_for(100 * session.PARTITION_BYTES) == 100
    assert session.partitions_for(100 * session.PARTITION_BYTES, growth=6) == 600
    assert session.partitions_for(10**16) > 70_000_000


def test_each_lake_has_partitions_of_its_own_and_the_callers_stay(spark, tmp_path):
    before = dict(spark.conf.getAll)
    small, large = (session.own_session(spark, n) for n in (3, 7))
    seen = {}

    def build(name, own):
        lake = batch.ReviewLake(own, raw_reviews(own, SMALL), raw_products(own, SMALL), f"{tmp_path}/{name}")
        lake.build()
        seen[name] = lake.spark.conf.get(session.INITIAL_PARTITIONS)

    threads = [threading.Thread(target=build, args=a) for a in (("small", small), ("large", large))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert seen == {"small": "3", "large": "7"}
    registry.QUERIES["total_products"](spark, SMALL).collect()
    assert dict(spark.conf.getAll) == before


def test_a_larger_folder_gets_its_own_number(spark, monkeypatch, settings):
    settings(spark__sql__shuffle__partitions="1")
    monkeypatch.setattr(registry, "GROWTH", 6e4)
    monkeypatch.setattr(registry, "_lakes", {})
    first, second = (registry.lake(spark, d) for d in (SMALL, MEDIUM))
    numbers = [int(lake.spark.conf.get(session.INITIAL_PARTITIONS)) for lake in (first, second)]
    assert 1 < numbers[0] < numbers[1]


def folders(base):
    return {d for d in os.listdir(base) if not d.startswith(".")}


def test_stages_go_after_success_and_failure(spark, feed_paths, tmp_path, monkeypatch):
    batch.run_batch(spark, *feed_paths, f"{tmp_path}/good")
    assert folders(f"{tmp_path}/good") == {"runs", "_published"}
    assert folders(publication.root_of(spark, f"{tmp_path}/good")) == {"curated", "analytics", "quality", "quarantine"}
    write = tables.write_table

    def failing(frame, base, name):
        if name == "brand_summary":
            raise RuntimeError("disk full")
        write(frame, base, name)

    monkeypatch.setattr(tables, "write_table", failing)
    with pytest.raises(RuntimeError, match="disk full"):
        batch.run_batch(spark, *feed_paths, f"{tmp_path}/bad")
    assert folders(f"{tmp_path}/bad") == {"runs"} and not folders(f"{tmp_path}/bad/runs")


def test_a_hot_id_in_many_tasks_reaches_no_reducer_whole(spark, settings):
    settings(spark__sql__shuffle__partitions="64", spark__sql__adaptive__enabled="false")
    hot = spark.range(0, 6400, 1, 400).select(
        F.when(F.col("id") % 7 < 7, "x").otherwise("y").alias("id"), F.col("id").alias("n"), F.lit("text").alias("text")
    )
    found = cleaning.keep_first(hot, "id", [F.desc("n")])
    assert [tuple(r) for r in found.collect()] == [("x", 6399, "text")]
    assert plan(found).count("Exchange") == 2
    # On the first level a group holds the tasks of one salt, on the second the salts of one id.
    dealt = hot.select(F.spark_partition_id().alias("task")).distinct()
    per_salt = dealt.groupBy((F.col("task") % 20).alias("salt")).count()
    assert {r["count"] for r in per_salt.collect()} == {20} and per_salt.count() == 20


def test_readers_never_miss_a_table_while_it_is_registered(spark, feed_paths, tmp_path):
    base, few = str(tmp_path / "base"), write_lines(tmp_path / "few", REVIEW)
    batch.run_batch(spark, *feed_paths, base)
    tables.register_tables(spark, base, "steady")
    before, seen, failed, done = spark.table("steady.reviews").count(), set(), [], threading.Event()

    def read():
        own = spark.newSession()
        while not done.is_set():
            try:
                seen.add(own.sql("SELECT count(*) AS n FROM steady.reviews").first()["n"])
            except Exception as error:  # whatever it is, the test names it
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        batch.run_batch(spark, few, feed_paths[1], base)
        tables.register_tables(spark, base, "steady")
        tables.register_tables(spark, base, "steady")
    finally:
        done.set()
        reader.join()
    assert not failed and seen <= {before, 1}
    assert spark.table("steady.reviews").count() == 1
    # Both publications are kept, so are their entries; with a third run the first one's go.
    assert spark.sql("SHOW TABLES IN steady__stored").count() == 12
    batch.run_batch(spark, few, feed_paths[1], base)
    tables.register_tables(spark, base, "steady")
    assert spark.sql("SHOW TABLES IN steady__stored").count() == 12 and spark.table("steady.reviews").count() == 1


def test_the_planner_follows_registered_figures(spark, lake, settings):
    tables.register_tables(spark, lake.base, "figured")
    tables.register_tables(spark, lake.base, "plain", statistics=False)
    settings(spark__sql__cbo__enabled="true", spark__sql__adaptive__enabled="false")

    def joined(database):
        products = spark.table(f"{database}.products").select("product_asin", "brand")
        return joins.enrich_reviews(spark.table(f"{database}.reviews").select("review_id", "product_asin"), products)

    def rows(database):
        figures = spark.table(f"{database}.products").select("product_asin")._jdf.queryExecution().optimizedPlan().stats()
        return int(str(figures.rowCount().get())) if figures.rowCount().isDefined() else None

    count = lake.table("products").count()
    assert rows("figured") == count and rows("plain") is None
    small = spark.table("figured.products").select("product_asin", "brand")._jdf.queryExecution().optimizedPlan().stats()
    size = int(str(small.sizeInBytes()))
    # A threshold just above and just below what the rows take decides.
    settings(spark__sql__autoBroadcastJoinThreshold=str(size + 1))
    assert "BroadcastHashJoin" in plan(joined("figured"))
    settings(spark__sql__autoBroadcastJoinThreshold=str(size - 1))
    assert "BroadcastHashJoin" not in plan(joined("figured"))


def test_an_earlier_entry_gives_way(spark, lake):
    spark.sql("CREATE DATABASE IF NOT EXISTS earlier")
    spark.sql(f"CREATE TABLE earlier.products USING parquet LOCATION '{tables.table_path(publication.root_of(spark, lake.base), 'products')}'")
    tables.register_tables(spark, lake.base, "earlier")
    assert spark.catalog.getTable("earlier.products").tableType == "VIEW"
    assert spark.table("earlier.products").count() == lake.table("products").count()


def test_names_and_paths_with_quotes(spark, lake, tmp_path):
    base = f"{tmp_path}/it's a `lake`"
    for name in TABLES:
        tables.write_table(lake.table(name), base, name)
    tables.register_tables(spark, base, "order")
    assert tables.tables_present(spark, "order").where("is_present").count() == 6
    assert spark.table("`order`.reviews").count() == lake.table("reviews").count()


def test_stored_bytes(spark, tmp_path):
    path = write_lines(tmp_path / "r", REVIEW)
    assert feeds.stored_bytes(spark, path) == os.stat(f"{path}/part.jsonl.gz").st_size


def test_batch_logs_what_it_wrote_and_what_it_read(caplog, spark, feed_paths, tmp_path):
    with caplog.at_level(logging.INFO, logger="reviewmill.plans.batch"):
        batch.run_batch(spark, *feed_paths, str(tmp_path))
    assert sum("writing" in r.getMessage() for r in caplog.records) == 6
    assert any("without_key" in r.getMessage() for r in caplog.records)


def test_empty_feeds_give_empty_tables(spark, tmp_path):
    for name in ("reviews", "products"):
        (tmp_path / name).mkdir()
    base = str(tmp_path / "base")
    lake = batch.run_batch(spark, str(tmp_path / "reviews"), str(tmp_path / "products"), base)
    assert {name: lake.table(name).count() for name in TABLES} == dict.fromkeys(TABLES, 0)
    tables.register_tables(spark, base, "nothing")
    assert spark.table("nothing.reviews").count() == 0


def test_command_line(spark, monkeypatch, feed_paths, tmp_path):
    base = str(tmp_path)
    monkeypatch.setattr("sys.argv", ["reviewmill", *feed_paths, base, "--database", "by_command"])
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    command.main()
    assert spark.table("by_command.reviews").count() == 6153
