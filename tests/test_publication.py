"""Write, audit, publish: readers see one whole publication, whatever becomes of a run."""

from __future__ import annotations

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from helpers import PRODUCT, REVIEW, plan, rows
from reviewmill import __main__ as command
from reviewmill.operators import cleaning, quality
from reviewmill.plans import batch
from reviewmill.plans.supplied import odd_lines
from reviewmill.schemas import TABLES
from reviewmill.sources import feeds, files, publication, tables
from test_storage import write_lines


@pytest.fixture(scope="module")
def small_feeds(tmp_path_factory):
    base = tmp_path_factory.mktemp("small")
    reviews = [{**REVIEW, "user_id": f"u{i}", "parent_asin": f"P{i % 3}"} for i in range(9)]
    return write_lines(base / "r", *reviews), write_lines(base / "p", PRODUCT)


@pytest.fixture(scope="module")
def larger_feeds(tmp_path_factory):
    base = tmp_path_factory.mktemp("larger")
    reviews = [{**REVIEW, "user_id": f"u{i}", "parent_asin": f"P{i % 5}"} for i in range(20)]
    return write_lines(base / "r", *reviews), write_lines(base / "p", PRODUCT, {**PRODUCT, "parent_asin": "P2"})


def contents(spark, base):
    return {name: rows(frame) for name, frame in tables.read_tables(spark, base).items()}


@pytest.mark.parametrize("fails", [1, 5])
def test_a_run_that_fails_at_any_write_leaves_six_old_tables(
    spark, small_feeds, larger_feeds, tmp_path, monkeypatch, fails
):
    base = str(tmp_path)
    batch.run_batch(spark, *small_feeds, base)
    before = contents(spark, base)
    write, calls, lock = tables.write_table, [], threading.Lock()

    def failing(frame, to, name):
        with lock:
            calls.append(name)
            last = len(calls) == fails
        if last:
            raise OSError("disk full")
        write(frame, to, name)

    monkeypatch.setattr(tables, "write_table", failing)
    with pytest.raises(OSError, match="disk full"):
        batch.run_batch(spark, *larger_feeds, base)
    assert len(calls) >= fails
    assert contents(spark, base) == before and len(before["reviews"]) == 9
    assert os.listdir(f"{base}/runs") == [os.path.basename(publication.root_of(spark, base))]
    monkeypatch.undo()
    batch.run_batch(spark, *larger_feeds, base)
    after = contents(spark, base)
    assert len(after["reviews"]) == 20 and all(after[name] != before[name] for name in TABLES)


def test_a_run_killed_before_it_publishes_changes_nothing(spark, small_feeds, tmp_path):
    """What a killed driver leaves: a run folder without a manifest, and a manifest half written."""
    base = str(tmp_path)
    first = batch.run_batch(spark, *small_feeds, base)
    tables.write_table(first.table("products").limit(0), f"{base}/runs/killed", "products")
    files.create_text(spark, f"{base}/_published/{2:012d}.json", '{"root": "runs/kil')
    assert publication.current(spark, base).version == 1
    assert tables.read_table(spark, base, "products").count() == 1
    again = batch.run_batch(spark, *small_feeds, base)
    assert again.published.version == 3 and publication.current(spark, base) == again.published


def test_a_failing_expectation_publishes_nothing_and_is_named(spark, small_feeds, larger_feeds, tmp_path, monkeypatch):
    base = str(tmp_path)
    batch.run_batch(spark, *small_feeds, base)
    before = contents(spark, base)
    with pytest.raises(quality.AuditFailed, match="unmatched_reviews") as failed:
        batch.run_batch(spark, *larger_feeds, base, limits={"unmatched_reviews": 3, "unmatched_percent": 99})
    assert failed.value.failed == {"unmatched_reviews": 12.0}
    file_reviews = cleaning.file_reviews
    monkeypatch.setattr(cleaning, "file_reviews", lambda r: file_reviews(r).withColumn("rating", F.lit(7.0)))
    with pytest.raises(quality.AuditFailed, match="invalid_ratings: 20"):
        batch.run_batch(spark, *larger_feeds, base)
    assert contents(spark, base) == before and publication.current(spark, base).version == 1
    assert len(os.listdir(f"{base}/runs")) == 1


def test_audit_of_a_report(spark):
    layout = "check_name string, observed double, expected double, passed boolean"
    made = [("a", 0.0, 0.0, True), ("b", 2.0, 0.0, False), ("rows_c", 5.0, None, None), ("share", None, None, None)]
    report = spark.createDataFrame(made, layout)
    with pytest.raises(quality.AuditFailed, match="^b: 2$"):
        quality.audit(report)
    assert quality.audit(report, {"b": 2, "share": 0})["rows_c"] == 5.0
    with pytest.raises(quality.AuditFailed) as failed:
        quality.audit(report, {"b": 1, "rows_c": 4, "rows_in_year_1": 0})
    assert failed.value.failed == {"b": 2.0, "rows_c": 5.0}
    with pytest.raises(ValueError, match="no such check: bb"):
        quality.audit(report, {"bb": 1})


def test_report_and_row_counts_are_published(spark, small_feeds, tmp_path):
    lake = batch.run_batch(spark, *small_feeds, str(tmp_path))
    assert lake.published.rows == {name: lake.table(name).count() for name in TABLES}
    report = batch.read_report(spark, str(tmp_path))
    assert report.where("NOT passed").count() == 0
    assert dict(rows(report, "check_name", "observed"))["rows_reviews"] == 9.0


def test_a_reader_keeps_its_publication_until_vacuum(spark, small_feeds, larger_feeds, tmp_path):
    base = str(tmp_path)
    batch.run_batch(spark, *small_feeds, base)
    reader = tables.read_tables(spark, base)
    batch.run_batch(spark, *larger_feeds, base)
    assert reader["reviews"].count() == 9 and tables.read_table(spark, base, "reviews").count() == 20
    assert [p.version for p in publication.history(spark, base)] == [2, 1]
    gone = publication.vacuum(spark, base, keep=1)
    assert len(gone) == 1 and [p.version for p in publication.history(spark, base)] == [2]
    assert publication.vacuum(spark, base, keep=1) == [] and publication.vacuum(spark, base, keep=0) == []
    assert tables.read_table(spark, base, "reviews").count() == 20


def test_numbers_are_taken_once(spark, tmp_path):
    base = str(tmp_path)
    found = [publication.publish(spark, base, f"{base}/runs/{i}", {"reviews": i}) for i in range(3)]
    assert [p.version for p in found] == [1, 2, 3]
    assert not files.create_text(spark, f"{base}/_published/{3:012d}.json", "{}")
    with pytest.raises(publication.Superseded, match="at publication 3, not 2"):
        publication.publish(spark, base, f"{base}/runs/x", {}, after=2)
    fourth = publication.publish(spark, base, f"{base}/runs/x", {}, after=3)
    assert publication.current(spark, base) == fourth and fourth.root == f"{base}/runs/x"
    with open(f"{base}/_published/{4:012d}.json", encoding="utf-8") as manifest:
        assert json.load(manifest) == {"root": "runs/x", "rows": {}}  # relative: a lake can be moved
    assert publication.root_of(spark, f"{base}/none") == f"{base}/none"


def test_odd_lines_come_back_whole_from_one_reading(spark, tmp_path, monkeypatch):
    good = spark.createDataFrame([(json.dumps(REVIEW),)] * 3, "value string")
    odd = odd_lines(spark, SMALL)
    good.unionByName(odd).repartition(3).write.text(f"{tmp_path}/r", compression="gzip")
    products = write_lines(tmp_path / "p", PRODUCT, "no json", "[1", "")
    read, readings = feeds.read_with_faults, []
    monkeypatch.setattr(feeds, "read_with_faults", lambda *a: readings.append(a[1]) or read(*a))
    monkeypatch.setattr(feeds, "read_reviews", None)
    base = str(tmp_path / "lake")
    lake = batch.run_batch(spark, f"{tmp_path}/r", products, base)
    found = batch.read_quarantine(spark, base)
    assert rows(found.where("feed = 'reviews'"), "line") == rows(odd, "value")
    by = {(r.feed, r.reason): r["count"] for r in found.groupBy("feed", "reason").count().collect()}
    suppliers = odd.count() // 2
    assert by == {("reviews", "unreadable"): suppliers, ("reviews", "wrong types"): suppliers, ("products", "unreadable"): 2}
    assert all(r.file.startswith("file:") and r.file.endswith(".gz") for r in found.collect())
    # Read once; the tables come from the stored rows, and what could be read of odd lines is in them.
    assert sorted(readings) == sorted([f"{tmp_path}/r", products])
    assert "json" not in plan(lake.raw_reviews).lower()
    assert lake.table("reviews").where("review_text = 'typed'").count() == suppliers
    assert not os.path.exists(f"{lake.base}/_parsed")


def test_without_quarantine(spark, small_feeds, tmp_path):
    lake = batch.run_batch(spark, *small_feeds, str(tmp_path), quarantine=False)
    assert lake.table("reviews").count() == 9 and not os.path.exists(batch.quarantine_path(lake.base))


def test_limits_on_the_command_line(spark, monkeypatch, small_feeds, tmp_path):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr("sys.argv", ["reviewmill", *small_feeds, str(tmp_path), "--limit", "rows_reviews=8", "--keep", "1"])
    with pytest.raises(quality.AuditFailed, match="rows_reviews: 9"):
        command.main()
    monkeypatch.setattr("sys.argv", ["reviewmill", *small_feeds, str(tmp_path), "--limit", "rows_reviews=9", "--no-quarantine"])
    command.main()
    assert publication.current(spark, str(tmp_path)).rows["reviews"] == 9


def test_levels_follow_the_tasks_that_read(spark, settings):
    assert cleaning.salts_for(spark.range(0, 10, 1, 256)) == 1
    assert cleaning.salts_for(spark.range(0, 10, 1, 400)) == 20
    assert cleaning.salts_for(spark.range(0, 10, 1, 10_000)) == 100
    jobs = spark.sparkContext.statusTracker()
    settings(spark__sql__shuffle__partitions="900")
    spark.sparkContext.setJobGroup("levels", "")
    shuffled = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert cleaning.salts_for(shuffled) == 30
    assert list(jobs.getJobIdsForGroup("levels")) == []  # nothing ran
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
