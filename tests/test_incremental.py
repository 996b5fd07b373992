"""The co-partitioned layout and the upkeep of the grain give what full runs give, with fewer shuffles."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import plan, products, reviews, rows
from reviewmill.operators import cleaning, joins, summaries
from reviewmill.plans import copartitioned, upkeep
from reviewmill.sources import buckets as store
from reviewmill.sources import publication
from reviewmill.sources.session import own_session


@pytest.fixture
def own(spark):
    """A session in which nothing is small enough to be broadcast, so that joins show their shuffles."""
    session = own_session(spark)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return session


def exchanges(frame):
    return len(re.findall(r"(?<!Broadcast)Exchange", plan(frame)))


def some_reviews(spark, hot, seed=1, n=400):
    rng = random.Random(seed)
    made = [
        {
            "user_id": f"u{i}",
            "parent_asin": "HOT" if i < hot * n else f"P{rng.randrange(40)}",
            "rating": rng.choice([1.0, 2.5, 4.1, 5.0, None]),
            "helpful_vote": rng.choice([0, 3, None]),
            "timestamp": rng.choice([0, 1_500_000_000_000, 1_700_000_000_123]),
        }
        for i in range(n)
    ]
    return reviews(spark, *made)


def some_products(spark):
    listed = [{"parent_asin": f"P{i}", "store": f"b{i % 4}"} for i in range(0, 60, 2)]
    return products(spark, *listed, {"parent_asin": "HOT", "store": "hot"}, {"parent_asin": "NONE"})


@pytest.mark.parametrize("hot", [0, 0.4])
def test_copartitioned_equals_shuffled_and_does_not_shuffle(own, tmp_path, hot):
    curated = cleaning.clean_reviews(some_reviews(own, hot)), cleaning.clean_products(some_products(own))
    for name, frame in zip(("r", "p"), curated):
        frame.write.parquet(f"{tmp_path}/{name}")
    stored = [own.read.parquet(f"{tmp_path}/{name}") for name in ("r", "p")]
    database = f"buckets_{int(hot * 10)}"
    copartitioned.write_layout(own, database, f"{tmp_path}/layout", *stored, buckets=16)

    joined = copartitioned.enriched(own, database)
    assert exchanges(joined) == 0 and "SortMergeJoin" in plan(joined)
    assert rows(joined) == rows(joins.enrich_reviews(*stored), *joined.columns)
    stats, rollup = copartitioned.product_stats(own, database), copartitioned.product_rollup(own, database)
    full = summaries.product_rollup(stored[1], summaries.product_stats(stored[0]))
    assert rows(stats, *sorted(stats.columns)) == rows(summaries.product_stats(stored[0]), *sorted(stats.columns))
    assert rows(rollup, *full.columns) == rows(full)
    assert exchanges(summaries.product_stats(stored[0])) == 1

    sliced = own.table(f"`{database}`.`{copartitioned.REVIEWS}`")
    slices = sliced.where("product_asin = 'HOT'").groupBy(copartitioned.SLICE).count().collect()
    if hot:
        # About two fifths of the rows, in shares of no more than a sixteenth each, on average.
        assert len(slices) == 7 and max(r["count"] for r in slices) < 50
        # Only the sums of each slice are shuffled, and not by the scan's tasks' rows.
        assert exchanges(stats) == 1 and exchanges(rollup) <= 3
    else:
        assert slices == [] and exchanges(stats) == exchanges(rollup) == 0


def test_copartitioned_of_nothing_and_again(own, tmp_path):
    none = cleaning.clean_reviews(some_reviews(own, 0).limit(0)), cleaning.clean_products(some_products(own).limit(0))
    copartitioned.write_layout(own, "buckets_none", f"{tmp_path}/l", *none, buckets=4)
    assert copartitioned.enriched(own, "buckets_none").count() == 0
    assert copartitioned.product_rollup(own, "buckets_none").count() == 0
    some = cleaning.clean_reviews(some_reviews(own, 0)), cleaning.clean_products(some_products(own))
    copartitioned.write_layout(own, "buckets_none", f"{tmp_path}/l", *some, buckets=4)
    assert copartitioned.enriched(own, "buckets_none").count() == 400


def test_each_bucket_is_one_file(own, tmp_path):
    store.create_database(own, "one_file", str(tmp_path))
    store.write_bucketed(own.range(0, 1000, 1, 8).withColumnRenamed("id", "k"), "one_file.t", f"{tmp_path}/t", ["k"], 4)
    assert len([n for n in os.listdir(tmp_path / "t") if n.endswith(".parquet")]) == 4


def copies(spark):
    """Rows of few ids, that differ in what decides which copy survives and in what it counts for."""
    rng = random.Random(5)
    made = []
    for i in range(300):
        made.append({
            "user_id": f"u{rng.randrange(40)}",
            "parent_asin": rng.choice(["P1", "P2", " P1 "]),
            "asin": rng.choice(["A", "B", None]),
            "rating": rng.choice([1.0, 2.0, 5.0, 4.1, None, 9.0]),
            "helpful_vote": rng.choice([0, 1, 7, None, -1]),
            "verified_purchase": rng.choice([True, False, None]),
            "title": rng.choice(["t", "", None]),
            "text": rng.choice(["x", "", None]),
            "timestamp": rng.choice([0, 1_700_000_000_123, 1_700_000_000_900]),
        })
    return reviews(spark, *made)


def whole_grain(raw):
    return summaries.product_month_stats(cleaning.clean_reviews(raw))


@pytest.mark.parametrize("parts", [[1], [0.5, 0.5], [0.2, 0.3, 0.5]])
def test_base_and_deltas_equal_one_run(own, tmp_path, parts):
    raw = copies(own).coalesce(1).cache()
    dealt = raw.randomSplit([float(p) for p in parts], seed=3)
    kept = upkeep.Upkeep(own, str(tmp_path), f"kept_{len(parts)}", buckets=4)
    for part in dealt:
        done = kept.add(part)
    full = whole_grain(raw)
    assert rows(kept.grain(), *full.columns) == rows(full)
    assert done.version == len(parts) and done.rows["seen"] == cleaning.clean_reviews(raw).count()
    curated = cleaning.clean_products(some_products(own))
    assert rows(summaries.brand_summary(kept.rollup(curated))) == rows(
        summaries.brand_summary(summaries.product_rollup(curated, summaries.product_stats(cleaning.clean_reviews(raw))))
    )
    # The same files again change nothing.
    again = kept.add(raw)
    assert again.rows == {"seen": done.rows["seen"], "changed": 0}
    assert rows(kept.grain(), *full.columns) == rows(full)
    assert len(publication.history(own, str(tmp_path))) == min(2, len(parts) + 1)


def test_the_state_is_not_shuffled(own, tmp_path):
    kept = upkeep.Upkeep(own, str(tmp_path), "kept_plan", buckets=4)
    first = kept.add(copies(own))
    delta = upkeep._narrow(copies(own))
    changes = kept.changes(delta, first.root)
    assert exchanges(changes) == exchanges(delta) + 1  # the delta's, into the buckets
    changes.write.parquet(f"{tmp_path}/changed")
    replaced = kept._replaced(own.read.parquet(f"{tmp_path}/changed"), first.root)
    written = replaced.repartition(4, "review_id").sortWithinPartitions("review_id")
    assert "Bucketed: true" in plan(written) and "SortMergeJoin" in plan(written)
    assert exchanges(written) == 1  # the changes'


def test_a_new_application_finds_the_buckets(own, tmp_path):
    first = upkeep.Upkeep(own, str(tmp_path), "kept_before", buckets=4)
    raw = copies(own).coalesce(1).cache()
    one, two = raw.randomSplit([0.5, 0.5], seed=1)
    first.add(one)
    later = upkeep.Upkeep(own, str(tmp_path), "kept_after", buckets=4)  # a catalog without the entry
    later.add(two)
    assert rows(later.grain(), *whole_grain(raw).columns) == rows(whole_grain(raw))


def test_a_delta_that_fails_or_comes_late_changes_nothing(own, tmp_path, monkeypatch):
    kept = upkeep.Upkeep(own, str(tmp_path), "kept_late", buckets=4)
    kept.add(copies(own))
    before = rows(kept.grain())
    monkeypatch.setattr(upkeep.Upkeep, "_replaced", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.add(some_reviews(own, 0))
    monkeypatch.undo()
    merge = upkeep.Upkeep._merge

    def overtaken(self, raw, current, root):
        publication.publish(own, str(tmp_path), current, {})
        return merge(self, raw, current, root)

    monkeypatch.setattr(upkeep.Upkeep, "_merge", overtaken)
    with pytest.raises(publication.Superseded):
        kept.add(some_reviews(own, 0))
    assert rows(kept.grain()) == before and len(os.listdir(tmp_path / "runs")) == 1
