"""Temperature mixing of sources, realised as budgeted block permutations (operator 2). DataFrame functions only.

A source's weight is its share of all words to the power of an exponent, normalised. The exponent is found by
section search over the table of sources (one row each, never on the driver: the driver sees entropy and
repetition for a grid of candidates): the largest with at least the target entropy, raised if need be until no
source is repeated more than allowed. Weights times the budget are the sources' quotas in words.

A source's documents are dealt by a hash of their id to blocks of about ``block_words`` words; longer documents are
blocks of their own. Each epoch is a permutation of the blocks by a hash of seed, epoch and block. Whole epochs take every
block; the last takes, in its order, each block that still fits the quota's rest, so a source misses its quota by less than
its smallest block left. That order is followed in passes: each takes blocks while their running sum fits, then drops
those larger than what is left, so a block that doesn't fit never keeps out a later one. Running sums come in two levels,
over buckets of the permutation and inside the bucket, each about the square root of the blocks, so no task ever sees a
hot source's documents or all its blocks. Documents meet their blocks' epochs in a join by source and block,
broadcast only while the blocks are few by count.

Null sources count as ''. Null and empty texts have no words and go with their block; a source without words gets no
weight and no rows. Rows with one id share a block, apart from those longer than a block, which share another. An empty
table gives no rows. Other columns stay whatever their names; ``epoch``, ``block`` (negative for a document longer than a block),
``n_words`` and ``position`` (0 to 1, where in the mix) replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmill.llm import shared

BLOCK_WORDS = 4096
#: Target entropy as a share of the largest possible, and how often a source may be repeated.
ENTROPY, MAX_REPEATS = 0.95, 4.0
#: Candidates of one pass of the search, and passes: the exponent is exact to GRID ** -PASSES times its range.
GRID, PASSES = 256, 4
#: Up to so many blocks (or sources) are sent to every executor.
BROADCAST_ROWS = 1 << 18


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hashed(*parts: Column) -> Column:
    """60 bits of a digest."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 15), 16, 10).cast("long")


def _grid(sources: DataFrame, low: float, step: float) -> DataFrame:
    """For each candidate a: z = sum of p ** a, y = sum of p ** a * ln p, most and least p ** (a - 1)."""
    grid = sources.select("p", F.explode(F.sequence(F.lit(0), F.lit(GRID))).alias("k"))
    grid = grid.withColumn("a", F.lit(low) + F.col("k") * F.lit(step))
    power, repeats = F.pow("p", F.col("a")), F.pow("p", F.col("a") - 1)
    return grid.groupBy("k", "a").agg(
        F.sum(power).alias("z"),
        F.sum(power * F.log("p")).alias("y"),
        F.max(repeats).alias("most"),
        F.min(repeats).alias("least"),
    )


def _search(sources: DataFrame, low: float, high: float, good: Column, good_below: bool) -> float:
    """The border between good and bad candidates of [low, high], on the good side, by section search."""
    for _ in range(PASSES):
        step = (high - low) / GRID
        bad = _grid(sources, low, step).filter(~good)
        if good_below:
            k = bad.agg(F.min("k")).first()[0]
            if k is None or k == 0:
                return high if k is None else low
            low, high = low + (k - 1) * step, low + k * step
        else:
            k = bad.agg(F.max("k")).first()[0]
            if k is None or k == GRID:
                return low if k is None else high
            low, high = low + k * step, low + (k + 1) * step
    return low if good_below else high


def exponent(sources: DataFrame, entropy: float | None, max_repeats: float | None, budget: float | None) -> float:
    """The exponent in [0, 1] for sources with shares p: flat enough for the entropy, steep enough for the limit.

    budget: words to mix as a multiple of all words, or None to take every source at least once.
    """
    count = sources.count()
    a = 1.0
    if entropy is not None and count > 1:
        held = F.log("z") - F.col("a") * F.col("y") / F.col("z")
        a = _search(sources, 0.0, 1.0, held >= F.lit(entropy) * F.log(F.lit(float(count))) - 1e-12, True)
    if max_repeats is not None:
        repeats = F.col("most") / F.col("least") if budget is None else F.lit(budget) * F.col("most") / F.col("z")
        start = 0.0 if entropy is None else a
        a = _search(sources, start, 1.0, repeats <= F.lit(max_repeats) + 1e-12, False)
    return a


def _few(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _last_epoch(blocks: DataFrame) -> list[DataFrame]:
    """One stored table for each pass: the blocks that stood for choice, and whether the pass takes them (fits)."""
    by_bucket = Window.partitionBy("__source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("__source", "bucket").orderBy("turn", "block")
    left, passes = blocks.select("__source", "block", "words", "rest", "turn", "bucket").filter("words <= rest"), []
    while True:
        buckets = left.groupBy("__source", "bucket").agg(F.sum("words").alias("in_bucket"))
        buckets = buckets.withColumn("before", F.coalesce(F.sum("in_bucket").over(by_bucket), F.lit(0)))
        upto = F.col("before") + F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        placed = left.join(buckets, ["__source", "bucket"]).withColumn("fits", upto <= F.col("rest"))
        passes.append(shared.stored(placed.select(*left.columns, "fits")))
        # Every pass takes the first block of each source at least, since none is larger than the rest.
        used = passes[-1].filter("fits").groupBy("__source").agg(F.sum("words").alias("used"))
        left = passes[-1].filter("NOT fits").drop("fits").join(used, "__source")
        left = left.withColumn("rest", F.col("rest") - F.col("used")).drop("used").filter("words <= rest")
        if left.isEmpty():
            return passes


def mix(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    entropy: float | None = ENTROPY,
    max_repeats: float | None = MAX_REPEATS,
    budget: float | None = 1.0,
    block_words: int = BLOCK_WORDS,
    seed: int = 0,
) -> DataFrame:
    """The rows of docs, once for each epoch that takes their block, with n_words, block, epoch and position."""
    added = ("n_words", "block", "epoch", "position")
    given, name = shared.masked(docs)
    long = F.col("n_words") >= block_words
    measured = given.select(
        *[name[c] for c in docs.columns if c not in added],
        F.coalesce(F.col(name[source]).cast("string"), F.lit("")).alias("__source"),
        hashed(F.lit(seed), F.coalesce(F.col(name[key]).cast("string"), F.lit(""))).alias("__at"),
        words_in(name[text]).alias("n_words"),
    )
    short = F.sum(F.when(long, 0).otherwise(F.col("n_words")))
    totals = measured.groupBy("__source").agg(F.sum("n_words").alias("words"), short.alias("short")).filter("words > 0")
    totals = shared.stored(totals)
    whole = totals.agg(F.sum("words")).first()[0] or 0
    sources = totals.withColumn("p", F.col("words") / F.lit(float(whole or 1)))
    a = exponent(sources, entropy, max_repeats, budget) if whole else 1.0
    z, least = sources.agg(F.sum(F.pow("p", F.lit(a))), F.min(F.pow("p", F.lit(a - 1)))).first()
    scale = 0.0 if not whole else budget / z if budget is not None else 1 / least
    sources = sources.select(
        "__source",
        F.greatest(F.ceil(F.col("short") / block_words), F.lit(1)).alias("blocks"),
        F.ceil(F.sqrt(F.ceil(F.col("words") / block_words))).cast("long").alias("buckets"),
        # Quotas in whole words; the small terms keep a quota of just one epoch from rounding down.
        F.floor(F.lit(scale) * F.pow("p", F.lit(a)) * F.lit(float(whole)) * (1 + 1e-12) + 1e-6).cast("long").alias("quota"),
        "words",
    ).withColumns({"whole": F.expr("quota div words"), "rest": F.expr("quota % words")})
    sources = _few(shared.stored(sources))

    dealt = measured.join(sources, "__source").withColumn(
        "block", F.when(long, -1 - F.col("__at")).otherwise(F.col("__at") % F.col("blocks"))
    )
    blocks = dealt.groupBy("__source", "block").agg(
        F.sum("n_words").alias("words"), *[F.first(c).alias(c) for c in ("buckets", "whole", "rest")]
    )
    total = F.col("whole").cast("string")
    turn = hashed(F.lit(seed), total, F.col("__source"), F.col("block").cast("string"))
    blocks = shared.stored(blocks.withColumns({"turn": turn, "bucket": F.expr("turn % buckets")}))
    passes = _last_epoch(blocks)
    times = blocks.select("__source", "block", F.col("whole").alias("times"))
    for taken in passes:
        times = times.unionByName(taken.filter("fits").select("__source", "block", F.lit(1).cast("long").alias("times")))
    times = times.filter("times > 0").groupBy("__source", "block").agg(F.sum("times").alias("times"))
    plan = shared.stored(times)
    shared.forget(*passes)
    plan = _few(plan)

    copies = dealt.join(plan, ["__source", "block"]).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))
    )
    order = hashed(F.lit(seed), F.col("epoch").cast("string"), F.col("__source"), F.col("block").cast("string"))
    position = (F.col("epoch") + order / F.lit(float(1 << 60))) / (F.col("quota") / F.col("words"))
    return copies.withColumn("position", F.least(position, F.lit(1.0))).select(
        *[F.col(name[c]).alias(c) for c in docs.columns if c not in added], *added
    )
