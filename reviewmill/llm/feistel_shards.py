"""Shards by a Feistel permutation of global row numbers with cycle walking (operator 13). DataFrame functions only.

Rows are numbered 0 to n - 1 in the order of a 128-bit digest of id and text, so numbers depend on the rows alone, not on
files, partitions or settings. A keyed permutation shuffles the numbers: row r goes to place p(r), which is slot
``p div shards`` of shard ``p mod shards``. Shards differ by one row at most (law ``rows``), slots have no gaps, and whoever knows n, the
seed and a row's number computes its place with :func:`place_of`, and the row of a place with :func:`number_at`.

The permutation is a Feistel network over two digits of different radices: a round adds a digest of one digit to the
other, modulo its radix. The radices' product is as little above n as a search finds; a number that lands beyond n walks on
along its cycle until it is below. Only the numbers beyond n can lengthen walks, so a walk is never longer than their count.

Numbering needs no global sort. Equal digests are counted for each input partition that has them, counts are summed up
inside ranges of digests (even, as digests are), and the ranges' totals, one row each, on top. Rows meet their count by digest and
partition, so a group of copies is never larger than what one input partition holds of it.

Null ids and null texts count as ''. Rows with equal id and text are interchangeable: they take consecutive numbers in no
particular order, which the permutation scatters over the shards, and so it does with copies under other ids. An empty table
gives no rows. Other columns stay whatever their names; ``size`` (bytes of the text and 1), ``row_number``, ``shard`` and ``slot`` replace
columns of these names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmill.llm import mixing, shared

SHARDS = 8
LAW = "rows"
#: Rounds of the network, an even number: then the radices stand as before the first.
ROUNDS = 6
#: Left radices tried for a product near the number of rows.
TRIED = 4096
#: Ranges of digests for each input partition.
RANGES = 4

_ADDED = ("size", "row_number", "shard", "slot")


def radices(n: int) -> tuple[int, int]:
    """Two radices near the square root of n with a product of n or little more."""
    least = math.isqrt(max(n, 1) - 1) + 1
    tried = ((a, -(-max(n, 1) // a)) for a in range(least, least + TRIED))
    return min(tried, key=lambda ab: (ab[0] * ab[1], ab[0]))


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by).cast("long"))


def _network(number: Column, a: int, b: int, seed: int, back: bool = False) -> Column:
    """One pass of the network, or of its inverse, over a number below a * b."""

    def step(state: Column, at: Column) -> Column:
        other = state["l"] if back else state["r"]
        added = mixing.hashed(F.lit(seed), at.cast("string"), other.cast("string"))
        radix = F.when(at % 2 == 0, F.lit(a)).otherwise(F.lit(b)).cast("long")
        if back:
            return F.struct(F.pmod(state["r"] - added, radix).alias("l"), other.alias("r"))
        return F.struct(other.alias("l"), F.pmod(state["l"] + added, radix).alias("r"))

    rounds = range(ROUNDS)
    digits = F.struct(_div(number, b).alias("l"), F.pmod(number, F.lit(b).cast("long")).alias("r"))
    order = F.array(*[F.lit(i) for i in (reversed(rounds) if back else rounds)])
    return F.aggregate(order, digits, step, lambda s: s["l"] * F.lit(b).cast("long") + s["r"])


def _walked(number: Column, n: int, seed: int, back: bool) -> Column:
    """The network, and again while the result is n or more: at most as often as there are such numbers."""
    a, b = radices(n)
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(a * b - max(n, 1))),
        number.cast("long"),
        lambda at, i: F.when((i > 0) & (at < n), at).otherwise(_network(at, a, b, seed, back)),
    )


def place_of(number: Column, n: int, seed: int = 0) -> Column:
    """The place of a row number below n (a long): a permutation of 0 to n - 1."""
    return _walked(number, n, seed, back=False)


def number_at(place: Column, n: int, seed: int = 0) -> Column:
    """The row number at a place: the inverse of :func:`place_of`."""
    return _walked(place, n, seed, back=True)


def _numbered(keyed: DataFrame, digest: str, part: str) -> tuple[DataFrame, int]:
    """The rows with row_number, and how many there are. keyed: a stored table."""
    last = keyed.agg(F.max(part)).first()[0]
    ranges = RANGES * ((last or 0) + 1)
    counts = keyed.groupBy(digest, part).agg(F.count(F.lit(1)).alias("rows"))
    spot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") * F.lit(ranges).cast("long")
    counts = shared.stored(counts.withColumn("range", F.shiftright(spot, 32)))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    totals = counts.groupBy("range").agg(F.sum("rows").alias("in_range"))
    totals = shared.stored(totals.withColumn("before", F.coalesce(F.sum("in_range").over(before), F.lit(0))))
    n = totals.agg(F.sum("in_range")).first()[0] or 0
    inside = Window.partitionBy("range").orderBy(digest, part).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("rows").over(inside), F.lit(0))
    firsts = counts.join(totals, "range").select(digest, part, first.alias("row_number"))
    copies = Window.partitionBy(digest, part).orderBy(digest)
    rows = keyed.join(firsts, [digest, part])
    return rows.withColumn("row_number", F.col("row_number") + F.row_number().over(copies) - 1), n


def deal(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shards: int = SHARDS,
    seed: int = 0,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """All rows of docs with size, row_number, shard and slot. carry: the columns to keep, all if None."""
    kept = [c for c in (docs.columns if carry is None else carry) if c not in _ADDED]
    digest, part = shared.unused(docs.select(*map(shared.quoted, kept)), "digest", "part")
    whole = F.coalesce(F.col(shared.quoted(text)).cast("string"), F.lit(""))
    of = F.concat_ws("/", F.coalesce(F.col(shared.quoted(key)).cast("string"), F.lit("")), F.md5(whole))
    keyed = docs.select(
        *map(shared.quoted, kept),
        (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.md5(of).alias(digest),
        F.spark_partition_id().alias(part),
    )
    rows, n = _numbered(shared.stored(keyed), digest, part)
    names = [*map(shared.quoted, kept), "size", "row_number"]
    (place,) = shared.unused(rows, "place")
    placed = rows.select(*names, place_of(F.col("row_number"), n, seed).alias(place))
    return placed.select(
        *names,
        F.pmod(place, F.lit(shards).cast("long")).cast("int").alias("shard"),
        _div(F.col(place), shards).alias("slot"),
    )
