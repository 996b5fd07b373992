"""Fingerprints by Order MinHash (operator 7). DataFrame functions only.

A text's k-mers are its runs of ``k`` words (a shorter text is one k-mer). Equal k-mers are told apart by numbering
their occurrences, and each numbered k-mer has one 64-bit hash. The hashes lie on a circle with ``slots`` evenly spaced
marks; each mark stands for one permutation, the order of the hashes from it on, and selects the ``2`` minimal
k-mers of that order. The selected are put back into text order and hashed as a tuple: one number for each slot. Shared k-mers
that stand in another order give another tuple, so likeness, the share of equal slots, follows edit distance.

Each text is done inside its row by array functions: nothing is exploded or shuffled for it, whatever its length.

Null and empty texts have no k-mers; all such texts have one fingerprint. Equal texts have equal fingerprints. k-mers
depend on words only, runs of white space (ASCII) separate them.

``with_edits`` pairs each document with the next by id. Ids alone are sorted over the cluster to find range borders
(one for each partition); texts then move once, by range, and the next text is a window's lead. The few first rows
of each range reach the range before them in a join. Rows with one id are ordered by a digest of the text, null ids come first.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, SLOTS = 5, 64
#: A k-mer is one number: the upper bits its hash, the lower its place (places beyond the last count as the last).
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1


def with_fingerprint(docs: DataFrame, text: str, into: str, k: int = K, slots: int = SLOTS) -> DataFrame:
    """docs and ``into``, an array<int> with the tuple hash of each slot.

    Done in steps of a column each, so that every array is made once.
    """
    bits = slots.bit_length() - 1
    marks = [-(1 << 63) + (j << (64 - bits)) for j in range(slots)]
    plain = F.coalesce(F.col(text), F.lit(""))
    for white in "\t\n\x0b\f\r":
        plain = F.replace(plain, F.lit(white), F.lit(" "))

    def pack(h: Column, i: Column) -> Column:
        return h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(F.least(i, F.lit(_PLACE)).cast("long"))

    def number(x: Column, i: Column) -> Column:
        """Occurrences of a k-mer after its first get a hash of their own; they stand together, by place."""
        before = F.get("__packed", i - 1)
        again = (i > 0) & (F.shiftright(before, PLACE_BITS) == F.shiftright(x, PLACE_BITS))
        occurrence = i - _first_from("__packed", x.bitwiseAND(F.lit(~_PLACE)), i)
        h = F.xxhash64(F.shiftright(x, PLACE_BITS), occurrence)
        return F.when(again, h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(x.bitwiseAND(F.lit(_PLACE)))).otherwise(x)

    def pair(at: Column) -> Column:
        """The tuple of two neighbours on the circle, in text order."""
        count = F.size("__numbered")
        a, b = F.get("__numbered", at % count), F.get("__numbered", (at + 1) % count)
        x, y = F.shiftright(a, PLACE_BITS), F.shiftright(b, PLACE_BITS)
        first = a.bitwiseAND(F.lit(_PLACE)) <= b.bitwiseAND(F.lit(_PLACE))
        return F.when(first, F.hash(x, y)).otherwise(F.hash(y, x))

    places = F.sequence(F.lit(0), F.greatest(F.size("__words") - k, F.lit(0)))
    kmers = F.transform(places, lambda i: F.xxhash64(*[F.get("__words", i + j) for j in range(k)]))
    none = F.array().cast("array<bigint>")
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    # Among numbers and marks in one order, mark j stands behind j marks and all smaller numbers. A number that
    # looks like a mark (one in 2 ** 34) would shift the marks after it, alike wherever its k-mer stands.
    is_mark = F.lit((1 << (64 - bits)) - 1)
    marked = F.filter(
        F.sequence(F.lit(0), F.size("__marked") - 1), lambda i: F.get("__marked", i).bitwiseAND(is_mark) == 0
    )
    chosen = F.transform(F.slice(marked, 1, slots), lambda i, j: pair(i - j))
    return (
        docs.withColumn("__words", F.array_remove(F.split(plain, " "), ""))
        .withColumn("__hashes", F.when(F.size("__words") == 0, none).otherwise(kmers))
        .withColumn("__packed", F.sort_array(F.transform("__hashes", pack)))
        .withColumn("__numbered", F.when(repeats, F.sort_array(F.transform("__packed", number))).otherwise(F.col("__packed")))
        .withColumn("__marked", F.sort_array(F.concat("__numbered", F.array(*map(F.lit, marks)))))
        .withColumn(into, F.when(F.size("__numbered") == 0, F.array_repeat(F.lit(0), slots)).otherwise(chosen))
        .drop("__words", "__hashes", "__packed", "__numbered", "__marked")
    )


def _first_from(numbers: str, least: Column, end: Column, strict: bool = False) -> Column:
    """Where the first number >= least (strict: > least) stands among the sorted numbers before end, by halving."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(end + 1)).cast("int"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"], 1)
        go = state["low"] < state["high"]
        number = F.get(numbers, middle)
        below = go & (number <= least if strict else number < least)
        return F.struct(
            F.when(below, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(go & ~below, middle).otherwise(state["high"]).alias("high"),
        )

    return F.aggregate(rounds, F.struct(F.lit(0).alias("low"), end.alias("high")), halve, lambda s: s["low"])


def as_text(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal slots."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return F.size(same) / F.size(a)


def with_edits(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, slots: int = SLOTS, ranges: int | None = None
) -> DataFrame:
    """key, text, edited, and both texts' and the next text's fingerprints; one row for each row of docs.

    edited: the last floor(n / 2) code points of the text replaced by the first as many of the next document.
    ranges: ranges of ids, four for each of the session's shuffle partitions if not given.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(text, F.lit("")).alias("__text"))
    rows = rows.withColumn("__digest", F.xxhash64("__text"))
    place = ["__key", "__digest"]
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    # The first id of each range, from the ids alone.
    ids = rows.select("__key").filter("__key IS NOT NULL").repartitionByRange(ranges, F.col("__key"))
    least = ids.groupBy(F.spark_partition_id()).agg(F.min("__key").alias("first")).distinct()
    borders = sorted(row["first"] for row in least.select("first").collect())
    literal = F.from_json(F.lit(json.dumps(borders, default=str)), f"array<{docs.schema[key].dataType.simpleString()}>")
    above = _first_from("__borders", F.col("__key"), F.size("__borders"), strict=True)
    ranged = rows.withColumn("__borders", literal)
    ranged = ranged.withColumn("__range", F.when(F.col("__key").isNull(), 0).otherwise(F.greatest(above - 1, F.lit(0))))
    ranged = ranged.drop("__borders")

    # The first text of each range goes to the last row of the range before; the first of all to the last of all.
    edge = F.col("__key").isNull() | F.col("__key").isin(borders)
    firsts = ranged.filter(edge).groupBy("__range").agg(F.min(F.struct(*place, "__text"))["__text"].alias("__first"))
    firsts = with_fingerprint(firsts, "__first", "__first_print", k, slots)
    count = max(1, len(borders))
    firsts = firsts.select(((F.col("__range") + (count - 1)) % count).alias("__before"), "__first", "__first_print")

    order = Window.partitionBy("__range").orderBy(*place)
    one = with_fingerprint(ranged.repartition("__range"), "__text", "__print", k, slots)
    led = one.select(
        "*", F.lead("__text").over(order).alias("__next"), F.lead("__print").over(order).alias("__next_print")
    )
    led = led.join(firsts, (F.col("__range") == F.col("__before")) & F.col("__next").isNull(), "left")
    half = F.floor(F.char_length("__text") / 2).cast("int")
    following = F.coalesce("__next", "__first")
    edited = F.concat(F.substring("__text", F.lit(1), F.char_length("__text") - half), F.substring(following, F.lit(1), half))
    led = led.select(
        "__key", "__text", "__print", F.coalesce("__next_print", "__first_print").alias("__next_print"), edited.alias("__edited")
    )
    both = with_fingerprint(led, "__edited", "__edited_print", k, slots)
    return both.select(
        F.col("__key").alias(key),
        F.col("__text").alias("text"),
        F.col("__edited").alias("edited"),
        F.col("__print").alias("fingerprint"),
        F.col("__edited_print").alias("edited_fingerprint"),
        F.col("__next_print").alias("next_fingerprint"),
    )
