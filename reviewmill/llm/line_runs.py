"""Line dedup by a distributed suffix array over line ids (operator 10). DataFrame functions only.

Every text is a sequence of line ids (128-bit hashes of its lines). Prefix doubling names the suffixes by their
first 1, 2, 4, ... lines: round by round, a suffix's name joins its own with the one that many lines on, names
are counted in Spark, and only suffixes whose name occurs again stay (the order of names is free, so hashes
stand for ranks and no global numbering is needed). Suffixes with one name of ``min_lines`` lines are an interval of
the suffix array whose common prefix has at least that length; its earliest member (by document id, digest of
the text, and line number) is the original, the others begin later copies. Doubling stops at ``min_lines``,
since maximal repeated runs are the unions of such neighbours. A line of ``long_line`` characters or more is a
run by itself. With ``min_words``, so is a run of fewer lines that has so many words together; names then grow
line by line, and each suffix carries the words of its run. Lines of later copies are deleted, the others keep their order and stay joined by line breaks.

Counts are combined before each shuffle. Names meet their counts through stored small tables, so Spark can split the
rows of a very frequent line. Only names travel, texts are shuffled once, at the end.

Null texts stay null, empty ones are one empty line. Rows with one id and text are one document and get the same
result. Null ids are one id. Lines differ as soon as a byte differs. Other columns stay whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import mixing, shared

MIN_LINES = 3
LONG_LINE = 200
#: A passage of so many words is worth deleting whatever its lines; off unless asked for, as query and pipeline do.
MIN_WORDS = 50

_PLACE = ("__doc", "__digest", "__pos")


def _name(*parts: Column) -> tuple[Column, Column]:
    """A 128-bit name."""
    return F.xxhash64(*parts).alias("__a"), F.xxhash64(F.lit("b"), *parts).alias("__b")


def repeated(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose name occurs again, with its earliest place as __first."""
    place = F.struct(*_PLACE)
    named = suffixes.groupBy("__a", "__b").agg(F.min(place).alias("__first"), F.max(place).alias("__last"))
    named = shared.stored(named.filter(~F.col("__first").eqNullSafe(F.col("__last"))).drop("__last"))
    return shared.stored(suffixes.join(named, ["__a", "__b"]))


def _pairs(suffixes: DataFrame, step: int) -> DataFrame:
    """Each suffix named by its own name and that of the suffix ``step`` lines on, where both repeat."""
    after = suffixes.select(
        F.col("__doc").alias("__of"),
        F.col("__digest").alias("__of_digest"),
        (F.col("__pos") - step).alias("__before"),
        F.col("__a").alias("__c"),
        F.col("__b").alias("__d"),
        *([F.col("__tail").alias("__next")] if "__tail" in suffixes.columns else []),
    )
    same = F.col("__doc").eqNullSafe(F.col("__of")) & (F.col("__digest") == F.col("__of_digest"))
    joined = suffixes.drop("__first").join(after, same & (F.col("__pos") == F.col("__before")))
    words = [(F.col("__words") + F.col("__next")).alias("__words"), F.col("__next").alias("__tail")]
    return joined.select(
        *_PLACE, *_name(*map(F.col, ("__a", "__b", "__c", "__d"))), *(words if "__tail" in suffixes.columns else [])
    )


def later_copies(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_lines: int = MIN_LINES,
    long_line: int = LONG_LINE,
    min_words: int | None = None,
) -> DataFrame:
    """(__doc, __digest, __flags, __gone): for each document that has lines in later copies, a byte 1 for each such line,
    a byte 0 for each other one before the last of them, and their number."""
    lines = docs.select(
        F.col(key).alias("__doc"), F.xxhash64(text).alias("__digest"), F.posexplode(F.split(text, "\n")).alias("__pos", "__line")
    )
    words = mixing.words_in("__line").cast("int")
    sizes = [words.alias("__words"), words.alias("__tail")] if min_words is not None else []
    suffixes = lines.select(*_PLACE, *_name(F.col("__line")), (F.char_length("__line") >= long_line).alias("__long"), *sizes)
    known = repeated(suffixes).dropDuplicates(list(_PLACE))
    later = ~F.struct(*_PLACE).eqNullSafe(F.col("__first"))
    wordy = F.lit(False) if min_words is None else F.col("__words") >= min_words
    found = known.filter(later & (F.col("__long") | wordy if min_lines > 1 else F.lit(True))).select(*_PLACE)
    known, width = known.drop("__long"), 1
    while width < min_lines:
        step = min(width, min_lines - width) if min_words is None else 1
        known, width = repeated(_pairs(known, step)), width + step
        if width == min_lines or min_words is not None:
            runs = known.filter(later & (F.lit(True) if width == min_lines else wordy)).select(
                "__doc", "__digest", F.explode(F.sequence(F.col("__pos"), F.col("__pos") + width - 1)).alias("__pos")
            )
            found = found.unionByName(runs)
    found = found.groupBy("__doc", "__digest").agg(F.sort_array(F.collect_set("__pos")).alias("__lines"))
    # One byte for each line up to the last of them: runs of 0 between 1 and 1.
    before = F.slice(F.concat(F.array(F.lit(-1)), F.col("__lines")), F.lit(1), F.size("__lines"))
    stays = F.zip_with("__lines", before, lambda line, last: F.repeat(F.lit("0"), line - last - 1))
    flags = F.concat(F.array_join(stays, "1"), F.lit("1")).cast("binary")
    return found.select("__doc", "__digest", flags.alias("__flags"), F.size("__lines").alias("__gone"))


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_lines: int = MIN_LINES,
    long_line: int = LONG_LINE,
    min_words: int | None = None,
) -> DataFrame:
    """All rows and columns of docs with the text without later copies, and n_lines and n_deleted."""
    found = later_copies(docs, text, key, min_lines, long_line, min_words)
    found = found.withColumnsRenamed({"__doc": "__of", "__digest": "__of_digest"})
    added = ("n_lines", "n_deleted")
    given, name = shared.masked(docs)
    words = F.col(name[text])
    split = F.split(words, "\n")
    keyed = given.select(
        *[name[c] for c in docs.columns if c not in added or c == text],
        F.col(name[key]).alias("__doc"),
        F.xxhash64(words).alias("__digest"),
        F.when(words.isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
    )
    same = F.col("__doc").eqNullSafe(F.col("__of")) & (F.col("__digest") == F.col("__of_digest"))
    joined = keyed.join(found, same, "left").withColumn("n_deleted", F.coalesce("__gone", F.lit(0)).cast("long"))
    # Lines are split once, and each finds its byte without a search: linear in the text.
    left = F.filter(split, lambda line, i: F.substring(F.col("__flags"), i + 1, F.lit(1)) != F.lit(b"1"))
    kept = F.when(F.col("__gone").isNull(), words).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[(kept if c == text else F.col(name[c])).alias(c) for c in docs.columns if c not in added], *added
    )
