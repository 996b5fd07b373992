"""Cleaning rules for one raw field at a time.

Text-to-number steps use ``try_cast``: under ANSI mode a plain cast would fail the whole job on
one bad value, where the rule is "unusable value becomes NULL (or the default)".
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the cleaning rules.
RATING_RANGE = (1.0, 5.0)
PRICE_PATTERN = r"^[0-9]+(\.[0-9]{1,2})?\z"
NUMBER_PATTERN = r"^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)? *\z"
UNKNOWN_BRAND = "Unknown"
UNKNOWN_YEAR = 0
UNKNOWN_MONTH = "unknown"
ID_SEPARATOR = "||"
LAST_EPOCH_MS = 253_402_300_799_999  # 9999-12-31 23:59:59.999 UTC


def product_key(*candidates: Column) -> Column:
    """First non-NULL id with outer spaces removed.

    Only NULL falls through to the next candidate: a blank id yields ``''``, which
    :func:`is_present` then rejects.
    """
    return F.trim(F.coalesce(*candidates))


def has_text(trimmed: Column) -> Column:
    """True for a trimmed key that isn't empty; false for NULL."""
    return F.coalesce(F.length(trimmed) > 0, F.lit(False))


def is_present(key: Column) -> Column:
    """True for a key with at least one non-space character; false for NULL."""
    return has_text(F.trim(key))


def number(text: Column) -> Column:
    """A text as a double: sign, digits, point and exponent, with spaces around; else NULL.

    Type suffixes (``12d``), names of infinities and NaN are no numbers here.
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def valid_rating(stars: Column) -> Column:
    """The rating, a double, when it lies in 1..5, else NULL (this covers NaN too)."""
    low, high = RATING_RANGE
    return F.when((stars >= low) & (stars <= high), stars)


def exact(rating: Column) -> Column:
    """The rating as a decimal, so that sums don't depend on the order of their terms.

    More than six decimal places are rounded half up. Sums have 18 digits, the widest that
    Spark adds up as plain longs: enough for 200 billion ratings in a group.
    """
    return rating.cast("decimal(8,6)")


def non_negative_long(column: Column, default: int = 0) -> Column:
    """The count as a long; NULL, negative and unreadable values become ``default``."""
    count = column.try_cast("long")
    return F.coalesce(F.when(count >= 0, count), F.lit(default).cast("long"))


def flag(column: Column) -> Column:
    """The boolean with NULL read as false."""
    return F.coalesce(column.try_cast("boolean"), F.lit(False))


def epoch_seconds(epoch_ms: Column) -> Column:
    """Whole seconds of an epoch-millisecond value, NULL unless it is a usable time.

    Usable means positive and at most the end of year 9999. The upper bound is a deliberate
    tightening: beyond it there is no four-digit year to file the review under.
    """
    ms = epoch_ms.try_cast("long")
    return F.when((ms > 0) & (ms <= LAST_EPOCH_MS), F.call_function("div", ms, F.lit(1000)))


class UtcTime(NamedTuple):
    """The forms in which one point in time is stored."""

    instant: Column
    text: Column
    year: Column
    month: Column


def utc_time(seconds: Column) -> UtcTime:
    """Instant, ``yyyy-MM-dd HH:mm:ss`` text, year and ``yyyy-MM`` month of epoch seconds.

    Text, year and month come from a zone-less wall clock counted from the epoch, so ids and
    partitions do not change with ``spark.sql.session.timeZone``. Unknown times get the
    sentinel year and month.
    """
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    wall = epoch + F.expr("INTERVAL '1' SECOND") * seconds
    day = wall.cast("date")
    return UtcTime(
        instant=F.timestamp_seconds(seconds),
        text=wall.cast("string"),
        year=F.coalesce(F.year(day), F.lit(UNKNOWN_YEAR)),
        month=F.coalesce(F.left(day.cast("string"), F.lit(7)), F.lit(UNKNOWN_MONTH)),
    )


def content_id(*parts: Column) -> Column:
    """SHA-256 hex over the parts, NULL counted as an empty string."""
    filled = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws(ID_SEPARATOR, *filled), 256)


def price(column: Column) -> Column:
    """Price text as ``decimal(10,2)``: dollar signs and commas go, anything odd is NULL.

    Negative amounts, three decimals, exponents, ranges in words and amounts too large for
    the type all become NULL, and so does a price followed by a line break.
    """
    digits = F.translate(F.trim(column), "$,", "")
    return F.when(digits.rlike(PRICE_PATTERN), digits.try_cast("decimal(10,2)"))


def brand(column: Column) -> Column:
    """The trimmed brand name; NULL and blank become the unknown brand."""
    name = F.trim(column)
    return F.when(has_text(name), name).otherwise(UNKNOWN_BRAND)


def known_brand(column: Column) -> Column:
    """The brand after an outer join, where a missing side leaves NULL."""
    return F.coalesce(column, F.lit(UNKNOWN_BRAND))


def mean(total: Column, count: Column, digits: int | None = None) -> Column:
    """Sum over count as a double, NULL when there is nothing to divide by.

    Decimal sums are divided and rounded as decimals.
    """
    quotient = F.try_divide(total, count)
    return (quotient if digits is None else F.round(quotient, digits)).cast("double")
