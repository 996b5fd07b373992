"""Rules that shape finished results: price bands, labels, tolerant number columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.cleaning import number

# Lower edge (in dollars) and label of each price band.
PRICE_BANDS = (
    (0, "$0–24"),
    (25, "$25–49"),
    (50, "$50–99"),
    (100, "$100–249"),
    (250, "$250–499"),
    (500, "$500–999"),
    (1000, "$1,000+"),
)

# Fixed values of the product label.
UNTITLED = "Unknown product"
LABEL_TITLE_CHARS = 48
LABEL_KEY_CHARS = 6
LABEL_SEPARATOR = " · "


def price_band_order(amount: Column) -> Column:
    """Number of the band an amount falls in: how many lower edges it has reached, at least 1."""
    inner_edges = [edge for edge, _ in PRICE_BANDS[1:]]
    reached = [(amount >= edge).cast("int") for edge in inner_edges]
    return sum(reached, F.lit(1))


def price_band_label(order: Column) -> Column:
    """Label that belongs to a band number."""
    return F.element_at(F.array(*[F.lit(label) for _, label in PRICE_BANDS]), order)


def product_label(title: Column, key: Column) -> Column:
    """Short display name: start of the title, then the tail of the product key."""
    shown = F.coalesce(F.nullif(title, F.lit("")), F.lit(UNTITLED))
    return F.concat(
        F.left(shown, F.lit(LABEL_TITLE_CHARS)),
        F.lit(LABEL_SEPARATOR),
        F.right(key, F.lit(LABEL_KEY_CHARS)),
    )


def coerce_numeric(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn the named columns into doubles, texts that are no plain number into NULL.

    Names the frame does not have are skipped.
    """
    kinds = dict(frame.dtypes)
    present = [name for name in columns if name in kinds]
    return frame.withColumns(
        {
            name: number(F.col(name)) if kinds[name] == "string" else F.col(name).cast("double")
            for name in present
        }
    )
