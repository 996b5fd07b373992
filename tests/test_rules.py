"""The cleaning and display rules, one case per trap."""

from __future__ import annotations

import hashlib
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from reviewmill.functions import cleaning as rule
from reviewmill.functions import display


def values(spark, kind, inputs, column):
    """Results of a column rule, in input order."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [r[1] for r in frame.select("i", column(F.col("v"))).orderBy("i").collect()]


def test_product_key_falls_back_on_null_only(spark):
    frame = spark.createDataFrame(
        [(" P ", "V"), (None, "V"), ("  ", "V"), (None, None)], "p STRING, v STRING"
    )
    key = rule.product_key(F.col("p"), F.col("v"))
    got = frame.select(key, rule.is_present(key)).collect()
    assert [tuple(r) for r in got] == [("P", True), ("V", True), ("", False), (None, False)]


def test_tab_is_not_blank(spark):
    assert values(spark, "STRING", ["\t", " "], rule.is_present) == [True, False]


def test_rating_range(spark):
    nan = float("nan")
    got = values(spark, "DOUBLE", [1.0, 5.0, 4.5, 0.99, 5.01, nan, None], rule.valid_rating)
    assert got == [1.0, 5.0, 4.5, None, None, None, None]
    texts = ["4", "x", "4d", "4.0f", " 4.5 ", "1e0", "NaN", "Infinity", "+.5", "", "4\n"]
    got = values(spark, "STRING", texts, lambda c: rule.valid_rating(rule.number(c)))
    assert got == [4.0, None, None, None, 4.5, 1.0, None, None, None, None, None]


def test_count_default(spark):
    assert values(spark, "BIGINT", [3, 0, -1, None], rule.non_negative_long) == [3, 0, 0, 0]
    assert values(spark, "STRING", ["7", "x"], lambda c: rule.non_negative_long(c, 2)) == [7, 2]


def test_flag(spark):
    assert values(spark, "BOOLEAN", [True, False, None], rule.flag) == [True, False, False]


def test_epoch_seconds(spark):
    ms = [1, 999, 1000, 0, -5, None, rule.LAST_EPOCH_MS, rule.LAST_EPOCH_MS + 1, 2**63 - 1]
    expected = [0, 0, 1, None, None, None, 253402300799, None, None]
    assert values(spark, "BIGINT", ms, rule.epoch_seconds) == expected


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_time_forms_do_not_depend_on_the_session_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    frame = spark.createDataFrame([(1_704_067_199,), (None,)], "s BIGINT")
    time = rule.utc_time(F.col("s"))
    got = frame.select(time.text, time.year, time.month, F.unix_seconds(time.instant)).collect()
    assert tuple(got[0]) == ("2023-12-31 23:59:59", 2023, "2023-12", 1_704_067_199)
    assert tuple(got[1]) == (None, 0, "unknown", None)


def test_content_id(spark):
    given = [("a", None, "c"), ("a", "", "c")]
    frame = spark.createDataFrame(given, "a STRING, b STRING, c STRING")
    expected = hashlib.sha256(b"a||||c").hexdigest()
    ids = frame.select(rule.content_id(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in ids] == [expected, expected]


def test_price(spark):
    cases = {
        "12.99": Decimal("12.99"),
        " $1,225.00 ": Decimal("1225.00"),
        "7": Decimal("7.00"),
        "7.5": Decimal("7.50"),
        "from 12.99": None,
        "-3.00": None,
        "12.999": None,
        "1e3": None,
        "999999999.00": None,
        "12.": None,
        ".5": None,
        "": None,
        None: None,
    }
    assert values(spark, "STRING", list(cases), rule.price) == list(cases.values())


def test_price_on_random_texts(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices("0123456789.,$- e\t", k=rng.randint(0, 9))) for _ in range(4000)]
    texts += [f"{rng.randint(0, 10**9)}.{rng.randint(0, 999)}" for _ in range(500)]

    def expected(text):
        digits = text.strip(" ").replace("$", "").replace(",", "")
        if not re.fullmatch(r"[0-9]+(\.[0-9]{1,2})?", digits):
            return None
        amount = Decimal(digits)
        return amount if amount < 10**8 else None

    got = values(spark, "STRING", texts, rule.price)
    assert got == [expected(text) for text in texts]
    assert sum(value is not None for value in got) > 300


def test_brand(spark):
    assert values(spark, "STRING", [" x ", "  ", "", None], rule.brand) == [
        "x",
        "Unknown",
        "Unknown",
        "Unknown",
    ]


def test_price_bands(spark):
    amounts = [0, 24.99, 25, 49.99, 50, 99.99, 100, 249.99, 250, 499.99, 500, 999.99, 1000, 5000]
    orders = values(spark, "DOUBLE", [float(a) for a in amounts], display.price_band_order)
    assert orders == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7]
    labels = values(spark, "INT", [1, 2, 7], display.price_band_label)
    assert labels == ["$0–24", "$25–49", "$1,000+"]


def test_product_label(spark):
    frame = spark.createDataFrame(
        [("é" * 60, "B000123456"), ("", "B1"), (None, "B2")], "t STRING, k STRING"
    )
    got = [r[0] for r in frame.select(display.product_label(F.col("t"), F.col("k"))).collect()]
    assert got == ["é" * 48 + " · 123456", "Unknown product · B1", "Unknown product · B2"]


def test_coerce_numeric(spark):
    given = [("1.5", "x", "k"), (None, "2", "k")]
    frame = spark.createDataFrame(given, "a STRING, b STRING, c STRING")
    got = display.coerce_numeric(frame, ["a", "b", "absent"])
    assert got.dtypes == [("a", "double"), ("b", "double"), ("c", "string")]
    assert rows(got) == [(1.5, None, "k"), (None, 2.0, "k")]
