"""Whitening, phrase mining and sharding against brute force, with nulls, ties, repeats, clashing columns and no rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import feistel_shards, qd_whitening, queries, vertical_phrases

SMALL = "/root/testdata/sf0.001"


# Sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 97, 1000, 4093])
def test_places_are_a_permutation_with_an_inverse(spark, n):
    number = F.col("id")
    got = spark.range(n).select(number, feistel_shards.place_of(number, n, seed=5).alias("p"))
    got = got.withColumn("back", feistel_shards.number_at(F.col("p"), n, seed=5)).collect()
    assert sorted(r.p for r in got) == list(range(n))
    assert all(r.back == r.id for r in got)
    if n > 90:
        assert sum(r.p == r.id for r in got) < n / 10


def test_walks_over_far_too_large_a_domain_end_below_n(spark, monkeypatch):
    monkeypatch.setattr(feistel_shards, "radices", lambda n: (12, 13))  # 156 places for 40 rows
    got = spark.range(40).select("id", feistel_shards.place_of(F.col("id"), 40).alias("p"))
    got = got.withColumn("back", feistel_shards.number_at(F.col("p"), 40)).collect()
    assert sorted(r.p for r in got) == list(range(40)) and all(r.back == r.id for r in got)


def test_radices_are_close():
    for n in [0, 1, 2, 10, 997, 10**6 + 3, 10**11 + 3]:
        a, b = feistel_shards.radices(n)
        assert n <= a * b <= n + 2 + math.isqrt(n) // 50 + 40


def shard_docs(spark):
    rows = [(i % 50, f"text {i}", "clash", "c", "d") for i in range(150)]
    rows += [(None, None, "x", "c", "d"), (None, "", "x", "c", "d"), (7, "same", "x", "c", "d")] * 20
    rows += [(1000 + i, "copy", "x", "c", "d") for i in range(100)] + [(5000, "é" * 100_000, "x", "c", "d")]
    return spark.createDataFrame(rows, "doc_id long, text string, slot string, digest string, place string")


def test_dealing(spark, settings):
    given = shard_docs(spark)
    n = given.count()
    dealt = feistel_shards.deal(given.repartition(7))
    assert dealt.columns == ["doc_id", "text", "digest", "place", "size", "row_number", "shard", "slot"]
    rows = dealt.collect()
    assert len(rows) == n and {r.size for r in rows if r.doc_id == 5000} == {200_001}
    assert sorted(r.row_number for r in rows) == list(range(n))
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, size in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))
    assert max(Counter(r.shard for r in rows if r.text == "copy").values()) < 35
    # The same under other partitions and settings; copies are interchangeable.
    settings(spark__sql__shuffle__partitions="3")
    again = feistel_shards.deal(given.coalesce(1)).collect()
    plain = lambda found: sorted((str(r.doc_id), r.text or "", r.shard, r.slot) for r in found)
    assert plain(again) == plain(rows)
    other = feistel_shards.deal(given, seed=1, shards=3).collect()
    assert plain(other) != plain(rows) and {r.shard for r in other} == {0, 1, 2}
    assert feistel_shards.deal(given.limit(0)).count() == 0


# Whitening


def whole(vectors):
    return np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)


def expected(vectors, k):
    """n, deviations, components and whitened vectors by brute force: whole numbers, then eigenvectors of the covariance."""
    x = whole(vectors)
    n, sums = len(x), x.sum(axis=0)
    scaled = n * x - sums
    centred = (scaled / n).astype(float)
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1][:k], found[:, ::-1][:, :k]
    return n, [int(v) for v in (scaled * scaled).sum(axis=1)], values, centred @ found / np.sqrt(values)


def vectors_of(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, vector string, whitening int")


@pytest.mark.parametrize("parts, kind", [(1, "float"), (23, "double")])
def test_whitening_equals_brute_force(spark, monkeypatch, parts, kind):
    monkeypatch.setattr(qd_whitening, "FAN_IN", 3)
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(300, 12)) * np.logspace(0, -2, 12)).astype(np.float32)
    rows = [(i, [float(c) for c in v], "clash", 1) for i, v in enumerate(data)]
    bad = [None, [None] * 12, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [0.5] * 3, []]
    given = vectors_of(spark, rows + rows[:20] + [(None, rows[0][1], "c", 1)] + [(-1, b, "c", 1) for b in bad], kind)
    given = given.repartition(parts)
    model = qd_whitening.fit(given)
    white = qd_whitening.whiten(given, model)
    assert white.columns == ["vec_id", "embedding", "vector", "whitening"]
    got = white.collect()
    assert len(got) == 321
    n, deviations, values, projected = expected([r.embedding for r in got], 8)
    assert model.n == n == 321
    assert np.allclose(model.variances, values, rtol=1e-12, atol=0)
    assert [int(r.whitening.deviation) for r in got] == deviations
    mine = np.array([r.whitening.whitened for r in got])
    signs = np.sign((mine * projected).sum(axis=0))
    assert np.abs(mine - projected * signs).max() < 1e-9
    assert qd_whitening.identity_error(given, model) < 1e-12
    x = whole([r.embedding for r in got]).astype(float)
    assert np.allclose(model.explained, values / np.cov(x.T, bias=True).trace(), rtol=1e-9)


def test_whitening_without_variance_or_vectors(spark):
    same = vectors_of(spark, [(i, [0.25, -1.0], "c", 1) for i in range(5)])
    model = qd_whitening.fit(same)
    assert model.n == 5 and len(model.variances) == 0
    assert [(r.whitening.deviation, r.whitening.whitened) for r in qd_whitening.whiten(same, model).collect()] == [(0, [])] * 5
    assert qd_whitening.identity_error(same, model) == 0
    line = vectors_of(spark, [(i, [float(i), 2.0 * i, 1.0], "c", 1) for i in range(5)])
    model = qd_whitening.fit(line)
    assert len(model.variances) == 1
    first = [r.whitening.whitened[0] for r in qd_whitening.whiten(line, model).orderBy("vec_id").collect()]
    assert np.allclose(np.abs(first), np.sqrt(2) * np.abs([-1, -0.5, 0, 0.5, 1]))
    none = same.filter("vec_id < 0")
    assert qd_whitening.fit(none) is None and qd_whitening.whiten(none, None).count() == 0
    assert queries.op11_qd_whitening(spark, SMALL).columns[:2] == ["vec_id", "component"]


def test_whitening_of_huge_entries_is_exact(spark):
    rows = [[1e300, 0.0], [-1e300, 0.5], [3.0, -0.5]]
    given = vectors_of(spark, [(i, v, "c", 1) for i, v in enumerate(rows)], "double")
    got = qd_whitening.whiten(given, qd_whitening.fit(given)).orderBy("vec_id").collect()
    most = qd_whitening.LARGEST
    assert [r.whitening.deviation for r in got] == [Decimal(d) for d in expected(np.clip(rows, -most, most), 1)[1]]


def spectrum(values, seed=0):
    rng = np.random.default_rng(seed)
    d = len(values)
    left, right = (np.linalg.qr(rng.normal(size=(k, d)))[0] for k in (3 * d, d))
    return left * np.array(values) @ right.T


@pytest.mark.parametrize(
    "x",
    [
        np.eye(20) * 3,
        spectrum(np.logspace(0, -7, 30)),
        spectrum([2.0] * 6 + [2 + 1e-9] + [1.0] * 20),
        spectrum([2 + 1e-5 * i for i in range(10)] + [1.0] * 10),
        np.repeat(spectrum(np.linspace(1, 3, 24))[:10], 3, axis=0),
        np.zeros((4, 5)),
        np.ones((1, 1)),
        np.diag([5.0, 0, 3, 0, 1]),
    ],
    ids=["equal", "graded", "cluster", "close", "low rank", "zero", "one", "holes"],
)
def test_qd_solver(x):
    values, found = qd_whitening.principal(np.linalg.qr(x, mode="r"), 8)
    right = np.linalg.eigvalsh(x.T @ x)[::-1][: len(values)]
    assert np.allclose(values, right, rtol=1e-12, atol=1e-13 * max(right, default=0))
    assert len(values) == min(8, np.linalg.matrix_rank(x))
    assert np.abs(found.T @ found - np.eye(len(values))).max(initial=0) < 1e-13
    assert np.abs(x.T @ (x @ found) - found * values).max(initial=0) <= 1e-13 * max(values, default=1)


def test_qd_values_of_small_numbers_are_relatively_exact():
    """Powers of ten apart: the product of all values is known from the diagonal."""
    q, e = [10.0**-k for k in range(0, 40, 2)], [10.0 ** -(k + 1) for k in range(0, 38, 2)]
    found = qd_whitening.qd_values(q, e)
    assert math.isclose(sum(map(math.log10, found)), sum(map(math.log10, q)), rel_tol=1e-12)


# Phrase mining


def mined(rows, min_count, percent=100):
    """(lang, phrase) -> (a, l, r, n, score), by brute force."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = {}
    for (lang, *words), a in candidates.items():
        k = len(words)
        cuts = [(1000 * a * n[lang] // (f[lang, *words[:c]] * f[lang, *words[c:]]), c) for c in range(1, k)]
        score, c = min(cuts)
        inside = any(
            o[0] == lang and len(o) > k + 1 and 100 * b >= percent * a and any(list(o[1 + i : 1 + i + k]) == words for i in range(len(o) - k))
            for o, b in candidates.items()
        )
        if not inside:
            out[lang, " ".join(words)] = (a, f[lang, *words[:c]], f[lang, *words[c:]], n[lang], score)
    return out


def phrase_rows():
    rng = random.Random(11)
    words = ["the", "The", "of", "a\x01b", "a\x00", "é", "naïve", "x" * 300, "　", "<", "of-"] + [f"w{i}" for i in range(30)]
    gaps = [" "] * 9 + ["\t", "  ", ". ", "\n", ";"]

    def text(size):
        return "".join(rng.choice(words[:5] if rng.random() < 0.6 else words) + rng.choice(gaps) for _ in range(size))

    rows = [(rng.choice(["en", "en", "de", None, ""]), text(rng.choice([0, 1, 5, 40, 200]))) for _ in range(120)]
    copy = "same old Line of many words here, and More"
    return rows + [("en", copy)] * 60 + [("fr", None), (None, ""), ("fr", " \t.\n"), ("fr", "Ä Ä Ä")]


@pytest.mark.parametrize("budget, parts, percent", [(1 << 21, 1, 100), (300, 5, 100), (20, 3, 60)])
def test_phrases_equal_brute_force(spark, budget, parts, percent):
    rows = phrase_rows()
    given = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, text string, phrase string, f int").repartition(parts)
    got = vertical_phrases.collocations(given, min_count=8, covered_percent=percent, budget=budget)
    mine = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in got.collect()}
    assert mine == mined(rows, 8, percent)
    assert len(mine) > 50 and ("und", "the the") in mine
    assert vertical_phrases.collocations(given.limit(0)).count() == 0


def test_long_texts_are_cut_at_ends_of_pieces_only(spark, monkeypatch):
    monkeypatch.setattr(vertical_phrases, "BLOCK_BYTES", 64)
    rows = [("en", "one two three four five six. " * 300 + "z " * 200), ("en", "one two")]
    given = spark.createDataFrame(rows, "lang string, text string")
    found, sizes = vertical_phrases.frequencies(given, min_count=2, budget=50)
    got = {r.phrase: r.f for r in found.collect()}
    assert got["one two"] == 301 and got["two three four five six"] == 300 and got["z z z z z"] == 196
    assert "six one" not in got and [tuple(r) for r in sizes.collect()] == [("en", 2002)]


def test_a_text_is_cut_where_pieces_end():
    data = np.frombuffer(b"aa bb. cc dd, ee" * 40 + b" tail" * 60, np.uint8)
    parts = [bytes(p[0]) for p in vertical_phrases._stretches(data, np.array([0, len(data)]), 50)]
    assert b"".join(parts) == bytes(data) and len(parts) > 5
    assert all(p[-1:] in b".," for p in parts[:-1])


def test_ranks(spark):
    rows = [("en", p, a, 1, 1, 9, s) for p, a, s in [("b a", 5, 7), ("b", 5, 7), ("é", 5, 7), ("c", 6, 7), ("d", 1, 8)]]
    given = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    got = vertical_phrases.top(given, limit=4).orderBy("rank").collect()
    assert [(r.rank, r.phrase) for r in got] == [(1, "d"), (2, "c"), (3, "b"), (4, "b a")]
