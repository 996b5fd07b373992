"""Exact substring dedup by a distributed merge sort of front-coded suffix runs (operator 8).

A byte goes if a string of ``WIDTH`` bytes around it also starts anywhere else. Sorting every suffix of the corpus would move
each byte a hundred times, so suffixes are sorted at places that equal strings share:

1. Every window of WIDTH bytes names one place in it, its least 32-byte gram by hash (rightmost of equals). Equal
   windows name equal grams at equal offsets. Windows that name one place are neighbours, an *anchor* with its run of
   windows (about one anchor in 70 bytes). Grams that occur once in the corpus drop out by a distributed count.
2. Anchors whose whole run of windows recurs (same bytes, same offset) are settled: all of it is repeated. One
   *representative* of each such class goes on, as a partner of others.
3. What is left, anchors at the borders of repeats, is settled by suffix order. Tasks sort the suffixes that start at
   their anchors and exchange the runs front-coded (shared prefix length and rest), by range of the gram. The
   receiving task combines the runs with a loser tree that compares prefix lengths first and bytes only beyond what both are
   known to share, which yields the order with the longest common prefixes (LCPs) of neighbours.
4. The LCP intervals of a gram, deepest first, join suffixes whose texts agree to the right; inside an interval those
   that agree most to the left are neighbours in the order of reversed left contexts. Each anchor so gets its
   longest valid agreement to either side (left and right together at least WIDTH): the bytes between are repeated.

Intervals are joined smaller into larger, so a gram with many contexts costs n log n steps, not pairs. Texts travel
twice, once to fetch the contexts of border anchors and once to meet their removed ranges. A range task holds all different
contexts of a gram (equal ones are one); that is the largest thing a task needs at once beside one text.

Matches never cross documents. Null and empty texts have no bytes and no spans, shorter texts than WIDTH lose none. Repeated rows
are copies of each other like any others. Rows with null ids work like others. What is left is bytes: a cut
may go through a character. Other columns stay whatever their names are.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays, shared

WIDTH, GRAM = 200, 32
#: Bytes scanned at once.
PIECE_BYTES = 1 << 19
#: Up to so many grams or ids (8 bytes each) are sent to every executor; beyond, rows are shuffled to meet them.
BROADCAST_ROWS = 1 << 22
#: Sampled grams for each range border; a range holds about RANGE_SUFFIXES suffixes.
SAMPLES, RANGE_SUFFIXES = 32, 20_000


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor, gram, digest) of each anchor; places count from their text's start."""
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < WIDTH:
        return none
    grams = arrays.gram_hashes(data, GRAM)
    low, span = np.uint64((1 << 32) - 1), WIDTH - GRAM + 1
    keyed = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    blocks = np.concatenate([keyed, np.full(-len(keyed) % span, ~np.uint64(0))]).reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    windows = len(data) - WIDTH + 1
    least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
    place = (low - (least & low)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    start = np.flatnonzero(np.arange(windows) + WIDTH <= offsets[text + 1])
    if not len(start):
        return none
    text, place = text[start], place[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    begin, text, place = start[first], text[first], place[first]
    content = arrays.span_hashes(data, begin, begin + count + WIDTH - 1)
    digest = arrays.mix(content ^ arrays.mix((place - begin).astype(np.uint64) << np.uint64(32) | count.astype(np.uint64)))
    base = offsets[text]
    return text, begin - base, count, place - base, grams[place].view(np.int64), digest.view(np.int64)


def _scan(batches: Iterator[pa.RecordBatch], only_grams: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in arrays.pieces(batch["text"], PIECE_BYTES):
            text, begin, count, place, gram, digest = anchors(data, offsets)
            if only_grams:
                yield pa.RecordBatch.from_arrays([pa.array(gram)], ["gram"])
                continue
            ids = [batch[c].slice(first, end - first).take(pa.array(text)) for c in ("doc", "copy")]
            yield pa.RecordBatch.from_arrays(
                [*ids, *map(pa.array, (begin, count, place, gram, digest))],
                ["doc", "copy", "begin", "count", "place", "gram", "digest"],
            )


def contexts(data: bytes, places: list[int], partner: list[bool]) -> Iterator[tuple[bytes, bytes, int, bool]]:
    """(right context from the gram on, reversed left context, place, whether it is only a partner)."""
    for place, only in zip(places, partner, strict=True):
        left = data[max(0, place - (WIDTH - GRAM)) : place]
        yield data[place : place + WIDTH], left[::-1], place, only


def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """(shared prefix with the one before, rests, lengths) of sorted suffixes."""
    shared_, rests, before = np.zeros(len(suffixes), np.int16), [], b""
    for i, s in enumerate(suffixes):
        n = common(before, s, 0)
        shared_[i] = n
        rests.append(s[n:])
        before = s
    return shared_, b"".join(rests), np.array([len(s) for s in suffixes], np.int16)


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    low, high = known, end  # a[known:low] agrees, a[known:high] doesn't
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def merged(runs: list[tuple[list[bytes], np.ndarray]]) -> Iterator[tuple[int, int, int]]:
    """(run, index in it, LCP with the one put out before) of all suffixes in order, by an LCP loser tree.

    runs: sorted suffixes and each one's LCP with the one before it. Every player carries its LCP with the last winner. Of two,
    the one with the larger LCP is smaller; only players with equal LCPs are compared, from there on.
    """
    size = 1
    while size < max(1, len(runs)):
        size *= 2
    texts = [r[0] for r in runs]
    lcps = [r[1].tolist() for r in runs]
    at = [0] * len(runs)
    lcp = [0] * size
    over = [k >= len(runs) or not texts[k] for k in range(size)]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's LCP becomes that with the winner."""
        if over[a] or over[b]:
            return (b, a) if over[a] else (a, b)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = texts[a][at[a]], texts[b][at[b]]
        n = common(x, y, lcp[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            lcp[b] = n
            return a, b
        lcp[a] = n
        return b, a

    tree = [0] * size  # tree[k]: the loser of the match at inner node k
    level = list(range(size))
    node = size // 2
    while len(level) > 1:
        up = []
        for i in range(0, len(level), 2):
            winner, loser = play(level[i], level[i + 1])
            tree[node + i // 2] = loser
            up.append(winner)
        level, node = up, node // 2
    winner = level[0]
    while not over[winner]:
        yield winner, at[winner], lcp[winner]
        at[winner] += 1
        if at[winner] < len(texts[winner]):
            lcp[winner] = lcps[winner][at[winner]]
        else:
            over[winner] = True
        node = (winner + size) // 2
        while node >= 1:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


def agreements(lefts: list[bytes], lcps: list[int]) -> list[tuple[int, int]]:
    """(left, right): the longest valid agreements of each suffix of one gram with another, (0, 0) if none is valid.

    lefts: reversed left contexts, in suffix order; lcps[i]: LCP of suffixes i - 1 and i.
    """
    n = len(lefts)
    best = [(0, 0)] * n
    if n <= 6:
        for i in range(n):
            right = WIDTH
            for j in range(i + 1, n):
                right = min(right, lcps[j])
                left = common(lefts[i], lefts[j], 0)
                if left + right >= WIDTH:
                    for k in (i, j):
                        best[k] = max(best[k][0], left), max(best[k][1], right)
        return best
    order = sorted(range(n), key=lefts.__getitem__)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    beside = [0] + [common(lefts[order[r - 1]], lefts[order[r]], 0) for r in range(1, n)]
    table = [np.array(beside)]  # minima over 2 ** k neighbours
    while len(table[-1]) > 1 << len(table) - 1:
        half = 1 << len(table) - 1
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))

    def left_of(a: int, b: int) -> int:
        if b - a == 1:
            return beside[b]
        k = (b - a).bit_length() - 1
        return int(min(table[k][a + 1], table[k][b + 1 - (1 << k)]))

    def meet(a: int, b: int, right: int) -> None:
        left = left_of(a, b)
        if left + right >= WIDTH:
            for i in (order[a], order[b]):
                best[i] = max(best[i][0], left), max(best[i][1], right)

    root = list(range(n))
    sets = [[rank[i]] for i in range(n)]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in sorted(range(1, n), key=lambda i: -lcps[i]):
        a, b = find(i - 1), find(i)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets[b]
        for r in small:
            k = bisect.bisect(large, r)
            if k:
                meet(large[k - 1], r, lcps[i])
            if k < len(large):
                meet(r, large[k], lcps[i])
        if len(small) * 8 < len(large):
            for r in small:
                bisect.insort(large, r)
        else:
            sets[a] = sorted(large + small)
        sets[b] = []
        root[b] = a
    return best


_CODEC = "zstd"
_RUN = "part int, run string, suffixes binary, sizes binary"


def _packed(*parts: bytes) -> tuple[bytes, list[int]]:
    whole = b"".join(parts)
    return pa.compress(whole, codec=_CODEC, asbytes=True), [len(whole), *map(len, parts)]


def _runs(batches: Iterator[pa.RecordBatch], borders: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs of the wanted contexts of each batch, one for each range."""
    for batch in batches:
        for low in range(0, len(batch), 2000):
            part = batch.slice(low, 2000)
            found = []
            for doc, copy, text, wanted in zip(
                part["doc"].to_pylist(), part["copy"].to_pylist(), part["text"].to_pylist(), part["wanted"].to_pylist(), strict=True
            ):
                places = [w["place"] for w in wanted]
                for right, left, place, only in contexts(text.encode(), places, [w["only"] for w in wanted]):
                    found.append((right, left, place, only, doc, copy))
            found.sort(key=lambda x: x[0])
            ranges = [bisect.bisect_right(borders, x[0][:GRAM]) for x in found]
            rows = []
            first = 0
            while first < len(found):
                end = bisect.bisect_right(ranges, ranges[first])
                own = found[first:end]
                lcps, rests, sizes = front_coded([x[0] for x in own])
                known = np.array([x[4] is not None for x in own])
                numbers = np.array([[x[4] or 0, x[5], x[2], x[3]] for x in own], np.int64)
                blob, cut = _packed(
                    lcps.tobytes(), sizes.tobytes(), rests, np.array([len(x[1]) for x in own], np.int16).tobytes(),
                    b"".join(x[1] for x in own), numbers.tobytes(), known.tobytes(),
                )
                name = f"{own[0][4]}/{own[0][5]}/{own[0][2]}/{low}"
                rows.append((ranges[first], name, blob, np.array(cut, np.int64).tobytes()))
                first = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)]
                if rows
                else [pa.array([], k) for k in (pa.int32(), pa.string(), pa.binary(), pa.binary())],
                ["part", "run", "suffixes", "sizes"],
            )


def _unpacked(blob: bytes, sizes: bytes) -> tuple[list[bytes], np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    whole, *cut = np.frombuffer(sizes, np.int64).tolist()
    data = pa.decompress(blob, whole, codec=_CODEC, asbytes=True)
    parts, at = [], 0
    for n in cut:
        parts.append(data[at : at + n])
        at += n
    lcps, lengths = np.frombuffer(parts[0], np.int16), np.frombuffer(parts[1], np.int16)
    texts, before, at = [], b"", 0
    for n, length in zip(lcps.tolist(), lengths.tolist(), strict=True):
        before = before[:n] + parts[2][at : at + length - n]
        at += length - n
        texts.append(before)
    lefts, at = [], 0
    for n in np.frombuffer(parts[3], np.int16).tolist():
        lefts.append(parts[4][at : at + n])
        at += n
    return texts, lcps, lefts, np.frombuffer(parts[5], np.int64).reshape(-1, 4), np.frombuffer(parts[6], bool)


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, copy, begin, end) of repeated ranges, from runs in order of their ranges."""
    held: list[tuple] = []
    part = None
    for batch in batches:
        for own, blob, sizes in zip(batch["part"].to_pylist(), batch["suffixes"].to_pylist(), batch["sizes"].to_pylist(), strict=True):
            if held and own != part:
                yield _ranges(held)
                held = []
            part = own
            held.append(_unpacked(blob, sizes))
    if held:
        yield _ranges(held)


def _ranges(runs: list[tuple]) -> pa.RecordBatch:
    found: list[tuple[int | None, int, int, int]] = []
    group: list[tuple[int, int]] = []
    lcps: list[int] = []

    def settle() -> None:
        if len(group) > 1:
            best = agreements([runs[r][2][i] for r, i in group], lcps)
            for (r, i), (left, right) in zip(group, best, strict=True):
                doc, copy, place, only = runs[r][3][i].tolist()
                if right and not only:
                    found.append((doc if runs[r][4][i] else None, copy, place - left, place + right))

    for run, i, lcp in merged([(r[0], r[1]) for r in runs]):
        if lcp < GRAM:
            settle()
            group, lcps = [], []
        group.append((run, i))
        lcps.append(lcp)
    settle()
    columns = list(zip(*found, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "copy", "begin", "end"])


def _few(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, copy, begin, end): byte ranges of texts that consist of repeated windows. docs: doc, copy, text."""
    grams = docs.select("doc", "copy", "text").mapInArrow(lambda b: _scan(b, True), "gram long")
    grams = _few(shared.stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")))
    kind = "doc long, copy long, begin long, count long, place long, gram long, digest long"
    found = docs.select("doc", "copy", "text").mapInArrow(lambda b: _scan(b, False), kind)
    # Read twice from the texts rather than stored: it would take as much disk as they do.
    found = found.join(grams, "gram", "left_semi")

    # Whole runs of windows that recur, and one representative of each for grams that have other anchors.
    place = F.struct("doc", "copy", "place")
    alike = found.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one"))
    alike = shared.stored(alike)
    whole = found.join(alike.filter("n > 1").select("gram", "digest"), ["gram", "digest"], "left_semi")
    whole = whole.select("doc", "copy", "begin", (F.col("begin") + F.col("count") + (WIDTH - 1)).alias("end"))
    kinds = alike.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    border = shared.stored(kinds.filter("kinds > 1 AND least = 1").select("gram"))
    wanted = alike.join(border, "gram", "left_semi").select("gram", "one.*", (F.col("n") > 1).alias("only"))
    wanted = shared.stored(wanted)

    lists = wanted.groupBy("doc", "copy").agg(F.collect_list(F.struct("place", "only")).alias("wanted"))
    lists = lists.withColumnsRenamed({"doc": "of", "copy": "of_copy"})
    same = F.col("doc").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("of_copy"))
    ids = shared.stored(lists.select("of", "of_copy"))
    holding = docs.join(F.broadcast(ids), same, "left_semi") if ids.count() <= BROADCAST_ROWS else docs
    holding = holding.join(lists, same).dropDuplicates(["doc", "copy"]).select("doc", "copy", "text", "wanted")
    total = wanted.count()
    parts = max(1, total // RANGE_SUFFIXES)
    borders: list[bytes] = []
    if parts > 1:
        share = min(1.0, 2 * SAMPLES * parts / total)
        sampled = wanted.groupBy("gram").agg(F.min(F.struct("doc", "copy", "place")).alias("p")).select("p.*")
        sampled = sampled.filter(F.pmod(F.xxhash64("doc", "copy", "place"), F.lit(1 << 20)) < int(share * (1 << 20)))
        sampled = sampled.withColumnsRenamed({"doc": "of", "copy": "of_copy", "place": "p"})
        chosen = docs.join(F.broadcast(sampled.limit(4 * SAMPLES * parts)), same).select(
            F.encode("text", "utf-8").alias("b"), "p"
        )
        texts = [bytes(r["g"]) for r in chosen.select(F.expr(f"substring(b, cast(p as int) + 1, {GRAM})").alias("g")).collect()]
        texts.sort()
        borders = sorted({texts[len(texts) * i // parts] for i in range(1, parts)}) if texts else []
    runs = holding.mapInArrow(lambda b: _runs(b, borders), _RUN)
    count = max(1, len(borders) + 1)
    dealt = runs.repartition(max(count, 1), "part").sortWithinPartitions("part", "run")
    settled = dealt.mapInArrow(_combined, "doc long, copy long, begin long, end long")
    return whole.unionByName(settled)


def _cut(text: pa.Array, ranges: pa.Array) -> pa.Array:
    rows = []
    for one, own in zip(text.to_pylist(), ranges.to_pylist(), strict=True):
        data, kept, at, spans = (one or "").encode(), [], 0, 0
        end = None
        for r in sorted(own or (), key=lambda r: r["begin"]):
            if end is None or r["begin"] > end:
                spans += 1
                kept.append(data[at : r["begin"]])
                at = end = r["end"]
            elif r["end"] > end:
                at = end = r["end"]
        kept.append(data[at:])
        left = b"".join(kept)
        rows.append((left, len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest()))
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows and columns of docs, with kept (bytes), n_bytes, n_removed, n_spans and kept_sha256."""
    added = ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    keyed = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("copy"), F.coalesce(text, F.lit("")).alias("text"))
    ranges = repeated_ranges(keyed).groupBy("doc", "copy").agg(F.collect_list(F.struct("begin", "end")).alias("__ranges"))
    ranges = ranges.withColumnsRenamed({"doc": "__doc", "copy": "__copy"})
    rows = docs.select(*shared.names(docs, *added), F.col(key).cast("long").alias("__of"), F.xxhash64(text).alias("__of_copy"))
    same = F.col("__of").eqNullSafe(F.col("__doc")) & (F.col("__of_copy") == F.col("__copy"))
    cut = F.arrow_udf(
        _cut, "kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    ).asNondeterministic()
    joined = rows.join(ranges, same, "left")
    return joined.select(*shared.names(docs, *added), cut(F.col(text), F.col("__ranges")).alias("__cut")).select(
        *shared.names(docs, *added), "__cut.*"
    )
