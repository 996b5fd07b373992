"""Near-duplicates by BagMinHash over word shingles (operator 6).

A text is a bag: its runs of ``SHINGLE`` words with their counts (a shorter text is one run). Signatures estimate the weighted
Jaccard similarity of bags without bias. A shingle of weight w is covered by weight intervals [0, 1), [1, 2),
[2, 4), [4, 8), ... up to w; each interval of each shingle has a Poisson process of points whose rate is its length,
the same in every text. A point of an interval falls on one unit of weight and one signature slot, and counts only
if that unit lies below w. A slot keeps its earliest point. Points are made in order of time up to a horizon at
which all slots are expected to be filled, and on for texts where some aren't, so work hardly depends on weights.

Then signatures are cut into bands. Texts with equal words are one class first, and only its first document goes
on. Texts that share a band meet in its bucket: every member is compared with the bucket's first one, by exact
bag overlap of the whole texts. Members of a bucket that lie in different components afterwards may still be linked: in
a small bucket they are compared with each other, unless their distances to the first rule a link out (weighted
Jaccard distance is a metric: distances of near texts differ by less than the limit). Larger buckets are put together by the
component that most of their members belong to, so a group of copies that fills a bucket of each band is one group, and
each text goes there once. Links between two members of that component tell nothing new; the others, its stragglers, are
compared with all members of the group, in blocks bounded by texts and bytes, and only links that connect components leave a
task. So no link between bucket members is lost, and a group of thousands of copies puts out one pair each, not one for each
two. With 32 bands of 5 rows, texts of similarity 0.8 share a bucket with probability 0.999997.

Buckets, links and components stay in Spark tables; counts combine before shuffles, and joins run between stored
tables, so that hot buckets are split. Only texts that have a candidate travel.

Null and empty texts, and those of white space alone, are one class of copies without shingles. Rows without id get the
class of their copies that have one, else null. Rows with one id: the first text by its digest stands for the id in comparisons. An
empty table gives none. Other columns stay; ``class_id`` is the least id that a document is connected with.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays, graphs, shared

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 5
#: Up to so many ids (8 bytes each) are sent to every executor to pick the texts that have candidates.
BROADCAST_IDS = 1 << 20

#: Buckets up to so many members are compared in pairs; larger ones in blocks of about BLOCK members.
SMALL_BUCKET, BLOCK = 12, 1024
#: Bytes of bags of a block, about.
BLOCK_BYTES = 32 << 20

_GOLDEN = 0x9E3779B97F4A7C15


def _u(x: int) -> np.uint64:
    return np.uint64(x & ((1 << 64) - 1))


def shingles(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle occurrence."""
    n = len(hashes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    at = np.arange(n)
    ok = (at + SHINGLE <= ends[text]) | ((at == starts[text]) & (sizes[text] < SHINGLE))
    at, text = at[ok], text[ok]
    out = hashes[at]
    for j in range(1, SHINGLE):
        inside = at + j < ends[text]
        out = arrays.mix(out * _u(_GOLDEN) + np.where(inside, hashes[np.minimum(at + j, n - 1)], np.uint64(0)) + _u(j))
    return text, out


def bags(text: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count), for fewer than 2 ** 16 texts; shingles are cut to 48 bits."""
    key = np.sort((text.astype(np.uint64) << np.uint64(48)) | (shingle >> np.uint64(16)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & _u((1 << 48) - 1), np.diff(np.append(first, len(new)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, slots: int) -> np.ndarray:
    """texts x slots: the names of the earliest points."""
    weight = np.bincount(text, count, minlength=texts)
    best = np.full(texts * slots, np.inf)
    name = np.zeros(texts * slots, np.uint64)
    # One process for each element and weight interval.
    levels = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    of = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    length = np.maximum(low, 1)
    doc, limit, key = text[of], count[of], arrays.mix(arrays.mix(shingle[of] + _u(1)) + level.astype(np.uint64))
    time, number = np.zeros(len(of)), np.zeros(len(of), np.uint64)
    slow = 1.0 / (slots * length)
    pending = np.ones(len(of), bool)
    horizon = (np.log(slots) + 4) / np.maximum(weight, 1)
    while pending.any():
        live = np.flatnonzero(pending)
        d, k, t, s, i, lo, ln, c = (x[live] for x in (doc, key, time, slow, number, low, length, limit))
        while len(live):
            h = arrays.mix(k + i * _u(_GOLDEN))
            after = t - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * s
            inside = after <= horizon[d]
            if not inside.all():  # these processes wait where they are
                stop = ~inside
                time[live[stop]], number[live[stop]] = t[stop], i[stop]
                live, d, k, s, i, lo, ln, c, h = (x[inside] for x in (live, d, k, s, i, lo, ln, c, h))
                after = after[inside]
            t, i = after, i + np.uint64(1)
            other = arrays.mix(h + _u(_GOLDEN))
            unit = lo + ((other >> np.uint64(32)).astype(np.int64) & (ln - 1))
            counts = unit < c
            slot = d * slots + ((other & _u(0xFFFFFFFF)).astype(np.int64) * slots >> 32)
            slot, at, called = slot[counts], t[counts], other[counts]
            np.minimum.at(best, slot, at)
            first = best[slot] == at
            name[slot[first]] = called[first]
        empty = np.isinf(best.reshape(texts, slots)).any(1) & (weight > 0)
        horizon[empty] *= 2
        pending = empty[doc]
    return name.reshape(texts, slots)


def _sign(column: pa.Array) -> pa.Array:
    names, bands, sizes_out = [], [], []
    for _, _, data, offsets in arrays.pieces(column):
        for low in range(0, len(offsets) - 1, 1 << 15):
            own = offsets[low : low + (1 << 15) + 1]
            part, own = data[own[0] : own[-1]], own - own[0]
            starts, ends, sizes = arrays.words(part, own)
            hashes = arrays.span_hashes(part, starts, ends)
            # A 128-bit name of the sequence of words.
            place = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            salted = [arrays.mix(hashes + arrays.mix(place.astype(np.uint64) + _u(salt))) for salt in (11, 10**9 + 7)]
            names.append(np.stack([_sums(x, sizes) + arrays.mix(sizes.astype(np.uint64)) for x in salted], 1))
            text, shingle, count = bags(*shingles(hashes, sizes))
            signed = signatures(text, shingle, count, len(sizes), BANDS * ROWS).reshape(len(sizes), BANDS, ROWS)
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sizes), BANDS)).copy()
            for row in range(ROWS):
                key = arrays.mix(key * _u(_GOLDEN) + signed[:, :, row])
            full = sizes > 0
            bands.append(key[full].ravel())
            sizes_out.append(full * BANDS)
    name = np.concatenate(names) if names else np.zeros((0, 2), np.uint64)
    flat = np.concatenate(bands) if bands else np.zeros(0, np.uint64)
    at = np.append(0, np.cumsum(np.concatenate(sizes_out) if sizes_out else [])).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))
    return pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(name[:, 0]).view(np.int64)), pa.array(np.ascontiguousarray(name[:, 1]).view(np.int64)), lists],
        ["a", "b", "bands"],
    )


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def overlaps(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the bags of each pair of texts; 1 for two without shingles."""
    out = np.zeros(len(left))
    for low in range(0, len(left), 256):
        sides = [_bag(column.slice(low, 256)) for column in (left, right)]
        text = np.concatenate([t for t, _ in sides])
        shingle = np.concatenate([s for _, s in sides])
        side = np.repeat([0, 1], [len(t) for t, _ in sides])
        by = np.lexsort((shingle, text))
        text, shingle, side = text[by], shingle[by], side[by]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            out[low : low + 256] = 1
            continue
        right_count = np.add.reduceat(side, first)
        left_count = np.diff(np.append(first, len(text))) - right_count
        n = min(256, len(left) - low)
        both = np.bincount(text[first], np.minimum(left_count, right_count), n)
        some = np.bincount(text[first], np.maximum(left_count, right_count), n)
        out[low : low + n] = np.where(some > 0, both / np.maximum(some, 1), 1)
    return out


def _bag(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts, found = [], []
    for first, _, data, offsets in arrays.pieces(column):
        starts, ends, sizes = arrays.words(data, offsets)
        text, shingle = shingles(arrays.span_hashes(data, starts, ends), sizes)
        texts.append(text + first)
        found.append(shingle)
    return np.concatenate(texts), np.concatenate(found)


def _likeness(left: Column, right: Column) -> Column:
    return F.arrow_udf(lambda a, b: pa.array(overlaps(a, b)), "double").asNondeterministic()(left, right)


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b) with the likeness of their texts."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ids = shared.stored(ids)
    needed = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    left = pairs.join(needed.withColumnsRenamed({"id": "a", "text": "__left"}), "a")
    both = left.join(needed.withColumnsRenamed({"id": "b", "text": "__right"}), "b")
    out = shared.stored(both.select("a", "b", _likeness(F.col("__left"), F.col("__right")).alias("likeness")))
    shared.forget(ids)
    return out


def _occurrences(column: pa.Array) -> pa.Array:
    """Each text's bag as a set: hashes of shingles with the number of their occurrence, sorted."""
    parts = []
    for low in range(0, len(column), 256):
        own = column.slice(low, 256)
        text, shingle = _bag(own)
        by = np.lexsort((shingle, text))
        text, shingle = text[by], shingle[by]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
        at = np.arange(len(text))
        number = at - np.maximum.accumulate(np.where(new, at, 0))
        named = np.where(number > 0, arrays.mix(shingle + arrays.mix(number.astype(np.uint64))), shingle)
        cut = np.searchsorted(text, np.arange(len(own) + 1)).astype(np.int32)
        parts.append(pa.ListArray.from_arrays(pa.array(cut), pa.array(named.view(np.int64))))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))


def _bridges(table: pa.Table, similarity: float) -> pa.Table:
    """(a, b): links between different parts of a block's members, enough to connect what they connect."""
    member = table["member"].to_numpy()
    bags_ = table["bag"].combine_chunks()
    size = bags_.value_lengths().to_numpy(zero_copy_only=False).astype(np.float32)
    row = np.repeat(np.arange(len(member)), size.astype(np.int64))
    _, shingle, count = np.unique(bags_.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shingle = shingle.ravel()
    common = count[shingle] > 1
    row, shingle = row[common], np.unique(shingle[common], return_inverse=True)[1].ravel()
    overlap = np.zeros((len(member), len(member)), np.float32)
    by = np.argsort(shingle, kind="stable")
    row, shingle = row[by], shingle[by]
    for low in range(0, int(shingle.max(initial=-1)) + 1, 4096):
        first, end = np.searchsorted(shingle, [low, low + 4096])
        holds = np.zeros((len(member), 4096), np.float32)
        holds[row[first:end], shingle[first:end] - low] = 1
        overlap += holds @ holds.T
    union = size[:, None] + size[None, :] - overlap
    _, part = np.unique(table["part"].to_numpy(), return_inverse=True)
    part = part.ravel()
    linked = (overlap >= similarity * union - 1e-4) & (part[:, None] < part[None, :])
    root = list(range(len(member)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        a, b = find(int(part[i])), find(int(part[j]))
        if a != b and overlap[i, j] / union[i, j] >= similarity - 1e-6:
            root[a] = b
            found.append((int(member[i]), int(member[j])))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _group_links(placed: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links across parts inside large buckets (bucket, member, part); stored."""
    counts = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    core = counts.groupBy("bucket").agg(F.max_by("part", F.struct("n", "part")).alias("core"))
    grouped = shared.stored(placed.join(shared.stored(core), "bucket").select("core", "member", "part").distinct())
    ids = shared.stored(grouped.select(F.col("member").alias("id")).distinct())
    needed = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    bag = F.arrow_udf(_occurrences, "array<long>").asNondeterministic()
    held = shared.stored(needed.select(F.col("id").alias("member"), bag("text").alias("bag")))

    straggler = F.col("part") != F.col("core")
    weighed = grouped.join(held.select("member", (8 * F.size("bag")).alias("bytes")), "member")

    def blocks(texts: Column, size: Column) -> Column:
        return F.greatest(F.ceil(texts / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("long")

    sizes = weighed.groupBy("core").agg(
        blocks(F.count(F.lit(1)), F.sum("bytes")).alias("columns"),
        blocks(F.count_if(straggler), F.sum(F.when(straggler, F.col("bytes")).otherwise(0))).alias("rows"),
    )
    dealt = grouped.join(shared.stored(sizes), "core")
    at = F.xxhash64("member")

    def all_of(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(number) - 1))

    # Stragglers stand in one row of blocks, all members in one column; a task compares a row's with a column's.
    down = dealt.withColumn("j", F.pmod(at, "columns")).withColumn("i", all_of("rows"))
    across = dealt.filter(straggler).withColumn("i", F.pmod(at, "rows")).withColumn("j", all_of("columns"))
    tasks = down.unionByName(across).select("core", "i", "j", "member", "part").distinct().join(held, "member")
    found = tasks.groupBy("core", "i", "j").applyInArrow(lambda table: _bridges(table, similarity), "a long, b long")
    found = shared.stored(found)
    shared.forget(ids, held, grouped)
    return found


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """All rows and columns of docs, and class_id."""
    sign = F.arrow_udf(_sign, "a long, b long, bands array<long>").asNondeterministic()
    signed = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("digest"), sign(F.col(text)).alias("s"))
    signed = shared.stored(signed.select("id", "digest", "s.*"))
    copies = signed.filter("id IS NOT NULL").groupBy("a", "b").agg(F.min("id").alias("class"), F.first("bands").alias("bands"))
    copies = shared.stored(copies)

    members = copies.select(F.explode("bands").alias("bucket"), F.col("class").alias("member"))
    buckets = members.groupBy("bucket").agg(F.min("member").alias("first"), F.max("member").alias("last"))
    buckets = shared.stored(buckets.filter("first < last").select("bucket", "first"))
    members = shared.stored(members.join(buckets, "bucket"))

    # Of rows with one id, the one whose text has the least digest speaks for the id.
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL")
    if _repeated(signed):
        speakers = signed.filter("id IS NOT NULL").groupBy("id").agg(F.min("digest").alias("digest"))
        texts = texts.withColumn("digest", F.xxhash64("text")).join(speakers, ["id", "digest"], "left_semi")
        texts = texts.drop("digest").dropDuplicates(["id"])

    starts = members.filter("first <> member").select(F.col("first").alias("a"), F.col("member").alias("b"))
    tried = _compared(shared.stored(starts.distinct()), texts)
    links = tried.filter(F.col("likeness") >= similarity).select("a", "b")
    parts = shared.stored(graphs.components(links))

    # Members of one bucket in different components, where their distances to its first leave a link possible.
    part = F.coalesce("component", "member").alias("part")
    away = F.when(F.col("first") == F.col("member"), 0.0).otherwise(1 - F.col("likeness")).alias("away")
    placed = members.join(tried.withColumnsRenamed({"a": "first", "b": "member"}), ["first", "member"], "left")
    placed = placed.join(parts.withColumnRenamed("node", "member"), "member", "left").select("bucket", "member", part, away)
    mixed = placed.groupBy("bucket").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x < y")
    placed = shared.stored(placed.join(shared.stored(mixed.select("bucket")), "bucket", "left_semi"))
    sizes = shared.stored(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    placed = placed.join(sizes, "bucket")
    small = placed.filter(F.col("n") <= SMALL_BUCKET)
    other = small.select("bucket", F.col("member").alias("b"), F.col("part").alias("part_b"), F.col("away").alias("away_b"))
    near = F.abs(F.col("away") - F.col("away_b")) <= 1 - similarity + 1e-9
    first = (F.col("away") == 0) | (F.col("away_b") == 0)  # compared already
    pairs = small.withColumnRenamed("member", "a").join(other, "bucket").filter((F.col("part") < F.col("part_b")) & near & ~first)
    more = _compared(shared.stored(pairs.select("a", "b").distinct()), texts)
    bridges = more.filter(F.col("likeness") >= similarity).select("a", "b")
    wide = placed.filter(F.col("n") > SMALL_BUCKET).select("bucket", "member", "part")
    bridges = bridges.unionByName(_group_links(wide, texts, similarity))
    parts = shared.stored(graphs.components(links.unionByName(bridges)))
    shared.forget(members, buckets, tried, more, sizes)

    classed = copies.select("a", "b", "class").join(parts.withColumnRenamed("node", "class"), "class", "left")
    classed = classed.select("a", "b", F.coalesce("component", "class").alias("class_id"))
    of = signed.select("id", "digest", "a", "b").distinct().join(shared.stored(classed), ["a", "b"], "left")
    of = of.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), "class_id")
    keyed = docs.select(*shared.names(docs, "class_id"), F.col(key).cast("long").alias("__of"), F.xxhash64(text).alias("__of_digest"))
    same = F.col("__of").eqNullSafe(F.col("__id")) & (F.col("__of_digest") == F.col("__digest"))
    return keyed.join(of, same, "left").select(*shared.names(docs, "class_id"), "class_id")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row of each class: that of the least id. Rows without class stay."""
    classed = classes(docs, text, key, **options)
    own = F.col(key).cast("long")
    kept = classed.filter(F.col("class_id").isNull() | (F.col("class_id") == own)).drop("class_id")
    if not _repeated(docs.select(own.alias("id"))):
        return kept
    named = kept.filter(F.col(key).isNotNull()).dropDuplicates([key])
    return named.unionByName(kept.filter(F.col(key).isNull()))


def _repeated(ids: DataFrame) -> bool:
    """Whether an id occurs twice."""
    return not ids.filter("id IS NOT NULL").groupBy("id").count().filter("count > 1").isEmpty()
