"""Phrase collocations from depth-truncated suffix subtrees under a vertical partitioning (operator 12).

Texts are lower-cased (A-Z), split at punctuation and line breaks into pieces, and these at blanks into words. Every word
begins a suffix of up to five words within its piece. The suffix tree of a language, cut at that depth, is partitioned
vertically: a prefix of one word with more occurrences than the memory budget is extended by another word, and so on, one pass over the
texts for each depth that still has such prefixes. All other prefixes are grouped, as bins of a hash, with a mean load of half the budget,
so a group holds a bounded number of occurrences; each group's subtrees are built independently of the others.

1. Words are counted by language (combined per block before the shuffle).
2. Prefixes beyond the budget are counted exactly and extended. They are known in every task by 64-bit hashes; a prefix that
   shares its hash is extended, too, and counted with them. There are at most occurrences / budget of them at each depth, and the budget is
   never less than 1 / MOST_EXTENDED of the corpus.
3. A block of text turns its suffixes into distinct rows of word numbers with counts, and sends each group those of its prefixes, as
   compressed byte planes. The COMMON most frequent words have numbers that all tasks know; other words travel with the
   rows. Equal suffixes were combined before the shuffle, so a phrase with a third of all words costs one row a block.
4. A group orders its suffixes; leaves are equal suffixes, and the total of the leaves below a node is the frequency of its phrase. Nodes
   with ``min_count`` or more are the result.
5. Candidates meet the frequencies of their parts in joins by language and phrase, and are scored with whole numbers of up to 38
   digits. A candidate inside a longer one that is as frequent needs to be looked for only in those one word longer: what is inside an even
   longer one is inside one of these with at least its frequency.

A null language is ``und``. Null and empty texts have no words. Rows with one id are rows of their own: ids aren't read. Memory follows
``BLOCK_BYTES`` of text or, where a longer text has no end of a piece, that piece; a text is cut at ends of pieces only.
Other columns are ignored. An empty table gives no rows. Ties end in the order of the phrases' UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmill.llm import arrays, shared

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
#: A candidate goes if a longer one has this share of its occurrences, in percent.
COVERED_PERCENT = 100
#: Occurrences that a prefix may have without being extended.
BUDGET = 1 << 20
MOST_EXTENDED = 1 << 17
#: Words whose numbers all tasks know.
COMMON = 1 << 16
BLOCK_BYTES = 2 << 20

# What ends a piece, and what separates words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_STEP = np.uint64(0x9FB21C651E98DF25)

LANG = "lang"


@dataclass(frozen=True)
class Plan:
    """What every task knows: the common words, and for each depth the hashes of the extended prefixes."""

    common: pa.Array
    extended: tuple[np.ndarray, ...] = ()
    groups: int = 1


@dataclass
class Block:
    """The words of some texts of one language, as numbers into a dictionary, and how many may follow each."""

    words: pa.Array  # distinct words
    hashes: np.ndarray  # of these, with the language
    ids: np.ndarray
    room: np.ndarray  # words from here to the end of the piece

    def columns(self, at: np.ndarray, depth: int) -> list[np.ndarray]:
        """Numbers of the words at some places and after them, -1 beyond the end."""
        padded = np.append(self.ids, np.full(depth, -1, np.int32))
        return [np.where(j < self.room[at], padded[at + j], np.int32(-1)) for j in range(depth)]

    def prefix_hashes(self, at: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        """Hashes of the first 1 to ``depth`` words at some places; what is beyond an end means nothing."""
        padded = np.append(self.hashes[self.ids], np.zeros(depth, np.uint64))
        h = np.zeros(len(at), np.uint64)
        for j in range(depth):
            h = arrays.mix(h * _STEP + padded[at + j])
            yield h


def _stretches(data: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts, a very long one in parts that end where a piece does."""
    if len(data) <= 2 * most:
        yield data, offsets
        return
    cuts = np.flatnonzero(_KIND[data] == 2) + 1
    low = 0
    while low < len(data):
        k = int(np.searchsorted(cuts, low + most, "right")) - 1
        k = k if k >= 0 and cuts[k] > low else k + 1
        high = int(cuts[k]) if k < len(cuts) else len(data)
        yield data[low:high], np.array([0, high - low])
        low = high


def _block(data: np.ndarray, offsets: np.ndarray, lang_hash: np.uint64) -> Block:
    kind = _KIND[data]
    inner = kind == 0
    cut, before, here = (np.zeros(len(data) + 1, bool) for _ in range(3))
    cut[offsets] = True
    before[1:] = inner
    here[:-1] = inner
    starts = np.flatnonzero(here & (~before | cut))
    ends = np.flatnonzero(before & (~here | cut))
    run = np.searchsorted(np.flatnonzero(kind == 2), starts) + np.searchsorted(offsets, starts, "right")
    edges = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [len(run)]])
    room = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(run))
    places = np.append(0, np.cumsum(ends - starts))
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(_LOWER[data[inner]])]
    )
    coded = flat.dictionary_encode()
    words = coded.dictionary
    at = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
    letters = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
    hashes = arrays.mix(arrays.span_hashes(letters, at[:-1], at[1:]) ^ lang_hash)
    return Block(words, hashes, coded.indices.to_numpy(), room)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Block]]:
    """(language, block) over (lang, text) batches."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        codes = langs.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        sorted_texts = batch.column(1).take(pa.array(order))
        borders = np.searchsorted(codes[order], np.arange(len(langs.dictionary) + 1))
        for lang, low, high in zip(langs.dictionary.to_pylist(), borders, borders[1:], strict=False):
            texts = sorted_texts.slice(low, high - low)
            name = np.frombuffer(lang.encode(), np.uint8)
            lang_hash = arrays.span_hashes(name, np.array([0]), np.array([len(name)]))[0]
            for _, _, data, offsets in arrays.pieces(texts, BLOCK_BYTES):
                for part in _stretches(data, offsets, BLOCK_BYTES):
                    block = _block(*part, lang_hash)
                    if len(block.ids):
                        yield lang, block


def _counted(lang: str, phrases: pa.Array, hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """COUNTED, in batches of bounded length."""
    for low in range(0, len(phrases), 1 << 16):
        part = slice(low, low + (1 << 16))
        text = phrases.slice(low, 1 << 16)
        columns = [pa.array([lang] * len(text), pa.string()), text, pa.array(hashes[part].view(np.int64)), pa.array(counts[part])]
        yield pa.record_batch(columns, ["lang", "phrase", "hash", "f"])


COUNTED = "lang string, phrase string, hash long, f long"


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """COUNTED for each distinct word of a block, and without a phrase for all its words."""
    for lang, block in _blocks(batches):
        counts = np.bincount(block.ids, minlength=len(block.words))
        yield from _counted(lang, _phrases(block.words, [np.arange(len(counts))]), arrays.mix(block.hashes), counts)
        yield from _counted(lang, pa.array([None], pa.string()), np.zeros(1, np.uint64), np.array([len(block.ids)]))


def _order(columns: list[np.ndarray], distinct: int) -> np.ndarray:
    """The places of the rows in lexicographic order. Entries are from -1 to distinct - 1."""
    base, per = distinct + 1, max(1, 63 // max(1, int(distinct + 1).bit_length()))
    keys = []
    for low in range(0, len(columns), per):
        key = np.zeros(len(columns[0]), np.int64)
        for c in columns[low : low + per]:
            key = key * base + (c + 1)
        keys.append(key)
    return np.lexsort(keys[::-1])


def _changes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """For each depth, where ordered rows begin a new prefix of it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    out = []
    for c in columns:
        new = new.copy()
        new[1:] |= c[1:] != c[:-1]
        out.append(new)
    return out


def _distinct(block: Block, at: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(a place, the words, occurrences) of each distinct suffix at some places, in order of the words."""
    columns = block.columns(at, depth)
    order = _order(columns, len(block.words))
    columns = [c[order] for c in columns]
    first = np.flatnonzero(_changes(columns)[-1])
    return at[order[first]], [c[first] for c in columns], np.diff(np.append(first, len(order)))


def _in(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are among known ones (sorted)."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    spot = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[spot] == hashes


def _phrases(words: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    taken = [words.take(pa.array(c)) for c in columns]
    joined = pc.binary_join_element_wise(*taken, pa.scalar(b" ", words.type))
    return joined.cast(pa.binary()).cast(pa.string())


def _prefix_counts(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """COUNTED for the prefixes one word longer than the extended ones."""
    depth = len(plan.extended) + 1
    for lang, block in _blocks(batches):
        at = np.flatnonzero(block.room >= depth)
        for k, known in enumerate(plan.extended):
            *_, h = block.prefix_hashes(at, k + 1)
            at = at[_in(h, known)]
        if len(at):
            at, columns, counts = _distinct(block, at, depth)
            *_, h = block.prefix_hashes(at, depth)
            yield from _counted(lang, _phrases(block.words, columns), h, counts)


def _planes(*columns: np.ndarray) -> bytes:
    """Numbers below 2 ** 32 as compressed planes of their bytes: high bytes are mostly alike."""
    raw = b"".join(np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns)
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unplaned(data: bytes, columns: int, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, columns * n * 4, codec="zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(columns, 4, n).transpose(0, 2, 1)).view("<u4").reshape(columns, n)


#: Planes of depth, count, and word numbers (0: none, then the common words, then those that come along) of n suffixes.
ROUTED = "lang string, bin long, words array<binary>, n long, planes binary"


def _routed(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """ROUTED for each block and group: the distinct suffixes of the group's prefixes. Depths tell each suffix's words in its prefix."""
    common = len(plan.common)
    for lang, block in _blocks(batches):
        at, columns, counts = _distinct(block, np.flatnonzero(block.room >= 2), MAX_WORDS)
        size = np.minimum(block.room[at], MAX_WORDS)
        depth, route = np.ones(len(at), np.int8), np.zeros(len(at), np.uint64)
        growing, whole = np.ones(len(at), bool), np.zeros(len(at), bool)
        for k, h in enumerate(block.prefix_hashes(at, MAX_WORDS), 1):
            depth[growing], route[growing] = k, h[growing]
            if k > len(plan.extended):
                break
            growing &= _in(h, plan.extended[k - 1])
            whole |= growing & (size == k)  # nothing but an extended prefix, which is counted
            growing &= size > k
        group = (route % np.uint64(plan.groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        order = order[~whole[order]]
        if not len(order):
            continue
        group, depth, counts = group[order], depth[order], counts[order]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        ends = np.append(first[1:], len(group))
        known = pc.fill_null(pc.index_in(block.words, value_set=plan.common), -1).to_numpy()
        number = np.append(known + 1, 0)  # the last for words beyond the end, which are -1
        matrix = np.stack([c[order] for c in columns])
        numbers = number[matrix]
        row, place = np.nonzero((numbers == 0) & (matrix >= 0))
        base = len(block.words)
        used, local = np.unique((np.searchsorted(first, place, "right") - 1) * base + matrix[row, place], return_inverse=True)
        word_ends = np.searchsorted(used, np.arange(len(first) + 1) * base)
        numbers[row, place] = common + 1 + local - np.repeat(word_ends[:-1], np.diff(word_ends))[local]
        words = block.words.take(pa.array(used % base)).cast(pa.binary())
        for low in range(0, len(first), 256):
            high = min(low + 256, len(first))
            some = word_ends[low : high + 1]
            lists = pa.ListArray.from_arrays(pa.array((some - some[0]).astype(np.int32)), words.slice(some[0], some[-1] - some[0]))
            planes = [_planes(depth[a:b], counts[a:b], *numbers[:, a:b]) for a, b in zip(first[low:high], ends[low:high], strict=True)]
            yield pa.record_batch(
                [
                    pa.array([lang] * (high - low), pa.string()),
                    pa.array(group[first[low:high]]),
                    lists,
                    pa.array(ends[low:high] - first[low:high]),
                    pa.array(planes, pa.binary()),
                ],
                ["lang", "bin", "words", "n", "planes"],
            )


def _subtrees(key: tuple, table: pa.Table, common: pa.Array, min_count: int) -> pa.Table:
    """(lang, phrase, f): the frequent nodes of one group's subtrees."""
    lists = table["words"].combine_chunks()
    coded = pa.concat_arrays([common.cast(pa.binary()), lists.flatten()]).dictionary_encode()
    codes = np.concatenate([[-1], coded.indices.to_numpy()]).astype(np.int32)  # by number, for words that come along after an offset
    words_at = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
    parts = []
    for data, n, at in zip(table["planes"], table["n"].to_pylist(), words_at, strict=False):
        part = _unplaned(data.as_py(), 2 + MAX_WORDS, n).astype(np.int64)
        numbers = part[2:]
        numbers[numbers > len(common)] += at
        part[2:] = codes[numbers]
        parts.append(part.astype(np.int32))
    whole = np.concatenate(parts, axis=1)
    parts.clear()
    order = _order(list(whole[2:]), len(coded.dictionary))
    depths, counts, *columns = (c[order] for c in whole)
    phrases, totals = [], []
    for k, new in enumerate(_changes(columns), 1):
        if k == 1:
            continue
        first = np.flatnonzero(new)
        total = np.add.reduceat(counts, first, dtype=np.int64)
        node = (total >= min_count) & (columns[k - 1][first] >= 0) & (depths[first] <= k)
        phrases.append(_phrases(coded.dictionary, [c[first[node]] for c in columns[:k]]))
        totals.append(total[node])
    phrase = pa.concat_arrays(phrases)
    return pa.table({"lang": pa.array([key[0].as_py()] * len(phrase), pa.string()), "phrase": phrase, "f": np.concatenate(totals)})


def _common(words: DataFrame) -> pa.Array:
    """The most frequent words, COMMON at most."""
    rows = words.orderBy(F.desc("f"), "lang", "phrase").limit(COMMON).select("phrase").collect()
    return pa.array(list(dict.fromkeys(r.phrase.encode() for r in rows)), pa.large_binary())


def _hashes(counts: DataFrame, budget: int) -> np.ndarray:
    """The hashes of prefixes beyond the budget, of which there are few by its definition."""
    found = [r[0] for r in counts.filter(F.col("f") > budget).select("hash").distinct().collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def frequencies(
    docs: DataFrame,
    text: str = "text",
    lang: str = LANG,
    min_count: int = MIN_COUNT,
    budget: int = BUDGET,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to MAX_WORDS words with f >= min_count, and (lang, n) of all words."""
    column, language = F.col(shared.quoted(text)), F.col(shared.quoted(lang))
    texts = docs.select(F.coalesce(language.cast("string"), F.lit("und")).alias("lang"), column.alias("text"))
    texts = texts.filter("text IS NOT NULL")
    words = texts.mapInArrow(_word_counts, COUNTED)
    words = words.groupBy("lang", "phrase").agg(F.min("hash").alias("hash"), F.sum("f").alias("f"))
    words = shared.stored(words.filter((F.col("f") >= min_count) | F.col("phrase").isNull()))
    sizes = words.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    words = words.filter(F.col("phrase").isNotNull())
    occurrences = sizes.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, min_count, -(-occurrences // MOST_EXTENDED))

    plan = Plan(_common(words), (), max(1, -(-2 * occurrences // budget)))
    found = words.select("lang", "phrase", "f")
    longer = _hashes(words, budget)
    while len(longer):
        plan = Plan(plan.common, (*plan.extended, longer), plan.groups)
        if len(plan.extended) == MAX_WORDS - 1:
            break
        counts = texts.mapInArrow(lambda b, plan=plan: _prefix_counts(b, plan), COUNTED)
        counts = counts.groupBy("lang", "phrase").agg(F.min("hash").alias("hash"), F.sum("f").alias("f"))
        counts = shared.stored(counts.filter(F.col("f") >= min_count))
        longer = _hashes(counts, budget)
        if len(longer):
            extended = counts.filter(F.col("f") > budget).select("hash").distinct()
            found = found.unionByName(counts.join(extended, "hash", "left_semi").select("lang", "phrase", "f"))

    routed = texts.mapInArrow(lambda b: _routed(b, plan), ROUTED)
    nodes = routed.groupBy("lang", "bin").applyInArrow(
        lambda key, table: _subtrees(key, table, plan.common, min_count), "lang string, phrase string, f long"
    )
    return shared.stored(found.unionByName(nodes)), sizes


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def _joined(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = LANG,
    min_count: int = MIN_COUNT,
    covered_percent: int = COVERED_PERCENT,
    budget: int = BUDGET,
) -> DataFrame:
    """All phrases of 2 to MAX_WORDS words that stay: lang, phrase, a, l, r, n, score (of the lowest-scoring cut)."""
    found, sizes = frequencies(docs, text, lang, min_count, budget)
    phrases = found.withColumn("words", F.split("phrase", " ")).withColumn("k", F.size("words")).filter("k >= 2")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), "k", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns(
        {"first": _joined(F.lit(1), F.col("cut")), "rest": _joined(F.col("cut") + 1, F.col("k") - F.col("cut"))}
    ).drop("words")
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(sizes, "lang")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (_exact("a") * _exact("n")).cast("decimal(34,0)"), _exact("l") * _exact("r"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))

    parts = F.array(_joined(F.lit(1), F.col("k") - 1), _joined(F.lit(2), F.col("k") - 1))
    longer = phrases.filter("k >= 3").select("lang", F.explode(parts).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    covered = F.lit(100).cast("decimal(3,0)") * _exact("longer") >= F.lit(covered_percent).cast("decimal(3,0)") * _exact("a")
    left = best.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    return left.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def top(found: DataFrame, limit: int = TOP) -> DataFrame:
    """Each language's first phrases with their rank: a group limit below the shuffle keeps a large language in bounds."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
