"""Quality rules on repetition: a word-level suffix array of each text (operator 4).

Each task takes texts in bounded pieces and builds one suffix array over the words of a piece by prefix
doubling, where a suffix ends with its own text. Ranks are refined only where suffixes still tie, so the
rounds shrink with what repeats. The names kept from each round give every pair of neighbours its longest
common prefix, and a suffix's larger neighbouring prefix is the longest repeat that begins there: the depth of
the innermost LCP interval around it. Spans of maximal repeats are joined and measured.

Nothing is shuffled, and no statistic crosses texts. Null and empty texts have no words and fail the base
rule. Repeated rows are judged alike. Other columns are kept whatever their names are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays

#: A repeat counts from this many words on.
MIN_REPEAT = 10
#: A text is kept while repeats cover at most this share of its words. Published filters hold repeated runs of ten words to
#: about a tenth; the base rule's limit on runs of three never lets a share above a half through, so a limit must be well below.
MAX_COVERED = 0.1
#: And while the longest has at most this many words, which acts in texts of more than 4,000.
MAX_LONGEST = 200

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Fixed values of the base rule.
BASE_WORDS, BASE_WINDOW, BASE_PERCENT = 50, 3, 50

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long"
)


def refined_ranks(text_of: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of all texts' words, texts apart, and the names of each round.

    Round k names each position by its first 2 ** k words: equal names mean equal words in one text.
    ends: for each position, where its text ends.
    """
    n = len(ids)
    key = text_of * (int(ids.max(initial=0)) + 1) + ids
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    names, width = [rank.copy()], 1
    size = np.repeat(np.diff(np.append(starts, n)), np.diff(np.append(starts, n)))
    active = order[size > 1]
    while len(active):
        after = active + width
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        pair = rank[active] * (n + 1) + second
        by = np.argsort(pair, kind="stable")
        active, pair = active[by], pair[by]
        old = rank[active]
        new = np.ones(len(active), bool)
        new[1:] = pair[1:] != pair[:-1]
        block = np.ones(len(active), bool)
        block[1:] = old[1:] != old[:-1]
        at = np.arange(len(active))
        first = np.maximum.accumulate(np.where(block, at, 0))
        place = old + at - first
        order[place] = active
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank[active] = place[head]
        names.append(rank.copy())
        size = np.diff(np.append(np.flatnonzero(new), len(active)))
        active = active[np.repeat(size, size) > 1]
        width *= 2
    return order, names


def longest_repeats(text_of: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run of words from it on that its text holds twice or more."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    order, names = refined_ranks(text_of, ids, ends)
    left, right = order[:-1], order[1:]
    common = np.zeros(n + 1, np.int64)  # common[j]: between the neighbours j - 1 and j
    live = np.flatnonzero(names[0][left] == names[0][right])
    left, right, depth = left[live], right[live], np.zeros(len(live), np.int64)
    for k in range(len(names) - 1, -1, -1):
        a, b = left + depth, right + depth
        inside = (a < ends[left]) & (b < ends[right])
        same = inside & (names[k][np.minimum(a, n - 1)] == names[k][np.minimum(b, n - 1)])
        depth += same.astype(np.int64) << k
    common[live + 1] = depth
    out = np.empty(n, np.int64)
    out[order] = np.maximum(common[:-1], common[1:])
    return out


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least this many words."""
    starts = np.flatnonzero(longest >= least)
    reach = np.zeros(len(longest), np.int64)
    reach[starts] = starts + longest[starts]
    return np.arange(len(longest)) < np.maximum.accumulate(reach)


def _piece(data: np.ndarray, offsets: np.ndarray, min_repeat: int) -> list[np.ndarray]:
    starts, ends, sizes = arrays.words(data, offsets)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    points = arrays.code_points(data)
    hashes = arrays.span_hashes(data, starts, ends)
    ids = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
    longest = longest_repeats(text_of, ids, sizes)

    # A repeat never passes its text's end, so spans may be joined over the whole piece.
    most = np.zeros(len(sizes), np.int64)
    full = sizes > 0
    if len(longest):
        most[full] = np.maximum.reduceat(longest, (np.cumsum(sizes) - sizes)[full])

    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(symbol[data], out=symbols[1:])

    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_text = np.searchsorted(offsets, line_start, "right") - 1
    line_hash = arrays.span_hashes(data, line_start, line_end)
    by = np.lexsort((line_hash, line_text))
    again = np.zeros(len(by), bool)
    again[1:] = (line_hash[by[1:]] == line_hash[by[:-1]]) & (line_text[by[1:]] == line_text[by[:-1]])
    dup_lines = np.bincount(line_text[by][again], minlength=len(sizes))

    return [
        sizes,
        arrays.per_text(points[ends] - points[starts], sizes),
        symbols[offsets[1:]] - symbols[offsets[:-1]],
        dup_lines,
        arrays.per_text(covered(longest, BASE_WINDOW), sizes),
        arrays.per_text(covered(longest, min_repeat), sizes),
        most,
    ]


def measures(text: Column, min_repeat: int = MIN_REPEAT) -> Column:
    """The struct MEASURES of a text column."""

    @F.arrow_udf(MEASURES)
    def measure(column: pa.Array) -> pa.Array:
        parts = [_piece(data, offsets, min_repeat) for _, _, data, offsets in arrays.pieces(column)]
        names = [x.split()[0] for x in MEASURES.split(", ")]
        flat = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(len(names))]
        return pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in flat], names)

    return measure.asNondeterministic()(text)


def judge(
    docs: DataFrame,
    text: str = "text",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    into: str = "repetition",
) -> DataFrame:
    """All rows and columns of docs and a struct ``into``: MEASURES, base_failed and kept."""
    m = F.col("__m")
    base = (m["n_words"] < BASE_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])
    good = (m["covered_words"] <= F.lit(max_covered) * m["n_words"]) & (m["longest_repeat"] <= max_longest)
    fields = [m[x.split()[0]].alias(x.split()[0]) for x in MEASURES.split(", ")]
    columns = [f"`{c.replace('`', '``')}`" for c in docs.columns if c != into]
    return docs.select(*columns, measures(F.col(text), min_repeat).alias("__m")).select(
        *columns, F.struct(*fields, base.alias("base_failed"), (~base & good).alias("kept")).alias(into)
    )


def keep(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of docs that the rules keep, with their columns."""
    judged = judge(docs, text, into="__repetition", **limits)
    return judged.filter("__repetition.kept").drop("__repetition")
