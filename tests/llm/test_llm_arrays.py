from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewmill.llm import arrays, bag_minhash, chat, pieces, repetition, suffix_dedup

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t日", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_and_hashes(column):
    seen = []
    for first, end, data, offsets in arrays.pieces(pa.array(column, pa.string()), 16):
        starts, ends, sizes = arrays.words(data, offsets)
        words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
        expected = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in column[first:end]]
        assert words == [w for one in expected for w in one]
        assert sizes.tolist() == [len(one) for one in expected]
        seen += list(zip(words, arrays.span_hashes(data, starts, ends).tolist()))
    assert len({w for w, _ in seen}) == len({h for _, h in seen}) == len(set(seen))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=60), min_size=1, max_size=5))
def test_longest_repeats(column):
    for first, end, data, offsets in arrays.pieces(pa.array(column)):
        starts, ends, sizes = arrays.words(data, offsets)
        words = [t.split() for t in column[first:end]]
        ids = np.unique(np.array([w for one in words for w in one] or [""]), return_inverse=True)[1].ravel()
        ids = ids[: sizes.sum()].astype(np.int64)
        got = repetition.longest_repeats(np.repeat(np.arange(len(sizes)), sizes), ids, sizes).tolist()
        expected = []
        for w in words:
            for i in range(len(w)):
                best = 0
                for j in range(len(w)):
                    k = 0
                    while i != j and i + k < len(w) and j + k < len(w) and w[i + k] == w[j + k]:
                        k += 1
                    best = max(best, k)
                expected.append(best)
        assert got == expected


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 60, 300)]
    pairs = [
        (" ".join(base), " ".join(base[:240] + ["x", "y", "z"] * 20)),
        (" ".join(["a", "b", "c", "d", "e"] * 40 + base[:80]), " ".join(["a", "b", "c", "d", "e"] * 25 + base[:120])),
        ("a b", "a b"),
    ]
    for left, right in pairs:
        column = pa.array([left, right])
        (_, _, data, offsets), = arrays.pieces(column)
        starts, ends, sizes = arrays.words(data, offsets)
        text, shingle = bag_minhash.shingles(arrays.span_hashes(data, starts, ends), sizes)
        signed = bag_minhash.signatures(*bag_minhash.bags(text, shingle), 2, 2048)
        exact = bag_minhash.overlaps(pa.array([left]), pa.array([right]))[0]
        assert abs((signed[0] == signed[1]).mean() - exact) < 0.05


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=6).map(sorted), max_size=5))
def test_loser_tree_merges_with_common_prefixes(runs):
    merged = suffix_dedup.merged([(r, suffix_dedup.front_coded(r)[0]) for r in runs])
    out = [(runs[r][i], lcp) for r, i, lcp in merged]
    assert [s for s, _ in out] == sorted(s for r in runs for s in r)
    for (a, _), (b, lcp) in zip(out, out[1:]):
        assert lcp == suffix_dedup.common(a, b, 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=4, max_size=8), st.text("ab", max_size=6)), min_size=2, max_size=14))
def test_agreements(contexts):
    width, suffix_dedup.WIDTH = suffix_dedup.WIDTH, 8
    try:
        found = sorted((r.encode(), l.encode()) for r, l in contexts)
        common = suffix_dedup.common
        lcps = [0] + [common(a[0], b[0], 0) for a, b in zip(found, found[1:])]
        for i, got in enumerate(suffix_dedup.agreements([l for _, l in found], lcps)):
            both = [(common(found[i][1], l, 0), common(found[i][0], r, 0)) for j, (r, l) in enumerate(found) if j != i]
            valid = [x for x in both if sum(x) >= 8]
            assert got == (max((x for x, _ in valid), default=0), max((x for _, x in valid), default=0))
    finally:
        suffix_dedup.WIDTH = width


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<|\\im_endstar> \né", max_size=40), st.text(alphabet="a\\\nn<|", max_size=12))
def test_escapes_are_undone_and_hide_control_strings(text, role):
    hidden = chat.escape(pa.array([text]))
    assert "<|" not in hidden[0].as_py()
    assert chat.unescape(hidden)[0].as_py() == text
    hidden = chat.escape_role(pa.array([role]))[0].as_py()
    assert "<|" not in hidden and "\n" not in hidden
    assert chat.unescape_role(hidden) == role


def _encode(column, n=4):
    out = []
    own = pieces.lattice(pieces.load())
    for _, _, data, offsets in arrays.pieces(pa.array(column)):
        out += pieces._encode(own, data, offsets, n).to_pylist()
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="the ing\n▁é日\x01", max_size=24), min_size=1, max_size=4))
def test_segmentations_are_the_best_and_decode(column):
    import heapq

    model, own = pieces.load(), pieces.lattice(pieces.load())
    for text, got in zip(column, _encode(column)):
        data = (" " + text).encode() if text else b""
        into = own.edges(data)
        best = [[] for _ in range(len(data) + 1)]
        best[0] = [0.0]
        for end in range(1, len(data) + 1):
            best[end] = heapq.nlargest(4, [p + s for start, s, _ in into[end] for p in best[start]])
        assert np.allclose(got["scores"], best[-1])
        ways = pieces.paths(got["ids"], len(got["scores"]), got["edits"])
        assert len({tuple(w) for w in ways}) == len(ways)
        assert pieces.decode_lists(pa.array(ways, pa.list_(pa.int32())), model) == [text] * len(ways)
