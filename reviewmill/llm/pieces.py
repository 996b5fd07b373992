"""SentencePiece encoding and decoding with N-best segmentation (operator 5).

A text with a leading space is a lattice of the model's pieces; the best path has the largest sum of piece scores. A
character that is no piece is spelled with byte pieces, at a penalty below the lowest score. Pieces hold spaces at
their beginning only, and some bytes (line breaks) are in no piece, so the lattice falls into units that
no piece crosses: a run of spaces with what follows it. Texts are taken in pieces of a bounded number of bytes; a piece's different
units are solved by a forward Viterbi pass over all units of one length at a time in numpy, which also gives the second-best
score. A worker keeps solutions from piece to piece, up to a bounded number of bytes.

N-best paths of a text can differ from the best only in the n - 1 units whose second-best path costs least. Their lattices
are chained, and backward A-star search runs over the chain: forward Viterbi scores are exact heuristics, so
the agenda yields complete paths in order of score. Equal scores come in order of discovery.

Decoding is exact for every text: spaces are mapped to the pieces' space sign only inside the model, so the sign
itself, when a text holds it, is spelled in bytes. The model is a parameter, read by the driver as a table of pieces
and scores that tasks get with their code. Nothing is shuffled.

Null and empty texts have no pieces, a score of 0 and one (empty) segmentation. Texts with fewer than n paths have as
many as there are. Equal texts have equal results. Other columns stay whatever their names are.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.llm import arrays, shared

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
#: Units up to so many bytes are solved together, longer ones one by one.
WIDE = 40
PIECE_BYTES = 2 << 20
#: Solutions of units that a worker keeps from piece to piece, and lattices of units it keeps for the search, in bytes.
KEPT_BYTES, LATTICE_BYTES = 64 << 20, 16 << 20
#: Bytes of a kept entry besides its ids, and of a lattice for each byte of its unit, about.
_ENTRY_BYTES, _EDGE_BYTES = 280, 1200

_SPACE = "▁"
_NONE = -np.inf

KIND = (
    "ids array<int>, scores array<double>, "
    "edits array<struct<nth:int,first:int,count:int,ids:array<int>>>"
)


@dataclass(frozen=True)
class Model:
    """pieces and scores by id; specials and byte pieces have no text of their own."""

    pieces: tuple[bytes | None, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]


@cache
def load(path: str = MODEL) -> Model:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=str(Path(path)))
    ids = range(model.get_piece_size())
    bytes_of = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    return Model(
        tuple(None if special[i] else model.id_to_piece(i).replace(_SPACE, " ").encode() for i in ids),
        tuple(model.get_score(i) for i in ids),
        tuple(bytes_of[f"<0x{b:02X}>"] for b in range(256)),
    )


class Lattice:
    """Tables of a model, made once in each Python worker."""

    def __init__(self, model: Model):
        self.model = model
        self.known = {p: i for i, p in reversed(list(enumerate(model.pieces))) if p}
        self.longest = max(map(len, self.known))
        self.penalty = min(model.scores[i] for i in self.known.values() if model.scores[i] > -1e8) - 10
        in_pieces = np.zeros(256, bool)
        in_pieces[np.frombuffer(b"".join(self.known), np.uint8)] = True
        self.alone = ~in_pieces & (np.arange(256) < 128)
        # A trie as sorted (state, byte) keys; each edge leads to a state, a state may end a piece.
        states, self.ends = {b"": 0}, [-1]
        edges = {}
        for piece, i in self.known.items():
            for k in range(1, len(piece) + 1):
                if piece[:k] not in states:
                    states[piece[:k]] = len(self.ends)
                    self.ends.append(-1)
                    edges[states[piece[: k - 1]] << 8 | piece[k - 1]] = states[piece[:k]]
            self.ends[states[piece]] = i
        self.ends = np.array(self.ends + [-1])
        keys = sorted(edges)
        self.keys, self.next = np.array([*keys, -1], np.int64), np.array([*(edges[k] for k in keys), -1], np.int64)
        self.first = np.full(256, -1, np.int64)
        for k in keys:
            if k < 256:
                self.first[k] = edges[k]
        self.scores = np.array([*model.scores, _NONE])
        self._solved: dict[bytes, tuple] = {}
        self._lattice_bytes = 0
        self._kept: dict[int, tuple[float, float, bytes]] = {}
        self._kept_bytes = 0

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next states, -1 where no piece goes on."""
        key = np.where(state < 0, -2, state << 8 | byte)
        at = np.minimum(np.searchsorted(self.keys[:-1], key), len(self.keys) - 2)
        return np.where(self.keys[at] == key, self.next[at], -1)

    def solve(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(best score, second best, pieces of each unit, ids) of units of one length, a row of bytes each."""
        rows, length = units.shape
        best = np.full((length + 1, rows), _NONE)
        second = np.full((length + 1, rows), _NONE)
        back = np.zeros((length + 1, rows), np.int64)
        piece = np.full((length + 1, rows), -1, np.int64)
        best[0] = 0
        data = units.T.astype(np.int64)
        sizes = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        for start in range(length):
            live = np.flatnonzero(best[start] > _NONE)
            if not len(live):
                continue
            state, alone, own_size = self.first[data[start, live]], np.ones(len(live), bool), sizes[start, live]
            for size in range(1, min(self.longest, length - start) + 1):
                if size > 1:
                    state = self.step(state, data[start + size - 1, live])
                going = state >= 0
                ends = np.where(going, self.ends[state], -1)
                done = np.flatnonzero(ends >= 0)
                if len(done):
                    at, i = live[done], ends[done]
                    alone[done[own_size[done] == size]] = False
                    self._relax(best, second, back, piece, start, size, at, i, self.scores[i])
                spelled = np.flatnonzero(alone & (own_size == size))
                if len(spelled):
                    at = live[spelled]
                    self._relax(best, second, back, piece, start, size, at, np.full(len(at), -1), self.penalty)
                keep = going | (alone & (own_size > size))
                if not keep.all():
                    live, state, alone, own_size = live[keep], state[keep], alone[keep], own_size[keep]
                if not len(live):
                    break
        # Paths from the back.
        counts, found = np.zeros(rows, np.int64), []
        at, live = np.full(rows, length), np.arange(rows)
        while len(live):
            size, i = back[at[live], live], piece[at[live], live]
            begin = at[live] - size
            spelled = i < 0
            found.append((live[~spelled], i[~spelled], counts[live[~spelled]]))
            counts[live[~spelled]] += 1
            for k in range(4):
                more = spelled & (size > k)
                if more.any():
                    byte = units[live[more], (begin + size - 1 - k)[more]]
                    found.append((live[more], self._bytes[byte], counts[live[more]]))
                    counts[live[more]] += 1
            at[live] = begin
            live = live[begin > 0]
        unit, ids, nth = (np.concatenate(x) for x in zip(*found, strict=True))
        out = np.empty(len(ids), np.int32)
        out[(np.cumsum(counts) - 1)[unit] - nth] = ids
        return best[length], second[length], counts, out

    def solutions(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> list[tuple[float, float, bytes]]:
        """(best score, second best, ids as bytes) of different units, from those kept where they are known."""
        keys = hashes.tolist()
        out = [self._kept.get(key) for key in keys]
        missing = np.array([i for i, known in enumerate(out) if known is None], np.int64)
        for size in np.unique(sizes[missing]):
            same = missing[sizes[missing] == size]
            step = max(1, (4 << 20) // (int(size) + 1) // 32) if size <= WIDE else 1
            for low in range(0, len(same), step):
                part = same[low : low + step]
                best, second, counts, ids = self.solve(data[starts[part][:, None] + np.arange(size)])
                ends, flat = (4 * np.cumsum(counts)).tolist(), ids.astype(np.int32).tobytes()
                for i, b, s, begin, end in zip(part.tolist(), best.tolist(), second.tolist(), [0, *ends], ends, strict=False):
                    out[i] = self._kept[keys[i]] = (b, s, flat[begin:end])
                    self._kept_bytes += _ENTRY_BYTES + end - begin
        if self._kept_bytes > KEPT_BYTES:
            self._kept.clear()
            self._kept_bytes = 0
        return out

    @property
    def _bytes(self) -> np.ndarray:
        return np.array(self.model.byte_ids)

    @staticmethod
    def _relax(best, second, back, piece, start, size, at, ids, score) -> None:
        end = start + size
        one, two, old = best[start, at] + score, second[start, at] + score, best[end, at]
        better = one > old
        second[end, at] = np.maximum(np.minimum(one, old), np.maximum(two, second[end, at]))
        best[end, at[better]] = one[better]
        back[end, at[better]] = size
        piece[end, at[better]] = ids[better]

    def edges(self, unit: bytes) -> list[list[tuple[int, float, int]]]:
        """For each position of a unit, (start, score, id or -1) of the edges that end there."""
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(len(unit) + 1)]
        start = 0
        while start < len(unit):
            first = unit[start]
            own = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            state, spelled = 0, True
            for size in range(1, min(self.longest, len(unit) - start) + 1):
                state = self._next.get(state << 8 | unit[start + size - 1], -1)
                if state < 0:
                    break
                if self.ends[state] >= 0:
                    i = int(self.ends[state])
                    into[start + size].append((start, self.model.scores[i], i))
                    spelled &= size != own
            if spelled:
                into[start + own].append((start, self.penalty, -1))
            start += own
        return into

    @property
    def _next(self) -> dict[int, int]:
        if not hasattr(self, "_edges"):
            self._edges = dict(zip(self.keys[:-1].tolist(), self.next[:-1].tolist(), strict=True))
        return self._edges

    def forward(self, into: list[list[tuple[int, float, int]]]) -> list[float]:
        """The best score from the start to each position."""
        best = [0.0] + [_NONE] * (len(into) - 1)
        for end in range(1, len(into)):
            for start, score, _ in into[end]:
                if best[start] + score > best[end]:
                    best[end] = best[start] + score
        return best

    def solved(self, unit: bytes) -> tuple[list[list[tuple[int, float, int]]], list[float]]:
        """Edges and forward scores, kept for the units met last."""
        if unit not in self._solved:
            self._lattice_bytes += _EDGE_BYTES * len(unit)
            if self._lattice_bytes > LATTICE_BYTES:
                self._solved.clear()
                self._lattice_bytes = _EDGE_BYTES * len(unit)
            into = self.edges(unit)
            self._solved[unit] = into, self.forward(into)
        return self._solved[unit]

    def n_best(self, units: list[bytes], n: int) -> list[tuple[float, list[list[int]]]]:
        """(score, ids of each unit) of the n best paths through a chain of units, best first."""
        chain, ahead = zip(*map(self.solved, units), strict=True)
        before = [0.0]
        for scores in ahead:
            before.append(before[-1] + scores[-1])
        # States stand at a position of a unit, with the score and edges of the path from there to the end.
        number, found = 0, []
        agenda = [(-before[-1], 0, len(units) - 1, len(units[-1]) if units else 0, 0.0, None)]
        while agenda and len(found) < n:
            _, _, unit, at, behind, path = heapq.heappop(agenda)
            while at == 0 and unit > 0:
                unit, at = unit - 1, len(units[unit - 1])
            if at == 0:
                ids: list[list[int]] = [[] for _ in units]
                while path:
                    (u, start, end, i), path = path
                    ids[u] += [i] if i >= 0 else [self.model.byte_ids[b] for b in units[u][start:end]]
                found.append((behind, ids))
                continue
            for start, score, i in chain[unit][at]:
                if ahead[unit][start] > _NONE:
                    number += 1
                    rank = before[unit] + ahead[unit][start] + behind + score
                    heapq.heappush(agenda, (-rank, number, unit, start, behind + score, ((unit, start, at, i), path)))
        return found


_lattices: dict[int, Lattice] = {}


def lattice(model: Model) -> Lattice:
    key = hash(model.pieces)
    if key not in _lattices:
        _lattices[key] = Lattice(model)
    return _lattices[key]


def _units(data: np.ndarray, offsets: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Where units begin."""
    space = data == 0x20
    begins = np.zeros(len(data) + 1, bool)
    begins[:-1] |= space
    begins[1:-1] &= ~(space[1:] & space[:-1])
    single = alone[data]
    begins[:-1] |= single
    begins[1:] |= single
    begins[offsets] = True
    begins[-1] = False
    return np.flatnonzero(begins)


def _encode(own: Lattice, data: np.ndarray, offsets: np.ndarray, n: int) -> pa.Array:
    sizes = np.diff(offsets)
    # A space goes before every text that isn't empty.
    full = sizes > 0
    at = offsets + np.append(0, np.cumsum(full))
    spaced = np.full(at[-1], 0x20, np.uint8)
    spaced[np.repeat(at[:-1] + full - offsets[:-1], sizes) + np.arange(len(data))] = data
    starts = _units(spaced, at, own.alone)
    ends = np.append(starts[1:], len(spaced))[: len(starts)]
    hashes = arrays.span_hashes(spaced, starts, ends)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    which = which.ravel()

    solved = own.solutions(spaced, starts[first], (ends - starts)[first], hashes[first])
    best, second = (np.array([x[k] for x in solved]) for k in (0, 1))
    counts = np.array([len(x[2]) // 4 for x in solved], np.int64)
    flat = np.frombuffer(b"".join([x[2] for x in solved]), np.int32)
    place = np.cumsum(counts) - counts

    made = counts[which]
    begin = np.cumsum(made) - made
    ids = flat[np.repeat(place[which] - begin, made) + np.arange(int(made.sum()))]
    text = np.searchsorted(at, starts, "right") - 1
    at_unit = np.searchsorted(starts, at)
    total = np.append(0, np.cumsum(made))[at_unit]
    score = np.bincount(text, best[which], len(sizes))

    # Units whose second-best path costs least, n - 1 of each text.
    cost = (best - second)[which]
    able = np.flatnonzero(np.isfinite(cost)) if n > 1 else np.zeros(0, np.int64)
    by = able[np.lexsort((able, cost[able], text[able]))]
    rank = np.arange(len(by)) - np.searchsorted(text[by], text[by])
    by = np.sort(by[rank < n - 1])
    cut = np.searchsorted(text[by], np.arange(len(sizes) + 1))
    scores, score_ends = [], [0]
    numbers: list[int] = []  # of edits: nth, first, count
    new_ids: list[int] = []
    new_ends, edit_ends = [0], [0]
    for t in range(len(sizes)):
        chosen = by[cut[t] : cut[t + 1]]
        if not len(chosen):
            scores.append(score[t])
        else:
            found = own.n_best([spaced[starts[u] : ends[u]].tobytes() for u in chosen], n)
            scores += [score[t] + (s - found[0][0]) for s, _ in found]
            for nth, (_, path) in enumerate(found[1:], 1):
                for u, new in zip(chosen, path, strict=True):
                    old = ids[begin[u] : begin[u] + made[u]]
                    if len(old) != len(new) or (old != new).any():
                        numbers += [nth, int(begin[u] - total[t]), int(made[u])]
                        new_ids += new
                        new_ends.append(len(new_ids))
        score_ends.append(len(scores))
        edit_ends.append(len(new_ends) - 1)
    edits = [pa.array(x) for x in np.array(numbers, np.int32).reshape(-1, 3).T]
    edits.append(pa.ListArray.from_arrays(pa.array(new_ends, pa.int32()), pa.array(new_ids, pa.int32())))
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), pa.array(ids.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(score_ends, pa.int32()), pa.array(scores, pa.float64())),
            pa.ListArray.from_arrays(
                pa.array(edit_ends, pa.int32()), pa.StructArray.from_arrays(edits, ["nth", "first", "count", "ids"])
            ),
        ],
        ["ids", "scores", "edits"],
    )


def paths(ids: list[int], count: int, edits: list) -> list[list[int]]:
    """The ids of all segmentations, from the best and the edits of the others."""
    out = [list(ids) for _ in range(count)]
    for e in sorted(edits, key=lambda e: -e["first"]):
        out[e["nth"]][e["first"] : e["first"] + e["count"]] = e["ids"]
    return out


def decode(ids: Column, model: Model) -> Column:
    """The text of a column of ids; ids that stand for no text, and unknown ones, give none."""

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        return pa.array(decode_lists(column, model), pa.string())

    return decoded.asNondeterministic()(ids)


@cache
def _spelled(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of every id's text, and of one more id for those out of range."""
    texts = [p or b"" for p in model.pieces] + [b""]
    for b, i in enumerate(model.byte_ids):
        texts[i] = bytes([b])
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))


def decode_lists(column: pa.Array, model: Model) -> list[str]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = _spelled(model)
    out: list[str] = []
    for low in range(0, len(column), 1024):
        part = column.slice(low, 1024).fill_null([])
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = np.where((flat >= 0) & (flat < len(offsets) - 2), flat, len(offsets) - 2)
        size = np.diff(offsets)[flat]
        end = np.append(0, np.cumsum(size))
        spelled = data[np.repeat(offsets[flat] - end[:-1], size) + np.arange(end[-1])].tobytes()
        cut = end[np.append(0, np.cumsum(part.value_lengths().to_numpy(zero_copy_only=False)))]
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            text = spelled[a:b]
            out.append((text[1:] if text[:1] == b" " else text).decode("utf-8", "replace"))
    return out


def encode(
    docs: DataFrame, text: str = "text", model: Model | None = None, n: int = N_BEST, digest: str | None = None
) -> DataFrame:
    """All rows and columns of docs, and ids, scores and edits: the best ids, the scores of the n best paths, and how they differ.

    An edit replaces ``count`` ids from ``first`` on in the nth path (0 is the best). Rows leave a task piece by piece.
    digest: name of a column with the SHA-256 of the text that the ids decode to, read back in the same pass.
    """
    model = model or load()
    added = ("ids", "scores", "edits", *([digest] if digest else []))
    kept = [c for c in docs.columns if c not in added]
    given = docs.select(*map(shared.quoted, kept))
    at = kept.index(text) if text in kept else len(kept)
    if at == len(kept):
        given = docs.select(*map(shared.quoted, kept), F.col(shared.quoted(text)).alias(shared.unused(given, "text")[0]))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model)
        for batch in batches:
            for first, end, data, offsets in arrays.pieces(batch.column(at), PIECE_BYTES):
                rows = [batch.column(k).slice(first, end - first) for k in range(len(kept))]
                made = _encode(own, data, offsets, n).flatten()
                if digest:
                    made.append(pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decode_lists(made[0], model)], pa.string()))
                yield pa.record_batch([*rows, *made], [*kept, *added])

    kind = T.StructType([*given.schema.fields[: len(kept)], *T.StructType.fromDDL(KIND).fields])
    if digest:
        kind.add(digest, "string")
    return given.mapInArrow(encoded, kind)
