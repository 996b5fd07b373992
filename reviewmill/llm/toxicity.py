"""Toxicity by a convolutional text classifier trained in numpy (operator 3).

A word is the sum of three hashed embeddings: of the whole word, and of its first four and six bytes, so that
inflected forms share what their stem has learnt. Filters of widths one to three run over a text's words, each
keeps its maximum over the text, and a logistic layer weighs the maxima. Words are maximal runs of letters and
digits of the text in lower case; embeddings start at zero, so an unseen word says nothing.

The fit uses every labelled text, whole. Up to ``fit_docs`` texts of each label, of ``fit_chars`` characters on average and ten times
that at most, are fitted on the driver. With more, it fits a sample of that size, by a hash of the id, as a start, and Spark goes on
from there with all texts: in each of ``ROUNDS`` rounds parts of the texts step from one and the same model, and the models are
averaged, so the driver only has the model, whose size is fixed. A fifth of the texts is held back to place the decision: the score is
shifted so that 0.5 separates best over all languages, and thresholds per language are set where a language has enough of both labels.
Labels, language, source and id are no inputs of the score. Scoring is one pass of Arrow batches over whole texts, in bounded
pieces, without a shuffle.

Null and empty texts have no words and get the score of the bias alone; null ones are no fit rows. Equal texts get equal scores. Without
labelled rows of both kinds every score is the prior of 0. Null labels and labels other than 0 and 1 are no fit rows; a document with
several labels counts as toxic if one says so. Other columns are kept whatever their names are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays, shared

FIT_DOCS = 3000
FIT_CHARS = 20_000
#: Rounds over all labelled texts, where these are more than the driver fits.
ROUNDS = 3
#: Texts of a part of a round, where fewer than PARTS are needed for them all.
PART_TEXTS = 6000
PARTS = 32
#: Up to so many ids and labels are sent to every executor (some 250 MB); with more, all texts are shuffled to join them.
SENT_LABELS = 8_000_000
#: Embeddings of a slice, in which they are averaged.
SLICE = 1 << 16
#: Steps of a score, of 1, in which held-back texts of a round are counted.
GRID = 1024
BUCKETS = 1 << 20
SIZE = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
STEMS = (4, 6)
EPOCHS = 12
#: Words and stems in fewer fitted texts aren't learnt.
LEAST_TEXTS = 3
#: Labelled texts of each kind that a language needs for a threshold of its own.
LEAST_BY_LANGUAGE = 20

#: What ends a word: all ASCII that is no letter or digit.
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Model:
    embeddings: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)


@dataclass
class State:
    """What the steps keep beside the model: sums of squared gradients, and how much a text of either label weighs."""

    squares: np.ndarray
    dense: list[np.ndarray]
    bias: float
    factor: dict[int, float]


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids by word, the word and its stems; words of each text)."""
    starts, ends, sizes = arrays.words(np.where(_BETWEEN[data], np.uint8(0x20), data), offsets)
    ids = [arrays.span_hashes(data, starts, np.minimum(ends, starts + stem)) for stem in STEMS]
    ids.insert(0, arrays.span_hashes(data, starts, ends))
    salted = [arrays.mix(x + np.uint64(i)) & np.uint64(BUCKETS - 1) for i, x in enumerate(ids)]
    return np.stack(salted, 1).astype(np.int32), sizes


def _pooled(model: Model, ids: np.ndarray, sizes: np.ndarray, places: bool = False):
    """Maxima over each text of every filter, and where they are (if asked for) with the embedded words."""
    n, embedded = len(ids), np.zeros((len(ids), SIZE), np.float32)
    for i in range(ids.shape[1]):
        embedded += model.embeddings[ids[:, i]]
    ends = np.cumsum(sizes)
    starts, full = ends - sizes, np.flatnonzero(sizes)
    pooled = np.zeros((len(sizes), len(WIDTHS) * FILTERS), np.float32)
    where = np.zeros(pooled.shape, np.int64)
    for k, width in enumerate(WIDTHS):
        z = embedded @ model.filters[k][0]
        for j in range(1, width):
            part = embedded @ model.filters[k][j]
            for back in range(j):  # windows that pass a text's end see nothing there
                at = starts[full] + back
                part[at[at < ends[full]]] = 0
            z[: n - j] += part[j:]
        z += model.biases[k]
        if len(full):
            pooled[full, k * FILTERS : (k + 1) * FILTERS] = np.maximum.reduceat(z, starts[full], axis=0)
        if places:
            for d in full:
                where[d, k * FILTERS : (k + 1) * FILTERS] = starts[d] + z[starts[d] : ends[d]].argmax(0)
    np.maximum(pooled, 0, out=pooled)
    return (pooled, where, embedded) if places else pooled


def logits(model: Model, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return _pooled(model, ids, sizes) @ model.weights + model.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _batch(texts: list[tuple[np.ndarray, int]], rng: np.random.Generator | None) -> tuple[np.ndarray, np.ndarray]:
    parts = [ids[rng.random(len(ids)) > 0.3] if rng else ids for ids, _ in texts]
    return np.concatenate(parts), np.array([len(p) for p in parts])


def _started(positive: int, negative: int) -> tuple[Model, State, np.random.Generator]:
    """A model that knows nothing, the steps' state with the weights of the labels, and the generator that has drawn them."""
    rng = np.random.default_rng(0)
    model = Model(
        np.zeros((BUCKETS, SIZE), np.float32),
        [rng.normal(0, 0.5, (width, SIZE, FILTERS)).astype(np.float32) for width in WIDTHS],
        [np.full(FILTERS, 0.05, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.5, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
    )
    dense = [np.full(x.shape, 1e-2, np.float32) for x in (*model.filters, *model.biases, model.weights)]
    return model, State(np.full((BUCKETS, SIZE), 1e-6, np.float32), dense, 1e-2, _factor(positive, negative)), rng


def _factor(positive: int, negative: int) -> dict[int, float]:
    return {1: 0.5 * (positive + negative) / positive, 0: 0.5 * (positive + negative) / negative}


def step(
    model: Model,
    state: State,
    learnt: np.ndarray,
    chosen: list[tuple[np.ndarray, int]],
    rng: np.random.Generator,
    rate: float = 0.1,
    decay: float = 1e-4,
) -> np.ndarray:
    """One adaptive gradient step over a small batch of (word ids, label) pairs, in place; the embeddings it moved.

    learnt: which embeddings may move.
    """
    ids, sizes = _batch(chosen, rng)
    if not len(ids):
        return np.zeros(0, np.int64)
    dense = [*model.filters, *model.biases, model.weights]
    pooled, where, embedded = _pooled(model, ids, sizes, places=True)
    p = _sigmoid(pooled @ model.weights + model.bias)
    delta = np.array([(q - y) * state.factor[y] for q, (_, y) in zip(p, chosen, strict=True)], np.float32)
    delta /= len(chosen)
    live = delta[:, None] * model.weights * (pooled > 0)
    ends = np.cumsum(sizes)
    grads: list[np.ndarray] = []
    touched, steps = [], []
    for k, width in enumerate(WIDTHS):
        part = slice(k * FILTERS, (k + 1) * FILTERS)
        grad = np.zeros_like(model.filters[k])
        for j in range(width):
            at = where[:, part] + j
            g = live[:, part] * (at < ends[:, None])
            at = np.minimum(at, len(ids) - 1)
            grad[j] = np.einsum("df,dfe->ef", g, embedded[at])
            touched.append(at.ravel())
            steps.append((g[:, :, None] * model.filters[k][j].T[None]).reshape(-1, SIZE))
        grads.append(grad)
    grads += [live[:, k * FILTERS : (k + 1) * FILTERS].sum(0) for k in range(len(WIDTHS))]
    grads.append(pooled.T @ delta)
    at, moved = np.concatenate(touched), np.concatenate(steps)
    rows, inverse = np.unique(ids[at].ravel(), return_inverse=True)
    total = np.zeros((len(rows), SIZE), np.float32)
    np.add.at(total, inverse.ravel(), np.repeat(moved, ids.shape[1], 0))
    total = (total + decay * model.embeddings[rows]) * learnt[rows][:, None]
    state.squares[rows] += total**2
    model.embeddings[rows] -= rate * total / np.sqrt(state.squares[rows])
    for x, grad, square in zip(dense, grads, state.dense, strict=True):
        grad = grad + decay * x
        square += grad**2
        x -= rate * grad / np.sqrt(square)
    total_bias = float(delta.sum())
    state.bias += total_bias**2
    model.bias -= rate * total_bias / state.bias**0.5
    return rows[learnt[rows]]


def fit(texts: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, learnt: np.ndarray | None = None) -> tuple[Model, State]:
    """A model of (word ids, label) pairs, by adaptive gradient steps over small batches, and the steps' state.

    learnt: which embeddings may move, those in LEAST_TEXTS of the texts if not given.
    """
    positive = sum(y for _, y in texts)
    model, state, rng = _started(positive, len(texts) - positive)
    if learnt is None:
        learnt = np.bincount(np.concatenate([np.unique(ids) for ids, _ in texts]), minlength=BUCKETS) >= LEAST_TEXTS
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), 32):
            step(model, state, learnt, [texts[i] for i in order[low : low + 32]], rng)
    return model, state


def best_threshold(scores: np.ndarray, hits: np.ndarray, misses: np.ndarray) -> float:
    """The middle of the gap between scores that gives the best F1; the gap nearest 0 among equals.

    hits, misses: how many texts of either label have each score.
    """
    order = np.argsort(-scores, kind="stable")
    scores, hits, misses = scores[order], hits[order].astype(np.int64), misses[order].astype(np.int64)
    found = np.cumsum(hits)
    f1 = 2 * found / (np.cumsum(hits + misses) + hits.sum())
    gap = np.append(scores[:-1] > scores[1:], True)
    below = np.append(scores[1:], scores[-1] - 2)
    middle = (scores + below) / 2
    f1 = np.where(gap, f1, -1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    return float(middle[best[np.argmin(np.abs(middle[best]))]])


def fit_rows(docs: DataFrame, labels: DataFrame, text: str, lang: str, learn: Column) -> DataFrame:
    """Every labelled text: at (a hash of its id), label, text, lang."""
    known = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("label").alias("label"))
    if known.count() <= SENT_LABELS:  # then only texts with a label are shuffled
        known = F.broadcast(known)
    rows = docs.select("doc_id", F.lower(F.col(text)).alias("text"), F.col(lang).alias("lang")).filter("text is not null")
    rows = rows.join(known, "doc_id").withColumn("at", F.xxhash64("doc_id"))
    # Repeated rows of a document count once.
    once = rows.groupBy("doc_id", "at", "label").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
    return once.select("at", "label", "text", "lang")


def _pairs(texts: pa.ChunkedArray, label: list[int]) -> Iterator[list[tuple[np.ndarray, int]]]:
    """(word ids, label) pairs in bounded pieces."""
    for first, end, data, offsets in arrays.pieces(texts, 1 << 20):
        ids, sizes = word_ids(data, offsets)
        yield list(zip(np.split(ids, np.cumsum(sizes)[:-1]), label[first:end], strict=True))


def _texts(batch: pa.RecordBatch) -> Iterator[list[tuple[np.ndarray, int]]]:
    yield from _pairs(batch.column("text"), batch.column("label").to_pylist())


def _frequent(texts: DataFrame) -> np.ndarray:
    """Which embeddings are of words and stems in LEAST_TEXTS texts or more."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece in _texts(batch):
                for ids, _ in piece:
                    seen[np.unique(ids)] += 1
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["at", "n"])

    found = texts.mapInArrow(counted, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    learnt = np.zeros(BUCKETS, bool)
    learnt[found.filter(F.col("n") >= LEAST_TEXTS).select("at").toArrow()["at"].to_numpy()] = True
    return learnt


_MOVED = "slice int, part int, at binary, vectors binary, squares binary"


def _round(texts: DataFrame, model: Model, state: State, learnt: np.ndarray, number: int) -> None:
    """One round over all texts: each part steps from the same model, and the results are averaged, in place.

    An embedding is averaged over the parts that moved it, all else over all parts. Embeddings are averaged by Spark in slices of
    the table, so that the driver gets each of them once, however many parts there are.
    """
    context = texts.sparkSession.sparkContext
    known = np.flatnonzero(learnt)
    sent = context.broadcast((np.packbits(learnt), model.embeddings[known], state.squares[known], replace(model, embeddings=None), replace(state, squares=None)))

    def stepped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, vectors, squares, own, kept = sent.value
        part = TaskContext.get().partitionId()
        allowed = np.unpackbits(packed).astype(bool)
        at = np.flatnonzero(allowed)
        own, kept = pickle.loads(pickle.dumps((own, kept)))  # the broadcast value stays as it is
        own.embeddings, kept.squares = np.zeros((BUCKETS, SIZE), np.float32), np.full((BUCKETS, SIZE), 1e-6, np.float32)
        own.embeddings[at], kept.squares[at] = vectors, squares
        rng, moved, n = np.random.default_rng([number, part]), np.zeros(BUCKETS, bool), 0
        for given in (piece for batch in batches for piece in _texts(batch)):
            order = rng.permutation(len(given))
            for low in range(0, len(order), 32):
                moved[step(own, kept, allowed, [given[i] for i in order[low : low + 32]], rng)] = True
                n += 1
        if not n:
            return
        dense = pickle.dumps((own.filters, own.biases, own.weights, own.bias, kept.dense, kept.bias))
        rows = [(-1, part, b"", dense, b"")]
        at = np.flatnonzero(moved)
        for slice_ in np.unique(at // SLICE).tolist():
            own_at = at[at // SLICE == slice_]
            rows.append((slice_, part, own_at.astype(np.int32).tobytes(), half(own.embeddings[own_at]), half(np.sqrt(kept.squares[own_at]))))
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = ["slice", "part", "at", "vectors", "squares"]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    def half(x: np.ndarray) -> bytes:
        return x.astype(np.float16).tobytes()  # the precision of the finished model

    def averaged(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        if table["slice"][0].as_py() == -1:
            each = [pickle.loads(x) for x in table["vectors"].to_pylist()]
            mean = [np.mean(x, 0) for x in zip(*[[*f, *b, w, c, *d, e] for f, b, w, c, d, e in each])]
            one = pa.array([pickle.dumps(mean)], pa.binary())
            return pa.table([table["slice"].slice(0, 1), table["part"].slice(0, 1), pa.array([b""], pa.binary()), one, pa.array([b""], pa.binary())], table.schema)
        low = table["slice"][0].as_py() * SLICE
        n, sums = np.zeros(SLICE, np.int64), np.zeros((2, SLICE, SIZE))
        for at, vectors, squares in zip(*[table[c].to_pylist() for c in ("at", "vectors", "squares")]):
            at = np.frombuffer(at, np.int32) - low
            n[at] += 1
            sums[0][at] += np.frombuffer(vectors, np.float16).reshape(-1, SIZE)
            sums[1][at] += np.frombuffer(squares, np.float16).reshape(-1, SIZE).astype(np.float64) ** 2
        at = np.flatnonzero(n)
        means = (sums[:, at] / n[at][None, :, None]).astype(np.float32)
        row = [(at + low).astype(np.int32).tobytes(), means[0].tobytes(), means[1].tobytes()]
        return pa.table([table["slice"].slice(0, 1), table["part"].slice(0, 1), *[pa.array([x], pa.binary()) for x in row]], table.schema)

    results = texts.mapInArrow(stepped, _MOVED)
    for slice_, _, at, vectors, squares in results.groupBy("slice").applyInArrow(averaged, _MOVED).collect():
        if slice_ == -1:
            mean, k = pickle.loads(vectors), len(WIDTHS)
            model.filters, model.biases, model.weights = mean[:k], mean[k : 2 * k], mean[2 * k]
            model.bias, state.dense, state.bias = float(mean[2 * k + 1]), mean[2 * k + 2 : -1], float(mean[-1])
        else:
            rows = np.frombuffer(at, np.int32)
            model.embeddings[rows] = np.frombuffer(vectors, np.float32).reshape(-1, SIZE)
            state.squares[rows] = np.frombuffer(squares, np.float32).reshape(-1, SIZE)
    sent.destroy()


def _place(texts: DataFrame, model: Model) -> None:
    """Shift the model so that 0.5 separates the held-back texts best, and set thresholds by language.

    Scores are counted in steps of 1 / GRID, so the driver gets counts, however many texts there are.
    """
    context = texts.sparkSession.sparkContext
    known = np.flatnonzero(np.any(model.embeddings, axis=1))
    sent = context.broadcast((known, model.embeddings[known], replace(model, embeddings=None)))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, vectors, bare = sent.value
        own = replace(bare, embeddings=np.zeros((BUCKETS, SIZE), np.float32))
        own.embeddings[at] = vectors
        for batch in batches:
            parts = [logits(own, *_batch(given[i : i + 64], None)) for given in _texts(batch) for i in range(0, len(given), 64)]
            bins = np.rint(np.clip(np.concatenate(parts), -60, 60) * GRID).astype(np.int32) if parts else np.zeros(0, np.int32)
            yield pa.record_batch([pa.array(bins), batch.column("label"), batch.column("lang")], ["bin", "label", "lang"])

    bins = texts.select("text", "label", "lang").mapInArrow(scored, "bin int, label int, lang string")
    counts = bins.groupBy("lang", "bin").agg(F.sum("label").alias("hits"), F.sum(1 - F.col("label")).alias("misses"))
    found = counts.toArrow().to_pandas()
    sent.destroy()
    whole = found.groupby("bin")[["hits", "misses"]].sum()
    shift = best_threshold(whole.index.to_numpy() / GRID, whole["hits"].to_numpy(), whole["misses"].to_numpy())
    model.bias -= shift
    for one, own in sorted(found[found["lang"].notna() & (found["lang"] != "")].groupby("lang")):
        if min(own["hits"].sum(), own["misses"].sum()) >= LEAST_BY_LANGUAGE:
            place = best_threshold(own["bin"].to_numpy() / GRID - shift, own["hits"].to_numpy(), own["misses"].to_numpy())
            model.thresholds[one] = float(_sigmoid(np.float64(place)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    lang: str = "lang",
    learn: Column | None = None,
    fit_docs: int = FIT_DOCS,
    fit_chars: int = FIT_CHARS,
) -> Model | None:
    """Fit on all labelled rows; learn: which ids may be learnt from. None without both labels."""
    rows, folder = shared.placed(fit_rows(docs, labels, text, lang, F.lit(True) if learn is None else learn), "zstd")
    try:
        chars = F.char_length("text")
        found = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(chars).alias("chars"), F.max(chars).alias("most")).collect()
        if len(found) < 2:
            return None
        few = max(r["n"] for r in found) <= fit_docs and max(r["most"] for r in found) <= 10 * fit_chars
        if few and sum(r["chars"] for r in found) <= fit_docs * fit_chars:
            model = _fit_here(rows)
        else:
            model = _fit_in_rounds(rows, sum(r["n"] for r in found), fit_docs, fit_chars)
    finally:
        shared.erase(docs.sparkSession, folder)
    model.embeddings = model.embeddings.astype(np.float16)
    return model


def _collected(rows: DataFrame) -> tuple[pa.Table, list[tuple[np.ndarray, int]]]:
    """The rows in a fixed order, and their (word ids, label) pairs."""
    table = rows.toArrow().sort_by([("at", "ascending"), ("text", "ascending")])
    return table, [pair for piece in _pairs(table["text"], table["label"].to_pylist()) for pair in piece]


def _fit_here(rows: DataFrame) -> Model:
    """A model of few enough rows of both labels."""
    table, texts = _collected(rows)
    label, language = table["label"].to_numpy(), table["lang"].to_pylist()
    held = np.zeros(len(texts), bool)
    for y in (0, 1):  # every fifth of either label
        held[np.flatnonzero(label == y)[::5]] = True
    fitted = [t for t, h in zip(texts, held, strict=True) if not h]
    model, _ = fit(fitted if len({y for _, y in fitted}) > 1 else texts)
    used = [t for t, h in zip(texts, held, strict=True) if h]
    scores = np.concatenate([logits(model, *_batch(used[i : i + 64], None)) for i in range(0, len(used), 64)])
    truth, spoken = label[held], np.array([x or "" for x in np.array(language, object)[held]])
    shift = best_threshold(scores, truth == 1, truth == 0)
    model.bias -= shift
    for one in sorted(set(spoken.tolist()) - {""}):
        own = spoken == one
        if min((truth[own] == y).sum() for y in (0, 1)) >= LEAST_BY_LANGUAGE:
            model.thresholds[one] = float(_sigmoid(np.float64(best_threshold(scores[own] - shift, truth[own] == 1, truth[own] == 0))))
    return model


def _fit_in_rounds(rows: DataFrame, n: int, fit_docs: int, fit_chars: int) -> Model:
    """A model of all rows, however many: a sample's model first, which rounds over all of them go on from."""
    held = F.pmod("at", F.lit(5)) == 0
    counts = {(r["label"], r["held"]): r["count"] for r in rows.groupBy("label", held.alias("held")).count().collect()}
    split = all(counts.get((y, h)) for y in (0, 1) for h in (True, False))  # else too few of a label to hold any back
    fitted, placing = (rows.filter(~held), rows.filter(held)) if split else (rows, rows)
    sizes = [counts.get((y, False), 0) + (0 if split else counts.get((y, True), 0)) for y in (0, 1)]
    parts = min(PARTS, max(1, -(-n // PART_TEXTS)))
    texts = fitted.select("text", "label").coalesce(parts)
    learnt = _frequent(texts)
    short = fitted.filter(F.char_length("text") <= fit_chars)
    # Hashes alone are ranked, as one task gets those that all tasks pick.
    picked = [short.filter(F.col("label") == y).select("at").orderBy("at").limit(fit_docs) for y in (0, 1)]
    _, sample = _collected(short.join(F.broadcast(picked[0].unionByName(picked[1])), "at", "left_semi"))
    model, state = fit(sample, learnt=learnt) if len({y for _, y in sample}) > 1 else _started(sizes[1], sizes[0])[:2]
    state.factor = _factor(sizes[1], sizes[0])
    for number in range(ROUNDS):
        _round(texts, model, state, learnt, number)
    _place(placing, model)
    return model


def score(text: Column, model: Model | None) -> Column:
    """The score of a text column, 0 to 1."""
    if model is None:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        parts = [logits(model, *word_ids(data, offsets)) for _, _, data, offsets in arrays.pieces(column, 1 << 20)]
        return pa.array(_sigmoid(np.concatenate(parts).astype(np.float64)) if parts else np.zeros(0))

    return scored.asNondeterministic()(F.lower(text))


def classify(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang") -> DataFrame:
    """All rows and columns of docs, with score, predicted (score >= 0.5), the language's threshold and flagged."""
    own = F.lit(0.5)
    for one, threshold in (model.thresholds if model else {}).items():
        own = F.when(F.col(lang) == one, threshold).otherwise(own)
    columns = [f"`{c.replace('`', '``')}`" for c in docs.columns if c not in ("score", "predicted", "threshold", "flagged")]
    scored = docs.select(*columns, score(F.col(text), model).alias("score"))
    return scored.select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted"), own.alias("threshold")
    ).withColumn("flagged", (F.col("score") >= F.col("threshold")).cast("int"))
