"""Chat formatting by columnar byte assembly, and its reader (operator 9).

A conversation becomes one text: for each turn ``<|im_start|>``, the role, a line break, the content,
``<|im_end|>`` and a line break. Inside roles and contents every ``<|`` is broken up by a backslash (one more is
added where backslashes stand between the two already), so that no text can hold a control string; the change
is undone by taking one backslash away. Roles also have backslashes and line breaks escaped, since a line break
ends them.

Spark deals conversations to tasks by id and sorts their rows. A task streams the sorted batches: lengths of
all segments give cumulative offsets, and headers and contents are scattered into one preallocated buffer that
becomes the Arrow column. Only a conversation that isn't complete yet is held over to the next batch.

Null texts and roles are empty. Rows of one turn number are ordered by role and text, repeated rows stay.
Rows with a null id form one conversation, null turns come first. No rows give no conversations. Only the four
named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays

START, END = "<|im_start|>", "<|im_end|>"


def escape(texts: pa.Array) -> pa.Array:
    """Break up every ``<|``; reversible."""
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\\\1|")


def unescape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<\\(\\*)\|", r"<\1|")


def escape_role(roles: pa.Array) -> pa.Array:
    return escape(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: str) -> str:
    role = unescape(pa.array([role]))[0].as_py()
    out, parts = [], iter(role)
    for c in parts:
        out.append(c if c != "\\" else {"n": "\n"}.get(x := next(parts, ""), x))
    return "".join(out)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and offsets from 0 of a text column."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy piece i of data to out[at[i]:]."""
    sizes = np.diff(offsets)
    out[np.repeat(at - offsets[:-1], sizes) + np.arange(len(data))] = data


def _spread(out: np.ndarray, at: np.ndarray, fixed: bytes) -> None:
    """Copy the same bytes to every place."""
    out[at[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)


def assemble(rows: pa.Table, first: np.ndarray, loss_role: str) -> pa.RecordBatch:
    """One formatted row for each conversation; first: the index of each one's first row."""
    turns = len(rows)
    roles, texts = (pc.fill_null(rows[c].combine_chunks(), "") for c in ("role", "text"))
    learned = pc.equal(roles, loss_role).to_numpy(zero_copy_only=False)
    head, head_at = _bytes(escape_role(roles))
    body, body_at = _bytes(escape(texts))
    start, end = START.encode(), f"{END}\n".encode()

    role_size, body_size = np.diff(head_at), np.diff(body_at)
    size = len(start) + role_size + 1 + body_size + len(end)
    place = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    _spread(out, place, start)
    _scatter(out, place + len(start), head, head_at)
    _spread(out, place + len(start) + role_size, b"\n")
    body_place = place + len(start) + role_size + 1
    _scatter(out, body_place, body, body_at)
    _spread(out, body_place + body_size, end)

    last = np.append(first[1:], turns)
    offsets = np.append(place, len(out))[np.append(first, turns)]
    points = arrays.code_points(out)
    conversation = np.repeat(np.arange(len(first)), last - first)
    begin = points[body_place] - points[offsets[conversation]]
    finish = points[body_place + body_size] - points[offsets[conversation]]
    spans_at = np.append(0, np.cumsum(learned))[np.append(first, turns)]
    spans = pa.StructArray.from_arrays([pa.array(begin[learned]), pa.array(finish[learned])], ["begin", "finish"])
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out))
    return pa.RecordBatch.from_arrays(
        [
            rows["conv_id"].combine_chunks().take(pa.array(first)),
            pa.array(last - first),
            formatted.cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(spans_at, pa.int32()), spans),
        ],
        ["conv_id", "n_turns", "formatted", "loss_spans"],
    )


def _conversations(batches: Iterator[pa.RecordBatch], loss_role: str) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for low in range(0, len(batch), 2048):
            table = pa.Table.from_batches([batch.slice(low, 2048)])
            if held and pc.all(pc.fill_null(_same(table["conv_id"], held[-1]["conv_id"][-1]), False)).as_py():
                held.append(table)
                continue
            rows = pa.concat_tables([*held, table])
            first = _firsts(rows["conv_id"].combine_chunks())
            if len(first) > 1:
                yield assemble(rows.slice(0, first[-1]), first[:-1], loss_role)
            held = [rows.slice(first[-1])]
    if held:
        yield assemble(pa.concat_tables(held), np.zeros(1, np.int64), loss_role)


def _same(ids: pa.ChunkedArray, one: pa.Scalar) -> pa.ChunkedArray:
    return pc.equal(ids, one) if one.is_valid else pc.is_null(ids)


def _firsts(ids: pa.Array) -> np.ndarray:
    """Where a new id begins in sorted ids, nulls first."""
    changed = pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False).astype(bool)
    null = pc.is_null(ids).to_numpy(zero_copy_only=False)
    return np.append(0, np.flatnonzero(changed | (null[1:] != null[:-1])) + 1)


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans: code-point spans of the contents of ``loss_role``.

    rows: conv_id, turn, role, text; more columns are left out.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return (
        dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(
            lambda batches: _conversations(batches, loss_role),
            f"conv_id {kind}, n_turns long, formatted string, loss_spans array<struct<begin:long,finish:long>>",
        )
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, content = part.removesuffix(f"{END}\n").partition("\n")
        turns.append((unescape_role(role), content))
    contents = unescape(pa.array([c for _, c in turns], pa.string())).to_pylist()
    return [(role, content) for (role, _), content in zip(turns, contents, strict=True)]


def _digests(formatted: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, masked in zip(formatted.to_pylist(), spans.to_pylist(), strict=True):
        turns = hashlib.sha256("".join(f"{role}\n{content}\n" for role, content in parse(text)).encode())
        pieces = unescape(pa.array([text[s["begin"] : s["finish"]] for s in masked], pa.string())).to_pylist()
        loss = "".join(pieces)
        out.append((turns.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
    columns = list(zip(*out, strict=True)) or [()] * 4
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss mask, read from the formatted text alone."""
    digests = F.arrow_udf(
        lambda text, spans: _digests(text, spans),
        "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    ).asNondeterministic()
    read = formatted.select("conv_id", "n_turns", digests("formatted", "loss_spans").alias("d"))
    return read.select("conv_id", "n_turns", "d.*")
