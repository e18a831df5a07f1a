"""Chat formatting by columnar byte assembly.

A conversation becomes one text: a header, the turn's text and a footer for each turn. Per batch
of rows the lengths of all segments give their offsets by one cumulative sum; headers, roles and
texts are then copied into one preallocated buffer through scatter indices, and Arrow takes that
buffer as its column without another copy. No Python code runs per row.

Control strings inside roles and texts are broken by a backslash after their first character,
and a backslash is doubled, so nothing in a text can end its turn and the original comes back
by dropping one backslash of each pair and each one before another character.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import buffers, typed

# The template, and the control strings of common templates that a text may not hold.
TURN, BODY, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"
CONTROL = r"(<|\[)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|unk>|<SYS>>|</SYS>>|INST\]|/INST\])"
TURNS = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.|<(?!\|im_end\|>))*)<\|im_end\|>\n", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: Bytes that are assembled at a time.
STEP_BYTES = 4 << 20

FORMATTED = "formatted string, loss_starts array<bigint>, loss_ends array<bigint>"


def escaped(column: pa.Array) -> pa.Array:
    doubled = pc.replace_substring(pc.fill_null(column, ""), "\\", "\\\\")
    return pc.replace_substring_regex(doubled, CONTROL, r"\1\\\2")


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def scattered(out: np.ndarray, at: np.ndarray, data: np.ndarray, limits: np.ndarray) -> None:
    """Copies the k-th value of a binary column to place at[k]."""
    sizes = np.diff(limits)
    out[np.arange(len(data)) + np.repeat(at - limits[:-1], sizes)] = data


def constant(out: np.ndarray, at: np.ndarray, value: bytes) -> None:
    out[at[:, None] + np.arange(len(value))] = np.frombuffer(value, np.uint8)


def assembled(rows: pa.Table) -> pa.RecordBatch:
    """The conversations of rows sorted by conversation: id, text, and spans of characters under the loss."""
    roles, texts = (escaped(rows.column(c).combine_chunks()) for c in ("role", "text"))
    roles = pc.replace_substring(roles, "\n", "\\\n")
    (role_data, role_limits), (text_data, text_limits) = buffers(roles), buffers(texts)
    role_sizes, text_sizes = np.diff(role_limits), np.diff(text_limits)
    sizes = len(TURN) + role_sizes + len(BODY) + text_sizes + len(END)
    limits = np.r_[0, np.cumsum(sizes)]
    role_at = limits[:-1] + len(TURN)
    body_at = role_at + role_sizes
    text_at = body_at + len(BODY)
    end_at = text_at + text_sizes
    out = np.empty(limits[-1], np.uint8)
    for place, value in ((limits[:-1], TURN), (body_at, BODY), (end_at, END)):
        constant(out, place, value)
    scattered(out, role_at, role_data, role_limits)
    scattered(out, text_at, text_data, text_limits)

    number = rows.column("number").to_numpy()
    first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    owner = np.cumsum(np.r_[False, number[1:] != number[:-1]])
    offsets = np.r_[limits[first], limits[-1]]
    strings = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out))
    characters = np.r_[0, np.cumsum((out & 0xC0) != 0x80)]  # before each byte: UTF-8 continuation bytes do not count
    loss = np.flatnonzero(pc.equal(pc.fill_null(rows.column("role"), ""), "assistant").to_numpy(zero_copy_only=False))
    base = characters[offsets[owner[loss]]]
    lists = pa.array(np.searchsorted(owner[loss], np.arange(len(first) + 1)), pa.int32())
    spans = [pa.ListArray.from_arrays(lists, pa.array(characters[at[loss]] - base)) for at in (text_at, end_at)]
    ids = rows.column("_id").combine_chunks().take(pa.array(first))
    return pa.RecordBatch.from_arrays([ids, strings, *spans], names=["_id", "formatted", "loss_starts", "loss_ends"])


def formatted_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation to conversations; one that goes on in the next batch waits for it."""
    waiting: list[pa.Table] = []
    size, number = 0, 0
    last = None
    for batch in batches:
        rows = pa.table(batch)
        step = max(1, int(rows.num_rows * STEP_BYTES // max(1, rows.nbytes)))
        for at in range(0, rows.num_rows, step):
            part = rows.slice(at, step)
            new = part.column("_first").to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = number + np.cumsum(new)
            number = int(numbers[-1])
            part = part.append_column("number", pa.array(numbers))
            starts = np.flatnonzero(new)
            if len(starts) and last is not None and size + part.nbytes >= STEP_BYTES:
                cut = int(starts[-1])
                yield assembled(pa.concat_tables([*waiting, part.slice(0, cut)]))
                waiting, size, part = [], 0, part.slice(cut)
            waiting.append(part)
            size, last = size + part.nbytes, number
    if waiting:
        yield assembled(pa.concat_tables(waiting))


def format_conversations(turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
                         role_column: str = "role", text_column: str = "text") -> DataFrame:
    """One row per conversation: id, formatted, loss_starts, loss_ends.

    Turns follow their number, nulls first, then role and text; equal rows all stay. A null text
    or role is empty, a null id is a conversation of its own. The loss mask is the list of character
    spans [start, end) of the assistant's texts, as escaped. Other columns are not read. A task holds
    one conversation as a whole, as its formatted row does.
    """
    rows = turns.select(F.col(id_column).alias("_id"), F.col(turn_column).alias("_turn"),
                        F.col(role_column).cast("string").alias("role"), F.col(text_column).cast("string").alias("text"))
    placed = rows.repartition("_id").sortWithinPartitions("_id", "_turn", "role", "text")
    return placed.select("_id", "role", "text").mapInArrow(
        partial(first_marked, inner=formatted_batches), typed(turns, id_column, FORMATTED)).withColumnRenamed("_id", id_column)


def first_marked(batches: Iterator[pa.RecordBatch], inner: object) -> Iterator[pa.RecordBatch]:
    """Marks the first row of each conversation in a sorted partition."""

    def marked() -> Iterator[pa.RecordBatch]:
        before: pa.Array | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            held = pa.concat_arrays([ids.slice(0, 1) if before is None else before, ids])
            codes = held.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = codes[1:] != codes[:-1]
            if before is None:
                new[0] = True
            before = ids.slice(len(ids) - 1, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new)], names=[*batch.schema.names, "_first"])

    yield from inner(marked())


def parsed(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns = TURNS.findall(text)
    if sum(len(TURN) + len(r) + len(BODY) + len(t) + len(END) for r, t in turns) != len(text):
        raise ValueError("not a formatted conversation")
    return [(unescaped(r), unescaped(t)) for r, t in turns]


DIGESTS = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations, from nothing but the formatted text and the mask."""
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for text, starts, ends in zip(*(c.to_pylist() for c in batch.columns[1:4]), strict=True):
            turns = parsed(text)
            whole = hashlib.sha256()
            for role, said in turns:
                whole.update(f"{role}\n{said}\n".encode())
            loss = "".join(unescaped(text[s:e]) for s, e in zip(starts, ends, strict=True))
            values = len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                                         names=["_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(formatted: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Per formatted conversation: turns and text under the loss mask, read back and unescaped."""
    return formatted.select(F.col(id_column).alias("_id"), "formatted", "loss_starts", "loss_ends").mapInArrow(
        digest_batches, typed(formatted, id_column, DIGESTS)).withColumnRenamed("_id", id_column)
