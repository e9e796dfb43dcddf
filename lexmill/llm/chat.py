"""Conversations rendered by a compiled template, with the spans a model is to learn.

Rows of a conversation come together by its id and are sorted by turn; the template then
renders them as a stream, one turn at a time, so a conversation of any length needs the memory of
its longest turns. A rendering is cut into parts behind turns, of about ``PART`` characters. A
conversation is rendered by one task, in order: loops know what came before.

``guard`` makes text safe inside marks: a backslash is put into every ``<|``, ``<\\|``,
``<\\\\|`` and so on, so no text can hold a mark, and ``unguard`` takes it out again. ``line``
makes a role safe inside a header line: backslashes, ``|`` and line ends are written as escapes.

Null texts and roles are empty. Null turns come first; rows of equal turn are ordered by role
and text, repeated rows stay. Rows with a null id form one conversation with a null id. An empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.templates import START, STOP, TURN, compile_template

PART = 1 << 20  # characters of a part, besides its last turn
BATCH = 1 << 22  # characters of an output batch

START_MARK, END_MARK = "<|im_start|>", "<|im_end|>"
CHATML = (
    "{% for message in messages -%}" + START_MARK + "{{ message.role | line }}{{ '\\n' }}"
    "{%- if message.role == 'assistant' -%}{% generation %}{{ message.text | guard }}{% endgeneration %}"
    "{%- else -%}{{ message.text | guard }}{%- endif -%}" + END_MARK + "{{ '\\n' }}{%- endfor %}"
)

_GUARD, _UNGUARD = re.compile(r"<(?=\\*\|)"), re.compile(r"<\\(?=\\*\|)")
_LINE = {"\\": r"\\", "\n": r"\n", "|": r"\p"}
_UNLINE = {v[1]: k for k, v in _LINE.items()}


def guard(text: str) -> str:
    return _GUARD.sub(r"<\\", text) if "|" in text else text


def unguard(text: str) -> str:
    return _UNGUARD.sub("<", text) if "|" in text else text


def line(text: str) -> str:
    return re.sub(r"[\\\n|]", lambda m: _LINE[m[0]], text)


def unline(text: str) -> str:
    return re.sub(r"\\([\\np])", lambda m: _UNLINE[m[1]], text)


FILTERS = {"guard": lambda v: guard(v or ""), "line": lambda v: line(v or ""), "trim": lambda v: (v or "").strip()}

_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _parts(pieces: Iterator) -> Iterator[tuple[str, list]]:
    """Parts of a rendering (text, spans); spans that go on into a further part are cut there."""
    texts, spans, size, opened, given = [], [], 0, None, False
    for piece in pieces:
        if piece is START:
            opened = size
        elif piece is STOP:
            spans.append({"start": opened, "end": size})
            opened = None
        elif piece is TURN:
            if size >= PART:
                if opened is not None:
                    spans.append({"start": opened, "end": size})
                    opened = 0
                yield "".join(texts), spans
                texts, spans, size, given = [], [], 0, True
        else:
            texts.append(piece)
            size += len(piece)
    if texts or not given:
        yield "".join(texts), spans


def render(
    rows: DataFrame, template: str = CHATML, key: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """``key``, ``part`` (from 0), ``text`` and ``spans`` (``start``, ``end`` in code points of the
    part) of every conversation. Parts of a conversation follow one another in one partition."""
    compile_template(template, FILTERS)  # errors show before the job
    kind = rows.schema[key].dataType.simpleString()
    turns = rows.select(
        F.col(key).alias("_c"), F.col(turn).alias("_n"),
        F.coalesce(F.col(role), F.lit("")).alias("_r"), F.coalesce(F.col(text), F.lit("")).alias("_t"),
    )
    ordered = turns.repartition("_c").sortWithinPartitions("_c", "_n", "_r", "_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rendered, ids = compile_template(template, FILTERS), pa.null()

        def messages() -> Iterator[tuple]:
            nonlocal ids
            for b in batches:
                ids = b.schema.field("_c").type
                yield from zip(*(b.column(c).to_pylist() for c in ("_c", "_r", "_t")))

        held, size = [], 0

        def out() -> pa.RecordBatch:
            cs, ns, ts, ss = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array(cs, ids), pa.array(ns, pa.int32()), pa.array(ts, pa.string()), pa.array(ss, _SPANS)],
                ["_c", "part", "text", "spans"],
            )

        for conv, its in groupby(messages(), key=lambda m: m[0]):
            stream = ({"role": r, "text": t} for _, r, t in its)
            for n, (made, spans) in enumerate(_parts(rendered(stream))):
                held.append((conv, n, made, spans))
                size += len(made)
                if size > BATCH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    made = ordered.mapInArrow(run, f"_c {kind}, part int, text string, spans array<struct<start:int,end:int>>")
    return made.withColumnRenamed("_c", key)


def read_part(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Role and text of every turn of a part rendered by ``CHATML``, and where its text lies."""
    at = 0
    while at < len(text):
        body = text.index("\n", at) + 1
        stop = text.index(END_MARK, body)
        if not text.startswith(START_MARK, at):
            raise ValueError(f"no turn begins at {at}")
        yield unline(text[at + len(START_MARK) : body - 1]), unguard(text[body:stop]), body, stop
        at = stop + len(END_MARK) + 1


def digests(rendered: DataFrame, key: str = "conv_id") -> DataFrame:
    """What a rendering by ``CHATML`` says when it is read back, one row per conversation.

    ``rendered`` comes from ``render``, whose parts lie in order. Digests go along the
    parts, so no conversation is ever whole in memory.
    """
    kind = rendered.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, names = pa.null(), ["_c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def parts() -> Iterator[tuple]:
            nonlocal ids
            for b in batches:
                ids = b.schema.field("_c").type
                yield from zip(*(b.column(c).to_pylist() for c in ("_c", "text", "spans")))

        def out(found: list) -> pa.RecordBatch:
            kinds = [ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

        found: list = []
        for conv, its in groupby(parts(), key=lambda p: p[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n, n_loss, n_chars = 0, 0, 0
            for _, text, spans in its:
                n_chars += len(text)
                for role, said, _, _ in read_part(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    learnt = unguard(text[span["start"] : span["end"]])
                    n_loss += len(learnt)
                    loss.update(learnt.encode())
            found.append((conv, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars))
            if len(found) >= 4096:
                yield out(found)
                found = []
        if found:
            yield out(found)

    made = rendered.select(F.col(key).alias("_c"), "text", "spans").mapInArrow(
        run, f"_c {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return made.withColumnRenamed("_c", key)


def turns_of(rendered: DataFrame, key: str = "conv_id") -> DataFrame:
    """The turns of a rendering by ``CHATML``: ``key``, ``part``, ``place`` in the part, ``role``,
    ``text`` and ``learnt`` (whether all of its text lies under the mask)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.schema.field("_c").type
            for conv, part, text, spans in zip(*(b.column(c).to_pylist() for c in ("_c", "part", "text", "spans"))):
                found = [
                    (conv, part, i, role, said, any(s["start"] <= start and stop <= s["end"] for s in spans))
                    for i, (role, said, start, stop) in enumerate(read_part(text))
                ]
                kinds = [ids, pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)],
                    ["_c", "part", "place", "role", "text", "learnt"],
                )

    kind = rendered.schema[key].dataType.simpleString()
    made = rendered.select(F.col(key).alias("_c"), "part", "text", "spans").mapInArrow(
        run, f"_c {kind}, part int, place int, role string, text string, learnt boolean"
    )
    return made.withColumnRenamed("_c", key)
