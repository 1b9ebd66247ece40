"""Conversations as training text: typed content parts, a template and a loss mask.

A visitor walks the parts of each turn. Text is escaped and appended; an image,
a recording or a document leaves a numbered placeholder in its place, and its
reference and the tokens it will take are recorded beside the text. Turns of one
conversation meet in blocks of turn numbers, sorted and streamed, so a long
conversation is spread over tasks and never held whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import fields_and
from tidemark.llm.words import slices

# Turn numbers of one block, and code points of a part of it; a longer turn is a part of its own.
BLOCK_TURNS = 1000
PART_CHARS = 1_000_000
# Finished rows sent on at once.
_ROWS_OUT = 500

CONTENT = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
PARTS = (
    "block long, part int, formatted string, n_turns int, loss array<struct<start:int,length:int>>, "
    "attachments array<struct<kind:string,ref:string,start:int,tokens:bigint>>, tokens long"
)
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
_ATTACHMENTS = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("start", pa.int32()), ("tokens", pa.int64())]))


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the learnt roles, and what an attachment expands to.

    A control string in a role or text gets a backslash behind its first
    character, or one more if it has some; reading takes one away. Controls
    start with ``<`` or ``[`` and hold neither of them later, so that they never
    overlap.
    """

    begin: str = "<s>[INST] "
    after_role: str = " [/INST]\n"
    end: str = "</s>\n"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "[image ", "[audio ", "[document ")
    learnt: frozenset[str] = frozenset({"assistant"})
    image_patch: int = 14
    audio_tokens_a_second: float = 25.0
    document_tokens_a_page: int = 512

    def __post_init__(self) -> None:
        for control in self.controls:
            if control[:1] not in ("<", "[") or len(control) < 2 or re.search(r"[<\[\\]", control[1:]):
                raise ValueError(f"not a control string: {control!r}")

    @cached_property
    def _tails(self) -> dict[str, str]:
        tails: dict[str, str] = {}
        for head in "<[":
            found = [re.escape(c[1:]) for c in self.controls if c[0] == head]
            if found:
                tails[head] = "|".join(found)
        return tails

    @cached_property
    def _plain(self) -> re.Pattern:
        return re.compile("|".join(rf"{re.escape(h)}\\*(?={t})" for h, t in self._tails.items()))

    @cached_property
    def _escaped(self) -> re.Pattern:
        return re.compile("|".join(rf"{re.escape(h)}\\+(?={t})" for h, t in self._tails.items()))

    @cached_property
    def placeholder(self) -> re.Pattern:
        return re.compile(r"\[(image|audio|document) (\d+)\]")

    def escape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][:-1], text)


@dataclass
class Flattener:
    """Visits content parts and collects one part of formatted text."""

    template: Template
    pieces: list[str] = field(default_factory=list)
    chars: int = 0
    turns: int = 0
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def turn(self, role: str | None, parts: list[dict]) -> None:
        """Append a turn; neighbouring texts are one, so that no control string arises between them."""
        role = role or ""
        t = self.template
        self._add(t.begin + t.escape(role) + t.after_role)
        run: list[str] = []
        for part in parts:
            kind = part.get("type") or "text"
            if kind == "text":
                run.append(part.get("text") or "")
                continue
            visit = getattr(self, f"visit_{kind}", None)
            if visit is None:
                raise ValueError(f"unknown kind of content: {kind}")
            self.visit_text("".join(run), role)
            run = []
            visit(part)
        self.visit_text("".join(run), role)
        self._add(t.end)
        self.turns += 1

    def visit_text(self, text: str, role: str) -> None:
        if text:
            escaped = self.template.escape(text)
            if role in self.template.learnt:
                self.loss.append((self.chars, len(escaped)))
            self._add(escaped)

    def visit_image(self, part: dict) -> None:
        patch = self.template.image_patch
        self._attach("image", part, -(-(part.get("width") or 0) // patch) * -(-(part.get("height") or 0) // patch))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0.0) * self.template.audio_tokens_a_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.template.document_tokens_a_page)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        entry = {"kind": kind, "ref": part.get("ref"), "start": self.chars, "tokens": max(1, int(tokens))}
        self.attachments.append(entry)
        self._add(f"[{kind} {len(self.attachments)}]")

    def _add(self, text: str) -> None:
        self.pieces.append(text)
        self.chars += len(text)


def format_conversations(
    rows: DataFrame, template: Template | None = None, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text"
) -> DataFrame:
    """Formatted text of each conversation, in parts.

    ``content`` is text, or an array of typed parts (:data:`CONTENT`). Columns:
    the key, ``block`` (first turn number of the block), ``part`` from 0 in it,
    ``formatted``, ``n_turns``, ``loss`` (runs of learnt text as code points of
    ``formatted``), ``attachments`` in the order of their placeholders, and
    ``tokens``, what these expand to in all. A conversation is its parts in the
    order of ``block`` and ``part``; one of turn numbers below
    :data:`BLOCK_TURNS` and usual length has a single part. Parts end between
    turns and depend on the rows alone. Turns are whole, whatever their length.

    Turns go by number; equal numbers by role, then content; repeated rows
    stay. A null number comes first, in a block null. Rows of a null key are one
    conversation. A null role or text is empty, a null array or part list has no
    content, and so has a null part; a part of null type is text. An attachment
    without measures counts one token. Other columns are not read. No rows give
    no parts.
    """
    template = template or Template()
    number = F.col(turn).cast("long")
    is_text = isinstance(rows.schema[content].dataType, StringType)
    source = rows.select(
        F.col(conv_id).alias("key"),
        (number - F.pmod(number, F.lit(BLOCK_TURNS))).alias("block"),
        number.alias("number"),
        F.col(role).cast("string").alias("role"),
        F.col(content).alias("content"),
    )
    in_order = source.repartition("key", "block").sortWithinPartitions("key", "block", "number", "role", "content")
    schema = fields_and(rows.select(conv_id), PARTS)
    return in_order.mapInArrow(_formatted(template, conv_id, is_text), schema)


def _formatted(template: Template, conv_id: str, is_text: bool):
    names = ["block", "part", "formatted", "n_turns", "loss", "attachments", "tokens"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), _LOSS, _ATTACHMENTS, pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key_type, here, part, filling = None, None, 0, None

        def close() -> None:
            loss = [{"start": s, "length": n} for s, n in filling.loss]
            tokens = sum(a["tokens"] for a in filling.attachments)
            out.append((*here, part, "".join(filling.pieces), filling.turns, loss, filling.attachments, tokens))

        def sent() -> pa.RecordBatch:
            key, *rest = zip(*out, strict=True)
            arrays = [pa.array(key, key_type), *(pa.array(v, kind) for v, kind in zip(rest, kinds, strict=True))]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, [conv_id, *names])

        size = 0
        for batch in (s for b in batches for s in (slices(b, 4) if is_text else [b])):
            key_type = batch.column(0).type
            columns = [batch.column(k).to_pylist() for k in (0, 1, 3, 4)]
            for key, block, role, content in zip(*columns, strict=True):
                if filling is None or (key, block) != here:
                    if filling is not None:
                        size += filling.chars
                        close()
                    here, part, filling = (key, block), 0, Flattener(template)
                elif filling.chars >= PART_CHARS:
                    size += filling.chars
                    close()
                    part, filling = part + 1, Flattener(template)
                if len(out) >= _ROWS_OUT or size >= 4 * PART_CHARS:
                    yield sent()
                    size = 0
                parts = [{"type": "text", "text": content}] if is_text else [p for p in content or [] if p is not None]
                filling.turn(role, parts)
        if filling is not None:
            close()
            yield sent()

    return run


def turns(formatted: str, template: Template) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a formatted part: role, content still escaped, and where the content starts and ends."""
    at = 0
    for piece in formatted.split(template.end)[:-1]:
        head, content = piece.split(template.after_role, 1)
        start = at + len(head) + len(template.after_role)
        yield template.unescape(head.removeprefix(template.begin)), content, start, start + len(content)
        at += len(piece) + len(template.end)


def content_parts(content: str, attachments: Iterator[dict], template: Template) -> list[dict]:
    """Typed parts of a turn's escaped content: its texts and its attachments, in order."""
    parts, at = [], 0
    for mark in template.placeholder.finditer(content):
        if mark.start() > at:
            parts.append({"type": "text", "text": template.unescape(content[at : mark.start()]), "ref": None})
        parts.append({"type": mark[1], "text": None, "ref": next(attachments)["ref"]})
        at = mark.end()
    if at < len(content):
        parts.append({"type": "text", "text": template.unescape(content[at:]), "ref": None})
    return parts


def read_back(parts: DataFrame, template: Template | None = None, *, conv_id: str = "conv_id") -> DataFrame:
    """The turns that formatted parts were made from, one row each.

    Columns: the key, ``block``, ``part``, ``place`` of the turn in its part,
    ``role``, ``content`` (texts and attachment references in order; texts that
    were neighbours are one) and ``learnt``, the turn's text under the loss
    mask, null if there is none.
    """
    template = template or Template()
    content_type = pa.list_(pa.struct([("type", pa.string()), ("text", pa.string()), ("ref", pa.string())]))
    names = [conv_id, "block", "part", "place", "role", "content", "learnt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 3)):
            at, rows = [], []
            for k, (formatted, loss, attached) in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)), strict=True)):
                references = iter(attached)
                runs = [(x["start"], x["start"] + x["length"]) for x in loss]
                for place, (role, content, start, end) in enumerate(turns(formatted, template)):
                    learnt = [formatted[a:b] for a, b in runs if start <= a and b <= end]
                    at.append(k)
                    rows.append((place, role, content_parts(content, references, template), template.unescape("".join(learnt)) if learnt else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int32(), pa.string(), content_type, pa.string())
            taken = [batch.column(c).take(pa.array(at, pa.int64())) for c in range(3)]
            yield pa.RecordBatch.from_arrays([*taken, *(pa.array(v, t) for v, t in zip(columns, kinds, strict=True))], names)

    schema = fields_and(
        parts.select(conv_id, "block", "part"), "place int, role string, content array<struct<type:string,text:string,ref:string>>, learnt string"
    )
    return parts.select(conv_id, "block", "part", "formatted", "loss", "attachments").mapInArrow(run, schema)


def digests(parts: DataFrame, template: Template | None = None, *, conv_id: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its parts: counts, and digests of its turns and of its learnt text.

    Columns: the key, ``n_turns``, ``turns_sha256`` (role, \\n, content, \\n of
    every turn, unescaped, placeholders as they stand), ``loss_chars``,
    ``loss_sha256`` and ``formatted_chars``. A digest is a chain over a
    conversation's parts; these are streamed through one task in their order,
    of which it holds a slice.
    """
    template = template or Template()
    source = parts.select(F.col(conv_id).alias("key"), "block", "part", "formatted", "loss")
    in_order = source.repartition("key").sortWithinPartitions("key", "block", "part")
    schema = fields_and(parts.select(conv_id), _DIGESTS)
    return in_order.mapInArrow(_digested(template, conv_id), schema)


_DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Digest:
    def __init__(self) -> None:
        self.n = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict], template: Template) -> None:
        self.chars += len(formatted)
        for role, content, _, _ in turns(formatted, template):
            self.n += 1
            self.turns.update(f"{role}\n{template.unescape(content)}\n".encode())
        for run in loss:
            learnt = template.unescape(formatted[run["start"] : run["start"] + run["length"]])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode())

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digested(template: Template, conv_id: str):
    names = [field.split()[0] for field in _DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key_type, here, digest = None, None, None

        def sent() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], key_type), *map(pa.array, columns[1:])], [conv_id, *names])

        for batch in (s for b in batches for s in slices(b, 3)):
            key_type = batch.column(0).type
            for key, formatted, loss in zip(*(batch.column(c).to_pylist() for c in (0, 3, 4)), strict=True):
                if digest is None or key != here:
                    if digest is not None:
                        out.append((here, *digest.row()))
                    here, digest = key, _Digest()
                digest.add(formatted, loss, template)
            if len(out) >= _ROWS_OUT:
                yield sent()
        if digest is not None:
            out.append((here, *digest.row()))
            yield sent()

    return run
