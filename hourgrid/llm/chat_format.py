"""Chat formatting: typed content parts are flattened by a visitor into one text for each turn.

A turn is a role and an ordered list of parts. The visitor writes text parts escaped, and image, audio and
document parts as placeholders, in order; it records each attachment with its place and the number of
tokens that its placeholder stands for. Control strings inside texts and roles are escaped reversibly: a
run ``<``, tildes, ``|`` gets one tilde more, so that ``<|`` in an output is always the template's own.

Turns are formatted by the tasks that read them. What is said about a whole conversation is folded from its
turns in order by tasks that stream them, a batch at a time, so that the longest conversation needs no
more memory than a short one.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
PARTS = (
    "array<struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
)
ATTACHMENTS = "array<struct<part:int,type:string,uri:string,at:int,tokens:long>>"
TURN = f"conv_id long, turn long, role string, formatted string, text_at int, text_chars int, attachments {ATTACHMENTS}"
FOLDED = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " n_attachments long, attachment_tokens long"
)
_CONTROL, _ESCAPED = re.compile(r"<(~*)\|"), re.compile(r"<~(~*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<~\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


class Flatten:
    """Visits the parts of a turn in order; ``tokens`` gives what a placeholder expands to.

    An image counts one token for each patch of 14 by 14 pixels merged two by two, audio 25 a second, a
    document 1,500 a page; unknown sizes count one patch, second or page. A part of another type is an
    error, a null part or a null text is empty.
    """

    def __init__(self):
        self.out: list[str] = []
        self.length = 0
        self.attachments: list[tuple] = []

    def visit(self, number: int, part: dict | None) -> None:
        if part is None:
            return
        kind = part.get("type") or "text"
        visitor: Callable[[int, dict], None] | None = getattr(self, f"visit_{kind}", None)
        if visitor is None:
            raise ValueError(f"unknown part type {kind!r}")
        visitor(number, part)

    def write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def visit_text(self, number: int, part: dict) -> None:
        self.write(escape(part.get("text") or ""))

    def visit_image(self, number: int, part: dict) -> None:
        side = lambda n: max(1, math.ceil((n or 1) / 28))
        self.attach(number, "image", part, side(part.get("width")) * side(part.get("height")))

    def visit_audio(self, number: int, part: dict) -> None:
        self.attach(number, "audio", part, max(1, math.ceil(25 * (part.get("seconds") or 1))))

    def visit_document(self, number: int, part: dict) -> None:
        self.attach(number, "document", part, 1500 * max(1, part.get("pages") or 1))

    def attach(self, number: int, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append((number, kind, part.get("uri"), self.length, tokens))
        self.write(f"<|{kind}:{len(self.attachments) - 1}|>")


def format_turn(role: str | None, parts: list[dict | None] | None) -> tuple[str, int, int, list[tuple]]:
    """The formatted turn, where its content begins, how long that is, and its attachments."""
    content = Flatten()
    for number, part in enumerate(parts or []):
        content.visit(number, part)
    head = f"{START}{escape(role or '').replace(chr(10), LINE)}\n"
    return f"{head}{''.join(content.out)}{END}\n", len(head), content.length, content.attachments


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and content of a formatted turn, unescaped."""
    head, _, rest = formatted.removeprefix(START).partition("\n")
    return unescape(head.replace(LINE, "\n")), unescape(rest.removesuffix(f"{END}\n"))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _arrow_turn()]
    for batch in batches:
        rows = []
        for conv_id, turn, role, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text, at, chars, attachments = format_turn(role, parts)
            kept = [dict(zip(("part", "type", "uri", "at", "tokens"), a, strict=True)) for a in attachments]
            rows.append((conv_id, turn, role, text, at, chars, kept))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _arrow_turn(), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _arrow_turn() -> pa.Schema:
    attachment = pa.struct(
        [("part", pa.int32()), ("type", pa.string()), ("uri", pa.string()), ("at", pa.int32()), ("tokens", pa.int64())]
    )
    return pa.schema(
        [
            ("conv_id", pa.int64()),
            ("turn", pa.int64()),
            ("role", pa.string()),
            ("formatted", pa.string()),
            ("text_at", pa.int32()),
            ("text_chars", pa.int32()),
            ("attachments", pa.list_(attachment)),
        ]
    )


def whole_text(text: Column) -> Column:
    """A turn's parts, of the fields of ``PARTS``, when the turn is one text of any length."""
    others = (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in others]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *nothing))


def format_turns(turns: DataFrame) -> DataFrame:
    """Each row of ``turns`` (conv_id, turn, role, parts) formatted, with its mask and attachments.

    ``parts`` has the fields of ``PARTS``. The content, from ``text_at`` on and ``text_chars`` long, is under the
    loss mask when the role is ``assistant``. Null roles and parts are empty; other columns are ignored.
    """
    parts = F.col("parts").cast(PARTS)
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", parts.alias("parts")
    ).mapInArrow(_format, TURN)


class _Fold:
    """What is kept of one conversation while its turns pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.attachments = self.tokens = 0

    def add(self, formatted: str, at: int, chars: int, attachments: list[dict]) -> None:
        role, text = read_turn(formatted)
        self.n += 1
        self.chars += len(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            masked = unescape(formatted[at : at + chars])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)
        self.attachments += len(attachments)
        self.tokens += sum(a["tokens"] for a in attachments)

    def row(self) -> tuple:
        sums = (self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)
        return (self.conv_id, self.n, *sums, self.attachments, self.tokens)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in FOLDED.replace(",  ", ", ").split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    now: _Fold | None = None
    for batch in batches:
        done = []
        for conv_id, formatted, at, chars, attachments in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Fold(conv_id)
            now.add(formatted, at, chars, attachments)
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([now.row()])


def conversations(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its formatted turns in the order of ``turn``.

    Turns with the same number follow each other by their formatted text; a null turn comes first, and turns
    without conv_id are one conversation. A digest of a whole conversation has to pass over it in order, so
    the turns of one conversation meet in one task, which streams them.
    """
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.select("conv_id", "formatted", "text_at", "text_chars", "attachments").mapInArrow(_fold, FOLDED)
