r"""Conversations as training text: typed content parts, a reversible template and a loss mask.

Method. A turn's content is text, or a list of typed parts. A visitor with one method for each part
type flattens the parts in order: text stays, an image, audio or document becomes a placeholder,
and the visitor records the attachment's reference and how many tokens the placeholder stands for.
The template writes ``<|turn|>role<|text|>text</s>``. Control strings inside roles and texts (this
template's own and those of common others) get a backslash after their first character, and
backslashes are doubled, so no control string but the template's own stands in the output and
reading it back gives the very texts. The loss mask covers the text of assistant turns.

Each turn is formatted apart from the others; a conversation is its turns' segments in order, read
as a stream, so that one conversation may hold any share of all rows.

Defined cases: null roles, texts and contents count as empty; rows without conversation id form one
conversation; rows without turn come first; among rows with equal turn the order is by role and
text, and repeated rows are repeated turns; an empty table gives an empty table; further columns
are ignored. Memory holds one turn of any length. Unknown part types stop with an error.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from typing import Iterator, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sink, rows_of

TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
# Strings that this template or common others give a meaning; first character and rest.
CONTROL = (r"(<)(s>|/s>|<SYS>>|</SYS>>|\|turn\|>|\|text\|>|\|image\|>|\|audio\|>|\|document\|>|\|im_start\|>|\|im_end\|>"
           r"|\|endoftext\|>)|(\[)(INST\]|/INST\])")
_CONTROL = re.compile(CONTROL)
_ESCAPED = re.compile(r"\\(.)", re.S)
_SEGMENT = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)</s>", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: (m[1] or m[3]) + "\\" + (m[2] or m[4]), text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Attachment(NamedTuple):
    """A part that is not text: where it stands, what it refers to and how many tokens it becomes."""

    kind: str
    offset: int
    reference: str
    tokens: int


class Flatten:
    """Visits parts in order; ``text`` has a placeholder for each attachment."""

    PATCH, TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 512

    def __init__(self):
        self.pieces: list[str] = []
        self.open: list[str] = []
        self.length = 0
        self.attachments: list[Attachment] = []

    def visit_all(self, parts: list[dict]) -> None:
        for part in parts:
            self.visit(part)
        self._close()

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"no part type {kind}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.open.append(str(part.get("text") or ""))

    def _close(self) -> None:
        """Neighbouring texts are escaped as one: a control string may begin in one and end in the next."""
        self._put(escape("".join(self.open)))
        self.open = []

    def visit_image(self, part: dict) -> None:
        wide, high = part.get("width") or self.PATCH, part.get("height") or self.PATCH
        self._attach("image", part, math.ceil(wide / self.PATCH) * math.ceil(high / self.PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.TOKENS_A_SECOND)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * self.TOKENS_A_PAGE)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._close()
        self.attachments.append(Attachment(kind, self.length, str(part.get("url") or ""), tokens))
        self._put(f"<|{kind}|>")

    def _put(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def parts_of(content: str | None, typed: bool) -> list[dict]:
    """Parts of a content: of typed content a JSON list, else one text."""
    if not typed:
        return [{"type": "text", "text": content or ""}]
    return [p if isinstance(p, dict) else {"type": "text", "text": p} for p in json.loads(content or "[]")]


_TURN = pa.schema([
    ("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segment", pa.string()),
    ("loss_first", pa.int64()), ("loss_end", pa.int64()), ("expanded_tokens", pa.int64()),
    ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("offset", pa.int64()), ("reference", pa.string()),
                                        ("tokens", pa.int64())])))])
_TURN_SQL = ("conv bigint, turn bigint, role string, segment string, loss_first bigint, loss_end bigint, "
             "expanded_tokens bigint, attachments array<struct<kind string, offset bigint, reference string, tokens bigint>>")


def format_turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                 content: str = "text", typed: bool = False, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv, turn, role, segment, loss_first, loss_end, expanded_tokens, attachments`` of every row.

    ``segment`` is the turn's part of the formatted conversation; the loss mask and the offsets of
    attachments are code points in it, ends exclusive (null where a turn is not learnt).
    ``expanded_tokens`` counts the tokens that placeholders stand for. With ``typed`` the content
    is a JSON list of parts: ``{"type": "text", "text"}``, ``{"type": "image", "url", "width",
    "height"}``, ``{"type": "audio", "url", "seconds"}``, ``{"type": "document", "url", "pages"}``.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        sink = Sink(_TURN)
        for conv, number, who, body in rows_of(batches):
            flat = Flatten()
            flat.visit_all(parts_of(body, typed))
            head = TURN + escape(who or "") + TEXT
            segment = head + "".join(flat.pieces) + END
            span = (len(head), len(segment) - len(END)) if who in learn else (None, None)
            attached = [a._replace(offset=a.offset + len(head))._asdict() for a in flat.attachments]
            row = (conv, number, who, segment, *span, sum(a.tokens for a in flat.attachments), attached)
            if sink.add(row, len(segment) + 128):
                yield sink.flush()
        yield sink.flush()

    rows = df.select(F.col(conversation).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                     F.col(role).cast("string").alias("role"), F.col(content).cast("string").alias("body"))
    return rows.mapInArrow(run, _TURN_SQL)


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    match = _SEGMENT.fullmatch(segment)
    if match is None:
        raise ValueError(f"no formatted turn: {segment[:80]!r}")
    return unescape(match[1]), unescape(match[2])


_BACK = pa.schema([("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


class _Reader:
    """What the formatted turns of one conversation say, turn by turn."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, first: int | None, end: int | None) -> None:
        role, text = read_segment(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if first is not None:
            learnt = unescape(segment[first:end])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of conversations, read from the segments of :func:`format_turns` in order."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        sink, reader = Sink(_BACK), None
        for conv, segment, first, end in rows_of(batches):
            if reader is None or reader.conv != conv:
                if reader is not None and sink.add(reader.row(), 256):
                    yield sink.flush()
                reader = _Reader(conv)
            reader.add(segment, first, end)
        if reader is not None:
            sink.add(reader.row())
        yield sink.flush()

    order = ["conv", "turn", "role", "segment"]
    rows = turns.repartition("conv").sortWithinPartitions(*order).select("conv", "segment", "loss_first", "loss_end")
    return rows.mapInArrow(run, "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                "loss_sha256 string, formatted_chars bigint")
