"""Chat formatting: a finite-state machine over roles and a declarative template with loss flags.

Rows of a conversation are taken by (turn, role, text). A null role or text is empty, a null conversation id is a
conversation of its own, repeated rows are turns of their own, and a turn that the machine does not expect is formatted all
the same and counted in ``n_unexpected``. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

SEGMENTS = "conv_id long, segment long, turn_no long, role string, text string, loss boolean, unexpected boolean"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_unexpected long"
)
ROWS_OUT = 4096


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, which roles carry loss, and which role may follow which (``""`` is the start)."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_text: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )

    def expects(self, state: str, role: str) -> bool:
        return role in self.follows.get(state, frozenset())


# Control strings open with "<|". Inside a text, "<", any number of backslashes and "|" get one backslash more.
_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _in_order(turns: DataFrame) -> DataFrame:
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_chat(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Text segments of every conversation in order: for each turn its opening, its text and its close.

    One shuffle brings the turns of a conversation together; they then stream through the machine, so a conversation of any
    length needs the memory of one batch. Rows stay in conversation order within a partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, turn_no, segment, started = None, "", 0, 0, False
        out: list[tuple] = []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if not started or conv_id != conv:
                    conv, state, turn_no, segment, started = conv_id, "", 0, 0, True
                odd = not template.expects(state, role)
                pieces = (
                    (f"{template.before_role}{escape_role(role)}{template.after_role}", False),
                    (escape(text), role in template.loss_roles),
                    (template.after_text, False),
                )
                for piece, loss in pieces:
                    out.append((conv, segment, turn_no, role, piece, loss, odd))
                    segment += 1
                state, turn_no = role, turn_no + 1
                if len(out) >= ROWS_OUT:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    return _in_order(turns).mapInArrow(run, SEGMENTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class _Reader:
    """Reads the formatted text of one conversation back, segment by segment; holds one turn at most."""

    def __init__(self, conv_id: int | None, template: Template):
        self.conv_id, self.template = conv_id, template
        self.text = ""
        self.masked: list[tuple[int, int]] = []
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.n_loss = self.n_chars = self.n_unexpected = 0

    def add(self, text: str, loss: bool, odd: bool) -> None:
        if loss:
            self.masked.append((len(self.text), len(self.text) + len(text)))
        self.text += text
        self.n_chars += len(text)
        end = self.template.after_text
        if not loss and text == end:
            self._turn(self.text)
            self.n_unexpected += odd
            self.text, self.masked = "", []

    def _turn(self, formatted: str) -> None:
        t = self.template
        if not formatted.startswith(t.before_role):
            raise ValueError(f"conversation {self.conv_id}: a turn does not open with {t.before_role!r}")
        role, _, rest = formatted[len(t.before_role) :].partition(t.after_role)
        text, close, more = rest.partition(t.after_text)
        if not close or more:
            raise ValueError(f"conversation {self.conv_id}: a turn does not end with {t.after_text!r}")
        self.n_turns += 1
        self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        for start, stop in self.masked:
            said = unescape(formatted[start:stop])
            self.n_loss += len(said)
            self.loss.update(said.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.n_loss, self.loss.hexdigest(), self.n_chars, self.n_unexpected)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of conversations parsed back from the output of ``format_chat``, whose row order it relies on."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            out = []
            for conv_id, segment, text, loss, odd in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "segment", "text", "loss", "unexpected"))
            ):
                if segment == 0:
                    if reader:
                        out.append(reader.row())
                    reader = _Reader(conv_id, template)
                reader.add(text, loss, odd)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if reader:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(reader.row(), kinds)], names)

    return segments.mapInArrow(run, DIGESTS)
