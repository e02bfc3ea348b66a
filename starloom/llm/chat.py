r"""Chat formatting with a grammar round trip (operator 11).

The grammar; a turn bears its own marks, so turns can be read one after the
other, and a formatted conversation is its turns one after the other:

    conversation = turn*
    turn         = "<<SYS>>\n" text "\n<</SYS>>"        system
                 | "[INST] " text " [/INST]"            user
                 | " " text "</s>"                      assistant
                 | "[ROLE] " role "[/ROLE] " text "</s>"  any other role

A text holds no control string. Control strings are ``<s> </s> <<SYS>>
<</SYS>> [INST] [/INST] [ROLE] [/ROLE]``. A text that cannot stand as it is has
a backslash put after the first character of each control string in it, and one
more where there already are some: ``</s>`` becomes ``<\/s>`` and that becomes
``<\\/s>``. Reading takes one away again, so every text can be written.

1. Every turn is rendered as it is and read back by the parser. If the parser
   stops at something else or gives another role or text, the conflicting role
   or text is escaped and the turn is read again, until what comes back is what
   was put in; otherwise the turn is an error. Turns are independent of each
   other, so a conversation with a third of all rows is spread over all tasks.
2. The formatted turns (conv_id, turn, role, formatted, and start and stop of
   the loss mask in it, in code points; the mask covers the assistant's texts)
   are the output, a table.
3. Reading back takes conversations in order of turns, joins the formatted
   pieces and parses the stream: what a turn is comes from the marks alone, not
   from the rows; what is learned comes from the mask. Digests are taken on the way, so a task holds one turn at a
   time however long its conversation is. (A digest of a whole conversation is
   sequential; only this step takes a conversation in one task.)

Defined results: a null text is the empty text, a null role the empty role;
rows go by turn, then role (nulls first), then formatted text, and repeated rows
are turns of their own; null ids are one conversation; empty texts have a mask
without characters; an empty table has no conversations; extra columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import slices
from starloom.llm.common import only, stored

# The control strings, and the same with backslashes put in.
CONTROL = re.compile(r"</?s>|<</?SYS>>|\[/?(?:INST|ROLE)\]")
ESCAPABLE = re.compile(r"<\\*(?:/?s>|</?SYS>>)|\[\\*/?(?:INST|ROLE)\]")
FRAMES = {"system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
OTHER, OTHER_TEXT, OTHER_END = "[ROLE] ", "[/ROLE] ", "</s>"
LOSS_ROLE = "assistant"
READ_CHARS = 1 << 20  # how much of a conversation is joined before it is parsed


class ParseError(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    return ESCAPABLE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPABLE.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def _until(data: str, at: int, end: str) -> tuple[str, int]:
    """Text from ``at`` up to the closing mark, which must be the first control
    string there; and the place behind it."""
    m = CONTROL.search(data, at)
    if m is None:
        raise EOFError
    stop = m.end() - len(end)
    if stop < at or data[stop : m.end()] != end:
        raise ParseError(f"unexpected {m[0]} at {m.start()}")
    return data[at:stop], m.end()


def parse_turn(data: str, at: int = 0) -> tuple[str, str, int]:
    """(role, text as it stands, place behind) of the turn that begins at
    ``at``. EOFError if the data end before the turn does."""
    for role, (start, end) in FRAMES.items():
        if data.startswith(start, at):
            return (role, *_until(data, at + len(start), end))
    if data.startswith(OTHER, at):
        role, at = _until(data, at + len(OTHER), OTHER_TEXT.rstrip())
        if not data.startswith(" ", at):
            raise EOFError if at == len(data) else ParseError(f"no text at {at}")
        return (unescape(role), *_until(data, at + 1, OTHER_END))
    if any(start.startswith(data[at : at + len(start)]) for start in (OTHER, *(f[0] for f in FRAMES.values()))):
        raise EOFError
    raise ParseError(f"no turn at {at}")


def parse(data: str) -> list[tuple[str, str]]:
    """(role, text) of all turns of a whole formatted conversation."""
    out, at = [], 0
    while at < len(data):
        try:
            role, text, at = parse_turn(data, at)
        except EOFError:
            raise ParseError(f"the turn at {at} has no end") from None
        out.append((role, unescape(text)))
    return out


def _rendered(role: str, text: str, escape_role: bool, escape_text: bool) -> tuple[str, int, int]:
    """(formatted turn, start and stop of the text in it)."""
    if role in FRAMES:
        start, end = FRAMES[role]
    else:
        start, end = OTHER + (escape(role) if escape_role else role) + OTHER_TEXT, OTHER_END
    body = escape(text) if escape_text else text
    return start + body + end, len(start), len(start) + len(body)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn as text that the parser reads back as (role, text), escaped
    only if it has to be; and where its text starts and stops."""
    for escapes in ((False, False), (False, True), (True, False), (True, True)):
        out = _rendered(role, text, *escapes)
        try:
            if parse(out[0]) == [(role, text)]:
                return out
        except ParseError:
            pass
    raise ValueError(f"a turn of role {role[:40]!r} cannot be read back")


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, formatted, mask_start, mask_stop) for every row of
    (conv_id, turn, role, text); the mask is null outside the assistant's
    turns. Row by row, nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in slices(b):
                roles = [r or "" for r in rows.column("role").to_pylist()]
                got = [render(r, t or "") for r, t in zip(roles, rows.column("text").to_pylist(), strict=True)]
                mask = [(a, z) if r == LOSS_ROLE else (None, None) for r, (_, a, z) in zip(roles, got, strict=True)]
                cols = [rows.column("conv_id"), rows.column("turn"), rows.column("role"), pa.array([g[0] for g in got], pa.string()), pa.array([a for a, _ in mask], pa.int64()), pa.array([z for _, z in mask], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["conv_id", "turn", "role", "formatted", "mask_start", "mask_stop"])

    own = only(conversations, "conv_id", "turn", "role", "text")
    own = own.withColumns({c: F.col(c).cast("string") for c in ("role", "text")})
    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    return own.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, formatted string, mask_start long, mask_stop long")


class _Reader:
    """Digests of one conversation, fed with its formatted pieces in order."""

    def __init__(self) -> None:
        self.rest: list[str] = []
        self.held = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def feed(self, piece: str, mask_start: int | None, mask_stop: int | None) -> None:
        if mask_start is not None:
            text = unescape(piece[mask_start:mask_stop])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.rest.append(piece)
        self.held += len(piece)
        self.formatted_chars += len(piece)
        if self.held > READ_CHARS:
            self.read()

    def read(self) -> None:
        data, at = "".join(self.rest), 0
        try:
            while at < len(data):
                role, text, at = parse_turn(data, at)
                self.n_turns += 1
                self.turns.update(f"{role}\n{unescape(text)}\n".encode())
        except EOFError:  # the turn goes on in the next piece
            pass
        self.rest = [data[at:]]
        self.held = len(data) - at

    def done(self) -> tuple:
        self.read()
        if self.held:
            raise ParseError("the last turn has no end")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) of every formatted conversation: SHA-256 of role and text,
    a line each, of all turns, and of the texts under the mask."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out = [], []
        last, reader = None, None

        def rows() -> pa.RecordBatch:
            cols = [pa.array(ids, kind), *(pa.array([o[i] for o in out], pa.string() if "sha" in n else pa.int64()) for i, n in enumerate(names))]
            return pa.RecordBatch.from_arrays(cols, ["conv_id", *names])

        for b in batches:
            kind = b.schema.field("conv_id").type
            for part in slices(b):
                for conv, *piece in zip(*(part.column(c).to_pylist() for c in ("conv_id", "formatted", "mask_start", "mask_stop")), strict=True):
                    if reader is None or conv != last:
                        if reader is not None:
                            ids.append(last)
                            out.append(reader.done())
                        last, reader = conv, _Reader()
                    reader.feed(*piece)
            if len(out) >= 1000:
                yield rows()
                ids, out = [], []
        if reader is not None:
            ids.append(last)
            out.append(reader.done())
            yield rows()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.select("conv_id", "formatted", "mask_start", "mask_stop").mapInArrow(run, f"conv_id {formatted.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def round_trip(conversations: DataFrame) -> DataFrame:
    """Formats all conversations, writes them to the shared folder and reads
    them back."""
    return read_back(stored(format_turns(conversations), "formatted"))
