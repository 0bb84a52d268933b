"""Conversations as training text: a state machine over roles, a declarative template, loss flags.

Turns are dealt out by conversation and sorted; each task walks its rows once, and holds one
turn. A conversation's digest is sequential, so a very long one is one task's walk, in bounded memory.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm.arrays import map_batches

START = "start"
#: role before -> roles that may follow
TURN_ORDER = {START: {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}
LAST_ROLES = {"assistant"}


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How turns are marked. ``controls`` never occur unescaped in a text.

    An escape character goes after the first character of each control string in a text, and before each escape
    character; so reading is exact. ``other`` marks roles without a form of their own; its ``before`` ends the role's name with ``role_end``.
    """

    turns: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<<SYS>> ", " <</SYS>>\n"),
        "user": Turn("<s>[INST] ", " [/INST]\n"),
        "assistant": Turn("[OUT] ", " </s>\n", loss=True),
    })
    other: Turn = Turn("[ROLE] ", " [/ROLE]\n")
    role_end: str = " [TEXT] "
    controls: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[OUT]", "[ROLE]", "[TEXT]", "[/ROLE]"
    )
    escape: str = "\\"

    @cached_property
    def _unsafe(self) -> re.Pattern:
        longest_first = sorted([*self.controls, self.escape], key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest_first)))

    def escaped(self, text: str) -> str:
        e = self.escape
        return self._unsafe.sub(lambda m: e + e if m[0] == e else m[0][0] + e + m[0][1:], text)

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.DOTALL)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as (text, loss) segments."""
        turn = self.turns.get(role)
        if turn is None:
            turn = Turn(self.other.before + self.escaped(role) + self.role_end, self.other.after, self.other.loss)
        return [(turn.before, False), (self.escaped(text), turn.loss), (turn.after, False)]

    def read(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn of a formatted conversation; ValueError if it is not one."""
        at = 0
        while at < len(text):
            for role, turn in [*self.turns.items(), (None, self.other)]:
                if text.startswith(turn.before, at):
                    break
            else:
                raise ValueError(f"no turn starts at character {at}")
            at += len(turn.before)
            if role is None:
                end = text.index(self.role_end, at)
                role, at = self.unescaped(text[at:end]), end + len(self.role_end)
            end = text.index(turn.after, at)
            yield role, self.unescaped(text[at:end])
            at = end + len(turn.after)


DEFAULT = Template()


def turn_faults(roles: list[str]) -> list[int]:
    """Positions of turns that the state machine does not allow; the number of turns if the last role may not be last."""
    state, faults = START, []
    for i, role in enumerate(roles):
        if role not in TURN_ORDER.get(state, ()):
            faults.append(i)
        state = role
    return faults if state in LAST_ROLES else [*faults, len(roles)]


def _sorted_turns(turns: DataFrame) -> DataFrame:
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *texts)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per segment: conv_id, position, segment, loss, allowed; rows of a conversation stand together, in order.

    ``turns`` has conv_id, turn, role, text; more columns are ignored. Null text or role is empty; rows with the
    same turn follow role and text, repeated rows are turns of their own; rows with a null conv_id are one
    conversation; null turns come first; an empty table gives no rows. ``allowed`` is false on a turn out of order;
    such conversations are formatted all the same, so that callers decide.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, position, begun = None, START, 0, False
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                out = []
                batch = whole.slice(lo, 1000)
                for c, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                    if not begun or c != conv:
                        conv, state, position, begun = c, START, 0, True
                    allowed = role in TURN_ORDER.get(state, ())
                    state = role
                    for segment, loss in template.segments(role, text):
                        out.append((c, position, segment, loss, allowed))
                        position += 1
                yield _batch(out, SEGMENTS)

    return map_batches(_sorted_turns(turns), run, "conv_id long, position long, segment string, loss boolean, allowed boolean")


SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("position", pa.int64()), ("segment", pa.string()), ("loss", pa.bool_()), ("allowed", pa.bool_()),
])
DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()),
])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class _Reader:
    """Reads one conversation from its segments, turn by turn."""

    def __init__(self, conv: int | None, template: Template):
        self.conv, self.template = conv, template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.pending, self.valid, self.last = [], True, START

    def take(self, segment: str, loss: bool, allowed: bool) -> None:
        self.chars += len(segment)
        self.valid &= allowed
        if loss:
            plain = self.template.unescaped(segment)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.pending.append(segment)
        if segment == self.template.other.after or any(segment == t.after for t in self.template.turns.values()):
            for role, text in self.template.read("".join(self.pending)):
                self.turns.update(f"{role}\n{text}\n".encode())
                self.n, self.last = self.n + 1, role
            self.pending = []

    def row(self) -> tuple:
        done = self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        return self.conv, self.n, *done, self.valid and self.last in LAST_ROLES


def digests(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What the formatted conversations say when they are read again: one row per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            for c, segment, loss, allowed in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if now is None or now.conv != c:
                    if now is not None:
                        done.append(now.row())
                    now = _Reader(c, template)
                now.take(segment, loss, allowed)
            yield _batch(done, DIGESTS)
        if now is not None:
            yield _batch([now.row()], DIGESTS)

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean"
    )
    return map_batches(segments, run, schema)
