"""Operator 4 - chat formatting: a finite-state machine over roles and a declarative template.

Rows of one conversation, ordered by turn, become text segments, each with a
loss flag: for every turn an opening marker, the escaped text and a closing
marker. Only the text of an assistant turn is under the loss mask.

Rows are dealt and sorted by conversation; the machine then reads them as a
stream, keeping its state and one turn in memory, so a conversation of any
length passes through one task row by row and is never held as a group.

Defined results: null text is empty; a null or unknown role is written with the
template's generic marker and flagged; a null ``conv_id`` is one conversation of
its own; a null turn comes first; rows with the same turn are ordered by role,
then text; turn order violations are flagged (``ok``), never dropped.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Fixed values of the template: markers by role, and control strings.
SYSTEM_OPEN, SYSTEM_CLOSE = "<<SYS>>\n", "\n<</SYS>>\n"
USER_OPEN, USER_CLOSE = "[INST] ", " [/INST]\n"
ASSISTANT_OPEN, ASSISTANT_CLOSE = "<s>", "</s>\n"
OTHER_OPEN, OTHER_MID, OTHER_CLOSE = "<role>", "</role>", "</turn>\n"


@dataclass(frozen=True)
class Template:
    """Markers per role, which roles train, and the machine's transitions (role -> next roles)."""

    markers: dict = field(default_factory=lambda: {
        "system": (SYSTEM_OPEN, SYSTEM_CLOSE), "user": (USER_OPEN, USER_CLOSE),
        "assistant": (ASSISTANT_OPEN, ASSISTANT_CLOSE)})
    loss_roles: tuple = ("assistant",)
    follows: dict = field(default_factory=lambda: {
        None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def controls(self) -> list[str]:
        marks = {m.strip() for pair in self.markers.values() for m in pair}
        return sorted(marks | {OTHER_OPEN, OTHER_MID, OTHER_CLOSE.strip()}, key=lambda c: (-len(c), c))


DEFAULT = Template()


class Codec:
    """Escapes control strings and backslashes, and undoes it."""

    def __init__(self, template: Template):
        heads = sorted({c[0] for c in template.controls()})
        self._name = {h: chr(97 + i) for i, h in enumerate(heads)}
        self._head = {v: k for k, v in self._name.items()} | {"\\": "\\"}
        self._find = re.compile("|".join([r"\\", *map(re.escape, template.controls())]))
        self._undo = re.compile(r"\\(.)")

    def escape(self, text: str) -> str:
        return self._find.sub(lambda m: "\\\\" if m[0] == "\\" else "\\" + self._name[m[0][0]] + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._undo.sub(lambda m: self._head[m[1]], text)


def turn_segments(template: Template, codec: Codec, role: str, text: str) -> list[tuple[str, bool]]:
    """The segments of one turn: opening marker, text, closing marker."""
    body = codec.escape(text)
    if role in template.markers:
        opening, closing = template.markers[role]
    else:
        opening, closing = OTHER_OPEN + codec.escape(role) + OTHER_MID, OTHER_CLOSE
    return [(opening, False), (body, role in template.loss_roles), (closing, False)]


class Reader:
    """Reads formatted text back, piece by piece: ``feed`` returns the turns that are complete."""

    def __init__(self, template: Template):
        self._t, self._codec, self._buf = template, Codec(template), ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        self._buf += text
        out = []
        while (turn := self._turn()) is not None:
            out.append(turn)
        return out

    def _turn(self) -> tuple[str, str] | None:
        kinds = [*self._t.markers.items(), ("", (OTHER_OPEN, OTHER_CLOSE))]
        for role, (opening, closing) in kinds:
            if self._buf.startswith(opening):
                end = self._buf.find(closing, len(opening))
                if end < 0:
                    return None
                body = self._buf[len(opening):end]
                self._buf = self._buf[end + len(closing):]
                if not role:
                    role, _, body = body.partition(OTHER_MID)
                    role = self._codec.unescape(role)
                return role, self._codec.unescape(body)
        return None

    def rest(self) -> str:
        return self._buf


SEGMENTS = "conv_id long, turn long, n long, role string, text string, loss boolean, ok boolean"


def format_conversations(conv: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Segments (conv_id, turn, n, role, text, loss, ok), in order within each partition.

    ``n`` counts the segments of a conversation; ``ok`` says whether the machine
    allows the turn's role after the turn before it.
    """
    rows = (conv.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(it):
        codec = Codec(template)
        current, state, n, started = None, None, 0, False
        for b in it:
            out = {k: [] for k in ("conv_id", "turn", "n", "role", "text", "loss", "ok")}
            for cid, turn, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text"))):
                if not started or cid != current:
                    current, state, n, started = cid, None, 0, True
                ok = role in template.follows.get(state, ())
                state = role
                for seg, loss in turn_segments(template, codec, role, text):
                    for k, v in zip(out, (cid, turn, n, role, seg, loss, ok)):
                        out[k].append(v)
                    n += 1
            yield out

    return map_arrow(rows, run, SEGMENTS)


def op4_query(conv: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests per conversation, read back from the formatted segments as a stream."""
    probe = "</s>[INST] ok [/INST]"
    extra = conv.sparkSession.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    segments = format_conversations(conv.select("conv_id", "turn", "role", "text").union(extra), template)

    def run(it):
        cols = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")
        codec = Codec(template)
        open_id, st = None, None

        def begin():
            return {"reader": Reader(template), "turns": 0, "th": hashlib.sha256(), "lh": hashlib.sha256(),
                    "loss": 0, "chars": 0, "valid": True}

        def close(cid, s):
            if s["reader"].rest():
                raise ValueError(f"conversation {cid}: text left after the last turn")
            return (cid, s["turns"], s["th"].hexdigest(), s["loss"], s["lh"].hexdigest(), s["chars"], s["valid"])

        for b in it:
            done = []
            for cid, seg, loss, ok in zip(*(b.column(k).to_pylist() for k in ("conv_id", "text", "loss", "ok"))):
                if st is None or cid != open_id:
                    if st is not None:
                        done.append(close(open_id, st))
                    open_id, st = cid, begin()
                st["chars"] += len(seg)
                st["valid"] &= ok
                if loss:
                    plain = codec.unescape(seg)
                    st["loss"] += len(plain)
                    st["lh"].update(plain.encode())
                for role, text in st["reader"].feed(seg):
                    st["turns"] += 1
                    st["th"].update(f"{role}\n{text}\n".encode())
            yield {k: [r[i] for r in done] for i, k in enumerate(cols)}
        if st is not None:
            yield {k: [v] for k, v in zip(cols, close(open_id, st))}

    # The segments come dealt and sorted by conversation; this narrow step keeps that order.
    return map_arrow(segments, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long, valid boolean")
