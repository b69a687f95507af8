"""Chat conversations as training text, by a finite-state machine over roles.

A declarative template names the states, the roles that may follow each, and the control
strings around a role's text. Walking a conversation emits segments: control strings and
texts, each with a flag that says whether the loss counts there (assistant texts only). A turn
that the machine does not allow is still emitted, so that nothing is lost, and marked; a
conversation is valid if it has no such turn and ends in a final state.

Control strings inside texts get a backslash after their first character (one more if there
are some already), which ``unescape`` takes away again, so they never occur as such.

Rows of a conversation are ordered by turn, then role, then text; null text counts as empty and
null role as an empty name. Conversations stream through a task sorted; none is gathered in
memory, whatever its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import staged

START = "start"


@dataclass(frozen=True)
class Template:
    """Control strings by role, moves by state, and where a conversation may end."""

    before: dict[str, str] = field(default_factory=lambda: {
        "system": "<<SYS>>\n", "user": "<s>[INST] ", "assistant": " ",
    })
    after: dict[str, str] = field(default_factory=lambda: {
        "system": "\n<</SYS>>\n\n", "user": " [/INST]", "assistant": " </s>",
    })
    other: tuple[str, str] = ("<s>[ROLE] ", " [/ROLE]")
    control: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]",
    )
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)
    loss: tuple[str, ...] = ("assistant",)

    def pattern(self) -> re.Pattern:
        """A control string with any number of backslashes after its first character."""
        rests: dict[str, list[str]] = {}
        for c in sorted(self.control, key=len, reverse=True):
            rests.setdefault(c[0], []).append(c[1:])
        return re.compile("|".join(
            f"({re.escape(head)})(\\\\*)({'|'.join(map(re.escape, tails))})" for head, tails in rests.items()
        ))


def _groups(found: re.Match) -> list[str]:
    return [g for g in found.groups() if g is not None]


def escape(text: str, pattern: re.Pattern) -> str:
    """``text`` without any control string."""
    return pattern.sub(lambda m: "\\".join([_groups(m)[0], "".join(_groups(m)[1:])]), text)


def unescape(text: str, pattern: re.Pattern) -> str:
    def plain(m: re.Match) -> str:
        head, slashes, tail = _groups(m)
        return head + slashes[1:] + tail

    return pattern.sub(plain, text)


def segments(
    chats: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """(conv, turn number from 0, segment, kind, role, text, loss, allowed), in order per task.

    ``kind`` is ``control`` or ``text``; ``text`` is escaped. The conversation's output is all
    its segments' texts in order.
    """
    template = template or Template()
    kind = chats.schema[conv].dataType.simpleString()
    rows = chats.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = template.pattern()
        conv_now, state, nth = object(), START, 0
        for batch in batches:
            out = []
            for c, r, t in zip(*(batch.column(x).to_pylist() for x in ("conv", "role", "text"))):
                if c != conv_now:
                    conv_now, state, nth = c, START, 0
                allowed = r in template.moves.get(state, ())
                before, after = (
                    (template.before[r], template.after[r]) if r in template.before else template.other
                )
                if not r or r not in template.before:
                    before += escape(r, pattern) + "\n"
                for i, (what, body) in enumerate((("control", before), ("text", escape(t, pattern)), ("control", after))):
                    out.append((c, nth, 3 * nth + i, what, r, body, what == "text" and r in template.loss, allowed))
                state, nth = (r if r in template.moves else START), nth + 1
            if out:
                kinds = (batch.schema.field("conv").type, pa.int64(), pa.int64(), pa.string(), pa.string(),
                         pa.string(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*out), kinds)],
                    ["conv", "turn", "segment", "kind", "role", "text", "loss", "allowed"],
                )

    return rows.mapInArrow(
        walk, f"conv {kind}, turn long, segment long, kind string, role string, text string, loss boolean, allowed boolean"
    )


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation, from its segments: what was said and what the loss counts."""
    template = template or Template()
    kind = formatted.schema["conv"].dataType.simpleString()
    rows = formatted.repartition("conv").sortWithinPartitions("conv", "segment")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = template.pattern()
        now = None

        def closed(batch_type) -> pa.RecordBatch:
            c, turns, said, chars, loss, length, valid, last = now
            fields = [c, turns, said.hexdigest(), chars, loss.hexdigest(), length, valid and last in template.final]
            kinds = [batch_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array([f], k) for f, k in zip(fields, kinds)],
                ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"],
            )

        for batch in batches:
            done = []
            conv_type = batch.schema.field("conv").type
            for c, what, r, t, loss, allowed in zip(*(
                batch.column(x).to_pylist() for x in ("conv", "kind", "role", "text", "loss", "allowed")
            )):
                if now is None or now[0] != c:
                    if now is not None:
                        done.append(closed(conv_type))
                    now = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, None]
                now[5] += len(t)
                if what == "text":
                    plain = unescape(t, pattern)
                    now[1] += 1
                    now[2].update(f"{r}\n{plain}\n".encode())
                    now[6], now[7] = now[6] and allowed, r
                    if loss:
                        now[3] += len(plain)
                        now[4].update(plain.encode())
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if now is not None:
            yield closed(conv_type)

    return rows.mapInArrow(
        read, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean",
    )


def formatted(chats: DataFrame, template: Template | None = None, **names: str) -> DataFrame:
    """The segments written to the shared folder and read back."""
    return staged(segments(chats, template, **names), "segments")[0]
