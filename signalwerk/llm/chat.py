"""Conversations as training text: a finite-state machine over roles, a declarative template, and loss flags by segment.

Rows of a conversation meet in one task, in turn order, and pass through it one at a time: a digest of all turns is sequential, so a
long conversation costs time in a task but no memory. Inside texts an escape character breaks up every control string of the template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored

START = "start"


@dataclass(frozen=True)
class Template:
    """Marks and rules. `order` maps a state (the last role, or start) to the roles that may follow."""

    begin: str = "<|turn|>"
    middle: str = "<|text|>"
    end: str = "<|over|>"
    escape: str = "\\"
    loss_roles: frozenset = frozenset({"assistant"})
    order: dict = field(default_factory=lambda: {START: {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}})
    control: tuple = ("<|turn|>", "<|text|>", "<|over|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")

    def escaped(self, text: str) -> str:
        """Doubles escape characters and puts one after the first character of each control string, overlapping ones too."""
        starts = re.compile(f"(?=(?:{'|'.join(map(re.escape, self.control))}))(.)", re.DOTALL)
        return starts.sub(lambda m: m[1] + self.escape, text.replace(self.escape, 2 * self.escape))

    def plain(self, text: str) -> str:
        """The text that escaped() was given."""
        return re.sub(re.escape(self.escape) + "(.)", lambda m: m[1], text, flags=re.DOTALL)


DEFAULT = Template()
SEGMENTS = "conv_id long, segment long, text string, loss boolean, fault string"


def segments(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Three segments per turn (mark and role, text, end): conv_id, segment, text, loss, fault.

    fault, at a turn's first segment, says what is wrong with the order of roles; the turn is formatted all the same. Turns with equal or
    null numbers are ordered by (turn, role, text), null first. Null text and null role are empty. Rows with null conv_id are one conversation.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        conv, state, number, first = None, START, 0, True
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for ident, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if first or ident != conv:
                    conv, state, number, first = ident, START, 0, False
                allowed = template.order.get(state, {"user"})
                fault = None if role in allowed else f"{role!r} after {state}"
                state = role
                for part, loss in ((template.begin + template.escaped(role) + template.middle, False), (template.escaped(text), role in template.loss_roles), (template.end, False)):
                    for c, x in zip(cols, (ident, number, part, loss, fault), strict=True):
                        c.append(x)
                    number, fault = number + 1, None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()), strict=True)], names=["conv_id", "segment", "text", "loss", "fault"])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn").mapInArrow(run, SEGMENTS)


def read(found: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests of conversations, from the formatted segments alone.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, faults.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, faults long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        conv, live, role = None, None, ""

        def closed() -> list:
            return [(conv, live["turns"], live["all"].hexdigest(), live["chars"], live["loss"].hexdigest(), live["formatted"], live["faults"])]

        for batch in batches:
            out = []
            for ident, text, loss, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "fault")), strict=True):
                if live is None or ident != conv:
                    out += closed() if live else []
                    conv, live = ident, {"turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0, "faults": 0}
                live["formatted"] += len(text)
                live["faults"] += fault is not None
                if text.startswith(template.begin):
                    role = template.plain(text[len(template.begin) : -len(template.middle)])
                elif text != template.end:
                    said = template.plain(text)
                    live["turns"] += 1
                    live["all"].update(f"{role}\n{said}\n".encode())
                    if loss:
                        live["chars"] += len(said)
                        live["loss"].update(said.encode())
            if out:
                yield rows(pa, out)
        if live:
            yield rows(pa, closed())

    def rows(pa, found: list):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    return found.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(run, schema)


def formatted(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """segments(), written to the scratch folder and read back with read()."""
    return read(stored(segments(conversations, template), "chat"), template)
