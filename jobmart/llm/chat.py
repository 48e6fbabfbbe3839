"""Operator 6, chat formatting by a finite-state machine and a declarative template.

A ``Template`` names, for each role, the strings around a turn, whether its text is
learned from (loss), and the order of roles that is allowed. ``format_turns`` streams
the turns of each conversation in order through the machine: a turn that the state does
not allow marks the conversation invalid there (nothing is dropped) and the machine goes
on from that turn's role. Each turn becomes segments (text, loss); their concatenation
is the formatted turn.

Control strings inside texts are escaped: a backslash goes after the first character
of each, and before each backslash. No control string survives in an escaped text, so
``read_back`` finds the turns again and unescapes them.

Defined results: a null text is empty; a null role is the role ""; unknown roles get the
template's general marks and no loss; turns are ordered by turn (nulls first), then role
and text; a null conversation is a conversation. Equal rows are separate turns. Rows of
a conversation are streamed, so its length bounds no memory but that of one batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm.common import read_table

START = "start"


@dataclass(frozen=True)
class Template:
    """``marks``: role to (before, after, loss); ``order``: state to the roles allowed
    next (a state is the last role); ``general``: marks of any other role, named inside."""

    marks: dict[str, tuple[str, str, bool]]
    order: dict[str, tuple[str, ...]]
    general: tuple[str, str, str] = ("<|", "|>", "<|/|>")
    ends: tuple[str, ...] = ()
    controls: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self):
        strings = {s.strip() for before, after, _ in self.marks.values() for s in (before, after)}
        strings |= set(self.general)
        object.__setattr__(self, "controls", tuple(sorted(s for s in strings if s)))


INSTRUCT = Template(
    marks={
        "system": ("<<SYS>>", "<</SYS>>", False),
        "user": ("[INST] ", " [/INST]", False),
        "assistant": ("<s>", "</s>", True),
    },
    order={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)


class Formatter:
    """A template's escaping, segments and reader."""

    def __init__(self, template: Template):
        self.template = template
        parts = []
        for c in template.controls:
            parts.append(re.escape(c[0]) + (f"(?={re.escape(c[1:])})" if len(c) > 1 else ""))
        self._escape = re.compile("|".join([re.escape("\\"), *parts]))
        self._unescape = re.compile(r"\\(.)", re.S)
        opening = {m[0]: role for role, m in template.marks.items()}
        self._opening = opening
        low, mid, _ = template.general
        names = "|".join(re.escape(o) for o in sorted(opening, key=len, reverse=True))
        self._open = re.compile(rf"({names})|{re.escape(low)}((?:(?!{re.escape(mid)}).)*){re.escape(mid)}", re.S)

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._unescape.sub(r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as (text, loss) segments."""
        marks = self.template.marks.get(role)
        if marks is None:
            low, mid, end = self.template.general
            return [(f"{low}{self.escape(role)}{mid}{self.escape(text)}{end}", False)]
        before, after, loss = marks
        if not loss:
            return [(before + self.escape(text) + after, False)]
        return [(before, False), (self.escape(text), True), (after, False)]

    def allowed(self, state: str, role: str) -> bool:
        return role in self.template.order.get(state, ())

    def read_back(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of the turns of a formatted string."""
        out, at = [], 0
        while at < len(formatted):
            found = self._open.match(formatted, at)
            if found is None:
                raise ValueError(f"no turn begins at {at}")
            if found[1] is not None:
                role = self._opening[found[1]]
                after = self.template.marks[role][1]
            else:
                role, after = self.unescape(found[2]), self.template.general[2]
            end = formatted.index(after, found.end())
            out.append((role, self.unescape(formatted[found.end() : end])))
            at = end + len(after)
        return out


FORMATTED = (
    "conv_id long, turn long, place int, role string, allowed boolean, "
    "segments array<struct<text:string,loss:boolean>>"
)
_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
_FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int32()), ("role", pa.string()),
     ("allowed", pa.bool_()), ("segments", _SEGMENTS)]
)


def _columns(batch: pa.RecordBatch):
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, state, place, conversation = Formatter(template), START, 0, object()
        for batch in batches:
            out = []
            for conv_id, turn, role, text in _columns(batch):
                if conv_id != conversation:
                    state, place, conversation = START, 0, conv_id
                ok = form.allowed(state, role)
                segments = [{"text": t, "loss": l} for t, l in form.segments(role, text)]
                out.append((conv_id, turn, place, role, ok, segments))
                state, place = role, place + 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _FORMATTED)], schema=_FORMATTED
                )

    return run


def format_turns(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Each turn of ``turns`` (conv_id, turn, role, text) with its place, whether the
    machine allowed it there, and its segments; conversations in one piece, in order."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_format(template), FORMATTED)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean, first_bad_turn int"
)
_DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("first_bad_turn", pa.int32())]
)


def _digest(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, conversation, started = Formatter(template), None, False
        turns = loss = None
        n = loss_chars = chars = 0
        bad = role = None

        def done():
            complete = bad is None and role in template.ends
            return (conversation, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, complete, bad)

        for batch in batches:
            out = []
            for conv_id, place, ok, segments in _columns(batch):
                if place == 0:
                    if started:
                        out.append(done())
                    conversation, started, n, loss_chars, chars, bad = conv_id, True, 0, 0, 0, None
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                formatted = "".join(s["text"] for s in segments)
                chars += len(formatted)
                for role, text in form.read_back(formatted):
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for s in segments:
                    if s["loss"]:
                        learned = form.unescape(s["text"])
                        loss_chars += len(learned)
                        loss.update(learned.encode("utf-8", "surrogatepass"))
                if not ok and bad is None:
                    bad = place
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _DIGESTS)], schema=_DIGESTS)
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(done(), _DIGESTS)], schema=_DIGESTS)

    return run


def digests(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Of each conversation of ``format_turns``'s result, what reading its output back gives."""
    return formatted.select("conv_id", "place", "allowed", "segments").mapInArrow(_digest(template), DIGESTS)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations``, and one made of control strings, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(hard).alias("text"),
    )
    return digests(format_turns(turns.union(more)))
