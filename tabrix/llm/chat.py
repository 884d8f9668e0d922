"""Chat formatting of turns with typed content parts.

``TurnWriter`` visits the parts of a turn in order: text is escaped, an image,
audio or document part becomes a numbered placeholder, and the visitor records
its attachment reference and how many tokens the placeholder expands to. A turn is

    ### <role> newline <content> newline </turn> newline

Inside roles and contents a backslash stands before every backslash, ``#`` and
``<`` (and ``n`` after one for a role's line end), so no control string of the
template can occur there, and taking the backslashes out gives the text back.

Every turn is formatted on its own row, with the character ranges of the loss
mask in it; a conversation is its turns in order. So a conversation of any
length is never gathered: ``read_back`` streams sorted turns through running
digests.

Edge cases: NULL text or role counts as empty; NULL or no parts give an empty
content; turns with equal numbers are ordered by role, then content; repeated
rows are turns of their own; a NULL conversation id is an id like any other; an
unknown part type is an error; an empty table gives an empty result; extra
columns are not formatted.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "### ", "\n</turn>\n"
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
FORMATTED = ("turn bigint, role string, formatted string, loss array<struct<start:int,end:int>>, "
             "attachments array<struct<place:int,type:string,ref:string,tokens:bigint>>, tokens bigint")


def escape(text: str) -> str:
    return re.sub(r"[\\#<]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: m[1], text, flags=re.S)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder expands to."""

    patch: int = 28  # side of an image patch in pixels, one token each
    per_second: float = 25.0  # audio
    per_page: int = 512  # document


@dataclass
class TurnWriter:
    """Visitor of a turn's parts."""

    expansion: Expansion = Expansion()
    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)
    length: int = 0
    tokens: int = 0

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part.get('type')}", None)
        if method is None:
            raise ValueError(f"unknown part type {part.get('type')!r}")
        method(part)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def visit_text(self, part: dict) -> None:
        text = escape(part.get("text") or "")
        if text:
            self.texts.append((self.length, self.length + len(text)))
        self._put(text)
        self.tokens += len((part.get("text") or "").split())

    def _attach(self, part: dict, tokens: int) -> None:
        place = len(self.attachments) + 1
        self.attachments.append({"place": place, "type": part["type"], "ref": part.get("ref"), "tokens": tokens})
        self._put(f"<{part['type']}:{place}>")
        self.tokens += tokens

    def visit_image(self, part: dict) -> None:
        side = self.expansion.patch
        self._attach(part, math.ceil((part.get("width") or 0) / side) * math.ceil((part.get("height") or 0) / side))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("seconds") or 0.0) * self.expansion.per_second))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 0) * self.expansion.per_page)


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast(
        "array<struct<type:string,text:string>>")


def format_turns(df: DataFrame, conversation: str, turn: str, role: str, parts: str, learn: str = "assistant",
                 expansion: Expansion = Expansion()) -> DataFrame:
    """One row per turn: its formatted text, loss ranges, attachments and expanded tokens.

    ``loss``: character ranges of the text parts of turns whose role is ``learn``.
    ``parts``: an array of structs as in ``PARTS``; absent fields count as NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, loss, attached, tokens, roles = [], [], [], [], []
            for who, content in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                who, writer = who or "", TurnWriter(expansion)
                for part in content or ():
                    writer.visit(part)
                head = f"{OPEN}{escape_role(who)}\n"
                text.append(head + "".join(writer.out) + CLOSE)
                loss.append([{"start": a + len(head), "end": b + len(head)} for a, b in writer.texts] if who == learn else [])
                attached.append(writer.attachments)
                tokens.append(writer.tokens)
                roles.append(who)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(roles, pa.string()), pa.array(text, pa.string()),
                 pa.array(loss, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(attached, pa.list_(pa.struct([("place", pa.int32()), ("type", pa.string()), ("ref", pa.string()),
                                                        ("tokens", pa.int64())]))), pa.array(tokens, pa.int64())],
                names=["conversation", "turn", "role", "formatted", "loss", "attachments", "tokens"])

    kind = df.schema[conversation].dataType.simpleString()
    rows = df.select(F.col(conversation).alias("conversation"), F.col(turn).cast("long"), role, parts)
    return rows.mapInArrow(run, f"conversation {kind}, {FORMATTED}").withColumnRenamed("conversation", conversation)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text (without placeholders) of a formatted turn."""
    if not (formatted.startswith(OPEN) and formatted.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    end = formatted.index("\n")
    content = formatted[end + 1: -len(CLOSE)]
    plain = re.sub(r"(\\.)|<[a-z]+:\d+>", lambda m: m[1] or "", content, flags=re.S)
    return unescape_role(formatted[len(OPEN): end]), unescape(plain)


def read_back(formatted: DataFrame, conversation: str) -> DataFrame:
    """Per conversation what its formatted text holds: turns, their digest, and the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # (id, turns, digest, loss digest, loss characters, characters)
        schema = pa.schema([("id", kind), ("n", pa.int64()), ("t", pa.string()), ("c", pa.int64()), ("l", pa.string()), ("f", pa.int64())])

        def closed(s):
            return (s[0], s[1], s[2].hexdigest(), s[4], s[3].hexdigest(), s[5])

        for batch in batches:
            done = []
            for who, text, loss in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if state is None or state[0] != who:
                    if state:
                        done.append(closed(state))
                    state = [who, 0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                role, content = parse_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{content}\n".encode())
                for r in loss or ():
                    learnt = unescape(text[r["start"]: r["end"]])
                    state[3].update(learnt.encode())
                    state[4] += len(learnt)
                state[5] += len(text)
            yield _rows(done, schema)
        if state:
            yield _rows([closed(state)], schema)

    from pyspark.sql.pandas.types import to_arrow_type

    field_ = formatted.schema[conversation]
    kind = to_arrow_type(field_.dataType)
    schema = T.StructType([T.StructField(conversation, field_.dataType), T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    names = schema.names

    def _rows(rows: list[tuple], s: pa.Schema) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[] for _ in s]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, s, strict=True)], names=names)

    # a conversation's turns meet in one task as a sorted stream, never as a group in memory
    dealt = formatted.repartition(F.col(conversation)).sortWithinPartitions(conversation, "turn", "role", "formatted")
    return dealt.select(conversation, "formatted", "loss").mapInArrow(run, schema)
