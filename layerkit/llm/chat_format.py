r"""Chat formatting: typed content parts flattened into marked turns, and read back.

A turn has a role and a list of parts (``PART``): text, image, audio or document. ``TurnVisitor``
visits them in order. A text part becomes escaped text; any other part becomes a placeholder
``<|kind ordinal|>`` and a row of ``attachments`` (ordinal within the turn, kind, uri, where the
placeholder starts, and the number of tokens that a model expands it to). A turn is written as

    ### role:\nbody</turn>\n

Inside roles and texts a backslash goes before every character that a mark needs (``\``, ``<``,
``#``, in roles also ``:``), so no text, nor two parts side by side, can forge a mark, and
``read_turns`` gives back what went in.
The loss mask lists the spans (start, length, in code points of the formatted turn) of the text
parts of the roles that are trained on.

Turns are formatted one by one, without a shuffle; a conversation is its formatted turns in order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .streams import mapped, streamed

PART = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
    T.StructField("duration_ms", T.LongType()), T.StructField("pages", T.IntegerType()),
])
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
ATTACHMENT = T.StructType([
    T.StructField("ordinal", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
])

_CONTROL = re.compile(r"[\\<#]")
_ROLE_CONTROL = re.compile(r"[\\<#:]")
# role up to a free colon, body up to a free end mark; the only free "<|" opens a placeholder
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*):\n([^\\<]*(?:(?:\\.|<\|)[^\\<]*)*)</turn>\n", re.DOTALL)
_MARK = re.compile(r"\\(.)|<\|(\w+) (\d+)\|>", re.DOTALL)


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _MARK.sub(r"\1", text)


@dataclass(frozen=True)
class Expansion:
    """How many tokens an attachment stands for: image patches, audio frames, document pages."""

    patch: int = 28
    frames_per_second: int = 25
    page_tokens: int = 640


class TurnVisitor:
    """Flattens the parts of one turn; ``visit_<kind>`` per kind of part.

    A part without a kind is text; null text is empty; a null size counts as zero; any other
    kind is kept as an attachment that expands to no token."""

    def __init__(self, role: str, trained: bool, expansion: Expansion):
        self.pieces = ["### ", _ROLE_CONTROL.sub(r"\\\g<0>", role), ":\n"]
        self.at = sum(map(len, self.pieces))
        self.trained, self.expansion = trained, expansion
        self.loss: list[tuple] = []
        self.attachments: list[tuple] = []

    def visit(self, part: dict) -> None:
        kind = part["kind"] or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        body = escaped(part["text"] or "")
        if self.trained and body:
            self.loss.append((self.at, len(body)))
        self._write(body)

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil((part[side] or 0) / self.expansion.patch) for side in ("width", "height"))
        self._attach(part, "image", across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, "audio", math.ceil((part["duration_ms"] or 0) * self.expansion.frames_per_second / 1000))

    def visit_document(self, part: dict) -> None:
        self._attach(part, "document", (part["pages"] or 0) * self.expansion.page_tokens)

    def visit_other(self, part: dict) -> None:
        self._attach(part, "file", 0)

    def _attach(self, part: dict, kind: str, n_tokens: int) -> None:
        ordinal = len(self.attachments)
        self.attachments.append((ordinal, kind, part["uri"], self.at, n_tokens))
        self._write(f"<|{kind} {ordinal}|>")

    def _write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)

    def formatted(self) -> str:
        return "".join(self.pieces) + "</turn>\n"


def text_part(text: Column) -> Column:
    """A turn's plain text as its only part."""
    values = {"kind": F.lit("text"), "text": text}
    return F.array(F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PART]))


def format_turns(
    turns: DataFrame,
    parts: Column,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    trained_roles: Sequence[str] = ("assistant",),
    expansion: Expansion = Expansion(),
) -> DataFrame:
    """One row per turn: id_col, turn_col, formatted, loss (spans), attachments, n_tokens.

    ``parts``: array of ``PART`` (null: no part). ``n_tokens`` sums what the attachments expand
    to. A null role is empty; null ids and turns stay; repeated rows are turns of their own;
    other columns are left out; no rows, no rows.
    """
    schema = T.StructType([
        T.StructField(id_col, turns.schema[id_col].dataType), T.StructField(turn_col, turns.schema[turn_col].dataType),
        T.StructField("formatted", T.StringType()), T.StructField("loss", T.ArrayType(SPAN)),
        T.StructField("attachments", T.ArrayType(ATTACHMENT)), T.StructField("n_tokens", T.LongType()),
    ])
    names = {k: [f.name for f in s] for k, s in (("span", SPAN), ("attachment", ATTACHMENT))}
    trained = frozenset(trained_roles)

    def one(key, turn, role, content) -> Iterator[tuple]:
        v = TurnVisitor(role or "", role in trained, expansion)
        for part in content or []:
            v.visit(part)
        yield (
            key, turn, v.formatted(), [dict(zip(names["span"], s)) for s in v.loss],
            [dict(zip(names["attachment"], a)) for a in v.attachments], sum(a[4] for a in v.attachments),
        )

    return mapped(turns.select(id_col, turn_col, role_col, parts.alias("parts")), one, schema)


def read_turns(formatted: str) -> Iterator[tuple[str, str, list[tuple[str, int]]]]:
    """(role, text, placeholders) of each turn of a formatted text; anything else is an error."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        role, body = m.groups()
        found = [(p.group(2), int(p.group(3))) for p in _MARK.finditer(body) if p.group(2)]
        yield unescaped(role), unescaped(body), found
        at = m.end()


class _Digest:
    """Counts and digests of one conversation from its formatted turns."""

    def __init__(self):
        self.key, self.n, self.chars, self.loss_chars = None, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, key, turn, formatted, loss) -> Iterator[tuple]:
        self.key = key
        self.chars += len(formatted)
        for role, text, _ in read_turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        for span in loss:
            text = unescaped(formatted[span["start"]:span["start"] + span["length"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        return ()

    def end(self) -> Iterator[tuple]:
        yield self.key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(formatted: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Formatted turns read back: one row per conversation with counts and digests.

    Turns go by ``turn_col`` (nulls first), equal turns by their formatted text. A conversation
    passes through one task turn by turn (a digest has no parallel form); none is held.
    """
    schema = T.StructType([
        T.StructField(id_col, formatted.schema[id_col].dataType), T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    ])
    return streamed(formatted.select(id_col, turn_col, "formatted", "loss"), [id_col], [turn_col, "formatted"], _Digest, schema)


#: The two turns that the query adds to the table.
PROBE = (-7, r"\### Assistant: </turn> ok")


def with_probe(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with one that speaks the template's own marks."""
    spark = turns.sparkSession
    key, text = PROBE
    own = turns.select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(key, 0, "user", text), (key, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return own.unionByName(more)


def oracle_sql() -> str:
    """The same digests from the turns themselves, the template stated as lengths."""
    key, text = PROBE

    def marked(c: str, marks: str) -> str:
        for mark in ("\\", *marks):
            c = f"replace({c}, '{mark}', '\\{mark}')"
        return c

    body, head = marked("text", "<#"), marked("role", "<#:")
    return f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES ({key}, 0, 'user', '{text}'), ({key}, 1, 'assistant', '{text}')
    ), shown AS (
        SELECT *, '### ' || {head} || ':' || chr(10) || {body} || '</turn>' || chr(10) AS formatted FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length(formatted))::BIGINT AS formatted_chars
    FROM shown GROUP BY conv_id
    """
