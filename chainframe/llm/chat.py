"""Chat formatting with typed content parts.

A visitor flattens each turn's parts into text with ordered placeholders and records what they refer to and how many
tokens they expand to. Turns are rendered one by one, without a shuffle; one shuffle by conversation then sorts the
rendered turns, and reading them back streams over them, so that a conversation of any length needs little memory.

Rendered turn:  ``### role: content</turn>`` and a line feed. Control strings inside roles and texts get a backslash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TURN, END_OF_TURN, PART = "###", "</turn>", "<part:"
#: Tokens that one unit of an attachment expands to: an image's tile, a second of audio, a document's page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 768}
PARTS = "array<struct<type:string,text:string,ref:string,units:int>>"
ATTACHMENTS = "array<struct<ordinal:int,type:string,ref:string,tokens:bigint>>"

_CONTROL = re.compile(r"\\|###|</turn>|<part:")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|<part:|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|<part:|:)")
_PLACEHOLDER = re.compile(r"\\(?:\\|###|</turn>|<part:)|<part:([a-z]+):(\d+)>")
_HEADER = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|<part:|:))*): ", re.S)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class PartVisitor:
    """Flattens the parts of one turn; one method per type. Parts of unknown types are attachments of their type without
    tokens, with a placeholder of their own, so that nothing is lost and no row fails."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        {"text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document}.get(kind, self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def _attach(self, kind: str, part: dict) -> None:
        ordinal = len(self.attachments)
        units = part.get("units")
        tokens = TOKENS_PER_UNIT.get(kind, 0) * (1 if units is None else max(0, units))
        self.attachments.append({"ordinal": ordinal, "type": part.get("type"), "ref": part.get("ref"), "tokens": tokens})
        self.out.append(f"{PART}{kind}:{ordinal}>")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part)


def render_turn(role: str | None, parts: list[dict] | None) -> tuple[str, int, int, list[dict]]:
    """(segment, start and end of its content, attachments)."""
    visitor = PartVisitor()
    for part in parts or ():
        visitor.visit(part or {})
    head, content = f"{TURN} {escape(role or '', _ROLE_CONTROL)}: ", "".join(visitor.out)
    return f"{head}{content}{END_OF_TURN}\n", len(head), len(head) + len(content), visitor.attachments


def parse_turn(segment: str) -> tuple[str, list[tuple[str, str | int]]]:
    """The inverse of render_turn: role, and the content as texts and placeholders' ordinals, in order."""
    head = _HEADER.match(segment)
    tail = f"{END_OF_TURN}\n"
    if not head or not segment.endswith(tail):
        raise ValueError("not a rendered turn")
    content = segment[head.end() : -len(tail)]
    parts, at = [], 0
    for m in _PLACEHOLDER.finditer(content):
        if m[1]:
            if m.start() > at:
                parts.append(("text", unescape(content[at : m.start()])))
            parts.append((m[1], int(m[2])))
            at = m.end()
    if at < len(content):
        parts.append(("text", unescape(content[at:])))
    return unescape(head[1]), parts


def text_parts(df: DataFrame) -> DataFrame:
    """Rows with a plain ``text`` as rows with one text part."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))
    return df.withColumn("parts", F.array(part).cast(PARTS))


def render(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, turn, segment, loss_start, loss_end, attachments, expanded_tokens), a row per row of ``turns``.

    ``turns``: conv_id, turn, role, parts; other columns are ignored. Null parts are none, a null role is empty, and a part
    without a type is text; of unknown types see PartVisitor. Repeated rows are rendered each; texts of any length are
    rendered whole; an empty table gives no rows. The loss mask of a turn is loss_start..loss_end in its segment; both are
    null if the role isn't under the loss.
    """
    schema = f"conv_id long, turn long, segment string, loss_start int, loss_end int, attachments {ATTACHMENTS}, expanded_tokens long"
    plain = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.col("parts").cast(PARTS).alias("parts"))
    kind = pa.list_(pa.struct([("ordinal", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column("role").to_pylist()
            done = [render_turn(r, p) for r, p in zip(roles, batch.column("parts").to_pylist(), strict=True)]
            learnt = [r in loss_roles for r in roles]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array([d[0] for d in done], pa.string()),
                    pa.array([d[1] if x else None for d, x in zip(done, learnt)], pa.int32()),
                    pa.array([d[2] if x else None for d, x in zip(done, learnt)], pa.int32()),
                    pa.array([d[3] for d in done], kind),
                    pa.array([sum(a["tokens"] for a in d[3]) for d in done], pa.int64()),
                ],
                ["conv_id", "turn", "segment", "loss_start", "loss_end", "attachments", "expanded_tokens"],
            )

    return plain.mapInArrow(run, schema)


def in_order(rendered: DataFrame) -> DataFrame:
    """Rendered turns, each conversation's together and in order: by turn (null first), then by segment. The formatted
    conversation is its segments, one after the other."""
    return rendered.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "segment")


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation what its formatted form says, read from the segments and the loss mask alone.

    Null conv_ids are one conversation. Placeholders are read as they stand; each must have its attachment, in order, and
    these count as n_attachments and expanded_tokens. Turns with the same number, and repeated rows, are ordered by their
    segment. Streams: only digests are held. An empty table gives no rows.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, expanded_tokens long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "expanded_tokens"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        now = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        def row(state: dict) -> tuple:
            return (state["id"], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"], state["attached"], state["tokens"])

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end", "attachments", "expanded_tokens"))
            for conv, segment, a, b, attached, tokens in zip(*columns, strict=True):
                if now is None or conv != now["id"]:
                    if now is not None:
                        done.append(row(now))
                    now = {"id": conv, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0, "attached": 0, "tokens": 0}
                role, parts = parse_turn(segment)
                text = "".join(x if kind == "text" else f"{PART}{kind}:{x}>" for kind, x in parts)
                held = [x for kind, x in parts if kind != "text"]
                if held != [x["ordinal"] for x in attached]:
                    raise ValueError(f"placeholders {held} don't match the attachments of conversation {conv}")
                now["n"] += 1
                now["attached"] += len(held)
                now["tokens"] += tokens
                now["formatted"] += len(segment)
                now["turns"].update(f"{role}\n{text}\n".encode())
                if a is not None:
                    learnt = unescape(segment[a:b])
                    now["chars"] += len(learnt)
                    now["loss"].update(learnt.encode())
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([row(now)])

    return in_order(rendered.select("conv_id", "turn", "segment", "loss_start", "loss_end", "attachments", "expanded_tokens")).mapInArrow(run, schema)


#: The conversation that the query adds.
EXTRA_ID, EXTRA_TEXT = -7, r"\### Assistant: </turn> ok"


def format_conversations(spark: SparkSession, turns: DataFrame) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(EXTRA_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    return read_back(render(text_parts(turns.select("conv_id", "turn", "role", "text").unionByName(extra))))


ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### : </turn>') + 1 + length(regexp_replace(role, '(\\|###|</turn>|<part:|:)', '\\\1', 'g'))
                + length(regexp_replace(text, '(\\|###|</turn>|<part:)', '\\\1', 'g'))) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM turns GROUP BY conv_id
"""
