r"""Chat formatting: a schema fingerprint picks the declarative mapping that turns a record into canonical turns.

A record is one JSON object.  Its fingerprint is a hash of the sorted set of its
nested field paths with their kinds (``messages[].role:string``); fields that are
null or absent leave no path.  Each layout declares its required and optional
paths and how they map to turns, so the lookup is one dictionary read and no
layout is guessed from values.  Records whose fingerprint no layout declares get
no turns; ``unmapped`` lists them with their fingerprint.

Template of one turn: ``### Assistant: <text></turn>\n``.  Inside labels and texts a
backslash, ``###`` and ``</turn>`` get a backslash in front, so a control string
that is not escaped is always the template's own, and reading back is exact.

Turns stay rows: a conversation is its segments in (turn, seq) order and is never
held in one row or one task's memory.  The per-conversation digests are the only
step that needs a conversation in order; it streams over rows sorted within a
partition with constant memory.  SHA-256 over a whole conversation is sequential
by definition, so a conversation that holds a third of all rows is one stream.

Defined results: null role and null text are empty; turns sort by turn (nulls
last), then role, then text; repeated rows are turns of their own; rows with a
null conv_id form one conversation; a very long text is one whole segment; an empty table
leaves the control conversation alone; other columns of the input, of whatever name,
are dropped.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystar.llm.tables import arrow_schema, map_batches, to_batch

TERMINATOR = "</turn>"
MARK = "###"
LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}
ROLES = {label: role for role, label in LABELS.items()}
#: Names that other layouts use for the three roles.
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}

_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)

TURN_SCHEMA = "conv_id bigint, turn bigint, seq int, role string, text string"
SEGMENT_SCHEMA = "conv_id bigint, turn bigint, seq int, role string, text string, segment string, loss_start int, loss_end int"
DIGEST_SCHEMA = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


@dataclass(frozen=True)
class Layout:
    """A declared record layout.

    ``turns`` lists (role, path) for fixed fields, in order; several paths of one
    role in a row are joined by a blank line.  ``items`` instead names an array of
    objects with a role path and a text path.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None


LAYOUTS = (
    Layout("turn", (), ("role:string", "content:string"), items=("", "role", "content")),
    Layout("prompt", ("prompt:string",), ("completion:string", "system:string"),
           (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt:string", "response:string"), ("system:string",),
           (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question", ("question:string", "answer:string"), ("context:string",),
           (("user", ("context", "question")), ("assistant", ("answer",)))),
    Layout("instruction", ("instruction:string",), ("input:string", "output:string", "system:string"),
           (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("messages", ("messages:array", "messages[]:object", "messages[].role:string"),
           ("messages[].content:string",), items=("messages", "role", "content")),
    Layout("conversations", ("conversations:array", "conversations[]:object", "conversations[].from:string"),
           ("conversations[].value:string",), items=("conversations", "from", "value")),
)


def field_paths(value, path: str = "") -> set[str]:
    """Nested field paths of a parsed record with their kinds; null fields leave none."""
    if value is None:
        return set()
    if isinstance(value, dict):
        own = {f"{path}:object"} if path else set()
        return own.union(*(field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items()))
    if isinstance(value, list):
        return {f"{path}:array"}.union(*(field_paths(v, f"{path}[]") for v in value))
    kind = "string" if isinstance(value, str) else "boolean" if isinstance(value, bool) else "number"
    return {f"{path}:{kind}"}


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def _registry() -> dict[str, Layout]:
    """Fingerprint of every allowed subset of optional paths -> layout; the first declared layout wins."""
    found: dict[str, Layout] = {}
    for layout in LAYOUTS:
        for n in range(len(layout.optional) + 1):
            for extra in itertools.combinations(layout.optional, n):
                found.setdefault(fingerprint({*layout.required, *extra}), layout)
    return found


REGISTRY = _registry()


def record_turns(record: dict, layout: Layout) -> list[tuple[str, str]]:
    if layout.items:
        array, role, text = layout.items
        rows = record.get(array) or [] if array else [record]
        return [(SPEAKERS.get(x.get(role) or "", x.get(role) or ""), x.get(text) or "") for x in rows if x is not None]
    out = []
    for role, paths in layout.turns:
        texts = [record[p] for p in paths if record.get(p) is not None]
        if texts:
            out.append((role, "\n\n".join(texts)))
    return out


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace(MARK, "\\" + MARK).replace(TERMINATOR, "\\" + TERMINATOR)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """Segment of one turn and the code-point span under the loss mask (-1, -1 for other roles)."""
    label = LABELS.get(role) or escape("@" + role).replace(":", "\\:")
    head, body = f"{MARK} {label}: ", escape(text)
    span = (len(head), len(head) + len(body)) if role == "assistant" else (-1, -1)
    return f"{head}{body}{TERMINATOR}\n", *span


def parse(segment: str) -> tuple[str, str]:
    """Role and text of one segment, read from the formatted text alone."""
    m = _TURN.fullmatch(segment)
    if not m:
        raise ValueError(f"not one formatted turn: {segment[:80]!r}")
    label = unescape(m[1])
    return ROLES[label] if label in ROLES else label[1:], unescape(m[2])


def canonical_turns(records: DataFrame) -> DataFrame:
    """(conv_id, turn, record JSON) -> canonical turns; a record without a declared layout gives none."""

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("conv_id", "turn", "seq", "role", "text")}
        for conv, turn, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "record")), strict=True):
            record = _load(text)
            layout = REGISTRY.get(fingerprint(field_paths(record))) if isinstance(record, dict) else None
            for seq, (role, said) in enumerate(record_turns(record, layout) if layout else ()):
                for k, v in zip(out, (conv, turn, seq, role, said), strict=True):
                    out[k].append(v)
        return out

    return map_batches(records.select("conv_id", "turn", "record"), rows, TURN_SCHEMA)


def unmapped(records: DataFrame) -> DataFrame:
    """Number of records by fingerprint that no layout declares; null or broken JSON has a null fingerprint."""

    def rows(batch: pa.RecordBatch) -> dict:
        found = [_load(t) for t in batch.column("record").to_pylist()]
        prints = [fingerprint(field_paths(r)) if isinstance(r, dict) else None for r in found]
        return {"fingerprint": [p for p in prints if p not in REGISTRY]}

    return map_batches(records.select("record"), rows, "fingerprint string").groupBy("fingerprint").agg(F.count("*").alias("n"))


def _load(text: str | None):
    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return None


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted segment per turn with its loss span; map-only."""

    def rows(batch: pa.RecordBatch) -> dict:
        role, text = (batch.column(c).to_pylist() for c in ("role", "text"))
        made = [render(r, t) for r, t in zip(role, text, strict=True)]
        segment, start, end = map(list, zip(*made, strict=True))
        return {c: batch.column(c) for c in ("conv_id", "turn", "seq", "role", "text")} | {
            "segment": segment, "loss_start": start, "loss_end": end}

    return map_batches(turns, rows, SEGMENT_SCHEMA)


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, segment: str, start: int, end: int) -> None:
        role, text = parse(segment)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.formatted_chars += len(segment)
        if start >= 0:
            masked = unescape(segment[start:end])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, the digests of what the formatted segments and loss spans say."""
    names = DIGEST_SCHEMA.split()[::2]
    schema = arrow_schema(DIGEST_SCHEMA)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, done = None, None, []
        for batch in batches:
            for conv, segment, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if digest is None or conv != current:
                    if digest is not None:
                        done.append((current, *digest.row()))
                    current, digest = conv, _Digest()
                digest.add(segment, start, end)
            if len(done) >= 1000:
                yield to_batch(dict(zip(names, zip(*done, strict=True), strict=True)), schema)
                done = []
        if digest is not None:
            done.append((current, *digest.row()))
        if done:
            yield to_batch(dict(zip(names, zip(*done, strict=True), strict=True)), schema)

    ordered = segments.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), "seq", "role", "text"
    )
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(stream, DIGEST_SCHEMA)


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows of a conversations table as one JSON record each; null fields leave no path."""
    record = F.to_json(F.struct("role", F.col("text").alias("content")))
    return conversations.select("conv_id", "turn", record.alias("record"))


def with_control_case(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts hold the template's own control strings."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def format_conversations(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    records = turn_records(with_control_case(spark, conversations))
    return read_back(format_turns(canonical_turns(records)))


def oracle() -> str:
    said = "\\### Assistant: </turn> ok"
    speaker = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in SPEAKERS.items())
    label = " ".join(f"WHEN '{role}' THEN '{name}'" for role, name in LABELS.items())
    escaped = lambda c: f"replace(replace(replace({c}, '\\', '\\\\'), '{MARK}', '\\{MARK}'), '{TERMINATOR}', '\\{TERMINATOR}')"
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS said_by, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{said}' UNION ALL SELECT -7, 1, 'assistant', '{said}'),
turns AS (
  SELECT conv_id, turn, text, CASE said_by {speaker} ELSE said_by END AS role FROM rows),
segments AS (
  SELECT *, length('{MARK} ' || CASE role {label} ELSE replace({escaped("'@' || role")}, ':', '\\:') END || ': ' || {escaped("text")}
                   || '{TERMINATOR}') + 1 AS chars
  FROM turns)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM segments GROUP BY conv_id"""
