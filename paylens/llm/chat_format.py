"""Chat formatting of records in many layouts.

Each record (a JSON object) gets a fingerprint: a hash of its nested field
paths, values aside.  The fingerprint selects a declarative layout, which says
where conversation, turns, roles and texts are; the record becomes canonical
turns.  A record with further fields is matched by the fields that layouts
name.  Records of no layout are returned as such, never dropped.

Turns are formatted as ``<turn ROLE>TEXT</turn>``.  Inside roles and texts the
characters ``<``, ``>`` and ``\\`` become ``\\l``, ``\\g`` and ``\\\\``, so no
control string can occur there and the original comes back exactly.  The
output is in segments: whole turns up to about ``SEGMENT_CHARS`` characters,
with the spans that carry loss (assistant texts).  A conversation of any number
of turns passes through a task in order, one turn at a time in memory.

Nulls and edge cases: null roles and texts are empty; records without a
conversation id form one conversation with a null id.  Turns are ordered by
turn number (null first), then role, then text, so ties and repeated rows,
which all stay, have one order.  An object without turns gives none.  An empty
table gives no conversations.  A record that is not a JSON object has no
layout.  Columns of ``conversations`` other than the four used are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.scratch import bounded_batches

SEGMENT_CHARS = 1 << 20
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """Where a kind of record keeps its turns.

    ``each`` names a list of turns with fields ``role`` and ``text``; without
    it, ``fixed`` lists (role, fields whose non-empty texts are joined by blank
    lines), and ``role``/``text`` of a record that is one turn are field names.
    """

    name: str
    id: str = "id"
    turn: str | None = None
    each: str | None = None
    role: str | None = None
    text: str | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> list[str]:
        prefix = f"{self.each}[]." if self.each else ""
        own = [prefix + x for x in (self.role, self.text) if x]
        return [self.id, *([self.turn] if self.turn else []), *own, *chain(*(f for _, f in self.fixed))]

    def fingerprints(self) -> Iterator[str]:
        required = [p for p in self.paths() if p not in self.optional]
        for n in range(len(self.optional) + 1):
            for present in combinations(self.optional, n):
                yield fingerprint([*required, *present])
        if self.each:
            yield fingerprint([self.id, f"{self.each}[]"])  # no turn at all


def fingerprint(paths) -> str:
    return hashlib.blake2b("\n".join(sorted(set(paths))).encode(), digest_size=8).hexdigest()


#: The layouts, by field names.
LAYOUTS = (
    Layout("turn rows", id="conv_id", turn="turn", role="role", text="text"),
    Layout("messages", each="messages", role="role", text="content", optional=("id",)),
    Layout("from and value", each="conversations", role="from", text="value", optional=("id",),
           roles={"human": "user", "gpt": "assistant"}),
    Layout("instruction", fixed=(("system", ("system",)), ("user", ("instruction", "input")),
                                 ("assistant", ("output",))), optional=("id", "system", "input")),
    Layout("prompt and response", fixed=(("user", ("prompt",)), ("assistant", ("response",))), optional=("id",)),
    Layout("prompt and completion", fixed=(("user", ("prompt",)), ("assistant", ("completion",))),
           optional=("id",)),
    Layout("question and answer", fixed=(("system", ("context",)), ("user", ("question",)),
                                         ("assistant", ("answer",))), optional=("id", "context")),
)


def paths_of(value, at: str = "") -> Iterator[str]:
    """Nested field paths; list elements are ``[]``, an empty list or object is a path itself."""
    if isinstance(value, dict) and value:
        for key, inner in value.items():
            yield from paths_of(inner, f"{at}.{key}" if at else key)
    elif isinstance(value, list) and value:
        for inner in value:
            yield from paths_of(inner, f"{at}[]")
    else:
        yield at + "[]" if isinstance(value, list) else at


class Selector:
    """Layouts by fingerprint."""

    def __init__(self, layouts: tuple[Layout, ...] = LAYOUTS):
        self._by_print = {p: layout for layout in reversed(layouts) for p in layout.fingerprints()}
        self._known = {p for layout in layouts for p in layout.paths()}
        self._known |= {f"{layout.each}[]" for layout in layouts if layout.each}

    def __call__(self, record) -> tuple[str | None, Layout | None]:
        if not isinstance(record, dict):
            return None, None
        paths = set(paths_of(record))
        whole = fingerprint(paths)
        return whole, self._by_print.get(whole) or self._by_print.get(fingerprint(paths & self._known))


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: Layout) -> list[tuple[int | None, str, str]]:
    """(turn, role, text) of one record."""
    if layout.each:
        found = [(i, _text(x.get(layout.role)), _text(x.get(layout.text)))
                 for i, x in enumerate(record.get(layout.each) or [])]
    elif layout.fixed:
        parts = [(role, "\n\n".join(t for t in (_text(record.get(f)) for f in fields) if t), fields)
                 for role, fields in layout.fixed]
        found = [(i, role, text) for i, (role, text, fields) in enumerate(parts)
                 if any(f in record for f in fields)]
    else:
        found = [(record.get(layout.turn), _text(record.get(layout.role)), _text(record.get(layout.text)))]
    return [(turn, layout.roles.get(role, role), text) for turn, role, text in found]


TURNS = "layout string, fingerprint string, conv_id string, turn bigint, role string, text string"


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Turns of JSON records (column ``record``); a record of no layout is one row, its text the record."""
    schema = pa.schema([(c, pa.int64() if c == "turn" else pa.string()) for c in (
        "layout", "fingerprint", "conv_id", "turn", "role", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        select = Selector(layouts)
        for batch in batches:
            rows = []
            for line in batch.column("record").to_pylist():
                try:
                    record = json.loads(line) if line is not None else None
                except ValueError:
                    record = None
                mark, layout = select(record)
                if layout is None:
                    rows.append((None, mark, None, None, None, line))
                    continue
                conversation = record.get(layout.id)
                conversation = None if conversation is None else _text(conversation)
                rows += [(layout.name, mark, conversation, *turn) for turn in turns_of(record, layout)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
    return bounded_batches(records).select("record").mapInArrow(run, TURNS)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l").replace(">", "\\g")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    parts = text.split("\\\\")  # what stood between doubled escapes has single ones only
    return "\\".join(p.replace("\\l", "<").replace("\\g", ">") for p in parts)


FORMATTED = ("conv_id string, segment bigint, formatted string, "
             "loss array<struct<start: bigint, end: bigint>>")


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from turns that come sorted by conversation."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("conv_id", pa.string()), ("segment", pa.int64()), ("formatted", pa.string()),
                        ("loss", pa.list_(span))])
    started, current, number, parts, spans, size = False, None, 0, [], [], 0
    ready: list[tuple] = []

    def close():
        nonlocal number, parts, spans, size
        ready.append((current, number, "".join(parts), spans))
        number, parts, spans, size = number + 1, [], [], 0

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in ready], f.type) for i, f in enumerate(schema)],
                                         schema=schema)
        ready.clear()
        return out

    for batch in batches:
        for conversation, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if not started or conversation != current:
                if started:
                    close()
                started, current, number = True, conversation, 0
            elif size >= SEGMENT_CHARS:
                close()
                if sum(len(r[2]) for r in ready[-16:]) > 8 * SEGMENT_CHARS:
                    yield flush()
            head, body = f"<turn {escape(role)}>", escape(text)
            parts += [head, body, "</turn>"]
            if role == ASSISTANT:
                spans.append({"start": size + len(head), "end": size + len(head) + len(body)})
            size += len(head) + len(body) + 7
        if ready:
            yield flush()
    if started:
        close()
        yield flush()


def format_turns(turns: DataFrame) -> DataFrame:
    """Segments of each conversation, in order within one task's output."""
    return (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_formatted, FORMATTED))


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of one segment, unescaped."""
    for piece in formatted.split("</turn>")[:-1]:
        head, _, body = piece.removeprefix("<turn ").partition(">")
        yield unescape(head), unescape(body)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    current, n, whole, loss, n_loss, chars = None, 0, None, None, 0, 0
    rows: list[tuple] = []

    def close():
        rows.append((current, n, whole.hexdigest(), n_loss, loss.hexdigest(), chars))

    for batch in batches:
        for conversation, segment, text, spans in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "segment", "formatted", "loss"))):
            if segment == 0:
                if whole is not None:
                    close()
                current, n, n_loss, chars = conversation, 0, 0, 0
                whole, loss = hashlib.sha256(), hashlib.sha256()
            for role, said in read_turns(text):
                n += 1
                whole.update(f"{role}\n{said}\n".encode())
            for span in spans:
                said = unescape(text[span["start"]:span["end"]])
                n_loss += len(said)
                loss.update(said.encode())
            chars += len(text)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
        rows.clear()
    if whole is not None:
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its segments.

    A conversation's segments must lie in one partition, as ``format_turns``
    leaves them; they are put in order here.
    """
    return formatted.sortWithinPartitions("conv_id", "segment").mapInArrow(
        _read_back, "conv_id string, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                    "loss_sha256 string, formatted_chars bigint")


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows of the table ``conversations`` as JSON records."""
    return conversations.select(F.to_json(
        F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))


def oracle(extra: str) -> str:
    """The digests in DuckDB SQL; ``extra`` is a text said by user and assistant of conversation -7."""
    def escaped(x: str) -> str:
        return f"replace(replace(replace({x}, '\\', '\\\\'), '<', '\\l'), '>', '\\g')"

    said = extra.replace("'", "''")
    return f"""with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations union all values (-7, 0, 'user', '{said}'), (-7, 1, 'assistant', '{said}'))
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), ''))
            as loss_sha256,
        sum(length({escaped('role')}) + length({escaped('text')}) + {len('<turn ></turn>')})::bigint as formatted_chars
    from t group by conv_id"""
