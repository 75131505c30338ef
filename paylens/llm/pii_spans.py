"""Personal data: patterns propose spans, checksums confirm, context adjusts the score.

Four base kinds (email, ip, card, phone) are leftmost non-overlapping matches
of fixed patterns; checks of a match only confirm or drop it.  Further kinds:
``iban`` (confirmed by the remainder mod 97) and ``ssn`` (three digit groups,
no checksum).  Every confirmed span has a score: its kind's base, raised by
words of its kind nearby.  Base kinds start at the threshold, so they always
count; an ssn needs such a word, an iban does not.

Work is linear in the text's length: each pattern either starts at a rare
character or may not start inside a run it has already refused.  Offsets are
code points, ends exclusive.

Nulls and edge cases: a null text has no spans and counts as empty; masking
leaves it null.  Spans of different kinds may overlap; masking replaces their
union, named after the kind listed first.  Repeated rows get equal results.
Extra columns are ignored by ``find`` and kept by ``mask``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from paylens.llm.arrays import in_small_batches
from paylens.llm.scratch import bounded_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

#: The patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Base scores, words that speak for a kind, and the score that counts.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "insurance", "sozialversicherung"),
}
NEAR_CHARS, CONTEXT_GAIN, THRESHOLD = 40, 0.35, 0.5
_WORDS = {kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)", re.IGNORECASE)
          for kind, words in CONTEXT.items()}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = ord(digit) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of an account number in its plain form (no blanks)."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # Only "@" is searched; the name before it reaches back to the last match at most.
    last = 0
    if "@" in text:
        for match in _AT_DOMAIN.finditer(text):
            start = match.start()
            while start > last and _LOCAL.match(text, start - 1):
                start -= 1
            if start < match.start():
                yield start, match.end()
                last = match.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield match.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
                yield match.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for match in _IBAN.finditer(text):
        # A following word in capitals may have been taken along: give blocks back.
        candidate = match[0]
        while candidate:
            plain = candidate.replace(" ", "")
            if 15 <= len(plain) <= 34 and mod97(plain):
                yield match.start(), match.start() + len(candidate)
                break
            candidate = candidate.rpartition(" ")[0]


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for match in _SSN.finditer(text):
        area, group, serial = match[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield match.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns}


def spans_of(text: str) -> list[Span]:
    """All spans that count, by kind as listed, then by start."""
    found = []
    for kind in KINDS:
        for start, end in _FINDERS[kind](text):
            score = SCORES[kind]
            # Whole words only: the surroundings begin and end inside the text as it is.
            before, after = max(0, start - NEAR_CHARS), min(len(text), end + NEAR_CHARS)
            if _WORDS[kind].search(text, before, start) or _WORDS[kind].search(text, end, after):
                score = min(1.0, score + CONTEXT_GAIN)
            if score >= THRESHOLD:
                found.append(Span(kind, start, end, score))
    return found


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or union of overlapping spans, replaced by its kind."""
    out, done = [], 0
    merged: list[list] = []
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if merged and span.start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], span.end)
            merged[-1][2] = min(merged[-1][2], KINDS.index(span.kind))
        else:
            merged.append([span.start, span.end, KINDS.index(span.kind)])
    for start, end, kind in merged:
        out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = end
    return "".join(out) + text[done:]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


FOUND = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
         "base_sha256 string, spans string, scores array<double>")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS),
                        ("base_sha256", pa.string()), ("spans", pa.string()),
                        ("scores", pa.list_(pa.float64()))])
    for batch in in_small_batches(batches, "text"):
        rows = [spans_of(text or "") for text in batch.column("text").to_pylist()]
        base = [[s for s in spans if s.kind in BASE_KINDS] for spans in rows]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()),
            *(pa.array([sum(s.kind == kind for s in spans) for spans in base], pa.int64())
              for kind in BASE_KINDS),
            pa.array([hashlib.sha256(_joined(spans).encode()).hexdigest() for spans in base]),
            pa.array([_joined(spans) for spans in rows]),
            pa.array([[s.score for s in spans] for spans in rows], pa.list_(pa.float64()))], schema=schema)


def find(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, all spans and their scores."""
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(_found, FOUND)


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_small_batches(batches, "text"):
        texts = [None if t is None else masked(t, spans_of(t)) for t in batch.column("text").to_pylist()]
        columns = dict(zip(batch.schema.names, batch.columns))
        columns["text"] = pa.array(texts, batch.schema.field("text").type)
        yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)


def mask(docs: DataFrame) -> DataFrame:
    """All documents with their spans replaced by ``<KIND>``; all other columns stay as they are."""
    return bounded_batches(docs).mapInArrow(_masked, docs.schema)
