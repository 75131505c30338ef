"""Byte-level BPE: encoding and decoding with ranks, without a regular expression.

Pre-tokenisation works on whole batches of texts as codepoint-class arrays.  A
class (letter, number, other, white space by what follows it, apostrophe by the
contraction that follows) is a function from the scanner's state to its next
state; functions compose associatively, so a blocked scan finds the state
before every character: blocks are composed side by side, their results are
chained, and each block is run once more from its known state.  A table of
(state, class) then says where tokens begin.  The boundaries are those of the
pattern that splits text before the merges of the rank files.

Slices between boundaries are looked up in a memory of merged pieces; unknown
ones are merged pair by pair, lowest rank first.  Ids keep the offset of each
piece, so decoding a range needs no other text.

Nulls and edge cases: null and empty texts have no ids.  Texts and pieces may
be of any length: merging a long piece uses a heap and linked neighbours.
Rows without an id are encoded like others; repeated rows give equal rows.
Extra columns are ignored.  Decoding gives back the UTF-8 bytes exactly.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paylens.llm.arrays import in_small_batches, text_bytes
from paylens.llm.scratch import bounded_batches

#: Pieces one task remembers, and the longest piece that is remembered.
REMEMBERED, REMEMBERED_BYTES = 600_000, 64
#: Characters of one block of the scan.
BLOCK = 64
_NO_RANK = 1 << 40

# Classes.  END stands between texts; the white-space ones depend on what follows.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_RUN, SPACE_LAST, BLANK_LAST, END = range(9)
# States: what the current token is, or how many contraction characters are due.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, AFTER_BLANK, DUE_ONE, DUE_TWO = range(8)
_STATES = 8

#: White space (Unicode property White_Space), contractions by length.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
          0x202F, 0x205F, 0x3000]
_SHORT, _LONG = "stmd", ("re", "ve", "ll")


def _class_table() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(code))[0]
        if major == "L":
            kinds[code] = LETTER
        elif major == "N":
            kinds[code] = NUMBER
    kinds[_WHITE] = SPACE_RUN
    return kinds


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a token begins here" by [class, state]."""
    to = np.zeros((9, _STATES), np.uint8)
    begins = np.ones((9, _STATES), bool)
    joined = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    for kind, state in joined.items():
        to[kind] = state
        begins[kind, [state, AFTER_BLANK]] = False
    for kind, state in ((SHORT, DUE_ONE), (LONG, DUE_TWO)):
        to[kind] = state  # a contraction, but only where a token begins
        to[kind, [IN_OTHERS, AFTER_BLANK]] = IN_OTHERS
        begins[kind, [IN_OTHERS, AFTER_BLANK]] = False
    to[SPACE_RUN] = IN_SPACE
    begins[SPACE_RUN, IN_SPACE] = False
    to[SPACE_LAST] = FRESH  # white space before other text stands alone ...
    to[BLANK_LAST] = AFTER_BLANK  # ... but a blank joins it
    to[:, DUE_TWO], to[:, DUE_ONE] = DUE_ONE, FRESH
    begins[:, [DUE_TWO, DUE_ONE]] = False
    to[END], begins[END] = FRESH, True
    return to, begins


_TO, _BEGINS = _transitions()
_kinds: np.ndarray | None = None


def _states_before(classes: np.ndarray) -> np.ndarray:
    """The state before each character, by composing transition functions."""
    n = len(classes)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, END, np.uint8)
    padded[:n] = classes
    grid = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    # Each block as one function of its first state ...
    function = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None], blocks, axis=1)
    flat, rows = _TO.reshape(-1), grid * np.uint8(_STATES)
    for row in rows:
        np.take(flat, function + row, out=function)
    function = np.ascontiguousarray(function.T)
    # ... chained by doubling: after round i each function spans 2**i blocks.
    step = 1
    while step < blocks:
        function[step:] = np.take_along_axis(function[step:], function[:-step], axis=1)
        step *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = function[:-1, FRESH]
    before = np.empty((BLOCK, blocks), np.uint8)
    for i, row in enumerate(rows):
        before[i] = state
        state = np.take(flat, state + row)
    return before.T.reshape(-1)[:n]


def piece_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where pieces begin (all texts in order), and each text's first piece."""
    global _kinds
    if _kinds is None:
        _kinds = _class_table()
    head = (raw & 0xC0) != 0x80  # first bytes of characters
    starts = np.flatnonzero(head)
    # An END follows each text, so nothing joins or looks across texts.
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    text_of = np.searchsorted(at, starts, "right") - 1
    place = np.arange(len(starts)) + text_of
    total = len(starts) + len(at) - 1
    classes = np.full(total + 2, END, np.uint8)
    classes[place] = _kinds[codes]
    chars = np.zeros(total + 2, np.uint32)
    chars[place] = codes
    space = np.flatnonzero(classes[:total] == SPACE_RUN)
    following = classes[space + 1]
    last = space[(following != SPACE_RUN) & (following != END)]
    mark = np.flatnonzero(chars[:total] == ord("'"))
    one, two = chars[mark + 1], chars[np.minimum(mark + 2, total + 1)]
    classes[mark[np.isin(one, [ord(c) for c in _SHORT])]] = SHORT
    for pair in _LONG:
        classes[mark[(one == ord(pair[0])) & (two == ord(pair[1]))]] = LONG
    classes[last] = np.where(chars[last] == 32, BLANK_LAST, SPACE_LAST)
    classes = classes[:total]
    begins = _BEGINS[classes, _states_before(classes)][place]
    bounds = starts[begins]
    return bounds, np.searchsorted(bounds, at)


class Ranks:
    """A rank file: merging bytes to ids, remembered by piece, and ids back to bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self._byte = [self.rank[bytes([b])] for b in range(256)]
        # What two neighbouring ids (20 bits each) join to.
        self._joined = {self.rank[t[:i]] << 20 | self.rank[t[i:]]: rank for t, rank in self.rank.items()
                        for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank}
        self._known: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of lowest rank, leftmost first, is joined until none is left."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        rank, n = self.rank, len(piece)
        if n <= 100:
            get, none = self._joined.get, _NO_RANK
            ids = [self._byte[b] for b in piece]
            pairs = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
            while pairs:
                lowest = min(pairs)
                if lowest == none:
                    break
                i = pairs.index(lowest)
                ids[i] = lowest
                del ids[i + 1], pairs[i]
                if i < len(pairs):
                    pairs[i] = get(lowest << 20 | ids[i + 1], none)
                if i:
                    pairs[i - 1] = get(ids[i - 1] << 20 | lowest, none)
            return ids
        end = list(range(1, n + 1))  # parts are [i, end[i]); before[] links them backwards
        before = list(range(-1, n))
        alive = [True] * n
        heap = [(rank[piece[i:i + 2]], i, 2) for i in range(n - 1) if piece[i:i + 2] in rank]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if end[i] < n:
                size = end[end[i]] - i
                found = rank.get(piece[i:i + size])
                if found is not None:
                    heapq.heappush(heap, (found, i, size))

        while heap:
            _, i, size = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] - i != size or end[i] == i + size:
                continue
            alive[end[i]] = False
            end[i] = i + size
            if end[i] < n:
                before[end[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        ids, i = [], 0
        while i < n:
            ids.append(rank[piece[i:end[i]]])
            i = end[i]
        return ids

    def learn(self, pieces: set[bytes]) -> None:
        if len(self._known) > REMEMBERED:
            self._known.clear()
        for piece in pieces.difference(self._known):
            self._known[piece] = np.array(self.merge(piece), np.int32).tobytes()

    def encode(self, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the byte offset at which each of its pieces' ids begins.

        The second array has a row (byte offset in the text, index of the piece's first id) per piece.
        """
        bounds, firsts = piece_bounds(raw, at)
        data, edges = raw.tobytes(), [*bounds.tolist(), len(raw)]
        pieces = [data[b:e] for b, e in zip(edges[:-1], edges[1:])]
        distinct = set(pieces)
        self.learn(distinct)
        get = self._known.__getitem__
        for n, (first, last) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
            merged = list(map(get, pieces[first:last]))
            sizes = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
            yield (np.frombuffer(b"".join(merged), np.int32),
                   np.column_stack([bounds[first:last] - at[n], np.cumsum(sizes) - sizes]))
        for piece in distinct:  # long ones rarely come again
            if len(piece) > REMEMBERED_BYTES:
                del self._known[piece]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


ENCODED = "doc_id bigint, ids array<int>, pieces array<struct<byte_offset: bigint, first_id: bigint>>"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Ids of every document, with the byte offset and first id of each piece."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())),
                        ("pieces", pa.list_(pa.struct([("byte_offset", pa.int64()), ("first_id", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(path)
        for batch in in_small_batches(batches, "text"):
            found = list(ranks.encode(*text_bytes(batch.column("text"))))
            ends = np.concatenate([[0], np.cumsum([len(p) for _, p in found])]).astype(np.int32)
            rows = np.concatenate([p for _, p in found])
            pieces = pa.ListArray.from_arrays(
                pa.array(ends), pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(rows[:, 0])), pa.array(np.ascontiguousarray(rows[:, 1]))],
                    fields=list(schema.field("pieces").type.value_type)))
            id_ends = np.concatenate([[0], np.cumsum([len(i) for i, _ in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(
                pa.array(id_ends), pa.array(np.concatenate([i for i, _ in found])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), ids, pieces], schema=schema)
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(run, ENCODED)


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """Number and digest of the ids, and digest of the bytes they decode to."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(path)
        numerals = [str(i) for i in range(len(ranks.token))]
        for batch in batches:
            rows = []
            for ids in batch.column("ids"):
                ids = ids.values.to_numpy().tolist()
                text = ",".join(map(numerals.__getitem__, ids))
                rows.append((len(ids), hashlib.sha256(text.encode()).hexdigest(),
                             hashlib.sha256(ranks.decode(ids)).hexdigest()))
            n, coded, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())], schema=schema)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
