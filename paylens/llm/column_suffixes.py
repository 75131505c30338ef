"""Repeated byte strings across documents, by column-wise construction of suffix collections.

A byte goes when it is covered by a string of ``length`` bytes that also starts
in a document with a smaller id.  Whether two such strings are equal is read off
the sorted suffixes of a collection, with their Burrows-Wheeler transform and
common prefixes, built column by column: each round puts the next symbol (from
the right) of every member in front of its newest suffix, ranks the new suffixes
by a stable count of symbols, inserts them, and derives their common prefixes
from range minima of the previous round's (``Collection``).

One transform of a whole corpus would need as many passes over it as its longest
document has bytes, one after the other.  So documents are first cut into
overlapping pieces by content: the least hash of a window's ``GRAM``-byte grams
is its key, and successive windows with one key form a piece.  Equal windows have
equal keys, whatever surrounds them, so collections of pieces by key can be built
independently; a piece is at most 2 * length - GRAM bytes long, which bounds the
rounds.  Hashes only place windows; equality is always decided by suffixes.

Steps, each a table in the shared scratch folder that the next reads in order:

1. bundles of documents (compressed), with the keys of each, dealt to buckets;
2. per bucket, the keys that two rows have; others cannot repeat anything;
3. per bundle, the distinct pieces of these keys, dealt to buckets;
4. per bucket, collections of all distinct pieces with one key (several keys make
   one collection); the answer holds the smallest document per window;
5. per bundle, the covered bytes.

Bundles send each key and each distinct piece once, with its smallest document,
so copies shrink before every shuffle.  Keys with more than ``Limits.hot`` pieces are
dealt out window by window, by the whole window, so that no key gathers an
unbounded group.  What steps 3 and 5 move is packed bytes, not rows per window.

Nulls and edge cases: a null text counts as empty.  Rows without an id, and rows
with the same id, do not remove anything from each other; rows without an id
stay whole.  Repeated rows are answered each.  Texts shorter than ``length``
stay whole.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.arrays import CHUNK_BYTES, gram_hashes, in_small_batches, text_bytes
from paylens.llm.scratch import Scratch

#: Bytes of the grams whose least hash places a window.
GRAM = 20
_MOST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Limits:
    """What one task holds; results do not depend on it."""

    #: Pieces of one key beyond which its windows are dealt out one by one.
    hot: int = 4096
    #: Bytes of text per bundle and per bucket of keys.
    bundle: int = 8 << 20
    key_bucket: int = 32 << 20
    #: Bytes of pieces per bucket and per collection.
    piece_bucket: int = 12 << 20
    collection: int = 1 << 17


class Collection:
    """Sorted suffixes of all members, from their Burrows-Wheeler transform built column by column.

    ``symbols[r]`` precedes the suffix in row r (0: none), ``common[r]`` is the
    common prefix of rows r - 1 and r.  The first rows are the members' ends.
    """

    def __init__(self, members: list[bytes]):
        lengths = np.array([len(m) for m in members], np.int64)
        self.order = np.argsort(-lengths, kind="stable")  # still growing ones come first
        self.lengths = lengths[self.order]
        ends = np.cumsum(lengths)[self.order]
        raw = np.frombuffer(b"".join(members), np.uint8)
        # Symbols are bytes + 1; 0 is the end.
        kind = np.uint16 if len(raw) and raw.max() == 255 else np.uint8
        self.symbols = np.zeros(len(members), kind)
        self.common = np.zeros(len(members), np.uint8)
        newest = np.arange(len(members))
        for column in range(1, int(self.lengths.max(initial=0)) + 1):
            active = int(np.searchsorted(-self.lengths, -column, "right"))
            newest = self._insert(newest[:active], raw[ends[:active] - column].astype(kind) + kind(1))

    def _ranked(self) -> tuple[np.ndarray, int]:
        """Rows in the order of their suffixes with the preceding symbol; how many have none."""
        by_symbol = np.argsort(self.symbols, kind="stable")
        return by_symbol, int(np.searchsorted(self.symbols[by_symbol], 0, "right"))

    def _insert(self, newest: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """One round: ``letters`` go in front of the suffixes in rows ``newest``; the new suffixes' rows."""
        self.symbols[newest] = letters
        by_symbol, ended = self._ranked()
        n, first = len(by_symbol), len(self.lengths) - ended
        rank = np.empty(n, np.int64)
        rank[by_symbol] = np.arange(n)
        at = rank[newest]
        # Common prefixes change at the new rows and right behind them.
        changed = np.zeros(n + 1, bool)
        changed[at] = changed[at + 1] = True
        changed = np.flatnonzero(changed[:n])
        left, right = by_symbol[np.maximum(changed - 1, 0)], by_symbol[changed]
        same = (changed > 0) & (self.symbols[left] == self.symbols[right])
        values = np.zeros(len(changed), np.uint8)
        values[same] = self._least(left[same] + 1, right[same]) + 1
        old = np.ones(n + first, bool)
        old[at + first] = False
        for name in ("symbols", "common"):
            array = getattr(self, name)
            grown = np.zeros(n + first, array.dtype)
            grown[old] = array
            setattr(self, name, grown)
        self.common[changed + first] = values
        return at + first

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima of ``common`` over low..high, by doubling spans."""
        spans = np.frexp((high - low + 1).astype(np.float64))[1] - 1  # floor of the binary logarithm
        by_span = np.argsort(spans.astype(np.uint8), kind="stable")
        edges = np.searchsorted(spans[by_span], np.arange(int(spans.max(initial=-1)) + 2))
        out, table = np.empty(len(low), np.uint8), self.common
        for span in range(len(edges) - 1):
            if span:
                step = 1 << (span - 1)
                table = np.minimum(table[:-step], table[step:])
            own = by_span[edges[span]:edges[span + 1]]
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << span) + 1])
        return out

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        """(suffix length, rows of that suffix of the members that have one), members in ``order``."""
        by_symbol, ended = self._ranked()
        rank = np.empty(len(by_symbol), np.int64)
        rank[by_symbol] = np.arange(len(by_symbol)) + len(self.lengths) - ended
        at = np.arange(len(self.lengths))
        for column in range(1, int(self.lengths.max(initial=0)) + 1):
            at = rank[at[:int(np.searchsorted(-self.lengths, -column, "right"))]]
            yield column, at


def smallest_documents(members: list[bytes], documents: np.ndarray, length: int) -> list[np.ndarray]:
    """Per member and window start in it, the smallest document of members that hold the same window."""
    sorted_ = Collection(members)
    value = np.full(len(sorted_.symbols), _MOST, np.int64)
    owner = documents[sorted_.order]
    found = []
    for column, at in sorted_.rows():
        if column >= length:
            value[at] = owner[:len(at)]
            found.append(at)
    begins = sorted_.common < length
    begins[:1] = True
    least = np.minimum.reduceat(value, np.flatnonzero(begins)) if len(value) else value
    of_row = least[np.cumsum(begins) - 1]
    # The longest suffix is the first window.
    grid = np.zeros((len(found), len(members)), np.int64)
    for i, at in enumerate(found):
        grid[len(found) - 1 - i, :len(at)] = of_row[at]
    out: list = [None] * len(members)
    for place, (member, n) in enumerate(zip(sorted_.order.tolist(), sorted_.lengths.tolist())):
        out[member] = grid[len(found) - (n - length + 1):, place] if n >= length else grid[:0, place]
    return out


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - size + span], x[size - span:]) if span < size else x


def windows(raw: np.ndarray, at: np.ndarray, usable: np.ndarray, length: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces as their first byte, number of successive windows and key; texts lie between offsets ``at``."""
    grams = min(GRAM, length)
    most = length - grams + 1
    starts, counts, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for begin in range(0, len(raw) - length + 1, CHUNK_BYTES):
        end = min(len(raw), begin + CHUNK_BYTES)
        key = _sliding_least(gram_hashes(raw[begin:end + length - 1], grams), most)
        valid = np.zeros(len(key), bool)
        for d in range(int(np.searchsorted(at, begin, "right")) - 1, int(np.searchsorted(at, end, "left"))):
            if usable[d]:
                valid[max(at[d] - begin, 0):max(at[d + 1] - length + 1 - begin, 0)] = True
        where = np.flatnonzero(valid)
        key = key[where]
        new = np.ones(len(where), bool)
        new[1:] = (np.diff(where) != 1) | (key[1:] != key[:-1])
        run = np.flatnonzero(new)
        since = np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))
        new = np.flatnonzero(since % most == 0)
        starts.append(where[new] + begin)
        counts.append(np.diff(np.append(new, len(where))))
        keys.append(key[new])
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(keys)


class Bundle:
    """Some documents with their pieces; every step derives the same pieces from the same bytes."""

    def __init__(self, ids: pa.Array, raw: np.ndarray, at: np.ndarray, length: int):
        self.raw, self.at, self.length = raw, at, length
        self.usable = np.asarray(ids.is_valid())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.starts, self.counts, self.keys = windows(raw, at, self.usable, length)

    def document(self, starts: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.at, starts, "right") - 1]

    def grouped(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (bucket, short key) of the pieces as one integer, and each piece's place among them."""
        return np.unique((self.keys >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)
                         | self.keys & np.uint64(0xFFFFFFFF), return_inverse=True)

    def candidates(self, codes: np.ndarray, buckets: int) -> None:
        """Distinct pieces of shared keys, in the order in which they are dealt to ``buckets``."""
        shared, hot = np.flatnonzero(codes == 1), np.flatnonzero(codes == 2)
        n = self.counts[hot]
        single = np.repeat(self.starts[hot] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        starts = np.concatenate([self.starts[shared], single])
        counts = np.concatenate([self.counts[shared], np.ones(len(single), np.int64)])
        data, place = self.raw.tobytes(), {}
        index = np.array([place.setdefault(data[b:e], len(place)) for b, e in zip(
            starts.tolist(), (starts + counts + self.length - 1).tolist())], np.int64)
        pieces = list(place)
        first = np.zeros(len(pieces), np.int64)
        first[index[::-1]] = np.arange(len(index))[::-1]
        route = np.zeros(len(pieces), np.uint32)
        whole = first < len(shared)
        route[whole] = (self.keys[shared] & np.uint64(0xFFFFFFFF)).astype(np.uint32)[first[whole]]
        route[~whole] = [zlib.crc32(pieces[i]) for i in np.flatnonzero(~whole)]
        documents = np.full(len(pieces), _MOST, np.int64)
        np.minimum.at(documents, index, self.document(starts))
        bucket = route % np.uint32(buckets)
        order = np.argsort(bucket, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.pieces, self.route, self.documents = [pieces[i] for i in order], route[order], documents[order]
        self.bucket = bucket[order]
        self.occurrences = starts, counts, back[index]

    def covered(self, smallest: np.ndarray) -> np.ndarray:
        """Bytes to remove, from the smallest documents of all windows of ``pieces``."""
        sizes = np.array([len(p) - self.length + 1 for p in self.pieces], np.int64)
        begins = np.cumsum(sizes) - sizes
        change = np.zeros(len(self.raw) + 1, np.int32)
        for low in range(0, len(self.occurrences[0]), 1 << 16):
            starts, counts, index = (x[low:low + (1 << 16)] for x in self.occurrences)
            inner = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            gone = smallest[np.repeat(begins[index], counts) + inner] < np.repeat(self.document(starts), counts)
            at = (np.repeat(starts, counts) + inner)[gone]
            np.add.at(change, at, 1)
            np.add.at(change, at + self.length, -1)
        return np.cumsum(change[:-1]) > 0


def _spread(order: np.ndarray) -> list[tuple[int, slice]]:
    """(value, slice) of each run of a sorted array."""
    values, begins = np.unique(order, return_index=True)
    ends = np.append(begins[1:], len(order))
    return [(int(v), slice(int(b), int(e))) for v, b, e in zip(values, begins, ends)]


def _packed(data: bytes | np.ndarray) -> bytes:
    """What moves between steps is compressed before Spark sees it."""
    return zstandard.ZstdCompressor(level=3).compress(data if isinstance(data, bytes) else data.tobytes())


def _opened(data: bytes, kind=np.uint8) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


_BUNDLES = ("bundle bigint, ids array<bigint>, ends array<bigint>, text binary, "
            "keys array<struct<bucket:int,keys:binary,pieces:binary>>")


def _bundled(length: int, buckets: int, most: int):
    message = pa.struct([("bucket", pa.int32()), ("keys", pa.binary()), ("pieces", pa.binary())])
    schema = pa.schema([("bundle", pa.int64()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                        ("text", pa.binary()), ("keys", pa.list_(message))])

    def closed(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        ids = rows.column("doc_id").cast(pa.int64())
        raw, at = text_bytes(rows.column("text"))
        bundle = Bundle(ids, raw, at, length)
        groups, of = bundle.grouped(buckets)
        document = bundle.document(bundle.starts)
        low, high = np.full(len(groups), _MOST, np.int64), np.full(len(groups), -_MOST - 1, np.int64)
        np.minimum.at(low, of, document)
        np.maximum.at(high, of, document)
        # Twice the number of pieces, odd if they are of several documents.
        pieces = (2 * np.bincount(of, minlength=len(groups)) + (low < high)).astype(np.uint32)
        short = groups.astype(np.uint32)
        sent = [{"bucket": b, "keys": _packed(short[s]), "pieces": _packed(pieces[s])}
                for b, s in _spread(groups >> np.uint64(32))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(([number], [ids], [at[1:]], [_packed(raw)], [sent]), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in in_small_batches(batches, "text"):
            more = int(text_bytes(batch.column("text"))[1][-1])
            if held and size + more > most:
                yield closed(number, held)
                number, held, size = number + 1, [], 0
            held.append(batch)
            size += more
        if held:
            yield closed(number, held)
    return run


_ANSWERS = "bundle bigint, bucket int, pieces bigint, codes binary, runs binary, windows binary, documents binary"
_ANSWER_SCHEMA = pa.schema([("bundle", pa.int64()), ("bucket", pa.int32()), ("pieces", pa.int64()),
                            *((n, pa.binary()) for n in ("codes", "runs", "windows", "documents"))])


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    parts = [_opened(x, kind) for x in table.column(name).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _shared(most: int):
    """Of each key: 0 if one row has it, 1 if several, 2 if it also has more than ``most`` pieces."""
    def run(key: tuple, sent: pa.Table) -> pa.Table:
        keys, pieces = _joined(sent, "keys", np.uint32), _joined(sent, "pieces", np.uint32)
        order = np.argsort(keys, kind="stable")
        begins = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        # Bundles hold different rows, so a key that two of them send has several.
        several = (np.diff(np.append(begins, len(keys))) > 1) | (np.maximum.reduceat(pieces[order] & 1, begins) > 0)
        pieces = pieces >> 1
        hot = np.add.reduceat(pieces[order].astype(np.int64), begins) > most
        codes = np.empty(len(keys), np.uint8)
        codes[order] = np.repeat(several.astype(np.uint8) + (several & hot), np.diff(np.append(begins, len(keys))))
        edges = np.cumsum([0, *(len(_opened(k)) // 4 for k in sent.column("keys").to_pylist())])
        own = [codes[b:e] for b, e in zip(edges[:-1], edges[1:])]
        load = [int((pieces[b:e].astype(np.int64) * np.array([0, 1, GRAM])[codes[b:e]]).sum())
                for b, e in zip(edges[:-1], edges[1:])]
        empty = [None] * len(own)
        return pa.table([pa.array(c, f.type) for c, f in zip(
            (sent.column("bundle").to_pylist(), sent.column("bucket").to_pylist(), load, [_packed(c) for c in own],
             empty, empty, empty), _ANSWER_SCHEMA)], schema=_ANSWER_SCHEMA)
    return run


def _reopened(bundles: pa.Table, answers: pa.Table, length: int, key_buckets: int, piece_buckets: int) -> Bundle:
    """The bundle again, with the candidates that the answers about its keys leave."""
    row = bundles.slice(0, 1).to_pylist()[0]
    bundle = Bundle(pa.array(row["ids"], pa.int64()), _opened(row["text"]), np.array([0, *row["ends"]], np.int64), length)
    codes = answers.filter(pa.compute.greater_equal(answers.column("pieces"), 0)).sort_by("bucket")
    _, of = bundle.grouped(key_buckets)
    bundle.candidates(_joined(codes, "codes", np.uint8)[of], piece_buckets)
    return bundle


_PIECES = "bundle bigint, bucket int, text binary, sizes binary, route binary, low binary"


def _cut(length: int, key_buckets: int, piece_buckets: int):
    schema = pa.schema([("bundle", pa.int64()), ("bucket", pa.int32()),
                        *((n, pa.binary()) for n in ("text", "sizes", "route", "low"))])

    def run(key: tuple, bundles: pa.Table, answers: pa.Table) -> pa.Table:
        bundle = _reopened(bundles, answers, length, key_buckets, piece_buckets)
        sent = []
        for bucket, own in _spread(bundle.bucket):
            pieces = bundle.pieces[own]
            sent.append((key[0].as_py(), bucket, *map(_packed, (
                b"".join(pieces), np.array([len(p) for p in pieces], np.uint16), bundle.route[own], bundle.documents[own]))))
        return pa.table([pa.array([r[i] for r in sent], f.type) for i, f in enumerate(schema)], schema=schema)
    return run


def _collected(length: int, most: int):
    """Collections of one bucket; the answer lists, per piece, runs of windows with one smallest document."""
    def run(key: tuple, sent: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        index, routes, lows = [], [], []
        for text, sizes, route, low in zip(*(sent.column(c).to_pylist() for c in ("text", "sizes", "route", "low"))):
            text, ends = _opened(text).tobytes(), np.cumsum(_opened(sizes, np.uint16), dtype=np.int64).tolist()
            index.append(np.array([place.setdefault(text[b:e], len(place)) for b, e in zip([0, *ends], ends)], np.int64))
            routes.append(_opened(route, np.uint32))
            lows.append(_opened(low, np.int64))
        pieces, all_index = list(place), np.concatenate(index)
        route = np.zeros(len(pieces), np.uint32)
        route[all_index] = np.concatenate(routes)
        documents = np.full(len(pieces), _MOST, np.int64)
        np.minimum.at(documents, all_index, np.concatenate(lows))
        order = np.argsort(route, kind="stable")
        alone = np.append(True, route[order][1:] != route[order][:-1])
        alone &= np.append(alone[1:], True)
        # A collection of one member has nothing to sort: its windows are of its own document.
        answers: list = [(1, bytes([len(p) - length + 1]), d) for p, d in zip(pieces, map(np.ndarray.tobytes, documents[:, None]))]
        order = order[~alone]
        sizes = np.cumsum([len(pieces[i]) for i in order])
        begin = 0
        while begin < len(order):
            end = int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + most, "right"))
            end = int(np.searchsorted(route[order], route[order[max(end, begin + 1) - 1]], "right"))
            members = order[begin:end]
            for i, least in zip(members.tolist(), smallest_documents([pieces[i] for i in members], documents[members], length)):
                new = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
                answers[i] = (len(new), np.diff(np.append(new, len(least))).astype(np.uint8).tobytes(),
                              np.ascontiguousarray(least[new]).tobytes())
            begin = end
        rows = []
        for bundle, own in zip(sent.column("bundle").to_pylist(), index):
            parts = [answers[i] for i in own.tolist()]
            rows.append((bundle, key[0].as_py(), -1, None, *map(_packed, (
                bytes(p[0] for p in parts), b"".join(p[1] for p in parts), b"".join(p[2] for p in parts)))))
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ANSWER_SCHEMA)],
                        schema=_ANSWER_SCHEMA)
    return run


_KEPT = "doc_id bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary"


def _without(length: int, key_buckets: int, piece_buckets: int):
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())])

    def run(key: tuple, bundles: pa.Table, answers: pa.Table) -> pa.Table:
        bundle = _reopened(bundles, answers, length, key_buckets, piece_buckets)
        found = answers.filter(pa.compute.less(answers.column("pieces"), 0)).sort_by("bucket")
        smallest = np.repeat(_joined(found, "documents", np.int64), _joined(found, "windows", np.uint8))
        gone, at = bundle.covered(smallest), bundle.at
        edge = np.zeros(len(gone) + 1, bool)
        edge[at] = True  # removed runs end with their document
        first = gone & (edge[:-1] | ~np.append(False, gone[:-1]))
        last = gone & (edge[1:] | ~np.append(gone[1:], False))
        begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        of = np.searchsorted(at, begins, "right") - 1
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(begins, at), pa.int32()),
            pa.StructArray.from_arrays([pa.array(begins - at[of]), pa.array(ends - at[of])], fields=list(span)))
        kept = [bundle.raw[b:e][~gone[b:e]].tobytes() for b, e in zip(at[:-1].tolist(), at[1:].tolist())]
        ids = pa.array(np.ma.masked_array(bundle.ids, ~bundle.usable), pa.int64())
        return pa.table([ids, pa.array(np.diff(at)), spans, pa.array(kept, pa.binary())], schema=schema)
    return run


def remove_repeats(docs: DataFrame, length: int = 50, limits: Limits = Limits()) -> DataFrame:
    """doc_id, n_bytes, spans (removed, in bytes) and kept (the remaining bytes) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key_buckets = -(-size // limits.key_bucket) or 1
    bundles = scratch.settle(texts.mapInArrow(_bundled(length, key_buckets, limits.bundle), _BUNDLES), "bundles", "zstd")
    codes = scratch.settle(
        bundles.select("bundle", F.inline("keys")).groupBy("bucket").applyInArrow(_shared(limits.hot), _ANSWERS), "codes")
    pieces = codes.agg(F.sum("pieces")).first()[0] or 0
    piece_buckets = -(-pieces * (2 * length - GRAM) // limits.piece_bucket) or 1
    texts = bundles.select("bundle", "ids", "ends", "text")
    cut = scratch.settle(
        texts.groupBy("bundle").cogroup(codes.groupBy("bundle"))
        .applyInArrow(_cut(length, key_buckets, piece_buckets), _PIECES), "pieces", "zstd")
    found = scratch.settle(cut.groupBy("bucket").applyInArrow(_collected(length, limits.collection), _ANSWERS), "found", "zstd")
    scratch.drop("pieces")
    return (texts.groupBy("bundle").cogroup(codes.unionByName(found).groupBy("bundle"))
            .applyInArrow(_without(length, key_buckets, piece_buckets), _KEPT))


def digests(rows: DataFrame) -> DataFrame:
    """What was removed, with a hash in place of the remaining bytes."""
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
