"""Packing of documents into fixed-length token sequences along a Hilbert curve.

Every document's ids (a word-based tokenizer, then one end id) are projected by
hashed random signs to a few dimensions; the point's index on a Hilbert curve
is the document's key.  A range sort by key lays similar documents side by
side, and the ordered ids are cut into sequences of ``SEQUENCE`` ids.  The ids
left over at the very end fill sequences whose lengths are powers of two, so
nothing is padded at all.

Three passes over written tables: ids and keys per document; the same in curve
order, with each document's offset inside its range partition; pieces, from
these offsets and the partitions' totals.  Ids move once.  A hot key (many
equal documents) is split by doc_id, since that is part of the sort order.

Nulls and edge cases: a null or empty text is the end id alone.  Rows without
an id are packed like others and keep a null id.  Repeated rows are packed as
often as they occur, in any order among themselves.  Extra columns are ignored.
An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.arrays import in_small_batches, text_bytes
from paylens.llm.scratch import Scratch

SEQUENCE, END_ID = 4096, 2
#: Dimensions and bits per dimension of the curve; the key must fit 63 bits.
DIMENSIONS, BITS = 4, 12
#: Words whose ids one task remembers; beyond it the memory starts anew.
REMEMBERED_WORDS = 900_000

# ASCII letters and marks; the apostrophe is neither, because contractions use it.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
_MARK[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True


#: Letters below are precomposed and in one block with their cases.
_LATIN_END = "\u0180"
#: Byte-level tokenizers write a byte as the character of its number, or from 256 on if that does not print.
_UNPRINTED = [*range(33), *range(127, 161), 173]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_UNPRINTED)}
_OF_WORKER: dict[str, WordIds] = {}


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the curve of integer points (rows) with ``bits`` bits a coordinate."""
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    q = np.uint64(1 << (bits - 1))
    # Undo the reflections and exchanges that the curve makes at each level.
    while q > 1:
        low = q - np.uint64(1)
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, n):  # Gray code across coordinates
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << np.uint64(1) | (x[i] >> np.uint64(bit)) & np.uint64(1)
    return key.astype(np.int64)


def signs(ids: np.ndarray) -> np.ndarray:
    """One random sign per id and dimension."""
    h = (ids.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return 1.0 - 2.0 * ((h[:, None] >> np.arange(4, 4 + DIMENSIONS, dtype=np.uint32)) & 1)


def curve_keys(ids: np.ndarray, at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Keys of documents whose ids lie between successive offsets ``at`` (none empty)."""
    sums = np.add.reduceat(table[ids], at[:-1], axis=0) if len(at) > 1 else np.zeros((0, DIMENSIONS))
    mean = sums / np.diff(at)[:, None]
    # Means of signs crowd around 0: a smooth curve spreads them over the grid.
    grid = (0.5 + 0.5 * np.tanh(4 * mean)) * (1 << BITS)
    return hilbert_key(np.clip(grid, 0, (1 << BITS) - 1).astype(np.uint64))


def plain_words(raw: np.ndarray, at: np.ndarray) -> list[list[bytes]]:
    """The words of each text in ASCII lower case, cut where a letter meets a mark.

    The tokenizer drops white space, never joins text across it and always
    separates letters from marks, so these cuts leave every id as it is; "end",
    "end." and "End," then share one entry of the memory.
    """
    low = np.frombuffer(raw.tobytes().lower(), np.uint8)
    letter, mark = _LETTER[low], _MARK[low]
    cut = np.zeros(len(low) + 1, np.int64)
    if len(low):
        cut[2:] = np.cumsum((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:]))
    out = np.full(len(low) + int(cut[-1]), 32, np.uint8)
    out[np.arange(len(low)) + cut[1:]] = low
    data, at = out.tobytes(), at + cut[at]
    return [data[b:e].split() for b, e in zip(at[:-1].tolist(), at[1:].tolist())]


class WordIds(dict):
    """Ids (little-endian bytes) of words without white space, filled by the tokenizer.

    The words of a text that holds none of ``added`` (the tokenizer's added tokens)
    may be looked up one by one; ``whole`` encodes any text.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.code = "H" if self.vocabulary <= 1 << 16 else "I"
        self._byte_level = '"ByteLevel"' in self._tokenizer.to_str()
        self.added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        """One memory per Python worker, kept for its later tasks; it is bounded."""
        if path not in _OF_WORKER:
            _OF_WORKER.clear()
            _OF_WORKER[path] = cls(path)
        return _OF_WORKER[path]

    def whole(self, text: str) -> bytes:
        return array(self.code, self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, words: set[bytes]) -> None:
        unknown = [w for w in words if w not in self]
        if len(self) + len(unknown) > REMEMBERED_WORDS:
            self.clear()
            unknown = list(words)
        code, merge = self.code, self._tokenizer.model.tokenize
        others = []
        for word in unknown:
            # Neither normalisation nor splitting changes a word of Latin letters in
            # lower case: the tokenizer's merges are all it needs.
            if not word.isalpha():
                text = word.decode()
                if not (self._byte_level and text.isalpha() and max(text) < _LATIN_END and text == text.lower()):
                    others.append(word)
                    continue
            self[word] = array(code, [token.id for token in merge(word.decode("latin-1").translate(_BYTE_LETTERS))]).tobytes()
        texts = b" ".join(others).decode().split(" ") if others else []
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for word, result in zip(others, encoded):
            self[word] = array(code, result.ids).tobytes()


CODED = "doc_id bigint, curve_key bigint, n_tokens bigint, ids binary"


def _coded(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("curve_key", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # By its imported name: what is pickled with this function ends with the task.
        from paylens.llm import curve_packing

        known = curve_packing.WordIds.of_worker(path)
        table = signs(np.arange(known.vocabulary + END_ID + 1))
        end = array(known.code, [END_ID]).tobytes()
        for batch in in_small_batches(batches, "text"):
            words = plain_words(*text_bytes(batch.column("text")))
            known.learn(set().union(*words))
            get = known.__getitem__
            coded = [b"".join(map(get, w)) + end for w in words]
            for token in known.added:
                for i in pc.indices_nonzero(pc.match_substring(batch.column("text"), token)).to_pylist():
                    coded[i] = known.whole(batch.column("text")[i].as_py()) + end
            lengths = np.array([len(c) // len(end) for c in coded], np.int64)
            keys = curve_keys(np.frombuffer(b"".join(coded), known.code),
                              np.concatenate([[0], np.cumsum(lengths)]), table)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(keys), pa.array(lengths),
                 pa.array(coded, pa.binary())], schema=schema)
    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range partition and the number of ids before each document in it."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        lengths = batch.column("n_tokens").to_numpy()
        starts = before + np.cumsum(lengths) - lengths
        before += int(lengths.sum())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_tokens"), batch.column("ids"),
             pa.array(np.full(len(lengths), part, np.int64)), pa.array(starts.astype(np.int64))],
            names=["doc_id", "n_tokens", "ids", "part", "start_in_part"])


PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def sequence_starts_in_tail(total: int) -> list[int]:
    """Starts of the sequences behind the last full one: lengths are falling powers of two."""
    begin, starts = total - total % SEQUENCE, []
    for bit in range(SEQUENCE.bit_length() - 2, -1, -1):
        if (total - begin) >> bit:
            starts.append(begin)
            begin += 1 << bit
    return starts


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each document, from its place in the whole order."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                        ("offset", pa.int64())])
    for batch in batches:
        rows: list[tuple] = []
        names = ("doc_id", "n_tokens", "ids", "first", "total")
        for doc_id, n, ids, first, total in zip(*(batch.column(c).to_pylist() for c in names)):
            tail = sequence_starts_in_tail(total)
            full = total - total % SEQUENCE
            cuts = [c for c in range(first - first % SEQUENCE + SEQUENCE, min(first + n, full + 1), SEQUENCE)]
            cuts += [t for t in tail if first < t < first + n and t > full]
            edges = [first, *cuts, first + n]
            own = np.frombuffer(ids, np.uint16 if len(ids) == 2 * n else np.uint32).astype("<u4").tobytes()
            for begin, end in zip(edges[:-1], edges[1:]):
                if begin < full:
                    sequence, origin = begin // SEQUENCE, begin - begin % SEQUENCE
                else:
                    place = max(i for i, t in enumerate(tail) if t <= begin)
                    sequence, origin = full // SEQUENCE + place, tail[place]
                rows.append((doc_id, begin - first, end - begin, own[4 * (begin - first):4 * (end - first)],
                             n, sequence, begin - origin))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece, with its ids (little-endian, 32 bits); pieces of a sequence
    follow each other by ``offset``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    coded = scratch.settle(docs.select("doc_id", "text").mapInArrow(_coded(tokenizer), CODED), "coded", "zstd")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = scratch.settle(
        coded.repartitionByRange(parts, "curve_key", "doc_id").sortWithinPartitions("curve_key", "doc_id")
        .mapInArrow(_placed, "doc_id bigint, n_tokens bigint, ids binary, part bigint, start_in_part bigint"),
        "ordered", "zstd")
    scratch.drop("coded")
    # One row per range partition: a count that the cluster's settings fix, not the data.
    totals = ordered.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    in_order = Window.orderBy("part")
    before = totals.select(
        "part", (F.sum("n").over(in_order) - F.col("n")).alias("before"),
        F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    return (ordered.join(F.broadcast(before), "part")
            .select("doc_id", "n_tokens", "ids", (F.col("before") + F.col("start_in_part")).alias("first"), "total")
            .mapInArrow(_cut, PIECES))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def ids_checksum(ids: list[int]) -> int:
    """What ``digests`` gives for a piece of these ids."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
