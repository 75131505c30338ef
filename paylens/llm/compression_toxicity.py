"""Toxicity by compression distance.

Two zstandard dictionaries are trained on windows of labelled documents.  The
ordinary one learns from windows of ordinary text.  A toxic document is mostly
ordinary text too, so the toxic one learns from its telling windows: the
stretches covered by byte n-grams far more frequent in toxic than in ordinary
documents.  It is as large as these windows have different bytes, within a
limit.  Both models share the ordinary content at equal offsets (zeros stand for
the toxic part of the ordinary one), so ordinary text compresses alike under
both, and a window's difference in compressed length speaks of toxic material
alone.

Before that, letters are recoded by their place in the word (a fixed
permutation per place), so both dictionaries match words from their beginning:
a syllable inside an ordinary word does not match a toxic word made of it.

Every text is covered whole by overlapping windows.  Shares of windows beyond
calibrated byte thresholds, the mean and the largest difference enter a
logistic calibration fitted on the same labelled sample.

Nulls and edge cases: null and empty texts are scored as one blank window.
Rows without an id are never learnt from and are scored like any other.
Repeated rows get equal scores.  Conflicting labels of one document count as
toxic.  Without labels of both kinds every score is 0; a label none of whose
documents can be learnt from is an error.  Extra columns are
ignored by ``score`` and kept by ``without_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.arrays import in_small_batches, text_bytes
from paylens.llm.sampling import about, spread
from paylens.llm.scratch import bounded_batches

#: The labelled sample: expected documents of each label, and the characters of
#: a text that are learnt from, in windows spread over a longer one.  Scoring
#: has no such bounds.
SAMPLE_PER_LABEL, SAMPLE_MAX_CHARS = 1500, 32_768
THRESHOLD = 0.7

WINDOW, STEP = 64, 32
#: Byte thresholds whose window shares are features.
BYTES = (3, 4, 5)
GRAM, GRAM_SPACE = 5, 1 << 22
#: Bytes of the ordinary dictionary, and at most of the toxic one.
ORDINARY_BYTES, TOXIC_BYTES = 8192, 8192
#: Windows of the sample that the ordinary dictionary is trained on, spread evenly.
ORDINARY_WINDOWS = 60_000
#: A gram is toxic at this ratio of document shares and this share of toxic documents.
RATIO, LEAST_SHARE, LEAST_DOCUMENTS = 8.0, 0.01, 4

#: Places of a word with a recoding of their own; later ones share the last.
PLACES = 16

_SEGMENT = np.dtype([("offset", "<u8"), ("length", "<u8")])
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[97:123] = False
_NO_LETTER[128:] = False


def _recodings() -> np.ndarray:
    letters = np.flatnonzero(~_NO_LETTER)
    tables = np.tile(np.arange(256, dtype=np.uint8), (PLACES, 1))
    for place in range(PLACES):
        tables[place, letters] = np.random.default_rng(place).permutation(letters)
    return tables


_RECODED = _recodings()


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def _grams(text: bytes) -> np.ndarray:
    """Hashed n-grams from each byte on; 0 where one would run over a word's end."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(len(raw) - GRAM + 1, 0)
    h = np.zeros(n, np.uint64)
    over = np.zeros(n, bool)
    for j in range(GRAM):
        h = h * np.uint64(0x100000001B3) + raw[j:j + n] + np.uint64(1)
        if 0 < j < GRAM - 1:
            over |= _NO_LETTER[raw[j:j + n].astype(np.uint8)]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    out = (h % np.uint64(GRAM_SPACE - 1)).astype(np.int64) + 1
    out[over] = 0
    return out


def _document_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(GRAM_SPACE, np.int32)
    for text in texts:
        counts[np.unique(_grams(text))] += 1
    counts[0] = 0
    return counts


def _telling_windows(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Stretches of toxic texts that are covered by toxic n-grams."""
    of_toxic, of_ordinary = _document_counts(toxic), _document_counts(ordinary)
    hot = of_toxic / len(toxic) > RATIO * (of_ordinary + 0.5) / len(ordinary)
    hot &= of_toxic >= max(LEAST_DOCUMENTS, LEAST_SHARE * len(toxic))
    windows: list[bytes] = []
    for text in toxic:
        here = hot[_grams(text)]
        if here.any():
            covered = np.zeros(len(text) + 2, np.int8)
            for j in range(GRAM):
                covered[1 + j:1 + j + len(here)] |= here
            edges = np.flatnonzero(np.diff(covered))
            windows += [text[b:e] for b, e in zip(edges[::2], edges[1::2])]
    return windows


def _dictionary(windows: list[bytes], size: int, d: int, k: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, windows, d=d, k=k).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: take it as it is
        return b"".join(windows)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        compression_level=3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0,
        write_checksum=0, write_dict_id=0, min_match=6, strategy=zstandard.STRATEGY_GREEDY)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def recoded(texts: list[bytes]) -> list[bytes]:
    """Texts in lower case between blanks, letters recoded by their place in the word."""
    if not texts:
        return []
    lengths = np.array([len(t) for t in texts], np.int64) + 2
    raw = np.frombuffer(b"".join(b" " + t.lower() + b" " for t in texts), np.uint8)
    index = np.arange(len(raw))
    place = index - np.maximum.accumulate(np.where(_NO_LETTER[raw], index, 0)) - 1
    out = _RECODED[np.clip(place, 0, PLACES - 1), raw].tobytes()
    ends = np.cumsum(lengths)
    return [out[e - n:e] for e, n in zip(ends.tolist(), lengths.tolist())]


def _window_count(lengths: np.ndarray) -> np.ndarray:
    return np.maximum(1, -(-(lengths - WINDOW) // STEP) + 1)


class Features:
    """Window features of texts under one pair of dictionaries."""

    def __init__(self, model: Model):
        self._pair = _compressor(model.ordinary), _compressor(model.toxic)

    def _differences(self, buffer: bytes, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        parts = [np.zeros(0, np.int64)]
        for at in range(0, len(begin), 50_000):
            first, last = int(begin[at]), int((begin + length)[at:at + 50_000].max())
            segments = np.zeros(len(begin[at:at + 50_000]), _SEGMENT)
            segments["offset"] = begin[at:at + 50_000] - first
            segments["length"] = length[at:at + 50_000]
            source = zstandard.BufferWithSegments(buffer[first:last], segments.tobytes())
            sizes = []
            for compressor in self._pair:
                packed = compressor.multi_compress_to_buffer(source, threads=1)
                sizes.append(np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(packed)))
            parts.append(sizes[0] - sizes[1])
        return np.concatenate(parts)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """One row of features for each recoded text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        counts = _window_count(lengths)
        ends = np.cumsum(lengths)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = np.repeat(ends - lengths, counts) + within * STEP
        length = np.minimum(WINDOW, np.repeat(ends, counts) - begin)
        x = self._differences(b"".join(texts), begin, length)
        edges = np.cumsum(counts) - counts
        shares = [np.add.reduceat((x >= t).astype(np.float64), edges) / counts for t in BYTES]
        mean = np.add.reduceat(x.astype(np.float64), edges) / counts
        most = np.maximum.reduceat(x, edges)
        return np.column_stack([np.minimum(mean, 2.0), *(s * (5 + 2.5 * i) for i, s in enumerate(shares)),
                                np.minimum(most, 12) / 6, np.ones(len(texts))])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1.0)
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))  # both labels weigh the same
    for _ in range(50):
        p = _chance(x, w)
        slope = x.T @ (share * (p - y)) + ridge * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _chance(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def train(rows: list[tuple[str, int]]) -> Model | None:
    """A model from (text, label) rows; their order has no influence."""
    rows = sorted(rows)
    rows = list(zip(recoded([text.encode() for text, _ in rows]), (label for _, label in rows)))
    toxic = [t for t, label in rows if label == 1]
    ordinary = [t for t, label in rows if label == 0]
    if not toxic or not ordinary:
        return None
    windows = [t[i:i + WINDOW] for t in ordinary for i in range(0, max(1, len(t) - WINDOW + 1), WINDOW)]
    base = _dictionary(windows[:: -(-len(windows) // ORDINARY_WINDOWS)], ORDINARY_BYTES, d=6, k=16)
    telling = _telling_windows(toxic, ordinary)
    size = min(max(sum(map(len, set(telling))), 256), TOXIC_BYTES)
    extra = _dictionary(telling, size, d=8, k=16) if telling else b""
    # Equal lengths keep the offsets of the shared content equal.
    model = Model(base + bytes(len(extra)), base + extra, ())
    features = Features(model)
    x = np.vstack([features([t]) for t, _ in rows])
    weights = _logistic(x, np.array([label for _, label in rows], float))
    return Model(model.ordinary, model.toxic, tuple(weights))


def held_out() -> F.Column:
    """True for documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from a bounded sample of labelled documents that are not held out."""
    known = (labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = about(known, "toxic", SAMPLE_PER_LABEL, F.xxhash64("doc_id", F.lit("toxicity")))
    # The sample is bounded by SAMPLE_PER_LABEL, hence the broadcast and the one task that learns from it.
    rows = (docs.select("doc_id", "text").filter("text is not null")
            .join(F.broadcast(chosen), "doc_id")
            .select(spread(F.col("text"), SAMPLE_MAX_CHARS).alias("text"), F.col("toxic").cast("int").alias("toxic")))
    learnt = bounded_batches(rows).repartition(1).mapInArrow(
        _trained, "labels array<int>, ordinary binary, toxic binary, weights array<double>").first()
    missing = {0, 1} - set(learnt.labels if learnt else ())
    if missing:
        missing &= {r.toxic for r in known.select("toxic").distinct().collect()}
        if missing and not docs.isEmpty():
            raise ValueError(f"No document to learn from has the toxic label {sorted(missing)}.")
        return None
    return Model(bytes(learnt.ordinary), bytes(learnt.toxic), tuple(learnt.weights))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The labels of all rows, and the model if there are both."""
    rows = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic")))]
    model = train(rows)
    yield pa.RecordBatch.from_arrays(
        [pa.array([sorted({label for _, label in rows})], pa.list_(pa.int32())),
         pa.array([model and model.ordinary], pa.binary()), pa.array([model and model.toxic], pa.binary()),
         pa.array([model and list(model.weights)], pa.list_(pa.float64()))],
        names=["labels", "ordinary", "toxic", "weights"])


def _scored(model: Model | None):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model) if model else None
        for batch in in_small_batches(batches, "text"):
            if features is None:
                scores = np.zeros(batch.num_rows)
            else:
                raw, at = text_bytes(batch.column("text"))
                data = raw.tobytes()
                scores = _chance(features(recoded([data[b:e] for b, e in zip(at[:-1], at[1:])])),
                                 np.array(model.weights))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(scores)], schema=schema)
    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    return (bounded_batches(docs).select("doc_id", "text").mapInArrow(_scored(model), "doc_id bigint, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")))


def _ordinary_only(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model) if model else None
        for batch in in_small_batches(batches, "text"):
            if features is not None:
                raw, at = text_bytes(batch.column("text"))
                data = raw.tobytes()
                chance = _chance(features(recoded([data[b:e] for b, e in zip(at[:-1], at[1:])])),
                                 np.array(model.weights))
                batch = batch.filter(pa.array(chance < THRESHOLD))
            yield batch
    return run


def without_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents scored below the threshold, with all their columns."""
    return bounded_batches(docs).mapInArrow(_ordinary_only(model), docs.schema)
