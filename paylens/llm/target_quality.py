"""Quality by hashed n-gram likelihood ratio, after word-based rules.

Two multinomials over hashed byte n-grams are counted over the whole corpus:
one from trusted documents, one from all.  A document's score is the mean over
its n-grams of the logarithm of their ratio (so length does not matter); it is
kept when the score reaches a fixed threshold and the base rules do not fail.

Counting joins the documents with the trusted ids once and adds up one fixed
array per task; the table of counts has ``BUCKETS`` rows whatever the input.
Scoring needs no shuffle.

Nulls and edge cases: a null text has no words and fails the base rules.
Texts shorter than one n-gram score 0.  Rows without an id belong to the
corpus, not to the trusted part.  Repeated rows count as often as they occur
and are judged alike.  Without trusted documents every score is 0.  Ties with
the threshold are kept.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.arrays import in_small_batches, text_bytes, window_hashes, word_hashes
from paylens.llm.scratch import bounded_batches

GRAM, BUCKETS = 4, 1 << 15
#: Added to every count of both multinomials.
SMOOTHING = 1.0
#: Mean log ratio from which a document is kept.
THRESHOLD = -0.5

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, WINDOW, REPEAT_PERCENT = 50, 3, 50

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1
_SPACES = b" \t\n\x0b\x0c\r"


def gram_buckets(raw: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram from each byte on."""
    n = max(len(raw) - GRAM + 1, 0)
    code = np.zeros(n, np.uint32)
    for j in range(GRAM):
        code = code << np.uint32(8) | raw[j:j + n]
    code = code * np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    return (code >> np.uint32(17)).astype(np.int64)


def _inside(at: np.ndarray) -> np.ndarray:
    """Which n-grams of the joined texts do not run over a text's end."""
    n = max(int(at[-1]) - GRAM + 1, 0)
    ok = np.ones(int(at[-1]), bool)
    for j in range(1, GRAM):
        over = at[1:] - j
        ok[over[over >= at[:-1]]] = False
    return ok[:n]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in in_small_batches(batches, "text"):
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
        raw, at = text_bytes(batch.column("text"))
        buckets, ok = gram_buckets(raw), _inside(at)
        counts[0] += np.bincount(buckets[ok], minlength=BUCKETS)
        ok &= np.repeat(trusted, np.diff(at))[:len(ok)]
        counts[1] += np.bincount(buckets[ok], minlength=BUCKETS)
    used = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], names=["bucket", "corpus", "target"])


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """log(trusted share / corpus share) per bucket; ``trusted`` has a column doc_id."""
    texts = bounded_batches(docs).select("doc_id", "text").filter("text is not null")
    ids = trusted.select("doc_id").filter("doc_id is not null").distinct().withColumn("trusted", F.lit(True))
    # A merge join whatever the size, so that the plan measured on a small input
    # is the plan on a large one; it is the only time that texts move.
    flagged = texts.filter("doc_id is not null").join(ids.hint("merge"), "doc_id", "left")
    rows = flagged.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")).unionByName(
        texts.filter("doc_id is null").select("text", F.lit(False).alias("trusted")))
    counts = (rows.mapInArrow(_counted, "bucket bigint, corpus bigint, target bigint")
              .groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target")))
    found = counts.toPandas()  # at most BUCKETS rows
    table = np.zeros((2, BUCKETS))
    table[0, found["bucket"]], table[1, found["bucket"]] = found["corpus"], found["target"]
    if not table[1].sum():
        return np.zeros(BUCKETS)
    share = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(share[1]) - np.log(share[0])


def _repeated_words(words: np.ndarray) -> int:
    """Words lying in a window of WINDOW words that occurs twice or more."""
    windows = window_hashes(words, WINDOW)
    if len(windows) < 2:
        return 0
    _, which, seen = np.unique(windows, return_inverse=True, return_counts=True)
    again = seen[which] > 1
    covered = np.zeros(len(words), bool)
    for j in range(WINDOW):
        covered[j:j + len(again)] |= again
    return int(covered.sum())


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def _judged(ratios: np.ndarray, threshold: float):
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = np.ones(256, np.int64)  # first bytes of characters that are no space
        letter[0x80:0xC0] = 0
        letter[list(_SPACES)] = 0
        for batch in in_small_batches(batches, "text"):
            raw, at = text_bytes(batch.column("text"))
            data = raw.tobytes()
            words, begins = word_hashes(raw, at, lower=False)
            n = np.diff(begins)

            def summed(values: np.ndarray) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(values)])[at])

            ok = _inside(at)
            gains, grams = np.zeros(len(raw)), np.zeros(len(raw), np.int64)
            gains[:len(ok)] = ratios[gram_buckets(raw)] * ok
            grams[:len(ok)] = ok
            full = np.diff(at) > 0
            score = np.zeros(batch.num_rows)
            if full.any():  # reduceat adds within each text, whatever texts lie around it
                score[full] = (np.add.reduceat(gains, at[:-1][full])
                               / np.maximum(np.add.reduceat(grams, at[:-1][full]), 1))
            repeats = np.array([_repeated_words(words[b:e]) for b, e in zip(begins[:-1], begins[1:])], np.int64)
            lines = np.array([_repeated_lines(data[b:e]) for b, e in zip(at[:-1], at[1:])], np.int64)
            failed = (n < LEAST_WORDS) | (100 * repeats > REPEAT_PERCENT * n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(summed(letter[raw])),
                 pa.array(summed(_SYMBOL[raw])), pa.array(lines), pa.array(repeats), pa.array(failed),
                 pa.array(~failed & (score >= threshold)), pa.array(score)], schema=schema)
    return run


JUDGED = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, score double")


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Word counts, base rules, score and verdict of every document."""
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(_judged(ratios, threshold), JUDGED)
