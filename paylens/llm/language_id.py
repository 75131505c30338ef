"""Language identification in two levels.

A text becomes the counts of its hashed letter trigrams (UTF-8 bytes, ASCII in
lower case, everything that is no letter one blank).  Linear one-versus-one
support vector machines first choose the language family, then the language
among the family's learnt members.  They are trained on a bounded sample of
labelled rows, one task per machine; prediction adds up one weight per trigram
over the whole text.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with
score 0, and so is every text when nothing was learnt.  With one learnt
language all other texts are that language.  Rows without an id are predicted
but not learnt from; rows without a language are not learnt from.  Ties go to
the family or language first in alphabetical order.  Repeated rows get equal
predictions.  Extra columns are ignored by ``predict`` and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.arrays import in_small_batches, text_bytes
from paylens.llm.sampling import about, spread
from paylens.llm.scratch import bounded_batches

#: Language codes by family.  A code not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "uralic": ("et", "fi", "hu"),
    "semitic": ("am", "ar", "he", "mt"),
    "sinitic": ("zh", "yue"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

#: The labelled sample: expected rows per language, and the characters of a text
#: that are learnt from, in windows spread over a longer one.  Prediction has no
#: such bounds.
SAMPLE_PER_LANGUAGE, SAMPLE_MAX_CHARS = 1000, 32_768
BUCKETS = 1 << 13
PASSES, COST = 12, 1.0
#: ``accepted`` keeps texts whose score reaches this.
LEAST_SCORE = 0.5

UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def family_of(code: str) -> str:
    return _FAMILY_OF.get(code, code)


def trigram_buckets(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One bucket for each byte: its trigram, blank beyond the text's end; 0 if all blank."""
    folded = _FOLD[raw].astype(np.uint32)
    second, third = np.full(len(raw), 32, np.uint32), np.full(len(raw), 32, np.uint32)
    if len(raw):
        second[:-1], third[:-2] = folded[1:], folded[2:]
        ends = at[1:][np.diff(at) > 0]
        second[ends - 1] = third[ends - 1] = 32
        third[ends[np.diff(at)[np.diff(at) > 0] > 1] - 2] = 32
    code = folded << np.uint32(16) | second << np.uint32(8) | third
    h = code * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA77)
    h ^= h >> np.uint32(13)
    out = (h % np.uint32(BUCKETS - 1)).astype(np.int32) + 1
    out[code == 0x202020] = 0
    return out


@dataclass
class Model:
    """Weights of each machine: positive speaks for the first name of its pair."""

    languages: list[str] = field(default_factory=list)
    machines: dict[tuple[str, str, str], np.ndarray] = field(default_factory=dict)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for code in sorted(self.languages):
            out.setdefault(family_of(code), []).append(code)
        return out


def _vote(names: list[str], chances: dict[tuple[str, str], np.ndarray], n: int):
    """Index of the winner by votes, then by summed chance, and its least chance against another."""
    votes, sums, least = np.zeros((3, n, len(names)))
    least += 1.0
    for (a, b), p in chances.items():
        for name, q, won in ((a, p, p >= 0.5), (b, 1 - p, p < 0.5)):
            i = names.index(name)
            votes[:, i] += won
            sums[:, i] += q
            least[:, i] = np.minimum(least[:, i], q)
    best = np.argmax(votes * (len(names) + 1) + sums, axis=1)
    return best, least[np.arange(n), best]


def predict_texts(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The language and score of each text."""
    n = len(texts)
    raw, at = text_bytes(texts)
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    lettered = pc.match_substring_regex(filled, r"\p{L}").to_numpy(zero_copy_only=False)
    if not model.languages or not n:
        return [UNDETERMINED] * n, np.zeros(n)
    chances: dict[tuple[str, str, str], np.ndarray] = {}
    if model.machines:
        keys = list(model.machines)
        table = np.column_stack([model.machines[k] for k in keys])
        buckets = trigram_buckets(raw, at)
        sums = np.zeros((n, len(keys)))
        full = np.diff(at) > 0
        seen = np.zeros(n)
        if full.any():
            sums[full] = np.add.reduceat(table[buckets], at[:-1][full], axis=0)
            seen[full] = np.add.reduceat((buckets > 0).astype(np.float64), at[:-1][full])
        margins = sums / np.sqrt(np.maximum(seen, 1))[:, None]
        for i, key in enumerate(keys):
            chances[key] = 1 / (1 + np.exp(-np.clip(4 * margins[:, i], -30, 30)))
    members = model.members()
    families = sorted(members)
    family, family_chance = _vote(families, {k[1:]: p for k, p in chances.items() if k[0] == "*"}, n)
    names, scores = np.full(n, UNDETERMINED, object), np.zeros(n)
    for i, name in enumerate(families):
        best, chance = _vote(members[name], {k[1:]: p for k, p in chances.items() if k[0] == name}, n)
        here = (family == i) & lettered
        names[here] = np.array(members[name], object)[best[here]]
        scores[here] = (family_chance * chance)[here]
    return list(names), scores


def held_out() -> F.Column:
    """True for documents whose language is never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit-length sparse trigram counts of labelled texts."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.binary()), ("weight", pa.binary())])
    for batch in in_small_batches(batches, "text"):
        raw, at = text_bytes(batch.column("text"))
        buckets = trigram_buckets(raw, at)
        rows = []
        for begin, end in zip(at[:-1], at[1:]):
            counts = np.bincount(buckets[begin:end], minlength=BUCKETS)
            counts[0] = 0
            used = np.flatnonzero(counts)
            size = np.sqrt(float((counts[used].astype(np.float64) ** 2).sum())) or 1.0
            rows.append((used.astype(np.int32).tobytes(), (counts[used] / size).astype(np.float32).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").cast(pa.string()), pa.array([r[0] for r in rows], pa.binary()),
             pa.array([r[1] for r in rows], pa.binary())], schema=schema)


def train_machine(rows: list[tuple[bytes, bytes, int]]) -> np.ndarray:
    """A linear support vector machine by dual coordinate descent; labels are 1 and -1."""
    rows = sorted(rows)
    xs = [(np.frombuffer(b, np.int32), np.frombuffer(w, np.float32).astype(np.float64), y) for b, w, y in rows]
    many = {y: max(1, sum(1 for r in rows if r[2] == y)) for y in (1, -1)}
    limit = {y: COST * len(rows) / (2 * many[y]) for y in many}  # both sides weigh the same
    w, alpha = np.zeros(BUCKETS), np.zeros(len(xs))
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(xs)):
            at, x, y = xs[i]
            slope = y * (w[at] @ x) - 1
            new = min(max(alpha[i] - slope, 0.0), limit[y])  # rows have unit length
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y * x
                alpha[i] = new
    w[0] = 0
    return w


def fit(docs: DataFrame) -> Model:
    """Learn from a bounded sample of documents with a language that are not held out."""
    known = (bounded_batches(docs).select("doc_id", "text", "lang")
             .filter("lang is not null and text is not null and doc_id is not null")
             .filter(~held_out()))
    names = sorted(r[0] for r in known.select("lang").distinct().collect())
    members = Model(names).members()
    pairs = [("*", a, b) for a, b in combinations(sorted(members), 2)]
    pairs += [(name, a, b) for name, codes in members.items() for a, b in combinations(codes, 2)]
    if not pairs:
        return Model(names)
    # Each language's rows go to the machines that its family or itself is part of.
    of_language = {
        code: [(f"{g}|{a}|{b}", 1 if a in (code, family_of(code)) else -1) for g, a, b in pairs
               if (g == "*" and family_of(code) in (a, b)) or (g != "*" and code in (a, b))]
        for code in names}
    targets = F.create_map(*[x for code, uses in of_language.items() for x in (
        F.lit(code), F.array(*[F.struct(F.lit(m).alias("machine"), F.lit(y).alias("y")) for m, y in uses]))])

    def train(group: pd.DataFrame) -> pd.DataFrame:
        if group["y"].nunique() < 2:
            raise ValueError(f"No document to learn from on one side of {group['machine'].iloc[0]}.")
        w = train_machine(list(zip(group["bucket"], group["weight"], group["y"])))
        return pd.DataFrame({"machine": [group["machine"].iloc[0]], "w": [w.tobytes()]})

    sample = about(known, "lang", SAMPLE_PER_LANGUAGE, F.xxhash64("doc_id", F.lit("language")))
    trained = (sample.select(spread(F.col("text"), SAMPLE_MAX_CHARS).alias("text"), "lang").mapInArrow(_features, "lang string, bucket binary, weight binary")
               .select("bucket", "weight", F.inline(targets[F.col("lang")]))
               .groupBy("machine").applyInPandas(train, "machine string, w binary").collect())
    return Model(names, {tuple(r.machine.split("|")): np.frombuffer(bytes(r.w)) for r in trained})


def _predicted(model: Model):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small_batches(batches, "text"):
            names, scores = predict_texts(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores)],
                schema=schema)
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    return (bounded_batches(docs).select("doc_id", "text")
            .mapInArrow(_predicted(model), "doc_id bigint, lang_pred string, score double")
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))


def _accepted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small_batches(batches, "text"):
            names, scores = predict_texts(model, batch.column("text"))
            keep = (np.array(names, object) != UNDETERMINED) & (scores >= LEAST_SCORE)
            yield batch.filter(pa.array(keep.astype(bool)))
    return run


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents in a learnt language with a sufficient score, with all their columns."""
    return bounded_batches(docs).mapInArrow(_accepted(model), docs.schema)
