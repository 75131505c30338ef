"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Every document becomes its set of distinct word shingles (64-bit hashes).  One
permutation of the hash universe (sigma) removes structure; a second one (pi,
on 32-bit integers) is shifted circularly once per coordinate, so two
permutations give the whole signature:  h_k = min over s of pi(sigma(s) + k).

Documents with equal sets are merged first.  Bands of the signature put the
remaining representatives into buckets; bucket pairs are verified on full sets.
No pair list of a bucket is ever built: each bucket is compared with one
leader, the member with most company, and verified links are merged into components.  Buckets whose
other members lie in more than one component stay open.  Their documents are
compared by an exact prefix filter: shingles are ordered from rare to frequent
among them, and two sets can only reach the threshold if the first few of the
smaller set meet the first few of the larger one, with enough left behind.  Passages that many
documents share come last in that order, so they bring no candidates.  Either
way every pair that shares a bucket ends up linked, joined by other links, or
refused on its full sets.

Nulls and edge cases: a null or blank text has an empty set and links with
nothing.  Rows without an id link with nothing, have no component and are kept.
Rows with one id are one document: it links with whatever the set of any of
them links with.  Ties do not exist: every choice is the smallest id.  An empty table gives an empty result.  Further columns of the
input are ignored here; ``deduplicate`` returns them untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.arrays import in_small_batches, mix64, text_bytes, window_hashes, word_hashes
from paylens.llm.components import connected_components
from paylens.llm.scratch import Scratch

#: Rows per band and number of bands.  A pair at Jaccard 0.8 shares no band
#: with probability (1 - 0.8**5)**36, below one in a million.
BAND_ROWS, BANDS = 5, 36
COORDINATES = BAND_ROWS * BANDS
#: A pair goes on to exact verification unless its signatures agree in fewer
#: coordinates than six standard deviations below the threshold.
SIGMAS = 6.0


def _permute(x: np.ndarray) -> np.ndarray:
    """pi: a bijection of 32-bit integers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of one non-empty set."""
    sigma = (mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(COORDINATES, dtype=np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(sigma), 2048):
        block = _permute(sigma[begin:begin + 2048, None] + shifts)
        np.minimum(least, block.min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in coordinates.reshape(BANDS, BAND_ROWS).T:
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; fewer words than ``size`` count as one shingle."""
    raw, at = text_bytes(texts)
    words, begins = word_hashes(raw, at, lower=True)
    windows = window_hashes(words, size)
    for begin, end in zip(begins[:-1], begins[1:]):
        n = end - begin
        if n >= size:
            yield np.unique(windows[begin:end - size + 1])
        else:
            yield window_hashes(words[begin:end], int(n)) if n else np.zeros(0, np.uint64)


SKETCHES = ("id bigint, doc_id bigint, text_key string, n_shingles bigint, same binary, marks binary, "
            "bands array<bigint>")


def _sketch(size: int):
    schema = pa.schema([("id", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.string()),
                        ("n_shingles", pa.int64()), ("same", pa.binary()), ("marks", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small_batches(batches, "text"):
            counts, same, marks, bands = [], [], [], []
            for members in shingle_sets(batch.column("text"), size):
                counts.append(len(members))
                if len(members):
                    least = signature(members)
                    same.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                    marks.append((least & np.uint32(255)).astype(np.uint8).tobytes())
                    bands.append(band_keys(least))
                else:
                    same.append(None), marks.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("doc_id").cast(pa.int64()), batch.column("text_key"),
                 pa.array(counts, pa.int64()), pa.array(same, pa.binary()), pa.array(marks, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], schema=schema)
    return run


def _members(size: int):
    schema = pa.schema([("id", pa.int64()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"),
                 pa.array([m.tobytes() for m in shingle_sets(batch.column("text"), size)],
                          pa.binary())], schema=schema)
    return run


PAIRS = "lead bigint, id bigint"
_PAIR_SCHEMA = pa.schema([("lead", pa.int64()), ("id", pa.int64())])


def _kept_pairs(batch: pa.RecordBatch, keep: list[bool]) -> pa.RecordBatch:
    mask = pa.array(keep, pa.bool_())
    return pa.RecordBatch.from_arrays(
        [batch.column("lead").filter(mask), batch.column("id").filter(mask)], schema=_PAIR_SCHEMA)


def _plausible(percent: int):
    """Pairs whose signatures do not rule the threshold out."""
    t = percent / 100
    floor = COORDINATES * (t + (1 - t) / 256) - SIGMAS * (COORDINATES * t * (1 - t)) ** 0.5

    def run(batches):
        for batch in batches:
            a, b = batch.column("lead_marks").to_pylist(), batch.column("marks").to_pylist()
            yield _kept_pairs(batch, [
                np.count_nonzero(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= floor
                for x, y in zip(a, b)])
    return run


def _confirmed(percent: int):
    """Pairs whose full sets reach the threshold."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("lead_members"), batch.column("members")):
                a = np.frombuffer(x.as_buffer(), np.uint64)
                b = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield _kept_pairs(batch, keep)
    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and shingle."""
    schema = pa.schema([("shingle", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            sets = [np.frombuffer(m.as_buffer(), np.int64) for m in part.column("members")]
            sizes = np.array([len(m) for m in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sets)), pa.array(np.repeat(part.column("id").to_numpy(), sizes)),
                 pa.array(np.repeat(sizes, sizes))], schema=schema)


def _prefix_pairs(sets: DataFrame, components: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of ``sets`` in different components that may reach the threshold; none that does is missing.

    A pair with sizes a <= b needs an overlap of percent * (a + b) / (100 + percent),
    which is at least 2 * percent * a / (100 + percent) and percent * b / 100.
    So, in any one order of shingles, some common shingle lies among the first
    a - (first bound) + 1 of the smaller and b - (second bound) + 1 of the larger set.
    """
    rows = scratch.settle(sets.mapInArrow(_listed, "shingle bigint, id bigint, n bigint"), "listed")
    shared = rows.groupBy("shingle").agg(F.count("*").alias("seen")).filter("seen > 1")
    # Shingles of one document alone come first and match nothing: their number is enough.
    ranked = (rows.join(shared, "shingle").groupBy("id", "n")
              .agg(F.array_sort(F.collect_list(F.struct("seen", "shingle"))).alias("common"))
              .withColumn("alone", F.col("n") - F.size("common"))
              .join(components, "id", "left")
              .withColumn("comp", F.coalesce("component", "id")))

    def first(bound: str) -> DataFrame:
        length = F.expr(f"cast(n - ceil({bound}) + 1 - alone as int)")
        return (ranked.withColumn("length", length).filter("length > 0")
                .select("id", "n", "comp", "alone", F.posexplode(F.slice("common", 1, F.col("length"))))
                .select("id", "n", "comp", F.col("col.shingle").alias("shingle"),
                        (F.col("n") - F.col("alone") - F.col("pos")).alias("rest")))

    prefixes = scratch.settle(
        first(f"cast(2 * {percent} as decimal(20)) * n / {100 + percent}").withColumn("short", F.lit(True))
        .unionByName(first(f"cast({percent} as decimal(20)) * n / 100").withColumn("short", F.lit(False))),
        "prefixes")
    smaller = prefixes.filter("short").drop("short")
    larger = prefixes.filter("not short").select(
        "shingle", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"),
        F.col("rest").alias("rest2"))
    # The first common shingle must leave enough shingles (itself included) for the overlap.
    return (smaller.join(larger, "shingle")
            .filter(f"comp != comp2 and n <= n2 and n * 100 >= n2 * {percent} "
                    f"and least(rest, rest2) * {100 + percent} >= (n + n2) * {percent}")
            .select(F.least("id", "id2").alias("lead"), F.greatest("id", "id2").alias("id")).distinct())


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    ``size`` words make a shingle; documents link when 100 * intersection >=
    ``percent`` * union.  The component is the smallest doc_id reachable.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_key"), "text")
    # A node of the graph is a row, known by the id that it is written with.
    sketches = scratch.settle(
        texts.select(F.monotonically_increasing_id().alias("id"), "doc_id", "text_key", "text")
        .mapInArrow(_sketch(size), SKETCHES), "sketches")
    linkable = sketches.filter("doc_id is not null and n_shingles > 0")

    # Equal sets: every member of a class points at its row with the smallest doc_id.
    classes = linkable.groupBy("same").agg(F.min(F.struct("doc_id", "id")).alias("first"), F.count("*").alias("n"))
    # Written first, so both sides of the join are shuffled and a hot class can be split.
    several = scratch.settle(classes.filter("n > 1").select("same", F.col("first.id").alias("lead")), "classes")
    copies = scratch.settle(
        linkable.select("same", "id", "doc_id").join(several, "same")
        .filter("id != lead").select("lead", "id", "doc_id"), "copies")
    alone = linkable.join(copies.select("id"), "id", "left_anti")
    # Different sets of one doc_id are one document.
    nodes = alone.select("doc_id", "id").unionByName(copies.select("doc_id", F.col("lead").alias("id")))
    several_sets = (nodes.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("top"))
                    .filter("a < top").select("doc_id", "a"))
    of_one_id = scratch.settle(
        nodes.join(several_sets, "doc_id").filter("id != a").select("a", F.col("id").alias("b")).distinct(), "of-one-id")
    shown = alone.select("id", "n_shingles", "marks")
    buckets = scratch.settle(alone.select(F.explode("bands").alias("key"), "id"), "buckets")

    def verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        lead_sets = sets.select(F.col("id").alias("lead"), F.col("members").alias("lead_members"))
        return scratch.settle(pairs.join(sets, "id").join(lead_sets, "lead")
                              .mapInArrow(_confirmed(percent), PAIRS), name)

    def as_links(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("lead").alias("a"), F.col("id").alias("b"))

    # Every bucket against the document that meets most others over all its
    # buckets: in a group of edited copies, the one nearest to all.
    sizes = (buckets.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("top"), F.count("*").alias("size"))
             .filter("low < top").select("key", "size"))
    shared = scratch.settle(buckets.join(sizes, "key"), "shared")
    met = shared.groupBy("id").agg(F.sum("size").alias("met"))
    leaders = (shared.join(met, "id").groupBy("key")
               .agg(F.max(F.struct("met", (-F.col("id")).alias("against"))).alias("first"))
               .select("key", (-F.col("first.against")).alias("lead")))
    led = scratch.settle(shared.drop("size").join(leaders, "key").filter("id != lead"), "led")
    scratch.drop("buckets")
    # Full sets of all documents that share a bucket.  Merge joins, whatever the
    # size, so that the plan measured on a small input is the plan on a large one.
    asked = (led.select(F.explode(F.array("lead", "id")).alias("id")).distinct()
             .join(alone.select("id", "doc_id", "text_key"), "id"))
    sets = scratch.settle(
        texts.join(asked.hint("merge"), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
        .select("id", "text").mapInArrow(_members(size), "id bigint, members binary"), "sets")
    lead_shown = shown.select(F.col("id").alias("lead"), F.col("n_shingles").alias("lead_n"),
                              F.col("marks").alias("lead_marks"))
    near = (led.select("lead", "id").distinct().join(lead_shown, "lead").join(shown, "id")
            .filter(F.least("n_shingles", "lead_n") * 100
                    >= F.greatest("n_shingles", "lead_n") * percent)
            .select("lead", "id", "lead_marks", "marks"))
    plausible = scratch.settle(near.mapInArrow(_plausible(percent), PAIRS), "plausible")
    links = verified(plausible, sets, "links")
    components = connected_components(as_links(links), scratch, "first")

    # Buckets whose other members are not one component yet.
    rest = (led.select("key", "id").join(components, "id", "left")
            .select("key", "id", F.coalesce("component", "id").alias("comp")))
    mixed = (rest.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
             .filter("low < high").select("key"))
    open_ids = scratch.settle(rest.join(mixed, "key", "left_semi").select("id").distinct(), "open")
    open_sets = sets.join(open_ids, "id", "left_semi")
    pairs = scratch.settle(_prefix_pairs(open_sets, components, percent, scratch), "pairs")
    links = links.unionByName(verified(pairs, open_sets, "more_links"))
    components = connected_components(as_links(links).unionByName(of_one_id), scratch, "second")
    for name in ("shared", "led", "plausible", "sets", "listed", "prefixes", "pairs"):
        scratch.drop(name)

    # The smallest doc_id of a component; copies stand for their class.
    linked = alone.select("id", "doc_id").join(components, "id")
    lowest = linked.groupBy("component").agg(F.min("doc_id").alias("root"))
    in_component = linked.join(lowest, "component").select("id", "doc_id", "root")
    by_copy = (copies.join(alone.select(F.col("id").alias("lead"), F.col("doc_id").alias("lead_doc")), "lead")
               .join(in_component.select(F.col("id").alias("lead"), "root"), "lead", "left")
               .select("doc_id", F.coalesce("root", "lead_doc").alias("root")))
    roots = in_component.select("doc_id", "root").unionByName(by_copy)
    return (sketches.select("doc_id", "n_shingles")
            .join(roots.groupBy("doc_id").agg(F.min("root").alias("root")), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay: one of each group, the one with the smallest id, with all columns.

    Rows that repeat a kept id are one document; one of them stays.
    """
    found = near_duplicates(docs, size, percent)
    drop = found.filter("not kept").select("doc_id").distinct()
    kept = docs.join(drop, "doc_id", "left_anti").select(
        *["`" + c.replace("`", "``") + "`" for c in docs.columns])
    with_id = kept.filter("doc_id is not null").dropDuplicates(["doc_id"])
    return with_id.unionByName(kept.filter("doc_id is null"))
