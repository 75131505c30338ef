"""Ranked lexical search by pipelined term partitioning.

The terms that any item asks for are dealt to owners by document frequency, the
rarest first.  Documents lie in blocks; of each block every owner holds a shard
(postings sorted by term).  Items travel in bundles: a bundle meets the shards
of one owner after the other by ``cogroup`` on (bundle, block) and carries, per
item, a sparse accumulator: the documents of the block that can still win, and
their integer sums so far.  After each owner the k-th highest sum of an item is
a lower bound of its final k-th score, so a document is let go only when its sum
plus all that later owners could add stays below that bound: nothing that can
be ranked is lost, and frequent terms open few new accumulators.  The last owner
returns k documents per item and block; a window picks the final k.

A block is bounded in documents and postings, a bundle in items, so no task
gathers more than these whatever a term's frequency: postings of a term in a
third of all documents are spread over all blocks.  The vocabulary of the items
meets the documents in an ordinary join (Spark broadcasts it below its limit).

Nulls and edge cases: a null text has no terms; such documents, and those
without any term, count for nothing and are never ranked.  Repeated rows of
documents are documents of their own.  Rows without a doc_id count like others
and are ranked last among equal scores.  Rows of items with one id (null
included) are one item with the union of their terms.  Items without terms, or
without a scored document, have no rows.  Empty tables give no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.arrays import in_small_batches, text_bytes
from paylens.llm.scratch import Scratch

#: Owners of terms: those in at most this share of the documents, then the rest.
OWNER_SHARES = (1 / 64, 1 / 16, 1 / 4)
#: Documents and postings of a block, items of a bundle.
BLOCK_DOCS, BLOCK_POSTINGS, BUNDLE_ITEMS = 2048, 400_000, 256
#: No term adds more than its weight times this.
MOST_PER_WEIGHT = 1_000_000

#: Terms are runs of letters, digits and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))

_COUNTED = "row bigint, id bigint, n bigint, terms array<string>, tfs array<int>"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each text with their occurrences; n counts all of them."""
    for batch in in_small_batches(batches, "text"):
        raw, at = text_bytes(batch.column("text"))
        data = raw.tobytes().translate(_FOLD)
        found = [Counter(data[b:e].split()) for b, e in zip(at[:-1].tolist(), at[1:].tolist())]
        ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        terms = pa.array(list(chain.from_iterable(found)), pa.string())
        tfs = pa.array(list(chain.from_iterable(f.values() for f in found)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id").cast(pa.int64()), pa.array([f.total() for f in found], pa.int64()),
             pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, tfs)],
            names=["row", "id", "n", "terms", "tfs"])


def _counted(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("id"),
                       "text").mapInArrow(_count_terms, _COUNTED)


_SHARDS = ("owner int, block bigint, ids array<bigint>, lengths array<bigint>, terms array<bigint>, "
           "starts array<int>, places array<int>, tfs array<bigint>")


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _schema(text: str) -> pa.Schema:
    """The Arrow schema of a list of columns in Spark's words."""
    fields = [f.split() for f in text.split(", ")]
    return pa.schema([(n, pa.list_(_ARROW[t[6:-1]]) if t.startswith("array") else _ARROW[t]) for n, t in fields])


def _shards(owners: int):
    """The postings of one block, packed per owner; a document's place is its rank in the block."""
    schema = _schema(_SHARDS)

    def run(key: tuple, postings: pa.Table) -> pa.Table:
        rows, first, place = np.unique(postings.column("row").to_numpy(), return_index=True, return_inverse=True)
        ids, lengths = (postings.column(c).take(pa.array(first)).to_pylist() for c in ("id", "m"))
        owner, term, tf = (postings.column(c).to_numpy() for c in ("owner", "term", "tf"))
        out = []
        for k in range(owners):
            own = np.flatnonzero(owner == k)
            own = own[np.lexsort((place[own], term[own]))]
            terms, starts = np.unique(term[own], return_index=True)
            out.append((k, key[0].as_py(), ids, lengths, terms, np.append(starts, len(own)), place[own], tf[own]))
        return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
    return run


def _list(table: pa.Table, name: str, row: int) -> np.ndarray:
    return table.column(name)[row].values.to_numpy(zero_copy_only=False)


_CARRIED = "item bigint, bundle bigint, block bigint, places array<int>, sums array<bigint>, best array<bigint>"
_PICKED = "item bigint, doc_id bigint, score bigint"


def _visit(k: int, last: bool):
    """One bundle at one owner's shard of one block."""
    schema = _schema(_PICKED if last else _CARRIED)

    def run(key: tuple, bundle: pa.Table, shard: pa.Table) -> pa.Table:
        if not bundle.num_rows:
            return schema.empty_table()
        items = bundle.column("item").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        ids = shard.column("ids")[0].values if shard.num_rows else pa.array([], pa.int64())
        if shard.num_rows:
            places, tf, terms, starts = (_list(shard, c, 0) for c in ("places", "tfs", "terms", "starts"))
            factor = 1_000_000_000 * tf // (1000 * tf + 8 * _list(shard, "lengths", 0)[places])
        for i in range(len(items)):
            total = np.zeros(len(ids), np.int64)
            total[_list(bundle, "places", i)] = _list(bundle, "sums", i)
            if shard.num_rows and len(terms):
                asked, weights = _list(bundle, "terms", i), _list(bundle, "weights", i)
                at = np.searchsorted(terms, asked)
                held = terms[np.minimum(at, len(terms) - 1)] == asked
                for t, w in zip(at[held].tolist(), weights[held].tolist()):
                    own = slice(starts[t], starts[t + 1])
                    total[places[own]] += w * factor[own]
            open_ = np.flatnonzero(total)
            sums = total[open_]
            bound = bundle.column("bound")[i].as_py()
            if len(sums) >= k:
                bound = max(bound, int(np.partition(sums, -k)[-k]))
            keep = sums + bundle.column("rest")[i].as_py() >= bound
            found.append((open_[keep], sums[keep]))
        if last:
            nulls, values = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy(zero_copy_only=False)
            chosen = [p[np.lexsort((values[p], nulls[p], -s))[:k]] for p, s in found]
            sums = [s[np.lexsort((values[p], nulls[p], -s))[:k]] for p, s in found]
            return pa.table([pa.array(np.repeat(items, [len(c) for c in chosen])),
                             ids.take(pa.array(np.concatenate(chosen))), pa.array(np.concatenate(sums))], schema=schema)
        columns = (items, np.full(len(items), key[0].as_py()), np.full(len(items), key[1].as_py()),
                   [p for p, _ in found], [s for _, s in found], [np.sort(s)[-k:] for _, s in found])
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of each item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    counted = scratch.settle(_counted(docs, "doc_id"), "counted", "zstd")
    asked = scratch.settle(
        _counted(items, "item_id").select("id", F.explode("terms").alias("name"))
        .groupBy("id").agg(F.collect_set("name").alias("names"))
        .withColumn("item", F.monotonically_increasing_id()), "asked")
    vocabulary = scratch.settle(
        asked.select(F.explode("names").alias("name")).distinct()
        .withColumn("term", F.monotonically_increasing_id()), "vocabulary")
    seen, occurrences = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    bundles = -(-asked.count() // BUNDLE_ITEMS)
    owners = len(OWNER_SHARES) + 1
    if not seen or not bundles:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")

    postings = scratch.settle(
        counted.select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
        .select("row", "id", "n", F.col("t.terms").alias("name"), F.col("t.tfs").cast("bigint").alias("tf"))
        .join(vocabulary, "name").drop("name"), "postings", "zstd")
    scratch.drop("counted")
    frequency = postings.groupBy("term").agg(F.count("*").alias("df"))
    owner = sum(((F.col("df") > share * seen).cast("int") for share in OWNER_SHARES), F.lit(0))
    weights = scratch.settle(frequency.select(
        "term", owner.alias("owner"),
        F.floor(1000 * F.log((2.0 * seen + 2) / (2.0 * F.col("df") + 1))).cast("bigint").alias("weight")), "weights")
    size = postings.agg(F.approx_count_distinct("row"), F.count("*")).first()
    blocks = max(1, -(-size[0] // BLOCK_DOCS), -(-size[1] // BLOCK_POSTINGS))
    shards = scratch.settle(
        postings.join(weights.select("term", "owner"), "term")
        .withColumn("m", F.expr(f"10 + (90 * n * {seen}L) div {occurrences}L"))
        .groupBy(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
        .applyInArrow(_shards(owners), _SHARDS), "shards", "zstd")
    scratch.drop("postings")

    plans = scratch.settle(
        asked.select("item", F.explode("names").alias("name")).join(vocabulary, "name").join(weights, "term")
        .groupBy("item").agg(F.collect_list(F.struct("owner", "term", "weight")).alias("plan"))
        .withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles))), "plans")
    carried = plans.select(
        "item", "bundle", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
        F.array().cast("array<int>").alias("places"), F.array().cast("array<bigint>").alias("sums"),
        F.array().cast("array<bigint>").alias("best"))
    for stage in range(owners):
        own = F.filter("plan", lambda t: t["owner"] == stage)
        later = F.filter("plan", lambda t: t["owner"] > stage)
        part = plans.select(
            "item", F.transform(own, lambda t: t["term"]).alias("terms"),
            F.transform(own, lambda t: t["weight"]).alias("weights"),
            (F.aggregate(later, F.lit(0).cast("bigint"), lambda s, t: s + t["weight"]) * MOST_PER_WEIGHT).alias("rest"))
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("sum")))
        bounds = (carried.select("item", F.explode("best").alias("sum")).withColumn("place", place)
                  .filter(F.col("place") == k).select("item", F.col("sum").alias("bound")))
        left = (carried.drop("best").join(part, "item").join(bounds, "item", "left")
                .withColumn("bound", F.coalesce("bound", F.lit(0).cast("bigint"))))
        right = shards.filter(F.col("owner") == stage).withColumn(
            "bundle", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bundles - 1).cast("bigint"))))
        last = stage == owners - 1
        visited = (left.groupBy("bundle", "block").cogroup(right.groupBy("bundle", "block"))
                   .applyInArrow(_visit(k, last), _PICKED if last else _CARRIED))
        following = scratch.settle(visited, f"carried{stage}")
        if stage:
            scratch.drop(f"carried{stage - 1}")
        carried = following

    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return (carried.withColumn("rank", rank).filter(F.col("rank") <= k)
            .join(asked.select("item", F.col("id").alias("item_id")), "item")
            .select("item_id", "rank", "doc_id", "score"))


def oracle(k: int = 10) -> str:
    """The same result in DuckDB SQL, scoring every document."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def terms(table: str) -> str:
        return f"regexp_extract_all(translate({table}.text, '{upper}', '{upper.lower()}'), '{TERM}')"

    return f"""with d as materialized (select row_number() over () as r, doc_id, {terms("documents")} as ts from documents
            where text is not null),
    s as (select count(*) filter (len(ts) > 0) as n_docs, sum(len(ts))::bigint as n_terms from d),
    tf as materialized (select r, t, count(*) as tf from (select r, unnest(ts) as t from d) group by r, t),
    df as (select t, floor(1000 * ln((2.0::double * n_docs + 2) / (2 * count(*) + 1)))::bigint as w
        from tf, s group by t, n_docs),
    q as (select distinct item_id, unnest({terms("benchmark")}) as t from benchmark),
    m as (select r, doc_id, 10 + (90 * len(ts) * n_docs) // n_terms as m from d, s),
    x as (select item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
        from q join df using (t) join tf using (t) join m using (r) group by item_id, r),
    k as (select item_id, doc_id, score,
        row_number() over (partition by item_id order by score desc, doc_id)::int as rank
        from x join m using (r) where score > 0)
    select item_id, rank, doc_id, score from k where rank <= {k}"""
