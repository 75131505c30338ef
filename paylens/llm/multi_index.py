"""Near-duplicate vectors through an inverted multi-index.

Only vectors of one label and one length are compared; each such group has an
index of its own.  Vectors are scaled to length one and cut in halves; each half
has its codebook, fitted in a task on a bounded sample of the group, and the
pairs of codewords form a grid of cells.  Every vector is stored in the cell of
its nearest codewords.  A search visits cells in the order of the summed
distances to their codewords (multi-sequence traversal over the two sorted
codebooks) and stops after the number of cells at which the target recall is
reached.  That number comes from the sample: each sampled vector is turned by
exactly the angle of the similarity in a random direction, the hardest partner a
link can have, and the partner's cell must be among those visited from either
side.  Real links are closer, so they are found more often; a group below
``2 * CELL_VECTORS`` vectors is one cell, and a target of 1 visits every cell.
Visits per vector stay the same however long the table is.

Equal vectors are merged first.  Cells are compared in blocks of bounded size
by a matrix product; a block pair returns one row per vector with links (their
number, and a root that stands for the vectors it is connected with), never the
pairs.  A crowded cell only means more block pairs, spread over tasks.

Nulls and edge cases: vectors that are null, empty, zero or hold null or
non-finite components, and rows without a label or an id link with nothing: no
links, their own id as component (null for a null id), kept.  Vectors of
different lengths never link.  Repeated rows of an id are one
vector.  Copies link with each other.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.components import connected_components
from paylens.llm.scratch import Scratch

#: Expected vectors of one group in the sample that its codebooks are fitted on.
SAMPLE = 20_000
#: Codewords per half: so many that a cell holds about this many vectors, within a limit.
CELL_VECTORS, MOST_WORDS = 400, 1024
#: Share of hardest partners that the traversal must reach.
TARGET_RECALL = 0.999
#: Vectors whose cells one task looks up at once.
LOOKUP = 4096
#: Vectors on either side of one comparison.
BLOCK = 1024


def _prepared(kind: str):
    """Vectors as bytes of ``kind``, the type they came in; null when they cannot link."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("dim", pa.int64()),
                        ("digest", pa.binary()), ("vector", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, vectors, dims = [], [], []
            for item in batch.column("embedding"):
                if item.is_valid and not item.values.null_count:
                    x = item.values.to_numpy(zero_copy_only=False).astype(kind)
                    if len(x) and np.isfinite(x).all() and x.any():
                        data = (x + x.dtype.type(0)).tobytes()  # -0.0 becomes 0.0
                        digests.append(hashlib.blake2b(data, digest_size=16).digest())
                        vectors.append(data)
                        dims.append(len(x))
                        continue
                digests.append(None), vectors.append(None), dims.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").cast(pa.int64()), batch.column("label").cast(pa.int64()),
                 pa.array(dims, pa.int64()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())],
                schema=schema)
    return run


def unit(vectors: list, dim: int, kind: str = "f8") -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), kind).reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _squares(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None], 0)


def codebook(x: np.ndarray, size: int) -> np.ndarray:
    """k-means on the rows of ``x``, which must be in a fixed order."""
    x = np.unique(x, axis=0)
    words = x[np.random.default_rng(5).permutation(len(x))[:size]].copy()
    for _ in range(12):
        near = _squares(x, words).argmin(axis=1)
        for k in range(len(words)):
            if (near == k).any():
                words[k] = x[near == k].mean(axis=0)
    return np.unique(words, axis=0)


class MultiIndex:
    """Two codebooks, and for a vector the cells worth visiting, its own first."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int):
        self.books = first, second
        self.visits = visits

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def locate(self, x: np.ndarray, visits: int | None = None) -> np.ndarray:
        """One row per row of ``x``: the nearest cells, nearest first."""
        cut = self.books[0].shape[1]
        visits = min(visits or self.visits, self.cells)
        out = np.zeros((len(x), visits), np.int64)
        for at in range(0, len(x), 256):
            low1, low2 = _squares(x[at:at + 256, :cut], self.books[0]), _squares(x[at:at + 256, cut:], self.books[1])
            order1, order2 = np.argsort(low1, axis=1, kind="stable"), np.argsort(low2, axis=1, kind="stable")
            for row, (a, b, i, j) in enumerate(zip(low1, low2, order1, order2), at):
                out[row] = self._traverse(a[i].tolist(), b[j].tolist(), i, j, visits)
        return out

    def _traverse(self, a: list, b: list, i: np.ndarray, j: np.ndarray, visits: int) -> list[int]:
        """Multi-sequence traversal of the sums a[p] + b[q], both sorted."""
        found, heap, width = [], [(a[0] + b[0], 0, 0)], len(b)
        while len(found) < visits:
            _, p, q = heapq.heappop(heap)
            found.append(int(i[p]) * width + int(j[q]))
            # (p, q) is reached from (p, q - 1); the first column also from above.
            if q + 1 < width:
                heapq.heappush(heap, (a[p] + b[q + 1], p, q + 1))
            if not q and p + 1 < len(a):
                heapq.heappush(heap, (a[p + 1] + b[0], p + 1, 0))
        return found


def hardest_partners(x: np.ndarray, similarity: float) -> np.ndarray:
    """Each row turned by exactly the angle of ``similarity``, in a fixed random direction."""
    side = np.random.default_rng(3).normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    size = np.sqrt((side * side).sum(axis=1, keepdims=True))
    return similarity * x + np.sqrt(max(0.0, 1 - similarity ** 2)) * side / np.where(size > 0, size, 1)


def fit(x: np.ndarray, total: int, similarity: float, target_recall: float) -> MultiIndex:
    """Codebooks of a group of ``total`` vectors from a sample ``x`` in a fixed order."""
    words = int(np.clip(round((total / CELL_VECTORS) ** 0.5), 1, MOST_WORDS))
    cut = x.shape[1] // 2
    first = codebook(x[:, :cut], words) if cut else np.zeros((1, 0))
    index = MultiIndex(first, codebook(x[:, cut:], words), 1)
    if target_recall >= 1:
        index.visits = index.cells
        return index
    x = x[:2000]
    y, most = hardest_partners(x, similarity), min(index.cells, 64)
    while True:
        near, far = index.locate(x, most), index.locate(y, most)
        met = (near == far[:, :1]) | (far == near[:, :1])
        rank = np.where(met.any(axis=1), met.argmax(axis=1), index.cells)
        index.visits = int(np.sort(rank)[int(np.ceil(target_recall * len(rank))) - 1]) + 1
        if index.visits <= most or most == index.cells:
            return index
        most = min(index.cells, 8 * most)


FITTED = "label bigint, dim bigint, first binary, second binary, words bigint, visits bigint"


def _fitted(similarity: float, target_recall: float, kind: str):
    schema = pa.schema([("label", pa.int64()), ("dim", pa.int64()), ("first", pa.binary()), ("second", pa.binary()),
                        ("words", pa.int64()), ("visits", pa.int64())])

    def run(key: tuple, sample: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        x = unit(sorted(sample.column("vector").to_pylist()), dim, kind)
        index = fit(x, sample.column("total")[0].as_py(), similarity, target_recall)
        return pa.table([[key[0].as_py()], [dim], [index.books[0].tobytes()], [index.books[1].tobytes()],
                         [len(index.books[0])], [index.visits]], schema=schema)
    return run


INDEXED = "id bigint, label bigint, dim bigint, copies bigint, vector binary, cell bigint, visits array<bigint>"


def _indexed(kind: str):
    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int64()), ("copies", pa.int64()),
                        ("vector", pa.binary()), ("cell", pa.int64()), ("visits", pa.list_(pa.int64()))])

    def run(key: tuple, rows: pa.Table, books: pa.Table) -> pa.Table:
        visits = np.zeros((rows.num_rows, 1), np.int64)
        if books.num_rows and rows.num_rows:
            dim = key[1].as_py()
            book = books.slice(0, 1).to_pylist()[0]
            index = MultiIndex(np.frombuffer(book["first"]).reshape(book["words"], dim // 2),
                               np.frombuffer(book["second"]).reshape(-1, dim - dim // 2), book["visits"])
            visits = index.locate(unit(rows.column("vector").to_pylist(), dim, kind))
        return pa.table([*(rows.column(c) for c in ("id", "label", "dim", "copies", "vector")), pa.array(visits[:, 0]),
                         pa.array(list(visits), pa.list_(pa.int64()))], schema=schema)
    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest connected position of each of ``n`` positions under links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


LINKED = "id bigint, n_links bigint, root bigint"
_LINKED_SCHEMA = pa.schema([("id", pa.int64()), ("n_links", pa.int64()), ("root", pa.int64())])


def _compared(similarity: float, kind: str):
    """Links between two blocks: per vector their number and a root."""
    def run(key: tuple, queries: pa.Table, members: pa.Table) -> pa.Table:
        if not queries.num_rows or not members.num_rows:
            return _LINKED_SCHEMA.empty_table()
        ids = [t.column("id").to_numpy() for t in (queries, members)]
        copies = [t.column("copies").to_numpy() for t in (queries, members)]
        x, y = (unit(t.column("vector").to_pylist(), key[1].as_py(), kind) for t in (queries, members))
        own, cell = queries.column("own").to_numpy(), key[2].as_py()
        back = members.column("visits").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
        a, b = np.nonzero(x @ y.T >= similarity - 1e-12)
        # Close to the threshold the sums are formed pair by pair, in one order.
        exact = (x[a] * y[b]).sum(axis=1)
        # Two cells that visit each other compare a pair in the smaller one only.
        twice = (own[a] < cell) & (back[b] == own[a][:, None]).any(axis=1)
        keep = (exact >= similarity) & (ids[0][a] != ids[1][b]) & ~twice
        a, b = a[keep], b[keep]
        # Inside one cell both ends are queries; between cells the other end is counted here.
        both = own[a] != cell
        counts = (np.bincount(a, copies[1][b], len(x)), np.bincount(b[both], copies[0][a[both]], len(y)))
        all_ids = np.concatenate(ids)
        order, position = np.unique(all_ids, return_inverse=True)
        used = np.unique(position[np.concatenate([a, b + len(x)])])
        root = order[_roots(len(order), position[a], position[b + len(x)])]
        links = np.bincount(position, np.concatenate(counts), len(order))
        return pa.table({"id": order[used], "n_links": links[used].astype(np.int64), "root": root[used]},
                        schema=_LINKED_SCHEMA)
    return run


def near_duplicates(vectors: DataFrame, similarity: float = 0.98,
                    target_recall: float = TARGET_RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "multi-index")
    kind = "f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "f8"
    rows = scratch.settle(vectors.select("vec_id", "label", "embedding").mapInArrow(
        _prepared(kind), "vec_id bigint, label bigint, dim bigint, digest binary, vector binary"), "rows")
    usable = rows.filter("vec_id is not null and label is not null and vector is not null")
    classes = scratch.settle(
        usable.groupBy("label", "dim", "digest").agg(
            F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("copies"),
            F.first("vector").alias("vector")), "classes")
    group = ["label", "dim"]
    totals = scratch.settle(classes.groupBy(*group).agg(F.count("*").alias("total")), "totals")
    grouped = classes.join(totals, group)
    # Smaller groups are one cell.  The sample of a group is bounded, whatever its share of the table.
    sample = grouped.filter(F.col("total") > 2 * CELL_VECTORS).filter(
        F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) <= F.least(F.lit(1.0), SAMPLE / F.col("total")) * (1 << 30))
    books = scratch.settle(sample.select(*group, "vector", "total").groupBy(*group).applyInArrow(
        _fitted(similarity, target_recall, kind), FITTED), "books")
    parts = F.ceil(F.col("total") / LOOKUP)
    looked_up = grouped.withColumn("part", F.pmod(F.xxhash64("id"), parts)).drop("total")
    offered = (books.join(totals, group).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
               .drop("total"))
    offered = offered.toDF(*offered.columns)  # names of their own: both sides come from the same tables
    indexed = scratch.settle(
        looked_up.groupBy(*group, "part").cogroup(offered.groupBy(*group, "part"))
        .applyInArrow(_indexed(kind), INDEXED), "indexed")

    place = [*group, "cell"]
    members = indexed.select(*(F.col(c).alias(f"m_{c}") for c in (*place, "id", "copies", "vector", "visits"))).toDF(
        *place, "id", "copies", "vector", "visits")
    visits = indexed.select(*group, F.explode("visits").alias("cell"), "id", "copies", "vector",
                            F.col("cell").alias("own"))
    # Blocks per cell, from counts; cells without members or queries drop out.
    stored = members.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).alias("m_blocks"))
    asked = (indexed.select(*group, F.explode("visits").alias("cell")).groupBy(*place)
             .agg(F.ceil(F.count("*") / BLOCK).alias("q_blocks")))
    blocks = scratch.settle(stored.join(asked, place), "blocks")

    def spread(side: DataFrame, own: str, other: str, mine: str, its: str) -> DataFrame:
        return (side.join(blocks, place)
                .withColumn(mine, F.pmod(F.xxhash64("id"), F.col(own)))
                .withColumn(its, F.explode(F.sequence(F.lit(0), F.col(other) - 1))))

    key = [*place, "q", "m"]
    left = spread(visits, "q_blocks", "m_blocks", "q", "m").select(*key, "id", "copies", "vector", "own")
    right = spread(members, "m_blocks", "q_blocks", "m", "q").select(*key, "id", "copies", "vector", "visits")
    linked = scratch.settle(
        left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_compared(similarity, kind), LINKED), "linked")
    components = connected_components(
        linked.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch, "links")
    per_class = (indexed.select("id", "copies", "label", "dim")
                 .join(linked.groupBy("id").agg(F.sum("n_links").alias("others")), "id", "left")
                 .join(components, "id", "left")
                 .select(F.col("id").alias("class"), "label", "dim",
                         (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
                         F.coalesce("component", "id").alias("component")))
    per_vector = (usable.select("vec_id", *group, "digest").distinct()
                  .join(classes.select(*group, "digest", F.col("id").alias("class")), [*group, "digest"])
                  .join(per_class, ["class", *group])
                  .groupBy("vec_id").agg(F.max("links").alias("links"), F.min("component").alias("component")))
    return (rows.select("vec_id").join(per_vector, "vec_id", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def oracle(similarity: float = 0.98) -> str:
    """The same result in DuckDB SQL, comparing every pair of one label and length."""
    return f"""with recursive v as materialized (select vec_id, label, embedding::double[] as e,
            len(embedding) as n from embeddings
        where vec_id is not null and label is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l as materialized (select a.vec_id as a, b.vec_id as b from v a join v b
        on a.label = b.label and a.n = b.n and a.vec_id <> b.vec_id
        and list_cosine_similarity(a.e, b.e) >= {similarity}),
    r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
    c as (select a, min(b) as low from r group by a), k as (select a, count(*) as links from l group by a)
    select vec_id, coalesce(links, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id,
        vec_id = least(vec_id, coalesce(low, vec_id)) as kept
    from embeddings left join k on k.a = vec_id left join c on c.a = vec_id"""
