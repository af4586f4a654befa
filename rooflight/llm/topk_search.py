"""Exact top-k search by inner product, with a ball tree per shard.

Vectors are spread over shards of bounded size; each shard becomes one written row that holds a ball
tree. Queries are packed into blocks. First every block searches the shard of its own queries, which gives
each query a k-th score; then it goes to all groups of shards. A task reads the trees of a group once and
then streams the blocks past them: a block's queries drop every leaf whose upper bound on the inner product,
centre * q + radius * |q|, falls short of their k-th score (or ties with it and holds larger ids only).
Leaves are visited best bounds first, one matrix product for all queries that still need a leaf, and the
k-th scores rise from tree to tree. So trees travel once, blocks once a group, and rows never meet in a join.

Edge cases: vectors that are null or hold a null, NaN or infinite component take no part, nor do rows
with a null id; shorter vectors count as padded with zeros; repeated rows are candidates of their own,
repeated queries (same id) give one list, from the smallest vector; a query never meets a row of its
own id; scores beyond a long are cut to its range; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rooflight.llm.shared import written

#: Rows of a shard at most (fewer of long vectors, for SHARD_CELLS), and the shards of a group.
SHARD_ROWS = 16_384
SHARD_CELLS = 1 << 20
GROUP_SHARDS = 16
MIN_SHARDS = 16
BLOCK_QUERIES = 1_024
LEAF = 128
_FOUND = "query_id long, vec_id long, score long"
_PACKED = "shard int, blob binary"
_EXACT = {np.float32: float(1 << 24), np.float64: float(1 << 53)}
_LEAST = float(-(1 << 63))


class BallTree:
    """Nodes split at the median of the widest axis; a leaf's rows are contiguous. Node 0 is the root."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order, spans, kids = np.arange(len(ids)), [(0, len(ids))], [(-1, -1)]
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = spans[node]
            if b - a <= LEAF:
                continue
            part = order[a:b]
            axis = np.argmax(np.ptp(rows[part], axis=0))
            mid = (a + b) // 2
            order[a:b] = part[np.argpartition(rows[part, axis], mid - a)]
            kids[node] = (len(spans), len(spans) + 1)
            spans += [(a, mid), (mid, b)]
            kids += [(-1, -1), (-1, -1)]
            todo += [len(spans) - 2, len(spans) - 1]
        self.ids, self.rows = ids[order], rows[order]
        self.spans = np.array([s for s, (left, _) in zip(spans, kids, strict=True) if left < 0], np.int64)  # of the leaves
        parts = [self.rows[a:b] for a, b in self.spans]
        self.centres = np.stack([x.mean(axis=0) for x in parts])
        self.radii = np.array([np.sqrt(((x - c) ** 2).sum(axis=1).max()) for x, c in zip(parts, self.centres, strict=True)])
        self.low_id = np.array([self.ids[a:b].min() for a, b in self.spans])
        self.longest = float(np.sqrt((self.rows**2).sum(axis=1).max()))
        if self.longest < _EXACT[np.float32]:  # whole numbers that a single holds
            self.rows = self.rows.astype(np.float32)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds (queries x leaves) on the inner product, with room for rounding."""
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        size = np.sqrt((self.centres**2).sum(axis=1))[None, :] + self.radii[None, :]
        return np.maximum(queries @ self.centres.T + length * self.radii[None, :] + 1e-9 * length * size, _LEAST)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, best: list[list[tuple]]) -> None:
        """Put what is better into ``best``, a heap of up to k (score, -id) of each query."""
        if not len(queries):
            return
        kind = self._exact(queries)
        top, q = self.bounds(queries), queries.astype(kind)
        kth = np.array([h[0][0] if len(h) == k else -np.inf for h in best], kind)
        kth_id = np.array([-h[0][1] if len(h) == k else 0 for h in best], np.int64)
        for leaf in np.argsort(-top.max(axis=0), kind="stable").tolist():
            line = top[:, leaf]
            # within one of the k-th score it can tie at most, and loses every tie to smaller ids
            ask = np.flatnonzero((line >= kth) & ~((line < kth + 1) & (self.low_id[leaf] > kth_id)))
            if not len(ask):
                continue
            a, b = self.spans[leaf]
            ids = self.ids[a:b]
            if kind is object:
                scores = np.stack([_big(self.rows[a:b], x) for x in queries[ask]])
            else:
                scores = q[ask] @ self.rows[a:b].astype(kind, copy=False).T
            least = kth[ask]
            if kind is not object and b - a > k and np.isinf(least).any():
                others = np.where(ids[None, :] == query_ids[ask, None], -np.inf, scores)
                least = np.maximum(least, np.partition(others, -k, axis=1)[:, -k])
            for i, j in zip(*np.nonzero(scores >= least[:, None]), strict=True):
                n, hit = ask[i], (int(scores[i, j]), -int(ids[j]))
                if -hit[1] == query_ids[n]:
                    continue
                if len(best[n]) < k:
                    heapq.heappush(best[n], hit)
                elif hit > best[n][0]:
                    heapq.heapreplace(best[n], hit)
            for n in ask.tolist():
                if len(best[n]) == k:
                    kth[n], kth_id[n] = best[n][0][0], -best[n][0][1]

    def _exact(self, queries: np.ndarray) -> type:
        """The type that holds all products and their sums, which are whole numbers: no sum exceeds the product of the lengths."""
        most = float(np.sqrt((queries**2).sum(axis=1).max())) * self.longest
        most = max(most, float(np.abs(queries).max(initial=0)), self.longest) * 1.001
        return next((t for t, limit in _EXACT.items() if most < limit), object)


def _big(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    most = (1 << 63) - 1
    whole = [int(x) for x in query]
    return np.array([max(-most - 1, min(most, sum(int(x) * y for x, y in zip(r, whole, strict=True)))) for r in rows], dtype=object)


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): 256 x of every component (the search rounds down), without the vectors that take no part."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(embedding, lambda x: x.cast("double") * 256)
    return vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & fine).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v")
    )


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return np.floor(out)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest scores of each query, ties to the smaller id.

    Both inputs as :func:`quantised` gives them.
    """
    n, dim = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = max(1, dim or 1, queries.agg(F.max(F.size("v"))).first()[0] or 1)
    shards = max(MIN_SHARDS, -(-n // max(1, min(SHARD_ROWS, SHARD_CELLS // dim))))
    groups = max(MIN_SHARDS, -(-shards // GROUP_SHARDS))

    def packed(pdf: pd.DataFrame, what) -> pd.DataFrame:
        return pd.DataFrame({"shard": [pdf.shard.iat[0]], "blob": [pickle.dumps(what)]})

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        return packed(pdf, BallTree(pdf.vec_id.to_numpy(np.int64), _matrix(pdf.v, dim)))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        points = _matrix(pdf.v, dim)
        small = np.abs(points).max() < _EXACT[np.float32]
        return packed(pdf, (pdf.vec_id.to_numpy(np.int64), points.astype(np.float32) if small else points, [[] for _ in range(len(pdf))]))

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks with the best of their own shard, whose tree comes before them."""
        tree, of = None, None
        for _, shard, what in _rows(batches):
            if isinstance(what, BallTree):
                tree, of = what, shard
                continue
            ids, points, best = what
            if of == shard:
                tree.search(ids, points.astype(np.float64), k, best)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "blob": [pickle.dumps((ids, points, best))]})

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the trees of a group, which come before the blocks, add to each block's best."""
        trees, of = [], None
        for group, shard, what in _rows(batches):
            if of != group:
                trees, of = [], group
            if isinstance(what, BallTree):
                trees.append((shard, what))
                continue
            ids, points, best = what
            floor = [{*h} if len(h) == k else set() for h in best]
            now, points = [[min(h)] * k if len(h) == k else [] for h in best], points.astype(np.float64)
            for other, tree in trees:
                if other != shard:
                    tree.search(ids, points, k, now)
            yield _hits(ids, [set(h) - f for h, f in zip(now, floor, strict=True)])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["blob"]:
                ids, _, best = pickle.loads(blob.as_py())
                yield _hits(ids, best)

    def streamed(trees: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
        """The trees of each key and then its blocks, in one task."""
        both = trees.select(key, F.lit(0).alias("kind"), "shard", "blob").toDF("key", "kind", "shard", "blob")
        both = both.union(blocks.select(key, F.lit(1).alias("kind"), "shard", "blob"))
        return both.repartition("key").sortWithinPartitions("key", "kind")

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    trees = written(vectors.withColumn("shard", shard).groupBy("shard").applyInPandas(plant, _PACKED), "trees")
    # Each query starts in a shard of its own number; blocks of a shard have a bounded number of queries.
    asked = written(queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("shard", shard), "queries")
    blocks = max(1, -(-asked.count() // (BLOCK_QUERIES * shards)))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    first = asked.withColumn("block", block).groupBy("shard", "block").applyInPandas(pack, _PACKED)
    first = written(streamed(trees, first, "shard").mapInArrow(seed, _PACKED), "seeds")
    grouped = trees.withColumn("group", F.col("shard") % groups)
    everywhere = first.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    rest = streamed(grouped, everywhere, "group").mapInArrow(visit, _FOUND)
    better = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.mapInArrow(unpack, _FOUND)
        .unionByName(rest)
        .withColumn("rank", F.row_number().over(better).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch["key"][i].as_py(), batch["shard"][i].as_py(), pickle.loads(batch["blob"][i].as_buffer())


def _hits(ids: np.ndarray, best: list) -> pa.RecordBatch:
    found = [(int(i), -h[1], h[0]) for i, hits in zip(ids, best, strict=True) for h in hits]
    columns = zip(*found, strict=True) if found else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])
