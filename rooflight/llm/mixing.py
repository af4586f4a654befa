"""Mix overlapping sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources a document belongs to). Words flow
from patterns to the quotas of their sources; taking a pattern's words a second or third time costs
more and more (convex costs), so nothing is repeated that need not be. The graph has one node per
pattern and per source, never per document. Then documents are selected: each is taken as many
whole times as its pattern's flow allows, and the rest goes to the documents that come first in a
seeded hash order. That order's cut is found from sums over hash buckets, then within the one bucket
that holds the cut, so that no task sees a whole pattern. The flow runs on the driver: its size is that
of the set of patterns that occur (the mix's own configuration), never that of the documents.

Edge cases: a null text has no words; a null source is a source of its own, last in order; repeated
rows are documents of their own and, as equals in the seeded order, share a cut word by word; texts
of any length are counted whole; extra columns, of any name, are kept by ``mix_documents``; an empty
table gives no rows; targets of an all-empty corpus are 0.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rooflight.llm.shared import WORD, as_row, written

MAX_EPOCHS = 3
SEED = 20_240_601
WEIGHTS = (5, 2, 1)
#: Up to so many patterns the decisions (about 100 bytes each) are broadcast; beyond, they are joined.
BROADCAST_PATTERNS = 50_000
#: The seeded order is cut in buckets of about so many rows, at least 4096 buckets.
BUCKET_ROWS = 1 << 18


def order_key(source: str | None):
    return (source is None, source or "")


def fill_targets(sizes: dict, weights: dict, most: int = MAX_EPOCHS) -> dict:
    """Share the sum of ``sizes`` by weight; none gets over ``most`` times its size, the excess is reshared."""
    total, out, open_ = float(sum(sizes.values())), {}, sorted(sizes, key=order_key)
    while open_:
        share = total / sum(weights[s] for s in open_)
        full = [s for s in open_ if share * weights[s] > most * sizes[s]]
        if not full:
            return out | {s: share * weights[s] for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            total -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def _whole(targets: dict) -> dict:
    """Integers near the targets with the same (rounded) sum."""
    out = {s: int(t) for s, t in targets.items()}
    rest = round(sum(targets.values())) - sum(out.values())
    for s in sorted(targets, key=lambda s: (out[s] - targets[s], order_key(s)))[: max(0, rest)]:
        out[s] += 1
    return out


class _Flow:
    """Successive shortest paths with potentials."""

    def __init__(self):
        self.arcs, self.at = [], defaultdict(list)

    def arc(self, a, b, capacity: int, cost: int) -> int:
        self.at[a].append(len(self.arcs))
        self.at[b].append(len(self.arcs) + 1)
        self.arcs += [[b, capacity, cost], [a, 0, -cost]]
        return len(self.arcs) - 2

    def run(self, start, end) -> None:
        height: dict = defaultdict(int)
        while True:
            dist, via, heap, tick = {start: 0}, {}, [(0, 0, start)], 0
            while heap:
                d, _, a = heapq.heappop(heap)
                if d > dist[a]:
                    continue
                for k in self.at[a]:
                    b, capacity, cost = self.arcs[k]
                    if capacity > 0 and (e := d + cost + height[a] - height[b]) < dist.get(b, 1 << 60):
                        dist[b], via[b] = e, k
                        heapq.heappush(heap, (e, tick := tick + 1, b))
            if end not in dist:
                return
            far = max(dist.values())
            for a in list(self.at):
                height[a] += dist.get(a, far)
            path, a = [], end
            while a != start:
                path.append(via[a])
                a = self.arcs[via[a] ^ 1][0]
            push = min(self.arcs[k][1] for k in path)
            for k in path:
                self.arcs[k][1] -= push
                self.arcs[k ^ 1][1] += push


def route(capacity: dict[tuple, int], quota: dict, epochs: int = MAX_EPOCHS) -> dict[tuple, int]:
    """Words to take from each pattern: the cheapest of the largest flows to the quotas.

    The k-th time a pattern's words are taken costs k*k a word. Patterns that share no source with
    others are solved apart from them.
    """
    head: dict = {}

    def find(x):
        while head.setdefault(x, x) != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    for p in capacity:
        for s in p[1:]:
            head[find(s)] = find(p[0])
    parts = defaultdict(list)
    for p in capacity:
        if p:
            parts[find(p[0])].append(p)
    out = dict.fromkeys(capacity, 0)
    for patterns in parts.values():
        flow, first = _Flow(), {}
        for p in patterns:
            first[p] = [flow.arc("from", ("p", p), capacity[p], k * k) for k in range(1, epochs + 1)]
            for s in p:
                flow.arc(("p", p), ("s", s), epochs * capacity[p], 0)
        for s in {s for p in patterns for s in p}:
            flow.arc(("s", s), "to", quota[s], 0)
        flow.run("from", "to")
        for p in patterns:
            out[p] = sum(flow.arcs[k ^ 1][1] for k in first[p])
    return out


def word_count(text="text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _seeded(column: str = "doc_id"):
    return F.xxhash64(F.lit(SEED), column)


def plan_mix(sized: DataFrame, weights: Callable[[list], dict] | dict) -> tuple[DataFrame, DataFrame]:
    """Decide on a mix of ``sized`` (doc_id, pattern array<string>, size long).

    Returns (patterns, sources): patterns has ``pattern, times, cut_hash, cut_id, cut_words``: take
    a document ``times`` times, once more if (hash, id) comes before the cut, and ``cut_words`` words
    more if it is the cut; sources has ``source, source_size, target``. ``weights`` gives each source
    its weight, from the list of sources in order.
    """
    spark = sized.sparkSession
    sums = sized.groupBy("pattern").agg(F.sum("size").alias("size")).collect()
    capacity = {tuple(r.pattern): r["size"] for r in sums}
    size: dict = defaultdict(int)
    for p, n in capacity.items():
        for s in p:
            size[s] += n
    names = sorted(size, key=order_key)
    given = weights(names) if callable(weights) else weights
    targets = fill_targets(dict(size), given)
    taken = route(capacity, _whole(targets))
    todo = [(list(p), taken[p] // n if n else 0, taken[p] % n if n else 0) for p, n in capacity.items()]
    first = _small(spark.createDataFrame(todo, "pattern array<string>, times long, rest long"), len(todo))
    bits = max(12, (max(1, sized.count()) // BUCKET_ROWS).bit_length())
    keyed = sized.withColumn("h", _seeded()).withColumn("bucket", F.shiftright("h", 64 - bits)).withColumn("i", F.coalesce("doc_id", F.lit(-(1 << 63))))
    per_bucket = keyed.groupBy("pattern", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    same = F.col("pattern").eqNullSafe(F.col("p"))
    cuts = (
        per_bucket.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(first.withColumnRenamed("pattern", "p"), same)
        .where("rest > 0 and before < rest and before + n >= rest")
        .select("p", F.col("bucket").alias("b"), "before", "rest")
    )
    at = keyed.join(_small(cuts, len(todo)), same & (F.col("bucket") == F.col("b")))
    upto = F.sum("size").over(Window.partitionBy("pattern").orderBy("h", "i"))
    ends = (
        at.groupBy("pattern", "before", "rest", "h", "i").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
        .withColumn("upto", F.col("before") + upto)
        .where("upto >= rest and upto - size < rest")
        .select("pattern", "h", "i", F.expr("(rest - (upto - size)) div rows").alias("words"))
    )
    cut = {tuple(r.pattern): (r.h, r.i, r.words) for r in ends.collect()}
    decided = [(p, times, *cut.get(tuple(p), (None, None, None))) for p, times, _ in todo]
    schema = "pattern array<string>, times long, cut_hash long, cut_id long, cut_words long"
    listed = [(s, size[s], targets[s]) for s in names]
    return (
        _small(spark.createDataFrame(decided, schema), len(decided)),
        _small(spark.createDataFrame(listed, "source string, source_size long, target double"), len(listed)),
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_PATTERNS else df


def _with_decision(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """``rows`` (doc_id, pattern, ...) with times, before_cut, at_cut and cut_words."""
    p = patterns.select(F.col("pattern").alias("p"), "times", "cut_hash", "cut_id", "cut_words")
    key = F.struct(_seeded().alias("h"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"))
    cut = F.struct(F.col("cut_hash").alias("h"), F.col("cut_id").alias("i"))
    has = F.col("cut_hash").isNotNull()
    return rows.join(p, F.col("pattern").eqNullSafe(F.col("p"))).withColumn("before_cut", has & (key < cut)).withColumn("at_cut", has & (key == cut))


def rotating(names: list) -> dict:
    return {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized = written(docs.select("doc_id", "source", F.array("source").alias("pattern"), word_count().alias("size")), "sizes")
    patterns, sources = plan_mix(sized, rotating)
    taken = F.col("size") * (F.col("times") + F.col("before_cut").cast("long"))
    taken += F.when(F.col("at_cut"), F.least("size", "cut_words")).otherwise(0)
    sources = sources.withColumnRenamed("source", "s")
    return (
        _with_decision(sized, patterns)
        .join(sources, F.col("source").eqNullSafe(F.col("s")))
        .select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
    )


def mix_documents(docs: DataFrame, pattern=None, weights=rotating) -> DataFrame:
    """The mixed corpus: rows of ``docs`` left out, kept or repeated whole; columns unchanged.

    ``pattern`` is the array of sources of a row, by default its ``source`` alone. A document at the
    cut is taken once more if at least half of it is wanted.
    """
    rows = docs.select(as_row(docs), "doc_id", (F.array("source") if pattern is None else pattern).alias("pattern"), word_count().alias("size"))
    patterns, _ = plan_mix(written(rows.drop("row"), "sizes"), weights)
    out = _with_decision(rows, patterns)
    half = F.col("at_cut") & (2 * F.col("cut_words") >= F.col("size"))
    copies = F.col("times") + (F.col("before_cut") | half).cast("long")
    return out.withColumn("copies", copies).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
