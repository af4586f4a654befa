"""Language-model scores by deleted interpolation.

A trigram model whose maximum-likelihood estimates are mixed from the lowest order up:

    P1(w)      = a c(w) / N                 + (1 - a) / (V + 1)
    P2(w | h)  = b c(h, w) / c(h)           + (1 - b) P1(w)
    P3(w | gh) = d c(g, h, w) / c(g, h)     + (1 - d) P2(w | h)

b depends on the frequency bucket (powers of two) of c(h), d on that of c(g, h); an unseen context
leaves all to the lower order. Every distribution sums to 1, one unknown token included. Before a
text's first token stands its end token, twice: c(end, end) as a context is the number of texts.

The weights are learned by expectation-maximisation, order by order, on held-out training texts (a
tenth, by hash) against the counts of the other nine tenths; the scores then use the counts of all
training texts. In a mixture of two only the ratio of both estimates matters (half a token is added to either's share), so that a histogram of
that ratio by bucket (in steps of 2^(1/32), each with the mean of its ratios) is all the driver gets:
its size is fixed, whatever the corpus.

No count table is ever broadcast. Texts are packed into chunks of numbered tokens; each chunk asks
for the totals of its distinct words, bigrams and trigrams, in sorted compressed runs by hash range. A
range is summed in one task, where a frequent word has one entry per chunk, and the totals go back to
the chunks in the order asked. N-grams are known by hashes, of so many bits that the chance to meet
another's hash stays under 2^-22 each, whatever the corpus' size. A run without keys is not sent, so
that there are never more rows than distinct n-grams of chunks, and the largest of what is sent, the
keys, grows in proportion to the corpus.

Edge cases: a null text is empty and has the end token alone; a null id counts as empty text in the
folds; without training texts N and V are 0 and every token has probability 1 / (V + 1); without
held-out training texts the weights are 1/2; ties do not matter; repeated rows count (and are scored)
each; texts of any length are scored whole (a longer one than a chunk is a chunk of its own); extra
columns, of any name, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooflight.llm.packing import Numbering, chunk_id, expand, squeeze
from rooflight.llm.shared import held_out, written

ORDER = 3
CORE, ASIDE, UNSEEN = 0, 1, 2
CHUNK_TOKENS = 1_000_000
RANGE_TOKENS = 2_000_000
#: The hash of an n-gram has so many bits more than the number of tokens.
SPARE_BITS = 22
_STEP = 32  # bins of ratios by power of two
_NONE = -100_000  # the bin of ratio 0
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b""
_CHUNK = "chunk long, kind int, docs binary, no_id binary, lengths binary, tokens binary, vocabulary binary, n long"
_CHUNK_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]


def _pack(docs: DataFrame) -> DataFrame:
    """Chunks of texts, each of one kind: CORE, ASIDE (training, held out for the weights), UNSEEN."""
    kind = F.when(held_out(7, 2), UNSEEN).when(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(10)) == 0, ASIDE).otherwise(CORE)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, ids, number, part = {}, {}, 0, TaskContext.get().partitionId()

        def close(k: int) -> pa.RecordBatch:
            nonlocal number
            own, docs_ = open_.pop(k), ids.pop(k)
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in own.ids], np.uint64)
            row = {
                "chunk": [chunk_id(part, number)], "kind": [k],
                "docs": [np.array([d or 0 for d in docs_], np.int64).tobytes()], "no_id": [np.array([d is None for d in docs_], bool).tobytes()],
                "lengths": [own.lengths().tobytes()], "tokens": [squeeze(own.numbers())], "vocabulary": [hashes.tobytes()], "n": [own.tokens],
            }
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(row[c], t) for c, t in zip(row, _CHUNK_TYPES, strict=True)], list(row))

        for batch in batches:
            for doc, text, k in zip(batch["doc_id"].to_pylist(), batch["text"], batch["kind"].to_pylist(), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
                words.append(_END)
                own = open_.get(k) or open_.setdefault(k, Numbering())
                own.add(words)
                ids.setdefault(k, []).append(doc)
                if own.tokens >= CHUNK_TOKENS:
                    yield close(k)
        for k in sorted(open_):
            yield close(k)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", kind.alias("kind")).mapInArrow(pack, _CHUNK)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return z ^ (z >> np.uint64(32))


class _Chunk:
    """A chunk's tokens, and for each order its distinct n-grams in the order of their keys."""

    def __init__(self, tokens: bytes, vocabulary: bytes, lengths: bytes, bits: int):
        self.tokens = expand(tokens, np.int32).astype(np.int64)
        self.lengths = np.frombuffer(lengths, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        hashes = np.frombuffer(vocabulary, np.uint64)
        number, self.grams = self.tokens, []
        end = self.tokens[self.starts + self.lengths - 1]
        for order in range(1, ORDER + 1):
            if order > 1:  # an n-gram is what stood before, and the token
                before = np.empty_like(number)
                before[1:] = number[:-1]
                before[self.starts] = end if order == 2 else len(hashes)  # a context of its own: end, end
                codes, number = np.unique(before * np.int64(len(self.tokens) + 1) + self.tokens, return_inverse=True)
                known = np.append(hashes, np.uint64(1))
                hashes = _mixed(known[codes // (len(self.tokens) + 1)], words[codes % (len(self.tokens) + 1)])
            else:
                words = hashes
            keys, back = np.unique(hashes >> np.uint64(64 - bits), return_inverse=True)
            at = back[number].astype(np.int32)
            self.grams.append((keys, at, np.bincount(at, minlength=len(keys))))

    def contexts(self, counts: list[np.ndarray]) -> list[np.ndarray]:
        """Frequencies of the tokens' contexts, for orders from 2 up, from those of their n-grams."""
        texts = counts[0][self.starts + self.lengths - 1]  # of the end token: one a text
        out = []
        for c in counts[:-1]:
            before = np.empty_like(c)
            before[1:] = c[:-1]
            before[self.starts] = texts
            out.append(before)
        return out


_ASK = "size int, range int, chunk long, kind int, keys binary, counts binary"
_ASK_TYPES = pa.schema([("size", pa.int32()), ("range", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _asked(chunks: DataFrame, ranges: int, bits: int) -> DataFrame:
    edges = np.arange(ranges, dtype=np.uint64) << np.uint64(bits - ranges.bit_length() + 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _Chunk(row["tokens"], row["vocabulary"], row["lengths"], bits)
                for size, (keys, _, counts) in enumerate(own.grams, 1):
                    out: dict = {c: [] for c in _ASK_TYPES.names}
                    cut = np.concatenate([np.searchsorted(keys, edges), [len(keys)]])
                    for r in np.flatnonzero(np.diff(cut)).tolist():
                        part = slice(cut[r], cut[r + 1])
                        values = (size, r, row["chunk"], row["kind"], squeeze(np.diff(keys[part], prepend=np.uint64(0))), squeeze(counts[part].astype(np.int32)))
                        for c, v in zip(out, values, strict=True):
                            out[c].append(v)
                    yield pa.RecordBatch.from_pydict(out, schema=_ASK_TYPES)

    return chunks.select("chunk", "kind", "tokens", "vocabulary", "lengths").mapInArrow(ask, _ASK)


_TOTAL = "size int, range int, chunk long, kind int, core binary, every binary, n_core long, n_every long, distinct long"


def _total(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum one range of keys over all chunks; the totals in the order that each chunk asked for them."""
    keys = [np.cumsum(expand(k, np.uint64), dtype=np.uint64) for k in pdf["keys"]]
    cut = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    core, every = np.zeros(at.max() + 1, np.int64), np.zeros(at.max() + 1, np.int64)
    parts = [at[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    for p, k, c in zip(parts, pdf["kind"], pdf["counts"], strict=True):  # a chunk has a key once
        if k != UNSEEN:
            (core if k == CORE else every)[p] += expand(c, np.int32)
    every += core
    out = pdf[["size", "range", "chunk", "kind"]].copy()
    out["core"] = [squeeze(core[p]) if k == ASIDE else None for p, k in zip(parts, pdf["kind"], strict=True)]
    out["every"] = [squeeze(every[p]) for p in parts]
    out["n_core"], out["n_every"], out["distinct"] = 0, 0, 0
    out.iloc[0, out.columns.get_indexer(["n_core", "n_every", "distinct"])] = core.sum(), every.sum(), (every > 0).sum()
    return out


def _frequencies(pdf: pd.DataFrame, column: str, chunk: _Chunk) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of every token: the frequencies of its n-grams by order, and of its contexts from order 2."""
    out = []
    for size, (keys, at, _) in enumerate(chunk.grams, 1):
        rows = pdf[pdf["size"] == size].sort_values("range")
        got = np.concatenate([expand(x, np.int64) for x in rows[column]] or [np.empty(0, np.int64)])
        if len(got) != len(keys):
            raise ValueError("a chunk and its answers differ")
        out.append(got[at])
    return out, chunk.contexts(out)


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2)."""
    return np.frexp(context.astype(float))[1]


def learn_weights(bins: list[tuple[int, float, float]], rounds: int = 2000) -> dict[int, float]:
    """The upper estimate's weight in each bucket, by EM. bins: bucket, ratio of upper to lower estimate, tokens."""
    out = {}
    for b in sorted({x[0] for x in bins}):
        ratio, n = (np.array([x[i] for x in bins if x[0] == b], float) for i in (1, 2))
        w = 0.5
        for _ in range(rounds):
            new = (float((n * (w * ratio / (w * ratio + 1 - w))).sum()) + 0.5) / (n.sum() + 1)
            w, moved = new, abs(new - w)
            if moved < 1e-9:
                break
        out[b] = w
    return out


def weight_table(weights: dict[int, float]) -> np.ndarray:
    """Weights of buckets 0 to 64: 0 for an unseen context; a bucket without held-out tokens has that of the nearest below, else 1/2."""
    table, last = np.zeros(65), 0.5
    for b in range(1, 65):
        table[b] = last = weights.get(b, last)
    return table


def probabilities(counts: list, contexts: list, n: int, distinct: int, tables: list[np.ndarray]) -> np.ndarray:
    """The mixture of as many orders as there are tables."""
    p = np.full(len(counts[0]), 1 / (distinct + 1))
    for order, table in enumerate(tables):
        context = np.full(len(p), n) if order == 0 else contexts[order - 1]
        w = np.where(context > 0, table[bucket(context)], 0.0)
        p = w * (counts[order] / np.maximum(context, 1)) + (1 - w) * p
    return p


def _ratios(held: DataFrame, n: int, distinct: int, tables: list[np.ndarray]) -> list[tuple[int, float, float]]:
    """Histogram (bucket, mean ratio, tokens) of the next order's estimate to the mixture of those before."""
    order = len(tables)

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = [expand(x, np.int64) for x in row["counts"]]
                contexts = [expand(x, np.int64) for x in row["contexts"]]
                low = probabilities(counts, contexts, n, distinct, tables)
                context = np.full(len(low), n) if order == 0 else contexts[order - 1]
                seen = context > 0
                ratio, b = counts[order][seen] / context[seen] / low[seen], bucket(context[seen])
                with np.errstate(divide="ignore"):
                    bin_ = np.where(ratio > 0, np.rint(_STEP * np.log2(ratio)), _NONE).astype(np.int64)
                (bs, qs), at = np.unique(np.stack([b.astype(np.int64), bin_]), axis=1, return_inverse=True)
                at = at.reshape(-1)
                yield pa.RecordBatch.from_pydict({"b": bs, "q": qs, "n": np.bincount(at, minlength=len(bs)), "r": np.bincount(at, ratio, minlength=len(bs))})

    rows = held.mapInArrow(observe, "b long, q long, n long, r double").groupBy("b", "q").agg(F.sum("n").alias("n"), F.sum("r").alias("r")).collect()
    return sorted((r.b, r.r / r.n, float(r.n)) for r in rows)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    chunks = written(_pack(docs), "chunks")
    n = chunks.agg(F.sum("n")).first()[0] or 0
    ranges, bits = 16, min(64, n.bit_length() + SPARE_BITS)
    while ranges * RANGE_TOKENS < n:
        ranges *= 2
    totals = written(_asked(chunks, ranges, bits).groupBy("size", "range").applyInPandas(_total, _TOTAL), "totals")
    sums = totals.where("size = 1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_core", "n_every", "distinct")]).first()
    n_core, n_every, distinct = (int(x) for x in sums)

    def look(one: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = one.iloc[0]
        counts, contexts = _frequencies(found, "core", _Chunk(row.tokens, row.vocabulary, row.lengths, bits))
        return pd.DataFrame({"counts": [[squeeze(x) for x in counts]], "contexts": [[squeeze(x) for x in contexts]]})

    aside = chunks.where(F.col("kind") == ASIDE).groupBy("chunk").cogroup(totals.where(F.col("kind") == ASIDE).select("chunk", "size", "range", "core").groupBy("chunk"))
    held = written(aside.applyInPandas(look, "counts array<binary>, contexts array<binary>"), "held-out")
    tables: list[np.ndarray] = []
    for _ in range(ORDER):
        tables.append(weight_table(learn_weights(_ratios(held, n_core, distinct, tables))))

    def rate(one: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = one.iloc[0]
        chunk = _Chunk(row.tokens, row.vocabulary, row.lengths, bits)
        counts, contexts = _frequencies(found, "every", chunk)
        p = probabilities(counts, contexts, n_every, distinct, tables)
        base = np.log10((counts[0] + 1) / (n_every + distinct + 1))
        out = pd.DataFrame({"doc_id": pd.array(np.frombuffer(row.docs, np.int64), "Int64")})
        out.loc[np.frombuffer(row.no_id, bool), "doc_id"] = pd.NA
        out["held_out"] = row.kind == UNSEEN
        out["n_tokens"] = chunk.lengths
        out["n_known"] = np.add.reduceat((counts[0] > 0).astype(np.int64), chunk.starts)
        out["train_tokens"] = n_every
        out["base_score"], out["score"] = np.add.reduceat(base, chunk.starts), np.add.reduceat(np.log10(p), chunk.starts)
        return out

    every = chunks.groupBy("chunk").cogroup(totals.select("chunk", "size", "range", "every").groupBy("chunk"))
    return every.applyInPandas(rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
