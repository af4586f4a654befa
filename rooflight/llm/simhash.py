"""SimHash near-duplicates, found through Golay-code fuzzy keys.

A 64-bit fingerprint is cut into three segments (22, 21 and 21 bits), each a shortened word of the
perfect binary Golay code [23, 12, 7]. ``K(s)``, the indices of the codewords that s and its one-bit
neighbours decode to (about five), meets ``K(t)`` whenever s and t differ in two bits or fewer. Four
differing bits leave, by pigeonhole, one of two cases:

* a segment without an error, and of the other two one with two errors at most: keys of the exact
  segment and K of another one;
* two segments with one error each and two at most in the third, one of whose three parts is then
  exact: keys (K of one, codeword of the other) and the converse, with an exact part of the third.

Every key has 31 bits or more, so buckets stay short. Fingerprints that share a key are compared
(nothing is lost, as every pair within 4 bits shares one), links are thinned to a spanning forest of
the shortest ones before they leave the task, and components are found by distributed star contraction.
Everything works on distinct fingerprints: rows that share one, however many, are combined before the shuffle.

``near_duplicates`` links fingerprints alone. ``keep_one_each`` finds all texts whose sets of five-word
shingles have a Jaccard similarity of 0.8 or more, in two passes, both checked on the whole sets of shingles.
The first takes candidates from the keys of fingerprints of distinct words, which change far less than shingles
do when words are replaced, within 10 bits; of a key that more than FEW rows share, those along a shortest tree.
It joins most of every family. The second is the exact way for all the rest, whatever keys they have: shingles
are put in one order, rare ones first (by counters that are approximate, as any fixed order is right); sets of n and m
shingles that are alike share one of the first n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1. Sets that share such
a shingle with at most MANY others, are not in one component by then and can still have enough in common are checked,
each pair. A shingle of more sets only says that their components are of one family; families are dealt into
blocks of sets of like size, and all sets of two blocks are compared at once in one task, which returns links only.

Edge cases: a null text, or one without words, has fingerprint zero and links like any other; fewer
words than a shingle has make one shingle; null ids never name a component unless all its ids are null;
repeated rows share a component; whole texts are read, however long, in pieces of shingles; extra
columns, of any name, are ignored (kept by ``keep_one_each``, where the row with the smallest id stays,
null ids last, of rows that share an id and a set the smallest text); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from rooflight.llm.shared import as_row, bucketed, connected_components, look_up, written

SHINGLE = 4
MAX_BITS = 4
#: Of ``keep_one_each``: words of a shingle, the least similarity as a fraction, and the candidates' bits and prints.
COPY_SHINGLE = 5
ALIKE = (4, 5)
CANDIDATE_BITS = 10
#: Up to so many rows of a key are checked pair by pair, more of them along a shortest tree. What that leaves out is found by shingles.
FEW = 9
SEED = 42
#: Generator polynomial of the Golay code, and the segments (first bit, bits).
GOLAY = 0xC75
SEGMENTS = [(0, 22), (22, 21), (43, 21)]
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PIECE = 1 << 16
_ROWS = 1 << 18
_SMALL = 48  # rows of a key that are compared pair by pair
#: Sets that share a rare shingle are paired up to so many; more of them are compared by blocks of so many sets and shingles.
MANY = 16
BLOCK = 256
_BLOCK_TOKENS = 1 << 20
#: Sizes of sets that are alike are in one class or in neighbouring ones: a little more than 5 / 4.
_CLASS = 1.26
_COLUMNS = 1 << 12
#: Sets that a task keeps at hand while it checks pairs.
_HELD = 256
#: Counters of shingles, which only decide on the order in which they are looked at.
_SLOTS = 1 << 20


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles, repeats included, in pieces."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    hash_ = xxhash.xxh64_intdigest
    for k in range(0, len(starts), _PIECE):
        yield np.array([hash_(joined[a:b], SEED) for a, b in zip(starts[k : k + _PIECE], stops[k : k + _PIECE], strict=True)], "<u8")


def _majority(pieces: Iterator[np.ndarray]) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    counts, total = np.zeros(64, np.int64), 0
    for h in pieces:
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0]) if total else 0


def word_print(text: str | None) -> int:
    """A fingerprint of the whole text's distinct words."""
    h = np.unique(np.concatenate([np.empty(0, np.uint64), *_hashes(text, 1)]))
    return _majority(h[a : a + _PIECE] for a in range(0, len(h), _PIECE))


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of the whole text, as a signed number."""
    return _majority(_hashes(text, SHINGLE))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles of ``COPY_SHINGLE`` words."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *_hashes(text, COPY_SHINGLE)]))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return ALIKE[1] * both >= ALIKE[0] * (len(a) + len(b) - both)


@cache
def _code() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of single bits, and the error pattern (3 bits at most) of every syndrome."""
    bit = np.empty(23, np.int64)
    for i in range(23):
        r = 1 << i
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GOLAY << (k - 11)
        bit[i] = r
    errors = np.zeros(2048, np.int64)
    for n in (1, 2, 3):
        for at in combinations(range(23), n):
            errors[np.bitwise_xor.reduce(bit[list(at)])] = sum(1 << i for i in at)
    return bit, errors


def _decoded(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codeword index of each word, and of it and its one-bit neighbours (n x (bits + 1)), repeats as -1."""
    bit, errors = _code()
    syndrome = np.zeros(len(words), np.int64)
    for i in range(bits):
        syndrome ^= np.where(words >> i & 1, bit[i], 0)
    own = (words ^ errors[syndrome]) >> 11
    near = np.empty((len(words), bits + 1), np.int64)
    near[:, 0] = own
    for i in range(bits):
        near[:, i + 1] = (words ^ (1 << i) ^ errors[syndrome ^ bit[i]]) >> 11
    near.sort(axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return own, near


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of the fingerprint) of all keys of signed 64-bit fingerprints."""
    u = prints.view(np.uint64)
    seg = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    own, near = zip(*(_decoded(s, n) for s, (_, n) in zip(seg, SEGMENTS, strict=True)), strict=True)
    listed = [np.nonzero(x >= 0) for x in near]
    keys, rows = [], []

    def put(tag: int, row: np.ndarray, value: np.ndarray) -> None:
        keys.append(np.int64(tag) << 40 | value)
        rows.append(row)

    for tag, (i, j) in enumerate(permutations(range(3), 2)):
        r, c = listed[j]
        put(tag, r, seg[i][r] << 12 | near[j][r, c])
    for tag, (i, j) in enumerate(combinations(range(3), 2)):
        third = 3 - i - j
        for part in range(3):
            exact = seg[third] >> 7 * part & (127 if part < 2 else 255)
            r, c = listed[i]
            put(6 + 3 * tag + part, r, exact[r] << 24 | near[i][r, c] << 12 | own[j][r])
            r, c = listed[j]
            other = near[j][r, c] != own[j][r]
            r, c = r[other], c[other]
            put(6 + 3 * tag + part, r, exact[r] << 24 | own[i][r] << 12 | near[j][r, c])
    return np.concatenate(keys), np.concatenate(rows)


def _forest(links: np.ndarray) -> np.ndarray:
    """Of links (distance, a, b), those of a shortest spanning forest."""
    links = np.unique(links, axis=0)  # in order of distance
    head: dict = {}
    keep = []
    for i, (_, x, y) in enumerate(links.tolist()):
        p, q = x, y
        while head.setdefault(p, p) != p:
            head[p] = head[head[p]]
            p = head[p]
        while head.setdefault(q, q) != q:
            head[q] = head[head[q]]
            q = head[q]
        if p != q:
            head[p] = q
            keep.append(i)
    return links[keep]


def _links(a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    return np.stack([distance.astype(np.int64), np.minimum(a, b), np.maximum(a, b)], axis=1)


def _tree(prints: np.ndarray, bits: int) -> np.ndarray:
    """The links within ``bits`` of a shortest tree that joins one key's rows, one after the other."""
    n, at = len(prints), 0
    near, via, left = np.full(n, 255, np.uint8), np.zeros(n, np.int64), np.ones(n, bool)
    ends = np.zeros((n - 1, 3), np.int64)
    words = prints.view(np.uint64)
    for i in range(n - 1):
        left[at], near[at] = False, 255
        d = np.bitwise_count(words ^ words[at])
        closer = left & (d < near)
        near[closer], via[closer] = d[closer], at
        at = int(np.where(left, near, 255).argmin())
        ends[i] = near[at], via[at], at
    ends = ends[ends[:, 0] <= bits]
    return _links(prints[ends[:, 1]], prints[ends[:, 2]], ends[:, 0])


def _linked(key: np.ndarray, prints: np.ndarray, bits: int, small: int) -> np.ndarray:
    """Links within ``bits`` among rows of one key: all of up to ``small`` rows, a tree's of more. Rows are sorted by key."""
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.append(first, len(key)))
    found = [np.empty((0, 3), np.int64)]
    for a, n in zip(first[size > small].tolist(), size[size > small].tolist(), strict=True):
        found.append(_tree(prints[a : a + n], bits))
    at, step = np.flatnonzero(np.repeat((size > 1) & (size <= small), size)), 1
    while len(at := at[at < len(key) - step]) and len(at := at[key[at] == key[at + step]]):
        d = np.bitwise_count((prints[at] ^ prints[at + step]).view(np.uint64))
        hit = d <= bits
        found.append(_links(prints[at[hit]], prints[at[hit] + step], d[hit]))
        step += 1
    return np.unique(np.concatenate(found), axis=0)


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, simhash_print long) of every row of ``docs``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch["text"]), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found)], ["doc_id", "simhash_print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(add, "doc_id long, simhash_print long")


def _compared(prints: DataFrame, keys: Callable, bits: int, small: int) -> DataFrame:
    """(src, dst): links within ``bits`` between the distinct ``fp`` of ``prints`` that share a key, see _linked, thinned to a forest of each task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy()
            for a in range(0, len(fp), 8192):
                key, row = keys(fp[a : a + 8192])
                yield pa.RecordBatch.from_pydict({"key": key, "fp": fp[a + row]})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal held, rows
            key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))
            held, rows = [(key[cut:], fp[cut:])], len(key) - cut
            found = _forest(_linked(key[:cut], fp[:cut], bits, small))
            return pa.RecordBatch.from_pydict({"src": found[:, 1], "dst": found[:, 2]})

        limit = _ROWS
        for batch in batches:
            held.append((batch["key"].to_numpy(), batch["fp"].to_numpy()))
            rows += batch.num_rows
            if rows >= limit:
                yield flush(False)
                limit = _ROWS + 2 * rows
        if rows:
            yield flush(True)

    keyed = prints.select("fp").mapInArrow(emit, "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(compare, "src long, dst long").distinct()


def links(prints: DataFrame) -> DataFrame:
    """(src, dst): enough links between the distinct ``fp`` of ``prints`` to connect all within MAX_BITS."""
    return _compared(prints, fuzzy_keys, MAX_BITS, _SMALL)


def components(tagged: DataFrame) -> DataFrame:
    """(fp, n, component_id) of every distinct fingerprint of ``tagged`` (doc_id, simhash_print) and how many rows have it."""
    prints = written(tagged.groupBy(F.col("simhash_print").alias("fp")).agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "prints")
    reached = written(connected_components(written(links(prints), "links")), "reached")
    low = reached.join(prints, F.col("node") == F.col("fp")).groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    linked = look_up(reached, written(low, "lowest"), "component", reached.count()).select("node", "component_id")
    return prints.join(linked, F.col("fp") == F.col("node"), "left").select("fp", "n", F.coalesce("component_id", "low").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    tagged = written(with_fingerprint(docs), "fingerprints")
    found = written(components(tagged), "components")
    return look_up(tagged.withColumnRenamed("simhash_print", "fp"), found, "fp", tagged.count()).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def with_set(docs: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs``), ``near_set`` (hash of the set of shingles) and ``word_print`` (fingerprint of its distinct words)."""
    rows = docs.select(as_row(docs))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field("text")
            names = np.fromiter((xxhash.xxh3_64_intdigest(shingles(t.as_py()).tobytes()) for t in texts), np.uint64, batch.num_rows)
            prints = pa.array([word_print(t.as_py()) for t in texts], pa.int64())
            schema = batch.schema.append(pa.field("near_set", pa.int64())).append(pa.field("word_print", pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names.view(np.int64)), prints], schema=schema)

    return rows.mapInArrow(add, StructType([*rows.schema.fields]).add("near_set", LongType()).add("word_print", LongType()))


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (src, dst) of ``near_set`` whose sets of shingles are alike."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def known(node: int, text: pa.Scalar) -> np.ndarray:
            if node not in held:
                if len(held) == _HELD:
                    del held[next(iter(held))]
                held[node] = shingles(text.as_py())
            return held[node]

        for batch in batches:
            ends = zip(batch["src"].to_pylist(), batch["dst"].to_pylist(), batch["src_text"], batch["dst_text"], strict=True)
            good = pa.array([alike(known(a, x), known(b, y)) for a, b, x, y in ends], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["src"], batch["dst"]], names=["src", "dst"]).filter(good)

    src = sets.select(F.col("near_set").alias("src"), F.col("text").alias("src_text"))
    dst = sets.select(F.col("near_set").alias("dst"), F.col("text").alias("dst_text"))
    return pairs.join(src, "src").join(dst, "dst").select("src", "dst", "src_text", "dst_text").mapInArrow(verify, "src long, dst long")


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(_SLOTS - 1)).astype(np.int64)


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How many shingles of all ``sets`` fall into each slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SLOTS, np.int64)
        for batch in batches:
            held, n = [], 0
            for t in batch["text"]:
                held.append(shingles(t.as_py()))
                n += len(held[-1])
                if n >= _SLOTS:
                    total += np.bincount(_slot(np.concatenate(held)), minlength=_SLOTS)
                    held, n = [], 0
            if held:
                total += np.bincount(_slot(np.concatenate(held)), minlength=_SLOTS)
        at = np.flatnonzero(total.reshape(-1, _PIECE).any(axis=1))
        yield pa.RecordBatch.from_pydict({"part": pa.array(at, pa.int32()), "counts": pa.array([x.tobytes() for x in total.reshape(-1, _PIECE)[at]], pa.binary())})

    def add(pdf):
        return pdf.iloc[:1].assign(counts=[sum(np.frombuffer(x, np.int64) for x in pdf.counts).tobytes()])

    shape = "part int, counts binary"
    out = np.zeros((_SLOTS // _PIECE, _PIECE), np.int64)
    for r in sets.select("text").mapInArrow(count, shape).groupBy("part").applyInPandas(add, shape).toLocalIterator():
        out[r.part] = np.frombuffer(r.counts, np.int64)
    return out.ravel().astype(np.float32)


def _prefix(tokens: np.ndarray, frequencies: np.ndarray) -> np.ndarray:
    """The first of a set's shingles, rare ones first: sets that are alike have one in common among theirs."""
    n = len(tokens)
    return tokens[np.lexsort((tokens, frequencies[_slot(tokens)]))[: n - _common(n) + 1]]


def _common(size):
    """How many shingles a set of this size has in common with one that is alike, at least."""
    return -(-size * ALIKE[0] // ALIKE[1])


def _enough(common, size: np.ndarray, other: np.ndarray):
    """Can sets of these sizes be alike if so many shingles are in common?"""
    return sum(ALIKE) * common >= ALIKE[0] * (size + other)


def _meeting(token: np.ndarray, label: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray, many: int) -> np.ndarray:
    """(src, dst, least, n): pairs of nodes of different labels that share n of the tokens. Rows are sorted by token and label.

    They must share ``least`` tokens over all keys to be alike: what sets have in common but not in both prefixes
    is behind the prefix of one of the two. Pairs that cannot have enough in common before and behind a token are
    left out. Tokens of more than ``many`` rows (if not 0) are passed over, see _ties.
    """
    found = [np.empty((0, 3), np.int64)]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    count = np.diff(np.append(first, len(token)))
    mixed = (label[first] != label[first + count - 1]) & (count <= (many or len(token)))
    at, step = np.flatnonzero(np.repeat(mixed, count)), 1
    while len(at := at[at < len(token) - step]) and len(at := at[token[at] == token[at + step]]):
        i, j = at, at + step
        most = np.minimum(place[i], place[j]) + np.minimum(size[i] - place[i], size[j] - place[j])
        may = (label[i] != label[j]) & _enough(most, size[i], size[j])
        i, j = i[may], j[may]
        least = -(-(size[i] + size[j]) * ALIKE[0] // sum(ALIKE)) - _common(np.maximum(size[i], size[j])) + 1
        i, j = node[i], node[j]
        found.append(np.stack([np.minimum(i, j), np.maximum(i, j), least], axis=1))
        step += 1
    pairs, n = np.unique(np.concatenate(found), axis=0, return_counts=True)
    return np.column_stack([pairs, n])


def _ties(token: np.ndarray, label: np.ndarray, many: int) -> np.ndarray:
    """(src, dst, 0, 0): enough ties between labels to connect all that share a token of more than ``many`` rows, sorted as above."""
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    count = np.diff(np.append(first, len(token)))
    head, other = np.repeat(label[first], count), np.repeat(count > many, count)
    other &= (label != head) & np.r_[True, label[1:] != label[:-1]]
    ties = _forest(_links(head[other], label[other], np.zeros(int(other.sum()), np.int64)))
    return np.column_stack([ties[:, 1:], np.zeros((len(ties), 2), np.int64)])


def _sharing(sets: DataFrame, reached: DataFrame, frequencies) -> DataFrame:
    """(src, dst, least): all pairs of ``sets`` that may be alike and are not in one component of ``reached`` (node, component), and ties of components (least 0)."""
    columns = ["token", "label", "node", "size", "place"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for node, label, text in zip(batch["near_set"].to_pylist(), batch["label"].to_pylist(), batch["text"], strict=True):
                tokens = shingles(text.as_py())
                if not len(tokens):
                    continue
                own = _prefix(tokens, frequencies.value)
                held.append((own, np.full(len(own), label), np.full(len(own), node), np.full(len(own), len(tokens)), np.arange(len(own))))
                n += len(own)
                if n >= _PIECE:
                    yield rows(held)
                    held, n = [], 0
            if held:
                yield rows(held)

    def rows(held: list) -> pa.RecordBatch:
        got = [np.concatenate(x) for x in zip(*held, strict=True)]
        return pa.RecordBatch.from_pydict(dict(zip(columns, [got[0].view(np.int64), *(x.astype(np.int64) for x in got[1:3]), *(x.astype(np.int32) for x in got[3:])], strict=True)))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal held, n
            got = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = len(got[0]) if last else int(np.searchsorted(got[0], got[0][-1]))
            held, n = [[x[cut:] for x in got]], len(got[0]) - cut
            got = [x[:cut].astype(np.int64) for x in got]
            found = np.concatenate([_meeting(*got, MANY), _ties(*got[:2], MANY)]) if cut else np.empty((0, 4), np.int64)
            return pa.RecordBatch.from_pydict(dict(zip(("src", "dst", "least", "n"), found.T.copy(), strict=True)))

        limit = _ROWS
        for batch in batches:
            held.append([batch[c].to_numpy() for c in columns])
            n += batch.num_rows
            if n >= limit:
                yield flush(False)
                limit = _ROWS + 2 * n
        if n:
            yield flush(True)

    listed = _labelled(sets, reached).mapInArrow(emit, "token long, label long, node long, size int, place int")
    met = listed.repartition("token").sortWithinPartitions("token", "label").mapInArrow(meet, "src long, dst long, least long, n long")
    return met.groupBy("src", "dst", "least").agg(F.sum("n").alias("n")).where("n >= least").select("src", "dst", "least")


def _labelled(sets: DataFrame, reached: DataFrame) -> DataFrame:
    """(near_set, label, text): every set with its component, its own name if it is alone."""
    labels = reached.select(F.col("node").alias("near_set"), "component")
    return sets.select("near_set", "text").join(labels, "near_set", "left").select("near_set", F.coalesce("component", "near_set").alias("label"), "text")


def _alike_pairs(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """For each of the sets ``a`` and each of ``b``: are they alike?"""
    size = [np.array([len(x) for x in side], np.int64) for side in (a, b)]
    tokens = [np.concatenate([np.empty(0, np.uint64), *side]) for side in (a, b)]
    shared = np.intersect1d(*tokens)
    both = np.zeros((len(a), len(b)), np.int64)
    if len(shared):
        ends = []
        for t, n in zip(tokens, size, strict=True):
            at = np.minimum(np.searchsorted(shared, t), len(shared) - 1)
            hit = shared[at] == t
            order = np.argsort(at[hit], kind="stable")
            ends.append((at[hit][order], np.repeat(np.arange(len(n)), n)[hit][order]))
        for k in range(0, len(shared), _COLUMNS):
            matrix = []
            for (at, owner), n in zip(ends, size, strict=True):
                x, y = np.searchsorted(at, [k, k + _COLUMNS])
                matrix.append(np.zeros((len(n), min(_COLUMNS, len(shared) - k)), np.float32))
                matrix[-1][owner[x:y], at[x:y] - k] = 1
            both += (matrix[0] @ matrix[1].T).astype(np.int64)
    return _enough(both, size[0][:, None], size[1][None, :])


def _within_families(sets: DataFrame, reached: DataFrame, ties: DataFrame) -> DataFrame:
    """(src, dst): links of all alike pairs of ``sets`` whose components are tied, thinned to a forest of each two blocks.

    A block holds BLOCK sets or so of one family and class of sizes; a component of as many has blocks of its own, which are
    not compared with each other. Two blocks of one class or of neighbouring ones are compared in one task.
    """
    families = connected_components(ties).select(F.col("node").alias("label"), F.col("component").alias("family"))
    labels = _labelled(sets, reached).select("near_set", "label").join(families, "label")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [shingles(t.as_py()) for t in batch["text"]]
            columns = [*(batch[c] for c in ("near_set", "label", "family")), pa.array([len(t) for t in tokens], pa.int64()), pa.array([t.tobytes() for t in tokens], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["near_set", "label", "family", "size", "tokens"])

    def compare(table: pa.Table) -> pa.Table:
        left = table["side"].to_numpy() == 0
        sides = [table.filter(pa.array(left)), table.filter(pa.array(~left))]
        sides[1] = sides[1] if len(sides[1]) else sides[0]
        node, label = ([x[c].to_numpy() for x in sides] for c in ("near_set", "label"))
        near = _alike_pairs(*([np.frombuffer(t.as_py(), np.uint64) for t in x["tokens"]] for x in sides))
        i, j = np.nonzero(near & (label[0][:, None] != label[1][None, :]))
        found = _forest(_links(node[0][i], node[1][j], np.zeros(len(i), np.int64)))
        return pa.table({"src": found[:, 1], "dst": found[:, 2]})

    held = sets.select("near_set", "text").join(written(labels, "tied"), "near_set").select("near_set", "label", "family", "text")
    members = written(held.mapInArrow(add, "near_set long, label long, family long, size long, tokens binary").withColumn("class", F.floor(F.log(_CLASS, F.col("size")))), "members")
    own = members.groupBy("family", "class", "label").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    own = written(own.withColumn("own", F.when(F.col("n") >= BLOCK, F.col("label").cast("string")).otherwise("")), "own")
    parts = own.groupBy("family", "class", "own").agg(F.ceil(F.greatest(F.sum("n") / BLOCK, F.sum("size") / _BLOCK_TOKENS)).alias("blocks"))
    part = F.concat_ws("/", "family", "class", "own", "block")
    parts = written(parts, "parts")
    blocks = written(parts.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))).withColumn("part", part), "blocks")
    a, b = (blocks.select("family", *(F.col(c).alias(c + x) for c in ("class", "own", "part"))) for x in "ab")
    ahead = (F.col("classb") == F.col("classa") + 1) | (F.col("classb") == F.col("classa")) & (F.col("parta") <= F.col("partb"))
    two = written(a.join(b, "family").where(ahead & ((F.col("owna") == "") | (F.col("owna") != F.col("ownb")))).select("parta", "partb"), "two")
    sides = two.select(F.col("parta").alias("part"), "parta", "partb", F.lit(0).alias("side"))
    sides = sides.unionByName(two.where("parta <> partb").select(F.col("partb").alias("part"), "parta", "partb", F.lit(1).alias("side")))
    dealt = members.join(own.select("family", "class", "label", "own"), ["family", "class", "label"]).join(parts, ["family", "class", "own"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("near_set"), F.col("blocks"))).select(part.alias("part"), "near_set", "label", "tokens")
    return dealt.join(sides, "part").select("parta", "partb", "side", "near_set", "label", "tokens").groupBy("parta", "partb").applyInArrow(compare, "src long, dst long")


def near_copies(tagged: DataFrame) -> DataFrame:
    """(node, component) of the ``near_set`` of ``tagged`` (as of with_set) that have near copies."""
    with bucketed(tagged.groupBy("near_set").agg(F.min("row.text").alias("text"), F.min("word_print").alias("fp")), "sets", "near_set") as sets:
        first = written(sets.groupBy("fp").agg(F.min("near_set").alias("first")), "first")
        a, b = (first.select(F.col("fp").alias(f), F.col("first").alias(x)) for f, x in (("src", "a"), ("dst", "b")))
        pairs = _compared(first, fuzzy_keys, CANDIDATE_BITS, FEW).join(a, "src").join(b, "dst").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
        sure = written(_checked(written(pairs.distinct(), "pairs"), sets), "links")
        reached, frequencies = written(connected_components(sure), "reached"), sets.sparkSession.sparkContext.broadcast(_frequencies(sets))
        met = written(_sharing(sets, reached, frequencies), "pairs")
        sure = sure.union(written(_checked(met.where("least > 0").select("src", "dst"), sets), "links"))
        sure = sure.union(written(_within_families(sets, reached, met.where("least = 0")), "links"))
        return written(connected_components(sure), "reached")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component, that of the smallest id (nulls last); columns unchanged."""
    tagged = written(with_set(docs), "shingled")
    total = tagged.count()
    reached = near_copies(tagged)
    sets = tagged.groupBy("near_set").agg(F.count("*").alias("n")).join(reached, F.col("near_set") == F.col("node"), "left")
    sets = written(sets.select("near_set", "n", F.coalesce("component", "near_set").alias("component")), "sets")
    rows = look_up(tagged.select(F.col("row.doc_id").alias("doc_id"), "near_set"), sets, "near_set", total)
    held = rows.groupBy("component", "doc_id", "near_set").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "near_set", "rows")).alias("s")
    stay = held.groupBy("component").agg(first).select(F.col("s.doc_id").alias("stay_id"), F.col("s.near_set").alias("near_set"), "s.rows")
    stay = written(stay.join(sets.drop("component"), "near_set"), "stay")
    kept = look_up(tagged.select("row", "near_set"), stay.drop("rows"), "near_set", total).where(F.col("row.doc_id").eqNullSafe(F.col("stay_id")))
    if not stay.where("rows > 1").isEmpty():
        kept = kept.groupBy("near_set").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return kept.select("row.*")
